"""Quality rules: gradient-boosted trees over document statistics.

Statistics of every whole text are taken in one pass over Arrow batches and held as a narrow table. The trees are
trained in numpy on at most ``TRAIN_ROWS`` labelled rows (the ones with the smallest hash), with histograms of at most
``BINS`` cells per feature, and are then flattened into node arrays, so a batch descends all trees level by level by
indexing alone. Features of ``FALLING`` can only lower the score: a split whose right side would score higher is not
taken, and its children are held to either side of the middle between them.

Defined cases: a null or empty text has zero for every statistic and fails the base rule (fewer than ten words); texts
of any length are read whole; repeated rows give repeated results; a null doc_id is kept and never matches a label;
null labels are not used; with no label, or labels of one class only, the verdict of the method is to keep; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomkit.llm.jobs import bounded_sample, query, table
from fathomkit.session import hold

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_HESSIAN, RIDGE = 60, 3, 0.2, 32, 5.0, 1.0
LEFT_OUT = 5  # one of so many labelled rows is not fitted on but sets the threshold
KEEP_RECALL = 0.998
KEEP_AT = 0.5

# The characters that the base rule counts, and the white space between words.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_digits", "n_stops", "n_alpha", "n_unique", "n_bang"]
FEATURES = [
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "stop_share", "alpha_share", "unique_share", "bang_share", "line_words",
]
FALLING = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share")

_ODD = np.random.RandomState(7).randint(1 << 62, size=WINDOW, dtype=np.int64).astype(np.uint64) * 2 + 1


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur twice or more, their first occurrence included.

    Windows are compared by 64-bit sums over word hashes.
    """
    n = len(words) - size + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = sum(hashes[j: j + n] * _ODD[j] for j in range(size))
    order = np.sort(key)
    same = order[1:] == order[:-1]
    if not same.any():
        return 0
    hit = np.isin(key, order[1:][same])
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: str) -> tuple[int, ...]:
    """COUNTS and MORE of one text."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return (0, 0, sum(map(text.count, SYMBOLS)), *[0] * (len(COUNTS) + len(MORE) - 3))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    codes = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(codes, minlength=256)
    high = int(kinds[192:].sum())  # one leading byte per character beyond ASCII
    upper, lower = int(kinds[65:91].sum()), int(kinds[97:123].sum())
    if high:
        upper += sum(1 for c in text if c > "\x7f" and c.isupper())
    return (
        len(words), len(text) - int(kinds[[*map(ord, SPACES)]].sum()), int(kinds[[*map(ord, SYMBOLS)]].sum()),
        len(lines) - len(set(lines)), repeated_words(words),
        len(lines), upper, int(kinds[48:58].sum()), int(kinds[46]) + int(kinds[44]),
        upper + lower + high, len(set(words)), int(kinds[33]),
    )


def document_counts(docs: DataFrame) -> DataFrame:
    """doc_id with COUNTS and MORE, one row per document."""
    names = COUNTS + MORE
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(n, T.LongType()) for n in names),
    ])

    def count(batches):
        for batch in batches:
            rows = [text_counts(t or "") for t in batch.column(1).to_pylist()]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(count, schema)


def features(counts: pd.DataFrame) -> np.ndarray:
    c = {n: counts[n].to_numpy(float) for n in COUNTS + MORE}
    words, chars, lines = (np.maximum(c[n], 1) for n in ("n_words", "word_chars", "n_lines"))
    alpha = np.maximum(c["n_alpha"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), chars / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_upper"] / alpha, c["n_digits"] / chars, c["n_stops"] / words,
        c["n_alpha"] / chars, c["n_unique"] / words, c["n_bang"] / words, words / lines,
    ])


class Trees:
    """All nodes of all trees in flat arrays; a leaf points to itself."""

    def __init__(self, base: float):
        self.base, self.roots = base, []
        self.feature, self.limit, self.left, self.right, self.value = [], [], [], [], []

    def add(self, value: float) -> int:
        for part, x in ((self.feature, 0), (self.limit, np.inf), (self.value, value)):
            part.append(x)
        self.left.append(len(self.left))
        self.right.append(len(self.right))
        return len(self.value) - 1

    def freeze(self) -> Trees:
        for name, kind in (("feature", int), ("limit", float), ("left", int), ("right", int), ("value", float)):
            setattr(self, name, np.asarray(getattr(self, name), kind))
        self.roots = np.asarray(self.roots, int)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the label 1 for each row."""
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(DEPTH):
            at = np.where(x[rows, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-self.base - self.value[at].sum(1)))


def boost(x: np.ndarray, y: np.ndarray, signs: np.ndarray) -> Trees:
    """Second-order boosting of the logistic loss. ``signs``: -1 where a feature may only lower the score, 1 where it
    may only raise it, 0 where it is free."""
    rate = min(max(y.mean(), 1e-6), 1 - 1e-6)
    trees = Trees(math.log(rate / (1 - rate)))
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
    cells = np.column_stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T)])
    total = np.full(len(y), trees.base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        root = trees.add(0.0)
        trees.roots.append(root)
        open_nodes = [(root, np.arange(len(y)), -np.inf, np.inf)]
        for level in range(DEPTH + 1):
            grown = []
            for node, rows, low, high in open_nodes:
                sg, sh = g[rows].sum(), h[rows].sum()
                trees.value[node] = RATE * float(np.clip(sg / (sh + RIDGE), low, high))
                total_gain, best = sg * sg / (sh + RIDGE), None
                if level == DEPTH:
                    total[rows] += trees.value[node]
                    continue
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    gl = np.cumsum(np.bincount(cells[rows, f], g[rows], len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(cells[rows, f], h[rows], len(e) + 1))[:-1]
                    gr, hr = sg - gl, sh - hl
                    vl = np.clip(gl / (hl + RIDGE), low, high)
                    vr = np.clip(gr / (hr + RIDGE), low, high)
                    gain = gl * gl / (hl + RIDGE) + gr * gr / (hr + RIDGE) - total_gain
                    bad = (hl < LEAST_HESSIAN) | (hr < LEAST_HESSIAN) | (signs[f] * (vr - vl) < 0)
                    gain[bad] = -np.inf
                    k = int(np.argmax(gain))
                    if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                        best = (gain[k], f, k, vl[k], vr[k])
                if best is None:
                    total[rows] += trees.value[node]
                    continue
                _, f, k, vl, vr = best
                trees.feature[node], trees.limit[node] = f, float(edges[f][k])
                left, right = trees.add(0.0), trees.add(0.0)
                trees.left[node], trees.right[node] = left, right
                inside, mid = cells[rows, f] <= k, (vl + vr) / 2
                lows, highs = (low, low), (high, high)
                if signs[f] > 0:
                    lows, highs = (low, mid), (mid, high)
                elif signs[f] < 0:
                    lows, highs = (mid, low), (high, mid)
                grown.append((left, rows[inside], lows[0], highs[0]))
                grown.append((right, rows[~inside], lows[1], highs[1]))
            open_nodes = grown
    return trees.freeze()


def fails(n_words, n_repeat_words):
    """The base rule, over columns of Spark or of pandas."""
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words)


def train(counts: DataFrame, labels: DataFrame) -> tuple[Trees, float] | None:
    """Trees and the score from which a document is kept; None without labels of both classes.

    That score is ``KEEP_AT``, or less where more than a share of 1 - KEEP_RECALL of the good rows would fall below,
    by the rows that the trees were not fitted on and that the base rule keeps.
    """
    known = labels.select("doc_id", F.col("quality").cast("double").alias("quality")).dropna()
    rows = bounded_sample(counts.join(known, "doc_id").withColumn(
        "left_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % LEFT_OUT == 0), TRAIN_ROWS).toPandas()
    y = rows["quality"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    x, left = features(rows), rows["left_out"].to_numpy(bool)
    if len(set(y[~left])) < 2:
        left = np.zeros(len(y), bool)
    trees = boost(x[~left], y[~left], np.asarray([-1 if n in FALLING else 0 for n in FEATURES]))
    good = (y == 1) & ~fails(rows["n_words"], rows["n_repeat_words"]).to_numpy(bool)
    good = good & left if (good & left).any() else good
    return trees, float(min(KEEP_AT, np.quantile(trees.score(x[good]), 1 - KEEP_RECALL))) if good.any() else KEEP_AT


def rate(counts: DataFrame, model: tuple[Trees, float] | None) -> DataFrame:
    """The counts with base_failed, score (null without a model) and kept."""
    rated = counts.withColumn("base_failed", fails(F.col("n_words"), F.col("n_repeat_words")))
    if model is None:
        return rated.withColumn("score", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))
    trees, least = model

    def score(frames):
        for frame in frames:
            yield frame.assign(score=trees.score(features(frame)) if len(frame) else np.zeros(0))

    schema = T.StructType([*rated.schema.fields, T.StructField("score", T.DoubleType())])
    return rated.mapInPandas(score, schema).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    counts = hold(document_counts(docs))
    return rate(counts, train(counts, labels))


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rated.select("doc_id", *COUNTS, "base_failed", "kept", "score")
