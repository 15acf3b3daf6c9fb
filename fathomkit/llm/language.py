"""Language identification by interpolated Kneser-Ney character models.

Texts become lower-case letters with one space for every run of anything else. The sequences of ``ORDER`` characters are
counted per language over all learning documents: each Arrow batch is sorted and counted by itself, and Spark adds the
counts up. Counts of shorter sequences are continuation counts, the number of different characters seen before them,
and follow from the table of longer ones. The discounts come from how often counts of one and two occur. Every sequence
is kept for scoring, in arrays sorted by a hash of the sequence, with a column of probabilities per language; one that
was not seen falls back to shorter sequences with the weight of its context. The arrays pass the driver and are
broadcast, so distinct sequences (not rows) are limited by its memory; where they do not fit, the job fails.

The language with the lowest cross-entropy per character wins. Its score is calibrated on all learning documents, which
are scored in tasks: a logistic curve over the lead in cross-entropy, fitted on sums over all rows, exact in decimals; a
document whose cross-entropy lies above what nearly all learning documents of that language reach (an exact quantile) is
marked as rejected.

Defined cases: a null text, or one without a letter, gives ``und`` with score 0; texts of any length are read whole;
equal entropies go to the first language in order; repeated rows give repeated results and count each in learning; a
null lang teaches nothing; a null doc_id has no checksum and is never used for learning; with nothing to learn from
every document is ``und``; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomkit.llm.jobs import query, table
from fathomkit.operators.ordered import quantiles
from fathomkit.session import hold

ORDER = 4
REJECT_SHARE = 0.005
CHUNK_CHARS = 500_000
UNKNOWN = "und"

_BITS = 16
_ODD = np.uint64(0x9E3779B97F4A7C15)  # odd, so multiplying by it maps sequences to hashes one to one
_SPACE = 32


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point to itself for letters, to the space for all else; beyond 16 bits letters share one code."""
    codes = np.full(1 << _BITS, _SPACE, np.uint64)
    for c in range(1 << _BITS):
        if chr(c).isalpha():
            codes[c] = c
    return codes


def letters_of(text: str) -> np.ndarray:
    """Letter codes of a text with single spaces between runs, a space first and last; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    codes = _letters()[np.minimum(points, (1 << _BITS) - 1)]
    if points.size and points.max() >= 1 << _BITS:
        far = np.flatnonzero(points >= 1 << _BITS)
        codes[far] = [0xFFFD if chr(p).isalpha() else _SPACE for p in points[far]]
    letter = codes != _SPACE
    if not letter.any():
        return np.zeros(0, np.uint64)
    codes = np.concatenate(([_SPACE], codes, [_SPACE])).astype(np.uint64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
    return codes[keep]


def sequences(codes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The sequences ending at every character after the first, packed 16 bits a character; early ones start with
    spaces."""
    if len(codes) < 2:
        return np.zeros(0, np.uint64)
    padded = np.concatenate((np.full(order - 2, _SPACE, np.uint64), codes))
    n = len(codes) - 1
    key = np.zeros(n, np.uint64)
    for j in range(order):
        key = key << np.uint64(_BITS) | padded[j: j + n]
    return key


def chunks(texts: list[str], most: int = CHUNK_CHARS):
    """Slices of ``texts`` with about ``most`` characters, a longer text by itself."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield at, i
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield at, len(texts)


def sequence_counts(docs: DataFrame) -> DataFrame:
    """lang, gram (packed), n over the texts of ``docs`` (lang, text)."""

    def count(batches):
        for batch in batches:
            langs = np.asarray(batch.column(0).to_pylist(), object)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lang in sorted(set(langs)):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                for a, b in chunks(own, 4 * CHUNK_CHARS):
                    keys = np.sort(np.concatenate([sequences(letters_of(t)) for t in own[a:b]]))
                    if not len(keys):
                        continue
                    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                    n = np.diff(np.append(first, len(keys)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(first), pa.string()), pa.array(keys[first].view(np.int64)),
                         pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    grams = docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def shorter(counts: DataFrame, order: int) -> DataFrame:
    """Continuation counts of the sequences of ``order`` - 1 characters in a table of those of ``order``."""
    suffix = F.col("gram").bitwiseAND(F.lit((1 << _BITS * (order - 1)) - 1))
    return counts.groupBy("lang", suffix.alias("gram")).agg(F.count("*").alias("n"))


class Model:
    """Sorted hash arrays per order: probabilities of sequences and weights of contexts, a column per language."""

    def __init__(self, langs: list[str]):
        self.langs, self.keys, self.p, self.contexts, self.weight = langs, {}, {}, {}, {}
        self.unseen = np.zeros(len(langs))
        self.slope, self.offset, self.most = 1.0, 0.0, np.full(len(langs), np.inf)

    def _find(self, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed = wanted * _ODD
        at = np.minimum(np.searchsorted(keys, hashed), max(len(keys) - 1, 0))
        return at, (keys[at] == hashed) if len(keys) else np.zeros(len(wanted), bool)

    def chances(self, order: int, grams: np.ndarray) -> np.ndarray:
        """Probability of the last character after the others, per language."""
        at, known = self._find(self.keys[order], grams)
        out = np.empty((len(grams), len(self.langs)))
        out[known] = self.p[order][at[known]]
        rest = grams[~known]
        if len(rest):
            out[~known] = self.unseen if order == 1 else self.fallback(order, rest)
        return out

    def fallback(self, order: int, grams: np.ndarray) -> np.ndarray:
        at, known = self._find(self.contexts[order], grams >> np.uint64(_BITS))
        weight = np.ones((len(grams), len(self.langs)))
        weight[known] = self.weight[order][at[known]]
        return weight * self.chances(order - 1, grams & np.uint64((1 << _BITS * (order - 1)) - 1))

    def add(self, order: int, rows: pd.DataFrame) -> None:
        """Sequences of one order (lang, gram, n); shorter orders come first."""
        grams = rows["gram"].to_numpy(np.int64).view(np.uint64)
        column = np.searchsorted(self.langs, rows["lang"].to_numpy(str))
        n, width = rows["n"].to_numpy(float), len(self.langs)
        ones = np.bincount(column[n == 1], minlength=width)
        twos = np.bincount(column[n == 2], minlength=width)
        discount = np.where(ones > 0, (ones + 0.5) / (ones + 2 * twos + 1), 0.5)
        left = np.maximum(n - discount[column], 0)
        keys, row = np.unique(grams, return_inverse=True)
        own = np.zeros((len(keys), width))
        if order == 1:
            total = np.maximum(np.bincount(column, n, width), 1)
            types = np.bincount(column, minlength=width)
            own[row, column] = left / total[column]
            self.unseen = np.where(types > 0, discount * types / total, 1.0) / (len(keys) + 1)
            p = own + self.unseen
        else:
            contexts, of = np.unique(grams >> np.uint64(_BITS), return_inverse=True)
            total, types = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
            np.add.at(total, (of, column), n)
            np.add.at(types, (of, column), 1)
            own[row, column] = left / total[of, column]
            weight = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
            order_of = np.argsort(contexts * _ODD)
            self.contexts[order], self.weight[order] = (contexts * _ODD)[order_of], weight[order_of]
            p = own + self.fallback(order, keys)
        by = np.argsort(keys * _ODD)
        self.keys[order], self.p[order] = (keys * _ODD)[by], p[by]

    def freeze(self) -> Model:
        """Single precision, to halve what is broadcast."""
        for part in (self.p, self.weight):
            for order in part:
                part[order] = part[order].astype(np.float32)
        return self

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Nats per character, per text and language; NaN without a letter."""
        out = np.full((len(texts), len(self.langs)), np.nan)
        keys = [sequences(letters_of(t)) for t in texts]
        sizes = np.asarray([len(k) for k in keys])
        rows = np.flatnonzero(sizes)
        if not len(rows) or not self.langs:
            return out
        grams = np.concatenate(keys)
        order = np.sort(grams)
        distinct = order[np.concatenate(([True], order[1:] != order[:-1]))]
        logs = -np.log(self.chances(ORDER, distinct))
        place = np.searchsorted(distinct, grams)
        starts = np.concatenate(([0], np.cumsum(sizes[rows])[:-1]))
        for k in range(len(self.langs)):
            out[rows, k] = np.add.reduceat(logs[:, k][place], starts) / sizes[rows]
        return out


def _lead(entropies: np.ndarray) -> np.ndarray:
    """How far the best language is ahead of the next."""
    if entropies.shape[1] < 2:
        return np.zeros(len(entropies))
    low = np.partition(entropies, 1, axis=1)
    return low[:, 1] - low[:, 0]


def _entropies(model: Model, texts: list[str]) -> np.ndarray:
    found = [model.entropies(texts[a:b]) for a, b in chunks(texts)]
    return np.concatenate(found) if found else np.zeros((0, len(model.langs)))


def leads(known: DataFrame, model: Model) -> DataFrame:
    """lang, best, entropy and lead of every text of ``known`` (lang, text) with a letter."""
    sent = known.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        m = sent.value
        names = np.asarray(m.langs, object)
        for batch in batches:
            e = _entropies(m, [t or "" for t in batch.column(1).to_pylist()])
            some = np.flatnonzero(~np.isnan(e).any(1))
            e = e[some]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(some)), pa.array(names[e.argmin(1)], pa.string()), pa.array(e.min(1)),
                 pa.array(_lead(e))], names=["lang", "best", "entropy", "lead"])

    return known.select("lang", "text").mapInArrow(measure, "lang string, best string, entropy double, lead double")


def calibrate(model: Model, known: DataFrame) -> None:
    """Fits the logistic curve of the score and the entropies from which a language is rejected, on all rows."""
    if not model.langs:
        return
    rows = hold(leads(known, model))
    if rows.isEmpty():
        return
    # a row per language
    for r in quantiles(rows.where("best = lang"), ["entropy"], [1 - REJECT_SHARE], ["best"], ["most"]).collect():
        model.most[model.langs.index(r["best"])] = r["most"] + 1e-9
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + F.exp(-(F.col("lead") * float(w[0]) + float(w[1]))))
        gap, curve = F.when(F.col("best") == F.col("lang"), 0.99).otherwise(0.01) - p, p * (1 - p)
        x = F.col("lead")
        # decimals add up to the same in any order
        a, b, xx, xy, yy = (float(v) for v in rows.agg(*[
            F.sum(c.cast("decimal(28,12)")) for c in (gap * x, gap, curve * x * x, curve * x, curve)]).first())
        move = np.linalg.solve(np.array([[xx, xy], [xy, yy]]) + 1e-4 * np.eye(2), np.array([a, b]) - 1e-4 * w)
        w = w + move
        if np.abs(move).max() < 1e-9:
            break
    model.slope, model.offset = max(float(w[0]), 0.0), float(w[1])


def learn(docs: DataFrame) -> Model:
    """Model of the languages of ``docs`` (doc_id, lang, text); rows without a lang teach nothing."""
    known = docs.where("lang IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"),
                                                  F.col("text").cast("string").alias("text"))
    counts = hold(sequence_counts(known))
    tables = {ORDER: counts}
    for order in range(ORDER, 1, -1):
        tables[order - 1] = hold(shorter(tables[order], order)) if order > 2 else shorter(tables[order], order)
    langs = sorted(r["lang"] for r in tables[1].select("lang").distinct().collect())
    model = Model(langs)
    for order in range(1, ORDER + 1):
        model.add(order, tables[order].toPandas())
    calibrate(model.freeze(), known)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, entropy, rejected."""
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("lang_pred", T.StringType()),
              T.StructField("score", T.DoubleType()), T.StructField("entropy", T.DoubleType()),
              T.StructField("rejected", T.BooleanType())]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        m = sent.value
        names = np.asarray([*m.langs, UNKNOWN], object)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            e = _entropies(m, texts)
            none = np.isnan(e).any(1) if m.langs else np.ones(len(texts), bool)
            e = np.where(none[:, None], 0.0, e)
            best = np.where(none, len(m.langs), e.argmin(1) if m.langs else 0)
            lowest = e.min(1) if m.langs else np.zeros(len(texts))
            score = np.where(none, 0.0, 1 / (1 + np.exp(-m.offset - m.slope * _lead(e))))
            over = none | (lowest > np.append(m.most, np.inf)[best])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(lowest),
                 pa.array(over)], names=[f.name for f in fields])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(predict, T.StructType(fields))


def held_out(doc_id="doc_id", parts: int = 4, left: int = 2):
    """Whether the checksum of the id falls into the part that is left out of learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == left, F.lit(True))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()).select("doc_id", "lang", "text"))
    return identify(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "entropy", "rejected")
