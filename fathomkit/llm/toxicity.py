"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is its words (runs of letters, lower case). A word enters the network as an embedding of its own, if it is among
the ``WORDS`` words of the training sample that tell the classes apart best, and as the sum of the embeddings of its
character triples, hashed to ``TRIPLES`` cells, so forms not seen before still share their stem. Gated recurrent units
run over a window in either direction, attention weighs their states, and a logistic unit scores the window. A document
is scored by the highest of all its overlapping windows, whatever its length, and that maximum is calibrated.

Training takes at most ``TRAIN_ROWS`` labelled documents of each class (those with the smallest hash; a documented
bound). Their labels hold for the whole document, so each epoch first finds the highest window of every document with
the network as it is, at the start the window around its most telling word, and then learns from these windows and some
random ones of clean documents.

Scoring is one pass over Arrow batches. What a word contributes to the gates is computed once per distinct word and
remembered up to ``CACHE_WORDS`` words.

Defined cases: a null or empty text, or one without letters, gets the share of toxic labels as its score; texts of any
length are read whole; repeated rows give repeated scores; a null doc_id is kept and never matches a label; null
labels are not used; without labels of both classes every score is the share of toxic labels (0 without labels); other
columns are ignored by ``scored`` and kept by ``without_toxic``; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomkit.llm.jobs import bounded_sample, every, free_name, query, sampled_texts, table, with_scored_text
from fathomkit.session import hold

TRAIN_ROWS = 1500
WINDOW, STRIDE = 32, 16
WORDS, TRIPLES = 2048, 8192
WORD_SIZE, TRIPLE_SIZE, HIDDEN, ATTENTION = 8, 12, 8, 8
EPOCHS, STEPS, BATCH, RATE = 10, 800, 64, 0.01
LEAST_DOCS, LEAST_CALIBRATION = 3, 50
REJECT_AT = 0.7
CACHE_WORDS = 200_000
CHUNK_WINDOWS = 1024
CHUNK_CHARS = 1_000_000
CHUNK_WORDS = 20_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def triples_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the character triples of all words, with their ends marked, and where each word's cells begin."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), "<u4").astype(np.int64)
    cells = (codes[:-2] * 7_919 + codes[1:-1] * 104_729 + codes[2:] * 1_299_709) % TRIPLES
    many = np.fromiter(map(len, words), np.int64, len(words))  # a word of n letters has n triples
    begin = np.cumsum(many + 2) - many - 2
    inside = np.ones(len(codes), bool)
    inside[begin + many] = inside[begin + many + 1] = False
    return cells[inside[:-2]], np.cumsum(many) - many


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _shapes() -> dict[str, tuple[int, ...]]:
    width = WORD_SIZE + TRIPLE_SIZE
    shapes = {"words": (WORDS + 1, WORD_SIZE), "triples": (TRIPLES, TRIPLE_SIZE)}
    for way in ("f", "b"):
        shapes |= {f"in_{way}": (width, 3 * HIDDEN), f"bias_{way}": (3 * HIDDEN,), f"state_{way}": (HIDDEN, 3 * HIDDEN)}
    return shapes | {"attend": (2 * HIDDEN, ATTENTION), "attend_bias": (ATTENTION,), "attend_out": (ATTENTION,),
                     "out": (2 * HIDDEN,), "out_bias": (1,)}


class Network:
    """Weights, the vocabulary, the calibration (slope, offset) of a document's highest window, and the share of toxic
    labels."""

    def __init__(self, seed: int = 11):
        random = np.random.RandomState(seed)
        self.w = {}
        for name, shape in _shapes().items():
            scale = 0.1 if name in ("words", "triples") else 0.0 if "bias" in name else shape[0] ** -0.5
            self.w[name] = (random.randn(*shape) * scale).astype(np.float32)
        self.w["words"][WORDS] = 0  # words outside the vocabulary
        self.vocabulary: dict[str, int] = {}
        self.slope, self.offset, self.share = 1.0, 0.0, 0.0

    def inputs(self, words: list[str]) -> np.ndarray:
        """What enters the network for each word."""
        return self.combined([self.vocabulary.get(x, WORDS) for x in words], *triples_of(words))

    def combined(self, rows, cells: np.ndarray, starts: np.ndarray) -> np.ndarray:
        shape = np.tanh(np.add.reduceat(self.w["triples"][cells], starts, axis=0))
        return np.concatenate([self.w["words"][rows], shape], axis=1)

    def gates(self, words: list[str]) -> np.ndarray:
        """The words' share of the gates in both directions, side by side; a last row of zeros for padding."""
        return self.gates_of(self.inputs(words)) if words else np.zeros((1, 6 * HIDDEN), np.float32)

    def gates_of(self, x: np.ndarray) -> np.ndarray:
        both = [x @ self.w[f"in_{way}"] + self.w[f"bias_{way}"] for way in ("f", "b")]
        return np.vstack([np.concatenate(both, axis=1), np.zeros((1, 6 * HIDDEN), np.float32)])

    def run(self, gates: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States [time, window, HIDDEN] of one direction; ``gates`` [time, window, 3 HIDDEN]."""
        u, h = self.w[f"state_{way}"], np.zeros((gates.shape[1], HIDDEN), np.float32)
        states = np.empty((*gates.shape[:2], HIDDEN), np.float32)
        steps = range(len(gates)) if way == "f" else range(len(gates) - 1, -1, -1)
        for t in steps:
            hu = h @ u
            zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(gates[t, :, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
            m = mask[t][:, None]
            new = h + m * (1 - z) * (n - h)
            if keep is not None:
                keep.append((t, h, z, r, n, hu[:, 2 * HIDDEN:], m))
            h = states[t] = new
        return states

    def pooled(self, states: np.ndarray, mask: np.ndarray):
        """Logits of windows, with what the way back needs."""
        a = np.tanh(states @ self.w["attend"] + self.w["attend_bias"])
        s = a @ self.w["attend_out"]
        e = np.exp(s - s.max(0)) * mask
        share = e / (e.sum(0) + 1e-9)
        context = (share[:, :, None] * states).sum(0)
        return context @ self.w["out"] + self.w["out_bias"][0], (a, share, context)

    def logits(self, gates: np.ndarray, index: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Logits of windows; ``index`` [time, window] points into ``gates``, its last row being padding."""
        g = gates[index]
        states = np.concatenate([self.run(g[:, :, : 3 * HIDDEN], mask, "f"),
                                 self.run(g[:, :, 3 * HIDDEN:], mask, "b")], axis=2)
        return self.pooled(states, mask)[0]


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of every window; windows of WINDOW words every STRIDE words cover each text."""
    sizes = np.asarray(sizes, np.int64)
    many = np.maximum(1, -(-np.maximum(sizes - WINDOW, 0) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(sizes)), many)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    start = nth * STRIDE
    return doc, start, np.minimum(WINDOW, sizes[doc] - start)


def _index(ids: np.ndarray, first: np.ndarray, length: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """[time, window] indices and mask of windows that begin at ``first`` in ``ids``."""
    t = np.arange(WINDOW)[:, None]
    mask = t < length[None, :]
    if not len(ids):
        return np.full(mask.shape, pad), mask.astype(np.float32)
    at = np.minimum(first[None, :] + t, len(ids) - 1)
    return np.where(mask, ids[at], pad), mask.astype(np.float32)


def highest(net: Network, gates: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document the highest logit of its windows and the start of that window."""
    doc, start, length = windows_of(sizes)
    first = (np.cumsum(sizes) - sizes)[doc] + start
    logits = np.empty(len(doc), np.float32)
    for a in range(0, len(doc), CHUNK_WINDOWS):
        b = a + CHUNK_WINDOWS
        logits[a:b] = net.logits(gates, *_index(ids, first[a:b], length[a:b], len(gates) - 1))
    heads = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, int)
    top = np.maximum.reduceat(logits, heads) if len(doc) else logits
    best = np.flatnonzero(logits == top[doc])
    pick = best[np.unique(doc[best], return_index=True)[1]]
    return top, start[pick]


def _backward(net: Network, x: np.ndarray, index: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Gradients of the weighted logistic loss, and of the words' inputs."""
    w, grad, kept = net.w, {}, {"f": [], "b": []}
    g = {way: x @ w[f"in_{way}"] + w[f"bias_{way}"] for way in ("f", "b")}
    states = np.concatenate([net.run(np.vstack([g[way], np.zeros((1, 3 * HIDDEN), np.float32)])[index], mask, way,
                                     kept[way]) for way in ("f", "b")], axis=2)
    logit, (a, share, context) = net.pooled(states, mask)
    d_logit = (weight * (_sigmoid(logit) - y) / len(y)).astype(np.float32)
    grad["out"], grad["out_bias"] = context.T @ d_logit, d_logit.sum(keepdims=True)
    d_context = d_logit[:, None] * w["out"]
    d_share = (states * d_context).sum(2)
    d_s = share * (d_share - (share * d_share).sum(0))
    d_a = d_s[:, :, None] * w["attend_out"] * (1 - a * a)
    grad["attend_out"] = np.einsum("tb,tba->a", d_s, a)
    grad["attend"] = np.einsum("tbh,tba->ha", states, d_a)
    grad["attend_bias"] = d_a.sum((0, 1))
    d_states = share[:, :, None] * d_context + d_a @ w["attend"].T
    d_x = np.zeros_like(x)
    for k, way in enumerate(("f", "b")):
        u, d_h = w[f"state_{way}"], np.zeros((len(y), HIDDEN), np.float32)
        d_u = np.zeros_like(u)
        d_g = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
        for t, h, z, r, n, hn, m in reversed(kept[way]):
            d_new = d_h + d_states[t, :, k * HIDDEN: (k + 1) * HIDDEN]
            d_n = d_new * m * (1 - z) * (1 - n * n)
            d_z = d_new * m * (h - n) * z * (1 - z)
            d_r = d_n * hn * r * (1 - r)
            d_hu = np.concatenate([d_z, d_r, d_n * r], axis=1)
            d_u += h.T @ d_hu
            d_h = d_new * (1 - m * (1 - z)) + d_hu @ u.T
            np.add.at(d_g, index[t], np.concatenate([d_z, d_r, d_n], axis=1))
        d_g = d_g[:-1]
        grad[f"state_{way}"], grad[f"in_{way}"], grad[f"bias_{way}"] = d_u, x.T @ d_g, d_g.sum(0)
        d_x += d_g @ w[f"in_{way}"].T
    return grad, d_x


class _Adam:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}
        self.t = 0

    def step(self, weights, grads, rate):
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            weights[k] -= rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)


def _telling(docs: list[np.ndarray], y: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Per word the log ratio of the shares of toxic and clean documents that hold it, and how many do."""
    counts, many = np.zeros((2, words)), np.bincount(y, minlength=2)
    for ids, label in zip(docs, y):
        counts[label, np.unique(ids)] += 1
    share = np.log((counts + 0.5) / (many[:, None] + 1))
    return share[1] - share[0], counts.sum(0)


def train(texts: list[str], labels: np.ndarray, share: float, seed: int = 11) -> Network:
    """Network from texts with labels 0 and 1; ``share``: of toxic ones among all labelled rows, for calibration.

    Every fifth text of either class is left for the calibration, if there are enough.
    """
    labels = np.asarray(labels, int)
    nth = np.where(labels == 1, np.cumsum(labels), np.cumsum(1 - labels))
    left = (nth % 5 == 0) & (min(labels.sum(), (1 - labels).sum()) >= 5 * LEAST_CALIBRATION)
    kept = [t for t, out in zip(texts, left) if not out]
    net = _fitted(kept, labels[~left], seed)
    net.share = float(share)
    if left.any():
        kept, labels = [t for t, out in zip(texts, left) if out], labels[left]
    parts = [Scorer(net).tops(kept[a: a + 100]) for a in range(0, len(kept), 100)]
    top, some = (np.concatenate(x) for x in zip(*parts))
    y = labels[some]
    real = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    net.slope, net.offset = _calibrated(top[some], y, real)
    return net


def _fitted(texts: list[str], y: np.ndarray, seed: int) -> Network:
    """Network without calibration."""
    net, random = Network(seed), np.random.RandomState(seed)
    number: dict[str, int] = {}
    docs = [np.asarray([number.setdefault(w, len(number)) for w in words_of(t)], np.int64) for t in texts]
    names = list(number)
    telling, held = _telling(docs, y, len(names))
    ranked = sorted(np.flatnonzero(held >= LEAST_DOCS), key=lambda i: (-abs(telling[i]), names[i]))[:WORDS]
    net.vocabulary = {names[i]: row for row, i in enumerate(ranked)}
    own_row = np.full(len(names), WORDS, np.int64)
    own_row[ranked] = np.arange(len(ranked))
    sizes = np.asarray([len(d) for d in docs], np.int64)
    start = np.asarray([max(0, min(int(np.argmax(telling[d])) - STRIDE, len(d) - WINDOW)) if len(d) else 0
                        for d in docs], np.int64)
    ids = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    begin = np.cumsum(sizes) - sizes
    cells, cell_begin = triples_of(names) if names else (np.zeros(0, np.int64),) * 2
    cell_count = np.diff(np.append(cell_begin, len(cells)))
    del docs, number, names

    def top_windows():
        gates = np.zeros((len(own_row) + 1, 6 * HIDDEN), np.float32)
        for a in range(0, len(own_row), CHUNK_WORDS):
            b = min(a + CHUNK_WORDS, len(own_row))
            some = cells[cell_begin[a]: cell_begin[b - 1] + cell_count[b - 1]]
            x = net.combined(own_row[a:b], some, cell_begin[a:b] - cell_begin[a])
            gates[a:b] = net.gates_of(x)[:-1]
        return highest(net, gates, ids, sizes)

    adam = _Adam(net.w)
    clean = np.flatnonzero(y == 0)
    windows = len(y) + len(clean)
    epochs = max(EPOCHS, -(-STEPS * BATCH // windows))
    # toxic windows count more where they are few
    weight = np.where(y == 1, min(8.0, max(1.0, 2 * len(clean) / max(1, windows - 2 * len(clean)))), 1).astype(np.float32)
    for epoch in range(epochs):
        if epoch >= epochs // 5 and epoch * 10 // epochs > (epoch - 1) * 10 // epochs:
            start = top_windows()[1]
        extra = random.choice(clean, len(clean))
        doc = np.concatenate([np.arange(len(y)), extra])
        at = np.concatenate([start, (random.rand(len(extra)) * np.maximum(sizes[extra] - WINDOW, 1)).astype(int)])
        for part in np.array_split(random.permutation(len(doc)), max(1, len(doc) // BATCH)):
            d, s = doc[part], at[part]
            index, mask = _index(ids, begin[d] + s, np.minimum(WINDOW, sizes[d] - s), -1)
            used, local = np.unique(index, return_inverse=True)
            used, local = used[used >= 0], local.reshape(index.shape) - int((used < 0).any())
            local = np.where(index < 0, len(used), local)
            if not len(used):
                continue
            many = cell_count[used]
            first = np.cumsum(many) - many
            flat = cells[np.repeat(cell_begin[used] - first, many) + np.arange(many.sum())]
            x = net.combined(own_row[used], flat, first)
            shape = x[:, WORD_SIZE:]
            grad, d_x = _backward(net, x, local, mask, y[d].astype(np.float32), weight[d])
            grad["words"] = np.zeros_like(net.w["words"])
            np.add.at(grad["words"], own_row[used], d_x[:, :WORD_SIZE])
            grad["words"][WORDS] = 0
            grad["triples"] = np.zeros_like(net.w["triples"])
            d_cells = d_x[:, WORD_SIZE:] * (1 - shape * shape)
            np.add.at(grad["triples"], flat, np.repeat(d_cells, many, axis=0))
            adam.step(net.w, grad, RATE * (1 - epoch / epochs) + 0.001)
    return net


def _calibrated(top: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic curve over the highest logit, labels smoothed a little and weighted to the share of all labels."""
    x = np.column_stack([top, np.ones(len(top))])
    goal, w = np.clip(y.astype(float), 0.005, 0.995), np.asarray([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.01 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hessian, x.T @ (weight * (goal - p)) - 0.01 * (w - [1.0, 0.0])), -1, 1)
    return max(float(w[0]), 0.05), float(w[1])


def learn(docs: DataFrame, labels: DataFrame) -> Network | float:
    """Network from the labelled rows of ``docs`` (doc_id, text); the share of toxic rows if one class is missing.

    The sample is drawn from the ids; only one text of each is then fetched. An id with both labels counts as toxic.
    """
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    known = hold(docs.select("doc_id").distinct().join(marks, "doc_id"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if not (counts.get(0) and counts.get(1)):
        return float(share)
    ids = [bounded_sample(known.where(F.col("toxic") == k), TRAIN_ROWS) for k in (0, 1)]
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = sampled_texts(texts, ids[0].union(ids[1])).toPandas().sort_values(["toxic", "doc_id"])
    return train([t or "" for t in rows["text"]], rows["toxic"].to_numpy(int), share)


class Scorer:
    """Scores lists of texts; remembers what words add to the gates."""

    def __init__(self, net: Network):
        self.net, self.row, self.gates = net, {}, np.zeros((0, 6 * HIDDEN), np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        top, some = self.tops(texts)
        chance = 1 / (1 + np.exp(-np.clip(self.net.slope * top + self.net.offset, -30, 30)))
        return np.where(some, chance, self.net.share)

    def tops(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Highest logit per text, and whether it has a word."""
        if len(self.row) > CACHE_WORDS:
            self.row, self.gates = {}, self.gates[:0]
        docs = [words_of(t) for t in texts]
        row = self.row
        fresh = list(dict.fromkeys(w for d in docs for w in d if w not in row))
        if fresh:
            row.update(zip(fresh, range(len(self.gates), len(self.gates) + len(fresh))))
            self.gates = np.concatenate([self.gates, self.net.gates(fresh)[:-1]])
        ids = np.asarray([row[w] for d in docs for w in d], np.int64)
        sizes = np.asarray([len(d) for d in docs], np.int64)
        used, local = np.unique(ids, return_inverse=True)
        gates = np.vstack([self.gates[used], np.zeros((1, 6 * HIDDEN), np.float32)])
        return highest(self.net, gates, local, sizes)[0].astype(float), sizes > 0


def scored(docs: DataFrame, net: Network | float) -> DataFrame:
    """doc_id and score."""
    if isinstance(net, float):
        return docs.select("doc_id", F.lit(net).alias("score"))
    return _with_score(docs.select("doc_id", "text"), net, "score").drop("text")


def _with_score(docs: DataFrame, net: Network, name: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        scorer = Scorer(sent.value)

        def score(texts):
            parts, at, size = [np.zeros(0)], 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size > CHUNK_CHARS or i + 1 == len(texts):
                    parts.append(scorer.scores(texts[at: i + 1]))
                    at, size = i + 1, 0
            return pa.array(np.concatenate(parts))

        return score

    return with_scored_text(docs, name, T.DoubleType(), make)


def held_out(doc_id: str = "doc_id", parts: int = 3, left: int = 1):
    """Whether the checksum of the id falls into the part that is left out of learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == left, F.lit(True))


def without_toxic(docs: DataFrame, labels: DataFrame, at: float = REJECT_AT) -> DataFrame:
    """``docs`` without the rows that score ``at`` or more; the labels of other rows teach the network."""
    learning = ~held_out()
    net = learn(docs.where(learning), labels.where(learning))
    if isinstance(net, float):
        return docs.where(F.lit(net < at))
    name = free_name(docs, "toxic_score")
    return _with_score(docs, net, name).where(F.col(name) < at).select(*every(docs))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, learning = table(spark, sf_dir, "documents"), ~held_out()
    net = learn(docs.where(learning), table(spark, sf_dir, "labels").where(learning))
    return scored(docs, net).select("doc_id", held_out().alias("held_out"), "score",
                                    (F.col("score") >= REJECT_AT).cast("int").alias("predicted"))
