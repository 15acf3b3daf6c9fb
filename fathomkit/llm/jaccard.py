"""Near duplicates: Jaccard join on word shingles with Bayesian pruning of candidates.

Texts with the same set of five-word shingles are one class; classes are joined. Classes that agree in a whole band of
MinHash values (four of 128) meet in a bucket. A pair of a bucket is compared a few MinHash values at a time: with m of n
equal, the similarity has the posterior Beta(m + 1, n - m + 1), and the pair is dropped once the chance that it reaches
the threshold is below ``TOLERANCE``. The pairs that stay are verified exactly, by the size of the common part of their
shingle sets.

No pair is ever a row. Buckets with the same members are merged into one; each bucket is one cell of work, and one of
more than ``CELL_MEMBERS`` is dealt into chunks, of which each pair is a cell. A pair is handled only in the smallest
bucket that both share, which their own lists of buckets tell. A cell gives one row per linked member: the number of its
links there, and the smallest member that it reaches, which is enough to spread class ids over the links. Only members
of buckets carry their text along, once per bucket.

A pair of similarity 0.8 shares no band with a chance of 5e-8, and is pruned in error with one of about 1e-5 (8 steps
at tolerance 1e-6); pairs further above are safer still. Shingles are compared by 64-bit hashes.

Defined cases: a null text, or one without a word, is similar to nothing and a class of its own; a text of fewer than
five words has one shingle of them all; texts of any length are read whole; repeated rows and equal texts are copies of
each other; ``class_id`` is the smallest doc_id of a group (null only if all are); a null doc_id is kept and takes part;
other columns are ignored by ``linked`` and kept by ``one_of_each``; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomkit.llm.jobs import every, free_name, query, table, with_scored_text
from fathomkit.llm.shingles import HASHES, band_keys, digest_of, shingles_of, signature_of
from fathomkit.operators.components import components
from fathomkit.session import hold

THRESHOLD = 0.8
TOLERANCE = 1e-6
STEP = 16
CELL_MEMBERS = 1024
PAIR_BLOCK = 1 << 18
COLUMN_BLOCK = 1 << 12
DENSE_PAIRS = 64


@functools.lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n compared values the fewest equal ones with which a pair may go on.

    P(similarity >= t | m of n) is the chance of at most m heads in n + 1 throws of a coin that shows heads with t.
    """
    least = {}
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        least[n] = m
    return least


def survivors(signatures: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (i, j) are still possible after all values."""
    alive, equal = np.arange(len(i)), np.zeros(len(i), np.int32)
    for n, least in least_matches(threshold).items():
        part = slice(n - STEP, n)
        equal = equal + (signatures[i[alive], part] == signatures[j[alive], part]).sum(1, dtype=np.int32)
        stay = equal >= least
        alive, equal = alive[stay], equal[stay]
    return alive


def common_sizes(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the common parts of the sets of each pair."""
    if len(i) < DENSE_PAIRS:
        return np.asarray([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    used, local = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = local[: len(i)], local[len(i):]
    owner = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
    values, column, many = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True, return_counts=True)
    shared = many[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(used), len(used)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMN_BLOCK):
        a, b = np.searchsorted(column, [at, at + COLUMN_BLOCK])
        block = np.zeros((len(used), COLUMN_BLOCK), np.float32)
        block[owner[a:b], column[a:b] - at] = 1
        common += block @ block.T
    return common[i, j].astype(np.int64)


class Cell:
    """Members of one cell, and what they link to."""

    def __init__(self, key: int, across: bool):
        self.key, self.across = key, across
        self.node, self.chunk, self.weight, self.keys, self.sets = [], [], [], [], []

    def add(self, node: bytes, chunk: int, weight: int, keys: list[int], text: str | None) -> None:
        shingles = shingles_of(text or "")
        if digest_of(shingles) != node or node in self.node[-1:]:
            return  # another text under the same id, or a repeated row
        self.node.append(node)
        self.chunk.append(chunk)
        self.weight.append(weight)
        self.keys.append(keys)
        self.sets.append(shingles)

    def eligible(self) -> np.ndarray:
        """[n, n] whether a pair belongs to this cell: no smaller bucket in common, and chunks of either side."""
        n = len(self.node)
        owner = np.repeat(np.arange(n), [sum(k < self.key for k in keys) for keys in self.keys])
        smaller = np.asarray([k for keys in self.keys for k in keys if k < self.key], np.int64)
        yes = np.ones((n, n), bool)
        if len(smaller):
            _, column, many = np.unique(smaller, return_inverse=True, return_counts=True)
            shared = many[column] > 1
            if shared.any():
                column = np.unique(column[shared], return_inverse=True)[1]
                held = np.zeros((n, int(column.max()) + 1), np.float32)
                held[owner[shared], column] = 1
                yes = (held @ held.T) == 0
        if self.across:
            chunk = np.asarray(self.chunk)
            yes &= chunk[:, None] != chunk[None, :]
        return yes

    def links(self, threshold: float) -> np.ndarray:
        """[n, n] whether two members are linked here."""
        n = len(self.node)
        linked = np.zeros((n, n), bool)
        i, j = np.nonzero(np.triu(self.eligible(), 1))
        if not len(i):
            return linked
        signatures = np.stack([signature_of(s) for s in self.sets])
        size = np.asarray([len(s) for s in self.sets])
        for at in range(0, len(i), PAIR_BLOCK):
            a, b = i[at: at + PAIR_BLOCK], j[at: at + PAIR_BLOCK]
            alive = survivors(signatures, a, b, threshold)
            a, b = a[alive], b[alive]
            if len(a):
                common = common_sizes(self.sets, a, b)
                yes = common >= threshold * (size[a] + size[b] - common) - 1e-9
                linked[a[yes], b[yes]] = True
        return linked | linked.T

    def rows(self, threshold: float) -> list[tuple]:
        """(node, links weighted by copies, links between classes, smallest node reached) of linked members."""
        if len(self.node) < 2:
            return []
        linked = self.links(threshold)
        some = np.flatnonzero(linked.any(1))
        if not len(some):
            return []
        linked = linked[np.ix_(some, some)]
        node = [self.node[k] for k in some]
        weight = np.asarray([self.weight[k] for k in some], np.int64)
        by_node = np.argsort(np.argsort(np.asarray(node, object)))
        reached = by_node.copy()
        while True:
            lower = np.minimum(reached, np.where(linked, reached[None, :], len(node)).min(1))
            if (lower == reached).all():
                break
            reached = lower
        name = sorted(node)
        return [(node[k], int(weight[linked[k]].sum()), int(linked[k].sum()), name[reached[k]])
                for k in range(len(node))]


def sketched(docs: DataFrame, keys: bool = True) -> DataFrame:
    """doc_id, node (128 bits that stand for the shingle set, null without words) and its band keys."""
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("node", T.BinaryType()),
              T.StructField("keys", T.ArrayType(T.LongType()))]

    def sketch(batches):
        for batch in batches:
            node, bands = [], []
            for text in batch.column(1).to_pylist():
                shingles = shingles_of(text or "")
                node.append(digest_of(shingles) if len(shingles) else None)
                bands.append(band_keys(signature_of(shingles)) if keys and len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=[f.name for f in fields])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(sketch, T.StructType(fields))


def _compared(cells: DataFrame, threshold: float) -> DataFrame:
    """Runs the cells; rows come sorted by cell, of which one at a time is in memory."""

    def run(batches):
        at, cell = None, None

        def result(rows):
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                              names=["node", "links", "class_links", "reached"])

        for batch in batches:
            out = []
            for key, a, b, node, chunk, weight, keys, text in zip(
                    *(batch.column(c).to_pylist() for c in range(batch.num_columns))):
                if (key, a, b) != at:
                    if cell is not None:
                        out += cell.rows(threshold)
                    at, cell = (key, a, b), Cell(key, a != b)
                cell.add(node, chunk, weight, keys, text)
            yield result(out)
        if cell is not None:
            yield result(cell.rows(threshold))

    ordered = cells.select("key", "a", "b", "node", "chunk", "n_docs", "buckets", "text")
    ordered = ordered.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "node")
    return ordered.mapInArrow(run, "node binary, links long, class_links long, reached binary")


def linked(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, node, class_id, n_links (documents at or above the threshold, copies included),
    n_class_links (linked classes of other shingle sets), and keeper (the node whose text stands for the group)."""
    docs = docs.select("doc_id", "text")
    sketches = hold(sketched(docs))
    nodes = hold(sketches.where("node IS NOT NULL").groupBy("node", "keys").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n_docs")))

    entries = nodes.select("node", F.explode("keys").alias("key"))
    buckets = entries.groupBy("key").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("sum"), F.min("node").alias("lowest"),
    ).where("members > 1").groupBy("members", "sum", "lowest").agg(F.min("key").alias("key")).select("key", "members")
    met = hold(entries.join(buckets, "key"))
    own = met.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("buckets"))  # at most one per band
    texts = docs.withColumnRenamed("doc_id", "first_id")
    carried = nodes.select("node", "first_id", "n_docs").join(own, "node")
    # an id may stand for several texts: a cell takes the one whose set is the node's
    carried = carried.join(texts, carried["first_id"].eqNullSafe(texts["first_id"])).select(
        "node", "n_docs", "buckets", "text")
    chunks = F.ceil(F.col("members") / CELL_MEMBERS).cast("int")
    dealt = met.join(carried, "node").withColumn("chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64("node", "key"), F.col("chunks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = dealt.withColumn("a", F.least("chunk", "other")).withColumn("b", F.greatest("chunk", "other"))
    found = hold(_compared(cells, threshold))

    sums = found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("class_links").alias("class_links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("reached").alias("b")))
    grouped = nodes.select("node", "first_id", "n_docs").join(sums, "node", "left").join(roots, "node", "left")
    grouped = hold(grouped.withColumn("root", F.coalesce("root", "node")))
    groups = grouped.groupBy("root").agg(
        F.min("first_id").alias("class_id"), F.min(F.struct(F.col("first_id").isNull(), "first_id", "node"))["node"]
        .alias("keeper"))
    classes = grouped.join(groups, "root").select(
        "node", "class_id", "keeper", (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("class_links", F.lit(0)).alias("n_class_links"))
    alone = F.col("node").isNull()
    return sketches.select("doc_id", "node").join(classes, "node", "left").select(
        "doc_id", "node", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_class_links")).cast("long").alias("n_class_links"), "keeper")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group; rows without a word all stay."""
    rows = hold(linked(docs, threshold))
    unique = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id")
    unique = hold(unique)  # ids that do not name one row
    stays = F.col("node").isNull() | (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("keeper")))
    leaves = rows.where(~stays).select("doc_id").union(unique)
    kept = docs.join(hold(leaves.where("doc_id IS NOT NULL").distinct()), "doc_id", "left_anti").where(
        "doc_id IS NOT NULL")
    return kept.select(*every(docs)).unionByName(_by_text(docs, rows.where(stays), unique))


def _by_text(docs: DataFrame, stays: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows to keep among those whose id does not name one row, found by their shingle set."""
    some, node = free_name(docs, "some_id"), free_name(docs, "node")
    rows = docs.join(ids.withColumnRenamed("doc_id", some), F.col("doc_id").eqNullSafe(F.col(some)), "left_semi")

    def digests(texts):
        sets = [shingles_of(t) for t in texts]
        return pa.array([digest_of(s) if len(s) else None for s in sets], pa.binary())

    marked = with_scored_text(rows, node, T.BinaryType(), lambda: digests)
    wordless = marked.where(F.col(node).isNull()).select(*every(docs))
    wanted = stays.where("node IS NOT NULL").select(F.col("node").alias(node)).distinct()
    first = F.min_by(F.struct(*every(docs)), F.struct(F.col("doc_id").isNull(), "doc_id")).alias(node + "_row")
    worded = marked.join(wanted, node, "left_semi").groupBy(node).agg(first).select(node + "_row.*")
    return wordless.unionByName(worded)


@query("op6_jaccard_join", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS node FROM s GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id
  GROUP BY 1, 2),
l AS (
  SELECT a, b, x.node AS node_a, y.node AS node_b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 5 * m >= 4 * (x.n + y.n - m)),
r(doc_id, met) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.met),
k AS (SELECT a AS doc_id, count(*) AS n_links,
  count(DISTINCT CASE WHEN node_a <> node_b THEN node_b END) AS n_class_links FROM l GROUP BY a)
SELECT r.doc_id, min(r.met) AS class_id, coalesce(any_value(n_links), 0)::BIGINT AS n_links,
  coalesce(any_value(n_class_links), 0)::BIGINT AS n_class_links
FROM r LEFT JOIN k USING (doc_id) GROUP BY r.doc_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_class_links")
