"""Source divergence audit with late strings.

Each task counts the terms of its documents per (lang, source) and gives, held once, one row per (lang, source, term) with
the 64-bit digest of the term in its place, and one row with the digest and the text of each term it has met. What is
shuffled for the counts are the digests, never the texts. Only digests in enough documents of a language are kept. For
these the smallest and the largest text of each digest are taken from the second kind of rows: where they differ, terms
collide, and the digest is split by numbering its terms and counting them anew under (digest, number), from tasks that
give texts along with their counts. Other texts are joined back for the candidates of the top terms alone.

The distance of two sources of a language is the sum of |p - q| over all kept terms. It is summed in numpy over blocks of
terms by sources that Spark deals out by digest; a block holds ``BLOCK_ENTRIES`` counts on average and goes through
dense slabs of ``SLAB_TERMS`` terms, with the sources that lack a term at their share of a count of zero. A task returns
one sum per pair of sources. All shares are whole numbers of billionths and computed exactly.

Defined cases: null text, lang and source are empty texts; a group without terms takes part with counts of zero; a
language without kept terms has distance 0 for its pairs and no top terms; texts of any length are read whole; repeated
rows are documents of their own; ties go to the smaller item in UTF-8 order; other columns, doc_id too, are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomkit.llm.jobs import query, table
from fathomkit.session import hold

LEAST_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PRIOR = 5
HELD_ROWS = 2_000_000
HELD_TERMS = 500_000
BLOCK_ENTRIES = 200_000
SLAB_TERMS = 2_048

# Bytes of terms stay, A-Z in lower case; every other byte becomes a space.
_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def default_digest(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term)


class _Numbers(dict):
    """Terms by the order in which they were asked for."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def _added_up(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (key, n, n_docs), one per key."""
    rows = np.concatenate(parts, 1)
    rows = rows[:, np.argsort(rows[0], kind="stable")]
    starts = np.flatnonzero(np.r_[True, np.diff(rows[0]) != 0])
    return np.stack([rows[0][starts], *(np.add.reduceat(c, starts) for c in rows[1:])])


def task_counts(
    docs: DataFrame, digest: Callable[[bytes], int] = default_digest, with_terms: bool = False,
) -> DataFrame:
    """lang, source, digest, n, n_docs, term, added up inside each task.

    Three kinds of rows: counts, whose term is null unless ``with_terms``; terms without a source; and, without a digest,
    the groups themselves. A task lets go of what it holds at ``HELD_ROWS`` counts or ``HELD_TERMS`` terms.
    """
    names = ["lang", "source", "digest", "n", "n_docs", "term"]

    def batches_of(ids, groups, parts):
        langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
        terms, none = pa.array(list(ids), pa.binary()), pa.nulls(len(groups), pa.binary())
        digests = np.fromiter(map(digest, ids), np.uint64, len(ids)).view(np.int64)
        zeros = [pa.array(np.zeros(len(groups), np.int64))] * 2
        yield [langs, sources, pa.nulls(len(groups), pa.int64()), *zeros, none]
        if parts:
            key, n, n_docs = _added_up(parts)
            of, term = pa.array(key >> 40), key & ((1 << 40) - 1)
            yield [langs.take(of), sources.take(of), pa.array(digests[term]), pa.array(n), pa.array(n_docs),
                   terms.take(pa.array(term)) if with_terms else pa.nulls(len(key), pa.binary())]
        if not with_terms:
            zeros = [pa.array(np.zeros(len(ids), np.int64))] * 2
            yield [pa.nulls(len(ids), pa.string()), pa.nulls(len(ids), pa.string()), pa.array(digests), *zeros, terms]

    def count(batches):
        ids, groups, parts, held = _Numbers(), {}, [], 0
        for batch in batches:
            for *key, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                of = groups.setdefault(tuple(key), len(groups))
                terms = raw.translate(_BYTES).split()
                if not terms:
                    continue
                seen, n = np.unique(
                    np.fromiter(map(ids.__getitem__, terms), np.int64, len(terms)), return_counts=True)
                parts.append(np.stack([of << 40 | seen, n, np.ones_like(n)]))
                held += len(seen)
                if held >= HELD_ROWS:
                    parts = [_added_up(parts)]
                    held = parts[0].shape[1]
                if 2 * held >= HELD_ROWS or len(ids) >= HELD_TERMS:
                    for columns in batches_of(ids, groups, parts):
                        yield pa.RecordBatch.from_arrays(columns, names=names)
                    ids, groups, parts, held = _Numbers(), {}, [], 0
        for columns in batches_of(ids, groups, parts):
            yield pa.RecordBatch.from_arrays(columns, names=names)

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text")]
    return docs.select(*plain[:2], plain[2].cast("binary")).toDF("lang", "source", "text").mapInArrow(
        count, "lang string, source string, digest long, n long, n_docs long, term binary",
    ).withColumn("term", F.col("term").cast("string"))


def _kept(rows: DataFrame, least_docs: int) -> DataFrame:
    """lang, source, digest, part, n, lang_n, one: counts of terms in enough documents of their language; ``one`` is 1 in
    one row of each term and language."""
    whole = Window.partitionBy("lang", "digest", "part")
    return rows.select("lang", "source", "digest", "part", "n", "n_docs").repartition("lang", "digest").groupBy(
        "lang", "source", "digest", "part").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")).select(
        "lang", "source", "digest", "part", "n", F.sum("n").over(whole).alias("lang_n"),
        F.sum("n_docs").over(whole).alias("lang_docs"),
        (F.col("source") == F.min("source").over(whole)).cast("int").alias("one"),
    ).where(F.col("lang_docs") >= least_docs).drop("lang_docs")


def kept_terms(
    docs: DataFrame, rows: DataFrame, least_docs: int = LEAST_DOCS, digest: Callable[[bytes], int] = default_digest,
) -> tuple[DataFrame, DataFrame]:
    """The counts of kept terms, and the term of each (digest, part); ``rows``: held task counts of ``docs``."""
    counted = rows.where("lang IS NOT NULL AND digest IS NOT NULL")
    counts = hold(_kept(counted.withColumn("part", F.lit(0)), least_docs))
    told = rows.where("term IS NOT NULL").select("digest", "term")
    names = hold(told.join(counts.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(
        F.min("term").alias("low"), F.max("term").alias("high")))
    mixed = names.where("low <> high").select("digest")
    single = names.where("low = high").select("digest", F.lit(0).alias("part"), F.col("low").alias("term"))
    if mixed.isEmpty():
        return counts, single
    again = hold(task_counts(docs, digest, with_terms=True).join(mixed, "digest", "left_semi"))
    parts = hold(again.select("digest", "term").distinct().select(
        "digest", F.row_number().over(Window.partitionBy("digest").orderBy("term")).alias("part"), "term"))
    split = _kept(again.join(parts, ["digest", "term"]), least_docs)
    return hold(counts.join(mixed, "digest", "left_anti").unionByName(split)), single.unionByName(parts)


def group_table(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Per occurring (lang, source) its place among the sources of the language, total, kept terms and blocks."""
    sizes = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.sum("one").alias("ones"), F.count("*").alias("entries"))
    of = Window.partitionBy("lang")
    zero = {c: 0 for c in ("total", "ones", "entries")}
    groups = rows.where("digest IS NULL").select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").fillna(zero)
    return hold(groups.select(
        "lang", "source", F.row_number().over(of.orderBy("source")).alias("place"), "total",
        F.sum("total").over(of).alias("lang_total"), F.sum("ones").over(of).alias("terms"),
        F.expr(f"sum(entries) OVER (PARTITION BY lang) div {BLOCK_ENTRIES} + 1").cast("int").alias("blocks")))


def _share(n: str, total: str) -> F.Column:
    """Share of a count in billionths, exact in decimals; null where a language has no kept term."""
    over = f"CAST({total} + {PRIOR} * terms AS DECIMAL(20, 0))"
    return F.expr(f"IF(terms = 0, NULL, 1 + CAST({n} + {PRIOR} AS DECIMAL(20, 0)) * {SCALE} div {over})")


def _block_distances(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over the terms of one block for all pairs of places; ``right`` has the share of a zero count."""
    right = right.sort_values("place")
    none, n = right["none"].fillna(0).to_numpy(np.int64), len(right)
    left = left.sort_values(["digest", "part"])
    key = left[["digest", "part"]].to_numpy(np.int64)
    new = np.r_[True, (key[1:] != key[:-1]).any(1)] if len(key) else np.zeros(0, bool)
    term, place, share = np.cumsum(new) - 1, left["place"].to_numpy(np.int64) - 1, left["p"].to_numpy(np.int64)
    sums = np.zeros((n, n), np.int64)
    for low in range(0, int(new.sum()), SLAB_TERMS):
        a, b = np.searchsorted(term, [low, low + SLAB_TERMS])
        dense = np.repeat(none[:, None], term[b - 1] - low + 1, 1)
        dense[place[a:b], term[a:b] - low] = share[a:b]
        for i in range(n - 1):
            sums[i, i + 1:] += np.abs(dense[i + 1:] - dense[i]).sum(1)
    i, j = np.triu_indices(n, 1)
    return pd.DataFrame({"lang": right["lang"].iloc[0], "i": i + 1, "j": j + 1, "value": sums[i, j]})


def pair_distances(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for each ordered pair of sources of a language."""
    entries = counts.select("lang", "source", "digest", "part", "n").join(groups, ["lang", "source"]).select(
        "lang", F.expr("pmod(xxhash64(digest, part), blocks)").cast("int").alias("block"), "digest", "part", "place",
        _share("n", "total").alias("p"))
    sides = groups.select(
        "lang", F.explode(F.expr("sequence(0, blocks - 1)")), "place", _share("0", "total"),
    ).toDF("lang", "block", "place", "none")
    sums = entries.groupBy("lang", "block").cogroup(sides.groupBy("lang", "block")).applyInPandas(
        _block_distances, "lang string, i int, j int, value long")
    both = sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value")).select("lang", "value", F.explode(F.expr(
        "array(struct(i AS place, j AS other), struct(j AS place, i AS other))")).alias("of")).select(
        "lang", "value", "of.*")
    name = groups.select("lang", "place", "source")
    item = name.select("lang", F.col("place").alias("other"), F.col("source").alias("item"))
    return both.join(name, ["lang", "place"]).join(item, ["lang", "other"]).select("lang", "source", "item", "value")


def top_terms(counts: DataFrame, groups: DataFrame, names: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, item, value, rank of the terms that a group has more of than its language."""
    of = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    shares = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "digest", "part", _share("n", "total").alias("p"), _share("lang_n", "lang_total").alias("q"))
    more = shares.where("p > q").select("lang", "source", "digest", "part", (F.col("p") - F.col("q")).alias("value"))
    # rank keeps every term that shares the value of the last place, as texts decide between these
    likely = more.withColumn("rank", F.rank().over(of)).where(F.col("rank") <= top).drop("rank")
    return likely.join(names, ["digest", "part"]).select(
        "lang", "source", F.col("term").alias("item"), "value",
        F.row_number().over(of.orderBy(F.desc("value"), "term")).alias("rank")).where(F.col("rank") <= top)


def divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS,
    digest: Callable[[bytes], int] = default_digest,
) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources of the language, and top terms.

    ``digest`` gives 64 bits for a term; terms that share them are told apart.
    """
    rows = hold(task_counts(docs, digest))
    counts, names = kept_terms(docs, rows, least_docs, digest)
    groups = group_table(rows, counts)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_distances(counts, groups).withColumn("rank", F.row_number().over(order))
    out = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*out).unionByName(
        top_terms(counts, groups, names, top).withColumn("part", F.lit("term")).select(*out))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
  coalesce(source, '') AS source FROM documents),
o AS (SELECT id, lang, source, unnest(regexp_extract_all(
  translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT l.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN k ON k.lang = l.lang GROUP BY ALL),
t AS (SELECT g.lang, g.source, v.v, coalesce(sum(c.n), 0)::BIGINT AS n FROM g JOIN v ON v.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
gp AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
  (1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {PRIOR})) // (t.n + {PRIOR} * t.v))::BIGINT AS p
  FROM t JOIN k ON k.lang = t.lang
  LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
lt AS (SELECT lang, any_value(v) AS v, sum(n)::BIGINT AS n FROM t GROUP BY lang),
lp AS (SELECT c.lang, c.term, (1 + ({SCALE}::HUGEINT * (sum(c.n) + {PRIOR})) // any_value(lt.n + {PRIOR} * lt.v))::BIGINT AS q
  FROM c JOIN lt ON lt.lang = c.lang GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM t a JOIN t b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.v = 0),
terms AS (SELECT gp.lang, gp.source, 'term' AS part, gp.term AS item, p - q AS value
  FROM gp JOIN lp ON lp.lang = gp.lang AND lp.term = gp.term WHERE gp.n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""


@query("op13_source_divergence", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms each source has more of."""
    return divergence(table(spark, sf_dir, "documents"))
