"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A vector's code has one bit per component, set where it is above zero. Equal codes are merged first, each with its
smallest ids, of which a search can return no more than k and the query itself. The bits are cut into m segments about
as wide as the logarithm of the number of codes, so a bucket, which is a segment and its value, holds about one code
whatever the size of the table. Round s joins the buckets at s flipped bits from the segments of each open query with
the buckets of the codes, on the bucket: no code is copied more than m times, and queries meet only the codes of their
buckets. A code that an earlier bucket has found is told by its own bits and dropped without a shuffle, as is one
beyond the worst of enough verified neighbours. After round s every code within m (s + 1) - 1 bits has been seen
(pigeonhole); a search ends when enough verified codes lie within that distance.

Where a round would probe more buckets per query than there are codes (and more than ``LEAST_PROBES``), probing costs
more than comparing, and the searches still open are compared with all codes, blocks of queries against shards of codes.
Either way the result is exact. ``searched`` gives the round in which a search ended, or null for a compared one.

Defined cases: null vectors and null ids take no part; empty vectors have empty codes, at distance 0 of each other, and
vectors of different lengths are compared as if the missing components were zero; components that are null or not a
number set no bit; ties go to the smaller id; a query is not its own neighbour; repeated rows with one id count once;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomkit.llm.jobs import query, table
from fathomkit.session import hold

NEIGHBOURS = 10
QUERY_STEP = 50
SHARD_CODES = 16_384
BLOCK_QUERIES = 2_048
LEAST_PROBES = 16_384
COMPARED_AT_ONCE = 64


def longest(vectors: DataFrame) -> int:
    """Components of the longest vector."""
    return vectors.where("id IS NOT NULL AND vector IS NOT NULL").agg(F.max(F.size("vector"))).first()[0] or 0


def coded(vectors: DataFrame, size: int) -> DataFrame:
    """id and code (64 bits a word, as many words as ``size`` components need) of vectors (id, vector)."""
    known = vectors.where("id IS NOT NULL AND vector IS NOT NULL")
    bits = "transform(vector, x -> IF(x > 0 AND NOT isnan(x), 1L, 0L))"
    words = [
        f"shiftleft(aggregate(slice({bits}, {64 * w + 1}, 64), 0L, (a, b) -> shiftleft(a, 1) | b), "
        f"64 - size(slice(vector, {64 * w + 1}, 64)))" for w in range(max(1, -(-size // 64)))
    ]
    return known.select("id", F.expr(f"array({', '.join(words)})").alias("code"))


def segments(size: int, codes: int) -> list[tuple[int, int, int]]:
    """(word, shift, width) of the segments of codes of ``size`` bits, about log2(codes) bits each."""
    wanted, out = max(1, round(math.log2(max(codes, 2)))), []
    for word in range(max(1, -(-size // 64))):
        used = min(64, size - 64 * word)
        parts = max(1, -(-used // wanted))
        edges = [used * i // parts for i in range(parts + 1)]
        out += [(word, 64 - high, high - low) for low, high in zip(edges, edges[1:])]
    return out


def _value(code: str, segment: tuple[int, int, int]) -> str:
    word, shift, width = segment
    moved = f"shiftrightunsigned({code}[{word}], {shift})" if shift < 64 else "0L"
    return f"({moved} & {(1 << width) - 1}L)" if width < 64 else moved


def _buckets(rows: DataFrame, code: str, cut: list[tuple[int, int, int]]) -> DataFrame:
    """``rows`` once per segment of ``code``, with segment, value and width."""
    each = ", ".join(f"struct({j} AS segment, {_value(code, c)} AS value, {c[2]} AS width)" for j, c in enumerate(cut))
    return rows.select("*", F.expr(f"explode(array({each})) AS bucket")).select(*rows.columns, "bucket.*")


def _flipped(buckets: DataFrame, radius: int) -> DataFrame:
    """``buckets`` with every set of ``radius`` bits of value flipped, each set once (its bits in rising order)."""
    keep = [c for c in buckets.columns if c != "value"]
    rows = buckets.withColumn("bit", F.lit(-1))
    for _ in range(radius):
        rows = rows.where("bit + 1 < width").select(*keep, "value", F.expr("explode(sequence(bit + 1, width - 1)) AS bit"))
        rows = rows.withColumn("value", F.expr("value ^ shiftleft(1L, bit)"))
    return rows.drop("bit")


def _nearest_codes(rows: DataFrame, need: int) -> DataFrame:
    """Of each query the ``need`` codes by distance and smallest id; these hold the ``need`` nearest ids."""
    nth = F.row_number().over(Window.partitionBy("query").orderBy("hamming", "first"))
    return rows.withColumn("nth", nth).where(F.col("nth") <= need).drop("nth")


def _probed(waiting: DataFrame, codes: DataFrame, cut: list[tuple[int, int, int]], radius: int) -> DataFrame:
    """query, code, first, many, hamming of the codes that round ``radius`` finds first, within each query's bound."""
    probes = _flipped(_buckets(waiting, "query", cut), radius).drop("width")
    # Spark takes exploded rows to be as few as those before, and would broadcast them
    met = probes.join(_buckets(codes, "code", cut).drop("width").hint("merge"), ["segment", "value"])
    words = 1 + max(c[0] for c in cut)
    hamming = " + ".join(f"bit_count(code[{w}] ^ query[{w}])" for w in range(words))
    near = f"(bound IS NULL OR {hamming} <= bound)"
    # a bucket before this one, of an earlier round or segment, would have held the code
    fresh = [f"bit_count({_value('code', c)} ^ {_value('query', c)}) + IF({j} >= segment, 1, 0) > {radius}"
             for j, c in enumerate(cut)]
    return met.where(" AND ".join([near, *fresh])).select(
        "query", "code", "first", "many", F.expr(f"CAST({hamming} AS BIGINT) AS hamming"))


def _compare_cell(index: pd.DataFrame, wanted: pd.DataFrame, need: int) -> pd.DataFrame:
    """The ``need`` nearest codes of one shard for each query of one block."""
    out = {"query": [], "code": [], "first": [], "many": [], "hamming": []}
    if len(index) and len(wanted):
        codes = np.stack(index["code"].to_list()).astype(np.int64)
        first, many = index["first"].to_numpy(np.int64), index["many"].to_numpy(np.int64)
        asked = np.stack(wanted["query"].to_list()).astype(np.int64)
        for at in range(0, len(asked), COMPARED_AT_ONCE):
            part = asked[at: at + COMPARED_AT_ONCE]
            far = sum(np.bitwise_count((codes[:, w] ^ part[:, w, None]).view(np.uint64)).astype(np.int64)
                      for w in range(codes.shape[1]))
            for q, dist in zip(part, far):
                limit = np.partition(dist, need - 1)[need - 1] if len(dist) > need else len(codes[0]) * 64
                rows = np.flatnonzero(dist <= limit)
                rows = rows[np.lexsort((first[rows], dist[rows]))[:need]]
                out["query"] += [q.tolist()] * len(rows)
                out["code"] += codes[rows].tolist()
                out["first"] += first[rows].tolist()
                out["many"] += many[rows].tolist()
                out["hamming"] += dist[rows].tolist()
    return pd.DataFrame(out)


def _compared(waiting: DataFrame, codes: DataFrame, many_codes: int, need: int) -> DataFrame:
    shards, blocks = many_codes // SHARD_CODES + 1, waiting.count() // BLOCK_QUERIES + 1

    def everywhere(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    index = codes.withColumn("shard", F.pmod(F.xxhash64("code"), F.lit(shards)).cast("int")).withColumn(
        "block", everywhere(blocks))
    wanted = waiting.select("query").withColumn(
        "block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")).withColumn("shard", everywhere(shards))
    return index.groupBy("shard", "block").cogroup(wanted.groupBy("shard", "block")).applyInPandas(
        lambda a, b: _compare_cell(a, b, need),
        "query array<bigint>, code array<bigint>, first bigint, many bigint, hamming bigint")


def searched(codes: DataFrame, asked: DataFrame, size: int, need: int) -> DataFrame:
    """query, code, hamming and round of the codes that hold the ``need`` nearest ids of each distinct query.

    ``codes`` are distinct (code, first, many: its smallest id and how many ids it has), of ``size`` bits.
    """
    total = codes.count()
    cut = segments(size, total)
    waiting = hold(asked.select("query", F.lit(None).cast("bigint").alias("bound")))
    best, ended, last = None, [], max(c[2] for c in cut)
    for radius in range(last + 1):
        if sum(math.comb(c[2], radius) for c in cut) > max(total, LEAST_PROBES):
            ended.append(_nearest_codes(_compared(waiting, codes, total, need), need).withColumn(
                "round", F.lit(None).cast("int")))
            break
        found = _probed(waiting, codes, cut, radius)
        best = hold(_nearest_codes(found if best is None else best.unionByName(found), need))
        covered = size if radius == last else len(cut) * (radius + 1) - 1
        state = best.groupBy("query").agg(
            F.sum(F.when(F.col("hamming") <= covered, F.col("many"))).alias("sure"),
            F.when(F.sum("many") >= need, F.max("hamming")).alias("bound"))
        over = F.lit(radius == last) | (F.coalesce("sure", F.lit(0)) >= need)
        waiting = hold(waiting.select("query").join(state, "query", "left").where(~over).select("query", "bound"))
        ended.append(best.join(waiting, "query", "left_anti").withColumn("round", F.lit(radius)))
        if waiting.isEmpty():
            break
        best = best.join(waiting, "query", "left_semi")
    return functools.reduce(DataFrame.unionByName, ended).select("query", "code", "hamming", "round")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, id, hamming: the ``k`` nearest of ``vectors`` for each of ``queries``, both (id, vector)."""
    need = k + 1  # the query itself may be among them
    both = vectors.unionByName(queries)
    size = longest(both)
    all_codes = hold(coded(both, size).distinct())
    own = all_codes.join(vectors.select("id").distinct(), "id", "left_semi")
    nth = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    codes = hold(own.withColumn("nth", nth).where(F.col("nth") <= need).groupBy("code").agg(
        F.sort_array(F.collect_list("id")).alias("ids")))
    asked = hold(all_codes.join(queries.select("id").distinct(), "id", "left_semi").select(
        F.col("id").alias("query_id"), F.col("code").alias("query")))
    sized = codes.select("code", F.col("ids")[0].cast("bigint").alias("first"),
                         F.size("ids").cast("bigint").alias("many"))
    found = searched(sized, asked.select("query").distinct(), size, need).join(codes, "code")
    pairs = asked.join(found, "query").select("query_id", "hamming", F.explode("ids").alias("id")).where(
        "id <> query_id")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("hamming", "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "hamming")


@query("op8_exact_top_k", f"""
WITH c AS (SELECT vec_id, array_to_string(list_transform(embedding,
    lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN '1' ELSE '0' END), '')::BIT AS code FROM embeddings),
d AS (SELECT q.vec_id AS query_id, c.vec_id AS id, bit_count(xor(q.code, c.code))::BIGINT AS hamming
  FROM c q, c WHERE q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hamming, id)::INT AS rank FROM d)
SELECT query_id, rank, id, hamming FROM r WHERE rank <= {NEIGHBOURS}""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 50 against all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
    return nearest(vectors, vectors.where(F.col("id") % QUERY_STEP == 0))
