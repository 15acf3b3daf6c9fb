import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomkit.llm import hamming
from fathomkit.llm.hamming import coded, longest, nearest, searched, segments


def bits(vector, width):
    return [1 if i < len(vector) and vector[i] is not None and vector[i] > 0 else 0 for i in range(width)]


def by_hand(vectors, queries, k):
    width = max([len(v) for _, v in vectors + queries if v is not None], default=0)
    known = {i: bits(v, width) for i, v in vectors if i is not None and v is not None}
    out = []
    for q, v in {i: v for i, v in queries if i is not None and v is not None}.items():
        code = bits(v, width)
        near = sorted((sum(a != b for a, b in zip(code, c)), i) for i, c in known.items() if i != q)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def test_given_vectors(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    asked = vectors.where("id % 20 = 0")
    rows = [(r.id, list(r.vector)) for r in vectors.collect()]
    want = by_hand(rows, [r for r in rows if r[0] % 20 == 0], 10)
    assert sorted(tuple(r) for r in nearest(vectors, asked).collect()) == want


@pytest.mark.parametrize("width, probes", [(7, 16_384), (64, 16_384), (130, 16_384), (64, 0), (130, 0)])
def test_hard_rows(spark, monkeypatch, width, probes):
    """With no least probes the searches are compared with all codes, in several shards and blocks."""
    monkeypatch.setattr(hamming, "LEAST_PROBES", probes)
    monkeypatch.setattr(hamming, "SHARD_CODES", 40)
    monkeypatch.setattr(hamming, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(hamming, "COMPARED_AT_ONCE", 2)
    rng = np.random.RandomState(width)
    hot = rng.randn(width).tolist()
    rows = [(i, rng.randn(width).tolist()) for i in range(120)] + [(200 + i, hot) for i in range(60)]
    rows += [(300, None), (None, hot), (301, []), (302, [None, 1.0]), (303, [float("nan")] * width), (303, [float("nan")] * width)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, vector array<double>, code string").repartition(3)
    asked = df.where("id % 5 = 0 OR id IS NULL")
    want = by_hand(rows, [r for r in rows if r[0] is None or r[0] % 5 == 0], 6)
    got = sorted(tuple(r) for r in nearest(df.select("id", "vector"), asked.select("id", "vector"), 6).collect())
    assert got == want


def test_fewer_ids_than_neighbours(spark):
    rows = [(1, [1.0, 1.0]), (2, [1.0, -1.0]), (3, []), (50, [-1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    assert sorted(tuple(r) for r in nearest(df, df.where("id = 50")).collect()) == by_hand(rows, rows[3:], 10)


def test_empty(spark):
    none = spark.createDataFrame([], "id long, vector array<float>")
    assert nearest(none, none).collect() == []


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_given_searches_end_by_their_radii(spark, sf):
    vectors = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    size = longest(vectors)
    codes = coded(vectors, size).groupBy("code").agg(F.min("id").alias("first"), F.count("*").alias("many"))
    asked = coded(vectors.where("id % 50 = 0"), size).select(F.col("code").alias("query")).distinct()
    rounds = searched(codes, asked, size, 11).groupBy("query").agg(F.max("round").alias("round")).collect()
    assert len(rounds) == asked.count() and all(r["round"] is not None for r in rounds)


def test_a_code_is_found_once(spark):
    """A query's own code has the same value in every segment, but comes once; so do all others."""
    rng = np.random.RandomState(1)
    words = rng.randint(1 << 62, size=800).tolist()
    words += [w ^ 0b101 for w in words[:50]]
    codes = spark.createDataFrame([([w], i, 1) for i, w in enumerate(words)], "code array<bigint>, first long, many long")
    asked = codes.where("first < 50").select(F.col("code").alias("query"))
    got = {}
    for r in searched(codes, asked, 64, 2).collect():
        got.setdefault(r["query"][0], []).append((r["hamming"], r["code"][0], r["round"]))
    for w in words[:50]:
        assert sorted(x[:2] for x in got[w]) == [(0, w), (2, w ^ 0b101)]
        assert {x[2] for x in got[w]} == {0}  # two bits are covered by the pigeonhole of round 0


@pytest.mark.parametrize("size, codes", [(0, 0), (1, 5), (7, 100), (64, 2_000), (130, 10**9), (512, 10**6)])
def test_segments_cover_every_bit_once(size, codes):
    bits = [64 * w + 63 - b for w, shift, width in segments(size, codes) for b in range(shift, shift + width)]
    assert sorted(bits) == list(range(size))


def test_code_bits(spark):
    df = spark.createDataFrame([(1, [1.0, -1.0, 2.0] + [0.0] * 61 + [3.0])], "id long, vector array<double>")
    code = coded(df, longest(df)).first().code
    assert [c & ((1 << 64) - 1) for c in code] == [0b101 << 61, 1 << 63]
