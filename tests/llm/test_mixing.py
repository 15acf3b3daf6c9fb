import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fathomkit.llm.mixing import BLOCKS, apply_mixture, block_table, exponent, mixture, source_plan


@pytest.fixture(scope="module")
def shares(spark):
    rows = [(f"s{i}", math.log(p)) for i, p in enumerate((0.5, 0.3, 0.15, 0.05))]
    return spark.createDataFrame(rows, "mix_source string, ln_share double")


def weights(a):
    raw = [p ** a for p in (0.5, 0.3, 0.15, 0.05)]
    return [x / sum(raw) for x in raw]


def test_exponent_meets_a_repetition_limit(shares):
    a = exponent(shares, "repeats", 2.0)
    passes = [w / p for w, p in zip(weights(a), (0.5, 0.3, 0.15, 0.05))]
    assert max(passes) / min(passes) == pytest.approx(2.0, abs=1e-6)
    assert exponent(shares, "repeats", 1e9) < 1e-8 and exponent(shares, "repeats", 0.5) == pytest.approx(1)


def test_exponent_meets_an_entropy(shares):
    a = exponent(shares, "entropy", 1.25)
    assert -sum(w * math.log(w) for w in weights(a)) == pytest.approx(1.25, abs=1e-6)


def test_realised_budgets(docs):
    blocks = block_table(docs)
    largest = max(r.tokens for r in blocks.collect())
    plan = {r.mix_source: r for r in source_plan(blocks, "repeats", 1.5).collect()}
    got = Counter()
    for r in mixture(docs, "repeats", 1.5).collect():
        got[r.mix_source] += r.copies * r.tokens
        assert r.copies in (1, 2)
    for source, r in plan.items():
        assert 0 <= r.passes * r.tokens - got[source] <= largest + 1
        assert 1 <= r.passes <= 1.5 + 1e-6
    assert sum(r.weight for r in plan.values()) == pytest.approx(1)
    few = mixture(docs, "repeats", 1.5, budget=1000)
    assert sum(r.copies * r.tokens for r in few.collect()) <= 1000


def test_rows_come_out_as_often_as_planned(odd, docs):
    for df in (odd, docs):
        plan = mixture(df)
        out = apply_mixture(df, plan)
        assert out.columns == df.columns
        want = plan.agg(F.sum(F.col("copies") * F.col("n_docs"))).first()[0]
        assert out.count() == want >= df.count()
        assert out.exceptAll(df).exceptAll(df).count() == 0 and df.exceptAll(out).count() == 0
        assert plan.where(f"mix_block < 0 OR mix_block >= {BLOCKS}").count() == 0


def test_no_tokens_and_no_rows(odd, empty):
    assert apply_mixture(empty, mixture(empty)).count() == 0
    blank = odd.where("text IS NULL")
    assert apply_mixture(blank, mixture(blank)).count() == blank.count()
