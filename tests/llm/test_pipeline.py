import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from fathomkit.llm.secrets import secret_spans
from fathomkit.session import hold


@pytest.fixture(scope="module")
def stages(spark, sf, docs):
    out, now = [("documents", docs)], docs
    for name, stage in corpus_pipeline.STAGES:
        now = hold(stage(spark, now, sf))
        out.append((name, now))
    return out


def test_stages_keep_the_columns_and_take_effect(stages, docs):
    frames = dict(stages)
    assert [n for n, _ in stages[1:]] == [n for n, _ in corpus_pipeline.STAGES]
    for name, df in stages[:-1]:
        assert df.schema.simpleString() == docs.schema.simpleString(), name
    rows = {n: df.count() for n, df in stages}
    assert rows["toxicity"] < rows["documents"] and rows["ngram_jaccard_join"] < rows["toxicity"]
    assert rows["secret_scans"] == rows["ngram_jaccard_join"] <= rows["source_mixing"]
    assert secret_spans(frames["secret_scans"]).where("size(base) > 0").count() == 0
    ids = lambda n: {r.doc_id for r in frames[n].collect()}
    assert ids("source_mixing") == ids("secret_scans") == ids("best_fit_packing")


def test_each_stage_by_hand(stages):
    from tests.llm.test_jaccard import by_hand

    frames = dict(stages)
    rows = [tuple(r) for r in frames["toxicity"].select("doc_id", "text").collect()]
    want, groups = by_hand(rows)
    assert sorted(r.doc_id for r in frames["ngram_jaccard_join"].collect()) == sorted({r[1] for r in want})
    pieces = frames["best_fit_packing"].collect()
    assert sum(r.piece == 0 for r in pieces) == frames["source_mixing"].count()


def test_run_gives_the_rows_of_the_last_stage(spark, sf, stages):
    got = corpus_pipeline.run(spark, sf)
    assert got.count() == stages[-1][1].count() and got.columns == stages[-1][1].columns


def test_every_operator_has_a_query():
    names = queries()
    assert "pipeline" in names and names["pipeline"] is corpus_pipeline.run
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert {"op3_temperature_mixing", "op6_jaccard_join", "op7_warc_normaliser", "op8_exact_top_k"} <= set(oracle_sql())
