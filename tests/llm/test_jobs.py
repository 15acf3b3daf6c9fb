from pyspark.sql import functions as F

from fathomkit.llm import language, toxicity
from fathomkit.llm.jobs import sampled_texts


def hot(spark, many=300):
    rows = [(7, f"text number {i} of an id on many rows", "en") for i in range(many)]
    rows += [(i, f"text of {i}", "de") for i in range(20, 40)] + [(50, None, "en"), (51, "x" * 2_000, "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)


def test_one_text_of_each_id(spark):
    docs = hot(spark)
    ids = docs.select("doc_id").distinct()
    got = sampled_texts(docs, ids, 50_000).collect()
    assert sorted(r.doc_id for r in got) == [7, *range(20, 40), 50]  # a text beyond a fiftieth takes no part
    assert sampled_texts(docs.repartition(2), ids, 50_000).where("doc_id = 7").first().text == next(
        r.text for r in got if r.doc_id == 7)


def test_characters_are_bounded(spark):
    docs = hot(spark)
    got = sampled_texts(docs, docs.select("doc_id").distinct(), 2_000).select(F.sum(F.length("text"))).first()[0]
    small = sampled_texts(docs, docs.select("doc_id").distinct(), 500).collect()
    assert 0 < got <= 2_000 and sum(len(r.text or "") for r in small) <= 500


def test_learning_with_an_id_on_many_rows(spark):
    docs = hot(spark)
    assert language.learn(docs).langs == ["de", "en"]
    marks = spark.createDataFrame([(7, 1), (7, 0), (7, None), *((i, 0) for i in range(20, 40))], "doc_id long, toxic int")
    scores = toxicity.scored(docs, toxicity.learn(docs, marks)).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
