import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomkit.llm.language import _ODD, ORDER, Model, held_out, identify, learn, letters_of, sequences


def plain_model(texts):
    """Interpolated Kneser-Ney probabilities of one language from the formulas, by dictionaries."""
    from collections import Counter

    counts = {ORDER: Counter()}
    for t in texts:
        counts[ORDER].update(sequences(letters_of(t)).tolist())
    for n in range(ORDER, 1, -1):
        counts[n - 1] = Counter(g & ((1 << 16 * (n - 1)) - 1) for g in counts[n])
    cut = {}
    for n, k in counts.items():
        ones, twos = sum(c == 1 for c in k.values()), sum(c == 2 for c in k.values())
        cut[n] = (ones + 0.5) / (ones + 2 * twos + 1) if ones else 0.5

    def p(n, g):
        if n == 0:
            return 1 / (len(counts[1]) + 1)
        context = g >> 16
        same = [c for x, c in counts[n].items() if x >> 16 == context] if n > 1 else list(counts[1].values())
        lower = p(n - 1, g & ((1 << 16 * (n - 1)) - 1) if n > 1 else 0)
        if not same:
            return lower
        return max(counts[n][g] - cut[n], 0) / sum(same) + cut[n] * len(same) / sum(same) * lower

    return p


def test_probabilities_follow_the_formulas(spark):
    texts = ["the cat sat on the mat", "the bat and the hat", "a cat and a bat"]
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    model, p = learn(docs), plain_model(texts)
    for text in ["the cat", "xyz", "a mat and the zebra", "té"]:
        grams = sequences(letters_of(text))
        want = [p(ORDER, int(g)) for g in grams]
        assert model.chances(ORDER, grams)[:, 0] == pytest.approx(want, rel=1e-5)
        assert model.entropies([text])[0, 0] == pytest.approx(-np.log(want).mean(), rel=1e-5)


def test_chances_sum_to_one(docs):
    model = learn(docs)
    letters = (model.keys[1] * np.uint64(pow(int(_ODD), -1, 1 << 64))).astype(np.uint64)
    for context in (0x0020_0020_0074, 0x0020_0071_0078, 0x00FF_00FF_00FF):
        total = model.chances(ORDER, np.uint64(context << 16) | letters).sum(0) + model.unseen * 1
        assert total == pytest.approx(np.ones(len(model.langs)), abs=2e-3)


def test_every_sequence_is_kept(spark):
    rng = np.random.default_rng(4)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9F00, 45_000))) for _ in range(10)]
    model = learn(spark.createDataFrame([(i, "zh", t) for i, t in enumerate(texts)],
                                        "doc_id long, lang string, text string"))
    grams = np.unique(np.concatenate([sequences(letters_of(t)) for t in texts]))
    assert len(grams) > 400_000 and len(model.keys[ORDER]) == len(grams)
    assert model._find(model.keys[ORDER], grams)[1].all()


def test_held_out_accuracy(docs):
    model = learn(docs.where(~held_out()))
    rows = identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out()).collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, docs, empty):
    model = learn(docs)
    got = identify(odd, model).collect()
    assert len(got) == odd.count()
    none = {r.doc_id for r in got if r.lang_pred == "und"}
    assert none == {1, 2, 3, None} and all(r.score == 0 and r.rejected for r in got if r.lang_pred == "und")
    assert identify(empty, model).collect() == []


def test_nothing_learnt(odd, docs):
    for model in (learn(docs.where("false")), learn(docs.withColumn("lang", F.lit(None).cast("string")))):
        assert {r.lang_pred for r in identify(odd, model).collect()} == {"und"}
    assert isinstance(learn(docs.where("lang = 'en'")), Model)


def test_letters():
    assert letters_of("Ab, c1D").tolist() == [32, 97, 98, 32, 99, 32, 100, 32]
    assert letters_of("12 !").tolist() == [] and len(sequences(letters_of("ab"))) == 3


def test_calibrated_on_every_row(spark):
    """Longer texts, more rows and repeated ids than a sample would hold all move the limit and the curve."""
    rows = [(i % 50, "en" if i % 2 else "fr", ("the cat sat on mat " if i % 2 else "le chat est la sur ") * (1 + i % 3))
            for i in range(3_000)]
    rows += [(9_000 + i, "en", "zq xj kv wq " * 4) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = learn(frame)
    e = model.entropies([r[2] for r in rows])
    best, of = np.asarray(model.langs)[e.argmin(1)], np.asarray([r[1] for r in rows])
    for k, lang in enumerate(model.langs):
        own = e[(best == lang) & (of == lang), k]
        assert np.isclose(model.most[k], np.quantile(own, 0.995) + 1e-9)
    x = np.column_stack([np.abs(e[:, 0] - e[:, 1]), np.ones(len(e))])
    w = np.array([model.slope, model.offset])
    slope = x.T @ (np.where(best == of, 0.99, 0.01) - 1 / (1 + np.exp(-x @ w))) - 1e-4 * w
    assert np.abs(slope).max() < 1e-5
