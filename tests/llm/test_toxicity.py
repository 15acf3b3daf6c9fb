import numpy as np
import pytest

from fathomkit.llm import toxicity
from fathomkit.llm.toxicity import (
    STRIDE, WINDOW, Network, Scorer, _backward, _index, learn, scored, train, triples_of, windows_of, without_toxic, words_of,
)

PLAIN = "the and of that with from this have been were they would could there about which other".split()


def corpus(rng, n, toxic):
    out = []
    for _ in range(n):
        words = [PLAIN[rng.randint(len(PLAIN))] + "aeiou"[rng.randint(5)] for _ in range(rng.randint(3, 150))]
        if toxic:
            for _ in range(3):
                words.insert(rng.randint(len(words) + 1), "grobnik" + ["", "er", "ish", "ly"][rng.randint(4)])
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def net():
    rng = np.random.RandomState(2)
    texts = corpus(rng, 150, False) + corpus(rng, 60, True)
    return train(texts, np.asarray([0] * 150 + [1] * 60), 0.1)


def test_unseen_forms_and_long_texts(net):
    rng, s = np.random.RandomState(7), Scorer(net)
    clean, bad = s.scores(corpus(rng, 100, False)), s.scores(corpus(rng, 100, True))
    assert (clean < 0.7).mean() > 0.95 and (bad >= 0.7).mean() > 0.9
    long = " ".join(corpus(rng, 150, False))
    words = long.split()
    for at in (0, len(words) // 2, len(words)):
        text = " ".join([*words[:at], "grobniked", "grobnikish", "grobnik", *words[at:]])
        assert s.scores([text])[0] >= 0.7 > s.scores([long])[0]


def test_windows_cover_every_word():
    sizes = [0, 1, WINDOW, WINDOW + 1, 5 * WINDOW + 3, 2]
    doc, start, length = windows_of(np.asarray(sizes))
    for k, n in enumerate(sizes):
        own = doc == k
        assert {w for s, m in zip(start[own], length[own]) for w in range(s, s + m)} == set(range(n))
        assert own.sum() == max(1, -(-max(n - WINDOW, 0) // STRIDE) + 1) and (length[own] <= WINDOW).all()


def test_gradients_by_differences():
    net = Network(3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.RandomState(0)
    x = rng.randn(9, 20)
    ids = rng.randint(0, 9, 12)
    index, mask = _index(ids, np.asarray([0, 4, 9]), np.asarray([7, 8, 3]), 9)
    y, weight = np.asarray([1.0, 0.0, 1.0]), np.asarray([1.0, 2.0, 1.0])

    def loss(values):
        gates = np.concatenate([values @ net.w[f"in_{w}"] + net.w[f"bias_{w}"] for w in "fb"], axis=1)
        logit = net.logits(np.vstack([gates, np.zeros((1, gates.shape[1]))]), index, mask)
        return float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / 3)

    grad, d_x = _backward(net, x, index, mask, y, weight)
    for name in ("out", "attend", "attend_out", "attend_bias", "state_f", "state_b", "in_f", "bias_b", "out_bias"):
        at = tuple(rng.randint(0, n) for n in net.w[name].shape)
        old, h = net.w[name][at], 1e-2
        net.w[name][at] = old + h
        up = loss(x)
        net.w[name][at] = old - h
        down = loss(x)
        net.w[name][at] = old
        assert grad[name][at] == pytest.approx((up - down) / 2 / h, rel=0.05, abs=2e-4)
    step = np.zeros_like(x)
    step[ids[2], 3] = 1e-2
    assert d_x[ids[2], 3] == pytest.approx((loss(x + step) - loss(x - step)) / 2e-2, rel=0.05, abs=2e-4)


def test_triples_stay_inside_words():
    cells, starts = triples_of(["ab", "c", "ab"])
    assert starts.tolist() == [0, 2, 3] and len(cells) == 5
    assert cells[:2].tolist() == cells[3:].tolist() == triples_of(["ab"])[0].tolist()
    assert words_of("It's A1b, é!") == ["it", "s", "a", "b", "é"]


def test_scores_do_not_depend_on_the_batch(net):
    texts = corpus(np.random.RandomState(5), 20, True) + ["", "12"]
    alone = [Scorer(net).scores([t])[0] for t in texts]
    assert np.allclose(Scorer(net).scores(texts), alone, atol=1e-5)


def test_rows_and_columns(odd, empty, docs, labels, net):
    got = scored(odd, net).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    kept = without_toxic(odd, labels.where("false"))
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert scored(empty, net).collect() == []
    assert learn(docs, labels.where("toxic = 1")) == 1.0 and learn(empty, labels) == 0.0
    assert without_toxic(odd, labels).columns == odd.columns


def test_held_out_documents_of_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in without_toxic(docs, labels).collect()}
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    clean = [i in kept for i, t in marks.items() if t == 0]
    toxic = [i in kept for i, t in marks.items() if t == 1]
    assert np.mean(clean) > 0.97 and np.mean(toxic) < 0.5
