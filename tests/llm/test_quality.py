import re
from collections import Counter

import numpy as np

from fathomkit.llm.quality import COUNTS, DEPTH, boost, document_counts, quality_rules, repeated_words


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i: i + 5]) for i in range(len(words) - 4))
    inside = {i + j for i in range(len(words) - 4) if seen[tuple(words[i: i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(inside))


def test_counts_by_hand(docs, odd):
    for df in (docs, odd):
        rows = df.select("doc_id", "text").collect()
        want = Counter((r.doc_id, *by_hand(r.text or "")) for r in rows)
        assert Counter(tuple(r) for r in document_counts(df).select("doc_id", *COUNTS).collect()) == want


def test_repeats_of_overlapping_windows():
    for text in ("a a a a a a a", "a b c d e a b c d e", "a b c d a b c d", "a b c d e f a b c d e g"):
        words = text.split()
        assert repeated_words([w.encode() for w in words]) == by_hand(text)[4]


def test_good_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules(docs, labels).join(labels, "doc_id").where("quality IS NOT NULL AND NOT base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_base_rule_decides_and_models_may_be_missing(odd, labels, empty):
    for r in quality_rules(odd, labels.where("false")).collect():
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed) and r.score is None
    assert quality_rules(empty, labels).collect() == []


def test_trees_follow_the_constraints():
    rng = np.random.RandomState(0)
    x = rng.rand(3000, 3)
    y = ((np.sin(9 * x[:, 0]) + 0.3 * rng.randn(3000) - x[:, 1]) > 0).astype(float)
    trees = boost(x, y, np.asarray([-1, -1, 0]))
    base = rng.rand(200, 3)
    for f in (0, 1):
        grid = np.repeat(base, 50, axis=0)
        grid[:, f] = np.tile(np.linspace(0, 1, 50), 200)
        assert (np.diff(trees.score(grid).reshape(200, 50), axis=1) <= 1e-12).all()
    free = boost(x, y, np.zeros(3))
    p = free.score(x)
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.85

    def descend(row):
        total = trees.base
        for at in trees.roots:
            for _ in range(DEPTH):
                at = trees.left[at] if row[trees.feature[at]] <= trees.limit[at] else trees.right[at]
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([descend(r) for r in base], trees.score(base))
