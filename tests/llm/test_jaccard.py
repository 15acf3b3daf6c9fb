import itertools
import random

import numpy as np
import pytest

from fathomkit.llm import jaccard
from fathomkit.llm.jaccard import least_matches, linked, one_of_each
from fathomkit.llm.shingles import digest_of, shingles_of
from fathomkit.operators.components import components


def sets_of(rows):
    return [(i, frozenset(tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))) if (w := (t or "").split()) else None)
            for i, t in rows]


def by_hand(rows, threshold=0.8):
    """Per row (id, class_id, links, class links) by comparing all pairs."""
    sets = sets_of(rows)
    group = list(range(len(sets)))
    links, classes = [0] * len(sets), [set() for _ in sets]
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x is None or y is None or len(x & y) < threshold * len(x | y) - 1e-9:
            continue
        links[a] += 1
        links[b] += 1
        if x != y:
            classes[a].add(y)
            classes[b].add(x)
        old, new = group[b], group[a]
        group = [new if g == old else g for g in group]
    least = {g: min((sets[i][0] for i in range(len(sets)) if group[i] == g and sets[i][0] is not None), default=None)
             for g in set(group)}
    return [(sets[i][0], least[group[i]], links[i], len(classes[i])) for i in range(len(sets))], len(set(group))


def result(df, **more):
    return sorted((tuple(map(str, (r.doc_id, r.class_id, r.n_links, r.n_class_links)))
                   for r in linked(df, **more).collect()))


def family(rng, n, words=120, edits=3):
    """``n`` texts that each change a few words of one."""
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"v{rng.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def families(spark):
    rng = random.Random(4)
    common = " ".join(f"license{k}" for k in range(60))
    texts = family(rng, 60) + family(rng, 12, words=40, edits=1) + family(rng, 3, words=9, edits=0)
    texts += [common + " " + " ".join(f"u{rng.randrange(10_000)}" for _ in range(40)) for _ in range(40)]
    rows = list(enumerate(texts))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_links_and_classes_by_hand(families):
    rows, df = families
    want, groups = by_hand(rows)
    assert result(df) == sorted(tuple(map(str, r)) for r in want)
    assert one_of_each(df).count() == groups


def test_buckets_dealt_into_chunks_give_the_same(families, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL_MEMBERS", 7)
    monkeypatch.setattr(jaccard, "PAIR_BLOCK", 100)
    rows, df = families
    assert result(df) == sorted(tuple(map(str, r)) for r in by_hand(rows)[0])


def test_given_documents(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want, groups = by_hand(rows)
    assert result(docs) == sorted(tuple(map(str, r)) for r in want)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == groups
    assert {r.doc_id for r in kept.collect()} == {r[1] for r in want}


def test_odd_rows(odd, empty):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    want, groups = by_hand(rows)
    assert result(odd) == sorted(tuple(map(str, r)) for r in want)
    kept = one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == groups
    assert kept.exceptAll(odd).count() == 0
    assert linked(empty).collect() == [] and one_of_each(empty).collect() == []


def test_an_id_of_two_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(1, a), (1, b), (2, a), (2, b), (3, b), (None, a)], "doc_id long, text string")
    kept = one_of_each(df).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, a), (1, b)]


def test_posterior_bounds():
    from math import comb

    for n, least in least_matches(0.8).items():
        tail = [sum(comb(n + 1, k) * 0.8 ** k * 0.2 ** (n + 1 - k) for k in range(m + 1)) for m in (least - 1, least)]
        grid = (np.arange(200_000) + 0.5) / 200_000
        density = grid ** least * (1 - grid) ** (n - least)
        assert density[grid >= 0.8].sum() / density.sum() == pytest.approx(tail[1], rel=1e-2)
        assert tail[0] < jaccard.TOLERANCE <= tail[1]


def test_components(spark):
    edges = [(bytes([a]), bytes([b])) for a, b in
             [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (20, 21), (21, 22), (22, 20), *((30, k) for k in range(31, 60))]]
    got = {r.node[0]: r.root[0] for r in components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert got == {5: 1, 4: 1, 3: 1, 2: 1, 9: 8, 21: 20, 22: 20, **{k: 30 for k in range(31, 60)}}


def test_shingles_are_words():
    assert digest_of(shingles_of("a b  c\td e\nf")) == digest_of(shingles_of(" a b c d e f "))
    assert len(shingles_of("a b c")) == 1 and len(shingles_of("a b c d e f g")) == 3 and len(shingles_of(" \n")) == 0
    assert len(shingles_of("a b c d")) == 1 and digest_of(shingles_of("a b")) != digest_of(shingles_of("a b b"))
