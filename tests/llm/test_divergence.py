import random
import re
from collections import Counter, defaultdict

import pytest

from fathomkit.llm import divergence as d

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def reference(rows, least_docs, top):
    """Row by row from the definition; rows: (lang, source, text)."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        terms = TERM.findall("".join(x.lower() if x.isascii() else x for x in text))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
        groups.add((lang, source))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        v, sources = len(kept), sorted(s for a, s in groups if a == lang)

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counter[t] + 5) // (total + 5 * v) for t in kept}

        q = shares(sum((count[lang, s] for s in sources), Counter()))
        p = {s: shares(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            more = [(p[s][t] - q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", more, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items[:most])]
    return sorted(out)


def check(df, rows, least_docs, top, digest=d.default_digest):
    got = sorted(tuple(r) for r in d.divergence(df, least_docs, top, digest).collect())
    assert got == reference(rows, least_docs, top)
    return got


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "aébz😀Z" for b in ("x", "Yy", "ß", "q", "Éa", "kk")]
    rows = []
    for i in range(400):
        lang = rng.choice(("en", "en", "en", "de", None))
        source = rng.choice(("web", "web", "web", "a", "b", "ünï", None, "never"))
        text = "12 \x7f-".join(rng.choices(words[rng.randint(0, 8):], k=rng.randint(0, 12)))
        rows.append((lang, source, None if source == "never" else text))
    return rows


def test_from_the_definition(spark, mixed):
    df = spark.createDataFrame(mixed, "lang string, source string, text string").repartition(5)
    for least_docs, top in ((30, 50), (1, 3), (10, 1), (10_000, 50)):
        check(df, mixed, least_docs, top)


def test_digests_that_collide_are_split(spark, mixed):
    df = spark.createDataFrame(mixed, "lang string, source string, text string").repartition(3)
    for digest in (lambda t: d.default_digest(t) & 7, lambda t: 0, len, lambda t: d.default_digest(t) >> 58 << 58):
        check(df, mixed, 12, 4, digest)


def test_small_blocks_and_early_flushes(spark, mixed, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_ENTRIES", 10)
    monkeypatch.setattr(d, "SLAB_TERMS", 2)
    df = spark.createDataFrame(mixed, "lang string, source string, text string")
    for rows, terms in ((7, 1000), (1000, 5), (60, 1000)):
        monkeypatch.setattr(d, "HELD_ROWS", rows)
        monkeypatch.setattr(d, "HELD_TERMS", terms)
        check(df, mixed, 5, 50)


def test_odd_rows(odd, empty):
    rows = [tuple(r) for r in odd.select("lang", "source", "text").collect()]
    assert check(odd, rows, 1, 50)
    check(odd, rows, 30, 50)
    assert d.divergence(empty).collect() == []


def test_shares_are_exact_for_large_counts(spark):
    n, total, terms = 9_000_000_000_000_000, 9_100_000_000_000_007, 12_345_678
    row = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    assert row.select(d._share("n", "total")).first()[0] == 1 + 10 ** 9 * (n + 5) // (total + 5 * terms)


def test_texts_are_not_shuffled_for_counts(spark, mixed):
    df = spark.createDataFrame(mixed, "lang string, source string, text string")
    from fathomkit.session import hold
    from pyspark.sql import functions as F

    rows = hold(d.task_counts(df))
    plan = d._kept(rows.withColumn("part", F.lit(0)), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "term" not in plan
    assert rows.where("lang IS NOT NULL AND term IS NOT NULL").isEmpty()
