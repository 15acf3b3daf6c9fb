import random

import pytest
from pyspark.sql import functions as F

from fathomkit.llm.personal import personal_spans
from fathomkit.llm.secrets import secret_spans, without_secrets
from fathomkit.llm.spans import clear_of, found, redacted, running, substrings

SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def one(spark, row, schema, column):
    return spark.createDataFrame([row], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 99, 100, 101, 1000])
def test_running_values(spark, n):
    values = [random.Random(n).randint(0, 50) for _ in range(n)]
    got = one(spark, (values,), "v array<int>", running(F.col("v"), lambda a, b: a + b, F.lit(0)))
    assert got == [sum(values[:i + 1]) for i in range(n)]
    got = one(spark, (values,), "v array<int>", running(F.col("v"), F.greatest, F.lit(0)))
    assert got == [max(values[:i + 1]) for i in range(n)]


def random_spans(rng, size, n):
    out = []
    for k in range(n):
        a = rng.randint(0, size - 1)
        out.append((a, rng.randint(0, 2), rng.choice("abc"), min(size, a + rng.randint(1, 6))))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_clear_and_redacted_against_plain_loops(spark, seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("xyé\U0001f600 ") for _ in range(60))
    spans, others = random_spans(rng, 60, rng.randint(0, 12)), random_spans(rng, 60, rng.randint(0, 6))
    schema = f"t string, a {SPAN}, b {SPAN}"
    got = one(spark, (text, spans, others), schema, clear_of(F.col("a"), F.col("b")))
    want = [s for s in spans if not any(s[0] < o[3] and o[0] < s[3] for o in others)]
    assert sorted(map(tuple, got)) == sorted(want)

    out, at = "", 0
    for a, _, kind, b in sorted(spans):
        if a >= at:
            out += text[at:a] + f"[{kind.upper()}]"
        at = max(at, b)
    assert one(spark, (text, spans, others), schema, redacted(F.col("t"), F.col("a"))) == out + text[at:]


def test_found_places_and_substrings(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("ab1é\U0001f600") for _ in range(3000))
    got = one(spark, (text,), "t string", found(F.col("t"), "[ab]+1?", F.lit(True)))
    import re

    assert [tuple(s) for s in got] == [(m.start(), m.end(), m.group()) for m in re.finditer("[ab]+1?", text)]
    ranges = [(max(0, s.start - 40), s.end + 1 - max(0, s.start - 40)) for s in got]
    cut = one(spark, (text, ranges), "t string, r array<struct<at:int,n:int>>", substrings(F.col("t"), F.col("r")))
    assert cut == [text[a:a + n] for a, n in ranges]
    assert one(spark, (text, []), "t string, r array<struct<at:int,n:int>>", substrings(F.col("t"), F.col("r"))) == []


def test_two_hundred_thousand_matches_in_one_text(spark):
    n = 200_000
    secrets = " ".join(f"token=abc{i:09x} ok" for i in range(n))
    mails = " ".join(f"mail user{i}@example{i % 7}.com ok" for i in range(n))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, secrets, "en", "a", 1)], schema)
    assert secret_spans(docs).select(F.size("base")).first()[0] == n
    assert without_secrets(docs).first()["text"] == " ".join(["[ASSIGN] ok"] * n)
    docs = spark.createDataFrame([(1, mails, "en", "a", 1)], schema)
    base = personal_spans(docs).first()["base"]
    assert len(base) == n and all(mails[s.start:s.end].startswith("user") for s in base[::1000])
