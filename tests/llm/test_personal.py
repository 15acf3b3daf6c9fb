import re

from pyspark.sql import functions as F

from fathomkit.llm.personal import loose_spans, personal_spans, reliabilities
from fathomkit.llm.spans import digest


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    total = 0
    for i, c in enumerate(reversed(digits(text))):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 12 <= len(digits(t)) <= 19 and luhn(t)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15),
)


def by_hand(text):
    spans = [(m.start(), i, kind, m.end()) for i, (kind, pattern, ok) in enumerate(PATTERNS)
             for m in re.finditer(pattern, text) if ok(m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))


HARD = [
    "a@b.com_x@d.org a@b.com.@x.y a@b a@-.- ..@a.b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.01 1.2.3 1.2.3.4444",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111110 4111  1111", "+1 (988) 555-2485 +12 +1234567890123456 +1---9",
    "x" * 20_000 + "@y.z", "1" * 20_000, "1 " * 9_000, "1.1." * 5_000, "é@b.co \U0001f600+49 30 1234567", "",
]


def test_base_spans_by_hand(spark, docs, odd):
    hard = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    for df in (docs, hard, odd):
        got = sorted((str(r.doc_id), r.s) for r in personal_spans(df).select(
            "doc_id", digest(F.col("base")).alias("s")).collect())
        assert got == sorted((str(r.doc_id), by_hand(r.text or "")) for r in df.select("doc_id", "text").collect())


def test_votes_accept_what_their_context_supports(spark):
    good = [f"please call phone (21{i % 10}) 555-01{i:02d} soon" for i in range(40)]
    base = [f"write mail to user{i}@mail.example.com now" for i in range(40)]
    bad = [f"see order no 21{i % 10}-555-01{i:02d}x and 000-000-0000" for i in range(40)]
    names = [f"said Dr. Anna Miller{chr(97 + i % 26)} today" for i in range(10)]
    rows = list(enumerate(good + base + bad + names))
    got = {r.doc_id: [s.kind for s in r.spans] for r in personal_spans(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] == ["local_phone"] for i in range(40)) >= 36
    assert all(got[40 + i] == ["email"] for i in range(40))
    assert not any("local_phone" in got[80 + i] for i in range(40))


def test_spelled_out_addresses_in_any_bracket(spark):
    texts = ["write john [at] example.com now", "write john (at) example.com now", "write john[ AT ]example.com now", "no [atom]"]
    address = dict(loose_spans(F.col("text")))["address"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").orderBy("doc_id")
    got = [[s.hit for s in r.s] for r in rows.select(address.alias("s")).collect()]
    assert got == [["john [at] example.com"], ["john (at) example.com"], ["john[ AT ]example.com"], []]


def test_reliable_labelers_get_weight(spark):
    rows = [(["a=+", "b=+"], 90), (["a=-", "b=-"], 90), (["a=+", "b=-"], 10), (["a=-", "b=+"], 10),
            (["a=+", "b=+", "c=+"], 30), (["a=-", "b=-", "c=+"], 30)]
    weights, _ = reliabilities(spark.createDataFrame(rows, "votes array<string>, n long"))
    assert weights["a=+"] > 0.5 > -0.5 > weights["a=-"] and abs(weights["c=+"]) < 0.5


def test_empty_table_and_no_candidates(spark, empty):
    assert personal_spans(empty).collect() == []
    plain = spark.createDataFrame([(1, "nothing here")], "doc_id long, text string")
    assert personal_spans(plain).first().spans == []
