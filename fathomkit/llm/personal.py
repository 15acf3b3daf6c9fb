"""Personal data by weak supervision.

Fixed patterns give the base spans, which always stay; looser patterns give further candidates (phones without country
code, spelled-out addresses, national numbers, names after a title; a listed given name alone makes no candidate, the
list only votes). Labelers vote on every span, each for, against
or not at all: regular expressions on the span, gazetteers of names and top-level domains, and words in the context
before it. Expectation-maximisation over the distinct vote patterns, which Spark counts over all documents, estimates
how reliable each labeler is on either class; the resulting posteriors are the soft labels of the final classifier,
a naive Bayes over categorical features of the span, which scores candidates that no labeler has voted on as well.
Distinct patterns are bounded by the votes and features (a few thousand rows, whatever the input), every step of the
estimation is an aggregate over them, and only single weights reach the driver.

Everything is column expressions; one scan of the texts leaves a narrow table.

Defined cases: a null text is an empty one and has no spans; texts of any length are scanned whole; repeated rows give
repeated results and count each; a null doc_id is kept; other columns are ignored; an empty table gives no rows, and
without any span there is nothing to estimate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomkit.llm.jobs import query, table
from fathomkit.llm.spans import clear_of, digest, found, let, n_of, of_kind, substrings, whole_text
from fathomkit.session import hold

ROUNDS = 12
ACCEPT = 0.8
SMOOTH = 0.5
CONTEXT = 40

# The base patterns. Possessive forms match the same text and need no stack for long runs; a run that
# fails is not tried again from its second character on (unless the match before ended inside it, \G).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# The looser patterns, and the word lists of the labelers.
LOOSE = (
    ("address", r"(?i:\b[a-z0-9._%+-]{2,40}\x20?[\[(]\x20?at\x20?[\])]\x20?[a-z0-9.-]{2,60})", r"[\[(]\x20?(?i:at)"),
    ("local_phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", None),
    ("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
    ("name", r"\b(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]{1,30}(?:\x20[A-Z][a-z]{1,30})?", None),
)
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info", "biz")
GIVEN_NAMES = (
    "James", "Mary", "John", "Anna", "Robert", "Linda", "Michael", "Susan", "David", "Sarah", "Peter", "Maria",
    "Thomas", "Julia", "Paul", "Laura", "Daniel", "Claire", "Hans", "Sophie", "Pierre", "Carlos", "Carmen", "Jose",
)
SUPPORT = r"(?i)\b(e-?mail|mail|contact|write|phone|call|tel|fax|mobile|cell|dial|card|visa|account|ssn|social|name|"\
    r"from|user|login|address|ip|host)\b[^\n]{0,20}$"
AGAINST = r"(?i)\b(version|ver|isbn|doi|order|invoice|no|nr|page|chapter|section|figure|table|step|build|rfc)\b[^\n]{0,8}$"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, r"[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits of ``hit`` pass the checksum of card numbers."""
    total = F.aggregate(
        F.split(F.reverse(_digits(hit)), ""), F.struct(F.lit(0).alias("sum"), F.lit(False).alias("double")),
        lambda a, c: let(c.cast("int") * F.when(a["double"], 2).otherwise(1), lambda d: F.struct(
            (a["sum"] + F.when(d > 9, d - 9).otherwise(d)).alias("sum"), (~a["double"]).alias("double"))),
        lambda a: a["sum"])
    return total % 10 == 0


def base_spans(text: Column) -> list[tuple[str, Column]]:
    """Spans of the fixed patterns by kind, those that fail a check dropped."""
    ip = F.filter(found(text, IP, text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]")), lambda s: ~F.exists(
        F.split(s["hit"], r"\."), lambda part: let(F.regexp_replace(part, "^0+", ""), lambda n: (
            (F.length(n) > 3) | ((F.length(n) == 3) & (n > "255"))))))
    card = F.filter(found(text, CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")), lambda s: let(
        F.length(_digits(s["hit"])), lambda n: (n >= 12) & (n <= 19)) & luhn(s["hit"]))
    phone = F.filter(found(text, PHONE, text.rlike(r"\+[0-9]")), lambda s: let(
        F.length(_digits(s["hit"])), lambda n: (n >= 9) & (n <= 15)))
    email = found(text, EMAIL, text.contains("@"))
    return list(zip(KINDS, (email, ip, card, phone)))


def loose_spans(text: Column) -> list[tuple[str, Column]]:
    return [(kind, found(text, pattern, F.lit(True) if likely is None else text.rlike(likely)))
            for kind, pattern, likely in LOOSE]


def _vote(name: str, yes: Column, no: Column | None = None) -> Column:
    """name=+, name=-, or null where the labeler abstains, which is no evidence."""
    against = F.lit(False) if no is None else no
    return F.when(F.coalesce(yes, F.lit(False)), f"{name}=+").when(F.coalesce(against, F.lit(False)), f"{name}=-")


def _judged(span: Column, around: Column, kind: str, base: bool) -> Column:
    """A span with the votes of the labelers and the features of the classifier; ``around`` as ``_around`` gives it."""
    hit = span["hit"]
    ahead = F.least(span["start"], F.lit(CONTEXT))
    before = F.substring(around, F.lit(1), ahead)
    after = F.substring(around, ahead + F.length(hit) + 1, F.lit(1))

    def judge(x):
        digits = F.length(_digits(hit))
        last = F.lower(F.regexp_extract(hit, r"\.([A-Za-z]+)$", 1))
        shape = F.lit(True) if base else hit.rlike(r"^(Mr|Mrs|Ms|Dr|Prof)\b") if kind == "name" else F.lit(False)
        votes = F.array_compact(F.array(
            _vote("pattern", shape),
            _vote("even", F.lit(False), hit.rlike(r"^\D*(\d)(\D|\1)*$")),
            _vote("domains", last.isin(*DOMAINS), (F.lit(kind in ("email", "address"))) & (F.length(last) > 6)),
            _vote("names", F.regexp_extract(hit, r"([A-Z][a-z]+)$", 1).isin(*GIVEN_NAMES)
                  | F.regexp_extract(hit, r"\x20([A-Z][a-z]+)", 1).isin(*GIVEN_NAMES)),
            _vote("context", x["before"].rlike(SUPPORT), x["before"].rlike(AGAINST)),
            _vote("embedded", F.lit(False), x["before"].rlike(r"[A-Za-z0-9]$") | x["after"].rlike(r"[A-Za-z0-9]")),
        ))
        size = F.length(hit)
        features = F.array(
            F.lit(f"kind={kind}"),
            F.concat(F.lit("digits="), F.least(digits, F.lit(20)).cast("string")),
            F.concat(F.lit("size="), F.least(F.floor(F.log2(size)), F.lit(8)).cast("string")),
            F.concat(F.lit("groups="), F.least(F.size(F.split(hit, r"[\x20().-]+")), F.lit(6)).cast("string")),
            F.concat(F.lit("before="), F.when(x["before"].rlike(r"\s$"), "space").when(
                x["before"] == "", "none").when(x["before"].rlike(r"[A-Za-z0-9]$"), "word").otherwise("sign")),
            F.concat(F.lit("after="), F.when(x["after"].rlike(r"\s"), "space").when(
                x["after"] == "", "none").when(x["after"].rlike(r"[A-Za-z0-9]"), "word").otherwise("sign")),
            F.concat(F.lit("context="), x["before"].rlike(SUPPORT).cast("string")),
        )
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), F.lit(kind).alias("kind"),
                        votes.alias("votes"), features.alias("features"))

    return let(F.struct(before.alias("before"), after.alias("after")), judge)


def scanned(text: Column) -> tuple[Column, Column]:
    """Base spans, and all spans with their votes and features."""
    base, loose = base_spans(text), loose_spans(text)
    spans = F.concat(*(of_kind(s, kind, i) for i, (kind, s) in enumerate(base)))
    judged = F.concat(*(_all_judged(text, s, kind, is_base)
                        for is_base, group in ((True, base), (False, loose)) for kind, s in group))
    return spans, judged


def _around(text: Column, spans: Column) -> Column:
    """Per span its text with ``CONTEXT`` characters before it and one after it, as far as there are any."""
    return substrings(text, F.transform(spans, lambda s: let(
        F.greatest(s["start"] - CONTEXT, F.lit(0)),
        lambda at: F.struct(at.alias("at"), (s["end"] + 1 - at).alias("n")))))


def _all_judged(text: Column, spans: Column, kind: str, base: bool) -> Column:
    return let(spans, lambda spans: F.zip_with(
        spans, _around(text, spans), lambda s, around: _judged(s, around, kind, base)))


def _log_ratio(yes: float, no: float, all_yes: float, all_no: float) -> float:
    return math.log((yes + SMOOTH) / (all_yes + 2 * SMOOTH)) - math.log((no + SMOOTH) / (all_no + 2 * SMOOTH))


def _logistic(weights: dict[str, float], bias: float, items: Column) -> Column:
    """1 / (1 + exp(-sum of the items' weights)); items without a weight count nothing."""
    if not weights:
        return F.lit(1 / (1 + math.exp(-bias)))
    known = F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair))
    total = F.aggregate(items, F.lit(float(bias)), lambda a, i: a + F.coalesce(known[i], F.lit(0.0)))
    return 1 / (1 + F.exp(-total))


def _shares(patterns: DataFrame, posterior: Column, items: str) -> tuple[dict[str, float], float]:
    """Log-odds of each item and of the class, with ``posterior`` as the soft label of a pattern."""
    rows = patterns.withColumn("p", posterior).select(
        F.explode(F.concat(F.array(F.lit("")), items)).alias("item"), (F.col("n") * F.col("p")).alias("yes"),
        (F.col("n") * (1 - F.col("p"))).alias("no"),
    ).groupBy("item").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect()
    sums = {r["item"]: (r["yes"], r["no"]) for r in rows}
    yes, no = sums.pop("", (0.0, 0.0))
    return ({item: _log_ratio(a, b, yes, no) for item, (a, b) in sums.items()},
            math.log((yes + SMOOTH) / (no + SMOOTH)))


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[dict[str, float], float]:
    """Expectation-maximisation: log-odds that each vote carries for the class, and of the class itself.

    It starts from the share of votes for a span among those cast.
    """
    ayes = F.size(F.filter("votes", lambda v: v.endswith("=+")))
    noes = F.size(F.filter("votes", lambda v: v.endswith("=-")))
    posterior = (ayes + 0.5) / (ayes + noes + 1)
    weights, bias = {}, 0.0
    for _ in range(rounds):
        weights, bias = _shares(patterns, posterior, "votes")
        posterior = _logistic(weights, bias, F.col("votes"))
    return weights, bias


def trained(judged: DataFrame) -> tuple[dict[str, float], float]:
    """Weights of the span classifier; ``judged`` has a column spans as ``scanned`` gives it."""
    patterns = hold(judged.select(F.explode("judged").alias("s")).groupBy(
        F.col("s.votes").alias("votes"), F.col("s.features").alias("features")).agg(F.count("*").alias("n")))
    weights, bias = reliabilities(patterns)
    return _shares(patterns, _logistic(weights, bias, F.col("votes")), "features")


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id with base (spans of the fixed patterns) and spans (these and the accepted candidates)."""
    texts = docs.select("doc_id", whole_text(F.col("text")).alias("text"))
    base, judged = scanned(F.col("text"))
    held = hold(texts.select("doc_id", base.alias("base"), judged.alias("judged")))
    weights, bias = trained(held)
    loose = [kind for kind, *_ in LOOSE]
    accepted = F.filter("judged", lambda s: s["kind"].isin(*loose) & (_logistic(
        weights, bias, s["features"]) >= ACCEPT))
    rank = F.create_map(*(F.lit(x) for i, kind in enumerate(loose) for x in (kind, len(KINDS) + i)))
    extra = F.transform(clear_of(accepted, F.col("base")), lambda s: F.struct(
        s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    return held.select("doc_id", "base", F.concat("base", extra).alias("spans"))


@query("op4_personal_data")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = personal_spans(table(spark, sf_dir, "documents"))
    return spans.select(
        "doc_id", *(n_of("base", kind) for kind in KINDS),
        (F.size("spans") - F.size("base")).cast("long").alias("n_more"),
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))
