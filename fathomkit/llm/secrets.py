"""Secret scans: fixed patterns, and a battery of randomness tests on every long token.

The encoding of a token is inferred from its characters; under the hypothesis that these are drawn evenly from its
alphabet, three tests are made: chi-squared for evenness (normal by the cube root), runs above and below the middle of
the alphabet, and serial correlation of neighbours. Fisher's sum combines them to one p-value, which is high for random
tokens. What ordinary text reaches by chance is measured, not assumed: the prose of all documents, its words joined and
cut into runs of letters, and all long words take the same battery, and in each band of lengths a token is reported only
from the p-value on at which, by their share above it, the expected share of ordinary tokens among those reported is at
most ``FALSE_SHARE`` (Benjamini-Hochberg with an empirical null). A run has the least length of its band, where text is
told apart worst, and every letter of the prose is in one run at most: the runs are cut in a fixed order of bands
(``PIECES``), short ones often, so that short documents give their share too. Only a band longer than nearly all
documents, with fewer than ``LEAST_NULL`` runs, leans on the next shorter ones. The tests have little power on 16 to 22
characters, where few tokens are reported. The counts cover all documents; only bands x bins of them reach the driver,
a fixed number.

Everything is column expressions; one scan of the texts leaves a narrow table, another one counts the prose.

Defined cases: a null text is an empty one and has no spans; texts of any length are scanned whole; repeated rows give
repeated results; a null doc_id is kept; other columns are ignored by ``secret_spans`` and kept by ``without_secrets``;
an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomkit.llm.jobs import every, free_name, query, table
from fathomkit.llm.spans import clear_of, digest, found, let, n_of, normal_tail, of_kind, redacted, whole_text
from fathomkit.session import hold

FALSE_SHARE = 0.05
BINS = 50
SHORTEST_BAND = 8
LONGEST_BAND = 24
LEAST_NULL = 200

# The base patterns with the least lengths, and the alphabets of encodings.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]+"
LEAST_ACCESS = 20
HEX = r"[0-9a-f]{24,}"
LONG_TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+"
ENCODINGS = (  # name, pattern of the whole token, alphabet, all in the case that the alphabet has
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", r"^[A-Z2-7]+$", "abcdefghijklmnopqrstuvwxyz234567"),
    ("base36", r"^([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ORDINARY = r"^[A-Z]?[a-z]+$|^[A-Z]+$"
WORD = r"(?<![A-Za-z0-9+/_=-])(?:[A-Z]?[a-z]++|[A-Z]++)(?![A-Za-z0-9+/_=-])"

# The bands of the runs that are cut from a block of prose, one after the other. Half of the first 128 are
# of the shortest band, a quarter of the next and so on; the bands longer than these follow once each.
PIECES = [SHORTEST_BAND + (i & -i).bit_length() - 1 for i in range(1, 129)]
PIECES += range(max(PIECES) + 1, LONGEST_BAND + 1)

KINDS = ("assign", "access", "hex", "random")


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by kind."""
    lower = F.lower(text)
    worded = lower.contains(ASSIGN_WORDS[0])
    for word in ASSIGN_WORDS[1:]:
        worded |= lower.contains(word)
    assign = F.filter(found(text, ASSIGN, worded), lambda s: F.length(
        F.regexp_extract(s["hit"], ASSIGN, 2)) >= LEAST_VALUE)
    access = F.filter(found(text, ACCESS, text.contains("AKIA")), lambda s: F.length(s["hit"]) >= LEAST_ACCESS)
    return F.concat(
        of_kind(assign, "assign", 0), of_kind(access, "access", 1),
        of_kind(found(text, HEX, text.rlike(r"[0-9a-f]{24}")), "hex", 2))


def _fisher(of: Column, k: Column) -> Column:
    """Fisher's combined p-value from n characters, the sum of their counts' squares, turns and serial product."""
    n = of["n"]
    # a turn has the chance 2 q (1 - q), q the share of the alphabet above its middle
    above = F.floor(k / 2) / k
    turn = 2 * above * (1 - above)
    chi = (k * of["squares"] / n - n) / (k - 1)
    spread = 2 / (9 * (k - 1))
    uneven = let((F.greatest(chi, F.lit(0.0)) ** (1 / 3) - (1 - spread)) / F.sqrt(spread), normal_tail)
    runs = 2 * let(F.abs(of["turns"] - (n - 1) * turn) / F.sqrt((n - 1) * turn * (1 - turn)), normal_tail)
    serial = 2 * let(F.abs(of["product"] / ((k * k - 1) / 12)) / F.sqrt(n - 1), normal_tail)
    logs = F.lit(0.0)
    for p in (uneven, runs, serial):
        logs = logs - F.log(F.least(F.greatest(p, F.lit(1e-12)), F.lit(1.0)))
    return let(logs, lambda x: F.exp(-x) * (1 + x + x * x / 2))


def battery(codes: Column, k: Column) -> Column:
    """Fisher's combined p-value of three tests that ``codes`` are drawn evenly from 0 to k-1; null for fewer than 8."""
    middle = (k - 1) / 2

    def sums(codes):
        squares = F.aggregate(
            F.array_sort(codes), F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum")),
            lambda a, x: let(F.when(a["last"] == x, a["run"] + 1).otherwise(1), lambda run: F.struct(
                x.alias("last"), run.alias("run"), (a["sum"] + 2 * run - 1).alias("sum"))),
            lambda a: a["sum"])
        pairs = F.aggregate(
            F.slice(codes, 2, F.size(codes)),
            F.struct(codes[0].alias("last"), F.lit(0).alias("turns"), F.lit(0.0).alias("product")),
            lambda a, x: F.struct(
                x.alias("last"),
                (a["turns"] + ((a["last"] > middle) != (x > middle)).cast("int")).alias("turns"),
                (a["product"] + (a["last"] - middle) * (x - middle)).alias("product")))
        return let(pairs, lambda pair: F.struct(
            F.size(codes).cast("double").alias("n"), squares.alias("squares"), pair["turns"].alias("turns"),
            pair["product"].alias("product")))

    return let(codes, lambda c: F.when(F.size(c) >= 8, let(sums(c), lambda of: _fisher(of, k))))


def letters_battery(run: Column) -> Column:
    """``battery`` of a text of at least 8 letters of ``LETTERS``, its sums by functions of whole texts."""
    k, n = len(LETTERS), F.length(run)
    squares = F.lit(0.0)
    for c in LETTERS:
        squares += (n - F.length(F.replace(run, F.lit(c), F.lit("")))).cast("double") ** 2
    halves = F.translate(run, LETTERS, "0" * (k // 2) + "1" * (k // 2))
    turns = sum(n - F.length(F.replace(halves, F.lit(t), F.lit(""))) for t in ("01", "10")) / 2
    middle = ord(LETTERS[0]) + (k - 1) / 2
    product = F.aggregate(
        F.split(run, ""), F.struct(F.lit(0.0).alias("last"), F.lit(0.0).alias("sum")),
        lambda a, c: F.struct((F.ascii(c) - middle).alias("last"),
                              (a["sum"] + a["last"] * (F.ascii(c) - middle)).alias("sum")), lambda a: a["sum"])
    sums = F.struct(n.cast("double").alias("n"), squares.alias("squares"), turns.alias("turns"),
                    product.alias("product"))
    return let(sums, lambda of: _fisher(of, F.lit(float(k))))


def _token(span: Column) -> Column:
    """Start, end, encoding, band of lengths and p-value of a long token."""
    hit = span["hit"]
    ordinary = hit.rlike(ORDINARY)
    name, alphabet = F.lit("base64"), F.lit(ENCODINGS[-1][2])
    for encoding, pattern, letters in reversed(ENCODINGS[:-1]):
        name = F.when(hit.rlike(pattern), encoding).otherwise(name)
        alphabet = F.when(hit.rlike(pattern), letters).otherwise(alphabet)
    plain = F.translate(hit, "-_", "+/")
    kind = F.struct(
        F.when(ordinary, "words").otherwise(name).alias("name"),
        F.when(ordinary, LETTERS).otherwise(alphabet).alias("letters"))

    def tested(of):
        text = F.when(of["name"] == "base64", plain).otherwise(F.lower(hit))
        codes = F.transform(F.split(text, ""), lambda c: F.position(c, of["letters"]) - 1)
        codes = F.filter(codes, lambda c: c >= 0)
        return F.struct(
            span["start"].alias("start"), span["end"].alias("end"), of["name"].alias("encoding"),
            F.least(F.floor(2 * F.log2(F.length(hit))), F.lit(LONGEST_BAND)).cast("int").alias("band"),
            battery(codes, F.length(of["letters"]).cast("double")).alias("p"))

    return let(kind, tested)


def least_length(band: int) -> int:
    """Characters from which on a token is in ``band``."""
    return math.ceil(2 ** (band / 2))


def prose_runs(text: Column, bands: set[int]) -> Column:
    """Band and letters of every run of ``bands`` that is cut from the words of a text."""
    plan, size = [], 0
    for band in PIECES:
        if band in bands:
            plan.append(F.struct(
                F.lit(size).alias("at"), F.lit(least_length(band)).alias("n"), F.lit(band).alias("band")))
        size += least_length(band)
    letters = F.lower(F.array_join(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), ""))
    blocks = F.regexp_extract_all(letters, F.lit(f".{{1,{size}}}"), F.lit(0))

    def cut(block):
        whole = let(F.length(block), lambda n: F.filter(F.array(*plan), lambda r: r["at"] + r["n"] <= n))
        return F.transform(whole, lambda r: F.struct(
            r["band"].alias("band"), F.substring(block, r["at"] + 1, r["n"]).alias("run")))

    return F.flatten(F.transform(blocks, cut))


def scanned(text: Column) -> tuple[Column, Column]:
    """Base spans of a text, and its long tokens with their tests (numbers alone are no secrets)."""
    tokens = F.filter(found(text, LONG_TOKEN, F.lit(True)), lambda s: ~s["hit"].rlike(r"^[0-9/_-]+$"))
    return base_spans(text), F.transform(tokens, _token)


def least_p(tokens: DataFrame, texts: DataFrame) -> dict[int, float]:
    """Per band of lengths the p-value from which a token is reported; a band without one is absent.

    ``tokens`` has a column tokens, ``texts`` the text. Runs are tested in the bands that hold tokens, and in all shorter
    ones where one of these has too few. Bands x bins of counts reach the driver.
    """
    null, seen = {}, {}

    def add(rows: DataFrame) -> None:
        cell = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int").alias("cell")
        for r in rows.groupBy("band", "ordinary", cell).agg(F.count("*").alias("n")).collect():
            (null if r["ordinary"] else seen).setdefault(r["band"], [0] * BINS)[r["cell"]] += r["n"]

    add(tokens.select(F.explode("tokens").alias("t")).where("t.p IS NOT NULL").select(
        "t.band", (F.col("t.encoding") == "words").alias("ordinary"), "t.p"))
    wanted, done = {*seen}, set()
    while wanted:
        add(texts.select(F.inline(prose_runs(whole_text(F.col("text")), wanted))).select(
            "band", F.lit(True).alias("ordinary"), letters_battery(F.col("run")).alias("p")))
        done |= wanted
        lacking = [band for band in seen if sum(null.get(band, [])) < LEAST_NULL]
        wanted = {*range(SHORTEST_BAND, max(lacking, default=SHORTEST_BAND))} - done
    limits, pooled = {}, [0] * BINS
    for band in sorted({*null, *seen}):
        own = null.get(band, [0] * BINS)
        pooled = own if sum(own) >= LEAST_NULL else [a + b for a, b in zip(pooled, own)]
        if band not in seen:
            continue
        tested = sum(seen[band])
        for cell in range(BINS):
            chance = (1 + sum(pooled[cell:])) / (1 + sum(pooled))
            reported = sum(seen[band][cell:])
            if reported and chance * tested <= FALSE_SHARE * reported:
                limits[band] = cell / BINS
                break
    return limits


def all_spans(base: Column, tokens: Column, limits: dict[int, float]) -> Column:
    """Base spans, and the tokens found random that overlap none of them."""
    if not limits:
        return base
    least = F.create_map(*(F.lit(x) for item in sorted(limits.items()) for x in item))
    random = F.filter(tokens, lambda t: (t["encoding"] != "words") & (t["p"] >= least[t["band"]]))
    return F.concat(base, of_kind(clear_of(random, base), "random", 3))


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id with base (spans of the fixed patterns) and spans (these and the random tokens)."""
    base, tokens = scanned(F.col("text"))
    texts = docs.select("doc_id", whole_text(F.col("text")).alias("text"))
    held = hold(texts.select("doc_id", base.alias("base"), tokens.alias("tokens")))
    limits = least_p(held, texts)
    return held.select("doc_id", "base", all_spans(F.col("base"), F.col("tokens"), limits).alias("spans"))


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; a null text stays null.

    The spans are written beside the documents once, so texts are searched a single time.
    """
    base, tokens = (free_name(docs, name) for name in ("base", "tokens"))
    text = whole_text(F.col("text"))
    found_base, found_tokens = scanned(text)
    held = hold(docs.select(*every(docs), found_base.alias(base), found_tokens.alias(tokens)))
    limits = least_p(held.select(F.col(tokens).alias("tokens")), held)
    clean = let(all_spans(F.col(base), F.col(tokens), limits), lambda spans: redacted(text, spans))
    kept = [F.when(F.col("text").isNull(), None).otherwise(clean).alias(c) if c == "text" else F.col(f"`{c}`")
            for c in docs.columns]
    return held.select(*kept)


@query("op1_secret_scans")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found_spans = secret_spans(table(spark, sf_dir, "documents"))
    counts = [n_of("base", k) for k in KINDS[:3]]
    extra = (F.size("spans") - F.size("base")).cast("long").alias("n_random")
    return found_spans.select(
        "doc_id", *counts, extra, F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"))
