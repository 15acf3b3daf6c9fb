"""Spans in texts by column expressions alone.

A span is a struct (start, end, hit) in code points, end exclusive. Spark's regular expressions give matches without
their places; the text between them gives these, by one split and one running sum per text.

An array that grows by one element a step is copied at each, and a substring is sought from the start of its text. So
running values and substrings go through blocks of about the square root of n elements: inside each block first, then
over the blocks. A text with n matches and T characters takes about n sqrt(n) cheap steps and T sqrt(n) character steps
instead of their squares.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,hit:string>>"
KIND_SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def whole_text(text: Column) -> Column:
    """Any text as a string, a null one as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def blocks(values: Column) -> Column:
    """The array cut into slices of about as many elements as there are slices."""

    def cut(values):
        return let(F.ceil(F.sqrt(F.size(values))).cast("int"), lambda width: F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(values) / width).cast("int") - 1),
            lambda k: F.slice(values, k * width + 1, width)))

    return let(values, lambda values: F.when(F.size(values) > 0, cut(values)).otherwise(
        F.slice(F.array(values), 1, 0)))


def running(values: Column, step: Callable[[Column, Column], Column], zero: Column, kind: str = "int") -> Column:
    """``step`` (associative, ``zero`` neutral) over the values so far, each value's own included."""
    none = F.array().cast(f"array<{kind}>")

    def inside(block):
        grow = lambda a, x: let(step(a["at"], x), lambda now: F.struct(
            now.alias("at"), F.concat(a["out"], F.array(now)).alias("out")))
        return F.aggregate(block, F.struct(zero.alias("at"), none.alias("out")), grow, lambda a: a["out"])

    def before(parts):
        grow = lambda a, part: F.struct(
            step(a["at"], F.element_at(part, -1)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
        return F.aggregate(parts, F.struct(zero.alias("at"), none.alias("out")), grow, lambda a: a["out"])

    return let(F.transform(blocks(values), inside), lambda parts: F.flatten(F.zip_with(
        parts, before(parts), lambda part, at: F.transform(part, lambda x: step(at, x)))))


def substrings(text: Column, ranges: Column) -> Column:
    """The texts of ``ranges``, structs (at, n) from 0 whose starts and ends both rise."""

    def inside(block):
        first, last = block[0], F.element_at(block, -1)
        region = F.substring(text, first["at"] + 1, last["at"] + last["n"] - first["at"])
        return let(region, lambda region: F.transform(
            block, lambda r: F.substring(region, r["at"] - first["at"] + 1, r["n"])))

    return F.flatten(F.transform(blocks(ranges), inside))


def found(text: Column, pattern: str, likely: Column) -> Column:
    """Spans of the leftmost non-overlapping matches; ``likely`` is a cheap test that no match can fail."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def places(matches):
        widths = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)), matches,
                            lambda gap, hit: F.length(gap) + F.length(hit))
        ends = running(widths, lambda a, b: a + b, F.lit(0))
        return F.when(F.size(matches) > 0, F.zip_with(ends, matches, lambda end, hit: F.struct(
            (end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))).otherwise(
            F.array().cast(SPAN))

    return F.when(likely, let(hits, places)).otherwise(F.array().cast(SPAN))


def of_kind(spans: Column, kind: str, rank: int) -> Column:
    """Spans as (start, rank, kind, end), which sort by start and then by the order of kinds."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def n_of(spans: str, kind: str) -> Column:
    """How many of the kind the column ``spans`` has, as n_<kind>."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def clear_of(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that overlap none of ``others``, by start.

    In the common order of starts a span is met by one of the others if one that starts before ends after its start, or
    the next one starts before its end.
    """
    far = 2 ** 31 - 1

    def split(spans):
        order = F.array_sort(F.concat(
            F.transform(others, lambda o: F.struct(
                o["start"].alias("start"), F.lit(-1).alias("at"), o["end"].alias("end"))),
            F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), i.alias("at"), s["end"].alias("end")))))

        def free(order):
            ends = running(F.transform(order, lambda x: F.when(x["at"] < 0, x["end"]).otherwise(0)), F.greatest, F.lit(0))
            starts = F.reverse(running(F.reverse(F.transform(
                order, lambda x: F.when(x["at"] < 0, x["start"]).otherwise(far))), F.least, F.lit(far)))
            met = F.zip_with(order, F.arrays_zip(ends.alias("ends"), starts.alias("starts")), lambda x, near: F.when(
                (x["at"] >= 0) & (near["ends"] <= x["start"]) & (near["starts"] >= x["end"]), x["at"]))
            return F.transform(F.array_compact(met), lambda i: spans[i])

        return let(order, free)

    return let(spans, lambda spans: F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(split(spans)))


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order of start and kind."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by its kind in brackets."""

    def cut(spans):
        reached = running(F.transform(spans, lambda s: s["end"]), F.greatest, F.lit(0))

        def joined(reached):
            heads = F.filter(F.zip_with(spans, F.concat(F.array(F.lit(0)), reached), lambda s, at: F.when(
                s["start"] >= at, F.struct(
                    at.alias("at"), (s["start"] - at).alias("n"), F.upper(s["kind"]).alias("kind")))),
                lambda head: head.isNotNull())
            tail = F.element_at(reached, -1)
            ranges = lambda heads: F.concat(
                F.transform(heads, lambda h: F.struct(h["at"].alias("at"), h["n"].alias("n"))),
                F.array(F.struct(tail.alias("at"), (F.length(text) - tail).alias("n"))))
            return let(heads, lambda heads: F.array_join(F.zip_with(
                substrings(text, ranges(heads)), heads, lambda piece, head: F.concat(
                    piece, F.when(head.isNull(), "").otherwise(F.concat(F.lit("["), head["kind"], F.lit("]"))))), ""))

        return let(reached, joined)

    return F.when(F.size(spans) > 0, let(F.array_sort(spans), cut)).otherwise(text)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by a rational approximation of erfc (error below 1.5e-7)."""
    # The coefficients of the approximation.
    scale, terms = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

    def tail(x):
        t = 1 / (1 + scale * x)
        poly = F.lit(0.0)
        for c in reversed(terms):
            poly = (poly + c) * t
        return poly * F.exp(-x * x) / 2

    upper = tail(F.abs(z) / 2 ** 0.5)
    return F.when(z >= 0, upper).otherwise(1 - upper)
