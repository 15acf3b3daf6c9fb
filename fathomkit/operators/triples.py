"""Graph patterns, rules and closures as joins over a triple table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomkit.operators.joins import compatible_left_join
from fathomkit.operators.components import components
from fathomkit.session import fresh_path, hold
from fathomkit.sources.files import read_parquet, write_parquet

TYPE = "rdf:type"
PLAIN = ["s", "p", "o"]
TASK_TRIPLES = 250_000  # triples that one task tells apart


def store(triples: DataFrame) -> DataFrame:
    """Keep the triples in one folder per predicate: a pattern then reads only its own."""
    path = write_parquet(triples, fresh_path(triples.sparkSession, "triples"), ["p"])
    return read_parquet(triples.sparkSession, path).select(*triples.columns)


# --- patterns ----------------------------------------------------------------------------
def facts(g: DataFrame, p: str, s: str, o: str, lang: str | None = None) -> DataFrame:
    """Solutions of one pattern ``?s p ?o``; ``lang`` filters the literal's language."""
    rows = g.filter(F.col("p") == p)
    if lang is not None:
        rows = rows.filter(F.col("o_lang") == lang)
    return rows.select(F.col("s").alias(s), F.col("o").alias(o))


def instances(g: DataFrame, cls: str, s: str) -> DataFrame:
    return g.filter((F.col("p") == TYPE) & (F.col("o") == cls)).select(F.col("s").alias(s))


def conjoin(*parts: DataFrame) -> DataFrame:
    """Inner join of patterns on the variables they share."""
    out = parts[0]
    for part in parts[1:]:
        shared = [c for c in part.columns if c in out.columns]
        if not shared:
            raise ValueError("patterns without a shared variable would be a cross product")
        out = out.join(part, shared)
    return out


def optional(left: DataFrame, group: DataFrame) -> DataFrame:
    """Left join with a group that was joined on its own before."""
    return left.join(group, [c for c in group.columns if c in left.columns], "left")


def optional_open(left: DataFrame, group: DataFrame, shared: str) -> DataFrame:
    """OPTIONAL that reuses ``shared``, a variable the left side may have left unbound."""
    keys = [c for c in group.columns if c in left.columns and c != shared]
    return compatible_left_join(left, group, keys, shared)


def number(o: Column | str) -> Column:
    return (F.col(o) if isinstance(o, str) else o).try_cast("bigint")


def construct(solutions: DataFrame, templates: Sequence[tuple[str | Column, str, str | Column]]) -> DataFrame:
    """Triples of every solution; one with an unbound variable is left out.

    A template names variables for subject and object; a Column stands for a constant.
    """
    def at(x):
        return F.col(x) if isinstance(x, str) else x

    made = F.array(*[
        F.struct(at(s).alias("s"), F.lit(p).alias("p"), at(o).cast("string").alias("o"))
        for s, p, o in templates
    ])
    return solutions.select(F.explode(made).alias("t")).select("t.*").dropna(
        subset=["s", "o"]
    ).distinct()


# --- rules and property axioms -----------------------------------------------------------
def participation_rule(g: DataFrame) -> DataFrame:
    """Player(p), playsFor(p, t), competesin(t, l) => participatesIn(p, l)."""
    body = conjoin(
        instances(g, "Player", "player"), facts(g, "playsFor", "player", "team"),
        facts(g, "competesin", "team", "league"),
    )
    return construct(body, [("player", "participatesIn", "league")])


def large_stadium_rule(g: DataFrame, above: int = 60000) -> DataFrame:
    """Team(t), hasStadium(t, s), capacity(s) > above => largeStadium(t, s)."""
    body = conjoin(
        instances(g, "Team", "team"), facts(g, "hasStadium", "team", "stadium"),
        facts(g, "stadiumCapacity", "stadium", "capacity").filter(number("capacity") > above),
    )
    return construct(body, [("team", "largeStadium", "stadium")])


def inverse(g: DataFrame, p: str, back: str) -> DataFrame:
    """Facts of ``back``, stated or implied by ``p``."""
    implied = g.filter(F.col("p") == p).select(F.col("o").alias("s"), F.lit(back).alias("p"), F.col("s").alias("o"))
    return g.filter(F.col("p") == back).select(*PLAIN).union(implied).distinct()


def closure(g: DataFrame, p: str, max_rounds: int = 64) -> DataFrame:
    """All pairs reachable over ``p``, by joining the newest paths with all known ones.

    Path length doubles per round. Each round is written out, so lineage stays flat and a
    lost executor costs one round at most.
    """
    known = hold(facts(g, p, "s", "o").distinct())
    fresh = known
    for _ in range(max_rounds):
        a = fresh.alias("a").join(known.alias("b"), F.col("a.o") == F.col("b.s"))
        b = known.alias("a").join(fresh.alias("b"), F.col("a.o") == F.col("b.s"))
        paths = a.select("a.s", "b.o").union(b.select("a.s", "b.o")).distinct()
        fresh = hold(paths.join(known, ["s", "o"], "left_anti"))
        if fresh.isEmpty():
            return known.select("s", F.lit(p).alias("p"), "o")
        known = hold(known.union(fresh))
    raise RuntimeError(f"closure of {p} did not settle in {max_rounds} rounds")


def functional_violations(g: DataFrame, p: str) -> DataFrame:
    """Subjects with more than one value of a property that allows one."""
    values = g.filter(F.col("p") == p).groupBy("s", "o").agg(F.lit(1).alias("one"))
    return values.groupBy("s").agg(F.count("*").alias("n_values")).filter("n_values > 1")


def irreflexive_violations(g: DataFrame, p: str) -> DataFrame:
    return g.filter((F.col("p") == p) & (F.col("s") == F.col("o"))).select("s").distinct()


def graph_counts(g: DataFrame) -> DataFrame:
    """Number of triples, per predicate and per type, in one pass."""
    kind = F.explode(F.array(
        F.struct(F.lit("all").alias("kind"), F.lit("triples").alias("name")),
        F.struct(F.lit("predicate").alias("kind"), F.col("p").alias("name")),
        F.struct(
            F.when(F.col("p") == TYPE, "type").alias("kind"), F.col("o").alias("name")
        ),
    )).alias("k")
    return g.select(kind).select("k.*").filter("kind IS NOT NULL").groupBy("kind", "name").agg(
        F.count("*").alias("n")
    )


def merge(*graphs: DataFrame) -> DataFrame:
    """Set union: a triple stated twice is kept once.

    Nearly all triples differ, so they are dealt out first, about ``TASK_TRIPLES`` to a task: told apart before the
    shuffle, a task would hold all triples of its file split in one hash table.
    """
    out = graphs[0]
    for g in graphs[1:]:
        out = out.unionByName(g)
    return out.repartition(max(1, -(-out.count() // TASK_TRIPLES)), *out.columns).distinct()


def link_by_name(g: DataFrame, cls: str, name: str = "hasName") -> DataFrame:
    """Rewrite instances of ``cls`` that share a name, directly or through others, to the smallest of their IRIs.

    Lets two sources with their own IRIs for the same thing be queried together.
    """
    named = conjoin(instances(g, cls, "s"), facts(g, name, "s", "label")).distinct()
    first = named.groupBy("label").agg(F.min("s").alias("b"))
    links = named.join(first, "label").select(F.col("s").alias("a"), "b")
    swap = hold(components(links).select(F.col("node").alias("was"), F.col("root").alias("one")))
    out = g.join(swap, F.col("s") == F.col("was"), "left").withColumn("s", F.coalesce("one", "s")).drop("was", "one")
    out = out.join(swap, F.col("o") == F.col("was"), "left").withColumn("o", F.coalesce("one", "o"))
    return merge(out.drop("was", "one"))
