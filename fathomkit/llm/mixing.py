"""Mixing sources to target weights by temperature.

The token share of every source is raised to an exponent a and normalised again: a = 1 keeps the shares, a = 0 makes
them equal. Both the entropy of the weights and the largest number of passes over a source fall as a grows, so the
exponent that meets a target entropy or a repetition limit is bisected; each pass over the table of sources evaluates
31 inner points of the bracket at once, which are five halvings. The weights are realised as budgets: a source whose
budget is b of its t tokens gets the whole part of b / t as full passes over its blocks, and the rest from the blocks
of one more pass in permuted order.

Documents fall into ``BLOCKS`` blocks by a hash of their id, whatever the source. All steps but the word count and the
final look-up work on the table of blocks, which has at most sources x BLOCKS rows; a source with a third of all rows
is summed before the shuffle and spread over its blocks in the join.

Defined cases: a null text has no tokens, but its document belongs to a block like any other; a null source is a source
of its own; tokens are stretches without ASCII white space, in whole texts; repeated rows share a block and count each;
a null doc_id falls into block 0; other columns are kept by ``apply_mixture`` and ignored otherwise; sources without
tokens get weight 0 and are passed over once; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomkit.llm.jobs import every, free_name, query, table
from fathomkit.session import hold

BLOCKS = 4096
SECTION = 32
PASSES = 6
MAX_REPEATS = 1.5
SEED = "mix"

TOKENS = "CAST(regexp_count(coalesce(CAST(text AS STRING), ''), '[^\\\\x20\\\\x09-\\\\x0D]+') AS BIGINT)"


def _hash12(text) -> F.Column:
    """A number below 4096 from the md5 of ``text``."""
    return F.conv(F.substring(F.md5(text), 1, 3), 16, 10).cast("int")


def with_blocks(docs: DataFrame, block: str = "mix_block", source: str = "mix_source") -> DataFrame:
    """Adds the block and the source of each row, under names that must be free."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    return docs.withColumn(block, _hash12(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn(source, key)


def block_table(docs: DataFrame) -> DataFrame:
    """mix_source, mix_block, tokens, n_docs; held, as every later step starts from it."""
    tokens = with_blocks(docs.select("doc_id", "text", "source")).withColumn("n", F.expr(TOKENS))
    return hold(tokens.groupBy("mix_source", "mix_block").agg(
        F.sum("n").alias("tokens"), F.count("*").alias("n_docs")))


def _repeats(a: str) -> str:
    """SQL: passes over the most repeated source while the largest source is passed over once."""
    passes = f"exp(({a} - 1) * ln_share)"
    return f"max({passes}) / min({passes})"


def _entropy(a: str) -> str:
    w = f"exp({a} * ln_share)"
    return f"ln(sum({w})) - {a} * sum({w} * ln_share) / sum({w})"


GOALS = {"entropy": _entropy, "repeats": _repeats}


def exponent(shares: DataFrame, goal: str, target: float) -> float:
    """The smallest exponent in [0, 1], to 2^-30, at which ``goal`` (of GOALS) is at most ``target``; 1 if none is."""
    low, width = 0.0, 1.0
    for _ in range(PASSES):
        step = width / SECTION
        points = [low + step * i for i in range(1, SECTION)]
        found = shares.agg(*(F.expr(f"{GOALS[goal](f'{a!r}D')} <= {target!r}D").alias(f"p{i}")
                             for i, a in enumerate(points))).first()
        met = next((i for i in range(SECTION - 1) if found[i]), SECTION - 1)
        low, width = low + step * met, step
    return low + width


def source_plan(
    blocks: DataFrame, goal: str = "repeats", target: float = MAX_REPEATS, budget: int | None = None,
) -> DataFrame:
    """Per source: tokens, n_docs, weight and passes (its budget in passes over itself).

    ``budget`` tokens are dealt out; without it as many that the largest source is passed over once, so that no
    document is left out.
    """
    totals = blocks.groupBy("mix_source").agg(F.sum("tokens").alias("tokens"), F.sum("n_docs").alias("n_docs"))
    total, most = totals.agg(F.sum("tokens"), F.max("tokens")).first()
    if not total:
        return totals.select("*", F.lit(0.0).alias("weight"), F.lit(1.0).alias("passes"))
    share = F.log(F.col("tokens") / F.lit(float(total)))
    shares = totals.where("tokens > 0").withColumn("ln_share", share)
    a = exponent(shares, goal, target)
    norm = shares.agg(F.expr(f"sum(exp({a!r}D * ln_share))")).first()[0]
    weight = F.when(F.col("tokens") > 0, F.exp(F.lit(a) * share) / F.lit(norm)).otherwise(0.0)
    if budget is None:
        passes = F.greatest(F.exp(F.lit(a - 1) * share) / F.lit((most / total) ** (a - 1)), F.lit(1.0))
    else:
        passes = F.exp(F.lit(a) * share) / F.lit(norm) * F.lit(float(budget)) / F.col("tokens")
    return totals.select("*", weight.alias("weight"), F.when(F.col("tokens") > 0, passes).otherwise(1.0).alias("passes"))


def block_plan(blocks: DataFrame, plan: DataFrame, seed: str = SEED) -> DataFrame:
    """Per block its permuted place in its source and the copies that are taken of it.

    The last pass takes blocks in permuted order while the tokens before their end are within the rest of the budget.
    """
    order = Window.partitionBy("mix_source").orderBy("turn", "mix_block")
    turn = F.md5(F.concat_ws("/", F.lit(seed), "mix_source", F.col("mix_block").cast("string")))
    rest = F.floor(F.round((F.col("passes") - F.floor("passes")) * F.col("source_tokens"), 3))
    sums = blocks.withColumn("turn", turn).join(
        plan.select("mix_source", F.col("tokens").alias("source_tokens"), "weight", "passes"), "mix_source",
    ).withColumn("place", F.row_number().over(order)).withColumn(
        "until", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    copies = F.floor("passes").cast("int") + F.when((F.col("until") <= rest) & (rest > 0), 1).otherwise(0)
    return sums.select("mix_source", "mix_block", "tokens", "n_docs", "place", "weight", "passes",
                       copies.alias("copies"))


def mixture(
    docs: DataFrame, goal: str = "repeats", target: float = MAX_REPEATS, budget: int | None = None, seed: str = SEED,
) -> DataFrame:
    """The block plan of ``docs``, held."""
    blocks = block_table(docs)
    return hold(block_plan(blocks, source_plan(blocks, goal, target, budget), seed))


def apply_mixture(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` as the mixture holds them: each row as often as its block is taken."""
    block, source, turn = (free_name(docs, name) for name in ("mix_block", "mix_source", "mix_pass"))
    taken = plan.select(F.col("mix_source").alias(source), F.col("mix_block").alias(block),
                        F.sequence(F.lit(1), "copies").alias(turn)).where("copies > 0")
    return with_blocks(docs, block, source).join(taken, [source, block]).select(
        *every(docs), F.explode(turn).alias(turn)).drop(turn)


SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS mix_source,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3))::INT AS block,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens FROM documents),
b AS (SELECT mix_source, block, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
s AS (SELECT mix_source, sum(tokens)::BIGINT AS tokens FROM b GROUP BY ALL),
t AS (SELECT sum(tokens)::DOUBLE AS t, max(tokens)::DOUBLE AS m FROM s),
sh AS (SELECT mix_source, tokens, ln(tokens / t) AS ln_share, m / t AS top FROM s, t WHERE tokens > 0),
bi(k, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT k + 1, CASE WHEN met THEN low ELSE (low + high) / 2 END, CASE WHEN met THEN (low + high) / 2 ELSE high END
  FROM (SELECT k, low, high,
    (SELECT max(exp(((low + high) / 2 - 1) * ln_share)) / min(exp(((low + high) / 2 - 1) * ln_share)) FROM sh)
      <= {MAX_REPEATS} AS met FROM bi WHERE k < 30)),
a AS (SELECT high AS a FROM bi WHERE k = 30),
w AS (SELECT mix_source, tokens AS source_tokens, greatest(exp((a - 1) * ln_share) / pow(top, a - 1), 1) AS passes,
  exp(a * ln_share) / sum(exp(a * ln_share)) OVER () AS weight FROM sh, a),
p AS (SELECT b.mix_source, b.block, w.weight, w.passes,
  sum(b.tokens) OVER (PARTITION BY b.mix_source ORDER BY md5('{SEED}/' || b.mix_source || '/' || b.block), b.block
    ROWS UNBOUNDED PRECEDING) AS until,
  floor(round((passes - floor(passes)) * source_tokens, 3)) AS rest
  FROM b JOIN w USING (mix_source))
SELECT d.doc_id, d.source, d.tokens, d.block, round(p.weight, 6) AS weight, round(p.passes, 5) AS passes,
  (floor(p.passes) + CASE WHEN until <= rest AND rest > 0 THEN 1 ELSE 0 END)::INT AS copies
FROM d JOIN p USING (mix_source, block)"""


@query("op3_temperature_mixing", SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its block, the weight and passes of its source, and how often the mixture takes it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixture(docs).select("mix_source", "mix_block", "weight", "passes", "copies")
    return with_blocks(docs).withColumn("tokens", F.expr(TOKENS)).join(plan, ["mix_source", "mix_block"]).select(
        "doc_id", "source", "tokens", F.col("mix_block").alias("block"), F.round("weight", 6).alias("weight"),
        F.round("passes", 5).alias("passes"), "copies")
