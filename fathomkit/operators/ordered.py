"""Order-dependent operators that never put a whole table in one task.

Spark's unpartitioned window moves every row to one task, and its exact ``percentile`` keeps every distinct value in one
buffer. The functions here cut the ordered axis into ranges first, work inside each range and carry only per-range
totals across. The number of ranges follows the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomkit.session import held_for, hold

CELLS = 1_024  # counts per group and pass of the quantile search
RANGE_ROWS = 1_000_000  # rows that one task of a ranged window should hold
MOST_FINITE = 1.7976931348623157e308


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group and column; nulls and NaN are left out.

    A search by counting: every pass cuts the interval that holds a wanted rank into ``CELLS`` equal parts, counts the
    values of each with a map-side aggregate, and goes on in the part where the rank lies, between the smallest and the
    largest value that it holds. It ends when these are equal. Only counts are shuffled, whatever the size of a group;
    prices and whole numbers need two or three passes. The value after the wanted one is known from the same counts.

    Result: ``by``, ``metric``, ``n`` and one column per entry of ``probs``.
    """
    names = list(names or [f"p{p * 100:g}".replace(".", "_") for p in probs])
    by, keys = list(by), [*by, "metric"]
    base = hold(df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]))
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("v")) for c in columns]))
    long = base.select(*by, stack.alias("_s")).select(*by, "_s.metric", "_s.v").filter("v IS NOT NULL AND NOT isnan(v)")

    whole = long.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]))
    left = hold(whole.select("*", at.alias("_t")).select(
        *keys, "n", "_t.i", ((F.col("n") - 1) * F.col("_t.p")).alias("pos"), "lo", "hi", F.col("n").alias("same"),
        F.lit(None).cast("double").alias("after"),
    ).withColumn("rank", F.floor("pos")))
    found = [left.filter("lo = hi")]
    while not (left := left.filter("lo < hi")).isEmpty():
        left = hold(_narrowed(long, left, keys))
        found.append(left.filter("lo = hi"))
    values = found[0]
    for part in found[1:]:
        values = values.unionByName(part)
    upper = F.when(F.col("rank") + 1 < F.col("same"), F.col("lo")).otherwise(F.coalesce("after", "lo"))
    share = F.col("pos") - F.floor("pos")
    value = F.when((share == 0) | (upper == F.col("lo")), F.col("lo")).otherwise(
        F.col("lo") + (upper - F.col("lo")) * share)
    return values.withColumn("value", value).groupBy(*keys, "n").agg(
        *[F.max(F.when(F.col("i") == i, F.col("value"))).alias(name) for i, name in enumerate(names)])


def _narrowed(long: DataFrame, left: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One pass of the search: each wanted rank with the part of its interval in which it lies."""
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    on.append(F.col("l.v").between(F.col("t.lo"), F.col("t.hi")))

    def half(c: str) -> Column:  # halves of finite values, so that no difference overflows
        return F.greatest(F.least(F.col(c), F.lit(MOST_FINITE)), F.lit(-MOST_FINITE)) / 2

    width = half("hi") - half("lo")
    cell = F.when(width > 0, F.least(F.floor((half("v") - half("lo")) / width * CELLS), F.lit(CELLS - 1))).otherwise(
        (F.col("v") > F.col("lo")).cast("long"))
    inside = long.alias("l").join(left.alias("t"), on).select(
        *[F.col(f"t.{k}").alias(k) for k in keys], "n", "i", "pos", "rank", "after", "lo", "hi", "v")
    counts = inside.withColumn("cell", cell).groupBy(*keys, "n", "i", "pos", "rank", "after", "cell").agg(
        F.count("*").alias("same"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    along = Window.partitionBy(*keys, "i").orderBy("cell")
    before = F.coalesce(F.sum("same").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = counts.withColumn("before", before).withColumn("next", F.lead("lo").over(along))
    return marked.filter((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("same"))).select(
        *keys, "n", "i", "pos", "lo", "hi", "same", F.coalesce("next", "after").alias("after"),
        (F.col("rank") - F.col("before")).alias("rank"))


def range_index(df: DataFrame, order: str, out: str) -> DataFrame:
    """Add the index of the value range a row falls in, and keep the table.

    Spark's range partitioner deals the rows out; a task gets about ``RANGE_ROWS`` of them, at least as many tasks as a
    shuffle has work. Equal values share a range.
    """
    held = hold(df)
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held.count() // RANGE_ROWS))
    return hold(held.repartitionByRange(ranges, order).withColumn(out, F.spark_partition_id()))


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    measures: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Inclusive running totals ``cum_<m>`` and group totals ``tot_<m>`` along ``order``.

    ``df`` holds one row per (by, order). The first order column is numeric and is cut into
    ranges; a window runs inside each (by, range), and the totals of earlier ranges are
    added. Every task sees one range, whatever the size of a group.
    """
    by = list(by)
    ranged = range_index(df, order[0], "_range")
    # exact decimals for whole numbers keep the sums free of order effects
    parts = ranged.groupBy(*by, "_range").agg(*[F.sum(m).alias(f"_part_{m}") for m in measures])
    toward = F.col("_range").desc() if descending else F.col("_range")
    over_ranges = Window.partitionBy(*by).orderBy(toward) if by else Window.orderBy(toward)
    whole = Window.partitionBy(*by)
    before = over_ranges.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *by, "_range",
        *[F.coalesce(F.sum(f"_part_{m}").over(before), F.lit(0)).alias(f"_base_{m}")
          for m in measures],
        *[F.sum(f"_part_{m}").over(whole).alias(f"tot_{m}") for m in measures],
    )
    inside = Window.partitionBy(*by, "_range").orderBy(
        *[F.col(c).desc() if descending else F.col(c) for c in order]
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = ranged.join(parts, [*by, "_range"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_base_{m}") + F.sum(m).over(inside)).alias(f"cum_{m}") for m in measures],
        *[F.col(f"tot_{m}") for m in measures],
    )


def global_rank(
    df: DataFrame, value: str, tie: str, descending: bool = False, out: str = "rank"
) -> DataFrame:
    """1-based rank over the whole table by ``value``, ties broken by the unique ``tie``.

    Spark's range partitioner deals the rows out by both columns, so a value shared by a third of all rows still spreads
    over many tasks; each task sorts its own and numbers them while they are written, and only the sizes of the tasks are
    added. Also adds ``total``, the number of ranked rows. A null value has no rank, so ``value`` must not be null.
    """
    by = [F.col(value).desc() if descending else F.col(value), F.col(tie)]
    with held_for(df) as held:
        ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held.count() // RANGE_ROWS))
        placed = hold(held.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn(
            "_at", F.monotonically_increasing_id()))  # the task, and below 33 bits the place in it
    task = F.shiftright("_at", 33)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hold(placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_n")).select(
        "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("total")))
    return placed.filter(F.col(value).isNotNull()).withColumn("_task", task).join(sizes, "_task").select(
        value, *[c for c in df.columns if c != value], "total", (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).alias(out))


def tile_of(rank: Column, total: Column, tiles: int) -> Column:
    """The ``ntile`` number that belongs to a 1-based rank."""
    size, extra = F.floor(total / tiles), total % tiles
    edge = extra * (size + 1)
    return F.when(rank <= edge, F.ceil(rank / (size + 1))).otherwise(
        extra + F.ceil(F.try_divide(rank - edge, size))
    ).cast("int")


def dense_index(df: DataFrame, code: str, out: str) -> DataFrame:
    """1-based position of each distinct code in sorted order, attached to every row; codes of any ordered type.

    The distinct codes are numbered range by range; only the size of each range passes through one task.
    """
    codes = range_index(df.filter(F.col(code).isNotNull()).select(code).distinct(), code, "_range")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = codes.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(code))
    numbered = codes.join(sizes, "_range").select(code, (F.col("_base") + inside).cast("int").alias(out))
    return df.join(hold(numbered), code)


def fill_along(
    df: DataFrame, store: str, day: str, tie: str, columns: Sequence[str]
) -> DataFrame:
    """Forward then backward fill of ``columns`` inside ``store``, in (day, tie) order.

    A store's rows are cut into (day, range of tie) chunks. Inside a chunk a window fills;
    between chunks only the first and last known value of each chunk travel, so a store
    with a third of all rows is filled by many tasks.
    """
    ranged = range_index(df, tie, "_chunk")
    chunk = [store, day, "_chunk"]

    def edge(pick, c: str, name: str) -> Column:
        return pick(F.when(F.col(c).isNotNull(), F.struct(F.col(tie).alias("t"), F.col(c).alias("v"))))[
            "v"
        ].alias(name)

    ends = ranged.groupBy(*chunk).agg(
        *[edge(F.max, c, f"_last_{c}") for c in columns],
        *[edge(F.min, c, f"_first_{c}") for c in columns],
    )
    along = Window.partitionBy(store).orderBy(day, "_chunk")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    later = along.rowsBetween(1, Window.unboundedFollowing)
    ends = ends.select(
        *chunk,
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_prev_{c}") for c in columns],
        *[F.first(f"_first_{c}", ignorenulls=True).over(later).alias(f"_next_{c}") for c in columns],
    )
    inside = Window.partitionBy(*chunk).orderBy(tie)
    up = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = {
        c: F.coalesce(
            F.last(c, ignorenulls=True).over(up),
            F.col(f"_prev_{c}"),
            F.first(c, ignorenulls=True).over(down),
            F.col(f"_next_{c}"),
        )
        for c in columns
    }
    joined = ranged.join(ends, chunk)
    kept = [F.col(c) for c in df.columns if c not in columns]
    return joined.select(*kept, *[filled[c].alias(c) for c in columns])


def fill_across(df: DataFrame, store: str, day: str, tie: str, columns: Sequence[str]) -> DataFrame:
    """``fill_along``, and then one pass over everything in (store, day, tie) order for stores without any known value.

    Such a store takes the last value of the nearest store before it that has one, or else the first value of the nearest
    after it. Only the first and last value of each store travel; stores are dealt into ranges, a window runs inside each,
    and between ranges again only the ends travel.
    """
    def edge(pick, c: str, name: str) -> Column:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col(day).alias("d"), F.col(tie).alias("t"), F.col(c).alias("v")))
        return pick(known)["v"].alias(name)

    ends = df.groupBy(store).agg(*[edge(F.min, c, f"_first_{c}") for c in columns],
                                 *[edge(F.max, c, f"_last_{c}") for c in columns])
    ranged = range_index(ends, store, "_range")

    def around(window, place: str) -> list[Column]:
        """The nearest known last value before and first value after."""
        before, after = window.rowsBetween(Window.unboundedPreceding, -1), window.rowsBetween(1, Window.unboundedFollowing)
        return [x for c in columns for x in (
            F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_{place}_prev_{c}"),
            F.first(f"_first_{c}", ignorenulls=True).over(after).alias(f"_{place}_next_{c}"))]

    # a row per range: their number follows the stores divided by RANGE_ROWS
    wide = ranged.groupBy("_range").agg(
        *[F.min_by(f"_first_{c}", F.when(F.col(f"_first_{c}").isNotNull(), F.col(store))).alias(f"_first_{c}") for c in columns],
        *[F.max_by(f"_last_{c}", F.when(F.col(f"_last_{c}").isNotNull(), F.col(store))).alias(f"_last_{c}") for c in columns],
    ).select("_range", *around(Window.orderBy("_range"), "far"))
    near = ranged.select(store, "_range", *around(Window.partitionBy("_range").orderBy(store), "near")).join(wide, "_range")
    spare = near.select(store, *[F.coalesce(*[f"_{place}_{side}_{c}" for side in ("prev", "next") for place in ("near", "far")])
                                 .alias(f"_spare_{c}") for c in columns])
    filled = fill_along(df, store, day, tie, columns).join(spare, store)
    return filled.select(*[F.coalesce(c, f"_spare_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])
