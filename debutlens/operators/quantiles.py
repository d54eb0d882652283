"""Exact percentiles of which no task ranks more than a slice of a group's distinct values, whose rows are bounded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import discard, stored


#: Counted values that a range has about.
SLICE_ROWS = 500_000


def in_ranges(counts: DataFrame, *order: str, slice_rows: int) -> DataFrame:
    """The rows with `slice`, the number of their range by `order`, stored; there are as many ranges as the rows need."""
    kept = stored(counts, "value-counts")
    n = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-kept.count() // slice_rows))
    out = stored(kept.repartitionByRange(n, *order).withColumn("slice", F.spark_partition_id()), "value-ranges")
    discard(kept)
    return out


def exact_percentiles(df: DataFrame, value: str, wanted: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """The columns `by` and each of `wanted` (name: share from 0 to 1), interpolated between neighbouring ranks.

    Values are counted, dealt to tasks by ranges and stored with the number of their range; the rows per range tell
    which ranges hold the ranks, and only those are ranked. NULL values don't count, -0.0 is 0.0, NaN is the
    greatest, NULL is a group of its own. A group without values is absent; without `by` there is always one row, of NULLs if need be.
    """
    group = F.struct(*by) if by else F.lit(0)
    values = df.select(group.alias("g"), F.col(value).cast("double").alias("v")).filter("v is not null")
    counts = values.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    sliced = in_ranges(counts, "g", "v", slice_rows=SLICE_ROWS)

    # one row per group and range
    sizes = sliced.groupBy("g", "slice").agg(F.sum("c").alias("m"))
    sizes = sizes.withColumn("below", F.sum("m").over(Window.partitionBy("g").orderBy("slice")) - F.col("m")).withColumn("n", F.sum("m").over(Window.partitionBy("g")))
    place = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in wanted.items()}
    holds = F.lit(False)
    for at in place.values():
        holds |= (F.floor(at) < F.col("below") + F.col("m")) & (F.ceil(at) >= F.col("below"))

    ranked = sliced.join(sizes.filter(holds).select("g", "slice", "below", "n"), ["g", "slice"])
    ranked = ranked.withColumn("end", F.col("below") + F.sum("c").over(Window.partitionBy("g", "slice").orderBy("v")))
    first = lambda rank: F.min(F.when(F.col("end") > rank, F.col("v")))
    ends = [x for name, at in place.items() for x in (first(F.floor(at)).alias(f"lower_{name}"), first(F.ceil(at)).alias(f"upper_{name}"))]
    found = (ranked.groupBy("g") if by else ranked).agg(F.max("n").alias("n"), *ends)

    def between(name: str):
        at, lower, upper = place[name], F.col(f"lower_{name}"), F.col(f"upper_{name}")
        return F.when(lower == upper, lower).otherwise((F.ceil(at) - at) * lower + (at - F.floor(at)) * upper).alias(name)

    return found.select(*[F.col("g")[k].alias(k) for k in by], *[between(name) for name in wanted])


def expanding_medians(df: DataFrame, columns: Sequence[str], date: str, splits: Sequence) -> DataFrame:
    """window (place in `splits`, which ascend), feature, median: of each column over the rows before each split.

    One pass for all windows: values are counted by (range of values, block of dates between splits) and stored; the
    sums per range and block, added up over blocks, tell which range holds a window's ranks, and only the counts of such
    ranges are added up value by value. NULL values don't count; a column without values before a split is absent.
    """
    if not columns or not len(splits):
        return df.sparkSession.createDataFrame([], "window int, feature string, median double")
    block = F.size(F.filter(F.array(*[F.lit(s).cast("date") for s in splits]), lambda s: s <= F.col(date))).alias("block")
    rows = df.filter(F.col(date) < F.lit(splits[-1]).cast("date")).select(block, *[F.col(c).cast("double").alias(c) for c in columns])
    long = rows.unpivot(["block"], list(columns), "feature", "v").filter("v is not null")
    counts = long.groupBy("feature", "v", "block").agg(F.count(F.lit(1)).alias("c"))
    sliced = in_ranges(counts, "feature", "v", slice_rows=SLICE_ROWS)

    # a row per feature, range and window: a block counts for its own window and all later ones
    windows = F.sequence(F.col("block"), F.lit(len(splits) - 1))
    sums = sliced.groupBy("feature", "slice", "block").agg(F.sum("c").alias("m"))
    sizes = sums.select("feature", "slice", "m", F.explode(windows).alias("window")).groupBy("feature", "window", "slice").agg(F.sum("m").alias("m"))
    of_window = Window.partitionBy("feature", "window")
    sizes = sizes.withColumn("below", F.sum("m").over(of_window.orderBy("slice")) - F.col("m")).withColumn("n", F.sum("m").over(of_window))
    low, high = F.expr("(n - 1) div 2"), F.expr("n div 2")
    holds = sizes.filter(((low >= F.col("below")) & (low < F.col("below") + F.col("m"))) | ((high >= F.col("below")) & (high < F.col("below") + F.col("m"))))

    near = sliced.join(holds.select("feature", "slice", "window", "below", "n"), ["feature", "slice"]).filter(F.col("block") <= F.col("window"))
    values = near.groupBy("feature", "window", "slice", "v").agg(F.sum("c").alias("c"), F.first("below").alias("below"), F.first("n").alias("n"))
    ended = values.withColumn("end", F.col("below") + F.sum("c").over(Window.partitionBy("feature", "window", "slice").orderBy("v")))
    first = lambda rank: F.min(F.when(F.col("end") > rank, F.col("v")))
    found = ended.groupBy("feature", "window").agg(first(low).alias("a"), first(high).alias("b"))
    return found.select(F.col("window").cast("int").alias("window"), "feature", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((F.col("a") + F.col("b")) / 2).alias("median"))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The median of each column; of one without values None."""
    if not columns:
        return {}
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    found = {r["feature"]: r["median"] for r in exact_percentiles(long, "value", {"median": 0.5}, ["feature"]).collect()}  # a row per column
    return {c: found.get(c) for c in columns}
