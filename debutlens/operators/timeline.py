"""Operators along time whose tasks are bounded by rows, not by keys or dates: as-of joins and means of the last rows.

Rows are dealt once into slices by range of (keys, time), stored with the number of their slice. What a slice needs
from before it, a few rows a key, is carried forward over a table of those rows and given to it as seeds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import stored

#: Rows that a slice has about.
SLICE_ROWS = 1_000_000
SLICE = "__slice"


def dealt(rows: DataFrame, order: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows of a stored table with their slice, a number that ascends with `order` and follows nothing else; stored.

    The number is written down with the rows, so that no later job depends on how often a range was sampled.
    """
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // slice_rows))
    return stored(rows.repartitionByRange(n, *order).withColumn(SLICE, F.spark_partition_id()), "slices")


def last_known(rows: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """seeds, the last `n` rows (t, k, v), newest first, of all earlier slices of a key: by, slice.

    rows: by, slice, t, k, v with v known. Only the last n rows of each slice and key take part.
    """
    newest = Window.partitionBy(SLICE, *by).orderBy(F.desc("t"), F.desc("k"))
    tails = rows.withColumn("r", F.row_number().over(newest)).filter(F.col("r") <= n)
    return tails.groupBy(*by, SLICE).agg(F.reverse(F.array_sort(F.collect_list(F.struct("t", "k", "v")))).alias("tail"))


def carried(slices: DataFrame, tails: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """by, slice and seeds of every slice that has rows of a key: tails of the slices before it, as many as hold n rows.

    The run over slices of a key holds a row per slice, never a row of the table.
    """
    run = Window.partitionBy(*by).orderBy(SLICE)
    # the last n known rows lie in the last n slices that have any, so slices without are passed over first
    upto = F.slice(F.reverse(F.array_sort(F.flatten(F.collect_list("tail").over(run.rowsBetween(-n, 0))))), 1, n)
    filled = tails.withColumn("upto", upto).select(*by, SLICE, "upto")
    before = F.last("upto", ignorenulls=True).over(run.rowsBetween(Window.unboundedPreceding, -1))
    return slices.join(filled, [*by, SLICE], "left").withColumn("seeds", before).filter("seeds is not null").select(*by, SLICE, "seeds")


def mean_of_last(rows: DataFrame, value: str, n: int, out: str, *, by: Sequence[str] = (), time: str, key: str, strict_time: bool = False, seeds_from: DataFrame | None = None) -> DataFrame:
    """`rows`, as `dealt` by (by or not, time, key) gives them, with the mean of the last `n` known values before each.

    Rows of a slice are sorted by key within it. With `strict_time` values of the same time don't count, for which
    rows have to be dealt by time alone. All rows have a time. `seeds_from`: the same rows as a stored table, if `rows`
    are made from it.
    """
    names = [f"g{i}" for i in range(len(by))]
    own = [F.col(time).alias("t"), F.col(key).alias("k"), F.col(value).cast("double").alias("v")]
    # nulls of a key are a key of their own
    keys = [F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("is")).alias(g) for c, g in zip(by, names, strict=True)]
    flat = (rows if seeds_from is None else seeds_from).select(*keys, SLICE, *own)
    tails = last_known(flat.filter("v is not null"), n, names)
    seeds = carried(flat.select(*names, SLICE).distinct(), tails, n, names)
    row_type = rows.select(F.struct("*").alias("row")).schema["row"].dataType
    given = seeds.select(*names, SLICE, F.explode("seeds").alias("s")).select(*names, SLICE, "s.t", "s.k", "s.v", F.lit(None).cast(row_type).alias("row"))
    every = rows.select(*keys, SLICE, *own, F.struct("*").alias("row")).union(given)
    of_slice = Window.partitionBy(SLICE, *names)
    known = Window.partitionBy(SLICE, *names, F.col("v").isNotNull()).orderBy("t", "k").rowsBetween(-(n - 1), 0)
    running = every.withColumn("a", F.when(F.col("v").isNotNull(), F.avg("v").over(known)))
    before = of_slice.orderBy("t", "k").rowsBetween(Window.unboundedPreceding, -1)
    if strict_time:
        before = of_slice.orderBy(F.datediff("t", F.lit("1970-01-01"))).rangeBetween(Window.unboundedPreceding, -1)
    return running.withColumn(out, F.last("a", ignorenulls=True).over(before)).filter("row is not null").select("row.*", out)


def asof_join(left: DataFrame, right: DataFrame, *, by: Sequence[str], time: str, strict: bool = True, prefix: str = "", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Each left row with the columns of its key's newest right row before it (`strict`), or up to it; NULLs without one.

    Both sides lie in one run, dealt by (by, time), so that no key, however many rows of either side it has, is one
    task's work, and neither side has to be small. A slice's seed is the last right row of the key in earlier slices; a
    slice begins inside one key at most, so that seeds are no more than slices and are broadcast. Of right rows at
    one time the greatest by their columns counts. NULL keys or times match nothing; left rows stay as they are.
    """
    own = [c for c in right.columns if c not in by]
    r = right.select(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)], F.col(time).alias("t"), F.lit(1 if strict else 0).alias("side"), F.struct(*own).alias("r"), F.lit(None).cast(left.select(F.struct("*").alias("x")).schema["x"].dataType).alias("l"))
    l = left.select(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)], F.col(time).alias("t"), F.lit(0 if strict else 1).alias("side"), F.lit(None).cast(r.schema["r"].dataType).alias("r"), F.struct("*").alias("l"))  # noqa: E741
    names = [f"g{i}" for i in range(len(by))]
    whole = F.lit(True)
    for c in [*names, "t"]:
        whole &= F.col(c).isNotNull()
    rows = dealt(stored(r.filter(whole).union(l), "both-sides"), [*names, "t", "side"], slice_rows)
    of_key = Window.partitionBy(*names)
    tails = rows.filter("r is not null").groupBy(*names, SLICE).agg(F.max(F.struct("t", "r")).alias("tail"))
    ends = rows.groupBy(*names).agg(F.min(SLICE).alias("first"), F.max(SLICE).alias("last")).filter("first < last").select(*names)
    # keys that lie in several slices: no more than there are slices
    crossing = rows.join(F.broadcast(ends), names, "left_semi").select(*names, SLICE).distinct().join(tails, [*names, SLICE], "left")
    carry = F.last("tail.r", ignorenulls=True).over(of_key.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1))
    seeds = crossing.withColumn("seed", carry).filter("seed is not null").select(*names, SLICE, "seed")
    run = Window.partitionBy(SLICE, *names).orderBy("t", "side", "r").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("m", F.last("r", ignorenulls=True).over(run)).filter("l is not null").join(F.broadcast(seeds), [*names, SLICE], "left")
    found = F.when(whole, F.coalesce("m", "seed"))
    return seen.select("l.*", *[found[c].alias(f"{prefix}{c}") for c in own])
