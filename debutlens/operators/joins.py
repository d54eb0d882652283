"""Joins of filings, listings, prices and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import clean_name
from ..sources.store import stored


def by_clean_name(filings: DataFrame, listings: DataFrame, name: str = "corp_name", most: int | None = None) -> DataFrame:
    """Filings with listings of the same cleaned name; the listing side gives name, date and sector. No null names.

    With `most`, names of more rows than that are split (`split_join`), for tables in which a name is a large share of both sides.
    """
    left = filings.drop("listing_date", "sector_name").withColumn("corp_name_clean", clean_name(F.col(name))).drop(name)
    right = listings.withColumn("corp_name_clean", clean_name(F.col(name)))
    if most:
        return split_join(left, right, "corp_name_clean", most)
    return left.filter("corp_name_clean is not null").join(right, "corp_name_clean")


SLICES, SLICE_ROWS = 64, 1_000_000


def slices(rows: Column, most: int) -> Column:
    """Into how many slices a key's rows are dealt: of `most` rows each, but no more than 64 unless these held over a million.

    Each slice gets the other side's rows again, so their number must not grow with the rows as long as a slice is small enough.
    """
    few = F.greatest(F.lit(SLICES), F.ceil(rows / max(most, SLICE_ROWS)))
    return F.least(F.ceil(rows / most), few).cast("int")


def split_join(left: DataFrame, right: DataFrame, key: str, most: int = 1_000_000) -> DataFrame:
    """Inner join, every pair, of two tables of which one key may hold a large share on both sides.

    Both sides are numbered and stored once. A key with more than `most` rows on a side is dealt by the hash of those numbers
    into `slices`, and the other side's rows of that key go to each slice: the join is by key and slices, so no task holds
    such a key whole, and a row is sent 64 times at most, or as often as the other side has millions of rows of its key.
    Where a side has over 100 000 times `most` rows, `most` is a hundred-thousandth of them; so at most 200 000 keys are
    dealt, and their counts are broadcast.
    NULL keys match nothing, repeated rows give every pair, other columns must have different names.
    """
    own = [c for c in right.columns if c != key]
    clash = sorted({c.lower() for c in own} & {c.lower() for c in left.columns})
    if clash:
        raise ValueError(f"both sides have {', '.join(clash)}")
    place = F.monotonically_increasing_id()
    flat = lambda df, side: df.toDF(*["k" if c == key else f"{side}{i}" for i, c in enumerate(df.columns)])
    a, b = (stored(flat(df, side).filter("k is not null").withColumn("n", place), "side") for df, side in ((left, "left"), (right, "right")))
    na, nb = (df.groupBy("k").agg(F.count(F.lit(1)).alias("c")) for df in (a, b))
    most = max(most, *(side.count() // 100_000 for side in (a, b)))
    hot = na.filter(F.col("c") > most).select("k").union(nb.filter(F.col("c") > most).select("k")).distinct()
    counts = na.withColumnRenamed("c", "ca").join(nb.withColumnRenamed("c", "cb"), "k")
    dealt = stored(counts.join(F.broadcast(hot), "k", "left_semi").select("k", slices(F.col("ca"), most).alias("pa"), slices(F.col("cb"), most).alias("pb")), "dealt")

    def cells(side: DataFrame, mine: str, other: str) -> DataFrame:
        known = side.join(F.broadcast(dealt), "k", "left").na.fill(1, ["pa", "pb"])
        slice_of = F.pmod(F.xxhash64("n"), F.col(f"p{mine}")).cast("int").alias(f"s{mine}")
        return known.select(*[c for c in side.columns if c != "n"], slice_of, F.explode(F.sequence(F.lit(0), F.col(f"p{other}") - 1)).alias(f"s{other}"))

    pairs = cells(a, "a", "b").join(cells(b, "b", "a"), ["k", "sa", "sb"])
    named = [F.col(f"{side}{i}").alias(c) for df, side in ((left, "left"), (right, "right")) for i, c in enumerate(df.columns) if c != key]
    return pairs.select(F.col("k").alias(key), *named)


def with_prices(listings: DataFrame, prices: DataFrame) -> DataFrame:
    """Listings with the prices of their first day; one price row per listing at most, absent ones are NULL."""
    day = prices.groupBy("ticker", "listing_date").agg(F.min(F.struct(*[c for c in prices.columns if c not in ("ticker", "listing_date")])).alias("__p"))
    return listings.join(day, ["ticker", "listing_date"], "left").select(*listings.columns, "__p.*")


def with_sector(listings: DataFrame, sectors: DataFrame, key: str = "ticker", default: str | None = None) -> DataFrame:
    out = listings.drop("sector_name").join(sectors.select(key, "sector_name"), key, "left")
    return out.fillna({"sector_name": default}) if default else out


def master_with(master: DataFrame, features: DataFrame, predictions: DataFrame | None = None, key: str = "ipo_id") -> DataFrame:
    """Master rows (keyed by id) with their features, one at most, and with their predictions, any number."""
    out = master.withColumnRenamed("id", key).join(features, key, "left")
    return out if predictions is None else out.join(predictions, key, "left")


def nearest_demand(filings: DataFrame, demand: DataFrame) -> DataFrame:
    """Each filing with its company's first demand filing on or after its date (of one date, the least by its columns).

    Both lie in one run per company, newest first, and the last demand filing passed is carried to the filings.
    """
    own = [c for c in demand.columns if c not in ("corp_code", "rcept_dt")]
    d = demand.select("corp_code", F.col("rcept_dt").alias("__at"), F.struct(F.col("rcept_dt").alias("demand_dt"), *own).alias("__d"), F.lit(None).cast(filings.select(F.struct("*").alias("x")).schema["x"].dataType).alias("__f"))
    f = filings.select("corp_code", F.col("rcept_dt").alias("__at"), F.lit(None).cast(d.schema["__d"].dataType).alias("__d"), F.struct("*").alias("__f"))
    run = Window.partitionBy("corp_code").orderBy(F.desc("__at"), F.col("__f").isNotNull(), F.desc("__d")).rowsBetween(Window.unboundedPreceding, 0)
    both = f.union(d.filter("__at is not null")).withColumn("__d", F.last("__d", ignorenulls=True).over(run)).filter("__f is not null")
    # filings without a company or a date match nothing
    found = F.when(F.col("corp_code").isNotNull() & F.col("__at").isNotNull(), F.col("__d"))
    return both.withColumn("__d", found).select("__f.*", *[F.col(f"__d.{c}").alias(c) for c in ("demand_dt", *own) if c not in filings.columns])


def walk_windows(df: DataFrame, date: str = "listing_date", *, first_days: int = 3 * 365, valid_days: int = 180, step_days: int = 90, min_train: int = 20, min_valid: int = 5) -> DataFrame:
    """Walk-forward windows: split, valid_end, n_train, n_valid, window (numbered from 0 among those kept).

    Counts come from a table of rows per date (a calendar's size), so windows cost no pass over the rows.
    """
    days = df.filter(F.col(date).isNotNull()).groupBy(F.col(date).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    ends = days.agg(F.min("d").alias("a"), F.max("d").alias("b")).filter(F.date_add("a", first_days + valid_days) <= F.col("b"))
    splits = ends.select(F.explode(F.sequence(F.date_add("a", first_days), F.date_sub("b", valid_days), F.expr(f"interval {step_days} days"))).alias("split")).withColumn("valid_end", F.date_add("split", valid_days))
    joined = days.join(F.broadcast(splits), F.col("d") < F.col("valid_end"))
    counts = joined.groupBy("split", "valid_end").agg(F.sum(F.when(F.col("d") < F.col("split"), F.col("n")).otherwise(0)).alias("n_train"), F.sum(F.when(F.col("d") >= F.col("split"), F.col("n")).otherwise(0)).alias("n_valid"))
    kept = counts.filter((F.col("n_train") >= min_train) & (F.col("n_valid") >= min_valid))
    return kept.withColumn("window", F.row_number().over(Window.orderBy("split")) - 1)


def validation_rows(df: DataFrame, windows: DataFrame, date: str = "listing_date") -> DataFrame:
    """Rows with the windows that validate them: windows are a table of dates, broadcast; a row is in two at most."""
    return df.join(F.broadcast(windows), (F.col(date) >= F.col("split")) & (F.col(date) < F.col("valid_end")))


def with_rank(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds __rank, from 0 by `order`, whose first column is a date: rows are ranked within dates, and dates by a table
    of rows per date (a calendar's size). Rows without a date come first."""
    days = df.groupBy(F.col(order[0]).alias("__day")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(F.col("__day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    base = days.select("__day", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    own = F.row_number().over(Window.partitionBy(order[0]).orderBy(*order[1:] or order)) - 1
    return df.withColumn("__own", own).join(base, F.col(order[0]).eqNullSafe(F.col("__day"))).withColumn("__rank", F.col("__own") + F.col("__base")).drop("__own", "__base", "__day")


def tail_cuts(df: DataFrame, ends: list[tuple], order: list[str]) -> list[dict | None]:
    """For each of a few `ends` (a date, before which the rows lie, or None; k): the first of the last k rows by `order`,
    whose first column is a date, as its values; None if there are fewer than k. Rows without a date don't count.

    One pass for all: rows per date (a calendar's size) tell the days of the cuts; cuts are top-ks within those days alone.
    """
    date = order[0]
    table = df.sparkSession.createDataFrame([(i, split, k) for i, (split, k) in enumerate(ends)], "__i int, __split date, __k long")
    days = df.filter(F.col(date).isNotNull()).groupBy(F.col(date).alias("__day")).agg(F.count(F.lit(1)).alias("__n"))
    before = days.join(F.broadcast(table), F.col("__split").isNull() | (F.col("__day") < F.col("__split")))
    later = Window.partitionBy("__i").orderBy(F.desc("__day")).rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("__k") - F.sum("__n").over(later) + F.col("__n")
    cuts = before.select("__i", "__day", "__n", left.alias("__left")).filter(F.col("__left").between(1, F.col("__n")))
    near = df.join(F.broadcast(cuts), F.col(date) == F.col("__day")).select("__i", "__left", F.struct(*order).alias("__cut"))  # a row per end
    last = near.withColumn("__r", F.row_number().over(Window.partitionBy("__i").orderBy(F.desc("__cut")))).filter("__r <= __left")
    found = {r["__i"]: r["__cut"].asDict() for r in last.groupBy("__i").agg(F.min("__cut").alias("__cut")).collect()}
    return [found.get(i) for i in range(len(ends))]


def from_cut(df: DataFrame, cut: dict | None, order: list[str]) -> Column:
    """Whether a row lies at a cut of `tail_cuts` or after it; without a cut every row with a date does."""
    dated = F.col(order[0]).isNotNull()
    if cut is None:
        return dated
    first = F.struct(*[F.lit(cut[c]).cast(df.schema[c].dataType).alias(c) for c in order])
    return F.coalesce(F.struct(*order) >= first, F.lit(False)) & dated


def chronological_tail(df: DataFrame, k: int, order: list[str]) -> DataFrame:
    """Adds is_tail for the last k rows by `order`, whose first column is a date; rows without one are never among them.

    The cut is found once (`tail_cuts`) and is a value then, so whoever reads the rows again doesn't find it anew.
    """
    return df.withColumn("is_tail", from_cut(df, tail_cuts(df, [(None, k)], order)[0], order) if k > 0 else F.lit(False))
