"""Listing features: scalar formulas, same-day counts, sector medians, as-of momentum, recent returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import clip, number, ratio
from ..sources.store import stored
from . import timeline
from .quantiles import exact_percentiles

#: Weights of the commitment periods.
LOCKUP_WEIGHTS = {"lockup_6m_ratio": 1.0, "lockup_3m_ratio": 0.75, "lockup_1m_ratio": 0.5, "lockup_15d_ratio": 0.25}


def lockup_weighted_score() -> Column:
    terms = [clip(F.coalesce(F.col(c), F.lit(0.0)), 0.0, 1.0) * w for c, w in LOCKUP_WEIGHTS.items()]
    return terms[0] + terms[1] + terms[2] + terms[3]


def band_position(price: str = "offering_price", low: str = "price_band_low", high: str = "price_band_high") -> Column:
    """Place of the price in its band; 0.5 for an empty or unknown band."""
    width = F.col(high) - F.col(low)
    return clip(F.when(F.col(price).isNotNull(), F.when(width > 0, (F.col(price) - F.col(low)) / width).otherwise(0.5)), -0.5, 2.0)


def band_exceeded(position: Column) -> Column:
    return F.coalesce(position > 1.0, F.lit(False)).cast("int")


def secondary_ratio(new: str = "new_shares", old: str = "secondary_shares", given: str | None = None) -> Column:
    """Share of existing shares in the offer; a column `given` is kept as it is."""
    if given:
        return F.col(given)
    a, b = F.coalesce(F.col(new), F.lit(0.0)), F.coalesce(F.col(old), F.lit(0.0))
    return clip(ratio(b, a + b), 0.0, 1.0)


def float_ratio(total: str = "total_post_listing_shares", new: str = "new_shares", old: str = "secondary_shares", public: str | None = None, given: str | None = None) -> Column:
    """Share of the listed shares that are free to trade; a column `given` is kept as it is."""
    if given:
        return F.col(given)
    free = F.col(public) if public else F.coalesce(F.col(new), F.lit(0.0)) + F.coalesce(F.col(old), F.lit(0.0))
    return clip(ratio(free, F.col(total)), 0.0, 1.0)


def offering_per(price: str = "offering_price", eps: str = "eps") -> Column:
    return clip(ratio(F.col(price), F.col(eps)), 0.0, 500.0)


def growth_3y(now: str = "revenue", then: str = "revenue_3y_ago") -> Column:
    return clip(F.when((F.col(now) > 0) & (F.col(then) > 0), F.pow(F.col(now) / F.col(then), F.lit(1 / 3)) - 1), -0.5, 5.0)


def operating_margin(income: str = "operating_income", revenue: str = "revenue") -> Column:
    return clip(ratio(F.col(income), F.col(revenue)), -1.0, 1.0)


def debt_ratio(liabilities: str = "total_liabilities", equity: str = "equity") -> Column:
    return clip(ratio(F.col(liabilities), F.col(equity)), 0.0, 10.0)


def open_return(open_price: str = "open_price", offer: str = "offering_price") -> Column:
    return F.when((F.col(offer) > 0) & F.col(open_price).isNotNull(), (F.col(open_price) / F.col(offer) - 1) * 100)


def extreme_return(limit: float = 200.0, value: str = "open_return_pct") -> Column:
    """Whether a return is so far from 0 that it should be looked at; rows are kept."""
    return F.coalesce(F.abs(F.col(value)) > limit, F.lit(False))


def extreme_report(df: DataFrame, limit: float = 200.0, value: str = "open_return_pct", name: str = "corp_name", shown: int = 5) -> DataFrame:
    """One row: how many returns are extreme, and the names of the `shown` greatest."""
    far = df.filter(extreme_return(limit, value))
    top = far.orderBy(F.desc(F.abs(F.col(value))), name).limit(shown).agg(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct(F.abs(F.col(value)).alias("v"), F.col(name).alias("n"))))), lambda x: x["n"]).alias("names"))
    return far.agg(F.count(F.lit(1)).alias("n")).crossJoin(top)


def with_same_day_count(df: DataFrame, date: str = "listing_date", out: str = "same_day_ipo_count", given: str | None = None) -> DataFrame:
    """Rows on the same date, by an aggregate that is joined back, so that one busy date costs one row; no date: 0.

    A column `given` is taken instead, as a number held between 0 and 20.
    """
    if given:
        return df.withColumn(out, clip(number(F.col(given)), 0.0, 20.0).cast("int"))
    counts = df.filter(F.col(date).isNotNull()).groupBy(date).agg(F.count(F.lit(1)).alias(out))
    return df.join(counts, date, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def with_group_median_ratio(df: DataFrame, value: str, group: str | None, out: str) -> DataFrame:
    """`value` over its group's median where that is above zero; without a group column, over the whole median."""
    if group is None:
        medians = exact_percentiles(df, value, {"__median": 0.5})
        return df.crossJoin(F.broadcast(medians)).withColumn(out, ratio(F.col(value), F.col("__median"))).drop("__median")
    medians = exact_percentiles(df.filter(F.col(group).isNotNull()), value, {"__median": 0.5}, [group])
    return df.join(medians, group, "left").withColumn(out, ratio(F.col(value), F.col("__median"))).drop("__median")


def index_momentum(index: DataFrame, spans: tuple[int, ...] = (5, 20, 60)) -> DataFrame:
    """Per session: close over that of n sessions before, less 1; 0.0 with n or fewer sessions so far, or for a close of 0 or none. One task per index."""
    by = Window.partitionBy("index_code").orderBy("date")
    numbered = index.withColumn("__n", F.row_number().over(by))
    move = lambda n: F.coalesce(F.when(F.col("__n") > n, F.round(F.try_divide("close", F.lag("close", n).over(by)) - 1, 6)), F.lit(0.0))
    out = numbered.select("index_code", "date", "close", *[move(n).alias(f"mom_{n}d") for n in spans])
    return out.withColumn("bear_market_flag", (F.col("mom_20d") < -0.08).cast("int")) if 20 in spans else out


def asof_momentum(listings: DataFrame, index: DataFrame, code: str, prefix: str, spans: tuple[int, ...] = (5, 20, 60), date: str = "listing_date") -> DataFrame:
    """Momentum of the newest session strictly before each listing's date; 0.0 without one.

    Sessions become intervals of dates; distinct listing dates are matched with them by their place in one
    sorted run of both (`last` over an ordered window), a calendar's worth of rows, and joined back by date.
    """
    names = [f"mom_{n}d" for n in spans]
    sessions = index_momentum(index.filter(F.col("index_code") == code), spans).select("date", F.lit(0).alias("ask"), F.struct(*names).alias("m"))
    asked = listings.filter(F.col(date).isNotNull()).select(F.col(date).alias("date")).distinct().select("date", F.lit(-1).alias("ask"), F.lit(None).cast(sessions.schema["m"].dataType).alias("m"))
    run = Window.orderBy("date", "ask").rowsBetween(Window.unboundedPreceding, -1)
    seen = sessions.unionByName(asked).withColumn("m", F.last("m", ignorenulls=True).over(run)).filter("ask = -1")
    got = seen.select(F.col("date").alias(date), *[F.coalesce(F.col("m")[n], F.lit(0.0)).alias(f"{prefix}_momentum_{k}d") for n, k in zip(names, spans, strict=True)])
    out = listings.join(got, date, "left")
    return out.fillna(0.0, [f"{prefix}_momentum_{k}d" for k in spans])


def recent_mean(df: DataFrame, value: str, n: int, out: str, *, group: str | None = None, date: str = "listing_date", key: str = "listing_id", strict_date: bool = False) -> DataFrame:
    """Mean of the last `n` known values before each row by (date, key), in its group if given; none: NULL.

    Rows are dealt into slices of bounded rows by range, and each slice is given the last `n` known rows before it
    (`timeline`). With `strict_date` results of the same date don't count, and a date is one slice's. Rows stay as they
    are, repeated keys too; rows without a date get NULL.
    """
    order = [*([group] if group else []), date, *([] if strict_date else [key])]
    rows = timeline.dealt(stored(df.filter(F.col(date).isNotNull()), "dated"), order)
    means = timeline.mean_of_last(rows, value, n, out, by=[group] if group else [], time=date, key=key, strict_time=strict_date)
    return means.drop(timeline.SLICE).union(df.filter(F.col(date).isNull()).withColumn(out, F.lit(None).cast("double")))


def with_temperature(df: DataFrame, value: str = "open_return_pct", sector: str = "sector_name", date: str = "listing_date", key: str = "listing_id") -> DataFrame:
    """Mean of the last 10 known returns, and of the last 5 in the sector (else, or without a sector, the former).

    Both read the same slices of (date, key): a slice is sorted once for all and once by sector within it.
    """
    rows = stored(df, "returns")
    dealt = timeline.dealt(rows.filter(F.col(date).isNotNull()), [date, key])
    both = timeline.mean_of_last(dealt, value, 10, "recent_ipo_avg_return_all", time=date, key=key)
    own = timeline.mean_of_last(both, value, 5, "recent_ipo_avg_return_sector", by=[sector], time=date, key=key, seeds_from=dealt).drop(timeline.SLICE)
    none = F.lit(None).cast("double")
    undated = rows.filter(F.col(date).isNull()).withColumns({"recent_ipo_avg_return_all": none, "recent_ipo_avg_return_sector": none})
    fallback = F.col("recent_ipo_avg_return_all")
    return own.unionByName(undated).withColumn("recent_ipo_avg_return_sector", F.when(F.col(sector).isNull(), fallback).otherwise(F.coalesce("recent_ipo_avg_return_sector", fallback)))
