"""The feature catalog, and the imputer that it drives."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import number_of
from .quantiles import exact_percentiles, medians


@dataclass(frozen=True)
class Feature:
    name: str
    group: str
    importance: str
    dtype: str
    fill: str
    low: float | None = None
    high: float | None = None


#: Names, groups, importance, types, fill strategies and clip bounds of the features.
FEATURES = [
    Feature("institutional_demand_ratio", "subscription", "core", "float", "median", 0, 3000),
    Feature("retail_subscription_ratio", "subscription", "core", "float", "median", 0, 5000),
    Feature("lockup_6m_ratio", "supply", "core", "float", "zero", 0, 1),
    Feature("lockup_3m_ratio", "supply", "core", "float", "zero", 0, 1),
    Feature("lockup_1m_ratio", "supply", "core", "float", "zero", 0, 1),
    Feature("lockup_15d_ratio", "supply", "core", "float", "zero", 0, 1),
    Feature("lockup_weighted_score", "supply", "core", "float", "zero", 0, 1),
    Feature("offering_price_band_position", "valuation", "core", "float", "median", -0.5, 2.0),
    Feature("band_exceeded", "valuation", "core", "bool", "zero"),
    Feature("kospi_momentum_5d", "market", "core", "float", "zero", -0.2, 0.2),
    Feature("kospi_momentum_20d", "market", "core", "float", "zero", -0.3, 0.3),
    Feature("recent_ipo_avg_return_sector", "market", "core", "float", "mean", -0.5, 2.0),
    Feature("recent_ipo_avg_return_all", "market", "core", "float", "mean", -0.5, 2.0),
    Feature("float_share_ratio", "supply", "secondary", "float", "median", 0, 1),
    Feature("secondary_offering_ratio", "supply", "secondary", "float", "zero", 0, 1),
    Feature("major_shareholder_lockup_months", "supply", "secondary", "int", "median", 0, 36),
    Feature("same_day_ipo_count", "market", "secondary", "int", "zero", 0, 20),
    Feature("risk_factor_count", "ipo_structure", "secondary", "int", "median", 0, 60),
    Feature("underwriter_tier", "ipo_structure", "secondary", "int", "median", 1, 3),
    Feature("offering_per", "valuation", "secondary", "float", "median", 0, 500),
    Feature("per_vs_sector_median", "valuation", "secondary", "float", "median", 0, 10),
    Feature("revenue_growth_3y", "financial", "secondary", "float", "median", -0.5, 5.0),
    Feature("operating_margin", "financial", "secondary", "float", "median", -1.0, 1.0),
    Feature("debt_ratio", "financial", "secondary", "float", "median", 0, 10),
    Feature("kospi_momentum_60d", "market", "optional", "float", "zero", -0.5, 0.5),
    Feature("kosdaq_momentum_20d", "market", "optional", "float", "zero", -0.3, 0.3),
    Feature("news_mention_count_7d", "market", "optional", "int", "zero", 0, 500),
]
LEVELS = ("core", "secondary", "optional")


def features_upto(importance: str | None = None) -> list[Feature]:
    """Core is part of secondary, secondary of optional; none gives all."""
    return FEATURES if importance is None else [f for f in FEATURES if LEVELS.index(f.importance) <= LEVELS.index(importance)]


def catalog(spark: SparkSession, importance: str | None = None) -> DataFrame:
    rows = [(f.name, f.group, f.importance, f.dtype, f.fill, f.low, f.high) for f in features_upto(importance)]
    return spark.createDataFrame([(*r[:5], *(None if x is None else float(x) for x in r[5:])) for r in rows], "name string, group string, importance string, dtype string, fill_na string, clip_lo double, clip_hi double")


def catalog_summary(spark: SparkSession) -> DataFrame:
    return catalog(spark).groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("importance") == "core").alias("n_core"), F.array_sort(F.collect_list("name")).alias("names"))


def available(df: DataFrame, features: list[Feature]) -> tuple[list[str], list[str]]:
    """The features that the table has, in catalog order, and those that it lacks."""
    have = set(df.columns)
    return [f.name for f in features if f.name in have], [f.name for f in features if f.name not in have]


def coverage(df: DataFrame) -> DataFrame:
    """The catalog's rows with `available` (the table has the column) and n_values, its numbers; NULL where it lacks it."""
    here, _ = available(df, FEATURES)
    out = catalog(df.sparkSession)
    if not here:
        return out.withColumns({"available": F.lit(False), "n_values": F.lit(None).cast("long")})
    counts = df.agg(*[F.count(number_of(df, c)).alias(c) for c in here]).unpivot([], here, "name", "n_values")
    return out.join(F.broadcast(counts), "name", "left").withColumn("available", F.col("n_values").isNotNull())  # a row per feature


class FittedImputer:
    """Fill values by feature. `transform` is one projection: coerce, fill, clip (clipped before the fill too, it is the same)."""

    def __init__(self, features: list[Feature], fills: dict[str, float]):
        self.features, self.fills = features, fills

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        have, keep = set(df.columns), keep or []
        if not self.features:
            return df.select(*keep)
        values = [number_of(df, f.name) if f.name in have else F.lit(None).cast("double") for f in self.features]
        rules = [F.struct(F.lit(self.fills[f.name]).alias("fill"), *[F.lit(None if x is None else float(x)).cast("double").alias(c) for c, x in (("low", f.low), ("high", f.high))]) for f in self.features]
        # one expression for all features: as many as there are features make a method too long for Java to compile
        made = F.zip_with(F.array(*values), F.array(*rules), lambda v, r: F.least(F.greatest(F.coalesce(v, r["fill"]), r["low"]), r["high"]))  # a NULL bound is none
        return df.select(*keep, made.alias("__made")).select(*keep, *[F.col("__made")[i].alias(f.name) for i, f in enumerate(self.features)])

    def save(self, path: str) -> None:
        """The fill values as a small table; the features come from the catalog."""
        spark = SparkSession.active()
        spark.createDataFrame([(f.name, self.fills[f.name]) for f in self.features], "name string, fill double").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedImputer:
        fills = {r["name"]: r["fill"] for r in spark.read.parquet(path).collect()}  # a row per feature
        return cls([f for f in FEATURES if f.name in fills], fills)


class Imputer:
    """Fits one fill value per feature, of the values before clipping.

    A column without any value takes the middle of its clip range if it is filled by the median and the range
    starts above zero, else 0; an absent column takes 0.
    """

    def __init__(self, features: list[Feature] | None = None):
        self.features = features or FEATURES

    def fit(self, df: DataFrame) -> FittedImputer:
        here = [f for f in self.features if f.name in set(df.columns) and f.fill != "zero"]
        means = [f.name for f in here if f.fill == "mean"]
        values = df.select(*[number_of(df, f.name).alias(f.name) for f in here]) if here else df
        row = medians(values, [f.name for f in here if f.fill == "median"])
        row |= values.agg(*[F.avg(c).alias(c) for c in means]).first().asDict() if means else {}
        fills = {}
        for f in self.features:
            value = row[f.name] if f in here else 0.0
            if value is None:
                value = (f.low + f.high) / 2 if f.fill == "median" and f.low is not None and f.low > 0 else 0.0
            fills[f.name] = float(value)
        return FittedImputer(self.features, fills)


def feature_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: count, mean, std, min, quartiles, max, and the shares of missing and zero values in percent."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "feature", "value")
    quartiles = exact_percentiles(long, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["feature"])
    out = long.groupBy("feature").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), F.count(F.lit(1)).alias("all"), F.count_if(F.col("value") == 0).alias("zeros"))
    share = lambda c: F.round(100 * c / F.col("all"), 2)
    out = out.join(F.broadcast(quartiles), "feature", "left")  # a row per feature
    return out.select("feature", "n", "mean", "std", "min", "p25", "p50", "p75", "max", share(F.col("all") - F.col("n")).alias("missing_pct"), share(F.col("zeros")).alias("zero_pct"))
