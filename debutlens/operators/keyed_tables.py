"""Keyed table upkeep: each operator returns the table's next version as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pair(old: DataFrame, new: DataFrame, keys: list[str]):
    """Old and new rows by key. A key that new rows repeat is an error when the table is read: take the `latest` first."""
    once = new.groupBy(*keys).agg(F.first(F.struct(*[c for c in new.columns if c not in keys], F.lit(0))).alias("__v"), F.count(F.lit(1)).alias("__n"))
    told = F.when(F.col("__n") > 1, F.raise_error(F.lit("new rows repeat a key"))).otherwise(F.struct(*keys, *[F.col(f"__v.{c}").alias(c) for c in new.columns if c not in keys]))
    return old.select(*keys, F.struct("*").alias("__a")).join(once.select(*keys, told.alias("__b")), keys, "full")


def upsert_known(old: DataFrame, new: DataFrame, keys: list[str] = ["corp_code"], stamp: str | None = None) -> DataFrame:  # noqa: B006
    """Known new values win, NULL ones don't; new columns that the table lacks are ignored."""
    given = set(new.columns)
    value = lambda c: F.coalesce(F.col(f"__b.{c}"), F.col(f"__a.{c}")) if c in given else F.col(f"__a.{c}")
    out = _pair(old, new, keys).select(*keys, *[value(c).alias(c) for c in old.columns if c not in keys], F.col("__b").isNotNull().alias("__new"))
    if stamp:
        out = out.withColumn(stamp, F.when(F.col("__new"), F.current_timestamp()).otherwise(F.col(stamp)))
    return out.drop("__new").select(*old.columns)


def upsert_given(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Columns that the new rows bring overwrite, NULL or not; others stay."""
    given = set(new.columns)
    value = lambda c: F.when(F.col("__b").isNotNull(), F.col(f"__b.{c}")).otherwise(F.col(f"__a.{c}")) if c in given else F.col(f"__a.{c}")
    return _pair(old, new, keys).select(*keys, *[value(c).alias(c) for c in old.columns if c not in keys]).select(*old.columns)


def resolve(predictions: DataFrame, actuals: DataFrame, key: str = "ipo_id") -> DataFrame:
    """Fills actual, error and direction of predictions whose outcome is known, and when that was (resolved_at, if not before)."""
    known = actuals.select(key, F.col("actual").alias("__y"))
    then = F.col("resolved_at") if "resolved_at" in predictions.columns else F.lit(None).cast("timestamp")
    out = predictions.withColumn("resolved_at", then).drop("actual", "error", "direction_correct").join(known, key, "left").withColumn("actual", F.col("__y"))
    out = out.withColumn("resolved_at", F.when(F.col("__y").isNotNull(), F.coalesce("resolved_at", F.current_timestamp())).otherwise(F.col("resolved_at")))
    return out.withColumns({"error": F.col("actual") - F.col("pred"), "direction_correct": (F.col("actual") > 0) == (F.col("pred") > 0)}).drop("__y")


def resolve_master(master: DataFrame, actuals: DataFrame, key: str = "ipo_id", column: str = "open_return_pct") -> DataFrame:
    """The master table with the returns that are known now."""
    return upsert_known(master, actuals.select(F.col(key).alias("id"), F.col("actual").alias(column)), ["id"])


def promote(registry: DataFrame, name: str, version: str) -> DataFrame:
    """Makes one model the only champion; fails if the registry lacks it."""
    target = (F.col("name") == name) & (F.col("version") == version)
    if registry.filter(target).isEmpty():
        raise ValueError(f"no model {name} {version}")
    status = F.when(target, "champion").when(F.col("is_champion"), "retired").otherwise(F.col("status"))
    return registry.withColumn("status", status).withColumn("is_champion", target)


def champion(registry: DataFrame) -> DataFrame:
    return registry.filter("is_champion").orderBy(F.desc("promoted_at"), "name", "version").limit(1)


def latest(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The newest record per key."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__r = 1").drop("__r")
