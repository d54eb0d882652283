"""Batch scoring: requests are validated, completed, scored and logged as tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import band_exceeded, lockup_weighted_score
from .keyed_tables import upsert_given
from .quantiles import medians

#: Required fields, allowed ranges and the defaults of absent core fields.
REQUIRED = ("institutional_demand_ratio", "lockup_6m_ratio", "offering_price_band_position")
RANGES = {
    "institutional_demand_ratio": (0, 3000), "lockup_6m_ratio": (0, 1), "lockup_3m_ratio": (0, 1), "lockup_1m_ratio": (0, 1), "lockup_15d_ratio": (0, 1), "retail_subscription_ratio": (0, None),
    "float_share_ratio": (0, 1), "secondary_offering_ratio": (0, 1), "major_shareholder_lockup_months": (0, None), "same_day_ipo_count": (0, None), "risk_factor_count": (0, None), "underwriter_tier": (1, 3),
    "offering_per": (0, None), "per_vs_sector_median": (0, None), "debt_ratio": (0, None),
}
DEFAULTS = {"retail_subscription_ratio": 0.0, "lockup_3m_ratio": 0.0, "lockup_1m_ratio": 0.0, "lockup_15d_ratio": 0.0, "kospi_momentum_5d": 0.0, "kospi_momentum_20d": 0.0, "recent_ipo_avg_return_sector": 10.0, "recent_ipo_avg_return_all": 10.0}


def validate(requests: DataFrame) -> DataFrame:
    """Adds violations: the names of broken rules; a request without any is accepted."""
    have = set(requests.columns)
    rules = [F.when(F.col(c).isNull() if c in have else F.lit(True), f"{c} required") for c in REQUIRED]
    for c, (low, high) in RANGES.items():
        if c in have:
            bad = (F.col(c) < low) | (F.col(c) > high if high is not None else F.lit(False))
            rules.append(F.when(bad, f"{c} out of range"))
    return requests.withColumn("violations", F.array_compact(F.array(*rules)))


def complete(requests: DataFrame, features: list[str], fill_mode: str = "zero", imputer=None, keep: list[str] | None = None) -> DataFrame:
    """Accepted requests as model input: defaults, derived columns, and fills by `zero`, by the `median` of the batch's
    known values, or by the fitted `catalog` imputer."""
    have = set(requests.columns)
    rows = requests.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in have else F.lit(v) for c, v in DEFAULTS.items()})
    rows = rows.withColumns({"lockup_weighted_score": lockup_weighted_score(), "band_exceeded": band_exceeded(F.col("offering_price_band_position"))})
    if fill_mode == "catalog":
        return imputer.transform(rows, keep)
    here = [c for c in features if c in rows.columns]
    middle = medians(rows, here) if fill_mode == "median" else {}
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(middle.get(c) or 0.0)) if c in here else F.lit(0.0)
    return rows.select(*(keep or []), *[value(c).alias(c) for c in features])


def one_batch(*requests: DataFrame) -> DataFrame:
    """All requests as one table; columns that some lack are NULL there."""
    out = requests[0]
    for more in requests[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def score_batch(requests: DataFrame, predict: Callable[[DataFrame], DataFrame], features: list[str], *, key: str = "ipo_id", fill_mode: str = "zero", imputer=None) -> tuple[DataFrame, DataFrame]:
    """Scored rows of the accepted requests (model output and weighted_score), and the rejected ones with their violations."""
    judged = validate(requests)
    accepted, rejected = judged.filter(F.size("violations") == 0), judged.filter(F.size("violations") > 0)
    scored = predict(complete(accepted, features, fill_mode, imputer, [key]))
    weighted = complete(accepted, ["lockup_weighted_score"], keep=[key]).select(key, F.round("lockup_weighted_score", 3).alias("weighted_score"))
    return scored.join(weighted, key), rejected.select(key, "violations")


def log_predictions(log: DataFrame, scored: DataFrame, name: str, version: str, key: str = "ipo_id") -> DataFrame:
    """The log's next version: one row per listing, model and version, newer ones overwrite."""
    rows = scored.withColumns({"model_name": F.lit(name), "model_version": F.lit(version)})
    return upsert_given(log, rows.select(*[c for c in log.columns if c in rows.columns]), [key, "model_name", "model_version"])
