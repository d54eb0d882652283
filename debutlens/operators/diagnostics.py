"""Back-test metrics, error distribution, outliers and their causes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import asof_momentum
from .quantiles import exact_percentiles

#: Limits of the causes, hints and recommended features.
BEAR_20D, CRASH_5D, CROWDED_DAY, LOOSE_FLOAT, HOT_SECTOR, OLD_SHARES = -0.08, -0.04, 4, 0.6, 50.0, 0.5
CAUSES = [
    ("A_market", "KOSPI 20일 수익률 %.1f%% (약세장 구간)", ["kospi_momentum_60d", "bear_market_flag", "volatility_index"]),
    ("A_market", "상장 직전 KOSPI 급락 %.1f%%", ["kospi_momentum_5d_extreme_flag", "market_stress_flag"]),
    ("B_supply", "동일일 상장 %d개 (수급 분산)", ["same_day_ipo_count", "same_day_total_offer_size"]),
    ("B_supply", "유통 물량 과다 (%.0f%%)", ["float_share_ratio", "secondary_offering_ratio"]),
    ("C_sector", "섹터 평균 수익률 이상 (%.1f%%)", ["sector_heat_index", "recent_ipo_avg_return_sector"]),
    ("D_structure", "구주매출 과다 (%.0f%%)", ["secondary_offering_ratio", "vc_exit_flag"]),
    ("E_unknown", "명확한 패턴 없음", []),
]
OVERSHOOT = " | 방향 예측 오류"
RECOMMENDED = {
    "A_market": ["kospi_momentum_60d (60일 장기 모멘텀 — 약세장 국면 감지)", "bear_market_flag (KOSPI 20일 수익률 < -8% 이진 플래그)", "market_volatility_20d (20일 변동성 — 불확실성 환경 반영)"],
    "B_supply": ["same_day_ipo_count (동일 상장일 종목 수)", "same_day_total_market_cap (동일일 공모 총 시총 — 수급 희소성)", "float_share_ratio (유통 물량 비율 — Phase 2 우선 추가)"],
    "C_sector": ["sector_heat_index (섹터 최근 30일 IPO 평균 수익률)", "sector_ipo_frequency (섹터 IPO 빈도 — 과열 감지)"],
    "D_structure": ["secondary_offering_ratio (구주매출 비율 — Phase 2 우선 추가)", "vc_backed_flag (VC 투자 기업 여부)", "audit_firm_tier (회계법인 등급)"],
}

#: The context of a listing that causes look at, beside the index.
CONTEXT = ("same_day_ipo_count", "float_share_ratio", "recent_ipo_avg_return_sector", "secondary_offering_ratio")


def mae() -> Column:
    return F.avg(F.abs(F.col("actual") - F.col("pred")))


def same_side() -> Column:
    return F.avg(((F.col("actual") > 0) == (F.col("pred") > 0)).cast("double"))


def within(low: str, high: str) -> Column:
    return F.avg(F.col("actual").between(F.col(low), F.col(high)).cast("double"))


def overall_metrics(predictions: DataFrame, distinct_latest: bool = False) -> DataFrame:
    """One row over all predictions; `distinct_latest` counts a listing once, by its latest window."""
    if distinct_latest:
        best = predictions.groupBy("listing_id").agg(F.max("window").alias("window"))
        predictions = predictions.join(best, ["listing_id", "window"], "left_semi")
    return predictions.agg(F.round(mae(), 3).alias("mae"), F.round(same_side(), 4).alias("direction_acc"), F.round(within("ci_90_low", "ci_90_high"), 4).alias("coverage_90"), F.countDistinct("window").alias("n_windows"), F.count(F.lit(1)).alias("n"))


def window_metrics(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("window").agg(F.round(mae(), 4).alias("mae"), F.round(same_side(), 4).alias("direction_acc"), F.round(within("ci_90_low", "ci_90_high"), 4).alias("coverage_90"), F.round(within("ci_50_low", "ci_50_high"), 4).alias("coverage_50"), F.round(F.avg(F.when(F.col("pred") > 0, F.col("actual"))), 4).alias("mean_if_up"), F.count(F.lit(1)).alias("n"))


def metrics_by(predictions: DataFrame, **keys: Column) -> DataFrame:
    """n, mae, direction, means of actual and predicted values by the given keys (year, quarter, ...)."""
    return predictions.withColumns(keys).groupBy(*keys).agg(F.count("actual").alias("n"), F.round(mae(), 4).alias("mae"), F.round(same_side(), 4).alias("direction_acc"), F.round(F.avg("actual"), 4).alias("actual_mean"), F.round(F.avg("pred"), 4).alias("pred_mean"))


def error_pattern(predictions: DataFrame, literal_direction: bool = False) -> DataFrame:
    """By year and quarter. `literal_direction` compares error + actual with actual instead of the prediction."""
    error = F.col("actual") - F.col("pred")
    right = ((error + F.col("actual")) if literal_direction else (F.col("actual") - error)) * F.col("actual") > 0
    rows = predictions.withColumns({"year": F.year("listing_date"), "quarter": F.quarter("listing_date"), "e": F.abs(error), "right": right.cast("double")})
    return rows.groupBy("year", "quarter").agg(F.count("e").alias("n"), F.round(F.avg("e"), 4).alias("mae"), F.round(F.avg("right"), 4).alias("direction_acc"))


def with_sigma(predictions: DataFrame) -> DataFrame:
    """Adds error_sigma: the absolute error over the sample deviation of all absolute errors (one broadcast row)."""
    e = predictions.withColumn("abs_error", F.abs(F.col("actual") - F.col("pred"))).withColumn("error", F.col("actual") - F.col("pred"))
    sigma = e.agg(F.stddev_samp("abs_error").alias("sigma"))
    return e.join(F.broadcast(sigma)).withColumn("error_sigma", F.coalesce(F.when(F.col("sigma") > 0, F.col("abs_error") / F.col("sigma")), F.lit(0.0)))


def error_distribution(predictions: DataFrame) -> DataFrame:
    """One row; of an empty table counts are 0 and all else is NULL."""
    e = with_sigma(predictions).filter(F.col("abs_error").isNotNull())
    x = F.col("abs_error")
    share = lambda c: F.round(F.try_divide(100 * F.count_if(c), F.count(F.lit(1))), 4)
    middle = exact_percentiles(predictions.select(F.abs(F.col("actual") - F.col("pred")).alias("e")), "e", {"median": 0.5, "p90": 0.9})
    counted = e.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(x), 4).alias("mean"), F.round(F.stddev_samp(x), 4).alias("std"),
        share(F.col("error_sigma") < 1).alias("within_1_sigma_pct"), share(F.col("error_sigma") < 2).alias("within_2_sigma_pct"), F.count_if(F.col("error_sigma") >= 2).alias("n_beyond_2_sigma"),
        F.count_if(x < 5).alias("e_0_5"), F.count_if((x >= 5) & (x < 10)).alias("e_5_10"), F.count_if((x >= 10) & (x < 20)).alias("e_10_20"), F.count_if((x >= 20) & (x < 30)).alias("e_20_30"), F.count_if(x >= 30).alias("e_30_up"),
    )
    rest = [c for c in counted.columns if c not in ("n", "mean", "std")]
    return counted.crossJoin(F.broadcast(middle)).select("n", "mean", F.round("median", 4).alias("median"), "std", F.round("p90", 4).alias("p90"), *rest)  # two tables of one row


def conformal_quantiles(residuals: DataFrame) -> DataFrame:
    q = exact_percentiles(residuals.select(F.abs(F.col("actual") - F.col("pred")).alias("e")), "e", {"q50": 0.5, "q90": 0.9})
    return q.select(F.round("q50", 6).alias("q50"), F.round("q90", 6).alias("q90"))


def risk_grade() -> Column:
    width = F.col("ci_90_high") - F.col("ci_90_low")
    return F.when((width < 30) & (F.col("up_prob") > 0.65), "A").when((width < 60) & (F.col("up_prob") > 0.5), "B").otherwise("C")


def outliers(predictions: DataFrame, sigmas: float = 2.0, points: float = 15.0) -> DataFrame:
    return with_sigma(predictions).filter((F.col("error_sigma") >= sigmas) & (F.col("abs_error") >= points))


def with_listing_context(predictions: DataFrame, context: DataFrame, key: str = "listing_id") -> DataFrame:
    """Predictions with the context columns of their listings that causes look at; those already there give way."""
    own = [c for c in CONTEXT if c in context.columns]
    return predictions.drop(*own).join(context.select(key, *own), key, "left")


def with_index_context(rows: DataFrame, index: DataFrame, code: str = "KOSPI", date: str = "listing_date") -> DataFrame:
    """Adds kospi_mom_5d, 20d and 60d: the index's momentum at the newest session before each row's date."""
    out = asof_momentum(rows, index, code, "__index", date=date)
    return out.withColumnsRenamed({f"__index_momentum_{n}d": f"kospi_mom_{n}d" for n in (5, 20, 60)})


def with_cause(rows: DataFrame) -> DataFrame:
    """Adds cause, cause_detail, feature_hint, overshoot and direction_wrong. Unknown context matches no cause."""
    have = set(rows.columns)
    c = lambda n: F.col(n) if n in have else F.lit(None).cast("double")
    m20, m5, crowd, free, heat, old = (c(n) for n in ("kospi_mom_20d", "kospi_mom_5d", *CONTEXT))

    def told(place: int, *args):
        cause, text, hints = CAUSES[place]
        return F.struct(F.lit(cause).alias("cause"), (F.format_string(text, *args) if args else F.lit(text)).alias("detail"), F.array(*map(F.lit, hints)).alias("hints"))

    cause = (
        F.when(m20 < BEAR_20D, told(0, m20 * 100))
        .when(m5 < CRASH_5D, told(1, m5 * 100))
        .when(crowd >= CROWDED_DAY, told(2, crowd.cast("int")))
        .when(free > LOOSE_FLOAT, told(3, free * 100))
        .when(F.abs(heat) > HOT_SECTOR, told(4, heat.cast("double")))
        .when(old > OLD_SHARES, told(5, old * 100))
        .otherwise(told(6))
    )
    over = F.coalesce(F.col("error") * F.col("actual") < 0, F.lit(False))
    out = rows.withColumn("__c", cause).withColumns({"overshoot": over, "direction_wrong": F.coalesce(F.col("pred") * F.col("actual") < 0, F.lit(False))})
    detail = F.concat(F.col("__c.detail"), F.when(F.col("overshoot"), OVERSHOOT).otherwise(""))
    return out.withColumns({"cause": F.col("__c.cause"), "cause_detail": detail, "feature_hint": F.col("__c.hints")}).drop("__c")


def cause_counts(causes: DataFrame) -> DataFrame:
    return causes.groupBy("cause").agg(F.count(F.lit(1)).alias("n"))


def recommendations(causes: DataFrame, share: float = 0.30) -> DataFrame:
    """Suggestions for causes of at least `share` of the outliers, each feature once: rank, cause, suggestion."""
    from pyspark.sql import Window

    spark = causes.sparkSession
    rules = spark.createDataFrame([(c, i, s) for c, x in RECOMMENDED.items() for i, s in enumerate(x)], "cause string, place int, suggestion string")
    counts = cause_counts(causes)
    total = counts.agg(F.sum("n").alias("total"))
    kept = counts.join(F.broadcast(total)).filter(F.col("n") >= share * F.col("total"))
    order = Window.orderBy(F.desc("n"), "cause", "place")  # a few rules
    listed = kept.join(F.broadcast(rules), "cause").withColumn("k", F.row_number().over(order)).withColumn("token", F.substring_index("suggestion", " ", 1))
    first = Window.partitionBy("token").orderBy("k")
    return listed.withColumn("r", F.row_number().over(first)).filter("r = 1").select(F.row_number().over(Window.orderBy("k")).alias("rank"), "cause", "suggestion")


def run_summary(predictions: DataFrame) -> DataFrame:
    flagged = with_sigma(predictions).agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("error_sigma") >= 2) & (F.col("abs_error") >= 15)).alias("n_outliers"), F.countDistinct("window").alias("n_windows"))
    return flagged.select("n", "n_outliers", "n_windows", F.round(F.coalesce(F.try_divide("n_outliers", "n"), F.lit(0.0)), 6).alias("outlier_rate"))


def run_report(predictions: DataFrame, causes: DataFrame) -> DataFrame:
    """One nested row: backtest (overall metrics), by_year (array), outliers (counts, rate, causes as a map)."""
    years = metrics_by(predictions, year=F.year("listing_date")).agg(F.array_sort(F.collect_list(F.struct("year", "n", "mae", "direction_acc"))).alias("by_year"))
    summary = run_summary(predictions).select(F.struct("n_outliers", "outlier_rate").alias("o"))
    counted = cause_counts(causes).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cause", "n")))).alias("causes"))
    backtest = overall_metrics(predictions).select(F.struct("*").alias("backtest"))
    joined = backtest.crossJoin(years).crossJoin(summary).crossJoin(counted)  # one row each
    return joined.select("backtest", "by_year", F.struct("o.n_outliers", "o.outlier_rate", "causes").alias("outliers"))
