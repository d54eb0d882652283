"""Readers and sinks of the canonical tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import clean_name, conform, day, is_equity_title, number

#: The columns of the canonical tables.
SCHEMAS = {
    "ipo_master": "id long, corp_code string, corp_name string, ticker string, market string, sector_code string, sector_name string, rcept_no string, demand_start timestamp, demand_end timestamp, sub_start timestamp, sub_end timestamp, listing_date timestamp, price_band_low long, price_band_high long, offering_price long, new_shares long, secondary_shares long, total_shares_post long, lead_underwriter string, open_price double, close_price double, open_return double, close_return double, created_at timestamp, updated_at timestamp",
    "ipo_features": "id long, ipo_id long, institutional_demand_ratio double, retail_subscription_ratio double, lockup_6m_ratio double, lockup_3m_ratio double, lockup_1m_ratio double, lockup_15d_ratio double, lockup_weighted_score double, offering_price_band_position double, band_exceeded boolean, kospi_momentum_5d double, kospi_momentum_20d double, recent_ipo_avg_return_sector double, recent_ipo_avg_return_all double, float_share_ratio double, secondary_offering_ratio double, major_shareholder_lockup_months int, same_day_ipo_count int, risk_factor_count int, underwriter_tier int, offering_per double, per_vs_sector_median double, revenue_growth_3y double, operating_margin double, debt_ratio double, kospi_momentum_60d double, kosdaq_momentum_20d double, bear_market_flag boolean, news_mention_count_7d int, financial_attractiveness double, attractiveness_grade string, feature_version string, computed_at timestamp",
    "filings_raw": "rcept_no string, corp_code string, corp_name string, report_nm string, rcept_dt date, html string",
    "accounts_long": "corp_code string, year int, account string, amount double",
    "listing_calendar": "ticker string, corp_name string, listing_date date, market string, sector_name string, same_day_ipo_count long",
    "listing_prices": "ticker string, listing_date date, open_price double, close_price double, high_price double, low_price double, volume double",
    "index_close": "index_code string, date date, close double",
    "ipo_predictions": "listing_id long, listing_date date, corp_name string, actual double, offering_price long, pred double, up_prob double, ci_90_low double, ci_90_high double, ci_50_low double, ci_50_high double, risk_grade string, error double, abs_error double, window int",
    "offerings": "rcept_no string, price_band_low long, price_band_high long, offering_price long, new_shares long, secondary_shares long, total_post_listing_shares long, lead_underwriter string, listing_date date, major_shareholder_lockup_months int, risk_factor_count int, parse_success boolean",
    "demand": "rcept_no string, institutional_demand_ratio double, lockup_6m_ratio double, lockup_3m_ratio double, lockup_1m_ratio double, lockup_15d_ratio double, lockup_none_ratio double, parse_success boolean",
    "model_registry": "name string, version string, mae double, direction_acc double, coverage_90 double, hyperparams map<string, string>, feature_names array<string>, status string, is_champion boolean, promoted_at timestamp, retired_at timestamp",
    "backtest_results": "model_name string, model_version string, window_num int, train_end date, valid_end date, n_train long, n_valid long, mae double, direction_acc double, coverage_90 double",
    "outlier_log": "ipo_id long, corp_name string, listing_date date, actual double, pred double, abs_error double, error_sigma double, cause string, cause_detail string, feature_hint array<string>, resolved boolean",
    "data_quality_log": "source string, check_name string, status string, detail string, n_records long, checked_at timestamp",
}
#: Account ids of statements and their names.
ACCOUNTS = {
    "ifrs-full_Revenue": "revenue", "dart_OperatingIncomeLoss": "operating_income", "ifrs-full_ProfitLoss": "net_income", "ifrs-full_Assets": "total_assets",
    "ifrs-full_Liabilities": "total_liabilities", "ifrs-full_Equity": "equity", "ifrs-full_BasicEarningsLossPerShare": "eps",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A Parquet table in its canonical schema; fails if the path is absent."""
    return conform(spark.read.parquet(path), schema(name))


def read_pages(spark: SparkSession, path: str, field: str, row: str, lines: bool = False) -> DataFrame:
    """Landed JSON pages whose array `field` holds flat objects of the DDL `row`: one row per object.

    A file is one page, however laid out; with `lines` it holds a page per line, so that large files are split. A page
    that isn't JSON, or has no such array, gives no row.
    """
    pages = spark.read.schema(f"{field} array<struct<{row}>>").option("multiLine", not lines).json(path)
    return pages.select(F.inline(field))


#: The columns of a landed page of the listing calendar, and their canonical names.
CALENDAR_PAGE = {"ISU_CD": "ticker", "ISU_ABBRV": "corp_name", "LIST_DD": "listing_date", "MKT_TP_NM": "market", "SECT_TP_NM": "sector_name"}


def landed_calendar(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The listing calendar of landed pages, in its canonical columns, with the number of listings of each day."""
    raw = read_pages(spark, path, "output", ", ".join(f"{c} string" for c in CALENDAR_PAGE), lines).withColumnsRenamed(CALENDAR_PAGE)
    dated = raw.withColumn("listing_date", F.coalesce(day(F.col("listing_date"), "yyyy/MM/dd"), day(F.col("listing_date"), "yyyy-MM-dd")))
    crowd = dated.filter("listing_date is not null").groupBy("listing_date").agg(F.count(F.lit(1)).alias("same_day_ipo_count"))
    return conform(dated.join(crowd, "listing_date", "left"), schema("listing_calendar"))


def filings(raw: DataFrame) -> DataFrame:
    """Equity filings of a landed list."""
    dated = raw.filter(is_equity_title(F.col("report_nm"))).withColumn("rcept_dt", day(F.col("rcept_dt")))
    return conform(dated, schema("filings_raw"))


def not_yet(batch: DataFrame, done: DataFrame, key: str = "rcept_no") -> DataFrame:
    """Rows of a batch whose key isn't among those done."""
    return batch.join(done.select(key).distinct(), key, "left_anti")


def append_new(batch: DataFrame, path: str, key: str = "rcept_no") -> None:
    """Appends what isn't stored yet; the first call creates the table. Partitioned by year of receipt.

    For one writer at a time; `versions.VersionedTable.append` commits a batch once, whoever else writes.
    """
    spark = batch.sparkSession
    try:
        batch = not_yet(batch, spark.read.parquet(path), key)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    batch.withColumn("year", F.year("rcept_dt")).write.mode("append").partitionBy("year").parquet(path)


def index_series(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.when(F.col("index_code") == "1", "KOSPI").otherwise("KOSDAQ").alias("index_code"),
        day(F.col("date"), "yyyy/MM/dd").alias("date"),
        number(F.col("close")).alias("close"),
    )


def statement_amounts(raw: DataFrame) -> DataFrame:
    """Long accounts of statements; consolidated ones where a company's year (and report) has them, else separate ones."""
    from pyspark.sql import Window

    rank = F.when(F.col("fs_div") == "CFS", 0).otherwise(1)
    report = [c for c in ("reprt_code",) if c in raw.columns]
    best = F.min(rank).over(Window.partitionBy("corp_code", "year", *report))
    name = F.create_map(*[F.lit(x) for kv in ACCOUNTS.items() for x in kv])[F.col("account_id")]
    picked = raw.withColumn("best", best).filter(rank == F.col("best"))
    return picked.select("corp_code", "year", name.alias("account"), number(F.col("thstrm_amount")).alias("amount")).dropna()


#: The columns of the outlier file.
OUTLIER_COLUMNS = ("corp_name", "listing_date", "actual", "pred", "error", "sigma", "cause", "cause_detail", "feature_hint")


def write_outliers_csv(outliers: DataFrame, path: str) -> None:
    """The nine columns of the outlier file, hints in one field."""
    outliers.withColumn("sigma", F.col("error_sigma")).withColumn("feature_hint", F.concat_ws("|", "feature_hint")).select(*OUTLIER_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> None:
    """A canonical table's Parquet: its columns and types, whatever else `df` holds. Logs are appended to."""
    conform(df, schema(name)).write.mode(mode).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """The nested summary of a run as JSON, one object in one file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def backfill(raw: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Equity filings received in the years from the first to the last."""
    return filings(raw).filter(F.year("rcept_dt").between(first_year, last_year))


def quality_log(statistics: DataFrame, source: str, most_missing_pct: float = 50.0) -> DataFrame:
    """Feature statistics as rows of the quality log: a feature fails without values and warns past so many missing."""
    status = F.when(F.col("n") == 0, "fail").when(F.col("missing_pct") > most_missing_pct, "warn").otherwise("pass")
    detail = F.format_string("missing %.2f%%, zero %.2f%%", F.coalesce("missing_pct", F.lit(100.0)), F.coalesce("zero_pct", F.lit(0.0)))
    return conform(statistics.select(F.lit(source).alias("source"), F.col("feature").alias("check_name"), status.alias("status"), detail.alias("detail"), F.col("n").alias("n_records"), F.current_timestamp().alias("checked_at")), schema("data_quality_log"))


def calendar(raw: DataFrame) -> DataFrame:
    return raw.withColumn("listing_date", day(F.col("listing_date"), "yyyy/MM/dd")).withColumn("corp_name_clean", clean_name(F.col("corp_name")))
