"""Registered jobs over tables: imputation, scoring and its log, master tables, reports and their files, back-tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import catalog, diagnostics, joins, model, scoring
from ..sources import tables
from ..sources.store import scratch, stored
from . import proxies as P
from .filings import DIGITS
from .queries import CAUSES, MODEL_FEATURES, OFFER_SQL, caused, model_rows, offer_rows, query

WIDE = catalog.features_upto("secondary")


def raw_value(i: int, f: catalog.Feature) -> str:
    """A column of a feature, in either SQL: some values missing, some outside the clip range."""
    low, high = (-2.0, 3.0) if f.low is None else (float(f.low), float(f.high))
    return f"CASE WHEN (listing_id + {i}) % {i % 5 + 3} > 0 THEN {low} + ((listing_id * {7 + 2 * i}) % {101 + i} - 8) * {high - low} / 8e1 END"


def raw_column(i: int, f: catalog.Feature):
    """The column of `raw_value`, whose decimal steps are whole tenths here: one division rounds as the decimal's cast does."""
    low, high = (-2.0, 3.0) if f.low is None else (float(f.low), float(f.high))
    key, tenths = F.col("listing_id"), round(10 * (high - low))
    assert f"{high - low}" == f"{tenths / 10}"
    value = F.lit(low) + ((key * (7 + 2 * i)) % (101 + i) - 8) * tenths / F.lit(10.0) / F.lit(80.0)
    return F.when((key + i) % (i % 5 + 3) > 0, value).cast("double").alias(f.name)


def wide_rows(spark, d) -> DataFrame:
    """All columns of `raw_value`, made where they are read; the stored table has keys alone.

    Stored, for one generated method can't hold the offers' aggregate and all columns made from it; in as many files as the
    session has shuffle partitions, for a few bytes a row would make few of them, and so few tasks of all that work.
    """
    keys = P.offers(spark, d).select("listing_id").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "listing_id")
    return stored(keys, "offers").select("listing_id", *[raw_column(i, f) for i, f in enumerate(WIDE)])


def imputed_sql() -> str:
    out = []
    for f in WIDE:
        fill = {"mean": f"(SELECT avg({f.name}) FROM w)", "median": f"(SELECT median({f.name}) FROM w)", "zero": "0.0"}[f.fill]
        value = f"coalesce({f.name}, {fill})"
        out.append(f"round({value if f.low is None else f'least({f.high}, greatest({f.low}, {value}))'}, 5)::DOUBLE AS {f.name}")
    made = ", ".join(f"({raw_value(i, f)})::DOUBLE AS {f.name}" for i, f in enumerate(WIDE))
    return f", w AS (SELECT listing_id, {made} FROM p_offer) SELECT listing_id, {', '.join(out)} FROM w"


@query(imputed_sql())
def imputed_catalog(spark, d):
    """All core and secondary features, filled and clipped by a stored imputer."""
    rows = wide_rows(spark, d)
    path = scratch(spark, "imputer")
    catalog.Imputer(WIDE).fit(rows).save(path)
    out = catalog.FittedImputer.load(spark, path).transform(rows, ["listing_id"])
    return out.select("listing_id", *[F.round(f.name, 5).alias(f.name) for f in WIDE])


@query(OFFER_SQL + """
, u AS (UNPIVOT (SELECT sc AS lockup_weighted_score, pos AS offering_price_band_position, sec AS secondary_offering_ratio FROM o) ON lockup_weighted_score, offering_price_band_position, secondary_offering_ratio INTO NAME feature VALUE v),
  c AS (SELECT feature, count(v)::BIGINT AS n, (SELECT count(*) FROM o) AS a, count(*) FILTER (v = 0) AS z FROM u GROUP BY 1)
SELECT 'offers' AS source, feature AS check_name, CASE WHEN n = 0 THEN 'fail' WHEN round(100.0 * (a - n) / a, 2) > 5 THEN 'warn' ELSE 'pass' END AS status, printf('missing %.2f%%, zero %.2f%%', round(100.0 * (a - n) / a, 2), round(100.0 * z / a, 2)) AS detail, n AS n_records FROM c
""")
def data_quality_log(spark, d):
    """Statistics of features, appended to the quality log and read from it."""
    stats = catalog.feature_statistics(offer_rows(spark, d), ["lockup_weighted_score", "offering_price_band_position", "secondary_offering_ratio"])
    path = scratch(spark, "quality-log")
    tables.write_table(tables.quality_log(stats, "offers", 5.0), path, "data_quality_log", "append")
    return tables.read_table(spark, path, "data_quality_log").drop("checked_at")


def linear_scores(rows: DataFrame) -> DataFrame:
    """A model of plain arithmetic, finished as the trees' predictions are."""
    pred = F.col("offering_price_band_position") * 64 - F.col("lockup_weighted_score") * 8
    scored = rows.withColumns({"__pred": pred, "up_prob": F.round(F.col("offering_price_band_position"), 4)})
    return model.finished(scored, 5.25, 12.5).drop("__pred")


SCORED = ["offering_price_band_position", "lockup_weighted_score", "institutional_demand_ratio"]


@query(OFFER_SQL + f"""
, r AS (SELECT *, pos * 64 - sc * 8 AS p FROM o WHERE lockup_6m_ratio IS NOT NULL AND coalesce(2 * sec, 0) <= 1)
SELECT listing_id AS ipo_id, 'linear' AS model_name, '2' AS model_version, {DIGITS.format("p", 2)} AS pred, {DIGITS.format("p + 12.5", 2)} AS ci_90_high, {DIGITS.format("p - 5.25", 2)} AS ci_50_low,
  {DIGITS.format("sc", 3)} AS weighted_score, CASE WHEN pos >= 0.65005 THEN 'A' WHEN pos >= 0.50005 THEN 'B' ELSE 'C' END AS risk_grade FROM r
UNION ALL SELECT listing_id, 'linear', '1', 0.0, 1.0, -1.0, NULL, 'C' FROM p_offer
""")
def scored_requests(spark, d):
    """Two lots of requests scored as one batch and logged beside an older version's predictions, in part logged before."""
    rows = offer_rows(spark, d).select(F.col("listing_id").alias("ipo_id"), "institutional_demand_ratio", "lockup_6m_ratio", "lockup_3m_ratio", "lockup_1m_ratio", "lockup_15d_ratio", "offering_price_band_position", (F.col("secondary_offering_ratio") * 2).alias("secondary_offering_ratio"))
    batch = scoring.one_batch(rows.filter("ipo_id % 2 = 0"), rows.filter("ipo_id % 2 = 1"))
    scored, _ = scoring.score_batch(batch, linear_scores, SCORED)
    before = P.offers(spark, d).select(F.col("listing_id").alias("ipo_id"), F.lit("linear").alias("model_name"), F.lit("1").alias("model_version"), F.lit(0.0).alias("pred"), F.lit(1.0).alias("ci_90_high"), F.lit(-1.0).alias("ci_50_low"), F.lit(None).cast("double").alias("weighted_score"), F.lit("C").alias("risk_grade"))
    again = before.join(scored.filter("ipo_id % 3 = 0").select("ipo_id"), "ipo_id", "left_semi").withColumn("model_version", F.lit("2")).select(before.columns)
    return scoring.log_predictions(before.union(again), scored, "linear", "2")


@query("""
SELECT c.c_custkey AS ipo_id, f.revenue_t0, count(p.listing_id)::BIGINT AS n_predictions, round(avg(p.actual), 4) AS mean_actual
FROM customer c LEFT JOIN (SELECT corp_code, revenue_t0 FROM p_fin WHERE corp_code % 4 > 0) f ON c.c_custkey = f.corp_code LEFT JOIN p_pred p ON p.corp_name = c.c_custkey::VARCHAR GROUP BY 1, 2
""")
def master_with_predictions(spark, d):
    """Companies with their features, absent for a quarter, and any number of predictions."""
    master = P.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    own = P.financials(spark, d).filter("corp_code % 4 > 0").select(F.col("corp_code").alias("ipo_id"), "revenue_t0")
    predicted = P.predictions(spark, d).select(F.col("corp_name").cast("long").alias("ipo_id"), "listing_id", "actual")
    out = joins.master_with(master, own, predicted)
    return out.groupBy("ipo_id", "revenue_t0").agg(F.count("listing_id").alias("n_predictions"), F.round(F.avg("actual"), 4).alias("mean_actual"))


@query(CAUSES + """SELECT corp_name, listing_date, round(actual, 4) AS actual, round(pred, 4) AS pred, round(error, 4) AS error, round(error_sigma, 3) AS sigma, cause, error * actual < 0 AS overshoot FROM k""")
def outlier_file(spark, d):
    """The outlier file, read again; the suffix of its details tells overshoots."""
    path = scratch(spark, "outliers")
    tables.write_outliers_csv(caused(spark, d), path)
    names = "corp_name string, listing_date date, actual double, pred double, error double, sigma double, cause string, cause_detail string, feature_hint string"
    rows = spark.read.schema(names).option("header", True).csv(path)
    r = lambda c, n: F.round(c, n).alias(c)
    return rows.select("corp_name", "listing_date", r("actual", 4), r("pred", 4), r("error", 4), r("sigma", 3), "cause", F.contains("cause_detail", F.lit(diagnostics.OVERSHOOT)).alias("overshoot"))


@query(CAUSES + """
, t AS (SELECT count(*) AS n, count(*) FILTER (e / s >= 2 AND e >= 15) AS o FROM p_pred, (SELECT stddev_samp(e) AS s FROM p_pred))
SELECT (SELECT round(avg(e), 3) FROM p_pred) AS mae, (SELECT count(DISTINCT "window")::BIGINT FROM p_pred) AS n_windows, (SELECT count(DISTINCT year(listing_date))::INTEGER FROM p_pred) AS n_years, o::BIGINT AS n_outliers, round(o / n, 6) AS outlier_rate,
  (SELECT string_agg(cause || '=' || c, ',' ORDER BY cause) FROM (SELECT cause, count(*)::VARCHAR AS c FROM k GROUP BY 1)) AS causes FROM t
""")
def run_report_file(spark, d):
    """The nested summary of a run, written as JSON and read again."""
    path = scratch(spark, "report")
    report = diagnostics.run_report(P.predictions(spark, d), caused(spark, d))
    tables.write_report(report, path)
    rows = spark.read.schema(report.schema).json(path)
    causes = F.array_join(F.array_sort(F.transform(F.map_entries("outliers.causes"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))), ",")
    return rows.select("backtest.mae", "backtest.n_windows", F.size("by_year").alias("n_years"), "outliers.n_outliers", "outliers.outlier_rate", causes.alias("causes"))


@query(CAUSES + """SELECT listing_id, round(error_sigma, 4) AS error_sigma FROM x""")
def stored_predictions_outliers(spark, d):
    """Predictions stored as a back-test leaves them, read and analysed again."""
    path = scratch(spark, "predictions")
    tables.write_table(P.predictions(spark, d), path, "ipo_predictions")
    return diagnostics.outliers(tables.read_table(spark, path, "ipo_predictions")).select("listing_id", F.round("error_sigma", 4).alias("error_sigma"))


@query("""SELECT 'm' AS model_name, '1' AS model_version, "window" AS window_num, round(avg(e), 4) AS mae, round(avg(((actual > 0) = (pred > 0))::INTEGER), 4) AS direction_acc, round(avg((actual BETWEEN ci_90_low AND ci_90_high)::INTEGER), 4) AS coverage_90, count(*)::BIGINT AS n_valid FROM p_pred GROUP BY 3""")
def backtest_results(spark, d):
    """Metrics of windows, stored as the back-test's table."""
    path = scratch(spark, "backtest")
    rows = diagnostics.window_metrics(P.predictions(spark, d)).withColumnsRenamed({"window": "window_num", "n": "n_valid"}).withColumns({"model_name": F.lit("m"), "model_version": F.lit("1")})
    tables.write_table(rows, path, "backtest_results", "append")
    return tables.read_table(spark, path, "backtest_results").select("model_name", "model_version", "window_num", "mae", "direction_acc", "coverage_90", "n_valid")


@query()
def walk_forward_backtest(spark, d):
    """A back-test of all listings by all windows, with few rounds of small trees; a test compares the parts."""
    out = model.walk_forward(model_rows(spark, d), MODEL_FEATURES, keep=("corp_name",), threads=4, whole=True, maxIter=3, maxDepth=3)
    return diagnostics.window_metrics(out)


@query()
def cross_validated(spark, d):
    """Mean error over five consecutive folds of all listings, with the operator's own settings."""
    rows = stored(model_rows(spark, d).fillna(0.0, MODEL_FEATURES), "model-rows")
    return model.cross_validate(rows, MODEL_FEATURES, "open_return_pct", ["listing_date", "listing_id"], 5, threads=5)
