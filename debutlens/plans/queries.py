"""The registered queries over whole tables, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import extract
from ..functions.cleaning import clean_name, number, rounded
from ..operators import catalog, diagnostics, features, joins, keyed_tables, model, rubric, scoring
from ..operators.quantiles import exact_percentiles
from ..sources import tables
from ..sources.store import stored
from . import proxies as P

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"WITH {P.CTE.strip()}\n{sql.strip()}" if "p_" in sql and not sql.startswith("SELECT feature, round(importance") and not sql.lstrip().startswith("WITH ") else sql.strip()
        return f

    return add


def returns(spark: SparkSession, d: str) -> DataFrame:
    return P.listings(spark, d).withColumn("open_return_pct", features.open_return())


@query("""
SELECT year(l.listing_date)::INTEGER AS year, count(*)::BIGINT AS n, count(ret)::BIGINT AS n_known, round(avg(ret), 4) AS mean_return, round(avg(coalesce(mom_20d, 0)), 6) AS mean_momentum
FROM p_listings l ASOF LEFT JOIN (SELECT * FROM p_momentum WHERE index_code = 'KOSPI') m ON l.listing_date > m.date GROUP BY 1
""")
def yearly_momentum_return(spark, d):
    rows = features.asof_momentum(returns(spark, d), P.index_close(spark, d), "KOSPI", "kospi", (20,))
    return rows.groupBy(F.year("listing_date").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.count("open_return_pct").alias("n_known"), F.round(F.avg("open_return_pct"), 4).alias("mean_return"), F.round(F.avg("kospi_momentum_20d"), 6).alias("mean_momentum"))


@query("SELECT index_code, date, close, mom_5d, mom_20d, mom_60d, (mom_20d < -0.08)::INTEGER AS bear_market_flag FROM p_momentum")
def index_momentum(spark, d):
    return features.index_momentum(P.index_close(spark, d))


@query("""
SELECT listing_id, coalesce(mom_5d, 0.0) AS kospi_momentum_5d, coalesce(mom_20d, 0.0) AS kospi_momentum_20d, coalesce(mom_60d, 0.0) AS kospi_momentum_60d
FROM p_listings l ASOF LEFT JOIN (SELECT * FROM p_momentum WHERE index_code = 'KOSPI') m ON l.listing_date > m.date
""")
def listing_momentum(spark, d):
    rows = features.asof_momentum(P.listings(spark, d).select("listing_id", "listing_date"), P.index_close(spark, d), "KOSPI", "kospi")
    return rows.drop("listing_date")


@query("SELECT listing_id, corp_name, listing_date, round(ret, 4) AS open_return_pct, abs(ret) > 200 AS extreme, abs(ret) > 5 AS far FROM p_listings WHERE ret IS NOT NULL")
def listing_targets(spark, d):
    known = returns(spark, d).filter("open_return_pct is not null")
    marks = (features.extreme_return().alias("extreme"), features.extreme_return(5.0).alias("far"))
    return known.select("listing_id", "corp_name", "listing_date", rounded(F.col("open_return_pct"), 4).alias("open_return_pct"), *marks)


@query("""
, far AS (SELECT corp_name, abs(ret) AS v FROM p_listings WHERE abs(ret) > 6)
SELECT count(*)::BIGINT AS n, (SELECT string_agg(corp_name, '|' ORDER BY v DESC, corp_name DESC) FROM (SELECT * FROM far ORDER BY v DESC, corp_name LIMIT 5)) AS names FROM far
""")
def extreme_returns(spark, d):
    """Returns beyond 6 percent points either way: no price of these tables moves by 200."""
    return features.extreme_report(returns(spark, d), 6.0).select("n", F.concat_ws("|", "names").alias("names"))


@query("SELECT count(ret)::BIGINT AS n, round(avg(ret), 4) AS mean, round(median(ret), 4) AS median, round(stddev_samp(ret), 4) AS std, round(avg((ret > 0)::INTEGER), 4) AS positive_share FROM p_listings")
def target_summary(spark, d):
    r = "open_return_pct"
    rows = returns(spark, d)
    told = rows.agg(F.count(r).alias("n"), F.round(F.avg(r), 4).alias("mean"), F.round(F.stddev_samp(r), 4).alias("std"), F.round(F.avg((F.col(r) > 0).cast("double")), 4).alias("positive_share"))
    return told.crossJoin(F.broadcast(exact_percentiles(rows, r, {"median": 0.5}))).select("n", "mean", F.round("median", 4).alias("median"), "std", "positive_share")


@query("""
, v AS (SELECT listing_id, avg(ret) OVER (ORDER BY listing_date, listing_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS a10,
    avg(ret) OVER (PARTITION BY sector_name ORDER BY listing_date, listing_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS a5 FROM p_listings WHERE ret IS NOT NULL),
  w AS (SELECT l.*, last_value(a10 IGNORE NULLS) OVER (ORDER BY listing_date, listing_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m10,
    last_value(a5 IGNORE NULLS) OVER (PARTITION BY sector_name ORDER BY listing_date, listing_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m5
    FROM p_listings l LEFT JOIN v USING (listing_id))
SELECT listing_id, round(m10, 4) AS recent_ipo_avg_return_all, round(coalesce(m5, m10), 4) AS recent_ipo_avg_return_sector FROM w
""")
def recent_returns(spark, d):
    rows = features.with_temperature(returns(spark, d).select("listing_id", "listing_date", "sector_name", "open_return_pct"))
    return rows.select("listing_id", F.round("recent_ipo_avg_return_all", 4).alias("recent_ipo_avg_return_all"), F.round("recent_ipo_avg_return_sector", 4).alias("recent_ipo_avg_return_sector"))


@query("SELECT listing_id, count(*) OVER (PARTITION BY listing_date)::BIGINT AS same_day_ipo_count FROM p_listings")
def same_day_count(spark, d):
    return features.with_same_day_count(P.listings(spark, d)).select("listing_id", "same_day_ipo_count")


@query("""
, s AS (SELECT corp_code, sector, CASE WHEN eps > 0 THEN least(500.0, greatest(0.0, offering_price / eps)) END AS per,
    CASE WHEN revenue_t0 > 0 AND revenue_3y_ago > 0 THEN least(5.0, greatest(-0.5, pow(revenue_t0 / revenue_3y_ago, 1.0 / 3) - 1)) END AS g,
    CASE WHEN revenue_t0 > 0 THEN least(1.0, greatest(-1.0, operating_income_t0 / revenue_t0)) END AS om, CASE WHEN equity > 0 THEN least(10.0, greatest(0.0, total_liabilities / equity)) END AS dr FROM p_fin),
  m AS (SELECT sector, median(per) AS med FROM s GROUP BY 1)
SELECT corp_code, round(per, 7) AS offering_per, CASE WHEN med > 0 THEN round(per / med, 7) END AS per_vs_sector_median, round(g, 7) AS revenue_growth_3y, round(om, 7) AS operating_margin, round(dr, 7) AS debt_ratio
FROM s JOIN m USING (sector)
""")
def financial_features(spark, d):
    f = P.financials(spark, d).withColumns({"offering_per": features.offering_per(), "revenue_growth_3y": features.growth_3y("revenue_t0", "revenue_3y_ago"), "operating_margin": features.operating_margin("operating_income_t0", "revenue_t0"), "debt_ratio": features.debt_ratio()})
    f = features.with_group_median_ratio(f, "offering_per", "sector", "per_vs_sector_median")
    return f.select("corp_code", F.round("offering_per", 7).alias("offering_per"), F.round("per_vs_sector_median", 7).alias("per_vs_sector_median"), F.round("revenue_growth_3y", 7).alias("revenue_growth_3y"), F.round("operating_margin", 7).alias("operating_margin"), F.round("debt_ratio", 7).alias("debt_ratio"))


OFFER_SQL = """
, o AS (SELECT listing_id, least(1.0, coalesce(lockup_6m_ratio, 0)) + 0.75 * least(1.0, coalesce(lockup_3m_ratio, 0)) + 0.5 * least(1.0, coalesce(lockup_1m_ratio, 0)) + 0.25 * least(1.0, coalesce(lockup_15d_ratio, 0)) AS sc,
    CASE WHEN price_band_high > price_band_low THEN least(2.0, greatest(-0.5, (offering_price - price_band_low) / (price_band_high - price_band_low))) ELSE 0.5 END AS pos,
    CASE WHEN coalesce(new_shares, 0) + coalesce(secondary_shares, 0) > 0 THEN coalesce(secondary_shares, 0) / (coalesce(new_shares, 0) + coalesce(secondary_shares, 0)) END AS sec,
    CASE WHEN total_post_listing_shares > 0 THEN least(1.0, (coalesce(new_shares, 0) + coalesce(secondary_shares, 0)) / total_post_listing_shares) END AS fl, lockup_6m_ratio, institutional_demand_ratio FROM p_offer)
"""


def offer_rows(spark, d):
    return P.offers(spark, d).withColumns({"lockup_weighted_score": features.lockup_weighted_score(), "offering_price_band_position": features.band_position(), "secondary_offering_ratio": features.secondary_ratio(), "float_share_ratio": features.float_ratio()}).withColumn("band_exceeded", features.band_exceeded(F.col("offering_price_band_position")))


@query(OFFER_SQL + "SELECT listing_id, round(sc, 6) AS lockup_weighted_score, round(pos, 6) AS offering_price_band_position, (pos > 1)::INTEGER AS band_exceeded, round(sec, 6) AS secondary_offering_ratio, round(fl, 6) AS float_share_ratio FROM o")
def offer_features(spark, d):
    r = lambda c: F.round(c, 6).alias(c)
    return offer_rows(spark, d).select("listing_id", r("lockup_weighted_score"), r("offering_price_band_position"), "band_exceeded", r("secondary_offering_ratio"), r("float_share_ratio"))


IMPUTED = ["institutional_demand_ratio", "lockup_weighted_score", "offering_price_band_position", "float_share_ratio", "secondary_offering_ratio", "underwriter_tier"]


@query(OFFER_SQL + """
SELECT listing_id, round(least(3000, institutional_demand_ratio), 6) AS institutional_demand_ratio, round(least(1.0, sc), 6) AS lockup_weighted_score, round(pos, 6) AS offering_price_band_position,
  round(coalesce(fl, (SELECT median(fl) FROM o)), 6) AS float_share_ratio, round(coalesce(sec, 0), 6) AS secondary_offering_ratio, 1.0::DOUBLE AS underwriter_tier FROM o
""")
def imputed_features(spark, d):
    """Absent columns take 0 before the clip, so the tier's lower bound."""
    wanted = [f for f in catalog.FEATURES if f.name in IMPUTED]
    rows = offer_rows(spark, d)
    out = catalog.Imputer(wanted).fit(rows).transform(rows, ["listing_id"])
    return out.select("listing_id", *[F.round(c, 6).alias(c) for c in IMPUTED])


@query(OFFER_SQL + """
, u AS (UNPIVOT (SELECT sc AS lockup_weighted_score, pos AS offering_price_band_position, fl AS float_share_ratio FROM o) ON lockup_weighted_score, offering_price_band_position, float_share_ratio INTO NAME feature VALUE v)
SELECT feature, count(v)::BIGINT AS n, round(avg(v), 5) AS mean, round(stddev_samp(v), 5) AS std, round(min(v), 5) AS min, round(quantile_cont(v, 0.25), 5) AS p25, round(quantile_cont(v, 0.5), 5) AS p50, round(quantile_cont(v, 0.75), 5) AS p75,
  round(max(v), 5) AS max, round(100.0 * ((SELECT count(*) FROM o) - count(v)) / (SELECT count(*) FROM o), 2) AS missing_pct, round(100.0 * count(*) FILTER (v = 0) / (SELECT count(*) FROM o), 2) AS zero_pct FROM u GROUP BY 1
""")
def feature_statistics(spark, d):
    out = catalog.feature_statistics(offer_rows(spark, d), ["lockup_weighted_score", "offering_price_band_position", "float_share_ratio"])
    return out.select("feature", "n", *[F.round(c, 5).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")], "missing_pct", "zero_pct")


@query("""
, a AS (SELECT *, offering_price * total_shares AS cap, CASE WHEN eps > 0 THEN offering_price / eps WHEN net_income_t0 > 0 AND total_shares > 0 THEN offering_price * total_shares / net_income_t0 END AS rper FROM p_fin),
  b AS (SELECT corp_code, nullif(round((rper)::DOUBLE::VARCHAR::DECIMAL(38, 15), 1)::DOUBLE, 0) AS per, CASE WHEN eps > 0 THEN 'normal' WHEN net_income_t0 > 0 AND total_shares > 0 THEN 'calculated' ELSE 'deficit' END AS per_flag,
    CASE WHEN equity > 0 THEN nullif(round((cap / equity)::DOUBLE::VARCHAR::DECIMAL(38, 15), 2)::DOUBLE, 0) END AS pbr, round((rper / 16.0)::DOUBLE::VARCHAR::DECIMAL(38, 15), 2)::DOUBLE AS pvs, CASE WHEN equity > 0 THEN round((cap / equity / 1.3)::DOUBLE::VARCHAR::DECIMAL(38, 15), 2)::DOUBLE END AS bvs,
    CASE WHEN revenue_t0 > 0 AND revenue_t2 > 0 THEN round((pow(revenue_t0 / revenue_t2, 0.5) - 1)::DOUBLE::VARCHAR::DECIMAL(38, 15), 4)::DOUBLE END AS rc, CASE WHEN revenue_t1 > 0 AND revenue_t0 <> 0 THEN round((revenue_t0 / revenue_t1 - 1)::DOUBLE::VARCHAR::DECIMAL(38, 15), 4)::DOUBLE END AS ry,
    CASE WHEN revenue_t0 > 0 THEN round((operating_income_t0 / revenue_t0)::DOUBLE::VARCHAR::DECIMAL(38, 15), 4)::DOUBLE END AS om, CASE WHEN equity > 0 THEN round((net_income_t0 / equity)::DOUBLE::VARCHAR::DECIMAL(38, 15), 4)::DOUBLE END AS roe, net_income_t0 > 0 AS prof,
    CASE WHEN equity > 0 THEN round((total_liabilities / equity)::DOUBLE::VARCHAR::DECIMAL(38, 15), 2)::DOUBLE END AS de, CASE WHEN operating_income_t0 <> 0 AND interest_expense > 0 THEN round((operating_income_t0 / interest_expense)::DOUBLE::VARCHAR::DECIMAL(38, 15), 1)::DOUBLE END AS ic FROM a),
  s AS (SELECT *, round((least(100, greatest(0, 50 + coalesce(CASE WHEN pvs IS NOT NULL THEN (1 - pvs) * 30 WHEN per_flag = 'deficit' THEN -20 END, 0) + coalesce((1 - bvs) * 10, 0))))::DOUBLE::VARCHAR::DECIMAL(38, 15), 1)::DOUBLE AS valuation_score,
    round((least(100, greatest(0, 50 + coalesce(rc * 100, 0) + coalesce(ry * 50, 0))))::DOUBLE::VARCHAR::DECIMAL(38, 15), 1)::DOUBLE AS growth_score,
    round((least(100, greatest(0, 50 + coalesce(om * 100, 0) + coalesce(roe * 50, 0) - CASE WHEN prof THEN 0 ELSE 20 END)))::DOUBLE::VARCHAR::DECIMAL(38, 15), 1)::DOUBLE AS profitability_score,
    round((least(100, greatest(0, 70 - coalesce(least(30, de * 10), 0) + coalesce(CASE WHEN ic > 0 THEN least(20, ic * 2) END, 0))))::DOUBLE::VARCHAR::DECIMAL(38, 15), 1)::DOUBLE AS stability_score FROM b)
SELECT corp_code, per, per_flag, pbr, valuation_score, growth_score, profitability_score, stability_score FROM s
""")
def attractiveness(spark, d):
    return rubric.rubric(P.financials(spark, d)).select("corp_code", "per", "per_flag", "pbr", "valuation_score", "growth_score", "profitability_score", "stability_score")


@query("""
SELECT listing_id, round(sum(amount) FILTER (account = 'F' AND t = 0), 2) AS "F_t0", round(sum(amount) FILTER (account = 'F' AND t = 1), 2) AS "F_t1", round(sum(amount) FILTER (account = 'O' AND t = 0), 2) AS "O_t0", round(sum(amount) FILTER (account = 'O' AND t = 1), 2) AS "O_t1"
FROM (SELECT listing_id, account, amount, year(listing_date) - 1 - year AS t FROM p_listings JOIN p_accounts USING (corp_code)) WHERE t BETWEEN 0 AND 1 GROUP BY 1
""")
def accounts_before_listing(spark, d):
    wide = rubric.accounts_wide(P.accounts(spark, d), P.listings(spark, d), ["F", "O"], 2)
    return wide.select("listing_id", *[F.round(c, 2).alias(c) for c in ("F_t0", "F_t1", "O_t0", "O_t1")])


@query("""
, e AS (SELECT min(listing_date) AS a, max(listing_date) AS b FROM p_listings), w AS (SELECT s::DATE AS split, s::DATE + 180 AS valid_end FROM e, unnest(generate_series((a + 1095)::TIMESTAMP, (b - 180)::TIMESTAMP, INTERVAL 90 DAY)) AS t(s)),
  c AS (SELECT split, valid_end, count(*) FILTER (listing_date < split)::BIGINT AS n_train, count(*) FILTER (listing_date >= split)::BIGINT AS n_valid FROM p_listings JOIN w ON listing_date < valid_end GROUP BY ALL)
SELECT split, valid_end, n_train, n_valid, (row_number() OVER (ORDER BY split) - 1)::INTEGER AS "window" FROM c WHERE n_train >= 20 AND n_valid >= 5
""")
def walk_forward_windows(spark, d):
    return joins.walk_windows(P.listings(spark, d))


@query("""
, e AS (SELECT min(listing_date) AS a, max(listing_date) AS b FROM p_listings), w AS (SELECT s::DATE AS split FROM e, unnest(generate_series((a + 1095)::TIMESTAMP, (b - 180)::TIMESTAMP, INTERVAL 90 DAY)) AS t(s))
SELECT split, count(*)::BIGINT AS n, round(median(ret), 4) AS median_return FROM p_listings JOIN w ON listing_date >= split AND listing_date < split + 180 GROUP BY 1
""")
def validation_medians(spark, d):
    rows = returns(spark, d)
    valid = joins.validation_rows(rows, joins.walk_windows(rows))
    middle = exact_percentiles(valid, "open_return_pct", {"median_return": 0.5}, ["split"])
    return valid.groupBy("split").agg(F.count(F.lit(1)).alias("n")).join(middle, "split", "left").select("split", "n", F.round("median_return", 4).alias("median_return"))


@query("""SELECT round(avg(e), 3) AS mae, round(avg(((actual > 0) = (pred > 0))::INTEGER), 4) AS direction_acc, round(avg((actual BETWEEN ci_90_low AND ci_90_high)::INTEGER), 4) AS coverage_90, count(DISTINCT "window")::BIGINT AS n_windows, count(*)::BIGINT AS n FROM p_pred""")
def overall_metrics(spark, d):
    return diagnostics.overall_metrics(P.predictions(spark, d))


@query("""SELECT "window", round(avg(e), 4) AS mae, round(avg(((actual > 0) = (pred > 0))::INTEGER), 4) AS direction_acc, round(avg((actual BETWEEN ci_90_low AND ci_90_high)::INTEGER), 4) AS coverage_90,
round(avg((actual BETWEEN ci_50_low AND ci_50_high)::INTEGER), 4) AS coverage_50, round(avg(actual) FILTER (pred > 0), 4) AS mean_if_up, count(*)::BIGINT AS n FROM p_pred GROUP BY 1""")
def window_metrics(spark, d):
    return diagnostics.window_metrics(P.predictions(spark, d))


@query("SELECT year(listing_date)::INTEGER AS year, count(actual)::BIGINT AS n, round(avg(e), 4) AS mae, round(avg(((actual > 0) = (pred > 0))::INTEGER), 4) AS direction_acc, round(avg(actual), 4) AS actual_mean, round(avg(pred), 4) AS pred_mean FROM p_pred GROUP BY 1")
def yearly_metrics(spark, d):
    return diagnostics.metrics_by(P.predictions(spark, d), year=F.year("listing_date"))


@query("SELECT year(listing_date)::INTEGER AS year, quarter(listing_date)::INTEGER AS quarter, count(e)::BIGINT AS n, round(avg(e), 4) AS mae, round(avg((pred * actual > 0)::INTEGER), 4) AS direction_acc FROM p_pred GROUP BY 1, 2")
def error_pattern(spark, d):
    return diagnostics.error_pattern(P.predictions(spark, d))


@query("""
SELECT count(*)::BIGINT AS n, round(avg(e), 4) AS mean, round(median(e), 4) AS median, round(stddev_samp(e), 4) AS std, round(quantile_cont(e, 0.9), 4) AS p90,
  round(100.0 * count(*) FILTER (e < s) / count(*), 4) AS within_1_sigma_pct, round(100.0 * count(*) FILTER (e < 2 * s) / count(*), 4) AS within_2_sigma_pct, count(*) FILTER (e >= 2 * s)::BIGINT AS n_beyond_2_sigma,
  count(*) FILTER (e < 5)::BIGINT AS e_0_5, count(*) FILTER (e >= 5 AND e < 10)::BIGINT AS e_5_10, count(*) FILTER (e >= 10 AND e < 20)::BIGINT AS e_10_20, count(*) FILTER (e >= 20 AND e < 30)::BIGINT AS e_20_30, count(*) FILTER (e >= 30)::BIGINT AS e_30_up
FROM p_pred, (SELECT stddev_samp(e) AS s FROM p_pred)
""")
def error_distribution(spark, d):
    return diagnostics.error_distribution(P.predictions(spark, d))


@query("SELECT round(quantile_cont(e, 0.5), 6) AS q50, round(quantile_cont(e, 0.9), 6) AS q90 FROM p_pred")
def conformal_quantiles(spark, d):
    return diagnostics.conformal_quantiles(P.predictions(spark, d))


def event_index(spark, d) -> DataFrame:
    """The mean value of each day's errors as an index, half up to 4 places, in whole cents."""
    errors = P.table(spark, d, "events").filter("event_type = 'error'").groupBy(F.col("ts").cast("date").alias("date"))
    cents = errors.agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("s"), F.count("value").alias("n"))
    return cents.select(F.lit("KOSPI").alias("index_code"), "date", (F.expr("(200 * s + n) div (2 * n)") / 10000).alias("close"))


def event_context(spark, d) -> DataFrame:
    """Context of the events' listings: a user's events of a day as listings of a day, and ratios by type."""
    e = P.table(spark, d, "events").select(F.col("event_id").alias("listing_id"), F.concat_ws(" ", "user_id", F.col("ts").cast("date")).alias("user_day"), "event_type", F.round(F.col("value") - 50, 4).alias("v"))
    kind = F.col("event_type")
    ratios = {"float_share_ratio": F.when(kind == "error", 0.7), "recent_ipo_avg_return_sector": F.when(kind == "purchase", F.col("v")), "secondary_offering_ratio": F.when(kind == "click", 0.6)}
    return features.with_same_day_count(e.withColumns(ratios), "user_day")


def caused(spark, d) -> DataFrame:
    """Outliers with the context of their listings and of the index, and their causes."""
    rows = diagnostics.with_listing_context(diagnostics.outliers(P.predictions(spark, d)), event_context(spark, d))
    return diagnostics.with_cause(diagnostics.with_index_context(rows, event_index(spark, d)))


CAUSES = """
, x AS (SELECT p.*, actual - pred AS error, e / s AS error_sigma FROM p_pred p, (SELECT stddev_samp(e) AS s FROM p_pred) WHERE e / s >= 2 AND e >= 15),
  ec AS (SELECT ts::DATE AS date, ((200 * sum(round(value * 100)::BIGINT) + count(value)) // (2 * count(value)))::DOUBLE / 10000 AS close FROM events WHERE event_type = 'error' GROUP BY 1),
  em AS (SELECT date, coalesce(round(close / lag(close, 5) OVER w - 1, 6), 0.0) AS m5, coalesce(round(close / lag(close, 20) OVER w - 1, 6), 0.0) AS m20 FROM ec WINDOW w AS (ORDER BY date)),
  crowd AS (SELECT event_id AS listing_id, count(*) OVER (PARTITION BY user_id, ts::DATE) AS same_day FROM events),
  k AS (SELECT x.*, CASE WHEN m20 < -0.08 THEN 'A_market' WHEN m5 < -0.04 THEN 'A_market' WHEN same_day >= 4 THEN 'B_supply' WHEN event_type = 'error' THEN 'B_supply'
    WHEN event_type = 'purchase' AND abs(actual) > 50 THEN 'C_sector' WHEN event_type = 'click' THEN 'D_structure' ELSE 'E_unknown' END AS cause
    FROM x JOIN crowd USING (listing_id) ASOF LEFT JOIN em ON x.listing_date > em.date)
"""


@query(CAUSES + "SELECT listing_id, round(error_sigma, 4) AS error_sigma, cause, coalesce(error * actual < 0, false) AS overshoot, coalesce(pred * actual < 0, false) AS direction_wrong FROM k")
def outlier_causes(spark, d):
    return caused(spark, d).select("listing_id", F.round("error_sigma", 4).alias("error_sigma"), "cause", "overshoot", "direction_wrong")


@query(CAUSES + "SELECT cause, count(*)::BIGINT AS n FROM k GROUP BY 1")
def cause_counts(spark, d):
    return diagnostics.cause_counts(caused(spark, d))


RULES = ", ".join(f"('{c}', {i}, '{x}')" for c, own in diagnostics.RECOMMENDED.items() for i, x in enumerate(own))


@query(CAUSES + f"""
, rules AS (SELECT * FROM (VALUES {RULES}) AS t(cause, place, suggestion)), n AS (SELECT cause, count(*) AS n FROM k GROUP BY 1),
  l AS (SELECT cause, suggestion, split_part(suggestion, ' ', 1) AS token, row_number() OVER (ORDER BY n DESC, cause, place) AS r FROM n JOIN rules USING (cause) WHERE n >= 0.2 * (SELECT sum(n) FROM n))
SELECT (row_number() OVER (ORDER BY r))::INTEGER AS rank, cause, suggestion FROM l QUALIFY row_number() OVER (PARTITION BY token ORDER BY r) = 1
""")
def feature_recommendations(spark, d):
    return diagnostics.recommendations(caused(spark, d), 0.2)


@query("""SELECT count(*)::BIGINT AS n, count(*) FILTER (e / s >= 2 AND e >= 15)::BIGINT AS n_outliers, count(DISTINCT "window")::BIGINT AS n_windows, round(count(*) FILTER (e / s >= 2 AND e >= 15) / count(*), 6) AS outlier_rate FROM p_pred, (SELECT stddev_samp(e) AS s FROM p_pred)""")
def run_summary(spark, d):
    return diagnostics.run_summary(P.predictions(spark, d))


@query("""SELECT listing_id, CASE WHEN ci_90_high - ci_90_low < 30 AND up_prob > 0.65 THEN 'A' WHEN ci_90_high - ci_90_low < 60 AND up_prob > 0.5 THEN 'B' ELSE 'C' END AS risk_grade FROM p_pred""")
def risk_grades(spark, d):
    return P.predictions(spark, d).select("listing_id", diagnostics.risk_grade().alias("risk_grade"))


@query("""
, o AS (SELECT c_custkey AS corp_code, c_name AS corp_name, c_mktsegment AS market, c_acctbal AS price FROM customer), n AS (SELECT o_custkey AS corp_code, max(o_orderpriority) AS market, CASE WHEN max(o_totalprice) > 200000 THEN round(max(o_totalprice), 2) END AS price FROM orders GROUP BY 1)
SELECT corp_code, corp_name, coalesce(n.market, o.market) AS market, coalesce(n.price, o.price) AS price FROM o FULL JOIN n USING (corp_code) -- p_
""")
def upserted_master(spark, d):
    old, new = _master(spark, d)
    return keyed_tables.upsert_known(old, new, ["corp_code"])


def _master(spark, d):
    old = P.table(spark, d, "customer").select(F.col("c_custkey").alias("corp_code"), F.col("c_name").alias("corp_name"), F.col("c_mktsegment").alias("market"), F.col("c_acctbal").alias("price"))
    new = P.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("corp_code")).agg(F.max("o_orderpriority").alias("market"), F.max("o_totalprice").alias("price"))
    return old, new.withColumn("price", F.when(F.col("price") > 200000, F.round("price", 2)))


@query("""
, o AS (SELECT c_custkey AS corp_code, c_name AS corp_name, c_mktsegment AS market, c_acctbal AS price FROM customer), n AS (SELECT o_custkey AS corp_code, max(o_orderpriority) AS market, CASE WHEN max(o_totalprice) > 200000 THEN round(max(o_totalprice), 2) END AS price, 1 AS here FROM orders GROUP BY 1)
SELECT corp_code, corp_name, CASE WHEN here = 1 THEN n.market ELSE o.market END AS market, CASE WHEN here = 1 THEN n.price ELSE o.price END AS price FROM o FULL JOIN n USING (corp_code) -- p_
""")
def upserted_features(spark, d):
    old, new = _master(spark, d)
    return keyed_tables.upsert_given(old, new, ["corp_code"])


def actuals(spark, d) -> DataFrame:
    return returns(spark, d).filter("open_return_pct is not null").select(F.col("listing_id").alias("ipo_id"), rounded(F.col("open_return_pct"), 4).alias("actual"))


@query("""
SELECT listing_id AS ipo_id, pred, round(l.ret, 4) AS actual, round(round(l.ret, 4) - pred, 4) AS error, (round(l.ret, 4) > 0) = (pred > 0) AS direction_correct, l.ret IS NOT NULL AS resolved
FROM p_pred p LEFT JOIN (SELECT listing_id, ret FROM p_listings WHERE ret IS NOT NULL) l USING (listing_id)
""")
def resolved_predictions(spark, d):
    out = keyed_tables.resolve(P.predictions(spark, d).select(F.col("listing_id").alias("ipo_id"), "pred"), actuals(spark, d))
    return out.select("ipo_id", "pred", "actual", F.round("error", 4).alias("error"), "direction_correct", F.col("resolved_at").isNotNull().alias("resolved"))


@query("""
SELECT coalesce(o.id, l.listing_id) AS id, o.corp_name, coalesce(round(l.ret, 4), o.old) AS open_return_pct
FROM (SELECT event_id AS id, user_id::VARCHAR AS corp_name, 0.5::DOUBLE AS old FROM events) o FULL JOIN (SELECT listing_id, ret FROM p_listings WHERE ret IS NOT NULL) l ON o.id = l.listing_id
""")
def resolved_master(spark, d):
    master = P.table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("corp_name"), F.lit(0.5).alias("open_return_pct"))
    return keyed_tables.resolve_master(master, actuals(spark, d))


def registry(spark, d):
    models = P.table(spark, d, "part").groupBy(F.col("p_brand").alias("name"), F.col("p_type").alias("version")).agg(F.max("p_retailprice").alias("promoted_at"), F.max("p_size").alias("size"))
    return models.withColumns({"is_champion": F.col("size") >= 45, "status": F.lit("trained")})


@query("""
, r AS (SELECT p_brand AS name, p_type AS version, max(p_retailprice) AS promoted_at, max(p_size) >= 45 AS is_champion FROM part GROUP BY 1, 2), t AS (SELECT name, version FROM r WHERE is_champion ORDER BY promoted_at DESC, name, version LIMIT 1)
SELECT r.name, r.version, r.name = t.name AND r.version = t.version AS is_champion, CASE WHEN r.name = t.name AND r.version = t.version THEN 'champion' WHEN is_champion THEN 'retired' ELSE 'trained' END AS status FROM r, t -- p_
""")
def promoted_registry(spark, d):
    models = registry(spark, d)
    best = keyed_tables.champion(models).first()
    return keyed_tables.promote(models, best["name"], best["version"]).select("name", "version", "is_champion", "status")


@query("SELECT o_orderkey AS rcept_no, o_custkey AS corp_code FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def unprocessed_filings(spark, d):
    batch = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("rcept_no"), F.col("o_custkey").alias("corp_code"))
    return tables.not_yet(batch, P.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("rcept_no")))


@query("SELECT o_custkey AS corp_code, o_orderkey AS rcept_no, o_orderdate::DATE AS rcept_dt FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_filings(spark, d):
    rows = P.table(spark, d, "orders").select(F.col("o_custkey").alias("corp_code"), F.col("o_orderkey").alias("rcept_no"), F.col("o_orderdate").alias("t"))
    return keyed_tables.latest(rows, ["corp_code"], [F.desc("t"), F.desc("rcept_no")]).select("corp_code", "rcept_no", F.col("t").cast("date").alias("rcept_dt"))


@query("SELECT c_custkey AS corp_code, s_suppkey AS listing_id FROM customer JOIN supplier ON regexp_replace(c_name, '[^0-9]', '', 'g')::BIGINT = regexp_replace(s_name, '[^0-9]', '', 'g')::BIGINT")
def name_matches(spark, d):
    """Names that differ in form only: a company form is put before the number and cleaned away again."""
    digits = lambda c: F.concat(F.lit("(주) "), F.regexp_replace(c, "[^0-9]", "").cast("long").cast("string"))
    left = P.table(spark, d, "customer").select(F.col("c_custkey").alias("corp_code"), digits("c_name").alias("corp_name"))
    right = P.table(spark, d, "supplier").select(F.col("s_suppkey").alias("listing_id"), F.regexp_replace(digits("s_name"), "\\(주\\)", "㈜").alias("corp_name"))
    return joins.by_clean_name(left, right).select("corp_code", "listing_id")


@query(OFFER_SQL + """
SELECT listing_id, concat_ws('|', CASE WHEN lockup_6m_ratio IS NULL THEN 'lockup_6m_ratio required' END, CASE WHEN 2 * sec > 1 THEN 'secondary_offering_ratio out of range' END) AS violations FROM o
""")
def request_violations(spark, d):
    """Requests with doubled ratios, so that ranges are broken."""
    rows = offer_rows(spark, d).select("listing_id", "institutional_demand_ratio", "lockup_6m_ratio", "offering_price_band_position", (F.col("secondary_offering_ratio") * 2).alias("secondary_offering_ratio"))
    return scoring.validate(rows).select("listing_id", F.concat_ws("|", "violations").alias("violations"))


@query("SELECT doc_id, nullif(least(60, len(regexp_extract_all(coalesce(text, ''), '(?:^|[ \\t\\n\\x0b\\f\\r])(?:[0-9]{1,2}\\.)'))), 0)::INTEGER AS risk_factor_count FROM documents")
def numbered_items(spark, d):
    return P.table(spark, d, "documents").select("doc_id", extract.risk_marks(F.coalesce("text", F.lit("")), "(?:^|\\s)(?:[0-9]{1,2}\\.)").cast("int").alias("risk_factor_count"))


@query()
def page_texts(spark, d):
    text = extract.plain_text(F.col("html"))
    return P.table(spark, d, "pages").select("page_id", F.length(text).alias("n_chars"), F.sha2(text.cast("binary"), 256).alias("text_sha256"))


@query("""
, t AS (SELECT listing_id, ret, row_number() OVER (ORDER BY listing_date DESC, listing_id DESC) <= 100 AS is_tail FROM p_listings)
SELECT is_tail, count(*)::BIGINT AS n, round(avg(ret), 4) AS mean_return FROM t GROUP BY 1
""")
def calibration_split(spark, d):
    return joins.chronological_tail(returns(spark, d), 100, ["listing_date", "listing_id"]).groupBy("is_tail").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("open_return_pct"), 4).alias("mean_return"))


@query("SELECT feature, round(importance, 4) AS importance, round(100 * importance / sum(importance) OVER (), 2) AS importance_pct FROM (SELECT p_brand AS feature, round(sum(p_retailprice), 4) AS importance FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)")
def top_importance(spark, d):
    return model.top_importance(P.table(spark, d, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.round(F.sum("p_retailprice"), 4).alias("importance")), 10)


MODEL_FEATURES = ["kospi_momentum_5d", "kospi_momentum_20d", "recent_ipo_avg_return_all", "recent_ipo_avg_return_sector", "same_day_ipo_count"]


def model_rows(spark, d):
    rows = features.with_temperature(returns(spark, d))
    rows = features.with_same_day_count(rows)
    return features.asof_momentum(rows, P.index_close(spark, d), "KOSPI", "kospi", (5, 20)).select("listing_id", "corp_name", "listing_date", "open_return_pct", *MODEL_FEATURES)


@query()
def scored_listings(spark, d):
    """A final model with few rounds: trained on all listings with a known return, it scores every listing."""
    rows = stored(model_rows(spark, d), "model-rows")
    fitted = model.final_model(rows, MODEL_FEATURES, "open_return_pct", ["listing_date", "listing_id"], maxIter=5, maxDepth=3)
    scored = fitted.predict(rows.fillna(0.0, MODEL_FEATURES))
    return fitted.explain(scored, 3).select("listing_id", "pred", "up_prob", "ci_90_low", "ci_90_high", "risk_grade", "top_features")
