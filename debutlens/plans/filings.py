"""Registered queries on filings, statements, demand and prices that Spark derives from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import extract
from ..operators import features, joins, rubric
from ..sources import tables
from ..sources.store import scratch
from . import proxies as P
from .queries import query


def grouped(c: str):
    """A whole number with thousands commas."""
    return F.format_number(F.floor(F.coalesce(F.col(c), F.lit(0.0))).cast("long"), 0)


@query("""
SELECT o_orderkey::VARCHAR AS rcept_no, o_custkey::VARCHAR AS corp_code, o_orderdate::DATE AS rcept_dt FROM orders
WHERE o_orderpriority[1] IN ('1', '2') AND o_custkey % 7 <> 0 AND year(o_orderdate) BETWEEN 1996 AND 1998
""")
def equity_filings(spark, d):
    """A backfill of three years from a landed list in which titles are other reports or absent, and dates malformed."""
    kind = F.substring("o_orderpriority", 1, 1)
    title = F.when(kind == "1", "증권신고서(지분증권)").when(kind == "2", "[기재정정]지분증권 증권신고서").when(kind == "3", "사업보고서")
    date = F.when(F.col("o_custkey") % 7 == 0, "20251340").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    raw = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("rcept_no"), F.col("o_custkey").alias("corp_code"), title.alias("report_nm"), date.alias("rcept_dt"))
    return tables.backfill(raw, 1996, 1998).select("rcept_no", "corp_code", "rcept_dt")


ACCOUNT_IDS = list(tables.ACCOUNTS)
ACCOUNT_OF_LINE = " ".join(f"WHEN {i + 1} THEN '{name}'" for i, name in enumerate(tables.ACCOUNTS.values()))


@query(f"""
, raw AS (SELECT l_suppkey AS corp, year(l_shipdate) AS year, CASE l_linenumber {ACCOUNT_OF_LINE} END AS account, l_returnflag <> 'A' AS separate, CASE WHEN l_tax <> 0.08 THEN l_extendedprice END AS amount FROM lineitem),
  best AS (SELECT corp, year, bool_and(separate) AS separate FROM raw GROUP BY 1, 2)
SELECT corp::VARCHAR AS corp_code, year::INTEGER AS year, account, count(*)::BIGINT AS n, round(sum(amount), 2) AS amount FROM raw JOIN best USING (corp, year, separate) WHERE amount IS NOT NULL AND account IS NOT NULL GROUP BY 1, 2, 3 -- p_
""")
def statement_accounts(spark, d):
    """Returned lines as consolidated statements, others as separate ones; amounts are texts with commas, some are none."""
    line = F.col("l_linenumber")
    ids = F.create_map(*[F.lit(x) for i, a in enumerate(ACCOUNT_IDS) for x in (i + 1, a)])
    raw = P.table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("corp_code"), F.year("l_shipdate").alias("year"), F.when(F.col("l_returnflag") == "A", "CFS").otherwise("OFS").alias("fs_div"),
        ids[line].alias("account_id"), F.when(F.col("l_tax") == 0.08, "-").otherwise(F.format_number("l_extendedprice", 2)).alias("thstrm_amount"),
    )
    return tables.statement_amounts(raw).groupBy("corp_code", "year", "account").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


@query("SELECT index_code, date, close FROM p_index")
def index_series(spark, d):
    """Index rows as an exchange sends them, read into the canonical table, stored and read again."""
    raw = P.index_close(spark, d).select(F.when(F.col("index_code") == "KOSPI", "1").otherwise("2").alias("index_code"), F.date_format("date", "yyyy/MM/dd").alias("date"), F.format_number("close", 4).alias("close"))
    path = scratch(spark, "index-close")
    tables.write_table(tables.index_series(raw), path, "index_close")
    return tables.read_table(spark, path, "index_close")


DEMAND_LABELS = {"lockup_6m_ratio": (1, "6개월"), "lockup_3m_ratio": (2, "3개월"), "lockup_1m_ratio": (3, "1개월"), "lockup_15d_ratio": (4, "15일"), "lockup_none_ratio": (5, "미확약")}
DEMAND_SHARES = ", ".join(f"round_even(q{n} / total, 6) AS {name}" for name, (n, _) in DEMAND_LABELS.items())
DEMAND_LINES = ", ".join(f"coalesce(sum(l_quantity) FILTER (l_linenumber = {n}), 0) AS q{n}" for n, _ in DEMAND_LABELS.values())


@query(f"""
, q AS (SELECT l_orderkey AS listing_id, max(l_linenumber) + 0.5 AS ratio, sum(l_quantity) AS total, {DEMAND_LINES} FROM lineitem GROUP BY 1)
SELECT listing_id, ratio::DOUBLE AS institutional_demand_ratio, {DEMAND_SHARES}, true AS parse_success FROM q -- p_
""")
def demand_fields(spark, d):
    """Demand tables read from texts that Spark makes of orders."""
    part = lambda n: F.sum(F.when(F.col("l_linenumber") == n, F.col("l_quantity")))
    sums = P.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("listing_id")).agg(F.max("l_linenumber").alias("r"), F.sum("l_quantity").alias("total"), *[part(n).alias(f"q{n}") for n, _ in DEMAND_LABELS.values()])
    rows = [F.concat(F.lit(f" {label} "), grouped(f"q{n}"), F.lit(" 주")) for n, label in reversed(DEMAND_LABELS.values())]
    text = F.concat(F.lit("경쟁률 "), F.col("r").cast("string"), F.lit(".5 : 1 합계 "), grouped("total"), F.lit(" 주"), *rows)
    return extract.with_demand_fields(sums.select("listing_id", text.alias("t")), F.col("t"), ["listing_id"])


def filing_texts(spark, d) -> DataFrame:
    """A filing's text for each order, some without an underwriter, a commitment, risks or a valid date.

    Its prices are rounded down, so the mean is that of the lines in their order.
    """
    key = F.col("listing_id")
    lead = F.element_at(F.array(*map(F.lit, (" 대표주관회사 한국투자증권", " 대표주관회사 대신 증권", " 주관회사 한길증권", ""))), (key % 4 + 1).cast("int"))
    kept = F.when(key % 3 != 0, F.concat(F.lit(" 최대주주 의무보유기간 "), (key % 5).cast("string"), F.lit("년 "), (key % 12).cast("string"), F.lit("개월"))).otherwise("")
    date = F.concat(F.lit(" 상장 예정일 2025년 "), (key % 14 + 1).cast("string"), F.lit("월 "), (key % 28 + 1).cast("string"), F.lit("일"))
    risks = F.element_at(F.array(*map(F.lit, ("", " 투자위험요소 가. 시장", " 투자위험요소 가. 시장 나. 영업", " 위험요소 1. 시장 2. 영업 ③ 재무"))), (key % 4 + 1).cast("int"))
    parts = ["<p>희망 공모가액 ", grouped("price_band_low"), " ~ ", grouped("price_band_high"), " 원</p><p>확정&nbsp;공모가 ", grouped("offering_price"), " 원</p> 신주모집 ", grouped("new_shares"), " 주 구주매출 ", grouped("secondary_shares"), " 주 상장예정주식수 ", grouped("total_post_listing_shares"), " 주", lead, kept, date, risks]
    html = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    return P.offers(spark, d, ordered=True).select("listing_id", extract.plain_text(html).alias("text"))


@query("""
SELECT listing_id, floor(price_band_low)::BIGINT AS price_band_low, floor(price_band_high)::BIGINT AS price_band_high, floor(offering_price)::BIGINT AS offering_price, floor(coalesce(new_shares, 0))::BIGINT AS new_shares,
  floor(coalesce(secondary_shares, 0))::BIGINT AS secondary_shares, floor(total_post_listing_shares)::BIGINT AS total_post_listing_shares,
  CASE listing_id % 4 WHEN 0 THEN '한국투자증권' WHEN 1 THEN '대신 증권' WHEN 2 THEN '한길증권' END AS lead_underwriter,
  CASE WHEN listing_id % 14 < 12 THEN make_date(2025, listing_id % 14 + 1, listing_id % 28 + 1) END AS listing_date,
  CASE WHEN listing_id % 3 <> 0 THEN least(36, listing_id % 5 * 12 + listing_id % 12)::INTEGER END AS major_shareholder_lockup_months,
  nullif(listing_id % 4, 0)::INTEGER AS risk_factor_count, true AS parse_success FROM p_offer
""")
def filing_fields(spark, d):
    """All ten fields of a filing."""
    return extract.with_offering_fields(filing_texts(spark, d), F.col("text"), ["listing_id"])


@query("""
SELECT listing_id, CASE listing_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 END::INTEGER AS underwriter_tier, CASE WHEN listing_id % 6 < 5 THEN greatest(1, least(3, listing_id % 6)) END::INTEGER AS given_tier,
  CASE WHEN listing_id % 6 < 5 THEN least(60, listing_id % 6 * 20)::INTEGER END AS given_risks, nullif(listing_id % 4, 0)::INTEGER AS risk_factor_count FROM p_offer
""")
def tiers_and_risks(spark, d):
    """Told from a filing's fields, and kept where a table gives them (as texts, some no numbers)."""
    key = F.col("listing_id")
    named = filing_texts(spark, d).select("listing_id", extract.offering_fields(F.col("text"))["lead_underwriter"].alias("underwriters"), F.col("text").alias("risk_factors"))
    told = extract.with_risk_count(extract.with_underwriter_tier(named))
    # the text's other numbers have no mark, its date ends in other signs
    told = told.select("listing_id", "underwriter_tier", "risk_factor_count")
    given = P.offers(spark, d).select("listing_id", F.when(key % 6 < 5, (key % 6).cast("string")).otherwise("x").alias("underwriter_tier"), F.when(key % 6 < 5, (key % 6 * 20).cast("string")).otherwise("").alias("risk_factor_count"))
    kept = extract.with_risk_count(extract.with_underwriter_tier(given)).select("listing_id", F.col("underwriter_tier").alias("given_tier"), F.col("risk_factor_count").alias("given_risks"))
    return told.join(kept, "listing_id")


@query("""
, pr AS (SELECT corp_code, listing_date, min(open_price) AS open_price FROM p_listings WHERE open_price IS NOT NULL AND corp_code % 3 <> 0 GROUP BY 1, 2)
SELECT listing_id, round(pr.open_price, 2) AS first_open, CASE WHEN c_nationkey < 20 THEN c_mktsegment ELSE '기타' END AS sector_name
FROM p_listings l LEFT JOIN pr USING (corp_code, listing_date) JOIN customer ON c_custkey = corp_code
""")
def first_day_prices(spark, d):
    """Listings with first-day prices, absent for a third of companies, and sectors, absent for five nations."""
    rows = P.listings(spark, d).withColumn("ticker", F.col("corp_code").cast("string"))
    prices = rows.filter("open_price is not null and corp_code % 3 <> 0").select("ticker", "listing_date", F.col("open_price").alias("first_open"))
    sectors = P.table(spark, d, "customer").filter("c_nationkey < 20").select(F.col("c_custkey").cast("string").alias("ticker"), F.col("c_mktsegment").alias("sector_name"))
    out = joins.with_sector(joins.with_prices(rows, prices), sectors, default="기타")
    return out.select("listing_id", F.round("first_open", 2).alias("first_open"), "sector_name")


@query("""
, f AS (SELECT o_orderkey AS rcept_no, o_custkey AS corp_code, o_orderdate::DATE AS rcept_dt FROM orders WHERE o_orderstatus = 'O'),
  dm AS (SELECT o_custkey AS corp_code, o_orderdate::DATE AS demand_dt, min(o_orderkey) AS demand_no FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT rcept_no, f.corp_code, rcept_dt, demand_dt, demand_no FROM f ASOF LEFT JOIN dm ON f.corp_code = dm.corp_code AND f.rcept_dt <= dm.demand_dt -- p_
""")
def demand_of_filings(spark, d):
    """Open orders as filings, finished ones of the same customer as demand filings."""
    orders = P.table(spark, d, "orders").select("o_orderstatus", F.col("o_custkey").alias("corp_code"), F.col("o_orderdate").cast("date").alias("rcept_dt"), F.col("o_orderkey").alias("rcept_no"))
    demand = orders.filter("o_orderstatus = 'F'").select("corp_code", "rcept_dt", F.col("rcept_no").alias("demand_no"))
    return joins.nearest_demand(orders.filter("o_orderstatus = 'O'").drop("o_orderstatus"), demand)


@query("""
, s AS (SELECT corp_code, CASE WHEN eps > 0 THEN least(500.0, greatest(0.0, offering_price / eps)) END AS per FROM p_fin)
SELECT corp_code, CASE WHEN (SELECT median(per) FROM s) > 0 THEN round(per / (SELECT median(per) FROM s), 6) END AS per_vs_median FROM s
""")
def per_vs_whole_median(spark, d):
    """Without a sector column, over the median of all."""
    rows = P.financials(spark, d).withColumn("per", features.offering_per())
    return features.with_group_median_ratio(rows, "per", None, "r").select("corp_code", F.round("r", 6).alias("per_vs_median"))


@query("""
SELECT listing_id, CASE WHEN listing_id % 5 = 0 THEN NULL ELSE least(20, greatest(0, listing_id % 31 - 5)) END::INTEGER AS same_day_ipo_count,
  CASE WHEN listing_id % 4 = 0 THEN NULL ELSE round(secondary_shares / total_post_listing_shares, 6) END AS secondary_offering_ratio, round(new_shares / total_post_listing_shares, 6) AS float_share_ratio FROM p_offer
""")
def given_features(spark, d):
    """Columns that a table brings are kept; counts are held between 0 and 20, texts that are no numbers are NULL."""
    key = F.col("listing_id")
    rows = P.offers(spark, d).withColumns({"n": F.when(key % 5 == 0, "x").otherwise((key % 31 - 5).cast("string")), "sec": F.when(key % 4 != 0, F.col("secondary_shares") / F.col("total_post_listing_shares"))})
    out = features.with_same_day_count(rows, given="n")
    return out.select("listing_id", "same_day_ipo_count", F.round(features.secondary_ratio(given="sec"), 6).alias("secondary_offering_ratio"), F.round(features.float_ratio(public="new_shares"), 6).alias("float_share_ratio"))


SEGMENTS = [("AUTOMOBILE", 20.0, 2.0), ("BUILDING", 8.0, 0.8), ("MACHINERY", 12.0, 1.1)]
#: Rounds a double as it is written, half up.
DIGITS = "round(({})::DOUBLE::VARCHAR::DECIMAL(38, 20), {})::DOUBLE"
SEGMENT_ROWS = ", ".join(f"('{s}', {a}::DOUBLE, {b}::DOUBLE)" for s, a, b in SEGMENTS)


@query(f"""
, m AS (SELECT * FROM (VALUES {SEGMENT_ROWS}) AS t(sector, mper, mpbr)),
  a AS (SELECT f.*, CASE WHEN corp_code % 10 <> 3 THEN offering_price END AS price, coalesce(mper, 16.0) AS mper, coalesce(mpbr, 1.3) AS mpbr FROM p_fin f LEFT JOIN m USING (sector))
SELECT corp_code, {DIGITS.format("CASE WHEN eps > 0 THEN price / eps WHEN net_income_t0 > 0 AND total_shares > 0 THEN price * total_shares / net_income_t0 END / mper", 2)} AS per_vs_sector,
  {DIGITS.format("CASE WHEN equity > 0 THEN price * total_shares / equity END / mpbr", 2)} AS pbr_vs_sector,
  CASE WHEN operating_income_t0 > 0 AND operating_income_t2 > 0 THEN {DIGITS.format("pow(operating_income_t0 / operating_income_t2, 0.5) - 1", 4)} END AS income_cagr,
  CASE WHEN operating_income_t1 > 0 AND operating_income_t0 <> 0 THEN {DIGITS.format("operating_income_t0 / operating_income_t1 - 1", 4)} END AS income_yoy,
  CASE WHEN revenue_t0 > 0 THEN {DIGITS.format("net_income_t0 / revenue_t0", 4)} END AS net_margin, price IS NULL AS analysis_error FROM a
""")
def sector_ratios(spark, d):
    """Ratios by sectors of which some match and others take the default; prices are missing for a tenth."""
    rows = P.financials(spark, d).withColumn("offering_price", F.when(F.col("corp_code") % 10 != 3, F.col("offering_price")))
    out = rubric.rubric(rows, spark.createDataFrame(SEGMENTS, "sector string, per double, pbr double"))
    return out.select("corp_code", "per_vs_sector", "pbr_vs_sector", "income_cagr", "income_yoy", "net_margin", "analysis_error")


@query("""
SELECT corp_code, total, CASE WHEN total >= 75 THEN 'A' WHEN total >= 60 THEN 'B' WHEN total >= 45 THEN 'C' ELSE 'D' END AS grade
FROM (SELECT c_custkey AS corp_code, round((0.4 * (c_acctbal % 100) + 0.3 * (c_nationkey * 4) + 0.2 * (c_custkey % 101) + 0.1 * (c_custkey % 37))::DOUBLE::VARCHAR::DECIMAL(38, 12), 1)::DOUBLE AS total FROM customer WHERE c_acctbal >= 0) -- p_
""")
def total_grades(spark, d):
    """Weighted totals of four scores and their grades."""
    c = P.table(spark, d, "customer").filter("c_acctbal >= 0")
    scores = {"valuation": F.col("c_acctbal") % 100, "growth": F.col("c_nationkey") * 4.0, "profitability": (F.col("c_custkey") % 101).cast("double"), "stability": (F.col("c_custkey") % 37).cast("double")}
    total = rubric.total_score(scores)
    return c.select(F.col("c_custkey").alias("corp_code"), total.alias("total")).withColumn("grade", rubric.grade(F.col("total")))
