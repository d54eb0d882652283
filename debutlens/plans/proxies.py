"""Listing-like views over the order tables, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import rounded


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order as a listing; pending orders have no opening price yet."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        rounded(F.sum("l_extendedprice"), 2).alias("offering_price"),
        rounded(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))), 2).alias("open_price"),
    )
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("listing_id"), F.col("c_custkey").alias("corp_code"), F.col("c_name").alias("corp_name"),
        F.col("o_orderdate").cast("date").alias("listing_date"), F.col("c_mktsegment").alias("sector_name"), "offering_price",
        F.when(F.col("o_orderstatus") != "P", F.col("open_price")).alias("open_price"),
    )


def index_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean order price, half up to 4 places, in whole cents: sums of doubles would round ties by their order."""
    index = F.when(F.col("o_custkey") % 2 == 0, "KOSPI").otherwise("KOSDAQ")
    cents = table(spark, sf_dir, "orders").groupBy(index.alias("index_code"), F.col("o_orderdate").cast("date").alias("date")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("s"), F.count("o_totalprice").alias("n"))
    return cents.select("index_code", "date", (F.expr("(200 * s + n) div (2 * n)") / 10000).alias("close"))


def ordered_mean(scanned: DataFrame, c: str) -> Column:
    """The mean of a scanned column whose doubles are added as they lie in the table. A sum of doubles depends on the order,
    and that of an aggregate on how the scan is split; whoever rounds means down next to whole numbers needs one of them."""
    places = ["_metadata.file_path", "_metadata.row_index"][len(scanned.inputFiles()) == 1 :]  # paths are long, so not of one file
    rows = F.sort_array(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(*places, F.col(c).alias("v")))))
    return F.try_divide(F.aggregate(rows, F.lit(0.0), lambda total, x: total + x["v"]), F.count(c))


def offers(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """Order lines as the shares and commitments of an offer; if `ordered`, its price is an `ordered_mean`."""
    lines = table(spark, sf_dir, "lineitem")
    price = ordered_mean(lines, "l_extendedprice") if ordered else F.avg("l_extendedprice")
    q = F.col("l_quantity")
    total = F.sum(q)
    part = lambda n: F.sum(F.when(F.col("l_linenumber") == n, q)) / total
    return lines.groupBy(F.col("l_orderkey").alias("listing_id")).agg(
        F.min("l_extendedprice").alias("price_band_low"), F.max("l_extendedprice").alias("price_band_high"), price.alias("offering_price"),
        F.sum(F.when(F.col("l_returnflag") == "N", q)).alias("new_shares"), F.sum(F.when(F.col("l_returnflag") == "A", q)).alias("secondary_shares"), total.alias("total_post_listing_shares"),
        part(1).alias("lockup_6m_ratio"), part(2).alias("lockup_3m_ratio"), part(3).alias("lockup_1m_ratio"), part(4).alias("lockup_15d_ratio"), F.max("l_linenumber").cast("double").alias("institutional_demand_ratio"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("corp_code"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("account")).agg(F.round(F.sum("o_totalprice"), 2).alias("amount"))


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as companies: yearly order sums as revenues, the account balance as income."""
    orders = table(spark, sf_dir, "orders")
    year = lambda y: F.round(F.sum(F.when(F.year("o_orderdate") == y, F.col("o_totalprice"))), 2)
    sums = orders.groupBy("o_custkey").agg(year(2000).alias("revenue_t0"), year(1999).alias("revenue_t1"), year(1998).alias("revenue_t2"), year(1997).alias("revenue_3y_ago"), F.avg("o_totalprice").alias("offering_price"), F.count(F.lit(1)).cast("double").alias("total_shares"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    bal = F.col("c_acctbal")
    return c.join(sums, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("corp_code"), F.col("c_mktsegment").alias("sector"), "revenue_t0", "revenue_t1", "revenue_t2", "revenue_3y_ago", "offering_price", "total_shares",
        (bal * 2).alias("operating_income_t0"), (bal + 500).alias("operating_income_t1"), (bal + 1000).alias("operating_income_t2"), bal.alias("net_income_t0"),
        (F.col("c_nationkey") * 1000.0).alias("total_liabilities"), (F.abs(bal) * 3).alias("equity"), (bal / 10).alias("eps"), (F.col("c_nationkey") * 10.0).alias("interest_expense"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as predictions: the value against its type's mean."""
    e = table(spark, sf_dir, "events")
    means = e.groupBy("event_type").agg(F.round(F.avg("value") - 50, 4).alias("pred"), F.count(F.lit(1)).alias("n_type"))
    return e.join(F.broadcast(means), "event_type").select(
        F.col("event_id").alias("listing_id"), F.col("ts").cast("date").alias("listing_date"), F.col("user_id").cast("string").alias("corp_name"), F.round(F.col("value") - 50, 4).alias("actual"), "pred", "event_type",
        (F.col("pred") - 40).alias("ci_90_low"), (F.col("pred") + 40).alias("ci_90_high"), (F.col("pred") - 20).alias("ci_50_low"), (F.col("pred") + 20).alias("ci_50_high"),
        F.round(F.abs(F.col("pred")) / 100, 4).alias("up_prob"), F.dayofmonth("ts").alias("window"),
    )


CTE = """
lines AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS offering_price, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS open_price FROM lineitem GROUP BY 1),
p_listings AS (SELECT o_orderkey AS listing_id, c_custkey AS corp_code, c_name AS corp_name, o_orderdate::DATE AS listing_date, c_mktsegment AS sector_name, offering_price,
  CASE WHEN o_orderstatus <> 'P' THEN open_price END AS open_price,
  CASE WHEN o_orderstatus <> 'P' AND offering_price > 0 THEN (open_price / offering_price - 1) * 100 END AS ret
  FROM orders JOIN lines ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey),
p_index AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'KOSPI' ELSE 'KOSDAQ' END AS index_code, o_orderdate::DATE AS date,
  ((200 * sum(round(o_totalprice * 100)::BIGINT) + count(o_totalprice)) // (2 * count(o_totalprice)))::DOUBLE / 10000 AS close FROM orders GROUP BY 1, 2),
p_mom AS (SELECT *, row_number() OVER w AS n, lag(close, 5) OVER w AS c5, lag(close, 20) OVER w AS c20, lag(close, 60) OVER w AS c60 FROM p_index WINDOW w AS (PARTITION BY index_code ORDER BY date)),
p_momentum AS (SELECT index_code, date, close, coalesce(CASE WHEN n > 5 THEN round(close / c5 - 1, 6) END, 0.0) AS mom_5d,
  coalesce(CASE WHEN n > 20 THEN round(close / c20 - 1, 6) END, 0.0) AS mom_20d, coalesce(CASE WHEN n > 60 THEN round(close / c60 - 1, 6) END, 0.0) AS mom_60d FROM p_mom),
p_offer AS (SELECT l_orderkey AS listing_id, min(l_extendedprice) AS price_band_low, max(l_extendedprice) AS price_band_high, avg(l_extendedprice) AS offering_price,
  sum(l_quantity) FILTER (l_returnflag = 'N') AS new_shares, sum(l_quantity) FILTER (l_returnflag = 'A') AS secondary_shares, sum(l_quantity) AS total_post_listing_shares,
  sum(l_quantity) FILTER (l_linenumber = 1) / sum(l_quantity) AS lockup_6m_ratio, sum(l_quantity) FILTER (l_linenumber = 2) / sum(l_quantity) AS lockup_3m_ratio,
  sum(l_quantity) FILTER (l_linenumber = 3) / sum(l_quantity) AS lockup_1m_ratio, sum(l_quantity) FILTER (l_linenumber = 4) / sum(l_quantity) AS lockup_15d_ratio,
  max(l_linenumber)::DOUBLE AS institutional_demand_ratio FROM lineitem GROUP BY 1),
p_accounts AS (SELECT o_custkey AS corp_code, year(o_orderdate) AS year, o_orderstatus AS account, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY ALL),
p_sums AS (SELECT o_custkey, round(sum(o_totalprice) FILTER (year(o_orderdate) = 2000), 2) AS revenue_t0, round(sum(o_totalprice) FILTER (year(o_orderdate) = 1999), 2) AS revenue_t1,
  round(sum(o_totalprice) FILTER (year(o_orderdate) = 1998), 2) AS revenue_t2, round(sum(o_totalprice) FILTER (year(o_orderdate) = 1997), 2) AS revenue_3y_ago,
  avg(o_totalprice) AS offering_price, count(*)::DOUBLE AS total_shares FROM orders GROUP BY 1),
p_fin AS (SELECT c_custkey AS corp_code, c_mktsegment AS sector, revenue_t0, revenue_t1, revenue_t2, revenue_3y_ago, offering_price, total_shares, c_acctbal * 2 AS operating_income_t0,
  c_acctbal + 500 AS operating_income_t1, c_acctbal + 1000 AS operating_income_t2, c_acctbal AS net_income_t0, c_nationkey * 1000.0::DOUBLE AS total_liabilities, abs(c_acctbal) * 3 AS equity,
  c_acctbal / 10 AS eps, c_nationkey * 10.0::DOUBLE AS interest_expense FROM customer JOIN p_sums ON c_custkey = o_custkey),
p_means AS (SELECT event_type, round(avg(value) - 50, 4) AS pred FROM events GROUP BY 1),
p_pred AS (SELECT event_id AS listing_id, ts::DATE AS listing_date, user_id::VARCHAR AS corp_name, round(value - 50, 4) AS actual, pred, event_type, pred - 40 AS ci_90_low, pred + 40 AS ci_90_high,
  pred - 20 AS ci_50_low, pred + 20 AS ci_50_high, round(abs(pred) / 100, 4) AS up_prob, day(ts) AS "window", abs(round(value - 50, 4) - pred) AS e FROM events JOIN p_means USING (event_type))
"""
