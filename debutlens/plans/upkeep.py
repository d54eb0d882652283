"""Registered queries of tables kept up by versions, of time slices, and of models as tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import catalog, features, imputing, joins, keyed_tables, quantiles, timeline, trees
from ..sources import tables
from ..sources.store import scratch, stored
from ..sources.versions import VersionedTable
from . import proxies as P
from .jobs import WIDE, imputed_sql, wide_rows
from .queries import _master, query, returns


@query("""
WITH o AS (SELECT c_custkey AS corp_code, c_name AS corp_name, c_mktsegment AS market, c_acctbal AS price FROM customer),
  n AS (SELECT o_custkey AS corp_code, max(o_orderpriority) AS market, CASE WHEN max(o_totalprice) > 200000 THEN round(max(o_totalprice), 2) END AS price FROM orders GROUP BY 1),
  v1 AS (SELECT corp_code, corp_name, coalesce(n.market, o.market) AS market, coalesce(n.price, o.price) AS price FROM o FULL JOIN n USING (corp_code)),
  g AS (SELECT s_suppkey AS corp_code, s_name AS corp_name, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS price FROM supplier),
  v2 AS (SELECT corp_code, CASE WHEN g.corp_code IS NULL THEN v1.corp_name ELSE g.corp_name END AS corp_name, market, CASE WHEN g.corp_code IS NULL THEN v1.price ELSE g.price END AS price
    FROM v1 FULL JOIN g USING (corp_code))
SELECT 0 AS version, * FROM o UNION ALL SELECT 1, * FROM v1 UNION ALL SELECT 2, * FROM v2
""")
def versioned_master(spark, d):
    """A master table created, then upserted twice, one batch of it retried; all three versions read at the end."""
    old, new = _master(spark, d)
    table = VersionedTable(spark, scratch(spark, "master"))
    given = P.table(spark, d, "supplier").select(F.col("s_suppkey").alias("corp_code"), F.col("s_name").alias("corp_name"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("price"))
    table.update(lambda _: old, batch="created")
    for _ in range(2):  # the second time the batch is there
        table.update(lambda rows: keyed_tables.upsert_known(rows, new, ["corp_code"]), batch="orders")
    table.update(lambda rows: keyed_tables.upsert_given(rows, given, ["corp_code"]), batch="suppliers")
    first, second, third = (table.read(v).select(F.lit(i).alias("version"), *old.columns) for i, v in enumerate(table.versions()))
    return first.union(second).union(third)


@query("""
SELECT year(o_orderdate)::INTEGER AS year, o_orderkey % 5 = 0 AS late, count(*)::BIGINT AS n, min(o_orderkey)::BIGINT AS first_no FROM orders GROUP BY 1, 2
""")
def appended_filings(spark, d):
    """Orders as filings, appended in two batches that overlap, each sent twice; only a batch's own years are compared."""
    orders = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("rcept_no"), F.col("o_orderdate").cast("date").alias("rcept_dt"))
    rows = orders.withColumns({"year": F.year("rcept_dt"), "late": F.col("rcept_no") % 5 == 0})
    table = VersionedTable(spark, scratch(spark, "filings"), ("year",))
    for batch, lot in (("early", rows.filter("not late")), ("all", rows.filter("late or year >= 1998"))) * 2:
        table.append(lot, "rcept_no", batch=batch)
    return table.read().groupBy("year", "late").agg(F.count(F.lit(1)).alias("n"), F.min("rcept_no").alias("first_no"))


@query("""
SELECT listing_id, m.price AS previous_price, m.day AS previous_day FROM p_listings l
ASOF LEFT JOIN (SELECT o_custkey, o_orderdate::DATE AS day, max(o_totalprice) AS price FROM orders GROUP BY 1, 2) m ON l.corp_code = m.o_custkey AND l.listing_date > m.day
""")
def previous_session(spark, d):
    """Each listing with its company's newest order day before it: as many keys as companies, both sides large."""
    listed = P.listings(spark, d).select("listing_id", "corp_code", "listing_date")
    days = P.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("corp_code"), F.col("o_orderdate").cast("date").alias("listing_date")).agg(F.max("o_totalprice").alias("price"))
    found = timeline.asof_join(listed, days.withColumn("day", F.col("listing_date")), by=["corp_code"], time="listing_date", prefix="previous_")
    return found.select("listing_id", "previous_price", "previous_day")


MEDIAN_COLUMNS = ["offering_price", "open_price", "open_return_pct", "same_day_ipo_count", "kospi_momentum_20d", "recent_ipo_avg_return_all", "recent_ipo_avg_return_sector"]


@query("""
, v AS (SELECT listing_id, avg(ret) OVER (ORDER BY listing_date, listing_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS a10,
    avg(ret) OVER (PARTITION BY sector_name ORDER BY listing_date, listing_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS a5 FROM p_listings WHERE ret IS NOT NULL),
  w AS (SELECT l.*, last_value(a10 IGNORE NULLS) OVER (ORDER BY listing_date, listing_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m10,
    last_value(a5 IGNORE NULLS) OVER (PARTITION BY sector_name ORDER BY listing_date, listing_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m5,
    count(*) OVER (PARTITION BY listing_date) AS same_day FROM p_listings l LEFT JOIN v USING (listing_id)),
  x AS (SELECT w.*, coalesce(m5, m10) AS s5, coalesce(mom_20d, 0.0) AS mom FROM w ASOF LEFT JOIN (SELECT * FROM p_momentum WHERE index_code = 'KOSPI') m ON w.listing_date > m.date),
  e AS (SELECT min(listing_date) AS a, max(listing_date) AS b FROM x),
  t AS (SELECT s::DATE AS split, (row_number() OVER (ORDER BY s) - 1)::INTEGER AS "window" FROM e, unnest(generate_series((a + 1095)::TIMESTAMP, (b - 180)::TIMESTAMP, INTERVAL 90 DAY)) AS u(s)),
  j AS (SELECT "window", x.* FROM x JOIN t ON listing_date < split)
SELECT "window", 'offering_price' AS feature, round(median(offering_price), 4) AS median FROM j GROUP BY 1
UNION ALL SELECT "window", 'open_price', round(median(open_price), 4) FROM j GROUP BY 1
UNION ALL SELECT "window", 'open_return_pct', round(median(ret), 4) FROM j GROUP BY 1
UNION ALL SELECT "window", 'same_day_ipo_count', round(median(same_day), 4) FROM j GROUP BY 1
UNION ALL SELECT "window", 'kospi_momentum_20d', round(median(mom), 4) FROM j GROUP BY 1
UNION ALL SELECT "window", 'recent_ipo_avg_return_all', round(median(m10), 4) FROM j GROUP BY 1
UNION ALL SELECT "window", 'recent_ipo_avg_return_sector', round(median(s5), 4) FROM j GROUP BY 1
""")
def training_medians(spark, d):
    """The medians of seven columns over the training rows of every walk-forward window, in one pass."""
    rows = features.with_same_day_count(features.with_temperature(returns(spark, d)))
    rows = stored(features.asof_momentum(rows, P.index_close(spark, d), "KOSPI", "kospi", (20,)), "rows")
    splits = [r["split"] for r in joins.walk_windows(rows).orderBy("window").collect()]  # a few dozen dates
    found = quantiles.expanding_medians(rows, MEDIAN_COLUMNS, "listing_date", splits)
    return found.select("window", "feature", F.round("median", 4).alias("median"))


@query(imputed_sql())
def pipeline_imputed(spark, d):
    """All core and secondary features through a pipeline of imputer and assembler, fitted, saved and loaded."""
    names = [f.name for f in WIDE]
    rows = wide_rows(spark, d)
    path = scratch(spark, "pipeline")
    Pipeline(stages=[imputing.CatalogImputer(names=names), VectorAssembler(inputCols=names, outputCol="x")]).fit(rows).write().save(path)
    out = PipelineModel.load(path).transform(rows).select("listing_id", vector_to_array("x").alias("x"))
    return out.select("listing_id", *[F.round(F.col("x")[i], 5).alias(c) for i, c in enumerate(names)])


#: A small ensemble over an offer's columns: (tree, weight, node, feature, threshold, value).
ENSEMBLE = [
    (0, 1.0, 1, "institutional_demand_ratio", 3.5, None), (0, 1.0, 2, "lockup_6m_ratio", 0.4, None), (0, 1.0, 3, None, None, 12.5), (0, 1.0, 4, None, None, -3.0), (0, 1.0, 5, None, None, 4.25),
    (1, 0.05, 1, "lockup_1m_ratio", 0.2, None), (1, 0.05, 2, None, None, -40.0), (1, 0.05, 3, "new_shares", 60.0, None), (1, 0.05, 6, None, None, 20.0), (1, 0.05, 7, None, None, 70.0),
    (2, 0.05, 1, "offering_price", 36000.0, None), (2, 0.05, 2, None, None, 16.0), (2, 0.05, 3, None, None, -8.0),
]


@query("""
, s AS (SELECT listing_id, CASE WHEN institutional_demand_ratio <= 3.5 THEN CASE WHEN lockup_6m_ratio <= 0.4 THEN -3.0 ELSE 4.25 END ELSE 12.5 END
    + CASE WHEN lockup_1m_ratio <= 0.2 THEN -40.0 ELSE CASE WHEN new_shares <= 60.0 THEN 20.0 ELSE 70.0 END END * 0.05::DOUBLE
    + CASE WHEN offering_price <= 36000.0 THEN 16.0 ELSE -8.0 END * 0.05::DOUBLE AS score FROM p_offer)
SELECT listing_id, round(score, 4) AS score, round(1 / (1 + exp(-2 * score)), 6) AS up_prob FROM s
""")
def ensemble_scores(spark, d):
    """Offers scored by the nodes of an ensemble, as fitted models give them; a node table stored and read again."""
    path = scratch(spark, "nodes")
    trees.node_table(spark, ENSEMBLE).write.parquet(path)
    nodes = [tuple(r) for r in spark.read.schema(trees.NODES).parquet(path).collect()]  # a row per node
    return P.offers(spark, d).select("listing_id", F.round(trees.score(nodes), 4).alias("score"), F.round(trees.probability(nodes), 6).alias("up_prob"))


@query("""
SELECT l.listing_id AS ipo_id, l.corp_name, round(l.ret, 4) AS open_return, count(*) OVER (PARTITION BY l.listing_date)::INTEGER AS same_day_ipo_count,
  round(coalesce(m.mom_20d, 0.0), 6) AS kospi_momentum_20d, round(coalesce(q.mom_20d, 0.0), 6) AS kosdaq_momentum_20d, 28::INTEGER AS n_features
FROM p_listings l ASOF LEFT JOIN (SELECT * FROM p_momentum WHERE index_code = 'KOSPI') m ON l.listing_date > m.date
  ASOF LEFT JOIN (SELECT * FROM p_momentum WHERE index_code = 'KOSDAQ') q ON l.listing_date > q.date
""")
def feature_table(spark, d):
    """Master and feature tables in their canonical schemas, written, read and joined; momentum of both indexes."""
    rows, index = features.with_same_day_count(returns(spark, d)), P.index_close(spark, d)
    rows = features.asof_momentum(features.asof_momentum(rows, index, "KOSPI", "kospi", (5, 20, 60)), index, "KOSDAQ", "kosdaq", (20,))
    built = stored(rows.withColumns({"ipo_id": F.col("listing_id"), "id": F.col("listing_id"), "open_return": F.col("open_return_pct"), "feature_version": F.lit("v1")}), "built")
    master, own = scratch(spark, "ipo-master"), scratch(spark, "ipo-features")
    tables.write_table(built, master, "ipo_master")
    tables.write_table(built, own, "ipo_features")
    left = tables.read_table(spark, master, "ipo_master").select("id", "corp_name", "open_return")
    right = tables.read_table(spark, own, "ipo_features")
    n = len(catalog.available(right, catalog.FEATURES)[0]) + 1  # the catalog's and the bear market flag
    both = joins.master_with(left, right.drop("id"))
    return both.select("ipo_id", "corp_name", F.round("open_return", 4).alias("open_return"), "same_day_ipo_count", F.round("kospi_momentum_20d", 6).alias("kospi_momentum_20d"), F.round("kosdaq_momentum_20d", 6).alias("kosdaq_momentum_20d"), F.lit(n).alias("n_features"))
