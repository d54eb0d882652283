"""Joins with hot names, landed pages, catalog coverage, folds side by side, options of metrics."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from debutlens.operators import catalog, diagnostics, joins, model
from debutlens.sources import tables


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("most", [1, 3, 7, 1000])
def test_split_join_gives_every_pair(spark, most):
    rng = random.Random(most)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c", "", None])
    left = [(key(), rng.randrange(3)) for _ in range(60)]  # rows repeat
    right = [(key(), rng.randrange(3)) for _ in range(40)] + [("alone", 0)]
    out = joins.split_join(spark.createDataFrame(left, "k string, x int").repartition(3), spark.createDataFrame(right, "k string, y int"), "k", most)
    assert out.columns == ["k", "x", "y"]
    want = Counter((k, x, y) for k, x in left for j, y in right if k is not None and k == j)
    assert Counter(map(tuple, out.collect())) == want and sum(want.values()) > 400


def test_split_join_of_empty_tables_and_clashing_names(spark):
    none, one = spark.createDataFrame([], "k string, x int"), spark.createDataFrame([("a", 1)], "k string, y int")
    assert joins.split_join(none, one, "k").collect() == [] and joins.split_join(one, none, "k", 1).collect() == []
    with pytest.raises(ValueError, match="both sides have y"):
        joins.split_join(one, one.withColumnRenamed("y", "Y"), "k")


def test_split_join_keeps_other_columns(spark):
    left = spark.createDataFrame([("a", [1], None, 5), ("a", [2], "t", 6)], "k string, row array<int>, n string, pa int")
    right = spark.createDataFrame([("a", 1.5)], "k string, `left` double")
    assert rows_of(joins.split_join(left, right, "k", 1)) == [("a", [1], None, 5, 1.5), ("a", [2], "t", 6, 1.5)]


def test_no_task_of_a_split_join_gets_a_hot_name_whole(spark):
    left = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("x"))
    right = spark.range(50).select(F.lit("hot").alias("k"), F.col("id").alias("y"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shares = joins.split_join(left, right, "k", 100).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sum(r["count"] for r in shares) == 150_000 and len(shares) == 4 and max(r["count"] for r in shares) < 90_000


def test_pages_per_line_and_broken_ones(spark, tmp_path):
    page = {"page": 0, "output": [{"ISU_CD": "1", "LIST_DD": "2020/01/02", "more": 1}, {"ISU_CD": "2", "ISU_ABBRV": "b", "LIST_DD": "2020-01-02"}, {"ISU_CD": "3", "LIST_DD": "soon"}]}
    (tmp_path / "pages.json").write_text("\n".join([json.dumps(page), "no page", json.dumps({"message": "none"}), json.dumps({"output": []})]))
    out = tables.landed_calendar(spark, str(tmp_path), lines=True)
    got = sorted((r["ticker"], r["corp_name"], str(r["listing_date"]), r["same_day_ipo_count"]) for r in out.collect())
    assert got == [("1", None, "2020-01-02", 2), ("2", "b", "2020-01-02", 2), ("3", None, "None", None)]


def test_coverage_of_the_catalog(spark):
    rows = spark.createDataFrame([("1,000", 2, None), ("x", None, None)], "offering_per string, underwriter_tier int, debt_ratio double")
    got = {r["name"]: (r["available"], r["n_values"]) for r in catalog.coverage(rows).collect()}
    assert len(got) == len(catalog.FEATURES)
    assert (got["offering_per"], got["underwriter_tier"], got["debt_ratio"], got["band_exceeded"]) == ((True, 1), (True, 1), (True, 0), (False, None))
    assert {(r["available"], r["n_values"]) for r in catalog.coverage(spark.range(1)).collect()} == {(False, None)}


def test_folds_side_by_side_give_the_same_error(spark):
    rng = random.Random(5)
    rows = spark.createDataFrame([(i, f"2020-01-{i % 28 + 1:02d}", float(i % 7), rng.uniform(-1, 1) + i % 7) for i in range(90)], "id int, d string, a double, y double").withColumn("d", F.to_date("d"))
    run = lambda threads: model.cross_validate(rows, ["a"], "y", ["d", "id"], 3, threads, maxIter=2, maxDepth=2).collect()
    assert run(1) == run(3)


def test_options_of_metrics(spark):
    rows = spark.createDataFrame(
        [(1, 0, 4.0, 1.0), (1, 1, 4.0, 3.0), (2, 0, -2.0, -6.0), (3, 1, 5.0, 12.0)], "listing_id long, window int, actual double, pred double"
    ).withColumns({"listing_date": F.lit("2020-02-03").cast("date"), "ci_90_low": F.col("pred") - 4, "ci_90_high": F.col("pred") + 4})
    every, newest = (diagnostics.overall_metrics(rows, o).first() for o in (False, True))
    assert (every["n"], every["mae"]) == (4, 3.75) and (newest["n"], newest["mae"], newest["coverage_90"]) == (3, 4.0, 0.6667)
    own, literal = (diagnostics.error_pattern(rows, o).first()["direction_acc"] for o in (False, True))
    assert own == 1.0 and literal == 0.5  # error + actual: 7, 5, 2, -2 with actual 4, 4, -2, 5


def test_rows_of_a_split_join_are_sent_a_bounded_number_of_times(spark):
    sc = spark.sparkContext
    left, right = (spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias(c)) for n, c in ((600, "x.1"), (400, "y")))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sc.setJobGroup("pairs", "pairs")
    try:
        out = joins.split_join(left, right, "k", 2)  # slices of two rows send each row 200 or 300 times
        got = out.toPandas()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert list(got.columns) == ["k", "x.1", "y"] and len(got) == len(got.drop_duplicates()) == 240_000
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = {s for j in sc.statusTracker().getJobIdsForGroup("pairs") for s in sc.statusTracker().getJobInfo(j).stageIds}
    sent = sum(sc._jsc.sc().statusStore().lastStageAttempt(s).shuffleWriteRecords() for s in stages)
    assert 64 * (600 + 400) <= sent < 64 * (600 + 400) + 100  # 240 000 and more before


@pytest.mark.parametrize(("rows", "most", "want"), [(1, 20, 1), (21, 20, 2), (1280, 20, 64), (120_000, 43, 64), (1_800_000, 43, 64), (64_000_001, 20, 65), (3_000_001, 1_000_000, 4), (200_000_000, 2_000_000, 100)])
def test_slices_of_a_hot_name(spark, rows, most, want):
    assert spark.range(1).select(joins.slices(F.lit(rows).cast("long"), most)).first()[0] == want
