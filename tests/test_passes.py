"""Passes that must not repeat: one cut for all windows, rows of a fit made once, rows of a run stored."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from debutlens.operators import joins, model, run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_cuts_in_one_pass(spark):
    rng, day = random.Random(1), datetime.date(2020, 1, 1)
    rows = [(None if rng.random() < 0.1 else day + datetime.timedelta(rng.randrange(20)), i) for i in range(200)] + [(day, None)]
    df = spark.createDataFrame(rows, "d date, i int")
    ends = [(day + datetime.timedelta(n), k) for n in (1, 5, 9, 20) for k in (1, 7, 40, 500)] + [(None, 3)]
    for (split, k), cut in zip(ends, joins.tail_cuts(df, ends, ["d", "i"]), strict=True):
        before = sorted((r for r in rows if r[0] and (split is None or r[0] < split)), key=lambda r: (r[0], r[1] is not None, r[1] or 0))
        got = df.filter(joins.from_cut(df, cut, ["d", "i"]) & (F.lit(True) if split is None else F.col("d") < F.lit(split))).collect()
        assert sorted(map(tuple, got), key=str) == sorted(before[-k:], key=str), (split, k)
    assert "Join" not in plan_of(joins.chronological_tail(df, 7, ["d", "i"]))


def test_a_fit_makes_its_rows_once(spark):
    made = spark.sparkContext.accumulator(0)

    def told(x):
        made.add(1)
        return float(x % 7)

    rows = spark.range(200, numPartitions=2).select(F.udf(told, "double")("id").alias("a"), ((F.col("id") % 5) - 2).cast("double").alias("y"))
    fitted = model.ReturnModel(["a"], "y", maxIter=2, maxDepth=2).fit(rows, rows.limit(0))
    assert fitted.classifier and made.value == 200
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_steps_of_a_run_read_stored_rows(spark, tmp_path, monkeypatch):
    day = datetime.date(2020, 1, 1)
    listings = spark.createDataFrame([(i, day + datetime.timedelta(i), "s", "c", float(i)) for i in range(5)], "listing_id long, listing_date date, sector_name string, corp_name string, open_return_pct double")
    index = spark.createDataFrame([("KOSPI", day, 1.0), ("KOSDAQ", day, 1.0)], "index_code string, date date, close double")

    class Stop(Exception):
        pass

    def seen(rows, *_):
        assert "Join" not in plan_of(rows) and rows.count() == 5
        raise Stop

    monkeypatch.setattr(run, "store_backtest", seen)
    with pytest.raises(Stop):
        run.listing_run(listings, index, str(tmp_path))
