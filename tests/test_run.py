"""The whole run on a small table: stopped in the middle, run again, read from what it stored."""

import datetime as dt
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from debutlens.operators import run
from debutlens.sources import tables
from debutlens.sources.versions import VersionedTable

DAY = dt.date(2020, 1, 1)
SMALL = {"maxIter": 2, "maxDepth": 2}
WINDOWS = {"first_days": 60, "valid_days": 30, "step_days": 60}


def test_a_run_goes_on_where_it_was_stopped(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    rows = [(i, f"c{i}", DAY + dt.timedelta(days=i), rng.choice("ab"), 1000 + i, rng.uniform(-20, 60) if i % 9 else None, rng.uniform(1, 900), i % 4 == 0) for i in range(120)]
    listings = spark.createDataFrame(rows, "listing_id long, corp_name string, listing_date date, sector_name string, offering_price long, open_return_pct double, institutional_demand_ratio double, band_exceeded boolean")
    index = spark.createDataFrame([(c, DAY + dt.timedelta(days=i), 1000.0 + rng.uniform(-90, 90)) for i in range(120) for c in ("KOSPI", "KOSDAQ")], "index_code string, date date, close double")
    out = str(tmp_path / "run")
    go = lambda: run.listing_run(listings, index, out, windows=WINDOWS, backtest=SMALL, final=SMALL)

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(run, "final_model", killed)
        with pytest.raises(KeyboardInterrupt):
            go()
    stamps = {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}
    assert not Path(f"{out}/model").exists() and not Path(f"{out}/report").exists()
    names = go()
    assert names == ["institutional_demand_ratio", "band_exceeded", "kospi_momentum_5d", "kospi_momentum_20d", "recent_ipo_avg_return_sector", "recent_ipo_avg_return_all"]
    assert all(p.stat().st_mtime_ns == t for p, t in stamps.items())  # nothing that was stored is written again
    registry = VersionedTable(spark, f"{out}/model_registry")
    assert go() == names and registry.versions() == [0]
    row = registry.read().first()
    assert (row["name"], row["status"], row["is_champion"], row["feature_names"], row["hyperparams"]["maxIter"]) == ("baseline", "trained", False, names, "2")
    scored = tables.read_table(spark, f"{out}/ipo_predictions", "ipo_predictions")
    log = {r["window_num"]: (r["n_train"], r["n_valid"]) for r in tables.read_table(spark, f"{out}/backtest_results", "backtest_results").collect()}
    known = [r for r in rows if r[5] is not None]
    first = known[0][2]
    split = first + dt.timedelta(days=60)
    assert log == {0: (sum(r[2] < split for r in known), sum(split <= r[2] < split + dt.timedelta(days=30) for r in known))}
    assert scored.count() == log[0][1] and scored.filter("offering_price is null or corp_name is null").isEmpty()
    report = json.loads(next(Path(f"{out}/report").glob("part-*.json")).read_text())
    assert report["backtest"]["mae"] == row["mae"] == scored.agg(F.round(F.avg("abs_error"), 3)).first()[0]
    outliers = tables.read_table(spark, f"{out}/outlier_log", "outlier_log")
    assert report["outliers"]["n_outliers"] == outliers.count() and sum(report["outliers"]["causes"].values()) == outliers.count()
    assert isinstance(report["recommended"], list)
