"""Versioned tables, time slices, medians of expanding windows, ensembles as columns, pipeline stages."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from debutlens.operators import catalog, diagnostics, imputing, model, quantiles, timeline, trees
from debutlens.sources import tables
from debutlens.sources.versions import Conflict, VersionedTable

DAY = dt.date(2020, 1, 1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    one, two = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (2, None)], "k int, v string")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.update(lambda old: one) == 0
    pinned = table.read()

    def killed(*_):
        raise KeyboardInterrupt  # after the rows are written, before the version is published

    with monkeypatch.context() as m:
        m.setattr(table, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            table.update(lambda old: two)
    assert table.versions() == [0] and rows_of(table.read()) == [(1, "a")]
    assert table.update(lambda old: two) == 1
    assert rows_of(pinned) == [(1, "a")] and rows_of(table.read(0)) == [(1, "a")] and rows_of(table.read()) == rows_of(two)
    lost = table.clean(keep=2)
    assert len(lost) == 1 and rows_of(table.read(0)) == [(1, "a")]  # only the dead writer's folder
    table.update(lambda old: old.filter("k = 2"))
    assert len(table.clean(keep=1)) == 2 and table.versions() == [2] and rows_of(table.read()) == [(2, None)]


def test_two_writers_of_one_version(spark, tmp_path):
    table, other = (VersionedTable(spark, f"file://{tmp_path}/t") for _ in range(2))
    table.update(lambda old: spark.createDataFrame([(1,)], "k int"))
    calls = []

    def slow(old):
        calls.append(old.count())
        if len(calls) == 1:  # another writer commits meanwhile
            other.update(lambda o: o.union(spark.createDataFrame([(2,)], "k int")))
        return old.union(spark.createDataFrame([(3,)], "k int"))

    assert table.update(slow) == 2 and calls == [1, 2]
    assert rows_of(table.read()) == [(1,), (2,), (3,)]
    with pytest.raises(Conflict):
        table.publish(2, [], table.read().schema, [])
    assert rows_of(table.read()) == [(1,), (2,), (3,)]


def test_a_batch_is_appended_once_and_reads_its_own_years(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, f"file://{tmp_path}/t", ("year",))
    lot = lambda *rows: spark.createDataFrame(rows, "k string, year int, v int")
    assert table.append(lot(("a", 2020, 1), ("b", 2021, 2), ("b", 2021, 2), (None, 2020, 9)), "k", batch="x") == 0
    assert table.append(lot(("c", 2020, 3)), "k", batch="x") == 0  # the id is there
    again = lot(("b", 2021, 5), ("d", None, 4))
    plan = table.stored_keys(again, "k", 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2021" in plan
    assert table.append(again, "k", batch="y") == 1
    assert table.append(again, "k", batch="y") == 1 and table.append(again, "k") == 2  # nothing new without an id
    assert rows_of(table.read()) == [("a", 2020, 1), ("b", 2021, 2), ("d", None, 4)]
    assert rows_of(table.read(0)) == [("a", 2020, 1), ("b", 2021, 2)]
    with monkeypatch.context() as m:  # retried after a failure before publishing
        m.setattr(table, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.append(lot(("e", 2020, 6)), "k", batch="z")
    assert table.append(lot(("e", 2020, 6)), "k", batch="z") == 3 and table.read().count() == 4


@pytest.mark.parametrize("strict", [True, False])
def test_asof_join_equals_a_plain_loop(spark, strict):
    rng = random.Random(4)
    day = lambda: DAY + dt.timedelta(rng.randint(0, 30)) if rng.random() < 0.95 else None
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    left = [(i, key(), day()) for i in range(200)] + [(0, "hot", DAY)] * 3
    right = [(key(), day(), rng.randint(0, 99)) for _ in range(150)]
    l, r = spark.createDataFrame(left, "id int, k string, t date"), spark.createDataFrame(right, "k string, t date, v int")  # noqa: E741
    found = timeline.asof_join(l, r, by=["k"], time="t", strict=strict, prefix="r_", slice_rows=20)
    want = []
    for i, k, t in left:
        before = [(x, v) for c, x, v in right if c == k and None not in (k, t, x) and (x < t or (x == t and not strict))]
        want.append((i, k, t, *(max(before) if before else (None, None))))
    assert rows_of(found) == sorted(want, key=repr)
    assert rows_of(timeline.asof_join(l, r.limit(0), by=["k"], time="t")) == sorted([(*x, None, None) for x in left], key=repr)
    assert timeline.asof_join(l.limit(0), r, by=["k"], time="t").count() == 0


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_means_over_small_slices_equal_a_plain_loop(spark, strict, by):
    rng = random.Random(8)
    data = [(i, DAY + dt.timedelta(rng.randint(0, 40)), rng.choice(["x", "x", "y", None]), rng.choice([None, 1.0, 2.0, 5.0])) for i in range(300)]
    df = spark.createDataFrame(data, "id int, t date, g string, v double")
    dealt = timeline.dealt(df, [*by, "t"] if strict else [*by, "t", "id"], slice_rows=9)
    assert dealt.select(timeline.SLICE).distinct().count() > 10
    got = {r["id"]: r["m"] for r in timeline.mean_of_last(dealt, "v", 3, "m", by=by, time="t", key="id", strict_time=strict).collect()}
    for i, t, g, _ in data:
        seen = sorted((x, j, v) for j, x, h, v in data if v is not None and (not by or h == g) and (x < t if strict else (x, j) < (t, i)))[-3:]
        assert got[i] == (pytest.approx(sum(x[2] for x in seen) / len(seen)) if seen else None)


def test_expanding_medians_equal_one_median_a_window(spark):
    rng = random.Random(6)
    data = [(DAY + dt.timedelta(rng.randint(0, 50)), rng.choice([None, -1.5, 0.0, 2.25, 1e9, rng.random()]), rng.randint(0, 3), None) for _ in range(400)] + [(None, 7.0, 1, None)]
    df = spark.createDataFrame(data, "d date, a double, b int, c double")
    splits = [DAY, DAY + dt.timedelta(3), DAY + dt.timedelta(20), DAY + dt.timedelta(20), DAY + dt.timedelta(60)]
    got = {(r["window"], r["feature"]): r["median"] for r in quantiles.expanding_medians(df, ["a", "b", "c"], "d", splits).collect()}
    want = {}
    for w, s in enumerate(splits):
        for name, at in (("a", 1), ("b", 2)):
            values = [x[at] for x in data if x[0] is not None and x[0] < s and x[at] is not None]
            if values:
                want[w, name] = statistics.median(values)
    assert got == want
    assert quantiles.expanding_medians(df, ["a"], "d", []).count() == 0


def test_nodes_score_as_the_model_does(spark):
    rng = random.Random(1)
    data = [(i, rng.random(), rng.choice([0.0, 1.0, 2.0]), rng.gauss(0, 1)) for i in range(300)]
    df = spark.createDataFrame([(i, a, b, 9 * a - 4 * b + c) for i, a, b, c in data], "id int, a double, b double, y double")
    fitted = model.ReturnModel(["a", "b"], "y", maxIter=6, maxDepth=4).fit(df)
    nodes = fitted.nodes()
    assert len({r[0] for r in nodes["regressor"]}) == 6
    scored = fitted.predict(df.withColumns({"p": trees.score(nodes["regressor"]), "u": trees.probability(nodes["classifier"])}))
    for r in scored.collect():
        assert r["pred"] == pytest.approx(r["p"], abs=0.0051) and r["up_prob"] == pytest.approx(r["u"], abs=0.000051)
    exact = fitted.regressor.transform(df.withColumn("p", trees.score(nodes["regressor"])))
    assert exact.agg(F.max(F.abs(F.col("p") - F.col("__pred")))).first()[0] < 1e-9
    again = [tuple(r) for r in trees.node_table(spark, nodes["regressor"]).collect()]
    assert sorted(again, key=repr) == sorted(nodes["regressor"], key=repr)
    assert spark.range(1).select(trees.score([])).first()[0] == 0.0


def test_imputer_in_a_saved_pipeline(spark, tmp_path):
    names = ["institutional_demand_ratio", "underwriter_tier", "debt_ratio"]
    df = spark.createDataFrame([(1, "1,200", None, 3.0), (2, None, None, 50.0), (3, "bad", None, None)], "id int, institutional_demand_ratio string, underwriter_tier int, debt_ratio double")
    fitted = Pipeline(stages=[imputing.CatalogImputer(names=names), VectorAssembler(inputCols=names, outputCol="x")]).fit(df)
    fitted.write().overwrite().save(f"{tmp_path}/p")
    loaded = PipelineModel.load(f"{tmp_path}/p")
    plain = catalog.Imputer([f for f in catalog.FEATURES if f.name in names]).fit(df)
    want = {r["id"]: [r[n] for n in names] for r in plain.transform(df, ["id"]).collect()}
    got = {r["id"]: r["x"].toArray().tolist() for r in loaded.transform(df).collect()}
    assert got == want and not any(math.isnan(v) for x in got.values() for v in x)
    assert loaded.stages[0].transform(df.drop("debt_ratio")).columns == ["id", *[f.name for f in catalog.FEATURES if f.name in names]]
    assert [f.name for f in imputing.CatalogImputer().features()] == [f.name for f in catalog.FEATURES]


def test_pages_catalog_and_conforming_tables(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{"list": [{"rcept_no": "1", "corp_name": "a"},\n {"rcept_no": "2"}], "status": "000"}')
    (tmp_path / "p2.json").write_text('{"list": []}')
    (tmp_path / "p3.json").write_text('{"status": "013"}')
    assert rows_of(tables.read_pages(spark, str(tmp_path), "list", "rcept_no string, corp_name string")) == [("1", "a"), ("2", None)]
    have, lack = catalog.available(spark.createDataFrame([(1, 2)], "debt_ratio int, x int"), catalog.features_upto("secondary"))
    assert have == ["debt_ratio"] and len(lack) == 23
    summary = catalog.catalog_summary(spark).collect()
    assert sum(r["n"] for r in summary) == 27 and sum(r["n_core"] for r in summary) == 13
    assert catalog.catalog(spark, "core").count() == 13 and catalog.catalog(spark).filter("fill_na is null").count() == 0
    for name, n in (("ipo_master", 26), ("ipo_features", 34)):
        path = f"{tmp_path}/{name}"
        tables.write_table(spark.createDataFrame([(1, "x")], "id int, other string"), path, name)
        read = tables.read_table(spark, path, name)
        assert len(read.columns) == n and read.first()["id"] == 1 and read.schema == tables.schema(name)


def test_ranges_of_counted_values_have_bounded_rows(spark, monkeypatch):
    """However few the shuffle's partitions are, and with the same medians."""
    tables, plain = [], quantiles.stored
    monkeypatch.setattr(quantiles, "SLICE_ROWS", 100, raising=False)
    monkeypatch.setattr(quantiles, "stored", lambda df, name: tables.append(plain(df, name)) or tables[-1])
    got = quantiles.exact_percentiles(spark.range(4000).selectExpr("id * 1.5D as v"), "v", {"m": 0.5}).first()["m"]
    assert got == 3999 * 1.5 / 2
    rows = [r["count"] for r in tables[-1].groupBy("slice").count().collect()]
    assert sum(rows) == 4000 and max(rows) <= 300
