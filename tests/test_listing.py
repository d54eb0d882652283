"""Hand-computed cases of the listing operators."""

import datetime as dt
import html
import json
import math
import random
import re

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from debutlens.functions import extract
from debutlens.functions.cleaning import clean_name, clip, day, number
from debutlens.operators import catalog, diagnostics, features, joins, keyed_tables, rubric, scoring
from debutlens.operators.quantiles import exact_percentiles, medians
from debutlens.plans import filings
from debutlens.plans import proxies as P
from debutlens.plans.queries import QUERIES
from debutlens.sources import tables

D = dt.date


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_cleaning_gives_null_for_bad_values(spark):
    r = one(spark, number(F.lit("1,250.5")).alias("a"), number(F.lit("x")).alias("b"), number(F.lit("NaN")).alias("c"), clip(F.lit(None).cast("double"), 0.0, 1.0).alias("d"), day(F.lit("20251340")).alias("e"), clean_name(F.lit("㈜ 가나다(주)")).alias("f"))
    assert r == (1250.5, None, None, None, None, "가나다")


FILING = """<div><b>공모 개요</b><br/>
희망공모가액 : 7,100&nbsp;～&nbsp;8,900 원 <i>확정 공모가</i>: 9,050원
모집주식수 : 640,000주 (매출주식수 160,000 주)
발행주식총수 3,200,000 주
<td>인수회사</td> : 푸른&middot;바다 증권 외
상장예정일 : 2031.7.4
최대주주 등 보호예수 8개월, 최대주주 특수관계인 1년 6개월
위험요소 1. 경기 2. 환율 ③ 원가 ④ 소송</div>"""


def test_offering_filing_fields(spark):
    df = spark.createDataFrame([("1", FILING), ("2", ""), ("3", "상장 예정일 2025년 13월 40일 신주모집 ,,, 주")], "id string, html string").select("id", extract.plain_text(F.col("html")).alias("t"))
    rows = {r["id"]: r for r in df.select("id", *[c.alias(k) for k, c in extract.offering_fields(F.col("t")).items()]).collect()}
    assert tuple(rows["1"])[1:] == (7100, 8900, 9050, 640000, 160000, 3200000, "푸른·바다 증권", D(2031, 7, 4), 18, 4, True)
    assert tuple(rows["2"])[1:] == (None,) * 10 + (False,)
    assert rows["3"]["listing_date"] is None and rows["3"]["new_shares"] is None


def test_plain_text_equals_the_standard_decoder(spark):
    raw = ["<p>a &amp; b</p>", "&lt;x&gt; &copy; &#44032; &hellip;", None, "", " a\u00a0 \n b<br>c", "&nbsp;", "5 < 6 &unknown; &eacute"]
    want = [None if t is None else re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", t))).strip() for t in raw]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(raw)], "i int, t string").orderBy("i").select(extract.plain_text(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in got] == want


def test_demand_fields(spark):
    text = "경쟁률 1,250.5 : 1 합계 1,000,000 주 확약없음 400,000 주 15일 100,000 주 1개월 100,000 주 3개월 150,000 주 6개월 250,000 주"
    r = one(spark, *[c.alias(k) for k, c in extract.demand_fields(F.lit(text)).items()])
    assert tuple(r) == (1250.5, 0.25, 0.15, 0.1, 0.1, 0.4, True)
    counted = F.lit("합계 12 1,000,000 주")
    assert one(spark, extract.shares_after(counted, "합계").alias("a"), extract.shares_after(counted, "합계", skip_count_column=True).alias("b")) == (None, 1000000)


def test_underwriter_tier(spark):
    rows = spark.createDataFrame([("NH 투자증권",), ("대신증권㈜",), ("다른증권",), (None,)], "n string").select(extract.underwriter_tier(F.col("n")).alias("t")).collect()
    assert [r["t"] for r in rows] == [1, 2, 3, None]


def test_scalar_features(spark):
    df = spark.createDataFrame([(16.0, 12.0, 15.0, 3.0, 1.0, None), (10.0, 10.0, 10.0, None, None, 5.0), (None, 1.0, 2.0, 1.0, 0.0, 0.0)], "offering_price double, price_band_low double, price_band_high double, new_shares double, secondary_shares double, total_post_listing_shares double")
    rows = df.select(features.band_position().alias("p"), features.band_exceeded(features.band_position()).alias("x"), features.secondary_ratio().alias("s"), features.float_ratio().alias("f")).collect()
    assert [tuple(r) for r in rows] == [(pytest.approx(4 / 3), 1, 0.25, None), (0.5, 0, None, 0.0), (None, 0, 0.0, None)]


def test_index_momentum_and_strict_asof(spark):
    days = [D(2024, 1, 1) + dt.timedelta(i) for i in range(70)]
    index = spark.createDataFrame([("KOSPI", d, 100.0 + i) for i, d in enumerate(days)], "index_code string, date date, close double")
    asked = spark.createDataFrame([(1, days[6]), (2, days[0]), (3, None), (4, D(2030, 1, 1)), (5, days[5])], "listing_id long, listing_date date")
    got = {r["listing_id"]: r for r in features.asof_momentum(asked, index, "KOSPI", "kospi").collect()}
    assert got[1]["kospi_momentum_5d"] == 0.05 and got[5]["kospi_momentum_5d"] == 0.0
    assert got[2]["kospi_momentum_5d"] == got[3]["kospi_momentum_5d"] == 0.0
    assert got[4]["kospi_momentum_60d"] == pytest.approx(169 / 109 - 1, abs=1e-6)


@pytest.mark.parametrize("strict", [False, True])
def test_recent_mean_equals_a_plain_loop(spark, strict):
    rng = random.Random(3)
    rows = [(i, D(2020, 1, 1) + dt.timedelta(rng.randrange(0, 900, 7)), rng.choice(["a", "b", None]), None if rng.random() < 0.3 else float(rng.randrange(100))) for i in range(300)]
    df = spark.createDataFrame(rows, "listing_id long, listing_date date, sector_name string, v double")
    got = {r["listing_id"]: r["m"] for r in features.recent_mean(df, "v", 4, "m", strict_date=strict).collect()}
    for i, d, _, _ in rows:
        before = sorted((x[1], x[0], x[3]) for x in rows if x[3] is not None and ((x[1] < d) if strict else (x[1], x[0]) < (d, i)))
        last = [x[2] for x in before[-4:]]
        assert got[i] == (pytest.approx(sum(last) / len(last)) if last else None)


def test_imputer_leaves_no_nulls_and_keeps_bounds(spark):
    df = spark.createDataFrame([("5000", None, 0.5), ("x", None, None), ("10", None, -1.0)], "institutional_demand_ratio string, underwriter_tier int, debt_ratio double")
    fitted = catalog.Imputer().fit(df)
    assert fitted.fills["underwriter_tier"] == 2.0 and fitted.fills["institutional_demand_ratio"] == 2505.0 and fitted.fills["offering_per"] == 0.0
    out = fitted.transform(df)
    assert out.columns == [f.name for f in catalog.FEATURES]
    for r in out.collect():
        for f in catalog.FEATURES:
            assert r[f.name] is not None and (f.low is None or f.low <= r[f.name] <= f.high)
    assert len(catalog.features_upto("core")) == 13 and len(catalog.features_upto("secondary")) == 24


def test_rubric_of_two_companies(spark):
    names = "revenue_t0 double, revenue_t1 double, revenue_t2 double, operating_income_t0 double, operating_income_t1 double, operating_income_t2 double, net_income_t0 double, total_liabilities double, equity double, eps double, offering_price double, total_shares double, interest_expense double, sector string"
    rows = [(1210.0, 1100.0, 1000.0, 121.0, 100.0, 100.0, 80.0, 200.0, 400.0, 4.0, 44.0, 10.0, 11.0, "화학"), (90.0, 100.0, 100.0, -9.0, 1.0, 2.0, -18.0, 500.0, 100.0, None, 13.0, 10.0, 3.0, "absent")]
    df = spark.createDataFrame(rows, names)
    b, a = rubric.rubric(df).orderBy("sector").collect()
    assert (a["per"], a["pbr"], a["ev_ebitda"], a["per_vs_sector"], a["pbr_vs_sector"], a["revenue_cagr"], a["income_cagr"]) == (11.0, 1.1, 5.3, 1.0, 1.1, 0.1, 0.1)
    assert (a["valuation_score"], a["growth_score"], a["profitability_score"], a["stability_score"], a["total_score"], a["grade"]) == (49.0, 65.0, 70.0, 85.0, 61.6, "B")
    assert (b["per"], b["per_flag"], b["valuation_score"], b["growth_score"], b["profitability_score"], b["stability_score"], b["total_score"], b["grade"]) == (None, "deficit", 30.0, 39.9, 11.0, 40.0, 30.2, "D")
    assert rubric.rubric(df, legacy_cagr=True).orderBy("sector").collect()[1]["revenue_cagr"] == -0.0909
    assert [r["analysis_error"] for r in rubric.rubric(df.withColumn("total_shares", F.when(F.col("sector") == "화학", F.col("total_shares")))).orderBy("sector").collect()] == [True, False]


def test_windows_never_train_on_validation(spark):
    df = spark.createDataFrame([(i, D(2015, 1, 1) + dt.timedelta(7 * i)) for i in range(600)], "listing_id long, listing_date date")
    w = joins.walk_windows(df)
    rows = w.orderBy("window").collect()
    assert len(rows) == 33 and [r["window"] for r in rows] == list(range(33))
    valid = joins.validation_rows(df, w)
    assert valid.count() == 848 and valid.select("listing_id").distinct().count() == 437
    assert valid.filter("listing_date < split").isEmpty()


def test_causes(spark):
    names = "id int, actual double, pred double, error double, kospi_mom_20d double, kospi_mom_5d double, same_day_ipo_count int, float_share_ratio double, recent_ipo_avg_return_sector double, secondary_offering_ratio double"
    rows = [(1, 1.0, 2.0, -1.0, -0.1, 0.0, 9, 0.0, 0.0, 0.0), (2, 1.0, -2.0, 3.0, None, -0.05, 0, 0.0, 0.0, 0.0), (3, 1.0, 0.0, 1.0, 0.0, 0.0, 4, 0.0, 0.0, 0.0), (4, 1.0, 0.0, 1.0, 0.0, 0.0, 0, 0.7, 0.0, 0.0), (5, 1.0, 0.0, 1.0, 0.0, 0.0, 0, 0.0, -51.0, 0.0), (6, 1.0, 0.0, 1.0, 0.0, 0.0, 0, 0.0, 0.0, 0.6), (7, 1.0, 0.0, 1.0, None, None, None, None, None, None)]
    out = diagnostics.with_cause(spark.createDataFrame(rows, names)).orderBy("id").collect()
    assert [r["cause"][0] for r in out] == list("AABBCDE")
    assert out[0]["overshoot"] and not out[0]["direction_wrong"] and out[1]["direction_wrong"]
    assert [r["error_sigma"] for r in diagnostics.with_sigma(spark.createDataFrame([(1.0, 0.0), (1.0, 0.0)], "actual double, pred double")).collect()] == [0.0, 0.0]


def test_keyed_tables(spark):
    old = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, x int, y int")
    new = spark.createDataFrame([("b", None, 21), ("c", 3, None)], "k string, x int, y int")
    assert sorted(map(tuple, keyed_tables.upsert_known(old, new, ["k"]).collect())) == [("a", 1, 10), ("b", 2, 21), ("c", 3, None)]
    assert sorted(map(tuple, keyed_tables.upsert_given(old, new, ["k"]).collect())) == [("a", 1, 10), ("b", None, 21), ("c", 3, None)]
    models = spark.createDataFrame([("m", "1", True, "champion", 1), ("m", "2", False, "trained", 2)], "name string, version string, is_champion boolean, status string, promoted_at int")
    assert sorted((r["version"], r["is_champion"], r["status"]) for r in keyed_tables.promote(models, "m", "2").collect()) == [("1", False, "retired"), ("2", True, "champion")]
    with pytest.raises(ValueError):
        keyed_tables.promote(models, "m", "3")


def test_requests(spark):
    names = "id int, institutional_demand_ratio double, lockup_6m_ratio double, offering_price_band_position double, underwriter_tier int"
    df = spark.createDataFrame([(1, 100.0, 0.5, 1.1, 1), (2, None, 0.5, 1.0, 1), (3, 1.0, 1.2, 0.0, 4)], names)
    out = {r["id"]: r["violations"] for r in scoring.validate(df).collect()}
    assert out[1] == [] and out[2] == ["institutional_demand_ratio required"] and out[3] == ["lockup_6m_ratio out of range", "underwriter_tier out of range"]
    r = scoring.complete(df.filter("id = 1"), ["lockup_weighted_score", "band_exceeded", "recent_ipo_avg_return_all", "absent"]).first()
    assert tuple(r) == (0.5, 1.0, 10.0, 0.0)


def test_incremental_append(spark, tmp_path):
    path = str(tmp_path / "filings")
    batch = spark.createDataFrame([("1", D(2024, 1, 2)), ("2", D(2025, 1, 2))], "rcept_no string, rcept_dt date")
    tables.append_new(batch.limit(1), path)
    tables.append_new(batch, path)
    assert spark.read.parquet(path).count() == 2


def test_streamed_filings_are_stored_once(spark, tmp_path):
    from debutlens.streaming.filings import store_filings, stream_filings

    landed = tmp_path / "landed"
    landed.mkdir()
    page = lambda *keys: json.dumps({"list": [{"rcept_no": k, "corp_name": "a", "report_nm": name, "rcept_dt": "20240102"} for k, name in keys]})
    equity, other = "증권신고서(지분증권)", "사업보고서"
    stored = []
    for i, keys in enumerate([[("1", equity), ("1", equity), ("2", other)], [("1", equity), ("3", equity), (None, equity)]]):
        (landed / f"{i}.json").write_text(page(*keys))
        store_filings(stream_filings(spark, str(landed)), str(tmp_path / "table"), str(tmp_path / "state")).awaitTermination()
        stored.append(sorted(r["rcept_no"] for r in spark.read.parquet(str(tmp_path / "table")).collect()))
    assert stored == [["1"], ["1", "3"]]


def test_consolidated_statements_win(spark):
    names = "corp_code string, year int, fs_div string, account_id string, thstrm_amount string"
    df = spark.createDataFrame([("a", 2024, "CFS", "ifrs-full_Revenue", "1,000"), ("a", 2024, "OFS", "ifrs-full_Revenue", "5"), ("b", 2024, "OFS", "ifrs-full_Equity", "7"), ("b", 2024, "OFS", "other", "8")], names)
    assert sorted(map(tuple, tables.statement_amounts(df).collect())) == [("a", 2024, "revenue", 1000.0), ("b", 2024, "equity", 7.0)]


def test_model_round_trip(spark, tmp_path):
    from debutlens.operators.model import ReturnModel, walk_forward

    rng = random.Random(1)
    rows = [(i, D(2020, 1, 1) + dt.timedelta(3 * i), float(x), 10.0 * x + rng.random() - 20) for i in range(120) for x in [rng.randrange(5)]]
    df = spark.createDataFrame(rows, "listing_id long, listing_date date, x double, open_return_pct double")
    fitted = ReturnModel(["x"], maxIter=2, maxDepth=2).fit(df)
    fitted.save(str(tmp_path / "m"))
    again = ReturnModel.load(str(tmp_path / "m"))
    assert sorted(map(tuple, fitted.predict(df).select("listing_id", "pred", "up_prob").collect())) == sorted(map(tuple, again.predict(df).select("listing_id", "pred", "up_prob").collect()))
    out = walk_forward(df, ["x"], windows={"first_days": 200, "valid_days": 90, "step_days": 90, "min_train": 20, "min_valid": 5}, maxIter=2, maxDepth=2)
    assert out.count() > 0 and out.agg(F.avg("abs_error")).first()[0] < 30


def test_empty_tables_and_zeros_have_defined_results(spark):
    from debutlens.operators import model

    empty = spark.createDataFrame([], "actual double, pred double, window int")
    r = diagnostics.error_distribution(empty).first()
    assert (r["n"], r["mean"], r["within_1_sigma_pct"], r["e_0_5"]) == (0, None, None, 0)
    assert diagnostics.run_summary(empty).first()["outlier_rate"] == 0.0
    top = model.top_importance(spark.createDataFrame([("a", 0.0), ("b", 0.0)], "feature string, importance double"), 2)
    assert [r["importance_pct"] for r in top.collect()] == [0.0, 0.0]
    days = [("KOSPI", D(2024, 1, 1) + dt.timedelta(i), 0.0 if i == 1 else 5.0) for i in range(8)]
    got = features.index_momentum(spark.createDataFrame(days, "index_code string, date date, close double"), (5,)).orderBy("date").collect()
    assert [r["mom_5d"] for r in got][5:] == [0.0, 0.0, 0.0]


def test_recent_mean_keeps_repeated_and_text_keys(spark):
    rows = [("a", D(2024, 1, 1), 1.0), ("b", D(2024, 1, 2), 3.0), ("b", D(2024, 1, 2), 3.0), ("c", None, 5.0), ("d", D(2024, 2, 1), None)]
    df = spark.createDataFrame(rows, "ticker string, listing_date date, v double")
    got = features.recent_mean(df, "v", 2, "m", key="ticker").collect()
    assert len(got) == 5 and {r["ticker"]: r["m"] for r in got if r["ticker"] != "b"} == {"a": None, "c": None, "d": 3.0}


def test_repeated_new_keys_are_refused(spark):
    old = spark.createDataFrame([("a", 1)], "k string, x int")
    new = spark.createDataFrame([("b", 2), ("b", 3)], "k string, x int")
    with pytest.raises(Exception, match="new rows repeat a key"):
        keyed_tables.upsert_known(old, new, ["k"]).collect()
    assert keyed_tables.upsert_given(old, keyed_tables.latest(new, ["k"], [F.desc("x")]), ["k"]).count() == 2


def test_tails_and_ranks_equal_a_plain_sort(spark):
    rng = random.Random(5)
    rows = [(i, D(2020, 1, 1) + dt.timedelta(rng.randrange(12))) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "i int, d date")
    order = [i for i, d in sorted(rows, key=lambda x: (x[1] is not None, x[1], x[0]))]
    assert [r["i"] for r in joins.with_rank(df, ["d", "i"]).orderBy("__rank").collect()] == order
    for k in (0, 1, 7, 60, 500):
        tail = {r["i"] for r in joins.chronological_tail(df, k, ["d", "i"]).filter("is_tail").collect()}
        assert tail == set(order[1:][max(0, 60 - k):])


def test_nearest_demand_breaks_ties_alike(spark):
    f = spark.createDataFrame([("1", "a", D(2024, 1, 5)), ("2", "a", D(2024, 3, 1)), ("3", None, D(2024, 1, 1)), ("4", "b", None)], "rcept_no string, corp_code string, rcept_dt date")
    d = spark.createDataFrame([("a", D(2024, 1, 5), 9), ("a", D(2024, 1, 5), 4), ("a", D(2024, 1, 1), 1), ("a", D(2024, 2, 1), 2), (None, D(2024, 2, 1), 3), ("b", D(2024, 1, 1), 5)], "corp_code string, rcept_dt date, n int")
    got = {r["rcept_no"]: (r["demand_dt"], r["n"]) for r in joins.nearest_demand(f, d).collect()}
    assert got == {"1": (D(2024, 1, 5), 4), "2": (None, None), "3": (None, None), "4": (None, None)}


def test_a_failing_window_is_left_out(spark, monkeypatch):
    from debutlens.operators import model

    df = spark.createDataFrame([(i, D(2020, 1, 1) + dt.timedelta(5 * i), float(i % 3), float(i % 7) - 3) for i in range(100)], "listing_id long, listing_date date, x double, open_return_pct double")
    fit, calls = model.ReturnModel.fit, []

    def broken(self, *args):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("no fit")
        return fit(self, *args)

    monkeypatch.setattr(model.ReturnModel, "fit", broken)
    out = model.walk_forward(df, ["x"], threads=1, windows={"first_days": 200, "valid_days": 90, "step_days": 90, "min_train": 20, "min_valid": 5}, maxIter=1, maxDepth=1)
    assert {r["window"] for r in out.select("window").distinct().collect()} == set(range(1, len(calls)))


def test_files_of_a_run(spark, tmp_path):
    rows = spark.createDataFrame([(1, D(2024, 1, 1), "a", 60.0, 1.0, 0), (2, D(2024, 1, 2), "b", 2.0, 1.0, 0)] + [(i, D(2024, 2, 1), "c", 1.0, 1.0, 1) for i in range(3, 30)], "listing_id int, listing_date date, corp_name string, actual double, pred double, window int")
    rows = rows.withColumns({c: F.lit(0.0) for c in ("ci_90_low", "ci_90_high", "ci_50_low", "ci_50_high")})
    causes = diagnostics.with_cause(diagnostics.outliers(rows))
    tables.write_outliers_csv(causes, str(tmp_path / "o"))
    assert spark.read.option("header", True).csv(str(tmp_path / "o")).columns == list(tables.OUTLIER_COLUMNS)
    tables.write_report(diagnostics.run_report(rows, causes), str(tmp_path / "r"))
    report = json.loads(next((tmp_path / "r").glob("*.json")).read_text())
    assert report["outliers"]["causes"] == {"E_unknown": 1} and report["backtest"]["n"] == 29 and report["by_year"][0]["year"] == 2024


def test_percentiles_equal_the_built_in_ones(spark):
    dice = random.Random(4)
    rows = [(dice.choice(["a", "b", None]), dice.choice([None, 0.0, -0.0, 1.5, dice.gauss(0, 9), dice.gauss(0, 9)])) for _ in range(900)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None), ("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("inf", float("inf"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    shares = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    plain = [F.percentile(F.col("v") + 0.0, F.lit(p)).alias(c) for c, p in shares.items()]
    show = lambda out: sorted(map(str, out.collect()))
    assert show(exact_percentiles(df, "v", shares, ["k"])) == show(df.filter("v is not null").groupBy("k").agg(*plain))
    assert show(exact_percentiles(df.filter("k < 'c'"), "v", shares)) == show(df.filter("k < 'c'").agg(*plain))
    assert exact_percentiles(df.limit(0), "v", shares).first() == (None,) * 5
    assert exact_percentiles(df.limit(0), "v", shares, ["k"]).count() == 0
    assert medians(df.filter("k = 'two'").withColumn("w", F.lit(None).cast("double")), ["v", "w"]) == {"v": 1.5, "w": None}


def test_scores_next_to_a_tie_round_as_their_sql(spark):
    """50 - 36.82 - 7.53 is 5.65, but a bit less in doubles."""
    row = {"corp_code": 1, "sector": "x", "revenue_t0": 233692.67, "revenue_t1": 275129.14, "revenue_t2": 585353.53, "offering_price": 1.0, "total_shares": 1.0}
    assert rubric.rubric(spark.createDataFrame([row])).first()["growth_score"] == 5.7


def order_tables(spark, path, lines):
    """lines: key, price, discount; each an order of its own customer."""
    spark.createDataFrame([(k, 1, 1.0, p, d, 0.0) for k, p, d in lines], "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(k, k, "F", dt.datetime(2000, 1, 3)) for k, *_ in lines], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(k, f"c{k}", "x") for k, *_ in lines], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{path}/customer.parquet")
    return str(path)


def test_prices_next_to_a_tie_round_as_their_sql(spark, tmp_path):
    """21747.115 and 1213.245 in doubles: what is written, and what a hundred times it is, lie on two sides of the tie."""
    d = order_tables(spark, tmp_path, [(387439, 22891.70, 0.05), (410860, 1348.05, 0.10)])
    got = {r["listing_id"]: r["open_price"] for r in P.listings(spark, d).collect()}
    assert got == {387439: 21747.12, 410860: 1213.24}
    assert QUERIES["extreme_returns"](spark, d).first()["n"] == 1


def test_targets_next_to_a_tie_round_as_their_sql(spark, tmp_path):
    d = order_tables(spark, tmp_path, [(387439, 22891.70, 0.05), (410860, 1348.05, 0.10)])
    got = {r["listing_id"]: (r["open_return_pct"], r["far"]) for r in QUERIES["listing_targets"](spark, d).collect()}
    assert got == {387439: (-5.0, False), 410860: (-10.0004, True)}


def test_prices_of_filings_are_added_as_their_lines_lie(spark, tmp_path):
    """Next to a whole number the mean's digits depend on the order of its sum: another one gives a unit less or more."""
    rng, a, b, c = random.Random(3), 0.0, 0.0, 0.0
    while math.floor((a + b + c) / 3) == math.floor((b + c + a) / 3):
        a, b, c = (round(rng.uniform(1e3, 1e5), 2) for _ in range(3))
    (tmp_path / "lineitem.parquet").mkdir()
    for i, prices in enumerate(([a], [b, None, c])):  # two files, so two tasks
        n = len(prices)
        lines = {"l_orderkey": [7] * n, "l_linenumber": list(range(n)), "l_quantity": [1.0] * n, "l_extendedprice": prices, "l_returnflag": ["N"] * n}
        pq.write_table(pa.table(lines), tmp_path / "lineitem.parquet" / f"{i}.parquet")
    with duckdb.connect(config={"threads": 1}) as con:
        (want,) = con.execute(f"SELECT floor(avg(l_extendedprice)) FROM '{tmp_path}/lineitem.parquet/*.parquet'").fetchone()
    assert filings.filing_fields(spark, str(tmp_path)).first()["offering_price"] == want == math.floor((a + b + c) / 3)
