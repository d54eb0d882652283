"""A part that fails or is left out must not look like a result."""

import datetime as dt

import pytest

from debutlens.operators import model, run
from debutlens.plans import boosting, jobs, queries

WINDOWS = {"first_days": 200, "valid_days": 90, "step_days": 90}


def failing(monkeypatch, name, nth):
    """Makes the nth call of a model's method fail; tells the calls."""
    right, calls = getattr(model.ReturnModel, name), []

    def broken(self, *args):
        calls.append(1)
        if len(calls) == nth:
            raise ValueError("lost file")
        return right(self, *args)

    monkeypatch.setattr(model.ReturnModel, name, broken)
    return calls


def listings(spark, n=100):
    rows = [(i, "c", dt.date(2020, 1, 1) + dt.timedelta(5 * i), 1000 + i, float(i % 3), float(i % 7) - 3) for i in range(n)]
    return spark.createDataFrame(rows, "listing_id long, corp_name string, listing_date date, offering_price long, x double, open_return_pct double")


@pytest.mark.parametrize("name", ["fit", "predict"])
def test_a_back_test_fails_with_its_window(spark, monkeypatch, name):
    calls = failing(monkeypatch, name, 2)
    with pytest.raises(RuntimeError, match="window 1 failed by ValueError: lost file"):
        model.walk_forward(listings(spark, 200), ["x"], threads=1, windows=WINDOWS, whole=True, maxIter=1, maxDepth=1)
    assert len(calls) <= 3  # one may be under way; the others are not run


def test_a_run_stores_no_back_test_without_a_window(spark, tmp_path, monkeypatch):
    failing(monkeypatch, "fit", 1)
    with pytest.raises(RuntimeError, match="window . failed"):
        run.store_backtest(listings(spark), ["x"], str(tmp_path), "baseline", "v1", WINDOWS, 2, {"maxIter": 1, "maxDepth": 1})
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("query", [boosting.boosted_windows, jobs.walk_forward_backtest])
def test_registered_back_tests_fail_with_a_window(spark, monkeypatch, query):
    plain = queries.returns(spark, "/root/testdata/sf0.001").select("listing_id", "corp_name", "listing_date", "open_return_pct")
    few = lambda names: plain.selectExpr("*", *[f"double(listing_id % {i + 3}) as {c}" for i, c in enumerate(names)])
    monkeypatch.setattr(boosting, "rows_of", lambda *_: few(boosting.FEATURES))
    monkeypatch.setattr(jobs, "model_rows", lambda *_: few(jobs.MODEL_FEATURES))
    failing(monkeypatch, "fit", 1)
    with pytest.raises(RuntimeError, match="failed by ValueError: lost file"):
        query(spark, "/root/testdata/sf0.001")


def test_registered_folds_have_the_operators_own_settings(spark, monkeypatch):
    seen = []

    class Small(model.GBTRegressor):
        """Notes what it is asked for, and fits one tree of one split."""

        def __init__(self, **asked):
            seen.append(asked)
            super().__init__(**(asked | {"maxIter": 1, "maxDepth": 1}))

    rows = listings(spark, 60).selectExpr("*", *[f"double(listing_id % {i + 3}) as {c}" for i, c in enumerate(queries.MODEL_FEATURES)])
    monkeypatch.setattr(model, "GBTRegressor", Small)
    monkeypatch.setattr(jobs, "model_rows", lambda *_: rows)
    assert jobs.cross_validated(spark, "").count() == 1
    assert len(seen) == 5 and all(model.SETTINGS.items() <= asked.items() for asked in seen)


@pytest.mark.parametrize("folds", [-1, 0, 1, 31])
def test_folds_that_leave_nothing_to_fit_or_to_judge_are_refused(spark, folds):
    with pytest.raises(ValueError, match=f"30 rows can't be dealt into {folds} folds"):
        model.cross_validate(listings(spark, 30), ["x"], "open_return_pct", ["listing_date", "listing_id"], folds, maxIter=1, maxDepth=1)


def test_errors_of_folds_do_not_depend_on_how_the_rows_lie(spark):
    rows = listings(spark, 90)
    run = lambda df: model.cross_validate(df, ["x"], "open_return_pct", ["listing_date", "listing_id"], 3, 3, maxIter=2, maxDepth=2).collect()
    assert run(rows.coalesce(1)) == run(rows.repartition(7)) == run(rows.sort("x", "listing_id"))
