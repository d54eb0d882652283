"""A whole run over listings: features, back-test, final model, outliers and report, each step a stored table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables
from ..sources.store import is_whole, stored
from ..sources.versions import VersionedTable
from . import catalog, diagnostics, features, joins, keyed_tables
from .model import SETTINGS, ReturnModel, final_model, walk_forward

#: The rounds of the back-test's trees; the final model has those of SETTINGS.
BACKTEST = {"maxIter": 200, "maxDepth": 5}
#: Columns of the master table that later steps need beside the features.
MASTER = ["id", "corp_name", "listing_date", "sector_name", "offering_price", "open_return"]


def step(spark: SparkSession, path: str, make: Callable[[], None]) -> None:
    """Runs `make`, which writes `path`, unless a former run left it whole; so a run that was stopped goes on where it was."""
    if not is_whole(spark, path):
        make()


def store_features(listings: DataFrame, index: DataFrame, out: str) -> None:
    """Adds the market features and stores master and feature tables in their canonical schemas. `listings`: listing_id,
    listing_date, sector_name, open_return_pct, and any columns of the catalog and of the master table."""
    rows = features.with_same_day_count(features.with_temperature(listings))
    rows = features.asof_momentum(features.asof_momentum(rows, index, "KOSPI", "kospi"), index, "KOSDAQ", "kosdaq", (20,))
    rows = rows.withColumns({"id": F.col("listing_id"), "ipo_id": F.col("listing_id"), "open_return": F.col("open_return_pct")})
    tables.write_table(rows, f"{out}/ipo_features", "ipo_features")
    # the second table reads the first one's features no more, only the listings
    master = listings.withColumns({"id": F.col("listing_id"), "open_return": F.col("open_return_pct")})
    tables.write_table(master, f"{out}/ipo_master", "ipo_master")


def read_features(spark: SparkSession, out: str) -> DataFrame:
    """Master and features by listing_id, the catalog's features as doubles, the target as open_return_pct."""
    own = tables.read_table(spark, f"{out}/ipo_features", "ipo_features")
    own = own.withColumns({c: F.col(c).cast("double") for c in catalog.available(own, catalog.FEATURES)[0]})
    master = tables.read_table(spark, f"{out}/ipo_master", "ipo_master").select(*MASTER)
    both = joins.master_with(master, own.drop(*MASTER))
    return both.withColumnsRenamed({"ipo_id": "listing_id", "open_return": "open_return_pct"})


def store_backtest(rows: DataFrame, names: list[str], out: str, name: str, version: str, windows: dict, threads: int, settings: dict) -> None:
    """Predictions of all windows, then a row per window of the back-test's log. Nothing is stored if a window fails."""
    spark = rows.sparkSession
    kept = ("corp_name", "offering_price")
    tables.write_table(walk_forward(rows, names, keep=kept, threads=threads, windows=windows, whole=True, **settings), f"{out}/ipo_predictions", "ipo_predictions")
    metrics = diagnostics.window_metrics(tables.read_table(spark, f"{out}/ipo_predictions", "ipo_predictions")).drop("n")
    known = rows.filter(F.col("open_return_pct").isNotNull())
    told = joins.walk_windows(known, **windows).select("window", F.col("split").alias("train_end"), "valid_end", "n_train", "n_valid")
    log = metrics.join(told, "window").withColumnRenamed("window", "window_num").withColumns({"model_name": F.lit(name), "model_version": F.lit(version)})
    tables.write_table(log, f"{out}/backtest_results", "backtest_results")


def register(registry: VersionedTable, model: ReturnModel, metrics: DataFrame, name: str, version: str) -> int:
    """Commits the model's row to the registry once, as trained and no champion; `metrics` is one row of `overall_metrics`."""
    settings = F.create_map(*[F.lit(str(x)) for kv in sorted(model.settings.items()) for x in kv])
    told = {"name": F.lit(name), "version": F.lit(version), "hyperparams": settings, "feature_names": F.array(*map(F.lit, model.features)), "status": F.lit("trained"), "is_champion": F.lit(False)}
    row = tables.conform(metrics.withColumns(told), tables.schema("model_registry"))

    def change(old: DataFrame | None) -> DataFrame:
        return row if old is None else keyed_tables.upsert_given(old, row, ["name", "version"])

    return registry.update(change, batch=f"{name}/{version}")


def store_outliers(predictions: DataFrame, context: DataFrame, index: DataFrame, out: str) -> None:
    """The outliers with their causes as the log, and as the file of nine columns."""
    rows = diagnostics.with_index_context(diagnostics.with_listing_context(diagnostics.outliers(predictions), context), index)
    causes = diagnostics.with_cause(rows)
    tables.write_outliers_csv(causes, f"{out}/outliers")
    tables.write_table(causes.withColumnRenamed("listing_id", "ipo_id"), f"{out}/outlier_log", "outlier_log")


def store_report(predictions: DataFrame, causes: DataFrame, out: str) -> None:
    """The report of the run, with the recommended features by rank."""
    advice = diagnostics.recommendations(causes).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "suggestion"))), lambda x: x["suggestion"]).alias("recommended"))
    tables.write_report(diagnostics.run_report(predictions, causes).crossJoin(advice), f"{out}/report")  # one row each


def listing_run(
    listings: DataFrame, index: DataFrame, out: str, *, importance: str | None = "core", name: str = "baseline", version: str = "v1",
    windows: dict | None = None, threads: int = 2, backtest: dict | None = None, final: dict | None = None,
) -> list[str]:
    """Runs all steps below the folder `out`, and returns the features that were used, in catalog order.

    Tables: ipo_master, ipo_features, ipo_predictions, backtest_results, outlier_log, outliers (CSV), report (JSON), model
    and model_registry (versions). A step reads what the former ones stored; the last of a step's tables tells that it is
    done, and a run over the same folder leaves it out then. `importance` picks the catalog's features (None: all); of
    those, columns without any value are left out. `backtest` and `final` override the trees' settings.
    """
    spark = listings.sparkSession
    out = str(out).rstrip("/")
    step(spark, f"{out}/ipo_master", lambda: store_features(listings, index, out))
    rows = stored(read_features(spark, out), "run-rows")  # every step, and each pass of a fit, reads them again
    wanted = {f.name for f in catalog.features_upto(importance)}
    filled = {r["name"] for r in catalog.coverage(rows).filter("n_values > 0").collect()}  # a row per feature
    names = [f.name for f in catalog.FEATURES if f.name in wanted & filled]
    step(spark, f"{out}/backtest_results", lambda: store_backtest(rows, names, out, name, version, windows or {}, threads, BACKTEST | (backtest or {})))
    predictions = tables.read_table(spark, f"{out}/ipo_predictions", "ipo_predictions")

    def train() -> None:
        final_model(rows, names, "open_return_pct", ["listing_date", "listing_id"], **(SETTINGS | (final or {}))).save(f"{out}/model")

    step(spark, f"{out}/model/meta", train)
    register(VersionedTable(spark, f"{out}/model_registry"), ReturnModel(names, **(final or {})), diagnostics.overall_metrics(predictions), name, version)
    step(spark, f"{out}/outlier_log", lambda: store_outliers(predictions, rows, index, out))
    causes = tables.read_table(spark, f"{out}/outlier_log", "outlier_log")
    step(spark, f"{out}/report", lambda: store_report(predictions, causes, out))
    return names
