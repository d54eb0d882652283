"""Boosted trees on pyspark.ml: return regressor, direction classifier, conformal intervals, walk-forward test."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .diagnostics import risk_grade
from ..sources.store import stored
from .joins import chronological_tail, from_cut, tail_cuts, walk_windows, with_rank
from .trees import nodes_of
from .quantiles import exact_percentiles, expanding_medians

#: The reference settings of the trees.
SETTINGS = {"maxIter": 300, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8, "seed": 42}


class ReturnModel:
    """Regressor on the return and classifier on its sign; the latter falls back to 0.8 / 0.2 by the sign of the
    prediction where a sign has fewer than two rows. q50 and q90 are quantiles of calibration errors."""

    def __init__(self, features: list[str], target: str = "open_return_pct", **settings):
        self.features, self.target, self.settings = features, target, SETTINGS | settings
        self.regressor = self.classifier = None
        self.q50 = self.q90 = 0.0

    def columns(self, rows: DataFrame) -> DataFrame:
        """The features and the target, as __y, as doubles."""
        return rows.select(*[F.col(c).cast("double") for c in self.features], F.col(self.target).cast("double").alias("__y"))

    @contextmanager
    def vectors(self, train: DataFrame) -> Iterator[DataFrame]:
        """The rows with a target, for fits, which pass over them several times: made once, and kept on disk so that trees
        have the memory."""
        rows = self.columns(train.filter(F.col(self.target).isNotNull())).withColumn("__up", (F.col("__y") > 0).cast("double"))
        made = self.assembler("__x").transform(rows).select("__x", "__y", "__up").persist(StorageLevel.DISK_ONLY)
        try:
            yield made
        finally:
            made.unpersist()

    def assembler(self, out: str) -> VectorAssembler:
        return VectorAssembler(inputCols=self.features, outputCol=out)

    def fit_regressor(self, vectors: DataFrame) -> None:
        self.regressor = PipelineModel([self.assembler("__x"), GBTRegressor(featuresCol="__x", labelCol="__y", predictionCol="__pred", **self.settings).fit(vectors)])

    def fit(self, train: DataFrame, calibration: DataFrame | None = None) -> ReturnModel:
        with self.vectors(train) as vectors:
            self.fit_regressor(vectors)
            signs = {r["__up"]: r["count"] for r in vectors.groupBy("__up").count().collect()}  # two rows at most
            if min(signs.get(0.0, 0), signs.get(1.0, 0)) >= 2:
                sign = GBTClassifier(featuresCol="__z", labelCol="__up", predictionCol="__cls", **self.settings).setRawPredictionCol("__raw").setProbabilityCol("__prob")
                self.classifier = PipelineModel([self.assembler("__z"), sign.fit(vectors.withColumnRenamed("__x", "__z"))])
        held = calibration if calibration is not None else train
        errors = self.regressor.transform(self.columns(held)).select(F.abs(F.col("__y") - F.col("__pred")).alias("e"))
        self.q50, self.q90 = (q or 0.0 for q in exact_percentiles(errors, "e", {"q50": 0.5, "q90": 0.9}).first())
        return self

    def nodes(self) -> dict[str, list[tuple]]:
        """The nodes of both ensembles (`trees.NODES`), by name; no classifier where it fell back."""
        found = {"regressor": nodes_of(self.regressor.stages[-1], self.features)}
        return found | ({"classifier": nodes_of(self.classifier.stages[-1], self.features)} if self.classifier else {})

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.regressor.transform(df.withColumns({c: F.col(c).cast("double") for c in self.features}))
        if self.classifier:
            out = self.classifier.transform(out).withColumn("up_prob", F.round(vector_to_array("__prob")[1], 4)).drop("__z", "__cls", "__raw", "__prob")
        else:
            out = out.withColumn("up_prob", F.when(F.col("__pred") > 0, 0.8).otherwise(0.2))
        return finished(out, self.q50, self.q90).drop("__x", "__pred")

    def importance(self, spark: SparkSession, k: int = 15) -> DataFrame:
        weights = self.regressor.stages[-1].featureImportances.toArray().tolist()
        return top_importance(spark.createDataFrame(list(zip(self.features, weights, strict=True)), "feature string, importance double"), k)

    def explain(self, scored: DataFrame, k: int = 5) -> DataFrame:
        """Adds top_features: the k features of the greatest overall importance with the row's values; NULL stays NULL."""
        best = [r["feature"] for r in self.importance(scored.sparkSession, k).collect()]  # k rows
        return scored.withColumn("top_features", F.array(*[F.struct(F.lit(c).alias("feature"), F.round(F.col(c).cast("double"), 4).alias("value")) for c in best]))

    def save(self, path: str) -> None:
        self.regressor.write().overwrite().save(f"{path}/regressor")
        if self.classifier:
            self.classifier.write().overwrite().save(f"{path}/classifier")
        spark = SparkSession.active()
        meta = spark.createDataFrame([(self.features, self.target, float(self.q50), float(self.q90), self.classifier is None)], "features array<string>, target string, q50 double, q90 double, fallback boolean")
        meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> ReturnModel:
        meta = SparkSession.active().read.schema("features array<string>, target string, q50 double, q90 double, fallback boolean").json(f"{path}/meta").first()
        model = cls(list(meta["features"]), meta["target"])
        model.regressor = PipelineModel.load(f"{path}/regressor")
        model.classifier = None if meta["fallback"] else PipelineModel.load(f"{path}/classifier")
        model.q50, model.q90 = meta["q50"], meta["q90"]
        return model


def finished(scored: DataFrame, q50: float, q90: float) -> DataFrame:
    """Adds pred, the intervals around the unrounded __pred, and the grade of the rounded values."""
    p = F.col("__pred")
    ends = {"ci_90_low": p - q90, "ci_90_high": p + q90, "ci_50_low": p - q50, "ci_50_high": p + q50}
    return scored.withColumns({"pred": F.round(p, 2)} | {k: F.round(c, 2) for k, c in ends.items()}).withColumn("risk_grade", risk_grade())


def top_importance(table: DataFrame, k: int) -> DataFrame:
    """The k greatest, with their share in percent of those k; 0 where all are 0, as of trees without a split."""
    top = table.orderBy(F.desc("importance"), "feature").limit(k)
    share = F.try_divide(100 * F.col("importance"), F.sum("importance").over(Window.partitionBy()))
    return top.withColumn("importance_pct", F.round(F.coalesce(share, F.lit(0.0)), 2))


#: Fixed value: rows of a partition that a fold trains on.
FOLD_ROWS = 100_000


def cross_validate(rows: DataFrame, features: list[str], target: str, order: list[str], folds: int = 5, threads: int = 2, **settings) -> DataFrame:
    """Mean and deviation of the regressor's mean absolute error over consecutive folds in order of `order`, a date first.

    Folds, two at least and of a row at least, are stored as a column and fitted side by side by a small pool of threads,
    whose jobs share the cluster. Trees draw rows by their place, so a fold's are dealt and sorted by rank: the error
    doesn't depend on how the rows lay or on the cores.
    """
    known = rows.filter(F.col(target).isNotNull())
    ranked, total = with_rank(known, order), known.count()
    if not 2 <= folds <= total:
        raise ValueError(f"{total} rows can't be dealt into {folds} folds")
    # as ntile does: the first folds have one row more
    size, more = divmod(total, folds)
    first = F.floor(F.col("__rank") / F.lit(size + 1))
    fold = F.when(F.col("__rank") < more * (size + 1), first).otherwise(more + F.floor((F.col("__rank") - more * (size + 1)) / F.lit(size)))
    parts = stored(ranked.select(*features, target, "__rank", fold.cast("int").alias("__f")), "folds")

    def error(f: int) -> float:
        model = ReturnModel(features, target, **settings)
        train = parts.filter(F.col("__f") != f).repartition(-(-total // FOLD_ROWS), "__rank").sortWithinPartitions("__rank")
        with model.vectors(train) as vectors:
            model.fit_regressor(vectors)
        scored = model.regressor.transform(model.columns(parts.filter(F.col("__f") == f)))
        return scored.agg(F.avg(F.abs(F.col("__y") - F.round("__pred", 2)))).first()[0]

    with ThreadPoolExecutor(threads) as pool:
        errors = list(pool.map(error, range(folds)))
    return rows.sparkSession.createDataFrame([(e,) for e in errors], "e double").agg(F.round(F.avg("e"), 3).alias("mae_mean"), F.round(F.stddev_pop("e"), 3).alias("mae_std"))


def final_model(rows: DataFrame, features: list[str], target: str, order: list[str], **settings) -> ReturnModel:
    """Trained on rows with a target, NULL as 0, but for the last 15 % (10 at least), which calibrate."""
    known = rows.filter(F.col(target).isNotNull()).fillna(0.0, features)
    tailed = chronological_tail(known, max(10, int(0.15 * known.count())), order)
    return ReturnModel(features, target, **settings).fit(tailed.filter("not is_tail"), tailed.filter("is_tail"))


def walk_forward(rows: DataFrame, features: list[str], *, target: str = "open_return_pct", date: str = "listing_date", key: str = "listing_id", keep: tuple[str, ...] = (), threads: int = 2, windows: dict | None = None, failed: list | None = None, whole: bool = False, **settings) -> DataFrame:
    """Predictions of every window (rows may be in two): context columns `keep`, actual, pred, intervals, window.

    Each window trains on the rows before its split: NULLs take the slice's medians, which one pass over the rows gives
    for all windows, and the last 15 % (5 at least) calibrate; one more pass finds where those start. Windows are a few dozen and run from a small pool of threads.
    With `whole` a window that fails is the failure of this, and windows not begun are not run. Without it, a failed window is left out and told in
    `failed` (window, reason); if all fail, so does this.
    """
    known = stored(rows.filter(F.col(target).isNotNull()), "known-rows")
    table = walk_windows(known, date, **(windows or {})).orderBy("window").collect()  # a few dozen dates
    fills = {w["window"]: dict.fromkeys(features, 0.0) for w in table}
    for r in expanding_medians(known, features, date, [w["split"] for w in table]).collect():  # a row per window and feature
        fills[table[r["window"]]["window"]][r["feature"]] = r["median"]

    order = [date, key]
    cuts = dict(zip((w["window"] for w in table), tail_cuts(known, [(w["split"], max(5, int(0.15 * w["n_train"]))) for w in table], order) if table else [], strict=True))
    reasons = [] if failed is None else failed

    def run(w) -> DataFrame | None:
        try:
            return one(w)
        except Exception as e:  # noqa: BLE001
            if whole:
                raise RuntimeError(f"window {w['window']} failed by {type(e).__name__}: {e}") from e
            logging.getLogger(__name__).exception("window %s is left out", w["window"])
            reasons.append((w["window"], f"{type(e).__name__}: {e}"))
            return None

    def one(w) -> DataFrame:
        train = known.filter(F.col(date) < F.lit(w["split"]))
        valid = known.filter((F.col(date) >= F.lit(w["split"])) & (F.col(date) < F.lit(w["valid_end"])))
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fills[w["window"]].items()}
        held = from_cut(known, cuts[w["window"]], order)
        model = ReturnModel(features, target, **settings).fit(train.filter(~held).withColumns(filled), train.filter(held).withColumns(filled))
        scored = model.predict(valid.withColumns(filled))
        return scored.select(key, date, *keep, F.col(target).alias("actual"), "pred", "up_prob", "ci_90_low", "ci_90_high", "ci_50_low", "ci_50_high", "risk_grade", (F.col(target) - F.col("pred")).alias("error"), F.abs(F.col(target) - F.col("pred")).alias("abs_error"), F.lit(w["window"]).alias("window"))

    with ThreadPoolExecutor(threads) as pool:
        parts = [p for p in pool.map(run, table) if p is not None]
    if table and not parts:
        raise RuntimeError(f"all {len(table)} windows failed, the first by {min(reasons)[1]}")
    if not parts:
        return rows.sparkSession.createDataFrame([], f"{key} long, {date} date, actual double, pred double, up_prob double, ci_90_low double, ci_90_high double, ci_50_low double, ci_50_high double, risk_grade string, error double, abs_error double, window int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
