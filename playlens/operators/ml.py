"""Distributed model training and the prediction chain (``pyspark.ml``).

Training is a batch job: the history is filtered/imputed once, kept on the
executors' disks (their memory is the estimators', which keep their own binned
rows and pass over them hundreds of times), and all size gates come from one
aggregation pass; each model is a ``Pipeline(VectorAssembler, estimator)``
fitted on executors, by as many tasks as the rows need: each pass costs its
tasks again.  Prediction is
a chain of ``PipelineModel.transform`` calls – narrow projections that run
inside the enrichment plan (or a streaming micro-batch) without a collect.
"""

from __future__ import annotations

import logging
import math
import os
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

LOG = logging.getLogger(__name__)

#: Training rows of one task; a boosted model makes some 350 passes, each with all its tasks.
ROWS_PER_TASK = 1_000_000


@dataclass
class ModelSpec:
    name: str
    features: list[str]
    label: str
    prediction: str
    min_rows: int            # trained only with more rows than this
    kind: str                # gbt | rf | lr | linear
    params: dict = field(default_factory=dict)
    positive_label: bool = False   # also require label > 0

    @property
    def features_col(self) -> str:
        return f"features_{self.name}"

    def row_filter(self) -> Column:
        c = F.col(self.label).isNotNull()
        if self.positive_label:
            c = c & (F.col(self.label) > 0)
        return c

    def estimator(self):
        common = dict(featuresCol=self.features_col, labelCol=self.label,
                      predictionCol=self.prediction)
        if self.kind == "gbt":
            return GBTRegressor(**common, **self.params)
        if self.kind == "rf":
            return RandomForestRegressor(**common, **self.params)
        if self.kind == "lr":
            return LogisticRegression(**common, **self.params)
        if self.kind == "linear":
            return LinearRegression(**common, **self.params)
        raise ValueError(self.kind)

    def pipeline(self) -> Pipeline:
        asm = VectorAssembler(inputCols=self.features, outputCol=self.features_col,
                              handleInvalid="skip")
        return Pipeline(stages=[asm, self.estimator()])


SPECS = [
    ModelSpec("rating", C.SENTIMENT_FEATURES, "rating", "predicted_rating", 50, "gbt",
              {"maxIter": 50, "maxDepth": 6}),
    ModelSpec("rating_base", C.EXTENDED_FEATURES, "rating", "predicted_rating_base", 50,
              "gbt", {"maxIter": 50, "maxDepth": 6}),
    ModelSpec("rating_count", C.BASE_FEATURES, "rating_count", "predicted_rating_count",
              30, "rf", {"numTrees": 30}, positive_label=True),
    ModelSpec("longevity", C.EXTENDED_FEATURES, "longevity_score", "predicted_longevity",
              30, "rf", {"numTrees": 40}),
    ModelSpec("success", C.EXTENDED_FEATURES, "success_level", "predicted_success_class",
              50, "lr", {"maxIter": 30}),
    # documented alongside the others; an extra registry entry
    ModelSpec("rating_linear", C.EXTENDED_FEATURES, "rating", "predicted_rating_linear",
              50, "linear", {"solver": "normal"}),
]
SPEC_BY_NAME = {s.name: s for s in SPECS}
DEFAULT_MODELS = ["rating", "rating_base", "rating_count", "longevity", "success"]


def training_frame(history: DataFrame, impute_labels: bool = True) -> DataFrame:
    """History restricted to features + labels; with ``impute_labels`` the
    history fills apply (unrated games train as longevity 0 / class 0)."""
    h = history.na.fill({k: v for k, v in C.HISTORY_FILLS.items() if k in history.columns}) \
        if impute_labels else history
    cols = sorted(set(C.SENTIMENT_FEATURES) | {s.label for s in SPECS})
    return h.select(*[c for c in cols if c in h.columns])


def gate_counts(train: DataFrame, specs=SPECS) -> dict[str, int]:
    """Total rows and rows per model in one aggregation pass."""
    aggs = [F.count(F.lit(1)).alias("total")]
    seen = set()
    for s in specs:
        if s.name in seen:
            continue
        seen.add(s.name)
        aggs.append(F.count_if(s.row_filter()).alias(s.name))
    row = train.agg(*aggs).collect()[0]
    return row.asDict()


def fit_tasks(spark, rows: int) -> int:
    """Tasks of one training pass: two for each core, or more where they would hold too many rows."""
    return max(2 * spark.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_TASK))


def train_models(history: DataFrame, names=None, impute_labels: bool = True,
                 min_total: int = C.MIN_TRAIN_ROWS) -> dict[str, PipelineModel]:
    """Fit every requested model whose gate passes; a fit that fails is an error that names its model,
    as a model left out would read like one whose gate did not pass: null predictions, or the fallback's."""
    specs = [SPEC_BY_NAME[n] for n in (names or DEFAULT_MODELS)]
    train = training_frame(history, impute_labels).persist(StorageLevel.DISK_ONLY)
    try:
        counts = gate_counts(train, specs)
        if counts["total"] <= min_total:
            return {}
        tasks = fit_tasks(train.sparkSession, counts["total"])
        models = {}
        for s in specs:
            if counts[s.name] <= s.min_rows:
                continue
            try:
                models[s.name] = s.pipeline().fit(train.where(s.row_filter()).coalesce(tasks))
            except Exception as e:
                raise RuntimeError(f"fit of model {s.name} failed") from e
        return models
    finally:
        train.unpersist()


def _apply(df: DataFrame, spec: ModelSpec, model: PipelineModel) -> DataFrame:
    out = model.transform(df.drop(spec.prediction, spec.features_col)).drop(spec.features_col)
    if spec.kind == "lr":
        out = out.drop("rawPrediction", "probability")
    return out


def predict_all(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Apply the available models in sequence; a missing model yields a
    typed null column.  ``rating_base`` stands in when ``rating`` is absent."""
    out = df.drop("predicted_rating", *[s.prediction for s in SPECS])
    if "rating" in models:
        out = _apply(out, SPEC_BY_NAME["rating"], models["rating"])
    elif "rating_base" in models:
        out = _apply(out, SPEC_BY_NAME["rating_base"], models["rating_base"]) \
            .withColumnRenamed("predicted_rating_base", "predicted_rating")
    else:
        out = out.withColumn("predicted_rating", F.lit(None).cast("double"))
    for name in ("rating_count", "longevity", "success"):
        spec = SPEC_BY_NAME[name]
        if name in models:
            out = _apply(out, spec, models[name])
        else:
            out = out.withColumn(spec.prediction, F.lit(None).cast("double"))
    return out


def save_models(models: dict[str, PipelineModel], path: str) -> None:
    for name, m in models.items():
        m.write().overwrite().save(os.path.join(path, name))


LATEST = "_latest"


def publish_models(spark, models: dict[str, PipelineModel], root: str, version: str) -> str:
    """Save a new model version under ``root/<version>`` and then point
    ``root/_latest`` at it.  Readers only follow the pointer, so they never
    see a half-written version; the pointer is written through Spark, so it
    works on any shared file system."""
    path = f"{root.rstrip('/')}/{version}"
    save_models(models, path)
    spark.createDataFrame([(version,)], "version string").coalesce(1) \
        .write.mode("overwrite").text(f"{root.rstrip('/')}/{LATEST}")
    return path


def latest_version(spark, root: str) -> str | None:
    try:
        rows = spark.read.text(f"{root.rstrip('/')}/{LATEST}").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        LOG.info("no model version published under %s", root)
        return None
    return rows[0][0] if rows else None


def load_models(path: str, names=None) -> dict[str, PipelineModel]:
    """Load whatever models exist under ``path`` (one folder per model)."""
    out = {}
    for name in names or [s.name for s in SPECS]:
        p = os.path.join(path, name)
        try:
            out[name] = PipelineModel.load(p)
        except Exception:  # noqa: BLE001 - absent or unreadable: the others still load
            LOG.warning("model %s could not be loaded from %s", name, p, exc_info=True)
    return out


class ModelRegistry:
    """Models loaded from a shared folder, reloaded when older than
    ``refresh_seconds`` (checked by the caller's clock, once per batch).

    With ``spark`` given, ``path`` is a root of published versions and the
    registry follows its ``_latest`` pointer; otherwise ``path`` holds the
    model folders directly."""

    def __init__(self, path: str, refresh_seconds: int = C.MODEL_REFRESH_SECONDS,
                 spark=None):
        self.path = path
        self.refresh_seconds = refresh_seconds
        self.spark = spark
        self.models: dict[str, PipelineModel] = {}
        self.loaded_at: float | None = None
        self.version: str | None = None

    def _source(self) -> tuple[str | None, str]:
        if self.spark is None:
            return None, self.path
        v = latest_version(self.spark, self.path)
        return v, f"{self.path.rstrip('/')}/{v}" if v else self.path

    def get(self, now: float) -> dict[str, PipelineModel]:
        if not self.models or self.loaded_at is None or \
                now - self.loaded_at > self.refresh_seconds:
            version, src = self._source()
            models = load_models(src) if (self.spark is None or version) else {}
            if models:
                self.models, self.version = models, version
                self.loaded_at = now
        return self.models
