"""Forests with Spark ML: assemble, train, score, explain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from billrisk.operators.clean import numeric_columns
from billrisk.session import checkpoint_dir


@dataclass(frozen=True)
class ForestSettings:
    """Size and shape of a forest, and what keeps the training of a large one within memory.

    Deep trees are trained with a cache of the node each row has reached
    (``cache_nodes``, written to the checkpoint folder every
    ``checkpoint_every`` passes) in place of sending all trees to every row.
    ``memory_mb`` bounds the statistics of the nodes that are split in one
    pass.  ``max_rows`` bounds the training rows: of more, about that many are
    taken by a hash of the row, whatever the partitioning.
    """

    trees: int = 50
    depth: int = 8
    impurity: str = "gini"
    bins: int = 32
    seed: int = 42
    subset: str = "auto"
    row_share: float = 1.0
    memory_mb: int = 256
    cache_nodes: bool = False
    checkpoint_every: int = 10
    max_rows: int | None = None

    def parameters(self) -> dict:
        return {
            "numTrees": self.trees, "maxDepth": self.depth, "maxBins": self.bins, "seed": self.seed,
            "featureSubsetStrategy": self.subset, "subsamplingRate": self.row_share, "maxMemoryInMB": self.memory_mb,
            "cacheNodeIds": self.cache_nodes, "checkpointInterval": self.checkpoint_every,
        }


# Forest sizes of the four models.
CLASSIFIER = ForestSettings(trees=50, depth=8)
FIRST_MODEL = ForestSettings(trees=100, depth=5)
MULTICLASS = ForestSettings(trees=700, depth=26, impurity="entropy", cache_nodes=True, memory_mb=1024)
REGRESSOR = ForestSettings(trees=200, depth=26, impurity="variance", cache_nodes=True, memory_mb=1024)


def bounded_rows(df: DataFrame, max_rows: int, seed: int = 42) -> DataFrame:
    """All rows, or about ``max_rows`` of more, by a hash of the row's values."""
    n = df.count()
    if n <= max_rows:
        return df
    place = F.pmod(F.xxhash64(*sorted(df.columns), F.lit(seed)), F.lit(1 << 30))
    return df.where(place < int((1 << 30) * max_rows / n))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Numeric columns that may be features: not the key, the year or a label."""
    return [c for c in numeric_columns(df) if c not in set(exclude)]


def assembler(columns: Sequence[str], invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid=invalid)


def _fit(train: DataFrame, columns: Sequence[str], forest, label: str, settings: ForestSettings) -> PipelineModel:
    # Columns that are neither feature nor label never reach the trainer.
    narrow = train.select(*columns, F.col(label).cast("double").alias(label))
    if settings.max_rows is not None:
        narrow = bounded_rows(narrow, settings.max_rows, settings.seed)
    if settings.cache_nodes:
        checkpoint_dir(train.sparkSession)
    # The trainer reads its rows three times before it has its own copy of them, which needs the memory.
    assemble = assembler(columns)
    vectors = assemble.transform(narrow).select("features", label).persist(StorageLevel.DISK_ONLY)
    try:
        return PipelineModel([assemble, forest.fit(vectors)])
    finally:
        vectors.unpersist()


def train_classifier(
    train: DataFrame, columns: Sequence[str], label: str = "LatePmt2", settings: ForestSettings = CLASSIFIER,
) -> PipelineModel:
    """Random forest for any number of classes; class codes are 0, 1, 2, ..."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, impurity=settings.impurity, **settings.parameters())
    return _fit(train, columns, forest, label, settings)


def train_regressor(
    train: DataFrame, columns: Sequence[str], label: str = "DiffPmt2", settings: ForestSettings = REGRESSOR,
) -> PipelineModel:
    forest = RandomForestRegressor(featuresCol="features", labelCol=label, **settings.parameters())
    return _fit(train, columns, forest, label, settings)


def score(model: PipelineModel, rows: DataFrame, positive: bool = False) -> DataFrame:
    """Add ``prediction``, and the probability of class 1 with ``positive``.

    The vectors are dropped again; the probability is read with a built-in
    function, so rows never leave the JVM.
    """
    out = model.transform(rows)
    if positive:
        out = out.withColumn("probability", vector_to_array("probability")[1])
    else:
        out = out.drop("probability")
    return out.drop("features", "rawPrediction")


def feature_importance(model: PipelineModel, k: int | None = None) -> DataFrame:
    """``Features, Importance``, highest first; one row per feature (or the first ``k``)."""
    assemble, forest = model.stages[0], model.stages[-1]
    weights = forest.featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(assemble.getInputCols(), weights)]
    frame = SparkSession.active().createDataFrame(rows, "Features string, Importance double")
    ordered = frame.orderBy(F.desc("Importance"), "Features")
    return ordered if k is None else ordered.limit(k)
