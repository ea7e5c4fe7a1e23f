"""Delay-model training and batch scoring with ``pyspark.ml``.

* class weights for the imbalanced label (balanced: n / (2 * n_class)) as a
  weight column — computed by one aggregate, joined back as a 2-row table;
* baseline ``LogisticRegression`` and ``GBTClassifier`` in a ``Pipeline``
  (imputation of missing numeric features, vector assembly);
* batch scoring: positive-class probability as a plain double column, written
  with dynamic partition overwrite so re-scoring a day replaces only that day;
* GBT feature importances as a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Tasks that a table of the training session is cut into, per core, unless it is very small.
TASKS_PER_CORE = 4


def ml_session(spark: SparkSession) -> SparkSession:
    """An isolated session of the same application for model training.

    Training jobs serialise closures that reach the session; once the session
    has served a ``DataFrame.observe(Observation, ...)`` those closures fail
    with ``Task not serializable`` (its ObservationManager).  A new session
    shares the cluster and the cached data source files but not that state.

    Its tables are cut into several tasks a core: training passes over them dozens of times, and a table in a few
    tasks more than there are cores leaves most cores idle in each pass.
    """
    s = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and s.conf.isModifiable(key):
            s.conf.set(key, value)
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    s.conf.set("spark.sql.shuffle.partitions", str(max(tasks, int(s.conf.get("spark.sql.shuffle.partitions")))))
    s.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1m")
    s.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    s.conf.set("spark.sql.files.minPartitionNum", str(tasks))
    s.conf.set("spark.sql.files.openCostInBytes", "256k")
    return s


def with_class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    w = counts.select(label, (F.lit(total) / (F.lit(2.0) * F.col("_n"))).alias(weight))
    return df.join(F.broadcast(w), label)   # one row per class


def _prep(features: Sequence[str]):
    feats = list(features)
    imputed = [f"{c}__imp" for c in feats]
    return [Imputer(inputCols=feats, outputCols=imputed, strategy="median"),
            VectorAssembler(inputCols=imputed, outputCol="features", handleInvalid="keep")]


def _numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features})


def fit_prep(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Imputation and assembly fitted once, for several models of the same rows and features."""
    return Pipeline(stages=_prep(features)).fit(_numeric(train, features))


def train_logistic(train: DataFrame, features: Sequence[str], label: str = "label",
                   weight: str | None = "weight", prep: PipelineModel | None = None) -> PipelineModel:
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=50, regParam=0.01)
    if weight:
        lr.setWeightCol(weight)
    return Pipeline(stages=[*(prep.stages if prep else _prep(features)), lr]).fit(_numeric(train, features))


def train_gbt(train: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = "weight",
              max_iter: int = 20, max_depth: int = 5, prep: PipelineModel | None = None) -> PipelineModel:
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=42)
    if weight:
        gbt.setWeightCol(weight)
    return Pipeline(stages=[*(prep.stages if prep else _prep(features)), gbt]).fit(_numeric(train, features))


def score(model: PipelineModel, df: DataFrame, features: Sequence[str], out: str = "score") -> DataFrame:
    scored = model.transform(_numeric(df, features))
    keep = [c for c in df.columns]
    return scored.select(*keep, vector_to_array("probability")[1].alias(out))


def feature_importances(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Importances of the fitted GBT (one small row per feature)."""
    gbt = model.stages[-1]
    imp = gbt.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(features, imp)), "feature string, importance double")


def write_scores(scored: DataFrame, path: str, partition: str = "score_date") -> None:
    """Dynamic partition overwrite: re-scoring one day replaces only that day."""
    (scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def compare_models(models: dict, test: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """One row per model: average precision and best F1 on ``test`` (PR curve as a distributed aggregate)."""
    from punctua.operators.stats import pr_curve
    out = None
    for name, model in models.items():
        curve = pr_curve(score(model, test, features), "score", label)
        row = curve.agg(F.max("average_precision").alias("average_precision"), F.max("f1").alias("best_f1"))
        row = row.select(F.lit(name).alias("model"), "average_precision", "best_f1")
        out = row if out is None else out.unionByName(row)
    return out
