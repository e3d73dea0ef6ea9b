"""Weighted tree classifiers with Spark's own learning library."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwatch.functions.grid import risk_level


def filled(df: DataFrame, names: list[str]) -> DataFrame:
    """Absent feature columns and null or NaN values become 0."""
    have = df.withColumns({n: F.lit(0.0) for n in names if n not in df.columns}) if set(names) - set(df.columns) else df
    return have.withColumns({n: F.col(n).cast("double") for n in names}).fillna(0.0, names)


def weighted(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds balanced class weights, n / (classes * n_class) over the classes that there are: of one class alone all weights are 1."""
    n, n1 = F.col("_n"), F.col("_n1")
    counts = df.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(label) == 1).alias("_n1"))
    classes = F.when((n1 == 0) | (n1 == n), 1).otherwise(2)
    of_class = F.when(F.col(label) == 1, n1).otherwise(n - n1)
    return df.crossJoin(F.broadcast(counts)).withColumn("weight", n / (classes * of_class)).drop("_n", "_n1")


def labelled(df: DataFrame, label: str = "label") -> DataFrame:
    """df with a label that is told to be of two classes, so that rows of one class, or a fold of them, can be learned from too."""
    return df.withMetadata(label, {"ml_attr": {"type": "nominal", "num_vals": 2}})


def _stages(names: list[str], classifier) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep"), classifier])


def forest(train: DataFrame, names: list[str], trees: int = 50, depth: int = 5, seed: int = 42) -> PipelineModel:
    return _stages(names, RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=5, featureSubsetStrategy="sqrt", seed=seed)).fit(labelled(filled(train, names)))


def tuned(train: DataFrame, names: list[str], kind: str = "forest", folds: int = 2, parallelism: int = 2, seed: int = 42, grid: dict | None = None):
    """A cross-validated forest (trees by depth) or boosted trees (depth), by area under the ROC curve."""
    c = RandomForestClassifier(labelCol="label", weightCol="weight", seed=seed) if kind == "forest" else GBTClassifier(labelCol="label", weightCol="weight", maxIter=80, stepSize=0.1, seed=seed)
    grid = grid or ({"numTrees": [80, 100], "maxDepth": [8, 10]} if kind == "forest" else {"maxDepth": [3, 5]})
    space = ParamGridBuilder()
    for k, v in grid.items():
        space = space.addGrid(c.getParam(k), v)
    score = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    return CrossValidator(estimator=_stages(names, c), estimatorParamMaps=space.build(), evaluator=score, numFolds=folds, parallelism=parallelism, seed=seed).fit(labelled(filled(train, names)))


def candidates(fitted, names: list[str], model: str, folds: int) -> DataFrame:
    """A row for each combination that `tuned` tried: model, candidate, params (name to value), avg_metric over the folds, n_folds, n_features, is_best."""
    rows = [{p.name: float(v) for p, v in space.items()} for space in fitted.getEstimatorParamMaps()]
    best = max(range(len(rows)), key=lambda k: (fitted.avgMetrics[k], -k))
    told = [(model, k, params, float(fitted.avgMetrics[k]), folds, len(names), k == best) for k, params in enumerate(rows)]
    return SparkSession.active().createDataFrame(told, "model string, candidate int, params map<string,double>, avg_metric double, n_folds int, n_features int, is_best boolean")


def scored(model: PipelineModel, df: DataFrame, names: list[str], medium: float = 0.33, high: float = 0.75) -> DataFrame:
    out = model.transform(filled(df, names)).withColumn("p", vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction", "features")
    return out.withColumnRenamed("p", "probability").withColumn("risk_level", risk_level(F.col("probability"), medium, high))


def importances(model: PipelineModel, names: list[str]) -> DataFrame:
    return SparkSession.active().createDataFrame(list(zip(names, map(float, model.stages[-1].featureImportances.toArray()), strict=True)), "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
