"""Boosted trees on encoded features: fit, score, save."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.operators.training import average_precisions, build_model_vector, impute_for_model


def prepare(df: DataFrame, contract: dict, keep: tuple[str, ...] = ()) -> DataFrame:
    return impute_for_model(build_model_vector(df, contract, keep), list(contract["columns"]))


def input_columns(contract: dict) -> list[str]:
    return [*contract["columns"], *[f"{c}_missing" for c in contract["columns"]]]


def train_classifier(train: DataFrame, val: DataFrame | None, contract: dict, label: str = "label", rounds: int = 30, depth: int = 4, seed: int = 42, patience: int = 10) -> PipelineModel:
    """Boosted trees with the rare class weighed up. If val is given, boosting stops early by its average precision: the best
    number of trees before `patience` more of them bring nothing better (ties: the fewest)."""
    counts = train.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col(label) == 1).cast("long")).alias("p")).first()
    weight = (counts["n"] - (counts["p"] or 0)) / max(1, counts["p"] or 0)
    rows = prepare(train, contract, (label,)).withColumn(label, F.col(label).cast("double")).withColumn("_w", F.when(F.col(label) == 1, weight).otherwise(1.0))
    vectors = VectorAssembler(inputCols=input_columns(contract), outputCol="features")

    def fit(n: int) -> PipelineModel:
        return Pipeline(stages=[vectors, GBTClassifier(featuresCol="features", labelCol=label, weightCol="_w", maxIter=n, maxDepth=depth, seed=seed)]).fit(rows)

    fitted = fit(rounds)
    if val is None:
        return fitted
    best = best_rounds([r["average_precision"] for r in precision_by_rounds(fitted, val, contract, label).orderBy("rounds").collect()], patience)
    return fitted if best == rounds else fit(best)  # the same seed grows the same first trees


def best_rounds(scores: list[float | None], patience: int) -> int:
    best, at = -1.0, 1
    for i, s in enumerate(scores, 1):
        if s is not None and s > best:
            best, at = s, i
        elif i - at >= patience:
            break
    return at


def leaf_values(model: GBTClassificationModel) -> list[list[float]]:
    """Of each tree, its weight times the predictions of its leaves, in the order of their numbers."""

    def leaves(node) -> list[float]:
        if node.getClass().getSimpleName() == "LeafNode":
            return [node.prediction()]
        return leaves(node.leftChild()) + leaves(node.rightChild())

    return [[w * x for x in leaves(t._call_java("rootNode"))] for t, w in zip(model.trees, model.treeWeights)]


def precision_by_rounds(fitted: PipelineModel, val: DataFrame, contract: dict, label: str = "label") -> DataFrame:
    """(rounds, average_precision) of the model's first 1, 2, ... trees on val. Rows are scored once: the leaves that a row
    falls in give the scores of all prefixes, and their counts are run up together."""
    trees = fitted.stages[-1]
    values = F.array(*[F.array(*map(F.lit, v)) for v in leaf_values(trees)])
    found = PipelineModel([*fitted.stages[:-1], trees.copy().setLeafCol("_leaves")]).transform(prepare(val, contract, (label,)))
    gains = F.zip_with(vector_to_array("_leaves"), values, lambda leaf, v: F.get(v, leaf.cast("int")))
    margins = F.aggregate(gains, F.array().cast("array<double>"), lambda acc, g: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + g)))
    scores = found.select(label, F.posexplode(margins).alias("_i", "margin")).select(label, (F.col("_i") + 1).alias("rounds"), "margin")
    return average_precisions(scores, label, "margin", "rounds")


def two_phase_fit(train: DataFrame, val: DataFrame, contract: dict, label: str = "label", rounds: int = 30, **kw) -> PipelineModel:
    """Early stopping first; then all rows with a tenth more rounds than it chose."""
    first = train_classifier(train, val, contract, label, rounds, **kw)
    chosen = max(1, round(first.stages[-1].getNumTrees * 1.1))
    return train_classifier(train.unionByName(val), None, contract, label, chosen, **kw)


def score_batch(df: DataFrame, model: PipelineModel, contract: dict, keep: tuple[str, ...], out: str = "fraud_score") -> DataFrame:
    return model.transform(prepare(df, contract, keep)).select(*keep, vector_to_array("probability")[1].alias(out))


def top_features(model: PipelineModel, contract: dict, k: int) -> list[str]:
    gain = model.stages[-1].featureImportances.toArray()
    names = input_columns(contract)
    return [names[i] for i in sorted(range(len(names)), key=lambda i: (-gain[i], i))[:k]]


def platt(df: DataFrame, label: str, score: str):
    """Logistic recalibration on the score alone."""
    rows = VectorAssembler(inputCols=[score], outputCol="x").transform(df.select(F.col(label).cast("double").alias(label), score))
    return LogisticRegression(featuresCol="x", labelCol=label).fit(rows)


def save_bundle(model: PipelineModel, contract: dict, metrics: dict, path: str, spark: SparkSession) -> str:
    """The model and, beside it, contract and metrics as JSON through Spark's writers; returns the version."""
    version = uuid.uuid4().hex[:12]
    model.write().overwrite().save(f"{path}/{version}/model")
    for name, content in (("contract", contract), ("metrics", metrics)):
        spark.createDataFrame([(json.dumps(content, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{version}/{name}")
    return version


def load_bundle(path: str, version: str, spark: SparkSession) -> tuple[PipelineModel, dict, dict]:
    read = lambda n: json.loads(spark.read.text(f"{path}/{version}/{n}").first()[0])
    return PipelineModel.load(f"{path}/{version}/model"), read("contract"), read("metrics")
