"""Deciding which candidate pairs match: rules, trees, logistic regression."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .features import ADDRESS, FEATURES, NAME

#: Weights of the rule matcher; they add up to 1.
RULE = {"name_token_jaccard": 0.35, "name_char3_jaccard": 0.2, "name_seq_sim": 0.15, "addr_token_jaccard": 0.25, "postal_exact_match": 0.05}
THRESHOLD = 0.83
#: Feature prefixes of the ablations.
PREFIXES = {"name_only": NAME, "name_address": NAME + ADDRESS, "full": FEATURES}


def rule_score(weights: dict[str, float] | None = None, allowed: list[str] | None = None) -> Column:
    """The weighted sum of some features; those that aren't allowed count for nothing."""
    total = F.lit(0.0)
    for name, w in (weights or RULE).items():
        if allowed is None or name in allowed:
            total = total + F.lit(w) * F.col(name)
    return F.round(total, 9)


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs (q, id) with label 1 where truth (q, id) has them, else 0."""
    return pairs.join(truth.select("q", "id").distinct().withColumn("_hit", F.lit(1)), ["q", "id"], "left").withColumn("label", F.coalesce("_hit", F.lit(0))).drop("_hit")


def in_training(q: Column, share: int = 80, seed: int = 42) -> Column:
    """Whether a query's pairs are for training: all pairs of a query fall on the same side, by a hash of it."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", q, F.lit(str(seed)))), 1, 8), 16, 10).cast("long") % 100 < share


def balanced(labelled: DataFrame) -> DataFrame:
    """labelled with a weight for positives: negatives over positives, between 1 and 10."""
    counts = labelled.agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    ratio = F.least(F.lit(10.0), F.greatest(F.lit(1.0), F.col("neg") / F.greatest(F.col("pos"), F.lit(1))))
    return labelled.join(F.broadcast(counts.select(ratio.alias("_ratio")))).withColumn("weight", F.when(F.col("label") == 1, F.col("_ratio")).otherwise(1.0)).drop("_ratio")


def fit(labelled: DataFrame, kind: str = "gbt", names: list[str] | None = None, **params) -> PipelineModel:
    """Fit trees (`gbt`) or logistic regression (`logistic`) on labelled features with a weight column."""
    assembler = VectorAssembler(inputCols=names or FEATURES, outputCol="features")
    if kind == "gbt":
        settings = {"maxIter": 50, "stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 20, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42} | params
        model = GBTClassifier(labelCol="label", weightCol="weight", **settings)
    else:
        model = LogisticRegression(labelCol="label", weightCol="weight", **({"maxIter": 100, "regParam": 0.01} | params))
    return Pipeline(stages=[assembler, model]).fit(labelled)


def probability(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """pairs with p, the probability of a match."""
    scored = model.transform(pairs).withColumn("p", vector_to_array("probability")[1])
    return scored.select(*pairs.columns, "p")


def importances(model: PipelineModel, names: list[str] | None = None) -> dict[str, float]:
    """By feature, largest first: of trees their gains, of a regression the size of its coefficients."""
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    return dict(sorted(zip(names or FEATURES, map(float, values), strict=True), key=lambda x: (-x[1], x[0])))


def save(model: PipelineModel, path: str, names: list[str], threshold: float, params: dict | None = None) -> None:
    """The model, and beside it names, threshold and parameters as JSON."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    side = json.dumps({"feature_names": names, "best_threshold": threshold, "params": params or {}})
    spark.createDataFrame([(side,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(spark, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/about").first()["value"])


def decide(scored: DataFrame, threshold: float = THRESHOLD, score: str = "p") -> DataFrame:
    return scored.where(F.col(score) >= threshold)


def best_owner(scored: DataFrame, score: str = "p") -> DataFrame:
    """Each candidate with its best query alone."""
    order = Window.partitionBy("id").orderBy(F.desc(score), "q")
    return scored.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def margin(scored: DataFrame, score: str = "p") -> DataFrame:
    """How far each candidate is above the next one of its query."""
    order = Window.partitionBy("q").orderBy(F.desc(score), "id")
    return scored.withColumn("margin", F.col(score) - F.lead(score).over(order))
