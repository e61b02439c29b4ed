"""Boosted trees over pair features (operators ML1-ML4, A29, IO23)."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pipeline(features: list[str], label: str = "label", rounds: int = 40, depth: int = 5, seed: int = 42, holdout: str | None = None) -> Pipeline:
    """ML1: a missing value is imputed by the median and flagged, as these trees cannot split
    on it; with a hold-out column the rounds stop where it gets no better."""
    gbt = GBTClassifier(featuresCol="__x", labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed, subsamplingRate=0.7, featureSubsetStrategy="0.8")
    if holdout:
        gbt = gbt.setValidationIndicatorCol(holdout)
    return Pipeline(stages=[Imputer(inputCols=features, outputCols=[f"__{f}" for f in features], strategy="median"), VectorAssembler(inputCols=[*(f"__{f}" for f in features), *(f"__na_{f}" for f in features)], outputCol="__x"), gbt])


def prepared(df: DataFrame, features: list[str]) -> DataFrame:
    return df.select("*", *(F.col(f).isNull().cast("double").alias(f"__na_{f}") for f in features)).withColumns({f: F.col(f).cast("double") for f in features})


def predict(model: PipelineModel, df: DataFrame, features: list[str], out: str = "p") -> DataFrame:
    """ML3."""
    p = vector_to_array(F.col("probability"))[1]
    return model.transform(prepared(df, features)).select(*df.columns, p.alias(out))


def fit(df: DataFrame, features: list[str], label: str = "label", stop: str | None = "i", share: float = 0.1, **kw) -> PipelineModel:
    """ML1: with ``stop`` (an entity's column) the rounds stop by the pairs of a hashed share
    of the entities, if both they and the rest hold both classes; labels of one class only
    are an error."""
    d = df.withColumn(label, F.col(label).cast("double"))
    held = F.pmod(F.xxhash64(F.col(stop), F.lit(17)), F.lit(1000)) < int(1000 * share) if stop in df.columns else F.lit(False)
    d = d.withColumn("__held", held)
    n = {r["__held"]: (r["lo"], r["hi"]) for r in d.groupBy("__held").agg(F.min(label).alias("lo"), F.max(label).alias("hi")).collect()}
    if min(x[0] for x in n.values()) == max(x[1] for x in n.values()):
        raise RuntimeError("the labels are all the same")
    both = len(n) == 2 and all(lo < hi for lo, hi in n.values())
    return pipeline(features, label, holdout="__held" if both else None, **kw).fit(prepared(d, features))


def out_of_fold(df: DataFrame, features: list[str], label: str = "label", fold: str = "fold", **kw) -> DataFrame:
    """ML2, ML4: each fold scored by a model of the others; a fold whose others hold one
    class only gets that class's share."""
    parts = []
    for r in sorted(df.select(fold).distinct().collect(), key=str):
        k = r[0]
        train, test = df.where(F.col(fold) != k), df.where(F.col(fold) == k)
        share = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
        constant = share is None or share in (0.0, 1.0)
        parts.append(test.withColumn("p", F.lit(float(share or 0.0))) if constant else predict(fit(train, features, label, **kw), test, features))
    return reduce(DataFrame.unionByName, parts) if parts else df.withColumn("p", F.lit(None).cast("double"))


def importances(model: PipelineModel, features: list[str]) -> dict[str, float]:
    """A feature's gain, its missing flag's included."""
    v = model.stages[-1].featureImportances.toArray()
    return {f: float(v[i] + v[i + len(features)]) for i, f in enumerate(features)}


def save(model: PipelineModel, features: list[str], path: str, **more) -> None:
    """IO23: a model, with its features and what else belongs to it (a threshold, say)."""
    from weftlink.sources import write_json

    model.write().overwrite().save(f"{path}/model")
    write_json(SparkSession.active(), f"{path}/meta", {"features": features, **more})


def load(path: str) -> tuple[PipelineModel, dict]:
    """IO23: what ``save`` wrote."""
    meta = SparkSession.active().read.text(f"{path}/meta").first()[0]
    return PipelineModel.load(f"{path}/model"), json.loads(meta)
