"""Fitted artefacts on shared storage.

Spark ML models use their own persistence (``PipelineModel.save``); the
scalar state of the wide-form preprocessing (means, deviations, category
lists, feature names, threshold) is one small JSON document per artefact,
written and read through Spark so any Hadoop-compatible path works.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from kestrel.operators.prep import ColumnTransformerModel, OneHotModel, ScalerModel
from kestrel.operators.sparse import SparseTransformerModel


def save_json(spark: SparkSession, obj: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(obj),)], "doc string") \
        .coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def save_preprocessor(spark: SparkSession, model: ColumnTransformerModel | SparseTransformerModel, path: str,
                      threshold: float | None = None) -> None:
    if isinstance(model, SparseTransformerModel):
        # The categories are a table beside the document.
        model.values.write.mode("overwrite").parquet(f"{path}/vocabulary")
        save_json(spark, {"scaler": [[c, model.scaler.means[c], model.scaler.stds[c]] for c in model.scaler.means],
                          "columns": [[c, *model.sizes[c]] for c in model.columns], "threshold": threshold}, f"{path}/state")
        return
    # Ordered lists: the feature order is part of the model's contract.
    save_json(spark, {"scaler": [[c, model.scaler.means[c], model.scaler.stds[c]]
                                 for c in model.scaler.means],
                      "encoder": [[c, vs] for c, vs in model.encoder.categories.items()],
                      "feature_names": model.feature_names, "threshold": threshold}, path)


def load_preprocessor(spark: SparkSession, path: str) -> tuple[ColumnTransformerModel, dict]:
    d = load_json(spark, path)
    scaler = ScalerModel({c: m for c, m, _ in d["scaler"]}, {c: s for c, _, s in d["scaler"]})
    m = ColumnTransformerModel(scaler, OneHotModel({c: vs for c, vs in d["encoder"]}))
    return m, d


def load_sparse_preprocessor(spark: SparkSession, path: str) -> tuple[SparseTransformerModel, dict]:
    d = load_json(spark, f"{path}/state")
    scaler = ScalerModel({c: m for c, m, _ in d["scaler"]}, {c: s for c, _, s in d["scaler"]})
    sizes = {c: (n, size) for c, n, size in d["columns"]}
    return SparseTransformerModel(scaler, list(sizes), spark.read.parquet(f"{path}/vocabulary"), sizes), d


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
