"""Saving and loading fitted segment models with Spark's own writers."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.operators.cluster import Clustering
from tablelab.operators.encode import Encoding
from tablelab.operators.forest import ForestFit
from tablelab.operators.missing import FillRule
from tablelab.operators.mixture import Mixture
from tablelab.operators.outliers import Detection, Treatment
from tablelab.operators.scale import Scale
from tablelab.plans.prepare import Preparation
from tablelab.plans.segment import SegmentModel

RECORD_SCHEMA = (
    "algorithm string, params map<string,string>, key array<string>, features array<string>, n_clusters bigint, "
    "silhouette double, silhouette_mode string, davies_bouldin double, calinski_harabasz double, state string"
)


def verdict(silhouette):
    """Wording of a silhouette value, as a column expression."""
    return (
        F.when(silhouette > 0.7, "strong").when(silhouette > 0.5, "reasonable").when(silhouette > 0.25, "weak").otherwise("poor")
    )


def save_model(model: SegmentModel, metrics: dict, path: str, spark: SparkSession, mode: str = "errorifexists") -> None:
    """Write pipeline, parameters, dictionaries and one metadata row under ``path``."""
    clustering = model.clustering
    if clustering.algorithm == "single_linkage":
        raise ValueError("single linkage has no rule for new rows; store the labelled rows instead")
    own = isinstance(clustering.model, Mixture)
    stages = [*model.projection.stages] if own else [*model.projection.stages, clustering.model]
    writer = PipelineModel(stages=stages).write()
    (writer.overwrite() if mode == "overwrite" else writer).save(f"{path}/pipeline")
    state = {
        "relabel": clustering.relabel,
        "params": clustering.params,
        "details": clustering.details,
        "defaults": model.defaults,
        "mixture": clustering.model.to_json() if own else None,
        "preparation": _preparation_state(model.preparation, path, mode) if model.preparation else None,
    }
    row = (
        clustering.algorithm,
        {k: str(v) for k, v in clustering.params.items()},
        model.key,
        model.features,
        *[metrics.get(x) for x in ("n_clusters", "silhouette", "silhouette_mode", "davies_bouldin", "calinski_harabasz")],
        json.dumps(state),
    )
    spark.createDataFrame([row], RECORD_SCHEMA).coalesce(1).write.mode(mode).parquet(f"{path}/record")


def load_model(spark: SparkSession, path: str) -> SegmentModel:
    record = spark.read.parquet(f"{path}/record").first()
    state = json.loads(record["state"])
    stages = PipelineModel.load(f"{path}/pipeline").stages
    if state["mixture"]:
        model = Mixture.from_json(state["mixture"])
    else:
        stages, model = stages[:-1], stages[-1]
    clustering = Clustering(record["algorithm"], state["params"], model, state["relabel"], details=state["details"])
    preparation = _load_preparation(spark, state["preparation"], path) if state["preparation"] else None
    projection = PipelineModel(stages=stages)
    return SegmentModel(list(record["key"]), list(record["features"]), projection, clustering, preparation, state.get("defaults", {}))


def model_card(spark: SparkSession, path: str) -> DataFrame:
    """Type, parameters, features, metrics and verdict of a stored model."""
    record = spark.read.parquet(f"{path}/record").drop("state")
    return record.withColumn("verdict", verdict(F.col("silhouette")))


def _preparation_state(prep: Preparation, path: str, mode: str) -> dict:
    encodings = []
    for i, e in enumerate(prep.encodings):
        if e.dictionary is not None:
            e.dictionary.write.mode(mode).parquet(f"{path}/dictionary_{i}")
        encodings.append(
            {"column": e.column, "kind": e.kind, "distinct": e.distinct, "total": e.total, "categories": e.categories,
             "stored": e.dictionary is not None}
        )
    return {
        "key": prep.key,
        "order_by": prep.order_by,
        "fills": [f.record() for f in prep.fills],
        "treatments": [asdict(t) for t in prep.treatments],
        "encodings": encodings,
        "dates": prep.dates,
        "scales": [asdict(s) for s in prep.scales],
    }


def _load_preparation(spark: SparkSession, state: dict, path: str) -> Preparation:
    fills = [FillRule(**{**f, "alive": tuple(f["alive"])}) for f in state["fills"]]
    treatments = []
    for t in state["treatments"]:
        d = dict(t["detection"])
        d["forest"] = ForestFit(**d["forest"]) if d["forest"] else None
        treatments.append(Treatment(**{**t, "detection": Detection(**d)}))
    encodings = []
    for i, e in enumerate(state["encodings"]):
        stored = e.pop("stored")
        dictionary = spark.read.parquet(f"{path}/dictionary_{i}") if stored else None
        encodings.append(Encoding(**e, dictionary=dictionary))
    return Preparation(
        state["key"],
        state["order_by"],
        fills,
        [t.detection for t in treatments],
        treatments,
        encodings,
        state["dates"],
        [Scale(**s) for s in state["scales"]],
    )


