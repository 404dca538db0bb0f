"""Writing the tables of a preparation and segmentation run, one folder each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import normalise_missing
from tablelab.operators.cluster import LABEL
from tablelab.operators.missing import missing_report
from tablelab.operators.outliers import detection_table
from tablelab.operators.profile import profile_report
from tablelab.operators.reduce import loading_table, top_loadings, variance_table
from tablelab.operators.segments import combined_importance
from tablelab.operators.scale import scale_table
from tablelab.operators.select import model_inputs
from tablelab.plans.prepare import Preparation, step_audit
from tablelab.plans.segment import Segmentation
from tablelab.plans.store import save_model
from tablelab.session import materialise
from tablelab.sources.files import write_csv, write_predictions


def export_preparation(
    source: DataFrame, preparation: Preparation, path: str, *, mode: str = "errorifexists"
) -> dict[str, str]:
    """Profile, missing-value, outlier, scaling and step reports, and the prepared rows."""
    start = normalise_missing(source)
    filled = preparation.step("missing", start)
    tables = {
        "profile": profile_report(start),
        "missing": missing_report(start, filled, preparation.fills),
        "outliers": detection_table(start, preparation.detections),
        "scales": scale_table(start, preparation.scales),
        "steps": step_audit(source, preparation),
        "processed_data": preparation.transform(source),
    }
    written = {}
    for name, table in tables.items():
        written[name] = f"{path}/{name}"
        write_csv(table, written[name], mode)
    return written


def flat_trials(trials: DataFrame) -> DataFrame:
    """The trial table with its parameter map as text, as CSV has no maps."""
    return trials.withColumn("params", F.to_json("params"))


def export_segmentation(
    found: Segmentation, inputs: DataFrame, path: str, *, importance: bool = True, mode: str = "errorifexists"
) -> dict[str, str]:
    """Trials, labels, component report, feature importance and the model itself.

    ``inputs`` is the prepared table that was segmented. Feature importance
    needs pair distances, so it can be left out for large tables.
    """
    spark = inputs.sparkSession
    key, features = found.model.key, found.model.features
    tables = {"trials": flat_trials(found.search.table(spark)), "trials_by_clusters": found.search.by_clusters(spark)}
    if found.components is not None:
        tables["pca_loadings"] = loading_table(inputs, found.components)
        tables["pca_variance"] = variance_table(inputs, found.components)
        tables["pca_top_features"] = top_loadings(inputs, found.components)
    labels = materialise(found.labels(), key)
    if importance:
        rows = model_inputs(inputs, key).join(labels, key)
        tables["feature_importance"] = combined_importance(rows, LABEL, features, key)
    written = {}
    for name, table in tables.items():
        written[name] = f"{path}/{name}"
        write_csv(table, written[name], mode)
    written["predictions"] = f"{path}/predictions"
    write_predictions(inputs.join(labels, key), written["predictions"], label=LABEL, mode=mode)
    save_model(found.model, found.best.metrics, f"{path}/model", spark, mode)
    written["model"] = f"{path}/model"
    return written
