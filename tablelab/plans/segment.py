"""Segmentation: choose inputs, reduce, compare and tune clusterings, describe."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import ref
from tablelab.operators import centres
from tablelab.operators.cluster import LABEL, Clustering
from tablelab.operators.reduce import Components, as_doubles, assemble, complete_means, fit_pca
from tablelab.operators.search import Search, Trial, compare_clusterings, tune_grid, tune_random
from tablelab.operators.tuner import tune_learning
from tablelab.operators.segments import cluster_mode, cluster_profiles, cluster_sizes, cluster_spend_summary
from tablelab.operators.select import align_to_source, model_inputs, split_target
from tablelab.plans.prepare import Preparation, fit_preparation
from tablelab.session import materialise

VECTOR = "features"


@dataclass
class SegmentModel:
    """Everything needed to label new rows: preparation, projection and clustering.

    ``defaults`` has the training mean of each feature, as the model sees it.
    """

    key: list[str]
    features: list[str]
    projection: PipelineModel
    clustering: Clustering
    preparation: Preparation | None = None
    defaults: dict[str, float] = field(default_factory=dict)

    def inputs(self, df: DataFrame) -> DataFrame:
        """Key and features of every row. A feature without a value takes its training mean."""
        prepared = self.preparation.transform(df, keep_rows=True) if self.preparation else df
        rows = as_doubles(model_inputs(prepared, self.key), self.features)
        known = set(self.features)
        return rows.select(
            *[F.coalesce(ref(c), F.lit(self.defaults.get(c, 0.0))).alias(c) if c in known else ref(c) for c in rows.columns]
        )

    def project(self, df: DataFrame) -> DataFrame:
        rows = self.inputs(df)
        made = self.projection.transform(rows)
        return made.select(*[ref(k) for k in self.key], ref(VECTOR))

    def predict(self, df: DataFrame) -> DataFrame:
        """Key columns and the label of each row of ``df``: one row per row, none is dropped.

        Gaps are filled by the fitted rules. What these leave open (a gap in a
        column that was complete in training or whose rows were dropped there,
        a category not seen in training) takes the training mean of the feature.
        """
        return self.clustering.transform(self.project(df)).select(*[ref(k) for k in self.key], ref(LABEL))


@dataclass
class Segmentation:
    labelled: DataFrame
    model: SegmentModel
    search: Search
    best: Trial
    components: Components | None
    target: DataFrame | None = None

    def labels(self) -> DataFrame:
        return self.labelled.select(*[ref(k) for k in self.model.key], ref(LABEL))


TUNERS = {"learning": tune_learning, "random": tune_random, "grid": tune_grid}


def segment_table(
    df: DataFrame,
    key: Sequence[str],
    algorithms: dict[str, dict[str, Sequence]],
    *,
    drop: Sequence[str] = (),
    target_column: str | None = None,
    use_pca: bool = True,
    pca_variance: float = 0.95,
    pca_components: int | None = None,
    tune: str | None = None,
    tune_trials: int = 30,
    tune_space: dict | None = None,
    tune_with: str = "learning",
    metric: str = "silhouette",
    mode: str = "squared",
    seed: int = 42,
    preparation: Preparation | None = None,
) -> Segmentation:
    """Fit every candidate on one materialised frame and keep the best.

    Of more than ``FEW_ROWS`` rows, equal ones are merged first, and components
    are fitted to the distinct ones and projected for these. The frame of all
    rows is then written only for what needs it (exact single linkage,
    Euclidean silhouettes); else the labels are a projection of ``df``.
    Tuned trials join the trial table, so a tuned model only wins if it is better.
    """
    target = None
    if target_column:
        df, target = split_target(df, target_column, key)
    inputs = model_inputs(df, key, drop)
    features = [c for c in inputs.columns if c not in key]
    if not features:
        raise ValueError("no numeric or boolean columns to cluster on")
    inputs = as_doubles(inputs, features)
    rows, defaults = complete_means(inputs, features)
    distinct = centres.merge_rows(inputs, features) if rows > centres.FEW_ROWS else None
    components = None
    if use_pca:
        fitted, weight = (inputs, None) if distinct is None else (distinct, centres.WEIGHT)
        components = fit_pca(fitted, features, pca_components, pca_variance, output=VECTOR, means=defaults, weight=weight)
        projection = components.model
    else:
        projection = assemble(features, VECTOR)
    merged = None if distinct is None else centres.merge_again(projection.transform(distinct), VECTOR)
    frame = projection.transform(inputs).select(*[ref(k) for k in key], ref(VECTOR))
    if merged is None or mode != "squared" or "single_linkage" in {*algorithms, tune}:
        frame = materialise(frame, key)
    search = compare_clusterings(frame, algorithms, key=key, metric=metric, mode=mode, seed=seed, vector=VECTOR, ready=True, merged=merged)
    if tune:
        if tune_with not in TUNERS:
            raise ValueError(f"unknown tuner {tune_with!r}, expected one of {tuple(TUNERS)}")
        tuner = TUNERS[tune_with]
        tuned = tuner(
            frame, tune, key=key, n_trials=tune_trials, space=tune_space, metric=metric, mode=mode, seed=seed,
            vector=VECTOR, first_number=len(search.trials), ready=True, merged=merged,
        )
        search = Search([*search.trials, *tuned.trials], metric)
    best = search.best()
    model = SegmentModel(list(key), features, projection, best.clustering, preparation, defaults)
    return Segmentation(best.clustering.transform(frame), model, search, best, components, target)


@dataclass
class Report:
    segmentation: Segmentation
    original: DataFrame
    sizes: DataFrame
    profiles: DataFrame
    spend: DataFrame
    mode: DataFrame | None


def segment_end_to_end(
    source: DataFrame,
    key: Sequence[str],
    algorithms: dict[str, dict[str, Sequence]],
    *,
    drop: Sequence[str] = (),
    mean_of: str,
    spend_pattern: str,
    mode_of: str | None = None,
    prepare_options: dict | None = None,
    **options,
) -> Report:
    """Prepare, segment, and describe the groups on the original values.

    The source is materialised once: it is often a join, and every fitting step
    and the final description read it again.
    """
    source = materialise(source, key)
    preparation = fit_preparation(source, key, **(prepare_options or {}))
    prepared = preparation.transform(source)
    found = segment_table(prepared, key, algorithms, drop=drop, preparation=preparation, **options)
    original = align_to_source(source, materialise(found.labels(), key), key)
    return Report(
        found,
        original,
        cluster_sizes(original, LABEL),
        cluster_profiles(original, LABEL, exclude=key),
        cluster_spend_summary(original, LABEL, mean_of, spend_pattern),
        cluster_mode(original, LABEL, mode_of) if mode_of else None,
    )


def segment_overview(report: Report) -> DataFrame:
    """One row per cluster: size, share, mean, spend and most frequent category."""
    out = report.sizes.join(report.spend.drop("size"), "cluster")
    if report.mode is not None:
        out = out.join(report.mode.select("cluster", "mode"), "cluster")
    return out.orderBy(F.col("cluster"))
