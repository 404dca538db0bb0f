"""Principal components as a pipeline of standard Spark ML stages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.functions.columns import number, ref
from tablelab.functions.comoments import pair_sums


@dataclass
class Components:
    """Fitted projection: ``model`` maps the input columns to the vector ``output``."""

    features: list[str]
    model: PipelineModel
    loadings: np.ndarray
    ratios: list[float]
    k: int
    output: str
    means: dict[str, float] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        made = [c for s in self.model.stages for c in [s.getOutputCol()] if c != self.output]
        return self.model.transform(as_doubles(df, self.features)).drop(*made)


def as_doubles(df: DataFrame, features: Sequence[str]) -> DataFrame:
    wanted = set(features)
    return df.select(*[number(df, c).alias(c) if c in wanted else ref(c) for c in df.columns])


def check_complete(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """The mean of each column. A missing cell has no place in a model; name the columns that hold any."""
    return complete_means(df, features)[1]


def complete_means(df: DataFrame, features: Sequence[str]) -> tuple[int, dict[str, float]]:
    """The number of rows, and :func:`check_complete`."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.when(number(df, c).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.avg(number(df, c)).alias(f"a{i}") for i, c in enumerate(features)],
    ).first()
    bad = [f"{c} ({row[f'm{i}']})" for i, c in enumerate(features) if row[f"m{i}"]]
    if bad:
        raise ValueError(f"missing values in model columns: {', '.join(bad)}; fill or drop them first")
    return row["rows"], {c: float(row[f"a{i}"] or 0.0) for i, c in enumerate(features)}


def fit_pca(
    df: DataFrame,
    features: Sequence[str],
    k: int | None = None,
    variance: float = 0.95,
    *,
    output: str = "components",
    means: dict[str, float] | None = None,
    weight: str | None = None,
) -> Components:
    """Centre, rotate, orient and keep components.

    ``k`` fixes their number; otherwise it is the smallest whose cumulative
    variance ratio exceeds ``variance``. The largest loading of each component
    is made positive, so that signs do not depend on the solver. ``means`` are
    those of :func:`check_complete`, if it is done. With the column ``weight``
    a row of ``df`` stands for so many equal ones: their covariances come from
    one scan, and the stages are fitted to a few rows that have the same.
    """
    features = list(features)
    means = check_complete(df, features) if means is None else means
    d = len(features)
    if weight is not None:
        df = _alike(df, features, means, weight)
    assembler = VectorAssembler(inputCols=features, outputCol="__assembled")
    rows = assembler.transform(as_doubles(df, features).select(*[ref(c) for c in features])).select("__assembled")
    center = StandardScaler(withMean=True, withStd=False, inputCol="__assembled", outputCol="__centred").fit(rows)
    pca = PCA(k=d, inputCol="__centred", outputCol="__rotated").fit(center.transform(rows))
    loadings = pca.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(d)])
    signs[signs == 0] = 1.0
    ratios = [float(r) for r in pca.explainedVariance.toArray()]
    if k is None:
        k = min(d, int(np.searchsorted(np.cumsum(ratios), variance, side="right")) + 1)
    orient = ElementwiseProduct(scalingVec=Vectors.dense(signs), inputCol="__rotated", outputCol="__oriented")
    keep = VectorSlicer(inputCol="__oriented", outputCol=output, indices=list(range(k)))
    model = PipelineModel(stages=[assembler, center, pca, orient, keep])
    return Components(features, model, loadings * signs, ratios, k, output, means)


def _alike(df: DataFrame, features: list[str], means: dict[str, float], weight: str) -> DataFrame:
    """Two rows per feature, with the means and covariances of the weighted rows of ``df``; ``df`` itself below two rows."""
    d = len(features)
    sums = pair_sums(df, [ref(c) for c in features], ref(weight)).select("i", "j", "n", "x", "y", "xy").collect()
    n = sums[0]["n"]
    if n < 2:
        return df.select(*[ref(c) for c in features])
    covariance = np.zeros((d, d))
    for r in sums:
        covariance[r["i"], r["j"]] = covariance[r["j"], r["i"]] = (r["xy"] - r["x"] * r["y"] / n) / (n - 1)
    values, vectors = np.linalg.eigh(covariance)
    reach = (vectors * np.sqrt(np.maximum(values, 0) * (2 * d - 1) / 2)).T
    middle = np.array([means[c] for c in features])
    rows = np.vstack([middle + reach, middle - reach]).tolist()
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in features])
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], schema).coalesce(1)


def assemble(features: Sequence[str], output: str) -> PipelineModel:
    return PipelineModel(stages=[VectorAssembler(inputCols=list(features), outputCol=output)])


def project(df: DataFrame, fitted: Components, keep: Sequence[str]) -> DataFrame:
    """Key columns and one column ``pc1..pck`` per component."""
    array = vector_to_array(ref(fitted.output))
    rows = fitted.transform(df)
    return rows.select(*[ref(c) for c in keep], *[array[i].alias(f"pc{i + 1}") for i in range(fitted.k)])


def loading_table(df: DataFrame, fitted: Components) -> DataFrame:
    rows = [
        (feature, j + 1, float(fitted.loadings[i, j])) for i, feature in enumerate(fitted.features) for j in range(fitted.k)
    ]
    return df.sparkSession.createDataFrame(rows, "feature string, component int, loading double")


def variance_table(df: DataFrame, fitted: Components) -> DataFrame:
    total = np.cumsum(fitted.ratios)
    rows = [(j + 1, fitted.ratios[j], float(total[j])) for j in range(fitted.k)]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double, cumulative double")


def top_loadings(df: DataFrame, fitted: Components, n: int = 10) -> DataFrame:
    """Features of largest absolute loading per component."""
    order = Window.partitionBy("component").orderBy(F.abs("loading").desc(), "feature")
    ranked = loading_table(df, fitted).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= n)
