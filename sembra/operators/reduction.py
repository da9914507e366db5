"""Principal components with centring, as a Spark ML pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sembra.functions.vectors import as_double

PCA_COMPONENTS = 50


def _with_features(df: DataFrame, vector_col: str) -> DataFrame:
    return df.withColumn("_features", array_to_vector(as_double(F.col(vector_col))))


def fit_pca(df: DataFrame, n: int = PCA_COMPONENTS, vector_col: str = "embedding") -> PipelineModel:
    """Fit on all vectors. Centring is a stage of its own: PCA alone does not centre rows."""
    return Pipeline(
        stages=[
            StandardScaler(inputCol="_features", outputCol="_centred", withMean=True, withStd=False),
            PCA(k=n, inputCol="_centred", outputCol="_reduced"),
        ]
    ).fit(_with_features(df, vector_col).select("_features"))


def pca_transform(
    df: DataFrame, model: PipelineModel, vector_col: str = "embedding", output_col: str = "reduced"
) -> DataFrame:
    projected = model.transform(_with_features(df, vector_col))
    return projected.withColumn(output_col, vector_to_array("_reduced")).drop(
        "_features", "_centred", "_reduced"
    )


def variance_explained(model: PipelineModel) -> float:
    return float(sum(model.stages[-1].explainedVariance))


def project_2d(df: DataFrame, vector_col: str = "embedding") -> tuple[DataFrame, float]:
    """Coordinates ``x, y`` of every row on the first two components, and their variance share.

    The sign of a component is arbitrary; it is fixed so that the loading of largest
    magnitude is positive.
    """
    model = fit_pca(df, 2, vector_col)
    loadings = model.stages[-1].pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] > 0 else -1.0 for column in loadings.T]
    reduced = pca_transform(df, model, vector_col, "_xy")
    coordinates = reduced.withColumns(
        {"x": F.col("_xy")[0] * F.lit(signs[0]), "y": F.col("_xy")[1] * F.lit(signs[1])}
    ).drop("_xy")
    return coordinates, variance_explained(model)
