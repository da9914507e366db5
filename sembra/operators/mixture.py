"""Gaussian mixtures: fit, soft assignment, likelihood and information criteria."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixtureModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sembra.functions.membership import (
    doc_distribution,
    dominant_cluster,
    membership_entropy,
    query_distribution,
    top_clusters,
)
from sembra.functions.text import preview
from sembra.functions.vectors import as_double, list_array, matrix
from sembra.operators.em import VARIANCE_FLOOR, Fit, best_fits, fit_mixtures

# Fixed values of the published system.
N_CLUSTERS = 18
FIT_RESTARTS = 5
FIT_ITERATIONS = 300
SEED = 42
MAX_PARAMETERS = 50_000_000


@dataclass(frozen=True)
class Mixture:
    """Parameters small enough to travel with a task: ``K`` weights, means and spreads.

    ``spreads`` holds variances (``K x d``) of a diagonal mixture or covariance matrices
    (``K x d x d``) of a full one. ``labels`` are the cluster ids to report where these are not
    0, 1, ... (posteriors stay in the order of the components).
    """

    weights: np.ndarray
    means: np.ndarray
    spreads: np.ndarray
    labels: np.ndarray | None = None

    @property
    def k(self) -> int:
        return self.means.shape[0]

    @property
    def dim(self) -> int:
        return self.means.shape[1]

    @property
    def is_full(self) -> bool:
        return self.spreads.ndim == 3

    @property
    def n_parameters(self) -> int:
        per_cluster = self.dim * (self.dim + 1) // 2 if self.is_full else self.dim
        return self.k - 1 + self.k * self.dim + self.k * per_cluster

    def log_joint(self, x: np.ndarray) -> np.ndarray:
        """``log(weight * density)`` per row and cluster."""
        out = np.empty((x.shape[0], self.k))
        with np.errstate(divide="ignore"):
            log_weights = np.log(self.weights)
        for c in range(self.k):
            diff = x - self.means[c]
            if self.is_full:
                root = np.linalg.cholesky(self.spreads[c])
                log_det = 2.0 * np.log(np.diag(root)).sum()
                # Whitening by the small inverse keeps the work per row one matrix product.
                white = diff @ np.linalg.inv(root).T
                distance = np.einsum("ij,ij->i", white, white)
            else:
                log_det = np.log(self.spreads[c]).sum()
                distance = (diff**2 / self.spreads[c]).sum(axis=1)
            out[:, c] = log_weights[c] - 0.5 * (self.dim * np.log(2 * np.pi) + log_det + distance)
        return out

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posterior probabilities and log density of every row."""
        joint = self.log_joint(x)
        top = joint.max(axis=1, keepdims=True)
        shifted = np.exp(joint - top)
        total = shifted.sum(axis=1, keepdims=True)
        return shifted / total, (top + np.log(total))[:, 0]

    def to_json(self) -> str:
        names = ("weights", "means", "spreads", "labels")
        return json.dumps({n: getattr(self, n).tolist() for n in names if getattr(self, n) is not None})

    @classmethod
    def from_json(cls, text: str) -> Mixture:
        return cls(**{n: np.array(v) for n, v in json.loads(text).items()})

    @classmethod
    def from_fit(cls, fit: Fit) -> Mixture:
        return cls(fit.weights, fit.means, fit.covariances)

    @classmethod
    def from_model(cls, model: GaussianMixtureModel) -> Mixture:
        """The parameters of a mixture that Spark ML has fitted."""
        return cls(
            np.array(model.weights),
            np.array([g.mean.toArray() for g in model.gaussians]),
            np.array([_floored(g.cov.toArray()) for g in model.gaussians]),
        )


def _floored(covariance: np.ndarray) -> np.ndarray:
    """Raise variances below the floor: copies of one text make a component flat in some direction."""
    variances, axes = np.linalg.eigh(covariance)
    if variances[0] >= VARIANCE_FLOOR:
        return covariance
    return (axes * np.maximum(variances, VARIANCE_FLOOR)) @ axes.T


def diagonal_mixture(df: DataFrame, label_col: str, vector_col: str = "embedding") -> Mixture:
    """The mixture a labelled table implies: share, mean and variance of every label.

    Components are in label order and carry their labels (whole numbers), which need not be without
    gaps. One map-side combined aggregation; what reaches the driver is the parameter table, refused
    above ``MAX_PARAMETERS`` numbers.
    """
    features = df.where(F.col(label_col).isNotNull()).select(label_col, array_to_vector(as_double(F.col(vector_col))).alias("v"))
    rows = (
        features.groupBy(label_col)
        .agg(
            F.count(F.lit(1)).alias("n"),
            Summarizer.mean(F.col("v")).alias("mean"),
            Summarizer.variance(F.col("v")).alias("var"),
        )
        .orderBy(label_col)
        .select(F.col(label_col).alias("label"), "n", vector_to_array("mean").alias("mean"), vector_to_array("var").alias("var"))
    )
    limit = 100_000
    table = rows.limit(limit + 1).collect()
    if len(table) > limit or sum(len(r["mean"]) for r in table) > MAX_PARAMETERS:
        raise ValueError("too many clusters for a mixture")
    counts = np.array([r["n"] for r in table], dtype=np.float64)
    return Mixture(
        counts / counts.sum(),
        np.array([r["mean"] for r in table]),
        np.array([r["var"] for r in table]) + VARIANCE_FLOOR,
        np.array([r["label"] for r in table], dtype=np.int64),
    )


def _labelled(mixture: Mixture, cluster: Column) -> Column:
    """The label of a component number."""
    if mixture.labels is None:
        return cluster
    return F.get(F.lit(mixture.labels.tolist()).cast("array<int>"), cluster)


def _labelled_map(mixture: Mixture, distribution: Column) -> Column:
    if mixture.labels is None:
        return distribution
    return F.transform_keys(distribution, lambda cluster, p: _labelled(mixture, cluster))


def fit_gmm(
    df: DataFrame,
    k: int = N_CLUSTERS,
    n_init: int = FIT_RESTARTS,
    max_iter: int = FIT_ITERATIONS,
    covariance: str = "full",
    vector_col: str = "reduced",
    seed: int = SEED,
) -> tuple[Mixture, float]:
    """Best of ``n_init`` EM fits by log likelihood, with that likelihood; all fits share their scans."""
    if covariance != "full":
        raise ValueError("only full covariance is available")
    fit = best_fits(fit_mixtures(df, [(k, seed + i) for i in range(n_init)], max_iter, vector_col))[k]
    return Mixture.from_fit(fit), fit.log_likelihood


def gmm_posteriors(
    df: DataFrame, mixture: Mixture, vector_col: str = "reduced", output_col: str = "probs"
) -> DataFrame:
    """Add ``probs`` (index = cluster) and ``log_density``; one Arrow pass, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(mixture)

    @F.arrow_udf("struct<probs: array<double>, log_density: double>")
    def assign(vectors: pa.Array) -> pa.Array:
        probs, density = shared.value.assign(matrix(vectors))
        return pa.StructArray.from_arrays(
            [list_array(probs), pa.array(density)], names=["probs", "log_density"]
        )

    return (
        df.withColumn("_assigned", assign(as_double(F.col(vector_col))))
        .withColumns({output_col: F.col("_assigned.probs"), "log_density": F.col("_assigned.log_density")})
        .drop("_assigned")
    )


def assign_clusters(df: DataFrame, mixture: Mixture, vector_col: str = "reduced") -> DataFrame:
    """Hard label, top-5 distribution and entropy of every document."""
    return gmm_posteriors(df, mixture, vector_col).withColumns(
        {
            "dominant_cluster": _labelled(mixture, dominant_cluster(F.col("probs"))),
            "cluster_distribution": _labelled_map(mixture, doc_distribution(F.col("probs"))),
            "entropy": membership_entropy(F.col("probs")),
        }
    )


def predict_queries(df: DataFrame, mixture: Mixture, vector_col: str = "reduced") -> DataFrame:
    """Hard label, thresholded distribution and entropy of every query."""
    return (
        gmm_posteriors(df, mixture, vector_col)
        .withColumns(
            {
                "dominant_cluster": _labelled(mixture, dominant_cluster(F.col("probs"))),
                "cluster_distribution": _labelled_map(mixture, query_distribution(F.col("probs"))),
                "entropy": membership_entropy(F.col("probs")),
            }
        )
        .drop("probs", "log_density")
    )


def log_likelihood(df: DataFrame, mixture: Mixture, vector_col: str = "reduced") -> float:
    return gmm_posteriors(df, mixture, vector_col).agg(F.sum("log_density")).first()[0]


def bic(log_lik: float, mixture: Mixture, n: int) -> float:
    return -2.0 * log_lik + mixture.n_parameters * float(np.log(n))


def aic(log_lik: float, mixture: Mixture) -> float:
    return -2.0 * log_lik + 2.0 * mixture.n_parameters


def information_criteria(df: DataFrame, mixture: Mixture, vector_col: str = "reduced") -> DataFrame:
    """One row: ``n_samples, log_likelihood, bic, aic``, from one pass over the data."""
    p = float(mixture.n_parameters)
    totals = gmm_posteriors(df, mixture, vector_col).agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum("log_density").alias("log_likelihood")
    )
    return totals.withColumns(
        {
            "bic": -2.0 * F.col("log_likelihood") + F.lit(p) * F.log(F.col("n_samples")),
            "aic": -2.0 * F.col("log_likelihood") + F.lit(2.0 * p),
        }
    )


def boundary_documents(assigned: DataFrame, docs: DataFrame, top_n: int = 20) -> DataFrame:
    """The most ambiguous documents with their three strongest clusters.

    ``assigned(doc_id, probs)``; ``docs(doc_id, text, category)``. The top-n is taken on
    ``(doc_id, probs)`` before the texts are joined.
    """
    strongest = (
        assigned.withColumn("entropy", membership_entropy(F.col("probs")))
        .orderBy(F.col("entropy").desc(), "doc_id")
        .limit(top_n)
        .select("doc_id", "entropy", top_clusters(F.col("probs"), 3).alias("top_clusters"))
    )
    return docs.join(F.broadcast(strongest), "doc_id").select(
        "doc_id",
        "entropy",
        "top_clusters",
        "category",
        preview(F.col("text"), 200).alias("text_preview"),
    )
