"""Reading a soft cluster assignment (``array<double>`` of probabilities, index = cluster)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published system.
MIN_PROBABILITY = 0.01
DOCUMENT_CLUSTERS = 5
REPORT_CLUSTERS = 3
ENTROPY_OFFSET = 1e-10


def dominant_cluster(probs: Column) -> Column:
    """Most likely cluster; the lowest id on ties."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def _entries(probs: Column) -> Column:
    return F.transform(
        probs, lambda p, i: F.struct(i.cast("int").alias("cluster"), p.alias("probability"))
    )


def top_clusters(probs: Column, n: int) -> Column:
    """The ``n`` most likely clusters as ``array<struct<cluster, probability>>``."""
    ranked = F.array_sort(
        _entries(probs),
        lambda a, b: F.when(a["probability"] > b["probability"], -1)
        .when(a["probability"] < b["probability"], 1)
        .otherwise(a["cluster"] - b["cluster"]),
    )
    return F.slice(ranked, 1, n)


def _rounded_map(entries: Column) -> Column:
    return F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["cluster"], F.round(e["probability"], 4)))
    )


def query_distribution(probs: Column, minimum: float = MIN_PROBABILITY) -> Column:
    """Every cluster above ``minimum``, rounded to 4 digits."""
    return _rounded_map(F.filter(_entries(probs), lambda e: e["probability"] > minimum))


def doc_distribution(probs: Column, n: int = DOCUMENT_CLUSTERS) -> Column:
    """The ``n`` strongest clusters, rounded to 4 digits, whatever their probability."""
    return _rounded_map(top_clusters(probs, n))


def membership_entropy(probs: Column) -> Column:
    terms = F.transform(probs, lambda p: p * F.log(p + F.lit(ENTROPY_OFFSET)))
    return -F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)


def probe_clusters(distribution: Column, dominant: Column, depth: int = 2) -> Column:
    """Clusters a lookup searches, most likely first.

    A distribution with more than one entry gives its ``depth`` strongest clusters (lower id
    first on ties); otherwise only the dominant cluster is searched.
    """
    ranked = F.array_sort(
        F.map_entries(distribution),
        lambda a, b: F.when(a["value"] > b["value"], -1)
        .when(a["value"] < b["value"], 1)
        .otherwise(a["key"] - b["key"]),
    )
    strongest = F.transform(F.slice(ranked, 1, depth), lambda e: e["key"])
    return F.when(
        distribution.isNotNull() & (F.size(distribution) > 1), strongest
    ).otherwise(F.array(dominant))
