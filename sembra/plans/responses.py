"""The shape of an answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sembra.functions.text import preview

MAX_QUERY_LENGTH = 1_000
RESULT_TYPE = (
    "array<struct<document: string, category: string, similarity: double,"
    " cluster_distribution: map<int,double>>>"
)


def validate_queries(df: DataFrame, query_col: str = "query") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected queries: 1 to 1,000 characters, blanks count."""
    fits = F.coalesce(F.length(query_col).between(1, MAX_QUERY_LENGTH), F.lit(False))
    return df.where(fits), df.where(~fits)


def pack_results(hits: DataFrame) -> DataFrame:
    """The ranked hits of each query (at most k rows) as one ``result`` array."""
    item = F.struct(
        "rank", preview(F.col("document")).alias("document"), "category", "similarity", "cluster_distribution"
    )
    return hits.groupBy("qid").agg(F.collect_list(item).alias("items")).select(
        "qid",
        F.transform(
            # A map cannot be compared, so the order is taken from the rank alone.
            F.array_sort("items", lambda a, b: a["rank"].cast("int") - b["rank"].cast("int")),
            lambda e: F.struct(
                e["document"].alias("document"),
                e["category"].alias("category"),
                e["similarity"].alias("similarity"),
                e["cluster_distribution"].alias("cluster_distribution"),
            ),
        ).alias("result"),
    )


def format_response(queries: DataFrame, log: DataFrame, cached: DataFrame, fresh: DataFrame) -> DataFrame:
    """One response per query.

    ``cached(matched_key, cached_result)`` answers hits and ``fresh(qid, result)`` misses. The
    cluster fields are those of the query itself, also on a hit. A query that was searched and
    found nothing has an empty list.
    """
    hit = F.col("hit")
    nothing = F.array().cast(fresh.schema["result"].dataType)
    return (
        queries.select("qid", "query", "dominant_cluster", "cluster_distribution")
        .join(log.select("qid", "hit", "matched_key", "matched_query", "score"), "qid")
        .join(cached, "matched_key", "left")
        .join(fresh, "qid", "left")
        .select(
            "qid",
            "query",
            hit.alias("cache_hit"),
            F.when(hit, F.col("matched_query")).alias("matched_query"),
            F.when(hit, F.round("score", 4)).alias("similarity_score"),
            F.when(hit, F.col("cached_result")).otherwise(F.coalesce("result", nothing)).alias("result"),
            "dominant_cluster",
            "cluster_distribution",
        )
    )


def health_summary(store: DataFrame, cache: DataFrame) -> DataFrame:
    return store.agg(
        F.count(F.lit(1)).alias("documents"), cache.agg(F.count(F.lit(1))).scalar().alias("cache_entries")
    )
