"""Answering a batch of queries through the cache."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sembra.functions.vectors import as_double
from sembra.operators.cache import (
    MAX_SIZE,
    SEARCH_DEPTH,
    THRESHOLD,
    cache_lookup,
    cache_store,
    evict_lru,
    touch,
)
from sembra.operators.encode import Encoder, HashingEncoder, embed_queries
from sembra.operators.mixture import Mixture, predict_queries
from sembra.operators.reduction import pca_transform
from sembra.operators.search import TOP_K, format_hits, search_topk
from sembra.plans.responses import format_response, pack_results, validate_queries
from sembra.session import materialize, spread


@dataclass(frozen=True)
class Answers:
    responses: DataFrame
    rejected: DataFrame
    log: DataFrame
    cache: DataFrame


def understand_queries(
    queries: DataFrame,
    mixture: Mixture,
    pca: PipelineModel | None = None,
    encoder: Callable[[], Encoder] = HashingEncoder,
) -> DataFrame:
    """Add vector and cluster fields to ``queries(qid, query)``."""
    embedded = embed_queries(spread(queries), encoder=encoder)
    embedded = embedded.withColumn("embedding", as_double(F.col("embedding")))
    if pca is None:
        return predict_queries(embedded, mixture, "embedding")
    return predict_queries(pca_transform(embedded, pca), mixture).drop("reduced")


def answer_queries(
    queries: DataFrame,
    store: DataFrame,
    cache: DataFrame,
    mixture: Mixture,
    pca: PipelineModel | None = None,
    encoder: Callable[[], Encoder] = HashingEncoder,
    threshold: float = THRESHOLD,
    depth: int = SEARCH_DEPTH,
    max_size: int = MAX_SIZE,
    k: int = TOP_K,
) -> Answers:
    """Answer ``queries(qid, query)`` against a cache snapshot and a document store.

    Queries of one batch see the snapshot, not each other. ``qid`` orders recency: it must
    exceed every ``seq`` of the snapshot. The returned ``cache`` holds the updated entries.
    """
    accepted, rejected = validate_queries(queries)
    # Encoded and looked up once; the log decides which rows are searched.
    understood = materialize(understand_queries(accepted, mixture, pca, encoder), "queries")
    log = materialize(cache_lookup(understood, cache, threshold, depth), "lookup")
    misses = understood.join(log.where("not hit").select("qid"), "qid", "left_semi")
    found = search_topk(
        misses.select("qid", F.col("embedding").alias("qvec")),
        store.select("doc_id", F.col("embedding").alias("dvec")),
        k,
    )
    fresh = materialize(pack_results(format_hits(found, store)), "results")
    cached = cache.select(F.col("key").alias("matched_key"), F.col("result").alias("cached_result"))
    responses = format_response(understood, log, cached, fresh)

    hits = log.where("hit").select("matched_key", F.col("qid").alias("seq"))
    rows = misses.join(fresh, "qid", "left").withColumn("seq", F.col("qid"))
    updated = evict_lru(cache_store(touch(cache, hits), rows), max_size)
    return Answers(responses, rejected, log, updated)
