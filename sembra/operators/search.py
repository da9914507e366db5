"""Cosine nearest neighbours: exact, cluster-probed and hashed.

All functions take ``queries(qid, qvec)`` and ``docs(doc_id, dvec, ...)`` with unit vectors
and return ``qid, doc_id, similarity, rank``; ties go to the lower ``doc_id``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sembra.functions.membership import probe_clusters
from sembra.functions.vectors import as_double, matrix
from sembra.operators import blocks
from sembra.operators.blocks import blocked_topk, celled_topk, rank_order, scanned_topk
from sembra.operators.hashed import (
    PROBE_SAMPLE,
    PROBING_QUERIES,
    HashPlan,
    ProbedBest,
    candidate_share,
    hashed_docs,
    make_plan,
    needed_probes,
    probing_queries,
)
from sembra.session import materialize

TOP_K = 5


def _ranked(hits: DataFrame, k: int, per: str = "qid") -> DataFrame:
    order = Window.partitionBy(per).orderBy(*rank_order(F.col("similarity"), F.col("doc_id")))
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("qid", "doc_id", "similarity", F.col("rank").cast("long").alias("rank"))
    )


def _tied(docs: DataFrame, *extra: str) -> DataFrame:
    return docs.select("doc_id", "dvec", *extra, F.col("doc_id").alias("tie"))


def search_topk(
    queries: DataFrame, docs: DataFrame, k: int = TOP_K, where: Column | None = None, tile_rows: int | None = None
) -> DataFrame:
    """Exact ``k`` nearest docs per query, optionally among docs matching ``where``.

    Queries travel to the docs in tiles of bounded bytes (or of ``tile_rows``); the docs are scanned in
    place, once a tile, and never shuffled, see ``blocks``.
    """
    if where is not None:
        docs = docs.where(where)
    found = scanned_topk(queries, _tied(docs), k, tile_rows)
    return _ranked(_no_hits(queries, docs) if found is None else found, k)


def search_topk_blocked(queries: DataFrame, docs: DataFrame, k: int = TOP_K, tile_rows: int | None = None) -> DataFrame:
    """:func:`search_topk` for batches that are known to be large: blocks of queries meet blocks of docs.

    Nothing passes through the driver; a task multiplies ``tile_rows`` queries at a time.
    """
    return _celled(queries, _tied(docs), k, tile_rows or blocks.PRODUCT_QUERIES)


def _celled(queries: DataFrame, docs: DataFrame, k: int, rows: int, scorer=None) -> DataFrame:
    found = celled_topk(queries, docs, k, rows, scorer)
    return _ranked(_no_hits(queries, docs) if found is None else found, k)


def _no_hits(queries: DataFrame, docs: DataFrame) -> DataFrame:
    none = [queries.schema["qid"], docs.schema["doc_id"], T.StructField("similarity", T.DoubleType())]
    return docs.sparkSession.createDataFrame([], T.StructType(none))


def search_probed(queries: DataFrame, docs: DataFrame, k: int = TOP_K, depth: int = 2) -> DataFrame:
    """Search only the docs of each query's ``depth`` most likely clusters.

    ``queries`` also carries ``cluster_distribution`` and ``dominant_cluster``; ``docs``
    carries ``dominant_cluster``. Large clusters are cut into blocks, see ``blocked_topk``.
    """
    # explode_outer: the plain form adds a filter on the array that runs its encoder twice.
    probes = queries.select(
        "qid",
        "qvec",
        F.explode_outer(
            probe_clusters(F.col("cluster_distribution"), F.col("dominant_cluster"), depth)
        ).alias("cluster"),
    )
    members = _tied(docs, F.col("dominant_cluster").alias("cluster"))
    # Counted per cluster and then joined: written once, so that models above run once.
    return _ranked(blocked_topk(materialize(probes, "probes"), members, k, group=["cluster"]), k)


@dataclass(frozen=True)
class HashedSearch:
    """Documents dealt into buckets, and queries with their reach; both are written, so they are hashed once."""

    docs: DataFrame
    queries: DataFrame
    plan: HashPlan

    def hits(self, k: int) -> DataFrame:
        plan = self.plan

        def probing(tile, k: int) -> ProbedBest:
            return ProbedBest(plan, matrix(tile["qvec"]), tile["reach"].to_numpy(), k)

        return _celled(self.queries, self.docs, k, PROBING_QUERIES, probing)

    def candidate_share(self) -> float:
        return candidate_share(self.queries, self.docs, self.plan)


def hashed_search(
    queries: DataFrame, docs: DataFrame, k: int = TOP_K, recall: float = 0.95, probes: int | None = None, seed: int = 42
) -> HashedSearch | None:
    """Buckets of ``docs`` and the probes of ``queries``; ``None`` where there is no vector to hash.

    The number of ``probes`` a query is calibrated to ``recall`` on at most ``PROBE_SAMPLE`` queries,
    which are searched exactly, unless it is given.
    """
    docs = materialize(docs.select("doc_id", "dvec"), "docs")
    plan = make_plan(docs, seed)
    if plan is None:
        return None
    if probes is None:
        sample = queries.where(F.col("qvec").isNotNull()).orderBy(F.xxhash64(F.lit(seed), "qid"), "qid").limit(PROBE_SAMPLE)
        sample = materialize(sample.select("qid", "qvec"), "probe-sample")
        exact = search_topk(sample, docs, k).select("qid", "doc_id")
        vectors = docs.select("doc_id", as_double(F.col("dvec")).alias("dvec")).join(F.broadcast(exact), "doc_id")
        pairs = vectors.join(F.broadcast(sample.select("qid", as_double(F.col("qvec")).alias("qvec"))), "qid")
        probes = needed_probes(plan, pairs.select("qvec", "dvec").toArrow(), recall)
    plan = replace(plan, probes=min(probes, 1 << plan.bits))
    asking = materialize(probing_queries(queries, plan), "probing")
    rows = docs.where(F.col("dvec").isNotNull()).count()
    parts = blocks.cell_sides(docs.sparkSession, asking.count(), rows)[1]
    return HashedSearch(materialize(hashed_docs(docs, plan, parts), "buckets"), asking, plan)


def search_lsh(
    queries: DataFrame, docs: DataFrame, k: int = TOP_K, recall: float = 0.95, probes: int | None = None, seed: int = 42
) -> DataFrame:
    """Approximate search: score only docs in the buckets that a query probes, see ``hashed``.

    Blocks of queries meet blocks of buckets, so a crowded bucket costs more tasks, not a larger one,
    and a query moves once a block, however many buckets it probes. A query may get fewer than ``k`` hits if its buckets hold fewer docs.
    """
    dealt = hashed_search(queries, docs, k, recall, probes, seed)
    return search_topk(queries, docs, k) if dealt is None else dealt.hits(k)


def format_hits(hits: DataFrame, store: DataFrame) -> DataFrame:
    """Attach stored fields to hits, with defaults for missing metadata.

    ``store(doc_id, document, category, dominant_cluster, cluster_distribution)``. The
    distribution is a map or its JSON text; it is null when absent or not valid JSON.

    The hits are written first: their size in bytes then lets the planner send their ids to the
    store (below its broadcast threshold), so that only the rows of hits are moved.
    """
    hits = materialize(hits, "hits")
    store = store.join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    by_cluster = F.col("cluster_distribution")
    if isinstance(store.schema["cluster_distribution"].dataType, T.StringType):
        parsed = F.from_json(by_cluster, "map<string,double>", {"mode": "PERMISSIVE"})
        by_cluster = F.transform_keys(parsed, lambda c, p: c.cast("int"))
    return hits.join(store, "doc_id", "left").select(
        "qid",
        "rank",
        F.concat(F.lit("doc_"), F.col("doc_id")).alias("id"),
        "document",
        F.coalesce(F.col("category"), F.lit("unknown")).alias("category"),
        F.round("similarity", 4).alias("similarity"),
        F.coalesce(F.col("dominant_cluster"), F.lit(-1)).cast("int").alias("dominant_cluster"),
        by_cluster.alias("cluster_distribution"),
    )
