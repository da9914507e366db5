"""The semantic cache as tables: lookup against a snapshot, store, eviction, statistics.

A snapshot has one row per entry: ``key, query_text, embedding, result, dominant_cluster,
cluster_distribution, created_seq, seq``. ``created_seq`` orders insertion and ``seq`` the last
use; both are unique. Queries carry ``qid, query, embedding, dominant_cluster,
cluster_distribution``.
"""

from __future__ import annotations

from collections import OrderedDict

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sembra.functions.membership import probe_clusters
from sembra.functions.text import cache_key
from sembra.operators.blocks import RANK_DIGITS, blocked_topk
from sembra.session import lookup_join, materialize

# Fixed values of the published system.
THRESHOLD = 0.60
MAX_SIZE = 10_000
SEARCH_DEPTH = 2

SEQUENCE_BLOCK_ROWS = 100_000


def exact_lookup(queries: DataFrame, cache: DataFrame) -> DataFrame:
    """Queries with ``key`` and, where an entry has that key, ``matched_query`` (score 1)."""
    keyed = queries.withColumn("key", cache_key(F.col("query")))
    entries = cache.select("key", F.col("query_text").alias("matched_query"))
    return lookup_join(keyed, entries, ["key"], spread_by="qid", how="left")


def semantic_lookup(
    queries: DataFrame, cache: DataFrame, threshold: float = THRESHOLD, depth: int = SEARCH_DEPTH
) -> DataFrame:
    """Best entry per query among its probed clusters, if it reaches ``threshold``.

    On equal similarity the earlier probe wins, then the entry inserted first. The threshold
    applies to the unrounded value. Returns ``qid, matched_key, score`` for hits only.
    """
    probed = queries.select(
        "qid",
        F.col("embedding").alias("qvec"),
        F.posexplode_outer(
            probe_clusters(F.col("cluster_distribution"), F.col("dominant_cluster"), depth)
        ).alias("probe", "cluster"),
    ).select(F.struct("qid", "probe").alias("qid"), "qvec", "cluster")
    entries = cache.select(
        F.col("key").alias("doc_id"),
        F.col("embedding").alias("dvec"),
        F.col("created_seq").alias("tie"),
        F.col("dominant_cluster").alias("cluster"),
    )
    candidates = blocked_topk(probed, entries, 1, group=["cluster"])
    order = F.struct(
        (-F.round("similarity", RANK_DIGITS)).alias("distance"),
        F.col("qid.probe").alias("probe"),
        "tie",
        F.col("doc_id").alias("key"),
        "similarity",
    )
    best = candidates.groupBy(F.col("qid.qid").alias("qid")).agg(F.min(order).alias("best"))
    return best.select(
        "qid", F.col("best.key").alias("matched_key"), F.col("best.similarity").alias("score")
    ).where(F.col("score") >= threshold)


def cache_lookup(
    queries: DataFrame, cache: DataFrame, threshold: float = THRESHOLD, depth: int = SEARCH_DEPTH
) -> DataFrame:
    """One log row per query: ``qid, key, hit, matched_key, matched_query, score``.

    An equal key hits with score 1 whatever the vector or cluster; only the rest is compared.
    The rest is written once, so that an encoder or model above it runs once.
    """
    looked_up = exact_lookup(queries, cache)
    exact = F.col("matched_query").isNotNull()
    rest = looked_up.where(~exact).select("qid", "embedding", "dominant_cluster", "cluster_distribution")
    similar = lookup_join(
        semantic_lookup(materialize(rest, "rest"), cache, threshold, depth),
        cache.select(F.col("key").alias("matched_key"), F.col("query_text").alias("similar_query")),
        ["matched_key"],
        spread_by="qid",
    )
    return (
        looked_up.select("qid", "key", "matched_query")
        .join(similar, "qid", "left")
        .select(
            "qid",
            "key",
            (exact | F.col("matched_key").isNotNull()).alias("hit"),
            F.when(exact, F.col("key")).otherwise(F.col("matched_key")).alias("matched_key"),
            F.coalesce("matched_query", "similar_query").alias("matched_query"),
            F.when(exact, 1.0).otherwise(F.col("score")).alias("score"),
        )
    )


def cache_store(cache: DataFrame, rows: DataFrame) -> DataFrame:
    """Snapshot after storing ``rows`` (``query, embedding, result, dominant_cluster,
    cluster_distribution, seq``).

    A known key keeps its text, vector and cluster and takes the new result and recency. Among
    new rows of one key the first makes the entry and the last gives the result.
    """
    entry = F.struct(
        F.col("query").alias("query_text"), "embedding", "dominant_cluster", "cluster_distribution", "seq"
    )
    fresh = (
        rows.withColumn("key", cache_key(F.col("query")))
        .groupBy("key")
        .agg(
            F.min_by(entry, "seq").alias("first"),
            F.max_by(F.struct("result"), "seq").alias("last"),
            F.max("seq").alias("last_seq"),
        )
    )
    known = cache.withColumn("known", F.lit(True))
    joined = known.join(fresh, "key", "full_outer")
    old = F.col("known").isNotNull()
    keep = lambda name: F.when(old, F.col(name)).otherwise(F.col(f"first.{name}")).alias(name)
    return joined.select(
        "key",
        keep("query_text"),
        keep("embedding"),
        F.when(F.col("last").isNotNull(), F.col("last.result")).otherwise(F.col("result")).alias("result"),
        keep("dominant_cluster"),
        keep("cluster_distribution"),
        F.when(old, F.col("created_seq")).otherwise(F.col("first.seq")).alias("created_seq"),
        F.coalesce("last_seq", "seq").alias("seq"),
    )


def evict_lru(cache: DataFrame, max_size: int = MAX_SIZE) -> DataFrame:
    """Keep the ``max_size`` most recently used entries.

    Only ``seq`` takes part in the ordering; entries are then filtered by the cut-off.
    """
    if max_size <= 0:
        return cache.limit(0)
    kept = cache.select("seq").orderBy(F.col("seq").desc()).limit(max_size)
    return cache.where(F.col("seq") >= kept.agg(F.min("seq")).scalar())


def touch(cache: DataFrame, hits: DataFrame) -> DataFrame:
    """Renew the recency of matched entries; ``hits(matched_key, seq)``."""
    latest = hits.groupBy(F.col("matched_key").alias("key")).agg(F.max("seq").alias("hit_seq"))
    return (
        cache.join(latest, "key", "left")
        .withColumn("seq", F.greatest(F.col("seq"), F.coalesce("hit_seq", "seq")))
        .drop("hit_seq")
    )


def cache_stats(log: DataFrame, cache: DataFrame) -> DataFrame:
    hits = F.count_if(F.col("hit"))
    total = F.count(F.lit(1))
    return log.agg(
        cache.agg(F.count(F.lit(1))).scalar().alias("total_entries"),
        hits.alias("hit_count"),
        (total - hits).alias("miss_count"),
        F.when(total > 0, F.round(hits / total, 4)).otherwise(0.0).alias("hit_rate"),
    )


def cache_cluster_counts(cache: DataFrame) -> DataFrame:
    return cache.groupBy("dominant_cluster").agg(F.count(F.lit(1)).alias("entries"))


def cache_clear(cache: DataFrame) -> tuple[DataFrame, int]:
    """An empty snapshot and the number of entries removed."""
    return cache.limit(0), cache.count()


def sequence_blocks(log: DataFrame, block_rows: int = SEQUENCE_BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Cut every tenant's log into consecutive blocks of about ``block_rows`` rows.

    Returns the log with ``block`` (0, 1, ... per tenant, in ``seq`` order) and the block list
    ``tenant, block``. Blocks come from range partitions, so a tenant with a third of all rows
    is spread over a third of the tasks; they are written once because they depend on sampling.
    """
    parts = max(1, -(-log.count() // block_rows))
    ranged = materialize(
        log.repartitionByRange(parts, "tenant", "seq").withColumn("_part", F.spark_partition_id()), "sequence"
    )
    order = Window.partitionBy("tenant").orderBy("_part")
    index = (
        ranged.select("tenant", "_part").distinct().withColumn("block", F.row_number().over(order) - F.lit(1))
    )
    blocked = ranged.join(index, ["tenant", "_part"]).drop("_part")
    return blocked, index.select("tenant", "block")


def _recent(accesses: DataFrame, max_size: int) -> DataFrame:
    """Last access of each key, for the ``max_size`` most recent keys of every block."""
    order = Window.partitionBy("tenant", "block").orderBy(F.col("at").desc())
    return (
        accesses.groupBy("tenant", "block", "key")
        .agg(F.max("at").alias("at"))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= max_size)
        .drop("_rank")
    )


def exact_cache_replay(log: DataFrame, max_size: int, block_rows: int = SEQUENCE_BLOCK_ROWS) -> DataFrame:
    """Replay of an exact-key LRU cache per tenant: ``tenant, seq, key, hit``.

    The content of an LRU cache at any moment is the ``max_size`` most recently used keys, and
    two such summaries of neighbouring stretches merge into the summary of both. The content at
    the start of every block is therefore a prefix scan, done by doubling: after round ``r``
    a block knows its last ``2**r`` predecessors, and blocks that already know ``max_size`` keys
    are done. Then all blocks replay at once, each from its own starting content.
    """
    blocks, index = sequence_blocks(log.select("tenant", "seq", "key"), block_rows)
    index = materialize(index, "blocks")
    longest = index.agg(F.max("block")).first()[0] or 0
    own = _recent(blocks.withColumnRenamed("seq", "at"), max_size)
    following = own.withColumn("block", F.col("block") + 1)
    state = materialize(following.join(index, ["tenant", "block"], "left_semi"), "content")
    span = 1
    while span <= longest:
        known = state.groupBy("tenant", "block").agg(F.count(F.lit(1)).alias("n"))
        open_blocks = known.where((F.col("n") < max_size) & (F.col("block") > span)).drop("n")
        if open_blocks.isEmpty():
            break
        older = state.withColumn("block", F.col("block") + span).join(
            open_blocks, ["tenant", "block"], "left_semi"
        )
        state = materialize(_recent(state.unionByName(older), max_size), "content")
        span *= 2

    schema = T.StructType([*log.select("tenant", "seq", "key").schema.fields, T.StructField("hit", T.BooleanType())])

    def replay(rows: pd.DataFrame, content: pd.DataFrame) -> pd.DataFrame:
        recent: OrderedDict[str, None] = OrderedDict.fromkeys(content.sort_values("at")["key"])
        rows = rows.sort_values("seq")
        hits = []
        for key in rows["key"]:
            hits.append(key in recent)
            recent.pop(key, None)
            recent[key] = None
            if len(recent) > max_size:
                recent.popitem(last=False)
        return rows.assign(hit=pd.Series(hits, index=rows.index, dtype=bool))[["tenant", "seq", "key", "hit"]]

    cell = ["tenant", "block"]
    return blocks.groupBy(*cell).cogroup(state.groupBy(*cell)).applyInPandas(replay, schema)
