"""One cache shared by all queries, advanced by micro-batches.

Queries of one micro-batch see the entries of earlier micro-batches only, which is what lets
the whole batch be answered in parallel. The cache is a log: a batch writes what it changes (new
entries, renewed recency, removals) under its number, and every ``COMPACT_EVERY`` batches the whole
is written once. Reading merges the last whole with the changes after it, by key. A batch reads what
its predecessors wrote and nothing of its own, so a repeated batch writes the same again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sembra.operators.cache import (
    MAX_SIZE,
    SEARCH_DEPTH,
    THRESHOLD,
    cache_lookup,
    cache_store,
)
from sembra.operators.search import TOP_K, format_hits, search_topk
from sembra.plans.responses import RESULT_TYPE, pack_results
from sembra.session import materialize

SNAPSHOT_SCHEMA = (
    f"key string, query_text string, embedding array<double>, result {RESULT_TYPE}, dominant_cluster int,"
    " cluster_distribution map<int,double>, created_seq long, seq long"
)
ENTRY_FIELDS = ("key", "query_text", "embedding", "result", "dominant_cluster", "cluster_distribution", "created_seq", "seq")
#: ``change`` is put, touch or drop.
CHANGE_SCHEMA = f"{SNAPSHOT_SCHEMA}, change string, batch int"
#: After so many batches the whole cache is written, so that reading never merges more.
COMPACT_EVERY = 16
QUERY_SCHEMA = (
    "qid long, query string, embedding array<double>, dominant_cluster int, cluster_distribution map<int,double>"
)


def snapshot(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The entries after ``batch_id``; empty before the first batch."""
    return merged(_since(spark, path, batch_id))


def _since(spark: SparkSession, path: str, batch_id: int, whole: bool = True) -> DataFrame:
    """The log up to ``batch_id`` from the last whole on; with ``whole`` false, from the one before ``batch_id``."""
    whole = (batch_id + whole) // COMPACT_EVERY * COMPACT_EVERY - 1
    empty = spark.createDataFrame([], CHANGE_SCHEMA)
    log = empty if batch_id < 0 else spark.read.schema(CHANGE_SCHEMA).parquet(f"{path}/changes")
    log = log.where((F.col("batch") > whole) & (F.col("batch") <= batch_id))
    if whole >= 0:
        base = spark.read.schema(SNAPSHOT_SCHEMA).parquet(f"{path}/whole/batch={whole}")
        log = log.unionByName(base.select("*", F.lit("put").alias("change"), F.lit(whole).alias("batch")))
    return log


def merged(log: DataFrame) -> DataFrame:
    """Entries of ``log``: of each key what was put after it was last removed, with the latest recency."""
    removed = F.max(F.when(F.col("change") == "drop", F.col("batch"))).over(Window.partitionBy("key"))
    valid = log.withColumn("removed", removed).where(F.col("removed").isNull() | (F.col("batch") > F.col("removed")))
    put = F.col("change") == "put"
    fields = [f for f in ENTRY_FIELDS if f not in ("key", "seq")]
    entry = F.max_by(F.struct(*fields), F.when(put, F.col("batch")))
    rows = valid.groupBy("key").agg(entry.alias("e"), F.max("seq").alias("seq"), F.max(put).alias("stored")).where("stored")
    return rows.select(*[F.col("e")[f].alias(f) if f in fields else F.col(f) for f in ENTRY_FIELDS])


def lookup_log(spark: SparkSession, path: str) -> DataFrame:
    """The log of every batch so far: ``batch, qid, key, hit, matched_key, matched_query, score``."""
    return spark.read.parquet(f"{path}/log")


def cache_foreach_batch(
    path: str,
    docs: DataFrame,
    threshold: float = THRESHOLD,
    max_size: int = MAX_SIZE,
    depth: int = SEARCH_DEPTH,
    k: int = TOP_K,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that looks up, searches misses, stores and evicts.

    Batches have ``QUERY_SCHEMA`` columns with ``qid`` unique and growing over batches (it
    orders recency); ``docs`` is a document store.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cache = snapshot(spark, path, batch_id - 1)
        # The batch is fixed once: it feeds the lookup, the search and the store.
        batch.write.mode("overwrite").parquet(f"{path}/queries/batch={batch_id}")
        queries = spark.read.schema(batch.schema).parquet(f"{path}/queries/batch={batch_id}")
        log_path = f"{path}/log/batch={batch_id}"
        cache_lookup(queries, cache, threshold, depth).write.mode("overwrite").parquet(log_path)
        log = spark.read.parquet(log_path)

        misses = queries.join(log.where("not hit").select("qid"), "qid", "left_semi")
        found = search_topk(
            misses.select("qid", F.col("embedding").alias("qvec")),
            docs.select("doc_id", F.col("embedding").alias("dvec")),
            k,
        )
        results = pack_results(format_hits(found, docs))
        rows = misses.join(results, "qid", "left").withColumn("seq", F.col("qid"))
        # A miss has a key that no entry has, else it would have hit: misses are new entries only.
        none = spark.createDataFrame([], SNAPSHOT_SCHEMA)
        puts = materialize(cache_store(none, rows).select(*ENTRY_FIELDS), "puts")
        hits = log.where("hit").groupBy(F.col("matched_key").alias("key")).agg(F.max("qid").alias("seq"))
        changed = changes(cache.select("key", "seq"), puts, hits, max_size)
        changed.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
        if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            now = merged(_since(spark, path, batch_id, whole=False))
            now.write.mode("overwrite").parquet(f"{path}/whole/batch={batch_id}")

    return process


def changes(entries: DataFrame, puts: DataFrame, hits: DataFrame, max_size: int) -> DataFrame:
    """Rows of the log: new entries, renewed recency, and removals beyond the ``max_size`` last used.

    ``entries(key, seq)`` are those before, ``hits(key, seq)`` the latest use of entries. Only keys and
    recency are read of entries that do not change.
    """
    used = entries.unionByName(hits).unionByName(puts.select("key", "seq"))
    used = used.groupBy("key").agg(F.max("seq").alias("seq"))
    kept = used.select("seq").orderBy(F.col("seq").desc()).limit(max(0, max_size))
    least = kept.agg(F.coalesce(F.min("seq"), F.lit(2**63 - 1))).scalar()
    rest = [f for f in ENTRY_FIELDS if f not in ("key", "seq")]
    blank = lambda df, change: df.select(
        "key", *[F.lit(None).cast(puts.schema[f].dataType).alias(f) for f in rest], "seq", F.lit(change).alias("change")
    )
    gone = entries.join(used.select("key", F.col("seq").alias("last")), "key").where(F.col("last") < least)
    renewed = hits.join(entries.select("key"), "key", "left_semi").where(F.col("seq") >= least)
    stored = puts.where(F.col("seq") >= least).withColumn("change", F.lit("put"))
    order = [*ENTRY_FIELDS, "change"]
    return stored.select(*order).unionByName(blank(renewed, "touch").select(*order)).unionByName(blank(gone.select("key", "seq"), "drop").select(*order))
