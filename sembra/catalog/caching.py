"""Semantic-cache queries on snapshots and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sembra.catalog.inputs import (
    BENCHMARK_SRC,
    CONVERSATION_SRC,
    QUERY_POSTERIORS,
    TEXT_STORE,
    benchmark_queries,
    conversation_queries,
    documents,
    embedding_sql,
    posteriors_sql,
    probes_sql,
    reversed_queries,
    table,
    text_encoder,
    text_mixture,
    text_store,
    vector_mixture,
    vectors,
    with_,
)
from sembra.catalog.registry import query
from sembra.functions.membership import probe_clusters
from sembra.functions.text import cache_key
from sembra.operators import cache as ch
from sembra.operators.mixture import predict_queries
from sembra.plans.answers import understand_queries
from sembra.session import materialize
from sembra.streaming.replay import semantic_cache_replay
from sembra.streaming.windows import hit_rate_windows

VECTOR_THRESHOLD = 0.25
TEXT_THRESHOLD = 0.60

KEY = r"sha256(lower(regexp_replace({0}, '^\s+|\s+$', '', 'g')))"


def lookup_sql(queries: str, entries: str, probes: str, name: str, threshold: float) -> str:
    """``{name}(id, key, hit, matched_key, matched_query, score)`` for ``queries(id, text, v)`` against
    ``entries(key, query_text, v, cluster, created)``."""
    return f"""
{name}_keyed AS (SELECT q.*, {KEY.format('text')} AS key FROM {queries} q),
{name}_exact AS (SELECT k.*, e.query_text AS exact_query FROM {name}_keyed k LEFT JOIN {entries} e ON e.key = k.key),
{name}_near AS (
  SELECT x.id, e.key AS near_key, e.query_text AS near_query, list_dot_product(x.v, e.v) AS s
  FROM {name}_exact x JOIN {probes} p ON p.id = x.id JOIN {entries} e ON e.cluster = p.cluster
  WHERE x.exact_query IS NULL
  QUALIFY row_number() OVER (PARTITION BY x.id ORDER BY round(s, 12) DESC, p.probe, e.created) = 1),
{name} AS (
  SELECT x.id, x.key, x.exact_query IS NOT NULL OR n.id IS NOT NULL AS hit,
         CASE WHEN x.exact_query IS NOT NULL THEN x.key ELSE near_key END AS matched_key,
         coalesce(x.exact_query, near_query) AS matched_query,
         CASE WHEN x.exact_query IS NOT NULL THEN 1.0::DOUBLE ELSE s END AS score
  FROM {name}_exact x LEFT JOIN (SELECT * FROM {name}_near WHERE s >= {threshold}) n ON n.id = x.id)
"""


# --- keys and probes -----------------------------------------------------------------------


@query("cache_key", f"SELECT doc_id, {KEY.format('text')} AS key FROM documents")
def cache_key_query(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", cache_key(F.col("text")).alias("key"))


def _vector_queries(spark, sf_dir):
    return predict_queries(reversed_queries(spark, sf_dir), vector_mixture(spark, sf_dir), "embedding")


@query("probe_clusters", with_(QUERY_POSTERIORS, select="SELECT id AS qid, probe::INT AS probe, cluster FROM probes"))
def probe_clusters_query(spark, sf_dir):
    probes = probe_clusters(F.col("cluster_distribution"), F.col("dominant_cluster"), 2)
    return _vector_queries(spark, sf_dir).select("qid", F.posexplode_outer(probes).alias("probe", "cluster"))


# --- lookups on vectors --------------------------------------------------------------------

ENTRIES = f"""
ranked AS (
  SELECT doc_id, text, {KEY.format('text')} AS key, embedding::DOUBLE[] AS v, label::INT AS cluster
  FROM documents JOIN embeddings ON vec_id = doc_id),
entries AS (
  SELECT key, arg_min(text, doc_id) AS query_text, arg_min(v, doc_id) AS v, arg_min(cluster, doc_id) AS cluster,
         min(doc_id) AS created, max(doc_id) AS seq, arg_max(substr(text, 1, 500), doc_id) AS result
  FROM ranked GROUP BY key)
"""

EMPTY = (
    "key string, query_text string, embedding array<float>, result string, dominant_cluster int,"
    " cluster_distribution map<int,double>, created_seq long, seq long"
)


def _entries(spark, sf_dir):
    """A snapshot made of every document that has a vector, stored in id order; written once."""
    rows = (
        vectors(spark, sf_dir)
        .join(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("query")), "doc_id")
        .select(
            "query",
            "embedding",
            F.substring("query", 1, 500).alias("result"),
            F.col("cluster").alias("dominant_cluster"),
            F.lit(None).cast("map<int,double>").alias("cluster_distribution"),
            F.col("doc_id").alias("seq"),
        )
    )
    return materialize(ch.cache_store(spark.createDataFrame([], EMPTY), rows), "entries")


DOCUMENT_LOG = f"""
looked AS (
  SELECT d.doc_id AS qid, {KEY.format('d.text')} AS key, e.query_text AS matched_query
  FROM documents d LEFT JOIN entries e ON e.key = {KEY.format('d.text')})
"""


def _document_queries(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("qid"), F.col("text").alias("query"))


@query("exact_lookup", with_(ENTRIES, DOCUMENT_LOG, select="SELECT qid, key, matched_query FROM looked"))
def exact_lookup(spark, sf_dir):
    """Every document text looked up among those that have a vector."""
    return ch.exact_lookup(_document_queries(spark, sf_dir), _entries(spark, sf_dir)).select(
        "qid", "key", "matched_query"
    )


@query(
    "semantic_lookup",
    with_(
        QUERY_POSTERIORS,
        ENTRIES,
        f"""
near AS (
  SELECT q.id AS qid, e.key AS matched_key, list_dot_product(q.v, e.v) AS s
  FROM query_rows q JOIN probes p ON p.id = q.id JOIN entries e ON e.cluster = p.cluster
  QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY round(s, 12) DESC, p.probe, e.created) = 1)""",
        select=f"SELECT qid, matched_key, round(s, 4) AS score FROM near WHERE s >= {VECTOR_THRESHOLD}",
    ),
)
def semantic_lookup(spark, sf_dir):
    hits = ch.semantic_lookup(_vector_queries(spark, sf_dir), _entries(spark, sf_dir), VECTOR_THRESHOLD)
    return hits.withColumn("score", F.round("score", 4))


@query(
    "cache_store",
    with_(
        f"""
first AS (
  SELECT {KEY.format('text')} AS key, min(item_id) AS created, arg_min(text, item_id) AS query_text,
         arg_max('b' || item_id, item_id) AS result, max(item_id) AS seq FROM benchmark GROUP BY 1),
batch AS (
  SELECT text, 1000 + doc_id AS seq, 'd' || doc_id AS result, 1 AS cluster FROM documents
  UNION ALL SELECT text, 10000000 + item_id, 'again' || item_id, 2 FROM benchmark),
fresh AS (
  SELECT {KEY.format('text')} AS key, arg_min(text, seq) AS query_text, arg_min(cluster, seq) AS cluster,
         min(seq) AS created, max(seq) AS seq, arg_max(result, seq) AS result FROM batch GROUP BY 1)""",
        select="""
SELECT key, coalesce(f.query_text, n.query_text) AS query_text, coalesce(n.result, f.result) AS result,
       CASE WHEN f.key IS NOT NULL THEN 0 ELSE n.cluster END::INT AS dominant_cluster,
       coalesce(f.created, n.created)::BIGINT AS created_seq, coalesce(n.seq, f.seq)::BIGINT AS seq
FROM first f FULL JOIN fresh n USING (key)""",
    ),
)
def cache_store(spark, sf_dir):
    """Benchmark texts, then all documents and the benchmark texts again."""

    def rows(df, id_col, offset, prefix, cluster):
        return df.select(
            F.col("text").alias("query"),
            F.lit(None).cast("array<float>").alias("embedding"),
            F.concat(F.lit(prefix), F.col(id_col).cast("string")).alias("result"),
            F.lit(cluster).alias("dominant_cluster"),
            F.lit(None).cast("map<int,double>").alias("cluster_distribution"),
            (F.col(id_col) + offset).alias("seq"),
        )

    bench, docs = table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents")
    first = ch.cache_store(spark.createDataFrame([], EMPTY), rows(bench, "item_id", 0, "b", 0))
    batch = rows(docs, "doc_id", 1_000, "d", 1).unionByName(rows(bench, "item_id", 10_000_000, "again", 2))
    return ch.cache_store(first, batch).select(
        "key", "query_text", "result", "dominant_cluster", "created_seq", "seq"
    )


@query("evict_lru", with_(ENTRIES, select="SELECT key, seq FROM entries ORDER BY seq DESC LIMIT 100"))
def evict_lru(spark, sf_dir):
    return ch.evict_lru(_entries(spark, sf_dir), 100).select("key", "seq")


@query(
    "touch",
    with_(
        ENTRIES,
        DOCUMENT_LOG,
        "used AS (SELECT key, max(qid + 1000000) AS used FROM looked WHERE matched_query IS NOT NULL GROUP BY key)",
        select="SELECT key, greatest(seq, coalesce(used, seq)) AS seq FROM entries LEFT JOIN used USING (key)",
    ),
)
def touch(spark, sf_dir):
    entries = _entries(spark, sf_dir)
    found = ch.exact_lookup(_document_queries(spark, sf_dir), entries).where(F.col("matched_query").isNotNull())
    hits = found.select(F.col("key").alias("matched_key"), (F.col("qid") + 1_000_000).alias("seq"))
    return ch.touch(entries, hits).select("key", "seq")


@query(
    "cache_stats",
    with_(
        ENTRIES,
        DOCUMENT_LOG,
        select="""
SELECT (SELECT count(*) FROM entries) AS total_entries, count(matched_query) AS hit_count,
       count(*) - count(matched_query) AS miss_count, round(count(matched_query) / count(*), 4) AS hit_rate FROM looked""",
    ),
)
def cache_stats(spark, sf_dir):
    entries = _entries(spark, sf_dir)
    log = ch.exact_lookup(_document_queries(spark, sf_dir), entries).withColumn(
        "hit", F.col("matched_query").isNotNull()
    )
    return ch.cache_stats(log, entries)


@query(
    "cache_cluster_counts",
    with_(ENTRIES, select="SELECT cluster AS dominant_cluster, count(*) AS entries FROM entries GROUP BY cluster"),
)
def cache_cluster_counts(spark, sf_dir):
    return ch.cache_cluster_counts(_entries(spark, sf_dir))


@query(
    "cache_clear",
    with_(ENTRIES, select="SELECT count(*) AS removed, 0::BIGINT AS entries_left FROM entries"),
)
def cache_clear(spark, sf_dir):
    empty, removed = ch.cache_clear(_entries(spark, sf_dir))
    return empty.agg(F.lit(removed).cast("long").alias("removed"), F.count(F.lit(1)).alias("entries_left"))


# --- lookups on texts ----------------------------------------------------------------------

BENCHMARK_ENTRIES = ",\n".join(
    [
        BENCHMARK_SRC,
        embedding_sql("bench_src", "bench_vec"),
        posteriors_sql("bench_vec", "bench_post"),
        probes_sql("bench_post", "bench_probes"),
        f"""
bench_rows AS (
  SELECT id, text, v, dominant AS cluster, {KEY.format('text')} AS key
  FROM bench_src JOIN bench_vec USING (id) JOIN bench_probes_dominant USING (id)),
bench_entries AS (
  SELECT key, arg_min(text, id) AS query_text, arg_min(v, id) AS v, arg_min(cluster, id) AS cluster,
         min(id) AS created FROM bench_rows GROUP BY key)""",
    ]
)

CONVERSATIONS = ",\n".join(
    [
        CONVERSATION_SRC,
        embedding_sql("conv_src", "conv_vec"),
        posteriors_sql("conv_vec", "conv_post"),
        probes_sql("conv_post", "conv_probes"),
        "conv_rows AS (SELECT id, text, v FROM conv_src JOIN conv_vec USING (id))",
    ]
)


@query(
    "cache_lookup",
    with_(
        TEXT_STORE,
        BENCHMARK_ENTRIES,
        CONVERSATIONS,
        f"""
asked AS (SELECT id, text, v FROM conv_rows UNION ALL SELECT id + 5000000000, text, v FROM bench_rows),
asked_probes AS (SELECT id, probe, cluster FROM conv_probes
                 UNION ALL SELECT id + 5000000000, probe, cluster FROM bench_probes)""",
        lookup_sql("asked", "bench_entries", "asked_probes", "looked", TEXT_THRESHOLD),
        select="SELECT id AS qid, key, hit, matched_key, matched_query, round(score, 4) AS score FROM looked",
    ),
)
def cache_lookup(spark, sf_dir):
    """Conversations and benchmark texts asked of a cache that holds the benchmark texts."""
    mixture = text_mixture(text_store(spark, sf_dir))
    known = understand_queries(benchmark_queries(spark, sf_dir), mixture, encoder=text_encoder)
    rows = known.withColumns({"result": F.lit("r"), "seq": F.col("qid")})
    cache = materialize(ch.cache_store(spark.createDataFrame([], EMPTY), rows), "cache")
    asked = conversation_queries(spark, sf_dir).unionByName(benchmark_queries(spark, sf_dir, 5_000_000_000))
    log = ch.cache_lookup(
        understand_queries(asked, mixture, encoder=text_encoder), cache, TEXT_THRESHOLD
    )
    return log.withColumn("score", F.round("score", 4))


# --- replays -------------------------------------------------------------------------------

CAPACITY = 40

REPLAY = f"""
access AS (
  SELECT event_type AS tenant, event_id AS seq, user_id::VARCHAR AS key, ts,
         lag(event_id) OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS prev FROM events),
replayed AS (
  SELECT a.tenant, a.seq, a.key, a.ts,
         a.prev IS NOT NULL AND (SELECT count(DISTINCT b.key) FROM access b
           WHERE b.tenant = a.tenant AND b.seq > a.prev AND b.seq < a.seq) < {CAPACITY} AS hit
  FROM access a)
"""


def _access_log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("tenant"),
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("key"),
        "ts",
    )


@query("exact_cache_replay", with_(REPLAY, select="SELECT tenant, seq, key, hit FROM replayed"))
def exact_cache_replay(spark, sf_dir):
    return ch.exact_cache_replay(_access_log(spark, sf_dir), CAPACITY, block_rows=2_000)


@query(
    "hit_rate_windows",
    with_(
        REPLAY,
        select="""
SELECT strftime(time_bucket(INTERVAL '1 day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (hit) AS hit_count,
       count(*) FILTER (NOT hit) AS miss_count, round(count(*) FILTER (hit) / count(*), 4) AS hit_rate
FROM replayed GROUP BY 1""",
    ),
)
def hit_rate_windows_query(spark, sf_dir):
    log = _access_log(spark, sf_dir)
    replayed = ch.exact_cache_replay(log, CAPACITY, block_rows=5_000)
    timed = replayed.join(log.select("tenant", "seq", "ts"), ["tenant", "seq"])
    windows = hit_rate_windows(timed, "1 day")
    return windows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def tenant_log(spark, sf_dir):
    """Every document as a query of the tenant that is its language, with hashed vectors."""
    store = text_store(spark, sf_dir)
    queries = documents(spark, sf_dir).select(
        F.col("lang").alias("tenant"), F.col("doc_id").alias("qid"), F.col("text").alias("query")
    )
    known = understand_queries(queries, text_mixture(store), encoder=text_encoder)
    return known.withColumnRenamed("qid", "seq")


@query("semantic_cache_replay")
def semantic_cache_replay_query(spark, sf_dir):
    replayed = semantic_cache_replay(tenant_log(spark, sf_dir), threshold=0.9, max_size=200, block_rows=5_000)
    return replayed.withColumn("score", F.round("score", 4))


@query(
    "semantic_cache_replay_exact",
    f"""
WITH access AS (
  SELECT lang AS tenant, doc_id AS seq, {KEY.format('text')} AS key FROM documents),
marked AS (SELECT *, lag(seq) OVER (PARTITION BY tenant, key ORDER BY seq) AS prev FROM access)
SELECT a.tenant, a.seq, a.prev IS NOT NULL AND count(DISTINCT b.key) < 100 AS hit
FROM marked a LEFT JOIN marked b ON a.prev IS NOT NULL AND b.tenant = a.tenant AND b.seq > a.prev AND b.seq < a.seq
GROUP BY a.tenant, a.seq, a.prev
""",
)
def semantic_cache_replay_exact(spark, sf_dir):
    """With a threshold no vector can reach, the replay is a plain LRU cache of keys."""
    replayed = semantic_cache_replay(tenant_log(spark, sf_dir), threshold=2.0, max_size=100, block_rows=300)
    return replayed.select("tenant", "seq", "hit")
