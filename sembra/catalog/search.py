"""Vector arithmetic and nearest-neighbour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sembra.catalog.inputs import (
    LABELLED,
    QUERY_POSTERIORS,
    REVERSED,
    labelled,
    reversed_queries,
    table,
    vector_mixture,
    vectors,
    with_,
)
from sembra.catalog.registry import query
from sembra.functions.vectors import cosine, dot, l2_normalize
from sembra.operators import search as sr
from sembra.operators.mixture import predict_queries
from sembra.session import materialize


def _queries(spark, sf_dir):
    return reversed_queries(spark, sf_dir).withColumnRenamed("embedding", "qvec")


def _docs(spark, sf_dir):
    return labelled(spark, sf_dir).withColumnRenamed("embedding", "dvec")


def _rounded(hits):
    return hits.select("qid", "doc_id", F.round("similarity", 4).alias("similarity"), "rank")


def topk_sql(docs: str, where: str = "true", k: int = 5) -> str:
    return f"""
sims AS (
  SELECT q.qid, d.doc_id, list_dot_product(q.v, d.v) AS s FROM reversed q CROSS JOIN {docs} d WHERE {where}),
hits AS (
  SELECT qid, doc_id, round(s, 4) AS similarity,
         row_number() OVER (PARTITION BY qid ORDER BY round(s, 12) DESC, doc_id)::BIGINT AS rank
  FROM sims QUALIFY rank <= {k})
"""


HITS = "SELECT qid, doc_id, similarity, rank FROM hits"


@query(
    "dot",
    """SELECT a.vec_id AS doc_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def dot_query(spark, sf_dir):
    """Similarity of each vector to its successor."""
    a = vectors(spark, sf_dir)
    b = a.select((F.col("doc_id") - 1).alias("doc_id"), F.col("embedding").alias("other"))
    return a.join(b, "doc_id").select(
        "doc_id", F.round(dot(F.col("embedding"), F.col("other")), 4).alias("similarity")
    )


@query(
    "cosine",
    """SELECT a.vec_id AS doc_id, round(list_cosine_similarity(list_transform(a.embedding::DOUBLE[],
  lambda x: x + a.label), b.embedding::DOUBLE[]), 4) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def cosine_query(spark, sf_dir):
    """As ``dot``, after shifting one side by its label so that it is no unit vector."""
    a = vectors(spark, sf_dir)
    b = a.select((F.col("doc_id") - 1).alias("doc_id"), F.col("embedding").alias("other"))
    shifted = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.col("cluster"))
    return a.join(b, "doc_id").select("doc_id", F.round(cosine(shifted, F.col("other")), 4).alias("similarity"))


@query(
    "l2_normalize",
    """
WITH s AS (SELECT vec_id AS doc_id, list_transform(embedding::DOUBLE[], lambda x: x * label) AS v FROM embeddings),
n AS (SELECT doc_id, v, sqrt(list_dot_product(v, v)) AS n FROM s)
SELECT doc_id, (d - 1)::INT AS d, round(CASE WHEN n > 0 THEN x / n ELSE x END, 4) + 0.0 AS x
FROM (SELECT doc_id, n, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM n)""",
)
def l2_normalize_query(spark, sf_dir):
    """Vectors scaled by their label (label 0 gives zero vectors), normalised again."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * F.col("cluster"))
    unit = vectors(spark, sf_dir).select("doc_id", F.posexplode(l2_normalize(scaled)).alias("d", "x"))
    return unit.withColumn("x", F.round("x", 4) + F.lit(0.0))


@query("search_topk", with_(LABELLED, REVERSED, topk_sql("labelled"), select=HITS))
def search_topk(spark, sf_dir):
    return _rounded(sr.search_topk(_queries(spark, sf_dir), _docs(spark, sf_dir)))


@query("search_topk_blocked", with_(LABELLED, REVERSED, topk_sql("labelled", k=8), select=HITS))
def search_topk_blocked(spark, sf_dir):
    return _rounded(
        sr.search_topk_blocked(_queries(spark, sf_dir), _docs(spark, sf_dir), 8, tile_rows=300)
    )


@query(
    "search_where",
    with_(LABELLED, REVERSED, topk_sql("labelled", "d.category IN ('src1', 'src2', 'unknown')"), select=HITS),
)
def search_where(spark, sf_dir):
    condition = F.col("category").isin("src1", "src2", "unknown")
    return _rounded(sr.search_topk(_queries(spark, sf_dir), _docs(spark, sf_dir), where=condition))


@query(
    "format_hits",
    with_(
        LABELLED,
        REVERSED,
        topk_sql("labelled"),
        select="""
SELECT qid, rank, 'doc_' || doc_id AS id, l.text AS document, l.category, similarity,
       CASE WHEN q.quality IS NULL THEN -1 ELSE l.cluster END AS dominant_cluster,
       CASE WHEN q.quality = 1 THEN 0.75::DOUBLE END AS share
FROM hits JOIN labelled l USING (doc_id) LEFT JOIN labels q USING (doc_id)""",
    ),
)
def format_hits(spark, sf_dir):
    """Only labelled documents carry cluster metadata; some of it is broken JSON."""
    docs = _docs(spark, sf_dir)
    good = F.concat(F.lit('{"'), F.col("cluster").cast("string"), F.lit('": 0.75}'))
    metadata = table(spark, sf_dir, "labels").select("doc_id", "quality")
    store = (
        docs.join(metadata, "doc_id", "left")
        .select(
            "doc_id",
            F.col("text").alias("document"),
            F.when(F.col("category") != "unknown", F.col("category")).alias("category"),
            F.when(F.col("quality").isNotNull(), F.col("cluster")).alias("dominant_cluster"),
            F.when(F.col("quality") == 1, good).when(F.col("quality") == 0, "{broken").alias("cluster_distribution"),
        )
    )
    hits = sr.format_hits(sr.search_topk(_queries(spark, sf_dir), docs), store)
    return hits.select(
        "qid",
        "rank",
        "id",
        "document",
        "category",
        "similarity",
        "dominant_cluster",
        F.element_at(F.map_values("cluster_distribution"), 1).alias("share"),
    )


@query(
    "search_probed",
    with_(
        LABELLED,
        QUERY_POSTERIORS,
        """
sims AS (
  SELECT p.id AS qid, d.doc_id, list_dot_product(q.v, d.v) AS s
  FROM probes p JOIN query_rows q ON q.id = p.id JOIN labelled d ON d.cluster = p.cluster),
hits AS (
  SELECT qid, doc_id, round(s, 4) AS similarity,
         row_number() OVER (PARTITION BY qid ORDER BY round(s, 12) DESC, doc_id)::BIGINT AS rank
  FROM sims QUALIFY rank <= 5)""",
        select=HITS,
    ),
)
def search_probed(spark, sf_dir):
    queries = predict_queries(reversed_queries(spark, sf_dir), vector_mixture(spark, sf_dir), "embedding")
    docs = _docs(spark, sf_dir).withColumnRenamed("cluster", "dominant_cluster")
    return _rounded(sr.search_probed(queries.withColumnRenamed("embedding", "qvec"), docs))


def _clustered(spark, sf_dir):
    """Every vector drawn to one of fifty centres, the vectors with the lowest ids."""
    rows = vectors(spark, sf_dir).select("doc_id", F.col("embedding").cast("array<double>").alias("v"))
    centres = rows.where("doc_id < 50").select(F.col("doc_id").alias("centre"), F.col("v").alias("c"))
    near = rows.join(F.broadcast(centres), F.pmod("doc_id", F.lit(50)) == F.col("centre"))
    return near.select("doc_id", l2_normalize(F.zip_with("v", "c", lambda x, c: c + 0.5 * x)).alias("dvec"))


def _measured(queries, docs):
    """Recall and share of all pairs that met, as figures: no better than 0.9 and 0.3 are told apart."""
    queries, docs = materialize(queries.select("qid", "qvec"), "queries"), materialize(docs.select("doc_id", "dvec"), "docs")
    dealt = sr.hashed_search(queries, docs)
    exact = sr.search_topk(queries, docs).select("qid", "doc_id")
    found = exact.join(dealt.hits(sr.TOP_K).select("qid", "doc_id", F.lit(1).alias("met")), ["qid", "doc_id"], "left")
    recall = F.count("met") / F.count(F.lit(1))
    return found.agg(F.count(F.lit(1)).alias("pairs"), F.least(F.round(recall, 4), F.lit(0.9)).alias("recall")), dealt.candidate_share()


@query("search_lsh_recall", "SELECT count(*) * 5 AS pairs, 0.9::DOUBLE AS recall FROM embeddings")
def search_lsh_recall(spark, sf_dir):
    """The share of the exact hits that ``search_lsh`` finds on the vectors as they are, up to 0.9."""
    return _measured(_queries(spark, sf_dir), _docs(spark, sf_dir))[0]


@query("search_lsh_clustered", "SELECT count(*) * 5 AS pairs, 0.9::DOUBLE AS recall, 0.3::DOUBLE AS candidate_share FROM embeddings")
def search_lsh_clustered(spark, sf_dir):
    """Recall (up to 0.9) and share of candidates (from 0.3) where vectors lie in groups."""
    docs = _clustered(spark, sf_dir)
    found, share = _measured(docs.select(F.col("doc_id").alias("qid"), F.col("dvec").alias("qvec")), docs)
    return found.withColumn("candidate_share", F.greatest(F.lit(round(share, 4)), F.lit(0.3)))


@query("search_lsh")
def search_lsh(spark, sf_dir):
    return _rounded(sr.search_lsh(_queries(spark, sf_dir), _docs(spark, sf_dir)))
