"""Cluster-by-category tables, entropy statistics and threshold curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from sembra.catalog.clusters import ENTROPY
from sembra.catalog.inputs import (
    LABELLED,
    QUERY_POSTERIORS,
    VECTOR_POSTERIORS,
    labelled,
    reversed_queries,
    vector_mixture,
    vectors,
    with_,
)
from sembra.catalog.registry import query
from sembra.functions.membership import membership_entropy
from sembra.operators import analysis as an
from sembra.operators.mixture import gmm_posteriors, predict_queries

K = 10

GRID = """
grid AS (SELECT c.c::INT AS cluster, g.category FROM range(10) c(c)
         CROSS JOIN (SELECT DISTINCT category FROM labelled) g),
cooc AS (
  SELECT g.cluster, g.category, count(l.doc_id) AS n FROM grid g
  LEFT JOIN labelled l ON l.cluster = g.cluster AND l.category = g.category GROUP BY 1, 2)
"""


@query("cooccurrence", with_(LABELLED, GRID, select="SELECT cluster, category, n FROM cooc"))
def cooccurrence(spark, sf_dir):
    return an.cooccurrence(labelled(spark, sf_dir), K)


@query(
    "cooccurrence_normalized",
    with_(
        LABELLED,
        GRID,
        select="""SELECT cluster, category, round(n / sum(n) OVER (PARTITION BY category), 4) AS share FROM cooc""",
    ),
)
def cooccurrence_normalized(spark, sf_dir):
    shares = an.cooccurrence_normalized(labelled(spark, sf_dir), K)
    return shares.withColumn("share", F.round("share", 4))


@query(
    "cluster_summary",
    with_(
        LABELLED,
        """
counts AS (SELECT cluster, category, count(*) AS n FROM labelled GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, category) AS r,
         sum(n) OVER (PARTITION BY cluster)::BIGINT AS size FROM counts QUALIFY r <= 3)""",
        select="""SELECT cluster, size, string_agg(category || '(' || n || ')', ', ' ORDER BY r) AS top_categories
FROM ranked GROUP BY cluster, size""",
    ),
)
def cluster_summary(spark, sf_dir):
    return an.cluster_summary(labelled(spark, sf_dir))


def _entropies(spark, sf_dir):
    rows = labelled(spark, sf_dir).drop("text")
    assigned = gmm_posteriors(rows, vector_mixture(spark, sf_dir), "embedding")
    # Rounded so that both engines bin equal numbers.
    return assigned.select(
        "doc_id", "category", F.round(membership_entropy(F.col("probs")), 6).alias("entropy")
    )


ROUNDED = """
ent AS (SELECT id AS doc_id, category, round(entropy, 6) AS entropy FROM entropies JOIN labelled ON doc_id = id)
"""


@query(
    "entropy_histogram",
    with_(
        LABELLED,
        VECTOR_POSTERIORS,
        ENTROPY,
        ROUNDED,
        """
lim AS (SELECT min(entropy) AS low, (max(entropy) - min(entropy)) / 50 AS w FROM ent),
placed AS (SELECT least(floor((entropy - low) / w), 49)::INT AS bin FROM ent, lim)""",
        select="""
SELECT b.b::INT AS bin, round(low + b.b * w, 4) AS bin_start, (SELECT count(*) FROM placed p WHERE p.bin = b.b) AS n
FROM range(50) b(b), lim""",
    ),
)
def entropy_histogram(spark, sf_dir):
    bins = an.entropy_histogram(_entropies(spark, sf_dir))
    return bins.withColumn("bin_start", F.round("bin_start", 4))


@query(
    "entropy_percentile",
    with_(
        LABELLED, VECTOR_POSTERIORS, ENTROPY, ROUNDED,
        select="SELECT 0.95::DOUBLE AS prob, round(quantile_cont(entropy, 0.95), 4) AS value FROM ent",
    ),
)
def entropy_percentile(spark, sf_dir):
    return an.entropy_percentile(_entropies(spark, sf_dir)).select("prob", F.round("value", 4).alias("value"))


@query(
    "entropy_by_category",
    with_(
        LABELLED, VECTOR_POSTERIORS, ENTROPY, ROUNDED,
        select="""
SELECT category, round(min(entropy), 4) AS minimum, round(quantile_cont(entropy, 0.25), 4) AS q1,
       round(quantile_cont(entropy, 0.5), 4) AS median, round(quantile_cont(entropy, 0.75), 4) AS q3,
       round(max(entropy), 4) AS maximum,
       row_number() OVER (ORDER BY round(quantile_cont(entropy, 0.5), 9), category) AS median_order
FROM ent GROUP BY category""",
    ),
)
def entropy_by_category(spark, sf_dir):
    boxes = an.entropy_by_category(_entropies(spark, sf_dir))
    return boxes.select(
        "category", *[F.round(c, 4).alias(c) for c in ("minimum", "q1", "median", "q3", "maximum")], "median_order"
    )


N_PAIRS = 2_000


def _digest(what: str) -> str:
    return f"('0x' || substr(md5('42:{what}:' || draw), 1, 12))::BIGINT"


PAIRS = f"""
sizes AS (SELECT category, count(*) AS size FROM labelled GROUP BY category),
ordered AS (SELECT category, size, row_number() OVER (ORDER BY md5(category)) - 1 AS no FROM sizes),
inside AS (SELECT doc_id, category, row_number() OVER (PARTITION BY category ORDER BY md5(doc_id::VARCHAR)) - 1 AS pos
           FROM labelled),
overall AS (SELECT doc_id, category, row_number() OVER (ORDER BY md5(doc_id::VARCHAR)) - 1 AS pos FROM labelled),
draws AS (SELECT range AS draw FROM range({N_PAIRS})),
tot AS (SELECT count(*) AS n, (SELECT count(*) FROM sizes) AS cats FROM labelled),
same_at AS (
  SELECT draw, category, size, {_digest('first')} % size AS pa, {_digest('second')} % (size - 1) AS step
  FROM draws, tot JOIN ordered ON true WHERE no = {_digest('category')} % cats AND size >= 2),
cross_at AS (SELECT draw, n, {_digest('left')} % n AS pa, {_digest('right')} % (n - 1) AS step FROM draws, tot),
pairs AS (
  SELECT draw, a.doc_id AS a, b.doc_id AS b, true AS same FROM same_at s
  JOIN inside a ON a.category = s.category AND a.pos = pa
  JOIN inside b ON b.category = s.category AND b.pos = (pa + 1 + step) % size
  UNION ALL
  SELECT draw, a.doc_id, b.doc_id, false FROM cross_at
  JOIN overall a ON a.pos = pa JOIN overall b ON b.pos = (pa + 1 + step) % n WHERE a.category <> b.category),
scored AS (
  SELECT p.*, round(list_dot_product(x.v, y.v), 9) AS similarity
  FROM pairs p JOIN labelled x ON x.doc_id = a JOIN labelled y ON y.doc_id = b)
"""


def _pairs(spark, sf_dir):
    return an.sample_pairs(labelled(spark, sf_dir), N_PAIRS)


def _scored(spark, sf_dir):
    scored = an.pair_similarity(_pairs(spark, sf_dir), vectors(spark, sf_dir))
    return scored.withColumn("similarity", F.round("similarity", 9))


@query("sample_pairs", with_(LABELLED, PAIRS, select="SELECT draw, a, b, same FROM pairs"))
def sample_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query(
    "pair_similarity",
    with_(LABELLED, PAIRS, select="SELECT draw, a, b, same, round(similarity, 4) + 0.0 AS similarity FROM scored"),
)
def pair_similarity(spark, sf_dir):
    return _scored(spark, sf_dir).withColumn("similarity", F.round("similarity", 4) + F.lit(0.0))


@query(
    "pair_means",
    with_(
        LABELLED, PAIRS,
        select="SELECT same, count(*) AS pairs, round(avg(similarity), 4) AS mean_similarity FROM scored GROUP BY same",
    ),
)
def pair_means(spark, sf_dir):
    means = an.pair_means(_scored(spark, sf_dir))
    return means.withColumn("mean_similarity", F.round("mean_similarity", 4))


SWEEP = """
taus AS (SELECT range / 100.0::DOUBLE AS tau FROM range(5, 51)),
tested AS (
  SELECT tau, count(*) FILTER (same AND similarity >= tau) AS tp,
         count(*) FILTER (NOT same AND similarity >= tau) AS fp, count(*) FILTER (same AND similarity < tau) AS fn
  FROM taus, scored GROUP BY tau),
pr AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM tested),
sweep AS (
  SELECT tau, tp, fp, fn, round(precision, 4) AS precision, round(recall, 4) AS recall,
         round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 4) AS f1
  FROM pr)
"""


def _sweep(spark, sf_dir):
    sweep = an.threshold_sweep(_scored(spark, sf_dir), 5, 50)
    return sweep.select(
        "tau", "tp", "fp", "fn", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")]
    )


@query("threshold_sweep", with_(LABELLED, PAIRS, SWEEP, select="SELECT * FROM sweep"))
def threshold_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir)


@query(
    "best_threshold",
    with_(LABELLED, PAIRS, SWEEP, select="SELECT * FROM sweep ORDER BY f1 DESC, tau LIMIT 1"),
)
def best_threshold(spark, sf_dir):
    return an.best_threshold(_sweep(spark, sf_dir))


@query(
    "similarity_density",
    with_(
        LABELLED,
        PAIRS,
        """
lim AS (SELECT same, min(similarity) AS low, (max(similarity) - min(similarity)) / 50 AS w, count(*) AS total
        FROM scored GROUP BY same),
placed AS (SELECT same, least(floor((similarity - low) / w), 49)::INT AS bin FROM scored JOIN lim USING (same))""",
        select="""
SELECT l.same, b.b::INT AS bin, round(low + b.b * w, 4) AS bin_start,
       round((SELECT count(*) FROM placed p WHERE p.bin = b.b AND p.same = l.same) / (total * w), 4) AS density
FROM range(50) b(b), lim l""",
    ),
)
def similarity_density(spark, sf_dir):
    bins = an.similarity_density(_scored(spark, sf_dir))
    return bins.withColumns({c: F.round(c, 4) for c in ("bin_start", "density")})


@query(
    "paraphrase_report",
    with_(
        QUERY_POSTERIORS,
        select="""
SELECT a.id AS pair_id, a.id AS q1, b.id AS q2, round(list_dot_product(a.v, b.v), 4) AS similarity,
       c.dominant AS cluster1, d.dominant AS cluster2, c.dominant = d.dominant AS same_cluster,
       list_dot_product(a.v, b.v) >= 0.05 AS hit_at_005, list_dot_product(a.v, b.v) >= 0.10 AS hit_at_010,
       list_dot_product(a.v, b.v) >= 0.25 AS hit_at_025
FROM query_rows a JOIN query_rows b ON b.id = a.id + 1
JOIN probes_dominant c ON c.id = a.id JOIN probes_dominant d ON d.id = b.id""",
    ),
)
def paraphrase_report(spark, sf_dir):
    """Each query paired with its successor."""
    queries = predict_queries(reversed_queries(spark, sf_dir), vector_mixture(spark, sf_dir), "embedding")
    pairs = vectors(spark, sf_dir).select(
        F.col("doc_id").alias("pair_id"), F.col("doc_id").alias("q1"), (F.col("doc_id") + 1).alias("q2")
    )
    report = an.paraphrase_report(pairs, queries, (0.05, 0.10, 0.25))
    return report.withColumn("similarity", F.round("similarity", 4))


@query(
    "recommend_threshold",
    with_(
        LABELLED, PAIRS,
        select="""SELECT round(avg(similarity), 4) AS mean_similarity, round(min(similarity), 4) AS min_similarity,
       round(max(similarity), 4) AS max_similarity, round(min(similarity) - 0.02, 4) AS recommended FROM scored""",
    ),
)
def recommend_threshold(spark, sf_dir):
    figures = an.recommend_threshold(_scored(spark, sf_dir))
    return figures.select(*[F.round(c, 4).alias(c) for c in figures.columns])
