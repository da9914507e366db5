"""Reduction, soft clustering and clustering-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sembra.catalog.inputs import (
    DIM,
    LABELLED,
    VECTOR_POSTERIORS,
    labelled,
    table,
    vector_mixture,
    vectors,
    with_,
)
from sembra.catalog.registry import query
from sembra.functions.membership import (
    doc_distribution,
    dominant_cluster,
    membership_entropy,
    query_distribution,
)
from sembra.operators import mixture as mx
from sembra.operators import quality as ql
from sembra.operators import reduction as rd
from sembra.session import scratch_path
from sembra.sources.artifacts import load_models, save_models

ENTROPY = """
entropies AS (SELECT id, -sum(p * ln(p + 1e-10)) AS entropy FROM post GROUP BY id),
dominants AS (
  SELECT id, c FROM post QUALIFY row_number() OVER (PARTITION BY id ORDER BY p DESC, c) = 1)
"""


def _assigned(spark, sf_dir):
    return mx.gmm_posteriors(vectors(spark, sf_dir), vector_mixture(spark, sf_dir), "embedding")


def _entries(df, column):
    return df.select("doc_id", F.explode_outer(column).alias("c", "p")).withColumn("p", F.round("p", 4))


# --- vectors whose axes or groups are known ------------------------------------------------


def _axes(spark, sf_dir):
    """Every number of every vector alone on its axis, with both signs, stretched by the axis: the
    mean is zero and the covariance diagonal."""
    cells = vectors(spark, sf_dir).select(F.posexplode("embedding").alias("d", "x"))
    cells = cells.select("d", F.explode(F.array(F.lit(1), F.lit(-1))).alias("sign"), (F.col("x").cast("double") * (F.col("d") + 1)).alias("x"))
    axis = F.transform(F.sequence(F.lit(0), F.lit(DIM - 1)), lambda i: F.when(i == F.col("d"), F.col("sign") * F.col("x")).otherwise(0.0))
    return cells.select(axis.alias("embedding"))


def _mirrored(spark, sf_dir):
    """Four mirror images of every vector: its first two numbers, stretched, are the principal axes."""
    sign = lambda bit: 1 - 2 * F.pmod(F.shiftright("image", bit), F.lit(2))
    images = labelled(spark, sf_dir).withColumn("image", F.explode(F.array(*[F.lit(i) for i in range(4)])))
    x = F.transform(
        "embedding",
        lambda v, i: v.cast("double")
        * F.when(i == 0, 100 * sign(0)).when(i == 1, 50 * sign(1)).otherwise(sign(0) * sign(1)),
    )
    return images.withColumns({"embedding": x, "doc_id": F.col("doc_id") * 4 + F.col("image")})


MIRRORED = """
images AS (
  SELECT vec_id * 4 + image AS doc_id, label::INT AS cluster, vec_id, embedding::DOUBLE[] AS v,
         100 * (1 - 2 * (image % 2)) * embedding[1]::DOUBLE AS x,
         50 * (1 - 2 * (image // 2)) * embedding[2]::DOUBLE AS y
  FROM embeddings, range(4) AS r(image)),
shares AS (
  SELECT sum(x * x + y * y) / sum(x * x + y * y + list_dot_product(v[3:], v[3:])) AS share, count(*) AS n FROM images)"""

FOLDED, GROUPS = 50, 10


def _grouped(spark, sf_dir):
    """Vectors as fifty numbers (the last fourteen added to the first), so that a reduction to the
    published size is a rotation; the ten groups of labels are moved far apart."""
    folded = [
        F.col("embedding")[j].cast("double")
        + (F.col("embedding")[j + FOLDED].cast("double") if j + FOLDED < DIM else 0.0)
        + F.when(F.col("cluster") == j, 10.0).otherwise(0.0)
        for j in range(FOLDED)
    ]
    return vectors(spark, sf_dir).select("doc_id", F.col("cluster").alias("category"), F.array(*folded).alias("embedding"))


GROUPED = """
cells AS (
  SELECT vec_id, label AS g, (generate_subscripts(embedding, 1) - 1) % 50 AS d, unnest(embedding)::DOUBLE AS x
  FROM embeddings),
folded AS (SELECT vec_id AS id, g, d, sum(x) + CASE WHEN g = d THEN 10 ELSE 0 END AS x FROM cells GROUP BY vec_id, g, d)"""

#: The silhouette by Euclidean distances of all pairs.
SILHOUETTE = """
whole AS (SELECT id, g, list(x ORDER BY d) AS v FROM {0} GROUP BY id, g),
sizes_of AS (SELECT g, count(*) AS n FROM whole GROUP BY g),
gaps AS (
  SELECT p.id, p.g, o.g AS other, any_value(s.n) AS n, sum(list_distance(p.v, o.v)) AS total
  FROM whole p, whole o JOIN sizes_of s ON s.g = o.g GROUP BY p.id, p.g, o.g),
near AS (
  SELECT id, max(CASE WHEN g = other THEN n END) AS own, max(CASE WHEN g = other THEN total / nullif(n - 1, 0) END) AS a,
         min(CASE WHEN g <> other THEN total / n END) AS b FROM gaps GROUP BY id),
scored AS (
  SELECT count(*) AS n, round(avg(CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 4) AS silhouette FROM near)"""

#: The silhouette by squared distances from sizes, sums and sums of squares of the groups.
SQUARED_SILHOUETTE = """
axes AS (SELECT g, d, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM {0} GROUP BY g, d),
gaps AS (
  SELECT p.id, p.g, a.g AS other, any_value(a.n) AS n, sum(a.n * p.x * p.x - 2 * p.x * a.s + a.q) AS total
  FROM {0} p JOIN axes a USING (d) GROUP BY p.id, p.g, a.g),
near AS (
  SELECT id, max(CASE WHEN g = other THEN n END) AS own, max(CASE WHEN g = other THEN total / nullif(n - 1, 0) END) AS a,
         min(CASE WHEN g <> other THEN total / n END) AS b FROM gaps GROUP BY id),
scored AS (
  SELECT count(*) AS n, round(avg(CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 4) AS silhouette FROM near)"""


@query(
    "fit_pca",
    """
WITH cells AS (SELECT generate_subscripts(embedding, 1) - 1 AS d, unnest(embedding)::DOUBLE AS x FROM embeddings),
axes AS (SELECT d, sum((x * (d + 1)) ** 2) AS s FROM cells GROUP BY d)
SELECT (row_number() OVER (ORDER BY s DESC) - 1)::INT AS component, round(s / sum(s) OVER (), 5) AS variance_ratio,
       d::INT AS dimension, 1.0::DOUBLE AS loading
FROM axes QUALIFY component < 50
""",
)
def fit_pca(spark, sf_dir):
    """The 50 components of vectors with a diagonal covariance: each is one axis."""
    model = rd.fit_pca(_axes(spark, sf_dir), 50)
    loadings = abs(model.stages[-1].pc.toArray()).T
    ratios = model.stages[-1].explainedVariance.toArray()
    rows = [
        (i, round(float(r), 5), int(column.argmax()), round(float(column.max()), 4))
        for i, (r, column) in enumerate(zip(ratios, loadings))
    ]
    return spark.createDataFrame(rows, "component int, variance_ratio double, dimension int, loading double")


@query(
    "pca_transform",
    """
WITH cells AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
means AS (SELECT d, avg(x) AS m FROM cells GROUP BY d)
SELECT vec_id AS doc_id, round(sum((x - m) * (x - m)), 4) AS squared_length FROM cells JOIN means USING (d) GROUP BY 1
""",
)
def pca_transform(spark, sf_dir):
    """With all components kept, the reduction is a rotation of the centred vectors."""
    rows = vectors(spark, sf_dir)
    reduced = rd.pca_transform(rows, rd.fit_pca(rows, 64))
    squares = F.aggregate("reduced", F.lit(0.0), lambda s, x: s + x * x)
    return reduced.select("doc_id", F.round(squares, 4).alias("squared_length"))


@query("variance_explained", with_(MIRRORED, select="SELECT round(share, 4) AS share, n FROM shares"))
def variance_explained(spark, sf_dir):
    """What two stretched axes explain."""
    rows = _mirrored(spark, sf_dir)
    share = rd.variance_explained(rd.fit_pca(rows, 2))
    return rows.agg(F.round(F.lit(share), 4).alias("share"), F.count(F.lit(1)).alias("n"))


@query(
    "project_2d",
    with_(
        MIRRORED,
        select="""
SELECT i.doc_id, round(x, 4) + 0.0 AS x, round(y, 4) + 0.0 AS y, cluster, coalesce(source, 'unknown') AS category,
       round(share, 4) AS variance_explained
FROM images i LEFT JOIN documents d ON d.doc_id = i.vec_id, shares""",
    ),
)
def project_2d(spark, sf_dir):
    """Mirrored vectors: the coordinates are the two stretched numbers."""
    coordinates, share = rd.project_2d(_mirrored(spark, sf_dir))
    return coordinates.select(
        "doc_id",
        *[(F.round(c, 4) + 0.0).alias(c) for c in "xy"],
        "cluster",
        "category",
        F.lit(round(share, 4)).alias("variance_explained"),
    )


@query(
    "fit_gmm",
    """
WITH cells AS (
  SELECT vec_id, (label >= 5)::INT AS g, generate_subscripts(embedding, 1) - 1 AS d,
         unnest(embedding)::DOUBLE + CASE WHEN label >= 5 AND generate_subscripts(embedding, 1) = 1 THEN 10 ELSE 0 END AS x
  FROM embeddings),
sizes AS (SELECT g, n / sum(n) OVER () AS share FROM (SELECT g, count(DISTINCT vec_id) AS n FROM cells GROUP BY g))
SELECT a.g, a.d::INT AS i, b.d::INT AS j, round(any_value(share), 4) AS weight,
       round(avg(a.x), 4) + 0.0 AS mean, round(covar_pop(a.x, b.x) + CASE WHEN a.d = b.d THEN 1e-6 ELSE 0 END, 4) + 0.0 AS covariance
FROM cells a JOIN cells b ON a.vec_id = b.vec_id JOIN sizes ON sizes.g = a.g GROUP BY a.g, a.d, b.d
""",
)
def fit_gmm(spark, sf_dir):
    """Whole vectors, two groups of labels moved far apart: the best fit has a closed form."""
    moved = F.transform(
        F.col("embedding").cast("array<double>"), lambda x, i: x + F.when((i == 0) & (F.col("cluster") >= 5), 10.0).otherwise(0.0)
    )
    fitted, _ = mx.fit_gmm(vectors(spark, sf_dir).withColumn("reduced", moved), k=2)
    rows = [
        (int(mean[0] > 5), i, j, round(float(w), 4), round(float(mean[i]), 4) + 0.0, round(float(spread[i, j]), 4) + 0.0)
        for w, mean, spread in zip(fitted.weights, fitted.means, fitted.spreads)
        for i in range(DIM)
        for j in range(DIM)
    ]
    return spark.createDataFrame(rows, "g int, i int, j int, weight double, mean double, covariance double")


@query(
    "fit_gmm_restarts",
    with_(
        GROUPED,
        "sizes AS (SELECT count(*) AS n FROM embeddings)",
        select="""
SELECT g::INT AS g, d::INT AS d, round(count(*) / any_value(n), 4) AS weight, round(avg(x), 4) + 0.0 AS mean
FROM folded, sizes GROUP BY g, d""",
    ),
)
def fit_gmm_restarts(spark, sf_dir):
    """Ten groups far apart, best of the published number of restarts."""
    fitted, _ = mx.fit_gmm(_grouped(spark, sf_dir), k=GROUPS, vector_col="embedding")
    rows = [
        (int(mean[:GROUPS].argmax()), d, round(float(weight), 4), round(float(x), 4) + 0.0)
        for weight, mean in zip(fitted.weights, fitted.means)
        for d, x in enumerate(mean)
    ]
    return spark.createDataFrame(rows, "g int, d int, weight double, mean double")


@query(
    "gmm_posteriors",
    with_(VECTOR_POSTERIORS, select="SELECT id AS doc_id, c, round(p, 4) + 0.0 AS p, round(ld, 4) AS log_density FROM post"),
)
def gmm_posteriors(spark, sf_dir):
    return (
        _assigned(spark, sf_dir)
        .select("doc_id", F.posexplode_outer("probs").alias("c", "p"), F.round("log_density", 4).alias("log_density"))
        .withColumn("p", F.round("p", 4))
    )


@query("dominant_cluster", with_(VECTOR_POSTERIORS, ENTROPY, select="SELECT id AS doc_id, c FROM dominants"))
def dominant_cluster_query(spark, sf_dir):
    return _assigned(spark, sf_dir).select("doc_id", dominant_cluster(F.col("probs")).alias("c"))


@query(
    "query_distribution",
    with_(VECTOR_POSTERIORS, select="SELECT id AS doc_id, c, round(p, 4) AS p FROM post WHERE p > 0.01"),
)
def query_distribution_query(spark, sf_dir):
    return _entries(_assigned(spark, sf_dir), query_distribution(F.col("probs")))


@query(
    "doc_distribution",
    with_(
        VECTOR_POSTERIORS,
        select="""SELECT id AS doc_id, c, round(p, 4) AS p FROM post
QUALIFY row_number() OVER (PARTITION BY id ORDER BY p DESC, c) <= 5""",
    ),
)
def doc_distribution_query(spark, sf_dir):
    return _entries(_assigned(spark, sf_dir), doc_distribution(F.col("probs")))


@query(
    "membership_entropy",
    with_(VECTOR_POSTERIORS, ENTROPY, select="SELECT id AS doc_id, round(entropy, 4) AS entropy FROM entropies"),
)
def membership_entropy_query(spark, sf_dir):
    return _assigned(spark, sf_dir).select(
        "doc_id", F.round(membership_entropy(F.col("probs")), 4).alias("entropy")
    )


@query(
    "predict_queries",
    with_(
        VECTOR_POSTERIORS,
        ENTROPY,
        select="""
SELECT id AS doc_id, dominants.c AS dominant_cluster, round(entropy, 4) AS entropy,
       (SELECT count(*) FROM post p WHERE p.id = entropies.id AND p.p > 0.01)::INT AS clusters
FROM entropies JOIN dominants USING (id)""",
    ),
)
def predict_queries(spark, sf_dir):
    predicted = mx.predict_queries(vectors(spark, sf_dir), vector_mixture(spark, sf_dir), "embedding")
    return predicted.select(
        "doc_id",
        "dominant_cluster",
        F.round("entropy", 4).alias("entropy"),
        F.size("cluster_distribution").alias("clusters"),
    )


@query(
    "assign_clusters",
    with_(
        VECTOR_POSTERIORS,
        ENTROPY,
        select="""
SELECT id AS doc_id, dominants.c AS dominant_cluster, round(entropy, 4) AS entropy,
       (SELECT round(max(p), 4) FROM post p WHERE p.id = entropies.id) AS strongest
FROM entropies JOIN dominants USING (id)""",
    ),
)
def assign_clusters(spark, sf_dir):
    assigned = mx.assign_clusters(vectors(spark, sf_dir), vector_mixture(spark, sf_dir), "embedding")
    return assigned.select(
        "doc_id",
        "dominant_cluster",
        F.round("entropy", 4).alias("entropy"),
        F.element_at("cluster_distribution", F.col("dominant_cluster")).alias("strongest"),
    )


@query(
    "information_criteria",
    with_(
        VECTOR_POSTERIORS,
        """
total AS (SELECT count(*) AS n, sum(ld) AS ll FROM (SELECT DISTINCT id, ld FROM post)),
size AS (SELECT count(DISTINCT cluster) AS k, max(d) AS dims FROM par)""",
        select="""
SELECT n AS n_samples, round(ll, 2) AS log_likelihood,
       round(-2 * ll + (k - 1 + 2 * k * dims) * ln(n), 2) AS bic,
       round(-2 * ll + 2 * (k - 1 + 2 * k * dims), 2) AS aic FROM total, size""",
    ),
)
def information_criteria(spark, sf_dir):
    criteria = mx.information_criteria(vectors(spark, sf_dir), vector_mixture(spark, sf_dir), "embedding")
    return criteria.select(
        "n_samples", *[F.round(c, 2).alias(c) for c in ("log_likelihood", "bic", "aic")]
    )


POINTS = """
pts AS (SELECT vec_id AS id, label AS g, generate_subscripts(embedding, 1) AS d, unnest(embedding)::DOUBLE AS x
        FROM embeddings)"""


@query(
    "silhouette",
    with_(POINTS, SILHOUETTE.format("pts"), select="SELECT n, n AS sampled, silhouette, 0.0::DOUBLE AS standard_error FROM scored"),
)
def silhouette(spark, sf_dir):
    """Euclidean, all rows."""
    scored = ql.silhouette(vectors(spark, sf_dir), per_cluster=1 << 20, vector_col="embedding")
    return scored.withColumn("silhouette", F.round("silhouette", 4))


@query("silhouette_squared", with_(POINTS, SQUARED_SILHOUETTE.format("pts"), select="SELECT * FROM scored"))
def silhouette_squared(spark, sf_dir):
    scored = ql.squared_silhouette(vectors(spark, sf_dir), vector_col="embedding")
    return scored.select("n", F.round("silhouette", 4).alias("silhouette"))


@query(
    "nmi",
    """
WITH t AS (SELECT lang AS l, quality AS c FROM documents JOIN labels USING (doc_id)),
cells AS (SELECT l, c, count(*)::DOUBLE AS n FROM t GROUP BY ALL),
tot AS (SELECT sum(n) AS n FROM cells),
lm AS (SELECT l, sum(n) AS n FROM cells GROUP BY l), cm AS (SELECT c, sum(n) AS n FROM cells GROUP BY c),
mi AS (SELECT sum(cells.n / tot.n * ln(tot.n * cells.n / (lm.n * cm.n))) AS v
       FROM cells JOIN lm USING (l) JOIN cm USING (c), tot),
hl AS (SELECT -sum(lm.n / tot.n * ln(lm.n / tot.n)) AS v FROM lm, tot),
hc AS (SELECT -sum(cm.n / tot.n * ln(cm.n / tot.n)) AS v FROM cm, tot)
SELECT tot.n::BIGINT AS n, round(mi.v / ((hl.v + hc.v) / 2), 4) AS nmi FROM tot, mi, hl, hc
""",
)
def nmi(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality").join(docs, "doc_id")
    return ql.nmi(rows, "lang", "quality").select("n", F.round("nmi", 4).alias("nmi"))


@query(
    "fit_report",
    with_(
        GROUPED,
        SILHOUETTE.format("folded"),
        select="""
SELECT n AS n_samples, 50 AS pca_components, 1.0::DOUBLE AS variance_explained, 10 AS n_clusters, true AS converged,
       silhouette AS silhouette_score, 1.0::DOUBLE AS nmi_vs_true_labels FROM scored""",
    ),
)
def fit_report(spark, sf_dir):
    """Ten groups far apart; components, restarts and iterations as published."""
    _, _, report = ql.fit_report(_grouped(spark, sf_dir), k=GROUPS, label_col="category")
    return report.select(
        "n_samples",
        "pca_components",
        F.round("variance_explained", 4).alias("variance_explained"),
        "n_clusters",
        "converged",
        F.round("silhouette_score", 4).alias("silhouette_score"),
        F.round("nmi_vs_true_labels", 4).alias("nmi_vs_true_labels"),
    )


@query(
    "evaluate_k",
    with_(
        GROUPED,
        SILHOUETTE.format("folded"),
        select="""
SELECT 'silhouette_score' AS metric, 10::BIGINT AS k, silhouette AS value FROM scored
UNION ALL SELECT 'nmi', 10, 1.0""",
    ),
)
def evaluate_k(spark, sf_dir):
    """The published sweep (K 5 to 35, three restarts) must find the number of groups, and its figures there."""
    sweep = ql.evaluate_k(_grouped(spark, sf_dir), label_col="category")
    best = ql.best_k(sweep).where("metric <> 'bic'")
    return best.withColumn("value", F.round("value", 4))


@query(
    "best_k",
    """
WITH s AS (
  SELECT user_id AS k, round(sum(value), 2) AS bic, round(avg(value), 3) AS sil, count(*)::DOUBLE AS nmi
  FROM events GROUP BY user_id)
SELECT 'bic' AS metric, k, v AS value FROM (SELECT k, bic AS v FROM s ORDER BY bic, k LIMIT 1)
UNION ALL SELECT 'silhouette_score', k, sil FROM (SELECT k, sil FROM s ORDER BY sil DESC, k LIMIT 1)
UNION ALL SELECT 'nmi', k, nmi FROM (SELECT k, nmi FROM s ORDER BY nmi DESC, k LIMIT 1)
""",
)
def best_k(spark, sf_dir):
    """Selection over a table with one candidate per user."""
    sweep = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("k"))
        .agg(
            F.round(F.sum("value"), 2).alias("bic"),
            F.round(F.avg("value"), 3).alias("silhouette_score"),
            F.count(F.lit(1)).cast("double").alias("nmi"),
        )
    )
    return ql.best_k(sweep)


@query(
    "boundary_documents",
    with_(
        LABELLED,
        VECTOR_POSTERIORS,
        ENTROPY,
        "top AS (SELECT id, entropy FROM entropies ORDER BY entropy DESC, id LIMIT 20)",
        """
ranked AS (
  SELECT id, c, p, row_number() OVER (PARTITION BY id ORDER BY p DESC, c) - 1 AS r FROM post
  WHERE id IN (SELECT id FROM top) QUALIFY r < 3)""",
        select="""
SELECT t.id AS doc_id, round(entropy, 4) AS entropy, r::INT AS r, c, round(p, 4) AS p, category,
       substr(text, 1, 200) AS text_preview
FROM top t JOIN ranked USING (id) JOIN labelled l ON l.doc_id = t.id""",
    ),
)
def boundary_documents(spark, sf_dir):
    report = mx.boundary_documents(_assigned(spark, sf_dir).select("doc_id", "probs"), labelled(spark, sf_dir))
    return report.select(
        "doc_id",
        F.round("entropy", 4).alias("entropy"),
        F.posexplode("top_clusters").alias("r", "e"),
        "category",
        "text_preview",
    ).select(
        "doc_id",
        "entropy",
        "r",
        F.col("e.cluster").alias("c"),
        F.round("e.probability", 4).alias("p"),
        "category",
        "text_preview",
    )


@query(
    "save_load_models",
    """
SELECT vec_id AS doc_id, min(vec_id) OVER (PARTITION BY label) AS first_of_cluster, 0.0::DOUBLE AS entropy
FROM embeddings
""",
)
def save_load_models(spark, sf_dir):
    """Assignments by reloaded models: ten groups far apart. Clusters are named by their least id."""
    rows = _grouped(spark, sf_dir)
    pca = rd.fit_pca(rows, FOLDED)
    fitted, _ = mx.fit_gmm(rd.pca_transform(rows, pca), k=GROUPS)
    path = scratch_path(spark, "models")
    save_models(pca, fitted, path)
    pca, fitted, _ = load_models(path)
    assigned = mx.assign_clusters(rd.pca_transform(rows, pca), fitted)
    first = assigned.groupBy("dominant_cluster").agg(F.min("doc_id").alias("first_of_cluster"))
    return assigned.join(F.broadcast(first), "dominant_cluster").select(
        "doc_id", "first_of_cluster", (F.abs(F.round("entropy", 4)) + 0.0).alias("entropy")
    )
