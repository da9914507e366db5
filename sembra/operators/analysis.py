"""Cluster tables, entropy statistics and threshold curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sembra.functions.text import short_category
from sembra.functions.vectors import dot
from sembra.operators.ranking import at_positions, exact_percentiles
from sembra.session import lookup_join, materialize

# Fixed values of the published system.
SWEEP_LOW, SWEEP_HIGH = 50, 98
PAIR_COUNT = 500
BINS = 50
THRESHOLD_MARGIN = 0.02
CHECKED_THRESHOLDS = (0.60, 0.65, 0.70)


def cooccurrence(df: DataFrame, k: int) -> DataFrame:
    """Documents per (cluster, category), zero cells included."""
    counts = df.groupBy(F.col("cluster").cast("int").alias("cluster"), "category").agg(
        F.count(F.lit(1)).alias("n")
    )
    grid = counts.select("category").distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cluster"), "category"
    )
    return grid.join(counts, ["cluster", "category"], "left").select(
        "cluster", "category", F.coalesce("n", F.lit(0)).alias("n")
    )


def cooccurrence_normalized(df: DataFrame, k: int) -> DataFrame:
    """Share of each category that falls into each cluster."""
    total = F.sum("n").over(Window.partitionBy("category"))
    return cooccurrence(df, k).select(
        "cluster", "category", (F.col("n") / F.when(total == 0, 1).otherwise(total)).alias("share")
    )


def cluster_summary(df: DataFrame, top: int = 3) -> DataFrame:
    """Size and most frequent categories (short names) of every non-empty cluster."""
    counts = df.groupBy("cluster", "category").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("cluster").orderBy(F.col("n").desc(), "category")
    ranked = counts.withColumns(
        {"rank": F.row_number().over(order), "size": F.sum("n").over(Window.partitionBy("cluster"))}
    ).where(F.col("rank") <= top)
    named = F.concat(short_category(F.col("category")), F.lit("("), F.col("n").cast("string"), F.lit(")"))
    return ranked.groupBy("cluster", "size").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", named.alias("s")))), lambda e: e["s"]), ", "
        ).alias("top_categories")
    )


def _binned(df: DataFrame, value: str, group: list[str], bins: int) -> DataFrame:
    """Counts per equal-width bin between minimum and maximum, the last bin closed."""
    values = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("v"))
    values = materialize(values, "values")  # limits first, then bins; the source runs once
    limits = values.groupBy(*group).agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("total")
    )
    # A single distinct value gets the unit interval around it, as histogram tools do.
    flat = F.col("low") == F.col("high")
    limits = limits.select(
        *group,
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        "total",
    ).withColumn("width", (F.col("high") - F.col("low")) / bins)
    if group:
        placed = lookup_join(values, limits, group, spread_by="v")
    else:
        packed = limits.where(F.col("total") > 0).select(F.struct("low", "width").alias("s"))
        placed = values.withColumn("_s", packed.scalar()).select("v", "_s.low", "_s.width")
    at = F.least(F.floor((F.col("v") - F.col("low")) / F.col("width")), F.lit(bins - 1)).cast("int")
    counts = placed.groupBy(*group, at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = limits.where(F.col("total") > 0).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, [*group, "bin"], "left").select(
        *group,
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        "width",
        "total",
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def entropy_histogram(df: DataFrame, bins: int = BINS) -> DataFrame:
    return _binned(df, "entropy", [], bins).select("bin", "bin_start", "n")


def entropy_percentile(df: DataFrame, p: float = 0.95) -> DataFrame:
    return exact_percentiles(df, [], "entropy", [p])


def entropy_by_category(df: DataFrame) -> DataFrame:
    """Box-plot figures per short category name; ``median_order`` (from 1) sorts them by median, then name."""
    named = df.select(short_category(F.col("category")).alias("category"), "entropy")
    quartiles = exact_percentiles(named, ["category"], "entropy", [0.0, 0.25, 0.5, 0.75, 1.0])
    names = {0.0: "minimum", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "maximum"}
    boxes = quartiles.groupBy("category").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name) for p, name in names.items()]
    )
    # Medians equal up to the last bits count as ties; there is one row per category.
    order = Window.orderBy(F.round("median", 9), "category")
    return boxes.withColumn("median_order", F.row_number().over(order).cast("long"))


def sample_pairs(df: DataFrame, n: int = PAIR_COUNT, seed: int = 42) -> DataFrame:
    """``n`` same-category draws and ``n`` draws over the whole table: ``draw, a, b, same``.

    A same-category draw picks a category uniformly, then two distinct documents of it;
    categories with fewer than two documents give nothing. A cross draw picks two distinct
    documents and is dropped if their categories agree. Documents are addressed by their
    position in hash order, which counts locate (``at_positions``): the table is neither sorted nor moved.
    """
    docs = df.select("doc_id", "category")
    sizes = docs.groupBy("category").agg(F.count(F.lit(1)).alias("size"))
    spark = df.sparkSession
    draws = spark.range(n).select(F.col("id").alias("draw"))

    def choose(what: str, modulus: Column) -> Column:
        """A number below ``modulus`` from the digest of seed, purpose and draw."""
        digest = F.md5(F.concat(F.lit(f"{seed}:{what}:"), F.col("draw").cast("string")))
        return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), modulus)

    categories = sizes.agg(F.count(F.lit(1))).scalar()
    same = (
        at_positions(sizes, [], "category", draws.withColumn("position", choose("category", categories)), "draw")
        .where(F.col("size") >= 2)
        .withColumn("pa", choose("first", F.col("size")))
        .withColumn("pb", F.pmod(F.col("pa") + 1 + choose("second", F.col("size") - 1), F.col("size")))
    )
    same_pairs = _drawn(same, docs, ["category"]).select("draw", "a", "b", F.lit(True).alias("same"))

    total = docs.agg(F.count(F.lit(1))).scalar()
    cross = draws.withColumn("pa", choose("left", total)).withColumn(
        "pb", F.pmod(F.col("pa") + 1 + choose("right", total - 1), total)
    )
    cross_pairs = (
        _drawn(cross, docs, [])
        .where(F.col("ca") != F.col("cb"))
        .select("draw", "a", "b", F.lit(False).alias("same"))
    )
    return same_pairs.unionByName(cross_pairs)


def _drawn(draws: DataFrame, docs: DataFrame, group: list[str]) -> DataFrame:
    """Resolve positions ``pa, pb`` to documents ``a, b`` (categories ``ca, cb``) in one search."""
    sides = F.explode(
        F.array(
            F.struct((F.col("draw") * 2).alias("pick"), F.col("pa").alias("position")),
            F.struct((F.col("draw") * 2 + 1).alias("pick"), F.col("pb").alias("position")),
        )
    )
    wanted = draws.select(*group, sides.alias("s")).select(*group, "s.pick", "s.position")
    found = at_positions(docs, group, "doc_id", wanted, "pick")
    of = lambda side, column: F.max(F.when(F.col("pick") % 2 == side, F.col(column)))
    return (
        found.groupBy(F.floor(F.col("pick") / 2).cast("long").alias("draw"))
        .agg(of(0, "doc_id").alias("a"), of(1, "doc_id").alias("b"), of(0, "category").alias("ca"), of(1, "category").alias("cb"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
    )


def pair_similarity(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Add the similarity of every pair; ``vectors(doc_id, embedding)``.

    The pairs are written first: their size in bytes lets the planner send their ids to the vectors
    (below its broadcast threshold), so that only the vectors of pairs are moved.
    """
    pairs = materialize(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    vectors = vectors.join(ids, "doc_id", "left_semi")
    side = lambda s: vectors.select(F.col("doc_id").alias(s), F.col("embedding").alias(f"v{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.withColumn("similarity", dot(F.col("va"), F.col("vb"))).drop("va", "vb")


def pair_means(scored: DataFrame) -> DataFrame:
    return scored.groupBy("same").agg(
        F.count(F.lit(1)).alias("pairs"), F.avg("similarity").alias("mean_similarity")
    )


def threshold_sweep(scored: DataFrame, low: int = SWEEP_LOW, high: int = SWEEP_HIGH) -> DataFrame:
    """Precision, recall and F1 at every threshold ``low/100 .. high/100``.

    Each pair is placed once, by the number of thresholds it reaches; the curve is a running
    sum over at most ``high - low + 2`` counts.
    """
    taus = [i / 100.0 for i in range(low, high + 1)]
    reached = F.size(F.filter(F.array(*[F.lit(t) for t in taus]), lambda t: F.col("similarity") >= t))
    counts = scored.groupBy(reached.alias("reached")).agg(
        F.count_if(F.col("same")).alias("same"), F.count_if(~F.col("same")).alias("other")
    )
    spark = scored.sparkSession
    grid = spark.range(len(taus) + 1).select(
        F.col("id").cast("int").alias("reached"), ((F.lit(low - 1) + F.col("id")) / F.lit(100.0)).alias("tau")
    )
    filled = grid.join(counts, "reached", "left").fillna(0, ["same", "other"])
    # A pair that reaches j thresholds is predicted positive by the first j of them.
    at_least = Window.orderBy(F.col("reached").desc())
    everything = Window.orderBy(F.col("reached").desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    summed = filled.select(
        "reached",
        "tau",
        F.sum("same").over(at_least).alias("tp"),
        F.sum("other").over(at_least).alias("fp"),
        F.sum("same").over(everything).alias("all_same"),
    ).where(F.col("reached") >= 1)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("all_same") - F.col("tp")
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0)
    recall = F.when(F.col("all_same") > 0, tp / F.col("all_same")).otherwise(0.0)
    return (
        summed.select("tau", "tp", "fp", fn.alias("fn"), precision.alias("precision"), recall.alias("recall"))
        .withColumn(
            "f1",
            F.when(
                F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
            ).otherwise(0.0),
        )
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold of highest F1, the lowest on ties."""
    return sweep.orderBy(F.col("f1").desc(), "tau").limit(1)


def similarity_density(scored: DataFrame, bins: int = BINS) -> DataFrame:
    """Density histogram of similarity for each class of pairs."""
    binned = _binned(scored, "similarity", ["same"], bins)
    return binned.select(
        "same", "bin", "bin_start", (F.col("n") / (F.col("total") * F.col("width"))).alias("density")
    )


def paraphrase_report(
    pairs: DataFrame, queries: DataFrame, thresholds: tuple[float, ...] = CHECKED_THRESHOLDS
) -> DataFrame:
    """Similarity, clusters and would-be hits of query pairs.

    ``pairs(pair_id, q1, q2)`` holds query ids; ``queries(qid, embedding, dominant_cluster)``.
    """
    side = lambda s: queries.select(
        F.col("qid").alias(f"q{s}"), F.col("embedding").alias(f"e{s}"), F.col("dominant_cluster").alias(f"c{s}")
    )
    joined = pairs.join(side("1"), "q1").join(side("2"), "q2")
    scored = joined.withColumn("similarity", dot(F.col("e1"), F.col("e2")))
    hits = {f"hit_at_{round(t * 100):03d}": F.col("similarity") >= t for t in thresholds}
    return scored.select(
        "pair_id",
        "q1",
        "q2",
        "similarity",
        F.col("c1").alias("cluster1"),
        F.col("c2").alias("cluster2"),
        (F.col("c1") == F.col("c2")).alias("same_cluster"),
        *[condition.alias(name) for name, condition in hits.items()],
    )


def recommend_threshold(scored: DataFrame, margin: float = THRESHOLD_MARGIN) -> DataFrame:
    """Mean, minimum and maximum similarity, and the threshold that catches every pair."""
    return scored.agg(
        F.avg("similarity").alias("mean_similarity"),
        F.min("similarity").alias("min_similarity"),
        F.max("similarity").alias("max_similarity"),
        (F.min("similarity") - margin).alias("recommended"),
    )
