"""Joins to lookup tables that are too large to broadcast."""

from pyspark.sql import functions as F

from sembra import session


def test_a_large_lookup_side_is_moved_once(spark):
    """Formerly every row of it was repeated for each of 64 salts."""
    big = spark.createDataFrame([(i, 7 if i < 300 else None if i < 320 else i) for i in range(400)], "qid long, k long")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(7, 500)], "k long, v string")
    wanted = sorted((i, f"v{k}" if k is not None else None) for i, k in ((r["qid"], r["k"]) for r in big.collect()))
    for how in ("left", "inner"):
        joined = session.lookup_join(big, small, ["k"], "qid", how, max_rows=10, hot_rows=100)
        found = sorted(((r["qid"], r["v"]) for r in joined.collect()), key=lambda r: r[0])
        assert found == [w for w in wanted if how == "left" or w[1] is not None]
    # A task of the join has a part of the hot key only, and the other keys are not repeated.
    spread, original = [], F.explode
    try:
        F.explode = lambda c: spread.append(c) or original(c)
        session.lookup_join(big, small, ["k"], "qid", "left", max_rows=10, hot_rows=100)
    finally:
        F.explode = original
    hot = small.withColumn("_salts", F.when(F.col("k") == 7, F.lit(64).cast("long")))
    assert hot.select(original(spread[0])).count() == 64 + small.count() - 1


def test_languages_leave_rows_where_they_are(spark):
    """Formerly a join dealt all documents by language: as many tasks encoded them as there were languages."""
    from sembra.catalog.inputs import languages

    lang = F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 2 == 0, "b").otherwise("a")
    rows = spark.range(0, 4_000, 1, 16).select(F.col("id").alias("doc_id"), lang.alias("lang"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = languages(rows)
        found = out.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert out.columns == ["doc_id", "lang", "cluster"] and len(found) == 4_000
    assert {(r.lang, r.cluster) for r in found} == {("a", 0), ("b", 1), (None, None)}
    assert len({r.task for r in found}) == 16
