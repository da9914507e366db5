import numpy as np
import pytest

import hashlib

from sembra.operators.ranking import at_positions, exact_percentiles, located

PROBS = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]


def test_percentiles_with_a_hot_group_and_repeats(spark):
    rng = np.random.RandomState(1)
    values = {"hot": rng.exponential(size=60_000), "flat": np.full(500, 2.5), "few": np.array([3.0, 1.0]),
              "one": np.array([7.0]), "coarse": rng.randint(0, 4, 3_000).astype(float)}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    found = {(r["g"], r["prob"]): r["value"] for r in exact_percentiles(df, ["g"], "x", PROBS).collect()}
    assert len(found) == len(values) * len(PROBS)
    for g, vs in values.items():
        for p in PROBS:
            assert found[g, p] == pytest.approx(np.quantile(vs, p), abs=1e-12)


def test_percentile_without_groups(spark):
    values = np.random.RandomState(2).randn(5_000)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert exact_percentiles(df, [], "x", [0.95]).first()["value"] == pytest.approx(np.quantile(values, 0.95))


def test_percentiles_of_all_kinds_of_doubles(spark):
    """Signs, zeros of both signs, infinities, tiny and huge numbers keep their order."""
    values = [-np.inf, -1e300, -2.5, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1e-5, 2.5, 1e300]
    rows = [("a", float(v)) for v in values] + [(None, 1.0), (None, 3.0), ("n", float("nan")), ("n", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(3)
    found = {(r["g"], r["prob"]): r["value"] for r in exact_percentiles(df, ["g"], "x", [0.0, 0.1, 0.2, 0.4, 0.5, 0.7, 1.0]).collect()}
    assert [found["a", p] for p in (0.1, 0.2, 0.5, 0.7, 1.0)] == [-1e300, -2.5, 0.0, 5e-324, 1e300]
    assert found["a", 0.0] != found["a", 0.0] or found["a", 0.0] == -np.inf
    assert found[None, 0.5] == 2.0 and found["n", 0.0] == 1.0 and np.isnan(found["n", 1.0])


def test_counts_locate_ranks():
    digits, counts = np.array([7, 2, 5]), np.array([4, 1, 3])  # 2, 5 5 5, 7 7 7 7
    inside, found, left = located(digits, counts, np.array([0, 1, 3, 4, 7, 8, -1]))
    assert inside.tolist() == [0, 1, 2, 3, 4]
    assert found.tolist() == [2, 5, 5, 7, 7] and left.tolist() == [0, 0, 2, 0, 3]


def test_rows_at_positions(spark):
    df = spark.range(5_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 700 = 1 THEN null ELSE 'hot' END AS g")
    rows = df.collect()
    order = {}
    for r in rows:
        order.setdefault(r["g"], []).append(r["doc_id"])
    for ids in order.values():
        ids.sort(key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    wanted = [(g, p, j * 10_000 + p) for j, (g, ids) in enumerate(order.items()) for p in (0, 1, 1, len(ids) // 2, len(ids) - 1, len(ids))]
    found = at_positions(df, ["g"], "doc_id", spark.createDataFrame(wanted, "g string, position long, pick long"), "pick").collect()
    truth = sorted((pick, order[g][p]) for g, p, pick in wanted if p < len(order[g]))
    assert sorted((r["pick"], r["doc_id"]) for r in found) == truth
    every = sorted(range(5_000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    found = at_positions(df, [], "doc_id", spark.createDataFrame([(p, p) for p in range(0, 5_000, 99)], "position long, pick long"), "pick")
    assert {r["pick"]: r["doc_id"] for r in found.collect()} == {p: every[p] for p in range(0, 5_000, 99)}


def test_positions_move_only_rows_near_them(spark):
    """Nothing but counts, and rows that share the first bits with a wanted one, is exchanged or sorted."""
    df = spark.range(20_000).selectExpr("id AS doc_id")
    found = at_positions(df, [], "doc_id", spark.createDataFrame([(5, 5)], "position long, pick long"), "pick")
    plan = found._jdf.queryExecution().sparkPlan().toString()
    below = plan[plan.index("Window") :]
    assert "BroadcastHashJoin" in below and below.index("BroadcastHashJoin") < below.index("Range")


def test_percentiles_of_nothing(spark):
    none = spark.createDataFrame([], "g string, x double")
    assert exact_percentiles(none, ["g"], "x", PROBS).count() == 0
    assert exact_percentiles(none, [], "x", PROBS).where("value is not null").count() == 0
