"""Cache operators on snapshots."""

import numpy as np
import pytest

from sembra.operators import cache as ch

SCHEMA = (
    "key string, query_text string, embedding array<double>, result string, dominant_cluster int,"
    " cluster_distribution map<int,double>, created_seq long, seq long"
)
QUERIES = (
    "qid long, query string, embedding array<double>, dominant_cluster int, cluster_distribution map<int,double>"
)


def vec(v):
    return [float(x) for x in v]


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def stored(spark, empty, rows):
    """rows: (query, vector, result, cluster, seq)"""
    frame = spark.createDataFrame(
        [(q, vec(v), r, c, None, s) for q, v, r, c, s in rows],
        "query string, embedding array<double>, result string, dominant_cluster int,"
        " cluster_distribution map<int,double>, seq long",
    )
    return ch.cache_store(empty, frame)


def asked(spark, rows):
    return spark.createDataFrame([(i, q, vec(v), c, d) for i, (q, v, c, d) in enumerate(rows)], QUERIES)


def looked(spark, cache, rows, threshold=0.85, depth=2):
    log = ch.cache_lookup(asked(spark, rows), cache, threshold, depth)
    return {r["qid"]: r for r in log.collect()}


def near(v, seed, size=0.02):
    w = v + size * np.random.RandomState(seed).randn(len(v))
    return w / np.linalg.norm(w)


def test_empty_cache(spark, empty, unit):
    log = ch.cache_lookup(asked(spark, [("q", unit(1), 0, None)]), empty)
    assert log.count() == 1 and not log.first()["hit"]
    stats = ch.cache_stats(log.where("false"), empty).first()
    assert stats.asDict() == {"total_entries": 0, "hit_count": 0, "miss_count": 0, "hit_rate": 0.0}


def test_same_text_hits_whatever_the_vector(spark, empty, unit):
    cache = stored(spark, empty, [("What is ML?", unit(1), "r", 0, 1)])
    row = looked(spark, cache, [(" what IS ml?", unit(2), 7, None)])[0]
    assert row["hit"] and row["score"] == 1.0 and row["matched_query"] == "What is ML?"


def test_similar_vector_hits_and_unrelated_misses(spark, empty, unit):
    cache = stored(spark, empty, [("base query", unit(42), "r", 0, 1)])
    rows = looked(spark, cache, [("close", near(unit(42), 1), 0, None), ("far", unit(7), 0, None)])
    assert rows[0]["hit"] and rows[0]["score"] >= 0.85 and rows[0]["matched_query"] == "base query"
    assert not rows[1]["hit"] and rows[1]["matched_query"] is None and rows[1]["score"] is None


def test_clusters_prune(spark, empty, unit):
    cache = stored(spark, empty, [("base", unit(1), "r", 0, 1)])
    rows = looked(
        spark,
        cache,
        [
            ("a", unit(1), 5, {5: 0.95}),
            ("b", unit(1), 1, {1: 0.55, 0: 0.40}),
            ("c", unit(1), 0, {1: 0.5, 2: 0.4, 0: 0.1}),
        ],
    )
    assert [rows[i]["hit"] for i in range(3)] == [False, True, False]


def test_ties(spark, empty, unit):
    v = unit(3)
    cache = stored(spark, empty, [("late", v, "r", 1, 9), ("early", v, "r", 1, 2), ("other", v, "r", 0, 1)])
    rows = looked(spark, cache, [("x", v, 1, {1: 0.6, 0: 0.4}), ("y", v, 0, {1: 0.4, 0: 0.6})])
    assert rows[0]["matched_query"] == "early" and rows[1]["matched_query"] == "other"


def test_threshold_zero_is_zero(spark, empty):
    cache = stored(spark, empty, [("a", [1.0, 0.0], "r", 0, 1)])
    rows = looked(spark, cache, [("b", [0.0, 1.0], 0, None), ("c", [-1.0, 0.0], 0, None)], threshold=0.0)
    assert rows[0]["hit"] and not rows[1]["hit"]


def test_lookup_equals_brute_force_in_a_hot_cluster(spark, empty):
    rng = np.random.RandomState(4)
    vectors = rng.randn(300, 6)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    entries = [(f"e{i}", vectors[i], "r", i % 4 % 3, i) for i in range(200)]
    cache = stored(spark, empty, entries)
    queries = [(f"q{i}", vectors[200 + i], i % 3, {i % 3: 0.5, (i + 1) % 3: 0.5}) for i in range(100)]
    rows = looked(spark, cache, queries, threshold=0.9)
    for i, (_, v, _, d) in enumerate(queries):
        sims = {e[0]: float(e[1] @ v) for e in entries if e[3] in d}
        best = max(sims, key=sims.get)
        assert rows[i]["hit"] == (sims[best] >= 0.9)
        assert rows[i]["matched_query"] == (best if sims[best] >= 0.9 else None)


def test_store_keeps_the_first_entry_and_the_last_result(spark, empty, unit):
    first = stored(spark, empty, [("Q", unit(1), "one", 0, 1), ("q ", unit(2), "two", 5, 2), ("p", unit(3), "p", 1, 3)])
    rows = {r["query_text"]: r for r in first.collect()}
    assert set(rows) == {"Q", "p"}
    q = rows["Q"]
    assert (q["result"], q["dominant_cluster"], q["created_seq"], q["seq"]) == ("two", 0, 1, 2)
    again = stored(spark, first, [("q", unit(9), None, 8, 10)])
    q = {r["query_text"]: r for r in again.collect()}["Q"]
    assert (q["result"], q["dominant_cluster"], q["created_seq"], q["seq"]) == (None, 0, 1, 10)
    assert q["embedding"] == pytest.approx(vec(unit(1)))


def test_eviction_drops_the_least_recently_used(spark, empty, unit):
    cache = stored(spark, empty, [(f"q{i}", unit(i), "r", 0, i) for i in range(4)])
    kept = lambda c: sorted(r["query_text"] for r in c.collect())
    assert kept(ch.evict_lru(cache, 3)) == ["q1", "q2", "q3"]
    hit = ch.cache_lookup(asked(spark, [("q0", unit(0), 0, None)]), cache).selectExpr("matched_key", "qid + 100 AS seq")
    assert kept(ch.evict_lru(ch.touch(cache, hit), 3)) == ["q0", "q2", "q3"]
    assert ch.evict_lru(cache, 0).count() == 0 and ch.evict_lru(cache, 100).count() == 4


def test_statistics(spark, empty, unit):
    cache = stored(spark, empty, [(f"q{i}", unit(i), "r", 0 if i < 3 else 1, i) for i in range(5)])
    assert {r[0]: r[1] for r in ch.cache_cluster_counts(cache).collect()} == {0: 3, 1: 2}
    log = ch.cache_lookup(asked(spark, [("q0", unit(0), 0, None), ("new", unit(50), 0, None)]), cache)
    assert ch.cache_stats(log, cache).first()["hit_rate"] == 0.5
    left, removed = ch.cache_clear(cache)
    assert removed == 5 and left.count() == 0


def simulate_lru(keys, capacity):
    held, hits = [], []
    for k in keys:
        hits.append(k in held)
        if k in held:
            held.remove(k)
        held.append(k)
        held = held[-capacity:] if capacity else []
    return hits


@pytest.mark.parametrize("capacity", [0, 1, 2, 5, 40])
@pytest.mark.parametrize("block", [17, 400, 10_000])
def test_exact_replay_equals_simulation(spark, capacity, block):
    rng = np.random.RandomState(11)
    # One tenant holds most of the log and its keys are skewed.
    logs = {"hot": (rng.zipf(1.3, 600) % 50).tolist(), "cold": (rng.randint(0, 8, 60)).tolist()}
    rows = [(t, i * 3 + (t == "hot"), str(k)) for t, ks in logs.items() for i, k in enumerate(ks)]
    log = spark.createDataFrame(rows, "tenant string, seq long, key string")
    found = ch.exact_cache_replay(log, capacity, block_rows=block).orderBy("tenant", "seq").collect()
    for tenant, keys in logs.items():
        assert [r["hit"] for r in found if r["tenant"] == tenant] == simulate_lru([str(k) for k in keys], capacity)
