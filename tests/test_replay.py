"""Sequential cache semantics: known cases, a plain simulation, and stream = batch."""

import hashlib

import numpy as np
import pytest

from sembra.session import scratch_path
from sembra.streaming.replay import semantic_cache_replay
from sembra.streaming.stateful import semantic_cache_stream, state_partitions

SCHEMA = (
    "tenant string, seq long, op string, query string, embedding array<double>, dominant_cluster int,"
    " cluster_distribution map<int,double>"
)


def vec(v):
    return [float(x) for x in v]


def log(spark, rows):
    """rows: (query, vector, cluster, distribution) or 'clear'"""
    full = [
        ("t", i, "clear", None, None, None, None) if r == "clear" else ("t", i, "query", r[0], vec(r[1]), r[2], r[3])
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


def play(spark, rows, threshold=0.85, max_size=100, depth=2, block_rows=100_000):
    played = semantic_cache_replay(log(spark, rows), threshold, max_size, depth, block_rows)
    return sorted(played.collect(), key=lambda r: r["seq"])


def test_repeat_hits_with_score_one(spark, unit):
    rows = play(spark, [("What is ML?", unit(1), 0, {0: 0.9}), ("what is ml?  ", unit(2), 3, None)])
    assert not rows[0]["hit"] and rows[0]["answer_seq"] == 0
    assert rows[1]["hit"] and rows[1]["score"] == 1.0 and rows[1]["answer_seq"] == 0
    assert rows[1]["matched_query"] == "What is ML?"


def test_near_vector_hits_and_pruning_misses(spark, unit):
    base = unit(42)
    close = base + 0.02 * np.random.RandomState(42).randn(384)
    close /= np.linalg.norm(close)
    rows = play(
        spark,
        [
            ("base query", base, 0, {0: 0.9, 1: 0.1}),
            ("close", close, 0, {0: 0.9, 1: 0.1}),
            ("other cluster", base, 5, {5: 0.95}),
            ("two clusters", base, 1, {1: 0.55, 0: 0.40}),
            ("unrelated", unit(8), 0, {0: 0.9}),
        ],
    )
    assert [r["hit"] for r in rows] == [False, True, False, True, False]
    assert rows[1]["score"] >= 0.85 and rows[1]["matched_query"] == "base query"


def test_touched_entry_survives_and_the_oldest_leaves(spark, unit):
    ask = lambda i: (f"query {i}", unit(i), 0, {0: 0.9})
    rows = play(spark, [ask(0), ask(1), ask(2), ask(0), ask(3), ask(0), ask(1)], max_size=3, depth=1)
    assert [r["hit"] for r in rows] == [False, False, False, True, False, True, False]


def test_clear_reports_and_forgets(spark, unit):
    ask = lambda i: (f"query {i}", unit(i), 0, {0: 0.9})
    rows = play(spark, [ask(0), ask(1), "clear", ask(0), ask(0)])
    assert rows[2]["removed"] == 2 and rows[2]["op"] == "clear" and rows[2]["hit"] is None
    assert [r["hit"] for r in rows if r["op"] == "query"] == [False, False, False, True]


def simulate(rows, threshold, max_size, depth):
    """The rules written down once more, without any index."""
    held, out = [], []  # held: [key, text, vector, cluster, created], least recently used first
    for seq, (text, v, cluster, dist) in enumerate(rows):
        key = hashlib.sha256(text.strip().lower().encode()).hexdigest()
        found = next((e for e in held if e[0] == key), None)
        score = 1.0 if found else None
        if not found:
            probes = [cluster]
            if dist and len(dist) > 1:
                probes = [c for c, _ in sorted(dist.items(), key=lambda x: (-x[1], x[0]))[:depth]]
            best = None
            for rank, probe in enumerate(probes):
                for e in sorted((e for e in held if e[3] == probe), key=lambda e: e[4]):
                    s = float(np.dot(e[2], v))
                    if best is None or round(s, 12) > round(best[0], 12):
                        best = (s, e)
            if best and best[0] >= threshold:
                score, found = best
        if found:
            held.remove(found)
            held.append(found)
            out.append((seq, True, found[1], round(score, 9)))
        else:
            held = held[-(max_size - 1):] if max_size > 1 else []
            held.append([key, text, v, cluster, seq])
            out.append((seq, False, None, None))
    return out


@pytest.fixture(scope="module")
def random_rows():
    rng = np.random.RandomState(9)
    rows = []
    for i in range(260):
        v = rng.randn(5)
        v /= np.linalg.norm(v)
        c = int(rng.randint(0, 3))
        dist = {c: 0.6, (c + 1) % 3: 0.3, (c + 2) % 3: 0.1} if i % 3 else {c: 1.0}
        rows.append((f"q{rng.randint(0, 120)}", v, c, dist))
    return rows


@pytest.mark.parametrize("block", [40, 100_000])
@pytest.mark.parametrize("max_size", [1, 12, 100])
def test_replay_equals_simulation(spark, random_rows, max_size, block):
    played = play(spark, random_rows, threshold=0.93, max_size=max_size, block_rows=block)
    found = [(r["seq"], r["hit"], r["matched_query"], None if r["score"] is None else round(r["score"], 9)) for r in played]
    assert found == simulate(random_rows, 0.93, max_size, 2)
    assert 0 < sum(r["hit"] for r in played) < len(played)


def test_stream_equals_batch_over_micro_batches(spark, random_rows):
    rows = random_rows[:100] + ["clear"] + random_rows[100:]
    full = log(spark, rows)
    other = full.selectExpr("'u' AS tenant", "seq", "op", "query", "embedding", "dominant_cluster", "cluster_distribution")
    both = full.unionByName(other)
    arriving, out, progress = (scratch_path(spark, n) for n in ("arriving", "out", "progress"))
    for low, high in ((0, 90), (90, 180), (180, 1000)):
        both.where(f"seq >= {low} AND seq < {high}").write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(both.schema).parquet(arriving)
        query = (
            semantic_cache_stream(stream, 0.93, 12)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    batch = semantic_cache_replay(both, 0.93, 12, block_rows=70)
    columns = ["tenant", "seq", "op", "hit", "matched_query", "answer_seq", "removed"]
    key = lambda r: (r["tenant"], r["seq"])
    streamed = sorted(spark.read.parquet(out).select(columns).collect(), key=key)
    assert streamed == sorted(batch.select(columns).collect(), key=key)


def test_state_partitions_do_not_follow_the_shuffles(spark, random_rows):
    """Formerly every micro-batch opened as many states as the session has shuffle partitions."""
    rows = log(spark, random_rows[:20])
    arriving, out = scratch_path(spark, "arriving"), scratch_path(spark, "out")
    rows.write.parquet(arriving)
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with state_partitions(spark):
        assert spark.conf.get(name) == str(spark.sparkContext.defaultParallelism)
    stream = semantic_cache_stream(spark.readStream.schema(rows.schema).parquet(arriving), 0.93, 12)
    with state_partitions(spark, 3):
        query = (
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "progress"))
            .trigger(availableNow=True).start()
        )
    assert spark.conf.get(name) == before
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    assert spark.read.parquet(out).count() == 20


def test_a_long_log_is_one_pass(spark, monkeypatch):
    """Formerly every block of a log was a round of jobs over all tenants."""
    import sembra.streaming.replay as module

    vector, jobs = [1.0, 0.0], []
    log = spark.createDataFrame(
        [("ab"[i % 3 == 0], i, f"q{i % 7}", vector, 0, None) for i in range(400)],
        "tenant string, seq long, query string, embedding array<double>, dominant_cluster int, cluster_distribution map<int,double>",
    )
    spark.sparkContext.setJobGroup("one-pass", "one-pass")
    played = module.semantic_cache_replay(log, threshold=2.0, max_size=3, block_rows=5)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one-pass")
    assert not jobs
    recent, wanted = {"a": [], "b": []}, {}
    for i in range(400):
        keys, key = recent["ab"[i % 3 == 0]], f"q{i % 7}"
        wanted[i] = key in keys
        recent["ab"[i % 3 == 0]] = [*[k for k in keys if k != key], key][-3:]
    assert {r["seq"]: r["hit"] for r in played.collect()} == wanted
