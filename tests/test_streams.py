import hashlib
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from sembra.operators.encode import HashingEncoder, embed_documents
from sembra.operators.mixture import Mixture, fit_gmm
from sembra.operators.reduction import fit_pca, pca_transform
from sembra.plans.answers import answer_queries
from sembra.plans.index import build_index, index_rows
from sembra.plans.responses import validate_queries
from sembra.session import scratch_path
from sembra.sources.artifacts import load_models, read_artifacts
from sembra.sources.corpus import clean_corpus
from sembra.sources.store import METADATA, STORE_SCHEMA, among, append_documents, ingest_missing, read_store, update_metadata
from sembra.streaming.ingest import stream_ingest
from sembra.streaming import shared
from sembra.streaming.shared import QUERY_SCHEMA, SNAPSHOT_SCHEMA, cache_foreach_batch, lookup_log, snapshot
from sembra.streaming.windows import hit_rate_windows

WORDS = ["orbit", "rocket", "moon", "goal", "match", "league", "kernel", "driver", "disk", "faith"]


encoder = partial(HashingEncoder, 32)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.RandomState(1)
    rows = []
    for i in range(120):
        topic = i % 3
        words = [WORDS[topic * 3 + rng.randint(0, 3)] for _ in range(12)] + [WORDS[rng.randint(0, 10)]]
        rows.append((i, f"Subject: x{i}\n" + " ".join(words), topic, f"top.{topic}"))
    rows.append((999, "too short", 0, "top.0"))
    return spark.createDataFrame(rows, "doc_id long, text string, category_id int, category string")


@pytest.fixture(scope="module")
def built(spark, corpus):
    path = scratch_path(spark, "index")
    index = build_index(corpus, path, encoder, k=3, components=4, k_range=range(2, 4), n_init=2, max_iter=50,
                        sweep_n_init=1, sweep_max_iter=30)
    return path, index


def test_index(spark, corpus, built):
    path, index = built
    rows = index.store.collect()
    assert len(rows) == 120 and {r["id"] for r in rows} == {f"doc_{i}" for i in range(120)}
    assert all(r["document"].startswith(tuple(WORDS)) for r in rows)
    assert all(0 <= r["dominant_cluster"] < 3 and len(r["cluster_distribution"]) == 3 for r in rows)
    assert index.sweep.count() == 2 and index.report.first()["n_samples"] == 120
    assert load_models(f"{path}/models")[2] == 3
    assert read_artifacts(spark, f"{path}/k_evaluation", "k int, bic double").count() == 2
    assert read_artifacts(spark, f"{path}/boundary_documents", "doc_id long").count() == 20


def test_second_ingest_adds_nothing(spark, corpus, built):
    path, _ = built
    cleaned = clean_corpus(corpus).drop("text").withColumnRenamed("clean_text", "document")
    ingest_missing(embed_documents(cleaned, "document", encoder), f"{path}/documents")
    assert read_store(spark, f"{path}/documents").count() == 120
    assert read_store(spark, f"{path}/nothing_here").count() == 0


def test_updates_write_metadata_only(spark):
    path = scratch_path(spark, "store")
    rows = [(i, f"text {i}", [float(i)], f"c{i}", i, {0: 0.5}) for i in range(6)]
    append_documents(spark.createDataFrame(rows, "doc_id long, document string, embedding array<float>, category string, category_id int, cluster_distribution map<int,double>"), path)
    before = read_store(spark, path)
    first = spark.createDataFrame([(0, "new", None), (1, None, 7), (1, None, 9), (77, "x", 1)], "doc_id long, category string, dominant_cluster int")
    assert update_metadata(spark, path, first) == 1
    second = spark.createDataFrame([(0, {1: 0.25}, None), (2, {2: 1.0}, "z")], "doc_id long, cluster_distribution map<int,double>, category string")
    assert update_metadata(spark, path, second) == 2
    found = {r.doc_id: r for r in read_store(spark, path).collect()}
    assert len(found) == 6 and read_store(spark, path).schema == before.schema
    assert [found[i].category for i in range(3)] == ["new", "c1", "z"] and found[1].dominant_cluster == 9
    assert found[0].cluster_distribution == {1: 0.25} and found[1].cluster_distribution == {0: 0.5}
    assert [found[i].document for i in range(6)] == [f"text {i}" for i in range(6)]
    assert {r.doc_id: r.category for r in read_store(spark, path, 1).collect()}[2] == "c2"
    written = spark.read.parquet(f"{path}_changes")
    assert set(written.columns) == {"doc_id", "version", *METADATA} and written.count() == 5


def test_ingest_of_equal_ids_and_a_large_store(spark):
    path = scratch_path(spark, "store")
    schema = "doc_id long, document string, embedding array<float>"
    ingest_missing(spark.range(20_000).selectExpr("id AS doc_id", "'old' AS document", "array(1f) AS embedding"), path)
    new = [(i, "new", [2.0]) for i in range(19_990, 20_010)] + [(30_000, "b", [1.0]), (30_000, "a", [9.0]), (30_000, "a", [3.0])]
    ids = among(read_store(spark, path), spark.createDataFrame(new, schema))
    assert {r.doc_id for r in ids.collect()} >= set(range(19_990, 20_000)) and ids.count() < 200
    for _ in range(2):
        ingest_missing(spark.createDataFrame(new, schema).repartition(3), path)
        rows = {r.doc_id: r for r in read_store(spark, path).where("doc_id >= 19990").collect()}
        assert read_store(spark, path).count() == 20_011
        assert [rows[i].document for i in (19_990, 19_999, 20_000)] == ["old", "old", "new"]
        assert (rows[30_000].document, rows[30_000].embedding) == ("a", [3.0])


def test_stream_ingest_equals_batch(spark, corpus, built):
    _, index = built
    mixture = index.mixture
    arriving, path, progress = (scratch_path(spark, n) for n in ("arriving", "stream", "progress"))
    for part in (0, 1):
        corpus.where(F.col("doc_id") % 2 == part).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(corpus.schema).parquet(arriving)
        stream_ingest(stream, index.pca, mixture, path, progress, encoder).awaitTermination()
    columns = ["doc_id", "id", "document", "category", "dominant_cluster", "cluster_distribution"]
    streamed = spark.read.schema(STORE_SCHEMA).parquet(path).select(columns).orderBy("doc_id").collect()
    batch = index_rows(corpus, index.pca, mixture, encoder).select(columns).orderBy("doc_id").collect()
    assert streamed == batch and len(batch) == 120


def test_answers_miss_then_hit(spark, built):
    _, index = built
    mixture = index.mixture
    queries = spark.createDataFrame([(1, "rocket moon orbit"), (2, "league goal"), (3, ""), (4, "x" * 1001)],
                                    "qid long, query string")
    first = answer_queries(queries, index.store, spark.createDataFrame([], SNAPSHOT_SCHEMA), mixture, index.pca, encoder)
    assert sorted(r["qid"] for r in first.rejected.collect()) == [3, 4]
    rows = {r["qid"]: r for r in first.responses.collect()}
    assert set(rows) == {1, 2} and not rows[1]["cache_hit"] and rows[1]["similarity_score"] is None
    assert len(rows[1]["result"]) == 5
    sims = [h["similarity"] for h in rows[1]["result"]]
    assert sims == sorted(sims, reverse=True) and rows[1]["result"][0]["category"] == "top.0"
    cache = first.cache.cache()
    again = spark.createDataFrame([(11, " Rocket MOON orbit "), (12, "orbit rocket moon"), (13, "kernel disk")],
                                  "qid long, query string")
    second = answer_queries(again, index.store, cache, mixture, index.pca, encoder)
    rows = {r["qid"]: r for r in second.responses.collect()}
    assert rows[11]["cache_hit"] and rows[11]["similarity_score"] == 1.0
    assert rows[12]["cache_hit"] and rows[12]["matched_query"] == "rocket moon orbit"
    assert rows[12]["result"] == rows[11]["result"] and not rows[13]["cache_hit"]
    assert second.cache.count() == 3
    touched = {r["query_text"]: r["seq"] for r in second.cache.collect()}
    assert touched["rocket moon orbit"] == 12 and touched["league goal"] == 2


def test_validation_counts_characters(spark):
    rows = spark.createDataFrame([(1, ""), (2, " "), (3, "é" * 1000), (4, "a" * 1001), (5, None)], "qid long, query string")
    accepted, rejected = validate_queries(rows)
    assert sorted(r["qid"] for r in accepted.collect()) == [2, 3]
    assert sorted(r["qid"] for r in rejected.collect()) == [1, 4, 5]


def test_shared_cache_batches_are_repeatable(spark, built):
    _, index = built
    path = scratch_path(spark, "shared")
    process = cache_foreach_batch(path, index.store, threshold=0.9, max_size=3)

    def batch(rows):
        encoded = embed_documents(spark.createDataFrame(rows, "qid long, query string"), "query", encoder)
        return encoded.select("qid", "query", F.col("embedding").cast("array<double>").alias("embedding"),
                              F.lit(0).alias("dominant_cluster"), F.lit(None).cast("map<int,double>").alias("cluster_distribution"))

    process(batch([(1, "rocket moon"), (2, "goal match"), (3, "rocket moon")]), 0)
    assert snapshot(spark, path, 0).count() == 2
    second = batch([(11, "moon rocket"), (12, "kernel"), (13, "faith")])
    process(second, 1)
    once = sorted(r["query_text"] for r in snapshot(spark, path, 1).collect())
    process(second, 1)
    assert sorted(r["query_text"] for r in snapshot(spark, path, 1).collect()) == once == ["faith", "kernel", "rocket moon"]
    hits = {r["qid"]: r["hit"] for r in lookup_log(spark, path).collect()}
    assert hits == {1: False, 2: False, 3: False, 11: True, 12: False, 13: False}
    assert set(f.split()[0] for f in QUERY_SCHEMA.split(", ") if "<" not in f) <= set(second.columns)


def plain_cache(batches, max_size):
    """Exact keys only: entries as {key: (text, created, seq)} after every batch."""
    cache, states = {}, []
    for rows in batches:
        before = dict(cache)
        for qid, text in rows:
            key = text.strip().lower()
            if key in before:
                cache[key] = (*cache[key][:2], max(cache[key][2], qid))
            else:
                old = cache.get(key, (text, qid, qid))
                cache[key] = (*old[:2], qid)
        kept = sorted(cache, key=lambda k: -cache[k][2])[:max_size]
        cache = {k: cache[k] for k in kept}
        states.append(dict(cache))
    return states


def test_shared_cache_is_a_log_of_changes(spark, built, monkeypatch):
    """Entries after every batch are those of a plain cache; a batch writes what it changes; the whole is
    written now and then; entries that were removed can come again."""
    monkeypatch.setattr(shared, "COMPACT_EVERY", 3)
    _, index = built
    path, draw = scratch_path(spark, "shared"), np.random.RandomState(8)
    texts = [f"{a} {b}" for a in WORDS[:5] for b in ("alpha", "beta")]
    batches = [[(100 * b + i, texts[draw.randint(len(texts))]) for i in range(4)] for b in range(7)]
    states = plain_cache(batches, 6)
    process = cache_foreach_batch(path, index.store, threshold=2.0, max_size=6, k=1)
    schema = QUERY_SCHEMA
    for b, rows in enumerate(batches):
        vectors = [(qid, text, [0.1] * 32, 0, None) for qid, text in rows]
        process(spark.createDataFrame(vectors, schema), b)
        if b in (2, 4):
            process(spark.createDataFrame(vectors, schema), b)  # a repeated batch
        found = {r["key"]: (r["query_text"], r["created_seq"], r["seq"]) for r in snapshot(spark, path, b).collect()}
        assert found == {hashlib.sha256(k.encode()).hexdigest(): v for k, v in states[b].items()}
        written = spark.read.parquet(f"{path}/changes").where(F.col("batch") == b)
        changed = set(states[b].items()) ^ set((states[b - 1] if b else {}).items())
        assert written.count() <= len({k for k, _ in changed}) and written.where("change <> 'put' and embedding is not null").count() == 0
    assert {r["batch"] for r in spark.read.parquet(f"{path}/whole").select("batch").distinct().collect()} == {2, 5}
    assert len({k for s in states for k in s}) > 6  # some were removed


def test_hit_rate_on_a_stream_equals_the_table(spark):
    rows = spark.range(400).selectExpr(
        "timestamp_seconds(1700000000 + id * 60) AS ts", "id % 3 = 0 AS hit"
    )
    arriving, out = scratch_path(spark, "arriving"), scratch_path(spark, "windows")
    rows.write.parquet(arriving)
    stream = spark.readStream.schema(rows.schema).parquet(arriving)
    query = (
        hit_rate_windows(stream, "1 hour", "10 minutes")
        .writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    streamed = {r["window_start"]: tuple(r) for r in spark.read.parquet(out).collect()}
    table = {r["window_start"]: tuple(r) for r in hit_rate_windows(rows, "1 hour").collect()}
    # The newest windows are still open behind the watermark.
    assert len(streamed) >= len(table) - 2 and all(table[w] == row for w, row in streamed.items())


def test_a_log_arrives_in_order_in_bounded_files(spark, tmp_path):
    """Formerly the whole log was one micro-batch, which a task of the stream held."""
    from sembra.catalog.flows import arrivals

    log = spark.range(1_000).select((F.col("id") * 7 % 500).alias("seq"), F.col("id").cast("string").alias("query"))
    n = arrivals(log.repartition(3), str(tmp_path / "log"), 100)
    files = sorted((tmp_path / "log").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    parts = [[r["seq"] for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert n == len(parts) == 10 and max(map(len, parts)) < 250
    assert sorted(s for p in parts for s in p) == sorted([*range(500), *range(500)])
    held = [p for p in parts if p]
    assert all(max(a) < min(b) for a, b in zip(held, held[1:]))


def test_files_of_a_log_are_written_at_once(spark, tmp_path, monkeypatch):
    """Formerly every file of the log was a job of its own, one after the other."""
    from sembra.catalog import flows

    log = spark.range(1_000).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("query"))
    jobs = []
    for rows in (500, 50):
        spark.sparkContext.setJobGroup(f"arrive-{rows}", "arrive")
        flows.arrivals(log, str(tmp_path / f"log-{rows}"), rows)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"arrive-{rows}")))
    spark.sparkContext.setJobGroup("none", "none")
    assert jobs[0] == jobs[1]
    # Where files cannot be dated they still arrive in order.
    monkeypatch.setattr(flows, "_dated", lambda fs, files: False)
    n = flows.arrivals(log, str(tmp_path / "slow"), 300)
    files = sorted((tmp_path / "slow").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    seqs = [sorted(r["seq"] for r in spark.read.parquet(str(f)).collect()) for f in files]
    assert n == len(files) and sum(seqs, []) == list(range(1_000))


def test_only_a_slice_of_texts_is_strings(spark):
    """Formerly a whole Arrow batch was turned into Python strings before its first text was encoded."""
    import gc

    def encoder():
        def encode(texts):
            alive = sum(1 for o in gc.get_objects() if isinstance(o, list) and len(o) > 60 and isinstance(o[0], str) and o[0].startswith("text "))
            return np.full((len(texts), 1), 1.0) * [[alive, len(texts)]]

        return encode

    df = spark.range(500).coalesce(1).select(F.when(F.col("id") != 499, F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    found = [r["embedding"] for r in embed_documents(df, encoder=encoder, batch_size=50).collect()]
    assert len(found) == 500 and all(v[0] == 0 and v[1] == 1 for v in found)
