import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sembra.functions import vectors as vx
from sembra.catalog import search as catalog
from sembra.operators import blocks
from sembra.operators.hashed import probe_order
from sembra.operators.search import format_hits, hashed_search, search_lsh, search_probed, search_topk, search_topk_blocked

DIM = 12


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.RandomState(7)
    docs = rng.randn(400, DIM)
    docs[50:60] = docs[40]  # copies tie
    docs /= np.linalg.norm(docs, axis=1, keepdims=True)
    queries = rng.randn(60, DIM)
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    # Two thirds of the documents share one cluster.
    clusters = np.where(np.arange(400) % 3 == 0, np.arange(400) % 5, 0)
    d = spark.createDataFrame(
        [(i, [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(docs, clusters))],
        "doc_id long, dvec array<double>, dominant_cluster int",
    )
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(queries)], "qid long, qvec array<double>")
    return docs, clusters, queries, d, q


def brute(docs, queries, k, allowed=None):
    out = {}
    for qid, q in enumerate(queries):
        ids = range(len(docs)) if allowed is None else allowed[qid]
        ranked = sorted(ids, key=lambda i: (-round(float(docs[i] @ q), 12), i))[:k]
        out[qid] = ranked
    return out


def collect(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append(r["doc_id"])
    return out


def test_topk(data):
    docs, _, queries, d, q = data
    assert collect(search_topk(q, d, 5)) == brute(docs, queries, 5)


@pytest.mark.parametrize("tile", [7, 50, 1000])
def test_blocked(data, tile, monkeypatch):
    docs, _, queries, d, q = data
    monkeypatch.setattr(blocks, "PRODUCT_CELLS", 900)
    monkeypatch.setattr(blocks, "PRODUCT_QUERIES", 16)
    assert collect(search_topk_blocked(q, d, 12, tile_rows=tile)) == brute(docs, queries, 12)


def test_large_batches_travel_in_tiles(data, monkeypatch):
    docs, _, queries, d, q = data
    sizes, original = [], blocks.tile_topk
    monkeypatch.setattr(blocks, "tile_topk", lambda asked, *rest: sizes.append(asked.num_rows) or original(asked, *rest))
    assert collect(search_topk(q, d, 3, tile_rows=10)) == brute(docs, queries, 3)
    assert max(sizes) <= 10 and sum(sizes) == 60
    monkeypatch.setattr(blocks, "TILE_BYTES", 8 * DIM * 25)
    sizes.clear()
    assert collect(search_topk(q, d, 3)) == brute(docs, queries, 3)
    assert max(sizes) <= 25 and sum(sizes) == 60


def test_documents_are_read_in_place(data):
    """Between the scan of the documents and their task's best hits there is no exchange."""
    _, _, _, d, q = data
    plan = search_topk(q, d, 3)._jdf.queryExecution().sparkPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan[plan.index("MapInArrow") :]


def test_products_are_small_and_hopeless_tiles_are_skipped(spark, monkeypatch):
    draw = np.random.RandomState(4)
    centres = np.eye(DIM)[np.arange(6000) // 1000]
    rows = centres + 0.05 * draw.randn(6000, DIM)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    asked = pa.table({"qid": list(range(200)), "qvec": [v.tolist() for v in rows[::30]]})
    cells, original = [], blocks.best_per_row
    monkeypatch.setattr(blocks, "best_per_row", lambda sims, *rest: cells.append(sims.size) or original(sims, *rest))
    monkeypatch.setattr(blocks, "PRODUCT_CELLS", 20_000)
    frame = spark.createDataFrame([(i, v.tolist(), i) for i, v in enumerate(rows)], "doc_id long, dvec array<double>, tie long").coalesce(1)
    scans = []
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, f, schema: scans.append(f) or self)
    blocks.tile_topk(asked, frame, 5)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6000)), "dvec": [v.tolist() for v in rows], "tie": list(range(6000))})
    found = pa.Table.from_batches(list(scans[0](iter([batch.slice(i, 500) for i in range(0, 6000, 500)]))))
    assert max(cells) <= 20_000 and sum(cells) < 0.6 * 200 * 6000
    best = {}
    for qid, doc in zip(found["qid"].to_pylist(), found["doc_id"].to_pylist()):
        best.setdefault(qid, []).append(doc)
    assert best == brute(rows, rows[::30], 5)


def test_k_is_nested(data):
    _, _, _, d, q = data
    three, five = collect(search_topk(q, d, 3)), collect(search_topk(q, d, 5))
    assert all(five[i][:3] == three[i] for i in three)


def test_filter_and_small_stores(data):
    docs, _, queries, d, q = data
    allowed = {i: [0, 1, 2] for i in range(len(queries))}
    assert collect(search_topk(q, d, 5, where=F.col("doc_id") < 3)) == brute(docs, queries, 5, allowed)
    assert search_topk(q, d.where("doc_id < 0")).count() == 0
    assert search_topk(q.where("qid < 0"), d).count() == 0


def test_probed(data, spark):
    docs, clusters, queries, d, q = data
    mixed = q.withColumns(
        {
            "dominant_cluster": (F.col("qid") % 5).cast("int"),
            "cluster_distribution": F.when(
                F.col("qid") % 2 == 0,
                F.create_map(F.lit(0), F.lit(0.4), (F.col("qid") % 5).cast("int") + 5, F.lit(0.1), F.lit(3), F.lit(0.4)),
            ),
        }
    )
    probes = {i: {0, 3} if i % 2 == 0 else {i % 5} for i in range(len(queries))}
    allowed = {i: [j for j in range(400) if clusters[j] in probes[i]] for i in probes}
    assert collect(search_probed(mixed, d, 4)) == brute(docs, queries, 4, allowed)


def near_copies(docs, n, size):
    noise = np.random.RandomState(3).randn(n, DIM) * size
    near = docs[:n] + noise
    return near / np.linalg.norm(near, axis=1, keepdims=True)


def query_frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "qid long, qvec array<double>")


def test_lsh_recall(data):
    docs, _, _, d, _ = data
    near = near_copies(docs, 60, 0.05)
    exact, found = brute(docs, near, 1), collect(search_lsh(query_frame(d.sparkSession, near), d, 1))
    assert sum(found.get(i) == exact[i] for i in exact) >= 57


def test_lsh_reads_little_of_clustered_vectors(spark):
    draw = np.random.RandomState(5)
    centres = draw.randn(40, 24)
    rows = centres[np.arange(2000) % 40] + 0.2 * draw.randn(2000, 24)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    d = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(rows)], "doc_id long, dvec array<double>, bucket string")
    q = query_frame(spark, rows[:300])
    dealt = hashed_search(q, d, 5)
    found, exact = collect(dealt.hits(5)), brute(rows, rows[:300], 5)
    assert sum(len(set(found[i]) & set(exact[i])) for i in exact) >= 0.9 * 5 * 300
    sides = dealt.plan.sides(rows)
    codes = dealt.plan.codes(sides)
    probes = [set((c ^ probe_order(s, dealt.plan.probes)[0]).tolist()) for c, s in zip(codes[:300], sides[:300])]
    met = sum(int(c) in p for p in probes for c in codes)
    assert dealt.candidate_share() == pytest.approx(met / (300 * 2000)) and met < 0.3 * 300 * 2000
    # Whatever is found is the best of the buckets that were probed.
    allowed = {i: [j for j in range(2000) if int(codes[j]) in probes[i]] for i in range(20)}
    assert {i: found[i] for i in allowed} == brute(rows, rows[:20], 5, allowed)


def test_probes_come_in_the_order_of_their_cost():
    sides = np.array([0.5, -0.1, 0.3, 0.2])
    flips, costs = probe_order(sides, 16)
    every = sorted((round(sum(s * s for j, s in enumerate(sides) if f >> j & 1), 12), f) for f in range(16))
    assert [(round(c, 12), f) for f, c in zip(flips.tolist(), costs)] == every
    assert probe_order(sides, 5)[0].tolist() == [f for _, f in every[:5]]


def test_lsh_of_odd_vectors(spark, data):
    docs, _, _, d, q = data
    broken = q.unionByName(spark.createDataFrame([(900, None)], "qid long, qvec array<double>"))
    assert 900 not in collect(search_lsh(broken, d, 2))
    assert search_lsh(q, d.where("doc_id < 0"), 2).count() == 0 and search_lsh(q.where("qid < 0"), d, 2).count() == 0
    same = spark.createDataFrame([(i, [1.0] + [0.0] * (DIM - 1)) for i in range(300)], "doc_id long, dvec array<double>")
    assert collect(search_lsh(query_frame(spark, [np.eye(DIM)[0]]), same, 3))[0] == [0, 1, 2]


def test_registered_lsh_reaches_its_recall(spark):
    data = "/root/testdata/sf0.001"
    exact, found = ({(r.qid, r.doc_id) for r in q(spark, data).collect()} for q in (catalog.search_topk, catalog.search_lsh))
    assert len(exact & found) >= 0.9 * len(exact)
    assert catalog.search_lsh_recall(spark, data).first().recall == 0.9
    assert catalog.search_lsh_clustered(spark, data).first()[1:] == (0.9, 0.3)


def test_vector_functions(spark):
    frame = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [1.0, 0.0])], "a array<float>, z array<float>, b array<double>")
    r = frame.select(
        vx.dot(F.col("a"), F.col("b")).alias("dot"),
        vx.cosine(F.col("a"), F.col("b")).alias("cos"),
        vx.cosine(F.col("a"), F.col("z")).alias("none"),
        vx.l2_normalize(F.col("a")).alias("unit"),
        vx.l2_normalize(F.col("z")).alias("zero"),
    ).first()
    assert r["dot"] == 3.0 and r["cos"] == pytest.approx(0.6) and r["none"] is None
    assert r["unit"] == pytest.approx([0.6, 0.8]) and r["zero"] == [0.0, 0.0]


def test_format_hits_defaults(spark):
    hits = spark.createDataFrame([(1, 10, 0.123456, 1), (1, 11, 0.1, 2), (1, 12, 0.05, 3)],
                                 "qid long, doc_id long, similarity double, rank long")
    store = spark.createDataFrame(
        [(10, "t", "news", 4, '{"4": 0.9, "2": 0.1}'), (11, "u", None, None, "not json"), (12, "v", "x", 1, None)],
        "doc_id long, document string, category string, dominant_cluster int, cluster_distribution string",
    )
    rows = format_hits(hits, store).orderBy("rank").collect()
    assert rows[0]["id"] == "doc_10" and rows[0]["similarity"] == 0.1235
    assert rows[0]["cluster_distribution"] == {4: 0.9, 2: 0.1}
    assert rows[1]["category"] == "unknown" and rows[1]["dominant_cluster"] == -1
    assert rows[1]["cluster_distribution"] is None and rows[2]["cluster_distribution"] is None
