"""Searches with as many queries as documents: bounded products, nothing through the driver."""

import numpy as np
import pyarrow as pa
import pytest

from sembra.operators import blocks, search

DIM = 12


@pytest.fixture(scope="module")
def many(spark):
    rows = np.random.RandomState(11).randn(300, DIM)
    rows[20:40] = rows[3]  # copies tie
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "doc_id long, dvec array<double>")
    asked = rows[::-1] + 0.1
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "qid long, qvec array<double>")
    return rows, asked, q, d


def best(rows, asked, k):
    return {i: sorted(range(len(rows)), key=lambda j: (-round(float(rows[j] @ a), 12), j))[:k] for i, a in enumerate(asked)}


def collect(hits):
    out = {}
    for r in hits.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append(r["doc_id"])
    return out


def test_blocked_search_sends_no_queries_through_the_driver(many, monkeypatch):
    """Formerly a job and a broadcast for every tile of queries."""
    rows, asked, q, d = many
    monkeypatch.setattr(blocks, "CELL_ROWS", 70)
    monkeypatch.setattr(blocks, "tile_topk", lambda *a: pytest.fail("a tile went through the driver"))
    assert collect(search.search_topk_blocked(q, d, 4, tile_rows=9)) == best(rows, asked, 4)


def test_documents_of_many_tiles_are_computed_once(many, monkeypatch):
    rows, asked, q, d = many
    plans, original = [], blocks.tile_topk
    monkeypatch.setattr(blocks, "tile_topk", lambda a, docs, k: plans.append(docs._jdf.queryExecution().toString()) or original(a, docs, k))
    joined = d.join(q.selectExpr("qid AS doc_id"), "doc_id")
    assert collect(search.search_topk(q, joined, 4, tile_rows=100)) == best(rows, asked, 4)
    assert len(plans) >= 3 and not any("Join" in p for p in plans)


def test_products_of_a_cell_are_bounded(many, monkeypatch):
    """Formerly one product of the whole block, with its copies."""
    rows, asked, _, _ = many
    cells, original = [], blocks.above
    monkeypatch.setattr(blocks, "above", lambda sims, *rest: cells.append(sims.size) or original(sims, *rest))
    monkeypatch.setattr(blocks, "PRODUCT_CELLS", 1000)
    monkeypatch.setattr(blocks, "PRODUCT_QUERIES", 50)
    kept = blocks.Best(asked, 4)
    import pyarrow as pa

    ids = pa.table({"doc_id": list(range(300)), "tie": list(range(300))})
    kept.add(rows, ids)
    found = {}
    for r, i in zip(kept.found["row"].to_pylist(), kept.found["doc_id"].to_pylist()):
        found.setdefault(r, []).append(i)
    assert found == best(rows, asked, 4) and max(cells) <= 1000


def test_a_query_moves_once_a_block_however_many_buckets_it_probes(many, monkeypatch):
    """Formerly a copy of its vector for every probed bucket was written."""
    rows, asked, q, d = many
    monkeypatch.setattr(blocks, "CELL_ROWS", 70)
    dealt = search.hashed_search(q, d, 4, probes=16)
    assert dealt.plan.bits == 4 and dealt.queries.count() == len(asked)
    assert collect(dealt.hits(4)) == best(rows, asked, 4) and dealt.candidate_share() == 1.0
    few = search.hashed_search(q, d, 4, probes=3)
    codes, sides = few.plan.codes(few.plan.sides(rows)), few.plan.sides(asked)
    own = few.plan.codes(sides)
    from sembra.operators.hashed import probe_order

    among = [set((c ^ probe_order(s, 3)[0]).tolist()) for c, s in zip(own, sides)]
    allowed = {i: [j for j in range(len(rows)) if int(codes[j]) in among[i]] for i in range(len(asked))}
    wanted = {i: sorted(js, key=lambda j: (-round(float(rows[j] @ asked[i]), 12), j))[:4] for i, js in allowed.items() if js}
    assert collect(few.hits(4)) == wanted
    assert few.candidate_share() == pytest.approx(sum(map(len, allowed.values())) / len(rows) ** 2)


def test_silhouette_moves_rows_once_a_large_block(spark, monkeypatch):
    """Formerly rows were repeated for every 2,048 others; now a task measures so many at a time."""
    from sembra.operators import quality

    draw = np.random.RandomState(2)
    rows = draw.randn(500, 5) + 3.0 * (np.arange(500) % 3)[:, None]
    d = spark.createDataFrame([(i, i % 3, v.tolist()) for i, v in enumerate(rows)], "doc_id long, cluster int, reduced array<double>")
    blocks_of, original = [], quality._block_scores
    monkeypatch.setattr(quality, "_block_scores", lambda p, blocks, rows: blocks_of.append((blocks, rows)) or original(p, blocks, rows))
    found = quality.silhouette(d, per_cluster=1 << 20, block_rows=64).first()
    distances = np.sqrt(((rows[:, None] - rows[None]) ** 2).sum(2))
    sums = np.stack([distances[:, np.arange(500) % 3 == c].sum(1) for c in range(3)], 1)
    sizes, own = np.bincount(np.arange(500) % 3), np.arange(500) % 3
    inside = sums[np.arange(500), own] / (sizes[own] - 1)
    means = sums / sizes
    means[np.arange(500), own] = np.inf
    outside = means.min(1)
    assert found["silhouette"] == pytest.approx(((outside - inside) / np.maximum(inside, outside)).mean())
    assert blocks_of == [(1, 64)]


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e6, 1e20])
def test_single_precision_loses_no_hit(monkeypatch, scale):
    """Cells that cannot be among the best are told in single precision; formerly all were computed in double."""
    draw = np.random.default_rng(3)
    base = draw.normal(size=(40, 16))
    # Near ties beyond single precision, exact copies, and a query without direction.
    docs = np.repeat(base, 150, axis=0) * scale
    docs[::2] *= 1 + draw.integers(0, 50, len(docs[::2]))[:, None] * 1e-10
    docs = np.concatenate([docs, draw.normal(size=(4_000, 16)) * scale])[draw.permutation(len(docs) + 4_000)]
    asked = np.concatenate([draw.normal(size=(700, 16)), np.zeros((1, 16))])
    doubles = []
    plain = blocks.above
    monkeypatch.setattr(blocks, "above", lambda sims, *rest: doubles.append(sims.size) or plain(sims, *rest))
    ids = np.arange(len(docs))
    best = blocks.Best(asked, 5)
    for start in range(0, len(docs), 2_500):
        part = pa.array(ids[start : start + 2_500])
        best.add(docs[start : start + 2_500], pa.table({"doc_id": part, "tie": part}))
    found = best.found
    sims = asked @ docs.T
    for row in range(len(asked)):
        order = np.lexsort((ids, -np.round(sims[row], blocks.RANK_DIGITS)))[:5]
        mine = found.filter(pa.array(found["row"].to_numpy() == row))
        assert np.allclose(mine["similarity"].to_numpy(), sims[row, order], rtol=1e-12, atol=1e-12)
        if scale <= 1:
            assert mine["doc_id"].to_pylist() == order.tolist()
    if scale == 1:
        assert sum(doubles) < 0.7 * sims.size
