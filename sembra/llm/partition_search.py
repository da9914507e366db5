"""Nearest neighbours by learned partitions of a neighbour graph.

On a sample of about ``sample_rows`` vectors (chosen by a hash of the id) the exact neighbour graph
is built and cut into balanced parts: median splits along principal directions give equal parts,
then vertices move to the part that holds most of their neighbours while its size allows. A linear
softmax classifier learns, for a vector, the parts of its neighbours. Every vector of the table is
indexed in its most probable part. A query is routed to its most probable parts; how many is
calibrated on held-out vectors of the sample, so that ``target_recall`` of their true neighbours
lie in the parts visited (all parts, if need be). Inside the parts scores are exact.

The number of parts is fixed by ``parts`` (fewer for samples too small to fill them): the work of a
query grows with the table, as its parts do. Parts are cut into blocks by a hash of the id, queries of a
part into blocks too, and each pair of blocks meets in one task that returns the k best per query; so a
part or a vector that holds a third of all rows becomes more tasks, not a larger one, and of what a
query finds in its blocks every task passes on k rows. Ids are whole numbers.

Vectors that are null, zero, hold null or non-finite components, or have another length than most
vectors take no part, nor do rows with a null id. A query has all candidates if there are fewer
than k. Of equal scores the smaller id wins. Repeated rows are one candidate each; a query id that
is repeated is searched once, with its first vector in the order of its bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sembra.session import materialize

NEIGHBOURS = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Partitioner:
    weights: np.ndarray  # dimensions x parts
    bias: np.ndarray
    probes: int

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.weights + self.bias


@dataclass(frozen=True)
class SearchSettings:
    sample_rows: int = 8_192
    parts: int = 32
    neighbours: int = 20
    target_recall: float = 0.95
    block_rows: int = 16_384
    block_queries: int = 2_048


# --- learning on the sample ---


def neighbour_graph(vectors: np.ndarray, queries: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Rows of the k largest inner products for each query; ``own``: query i is vector i."""
    out = []
    for start in range(0, len(queries), 256):
        scores = queries[start : start + 256] @ vectors.T
        if own:
            at = np.arange(len(scores))
            scores[at, start + at] = -np.inf
        out.append(np.argpartition(-scores, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.05, sweeps: int = 6) -> np.ndarray:
    """Part of each vertex: principal-direction median splits, refined along the graph under a size limit."""
    label = np.zeros(len(vectors), np.int64)
    pending, draw = [(np.arange(len(vectors)), 0, parts)], np.random.default_rng(3)
    while pending:
        rows, first, count = pending.pop()
        if count == 1:
            label[rows] = first
            continue
        centred = vectors[rows] - vectors[rows].mean(0)
        direction = draw.normal(size=vectors.shape[1])
        for _ in range(8):
            direction = centred.T @ (centred @ direction)
            direction /= np.linalg.norm(direction) + 1e-300
        order = rows[np.argsort(centred @ direction, kind="stable")]
        left = count // 2
        cut = len(rows) * left // count
        pending += [(order[:cut], first, left), (order[cut:], first + left, count - left)]
    limit = int(np.ceil(len(vectors) / parts * (1 + slack)))
    sizes = np.bincount(label, minlength=parts)
    for _ in range(sweeps):
        moved = 0
        votes = np.zeros((len(vectors), parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(len(graph)), graph.shape[1]), label[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(label, graph.shape[1])), 1)
        gain = votes.max(1) - votes[np.arange(len(label)), label]
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            best = int(votes[i].argmax())
            if sizes[best] < limit:
                sizes[label[i]] -= 1
                sizes[best] += 1
                label[i] = best
                moved += 1
        if not moved:
            break
    return label


def fit_classifier(vectors: np.ndarray, targets: np.ndarray, epochs: int = 40, batch: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Linear softmax on soft targets by Adam."""
    scale = 1 / (np.sqrt((vectors**2).mean()) + 1e-300)
    x, draw = vectors * scale, np.random.default_rng(9)
    params = [np.zeros((x.shape[1], targets.shape[1])), np.zeros(targets.shape[1])]
    first, second, step = [0.0, 0.0], [0.0, 0.0], 0
    for _ in range(epochs):
        order = draw.permutation(len(x))
        for start in range(0, len(x), batch):
            rows = order[start : start + batch]
            z = x[rows] @ params[0] + params[1]
            p = np.exp(z - z.max(1, keepdims=True))
            g = (p / p.sum(1, keepdims=True) - targets[rows]) / len(rows)
            step += 1
            for i, grad in enumerate((x[rows].T @ g, g.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                params[i] = params[i] - 0.02 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-9)
    return params[0] * scale, params[1]


def fit_partitioner(sample: np.ndarray, settings: SearchSettings = SearchSettings()) -> Partitioner:
    """Graph, parts, classifier and number of probes from the sampled vectors (rows in a fixed order)."""
    held = np.zeros(len(sample), bool)
    held[::10] = len(sample) >= 200
    vectors, queries = sample[~held], sample[held]
    parts = min(settings.parts, len(vectors) // (2 * settings.neighbours))
    if parts < 2:
        return Partitioner(np.zeros((sample.shape[1], 1)), np.zeros(1), 1)
    k = settings.neighbours
    graph = neighbour_graph(vectors, vectors, k, own=True)
    label = balanced_parts(vectors, graph, parts)
    targets = np.zeros((len(vectors), parts))
    np.add.at(targets, (np.repeat(np.arange(len(graph)), k), label[graph].ravel()), 1 / (k + 1))
    targets[np.arange(len(label)), label] += 1 / (k + 1)
    weights, bias = fit_classifier(vectors, targets)
    found = Partitioner(weights, bias, parts)
    placed = found.logits(vectors).argmax(1)
    truth = neighbour_graph(vectors, queries, k, own=False)
    ranking = np.argsort(-found.logits(queries), axis=1)
    place = np.empty_like(ranking)
    np.put_along_axis(place, ranking, np.arange(parts)[None, :].repeat(len(queries), 0), axis=1)
    depth = np.take_along_axis(place, placed[truth], axis=1)  # how many parts come before a neighbour's
    recall = [(depth < p).mean() for p in range(1, parts + 1)]
    probes = next((p + 1 for p, r in enumerate(recall) if r >= settings.target_recall), parts)
    return Partitioner(weights, bias, probes)


# --- search ---


def usable_vectors(vectors: DataFrame, key: str, embedding: str) -> DataFrame:
    """(id, vector as bytes of doubles) of the rows that take part."""
    named = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    bound = F.lit(float("inf"))
    fine = (
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < bound))
        & F.exists("v", lambda x: x != 0)
    )
    sized = named.where(fine)
    common = sized.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").head()
    return sized.where(F.size("v") == (common.d if common else 0))


def sampled_vectors(usable: DataFrame, total: int, rows: int) -> np.ndarray:
    """About ``rows`` vectors on the driver, by a hash of the id, in the order of that hash."""
    draw = F.pmod(F.xxhash64(F.lit("graph"), "id"), F.lit(1 << 30))
    share = min(1.0, rows / max(1, total))
    chosen = usable.where(draw < F.lit(int(share * (1 << 30)))).select(draw.alias("draw"), "id", "v").toPandas()
    chosen = chosen.sort_values(["draw", "id"], kind="stable")
    return np.array(chosen.v.tolist(), dtype=np.float64) if len(chosen) else np.zeros((0, 1))


def assign(usable: DataFrame, model: Partitioner, probes: int) -> DataFrame:
    """(id, vector bytes, part) for the ``probes`` most probable parts of each row."""

    def run(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            x = np.asarray(lists.flatten()).reshape(len(ids), -1) if len(ids) else np.zeros((0, model.weights.shape[0]))
            best = np.argsort(-model.logits(x), axis=1, kind="stable")[:, :probes]
            rows = np.repeat(np.arange(len(ids)), best.shape[1])
            raw = pa.array([v.tobytes() for v in x], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows)), raw.take(pa.array(rows)), pa.array(best.ravel().astype(np.int32))],
                names=["id", "v", "part"],
            )

    return usable.select("id", "v").mapInArrow(run, "id long, v binary, part int")


def block_of(column: str, blocks: str):
    """A number from 0 to ``blocks`` - 1 by a hash of ``column``."""
    return F.pmod(F.xxhash64(F.lit("block"), column), F.col(blocks))


def numbers(blocks: str):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))


def best_in_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """(query, vector, score) of each query's k best rows of a block, its own id left out.

    The dense product only preselects: scores are summed row by row afterwards, so that equal
    vectors get equal scores wherever they stand.
    """
    out = []
    step = max(1, (1 << 22) // max(1, len(ids)))
    for start in range(0, len(queries), step):
        rough = queries[start : start + step] @ vectors.T
        for i, scores in enumerate(rough, start):
            scores[ids == query_ids[i]] = -np.inf
            least = np.partition(scores, -k)[-k] if len(scores) > k else -np.inf
            margin = 1e-9 * (np.abs(least) + 1e-3) if np.isfinite(least) else 0
            near = np.flatnonzero((scores >= least - margin) & (scores > -np.inf))
            exact = (vectors[near] * queries[i]).sum(1)
            order = np.lexsort((ids[near], -exact))[:k]
            out.append((np.full(len(order), query_ids[i]), ids[near[order]], exact[order]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def search(
    queries: DataFrame, vectors: DataFrame, k: int = 20, key: str = "vec_id", embedding: str = "embedding",
    settings: SearchSettings = SearchSettings(),
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query among all ``vectors``."""
    usable = usable_vectors(vectors, key, embedding)
    total = usable.count()
    sample = sampled_vectors(usable, total, settings.sample_rows)
    if not len(sample):
        model = Partitioner(np.zeros((1, 1)), np.zeros(1), 1)
        usable = usable.where(F.lit(False))
    else:
        model = fit_partitioner(sample, settings)
    dimensions = model.weights.shape[0]
    indexed = materialize(assign(usable, model, 1), "partition-index")
    asked = usable_vectors(queries, key, embedding).where(F.size("v") == dimensions)
    asked = asked.groupBy("id").agg(F.min("v").alias("v"))
    routed = materialize(assign(asked, model, model.probes), "partition-routes")
    sizes = indexed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / settings.block_rows).alias("blocks"))
    asks = routed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / settings.block_queries).alias("query_blocks"))
    plan = F.broadcast(sizes.join(asks, "part"))  # at most ``parts`` rows
    left = routed.join(plan, "part").select(
        "part", numbers("blocks").alias("block"), block_of("id", "query_blocks").alias("query_block"), "id", "v"
    )
    right = indexed.join(plan, "part").select(
        "part", block_of("id", "blocks").alias("block"), numbers("query_blocks").alias("query_block"), "id", "v"
    )
    cell = ["part", "block", "query_block"]

    def meet(asked_rows: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asked_rows) or not len(rows):
            found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        else:
            q = np.frombuffer(b"".join(asked_rows.v), np.float64).reshape(len(asked_rows), -1)
            x = np.frombuffer(b"".join(rows.v), np.float64).reshape(len(rows), -1)
            found = best_in_block(q, asked_rows.id.to_numpy(), x, rows.id.to_numpy(), k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    met = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(meet, NEIGHBOURS)
    # Every task passes on its k best of a query only: the limit is applied before rows are exchanged too.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
