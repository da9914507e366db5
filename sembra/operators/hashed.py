"""Approximate nearest neighbours: one table of signed projections, probed in the order of each query.

A document lies in one bucket, named by the signs of ``bits`` random projections around their
medians; ``bits`` grows with the table, so that buckets keep their size. A query probes buckets in the
order of how far it would have to move to fall into them (the squared distances to the planes that
separate it from them, added up), starting with its own. How many buckets are probed is not guessed:
a bounded sample of the queries is searched exactly, and the number is the least with which the
asked share of their neighbours is met. So no pair is multiplied twice, structured vectors are read
in small part, and vectors without structure cost nearly an exact search instead of their neighbours.

A query carries no list of its buckets: the cost of the last one it probes tells for every bucket
whether it is among them. Documents are dealt by bucket into blocks of bounded size, queries meet
blocks as in an exact search (``blocks.celled_topk``), and multiply what lies in probed buckets only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sembra.functions.vectors import as_double, matrix
from sembra.operators.blocks import PRODUCT_CELLS, PRODUCT_QUERIES, Best, numbers
from sembra.session import materialize

BUCKET_ROWS = 16
MAX_BITS = 18
#: Rows that medians are taken from, and queries that the number of probes is calibrated with.
CUT_SAMPLE, PROBE_SAMPLE = 4_096, 256
#: Queries whose buckets are found at once, and the share of pairs from which all are multiplied.
PROBING_QUERIES, DENSE_SHARE = 4_096, 0.2


@dataclass(frozen=True)
class HashPlan:
    planes: np.ndarray  # dimensions x bits
    cuts: np.ndarray  # bits
    probes: int = 1

    @property
    def bits(self) -> int:
        return self.planes.shape[1]

    def sides(self, x: np.ndarray) -> np.ndarray:
        """Signed distances of rows to the planes."""
        return x @ self.planes - self.cuts

    def codes(self, sides: np.ndarray) -> np.ndarray:
        return (sides > 0) @ (1 << np.arange(self.bits, dtype=np.int64))


def probe_order(sides: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` nearest buckets of one query, as differences of code bits, with their costs.

    Planes are taken from near to far. A set of crossed planes that is not among the ``most`` cheapest
    of the planes so far is in none of the later ones, so lists stay short.
    """
    squares = sides * sides
    flips, costs = np.zeros(1, np.int64), np.zeros(1)
    for bit in np.argsort(squares, kind="stable"):
        flips = np.concatenate([flips, flips | (1 << int(bit))])
        costs = np.concatenate([costs, costs + squares[bit]])
        if len(costs) > most:
            kept = np.lexsort((flips, costs))[:most]
            flips, costs = flips[kept], costs[kept]
    order = np.lexsort((flips, costs))
    return flips[order], costs[order]


def make_plan(docs: DataFrame, seed: int, bucket_rows: int = BUCKET_ROWS) -> HashPlan | None:
    """Planes through the medians of a bounded sample; ``None`` for a table without vectors."""
    known = docs.where(F.col("dvec").isNotNull())
    n, dim = known.agg(F.count(F.lit(1)), F.max(F.size("dvec"))).first()
    if not n:
        return None
    bits = min(MAX_BITS, max(1, round(math.log2(max(2, n / bucket_rows)))))
    planes = np.random.default_rng(seed).normal(size=(dim, bits))
    planes /= np.linalg.norm(planes, axis=0)
    sample = known.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(CUT_SAMPLE)
    rows = matrix(sample.select(as_double(F.col("dvec")).alias("v")).toArrow()["v"])
    return HashPlan(planes, np.median(rows @ planes, axis=0))


def needed_probes(plan: HashPlan, exact: pa.Table, recall: float) -> int:
    """The least number of probes with which ``recall`` of the pairs (qvec, dvec) of ``exact`` meet."""
    if exact.num_rows == 0:
        return 1
    queries, found = plan.sides(matrix(exact["qvec"])), plan.sides(matrix(exact["dvec"]))
    ranks, orders = [], {}
    for q, d in zip(queries, found):
        name = q.tobytes()
        if name not in orders:
            orders[name] = probe_order(q, 1 << plan.bits)[1]
        crossed = (q > 0) != (d > 0)
        ranks.append(np.searchsorted(orders[name], (q * q)[crossed].sum() * (1 + 1e-12), "right"))
    return int(np.sort(ranks)[math.ceil(recall * len(ranks)) - 1])


def hashed_docs(docs: DataFrame, plan: HashPlan, blocks: int) -> DataFrame:
    """(doc_id, dvec, tie, bucket, _db) of the documents with a vector, dealt into ranges of buckets.

    A bucket with very many documents is cut between them.
    """
    known = docs.where(F.col("dvec").isNotNull()).select("doc_id", numbers(docs, "dvec"))
    schema = T.StructType([*known.schema.fields, T.StructField("bucket", T.LongType())])

    def run(batches):
        types = to_arrow_schema(schema)
        for batch in batches:
            codes = plan.codes(plan.sides(matrix(batch.column(1)))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int64())], schema=types)

    # Written before it is dealt: ranges are found by a look at the rows, which would hash them twice.
    hashed = materialize(known.mapInArrow(run, schema).withColumn("tie", F.col("doc_id")), "hashed")
    return hashed.repartitionByRange(blocks, "bucket", "doc_id").withColumn("_db", F.spark_partition_id())


def last_costs(plan: HashPlan, sides: np.ndarray) -> np.ndarray:
    """The cost of the last bucket that each query probes, with what rounding may add to it."""
    squares, every = sides * sides, 1 << plan.bits
    last = np.empty(len(sides))
    if plan.probes >= every:
        last[:] = np.inf
    elif 8 * plan.probes < every:
        for i, row in enumerate(sides):
            last[i] = probe_order(row, plan.probes)[1][-1]
    else:
        for i, row in enumerate(squares):
            costs = np.zeros(1)
            for square in row:
                costs = np.concatenate([costs, costs + square])
            last[i] = np.partition(costs, plan.probes - 1)[plan.probes - 1]
    return last + 1e-12 * squares.sum(1)


def probing_queries(queries: DataFrame, plan: HashPlan) -> DataFrame:
    """(qid, qvec, reach): the queries with a vector, and the cost of the last bucket they probe."""
    known = queries.where(F.col("qvec").isNotNull()).select("qid", numbers(queries, "qvec"))
    schema = T.StructType([*known.schema.fields, T.StructField("reach", T.DoubleType())])

    def run(batches):
        types = to_arrow_schema(schema)
        for batch in batches:
            reach = last_costs(plan, plan.sides(matrix(batch.column(1)))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reach, pa.float64())], schema=types)

    return known.mapInArrow(run, schema)


def probed(plan: HashPlan, sides: np.ndarray, reach: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Which of ``buckets`` each query probes."""
    own = sides > 0
    squares = sides * sides
    crossed = ((buckets[:, None] >> np.arange(plan.bits)) & 1).astype(np.float64)
    # Planes with the query on their other side: squares where the bits differ.
    costs = (squares * own).sum(1)[:, None] + (squares * np.where(own, -1.0, 1.0)) @ crossed.T
    return costs <= reach[:, None]


class ProbedBest(Best):
    """:class:`Best` among the documents of probed buckets; documents come in the order of buckets."""

    def __init__(self, plan: HashPlan, asked: np.ndarray, reach: np.ndarray, k: int):
        super().__init__(asked, k)
        self.plan, self.sides, self.reach = plan, plan.sides(asked) if len(asked) else asked, reach

    def products(self, x: np.ndarray, docs: pa.Table, rows: np.ndarray):
        codes = docs["bucket"].to_numpy()
        buckets, starts, sizes = np.unique(codes, return_index=True, return_counts=True)
        for at in range(0, len(rows), PROBING_QUERIES):
            some = rows[at : at + PROBING_QUERIES]
            met = probed(self.plan, self.sides[some], self.reach[some], buckets)
            shares = met.sum(0) / len(some)
            if (shares * sizes).sum() > DENSE_SHARE * len(x):
                for first in range(0, len(some), PRODUCT_QUERIES):
                    part = slice(first, first + PRODUCT_QUERIES)
                    yield some[part], slice(0, len(x)), np.repeat(met[part], sizes, axis=1)
                continue
            for b in np.flatnonzero(shares):
                asking, most = some[met[:, b]], max(1, PRODUCT_CELLS // int(sizes[b]))
                for first in range(0, len(asking), most):
                    yield asking[first : first + most], slice(int(starts[b]), int(starts[b] + sizes[b])), None


def candidate_share(queries: DataFrame, docs: DataFrame, plan: HashPlan) -> float:
    """The share of all pairs of queries and documents that meet in a bucket.

    The numbers of documents a bucket, at most 2 to the ``MAX_BITS``, go to the queries.
    """
    lying = docs.groupBy("bucket").agg(F.count(F.lit(1)).alias("nd")).toArrow()
    buckets, sizes = lying["bucket"].to_numpy(), lying["nd"].to_numpy().astype(np.float64)
    shared = docs.sparkSession.sparkContext.broadcast((buckets, sizes))

    def run(batches):
        buckets, sizes = shared.value
        rows = max(1, PRODUCT_CELLS // max(1, len(buckets)))
        met, n = 0.0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                found = probed(plan, plan.sides(matrix(part["qvec"])), part["reach"].to_numpy(), buckets)
                met, n = met + float((found @ sizes).sum()), n + part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([met]), pa.array([n], pa.int64())], names=["met", "n"])

    met, n = queries.select("qvec", "reach").mapInArrow(run, "met double, n long").agg(F.sum("met"), F.sum("n")).first()
    return (met or 0.0) / max(1.0, float(n or 0) * float(sizes.sum()))
