"""Exact top-k between two vector tables, in three forms.

``scanned_topk``: query tiles of bounded bytes go to all tasks, one after the other, and the documents
are read in place, once a tile; nothing but the best ``k`` of a task leaves it. Products are made in
small tiles, and a tile of documents whose centre and radius leave no chance to beat the ``k``
best found so far is not multiplied. Once ``k`` are known of every query, products in single precision
with a bound on their error tell which cells may be among the best; only those are computed in double.

``celled_topk``, for queries as many as documents: a fragment-and-replicate join. Both sides are cut into blocks
of bounded size; each pair of blocks meets in one task, and no vector passes through the driver.

``blocked_topk``, within groups: the same, whatever the size of a group. In no form is a pair of
rows materialised beyond the ``k`` survivors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema

from sembra.functions.vectors import as_double, matrix
from sembra.session import lookup_join, materialize, scratch_path

QUERY_BLOCK_ROWS = 2_048
DOC_BLOCK_ROWS = 8_192
#: Rows of a block of either side where queries are as many as documents.
CELL_ROWS = 32_768
#: Bytes of the query vectors that travel to the tasks at once.
TILE_BYTES = 8 << 20
#: Queries of one product, and its cells.
PRODUCT_QUERIES, PRODUCT_CELLS = 512, 1 << 20
#: Documents of the first product, before anything is known of the best.
FIRST_DOCS = 256
#: Cells of a product in single precision, which stay in a core's cache, and the longest vectors it is used for.
SINGLE_CELLS, SINGLE_LENGTH = 1 << 18, 1e15

# Similarities are compared at this many digits so that copies of one vector tie exactly and
# the tie-break column decides; the reported value is not rounded.
RANK_DIGITS = 12


def best_per_row(sims: np.ndarray, ties: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column indexes of the ``k`` best columns in every row of ``sims``."""
    k = min(k, sims.shape[1])
    kth = np.partition(sims, sims.shape[1] - k, axis=1)[:, -k]
    # Only what can equal the k-th best value after rounding is rounded and ordered.
    rows, cols = np.nonzero(sims >= kth[:, None] - 2 * 10.0**-RANK_DIGITS)
    order = np.lexsort((ties[cols], -np.round(sims[rows, cols], RANK_DIGITS), rows))
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - first < k
    return rows[keep], cols[keep]


class Best:
    """The ``k`` best documents so far of every row of ``asked``, from products of bounded size."""

    def __init__(self, asked: np.ndarray, k: int):
        self.asked, self.k = asked, k
        self.lengths = np.linalg.norm(asked, axis=1)
        self.single = asked.astype(np.float32) if len(asked) and self.lengths.max() < SINGLE_LENGTH else None
        self.kth = np.full(len(asked), -np.inf)
        #: ``row`` of ``asked``, ``doc_id``, ``tie``, ``similarity``; ordered by row and rank.
        self.found: pa.Table | None = None

    def products(self, x: np.ndarray, docs: pa.Table, rows: np.ndarray) -> Iterator[tuple]:
        """What is to be multiplied: rows of ``asked``, documents, and which of the cells count (all: None)."""
        for at in range(0, len(rows), PRODUCT_QUERIES):
            yield rows[at : at + PRODUCT_QUERIES], slice(0, len(x)), None

    def add(self, x: np.ndarray, docs: pa.Table) -> None:
        """Look through documents with vectors ``x``; ``docs`` has ``doc_id`` and ``tie``."""
        if not len(self.asked):
            return
        step = max(1, PRODUCT_CELLS // min(PRODUCT_QUERIES, len(self.asked)))
        waiting: list[pa.Table] = []
        # A few documents first, ordered whole: from then on most cells are told off by one comparison.
        start, size = 0, step if np.isfinite(self.kth).all() else min(step, FIRST_DOCS)
        while start < len(x):
            waiting.extend(self._part(x[start : start + size], docs.slice(start, size)))
            start, size = start + size, min(step, 2 * size)
            # As many new rows as there can be best ones: sorting stays a share of multiplying.
            if sum(t.num_rows for t in waiting) >= self.k * len(self.asked):
                self._merge(waiting)
                waiting = []
        self._merge(waiting)

    def _part(self, x: np.ndarray, docs: pa.Table) -> Iterator[pa.Table]:
        ties = docs["tie"].to_numpy(zero_copy_only=False)
        centre = x.mean(axis=0)
        radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))
        most = self.asked @ centre + self.lengths * radius
        open_ = np.flatnonzero(most * (1 + np.sign(most) * 1e-9) + 1e-9 >= self.kth)
        longest = float(np.sqrt((x**2).sum(axis=1).max()))
        single = x.astype(np.float32) if self.single is not None and longest < SINGLE_LENGTH else None
        for some, among, counts in self.products(x, docs, open_):
            floor = self.kth[some] - 2 * 10.0**-RANK_DIGITS
            found = None
            if single is not None and counts is None and np.isfinite(floor).all():
                found = self._near(some, x[among], single[among], floor, longest)
            if found is None:
                sims = self.asked[some] @ x[among].T
                if counts is not None:
                    sims[~counts] = -np.inf
                rows, cols = above(sims, ties[among], self.k, floor)
                found = rows, cols, sims[rows, cols]
            rows, cols, similarity = found
            taken = pa.array(cols + among.start)
            yield pa.table(
                {
                    "row": pa.array(some[rows]),
                    "doc_id": docs["doc_id"].take(taken),
                    "tie": docs["tie"].take(taken),
                    "similarity": pa.array(similarity),
                }
            )

    def _near(self, some: np.ndarray, x: np.ndarray, single: np.ndarray, floor: np.ndarray, longest: float) -> tuple | None:
        """Rows, columns and similarities of the cells that are not below ``floor``; ``None`` if they are too many.

        A product in single precision is off by less than ``error``, so no such cell is passed over.
        """
        error = (x.shape[1] + 8) * 2.0**-23 * self.lengths[some] * longest
        least = np.nextafter((floor - error).astype(np.float32), np.float32(-np.inf))[:, None]
        asked, most = self.single[some], 4 * self.k * len(some)
        step, total, parts = max(1, SINGLE_CELLS // max(1, len(some))), 0, []
        for start in range(0, len(x), step):
            cells = asked @ single[start : start + step].T >= least
            rows, cols = np.divmod(np.flatnonzero(cells), cells.shape[1])
            total += len(rows)
            if total > most:
                return None
            parts.append((rows, cols + start))
        rows, cols = (np.concatenate(c) for c in zip(*parts))
        similarity = np.einsum("ij,ij->i", self.asked[some[rows]], x[cols])
        good = similarity >= floor[rows]
        return rows[good], cols[good], similarity[good]

    def _merge(self, parts: list[pa.Table]) -> None:
        if not parts:
            return
        self.found = _merge(pa.concat_tables(parts if self.found is None else [self.found, *parts]), self.k)
        found = self.found["row"].to_numpy()
        full = np.flatnonzero(np.bincount(found, minlength=len(self.asked)) >= self.k)
        # Rows are ordered by query and rank: the last one of a query is its worst.
        self.kth[full] = self.found["similarity"].to_numpy()[np.searchsorted(found, full, "right") - 1]

    def table(self, asked: pa.Table, names: list[str]) -> pa.Table | None:
        """The best so far, with the columns ``names`` of ``asked`` beside those of the documents."""
        if self.found is None:
            return None
        rows = self.found["row"].combine_chunks()
        out = {c: self.found[c] if c in ("doc_id", "tie", "similarity") else asked[c].combine_chunks().take(rows) for c in names}
        return pa.table(out).combine_chunks()


def above(sims: np.ndarray, ties: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of cells that are not below the ``floor`` of their row, at least the ``k`` best."""
    if np.isfinite(floor).all():
        rows, cols = np.nonzero(sims >= floor[:, None])
        if len(rows) <= 4 * k * len(sims):
            return rows, cols
    rows, cols = best_per_row(sims, ties, k)
    good = (sims[rows, cols] >= floor[rows]) & (sims[rows, cols] > -np.inf)
    return rows[good], cols[good]


def _with_block(df: DataFrame, id_col: str, n_own: str, own: str, n_other: str, other: str) -> DataFrame:
    """Give each row its own block and repeat it for every block of the other side."""
    return df.withColumn(own, F.pmod(F.xxhash64(id_col), F.col(n_own))).withColumn(
        other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n_other) - 1))
    )


def blocked_topk(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    group: list[str] | None = None,
    query_block_rows: int = QUERY_BLOCK_ROWS,
    doc_block_rows: int = DOC_BLOCK_ROWS,
) -> DataFrame:
    """Best ``k`` docs per query, within equal ``group`` values if given.

    ``queries(qid, qvec[, group])`` and ``docs(doc_id, dvec, tie[, group])``; ``(qid, group)``
    may repeat a ``qid`` over groups. Returns candidates ``qid, [group,] doc_id, tie,
    similarity``: the ``k`` best of every block, for the caller to rank.
    """
    keys = list(group or [])
    queries = queries.where(F.col("qvec").isNotNull()).select("qid", *keys, as_double(F.col("qvec")).alias("qvec"))
    docs = docs.where(F.col("dvec").isNotNull()).select(
        "doc_id", "tie", *keys, as_double(F.col("dvec")).alias("dvec")
    )
    blocks = lambda rows: F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("long")
    q_size = queries.groupBy(*keys).agg(blocks(query_block_rows).alias("_nq"))
    d_size = docs.groupBy(*keys).agg(blocks(doc_block_rows).alias("_nd"))
    if keys:
        sizes = q_size.join(d_size, keys)
        q = lookup_join(queries, sizes, keys, spread_by="qid")
        d = lookup_join(docs, sizes, keys, spread_by="doc_id")
    else:
        n_q, n_d = q_size.first()[0], d_size.first()[0]
        q = queries.withColumns({"_nq": F.lit(n_q), "_nd": F.lit(n_d)})
        d = docs.withColumns({"_nq": F.lit(n_q), "_nd": F.lit(n_d)})
    q = _with_block(q, "qid", "_nq", "_qb", "_nd", "_db").drop("_nq", "_nd")
    d = _with_block(d, "doc_id", "_nd", "_db", "_nq", "_qb").drop("_nq", "_nd")

    cell = [*keys, "_qb", "_db"]
    schema = T.StructType(
        [queries.schema["qid"]]
        + [queries.schema[c] for c in keys]
        + [docs.schema["doc_id"], docs.schema["tie"], T.StructField("similarity", T.DoubleType())]
    )
    names = schema.fieldNames()

    def cell_topk(left: pa.Table, right: pa.Table) -> pa.Table:
        best = Best(matrix(left["qvec"]), k)
        if left.num_rows and right.num_rows:
            best.add(matrix(right["dvec"]), right)
        found = best.table(left, names)
        return to_arrow_schema(schema).empty_table() if found is None else found

    return q.groupBy(*cell).cogroup(d.groupBy(*cell)).applyInArrow(cell_topk, schema)


def numbers(df: DataFrame, vector: str) -> Column:
    """A vector column as it travels: single precision is widened where it is multiplied."""
    narrow = df.schema[vector].dataType == T.ArrayType(T.FloatType(), df.schema[vector].dataType.containsNull)
    return F.col(vector) if narrow else as_double(F.col(vector)).alias(vector)


def cell_sides(spark: SparkSession, n_queries: int, n_docs: int) -> tuple[int, int]:
    """How many blocks both sides are cut into: of at most ``CELL_ROWS``, and cells for all cores."""
    side = math.ceil(math.sqrt(2 * spark.sparkContext.defaultParallelism))
    return tuple(max(1, -(-n // CELL_ROWS), min(side, -(-n // QUERY_BLOCK_ROWS))) for n in (n_queries, n_docs))


def celled_topk(
    queries: DataFrame, docs: DataFrame, k: int, rows: int, scorer: Callable[[pa.Table, int], Best] | None = None
) -> DataFrame | None:
    """Best ``k`` docs per query and block of docs: ``qid, doc_id, tie, similarity``, for the caller to rank.

    ``queries(qid, qvec)`` and ``docs(doc_id, dvec, tie)``. Each pair of blocks meets in one task, which takes
    ``rows`` queries at a time; ``scorer`` makes their :class:`Best`. Documents with a column ``_db`` have their
    block already, and then both sides are written tables. ``None`` if there is no query or no document.
    """
    spark = docs.sparkSession
    dealt, q, d = "_db" in docs.columns, queries, docs
    if not dealt:
        q = materialize(queries.where(F.col("qvec").isNotNull()).withColumn("qvec", numbers(queries, "qvec")), "queries")
        d = materialize(docs.where(F.col("dvec").isNotNull()).withColumn("dvec", numbers(docs, "dvec")), "docs")
    n_queries, n_docs = q.count(), d.count()
    if not n_queries or not n_docs:
        return None
    n_q, n_d = cell_sides(spark, n_queries, n_docs)
    if dealt:
        n_d = d.agg(F.max("_db")).first()[0] + 1
    else:
        d = d.withColumn("_db", F.pmod(F.xxhash64("doc_id"), F.lit(n_d)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    q = q.withColumn("_qb", F.pmod(F.xxhash64("qid", "qvec"), F.lit(n_q))).withColumn("_db", every(n_d))
    d = d.withColumn("_db", F.col("_db").cast("long")).withColumn("_qb", every(n_q))
    schema = T.StructType([q.schema["qid"], d.schema["doc_id"], d.schema["tie"], T.StructField("similarity", T.DoubleType())])
    names = schema.fieldNames()

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [to_arrow_schema(schema).empty_table()]
        if right.num_rows:
            if "bucket" in right.column_names:
                right = right.sort_by("bucket")
            x = matrix(right["dvec"])
            for start in range(0, left.num_rows, rows):
                tile = left.slice(start, rows)
                best = scorer(tile, k) if scorer else Best(matrix(tile["qvec"]), k)
                best.add(x, right)
                found = best.table(tile, names)
                if found is not None:
                    out.append(found.cast(out[0].schema))
        return pa.concat_tables(out)

    return q.groupBy("_qb", "_db").cogroup(d.groupBy("_qb", "_db")).applyInArrow(cell, schema)


def tile_rows(docs: DataFrame) -> int:
    """How many queries for these documents make a tile of ``TILE_BYTES``."""
    first = docs.where(F.col("dvec").isNotNull()).select(F.size("dvec").alias("d")).first()
    return max(1, TILE_BYTES // (8 * max(1, first["d"] if first else 1)))


def scanned_topk(queries: DataFrame, docs: DataFrame, k: int, rows: int | None = None) -> DataFrame | None:
    """Best ``k`` docs per query and task: ``qid, doc_id, tie, similarity``, for the caller to rank.

    ``queries(qid, qvec)``, ``docs(doc_id, dvec, tie)``. A batch of at most ``rows`` queries (by default a
    tile's) is one scan. Larger ones are written in tiles of so many; each tile is one scan, whose
    result is written before the next tile travels. ``None`` if there is no query.
    """
    rows = rows or tile_rows(docs)
    valid = queries.where(F.col("qvec").isNotNull()).select("qid", as_double(F.col("qvec")).alias("qvec"))
    head = valid.limit(rows + 1).toArrow()
    if head.num_rows == 0:
        return None
    if head.num_rows <= rows:
        return tile_topk(head, docs, k)
    spark = docs.sparkSession
    whole = materialize(valid, "queries")
    # Fixed and dealt out once: else every tile would repeat the joins that the documents come from.
    docs = materialize(docs.repartition(2 * spark.sparkContext.defaultParallelism), "docs")
    path, out = scratch_path(spark, "query-tiles"), scratch_path(spark, "tile-hits")
    # A file is a tile: the writer starts a new one when it holds enough rows.
    whole.repartition(-(-whole.count() // rows)).write.option("maxRecordsPerFile", rows).parquet(path)
    for tile in spark.read.parquet(path).inputFiles():
        asked = spark.read.schema(whole.schema).parquet(tile).toArrow()
        if asked.num_rows:
            found = tile_topk(asked, docs, k)
            found.write.mode("append").parquet(out)
    return spark.read.schema(found.schema).parquet(out)


def tile_topk(queries: pa.Table, docs: DataFrame, k: int) -> DataFrame:
    """``scanned_topk`` of one tile of queries, which sits in every task."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)
    schema = T.StructType(
        [
            from_arrow_field("qid", queries),
            docs.schema["doc_id"],
            docs.schema["tie"],
            T.StructField("similarity", T.DoubleType()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(matrix(shared.value["qvec"]), k)
        for batch in batches:
            best.add(matrix(batch["dvec"]), pa.Table.from_batches([batch]))
        out = best.table(shared.value, schema.fieldNames())
        if out is not None:
            yield from out.to_batches()

    source = docs.where(F.col("dvec").isNotNull()).select(
        "doc_id", as_double(F.col("dvec")).alias("dvec"), "tie"
    )
    return source.mapInArrow(scan, schema)


def _merge(table: pa.Table, k: int) -> pa.Table:
    q = table["row"].to_numpy()
    rank = -np.round(table["similarity"].to_numpy(), RANK_DIGITS)
    order = np.lexsort((table["tie"].to_numpy(), rank, q))
    q = q[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
    return table.take(pa.array(order[keep]))


def from_arrow_field(name: str, table: pa.Table) -> T.StructField:
    return T.StructField(name, from_arrow_type(table.schema.field(name).type))


def rank_order(similarity: Column, *ties: Column) -> list[Column]:
    return [F.round(similarity, RANK_DIGITS).desc(), *ties]
