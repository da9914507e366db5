"""Arrow plumbing shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Letters that contracts lower-case; nothing else changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def map_columns(df: DataFrame, ddl: str, make: Callable[[], Callable]) -> DataFrame:
    """Run a function on lists of column values, one Arrow batch at a time.

    ``make`` is called once per task and returns ``f(*columns) -> columns``; the number of rows
    may change. Spark bounds a batch by rows and by bytes.
    """
    schema = StructType.fromDDL(ddl)

    def run(batches):
        types = to_arrow_schema(schema)
        function = make()
        for batch in batches:
            columns = function(*[c.to_pylist() for c in batch.columns])
            arrays = [pa.array(c, f.type) for c, f in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, schema=types)

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, column: str, make: Callable[[], Callable]) -> DataFrame:
    """Rows for whose ``column`` the predicate made by ``make`` holds; all columns stay as they are."""
    at = df.columns.index(column)

    def run(batches):
        predicate = make()
        for batch in batches:
            mask = [bool(predicate(value)) for value in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key falls in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus, F.lit(0))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(df: DataFrame, label: str, key: str, per_label: int, most_labels: int = 1_000) -> DataFrame:
    """About ``per_label`` rows of each value of ``label`` (all, if fewer), chosen by a hash of ``key``.

    Rates come from exact counts; the same rows are chosen at every run. The sample is of the
    ``most_labels`` most frequent labels, so the table of counts that is sent to all tasks has at
    most so many rows and no text is moved. Adds ``label_rows``, the number of rows that the label
    has in all of ``df``.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("label_rows"))
    counts = F.broadcast(counts.orderBy(F.desc("label_rows"), label).limit(most_labels))
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return df.join(counts, label).where(draw < F.lit(float(per_label)) / F.col("label_rows"))


def map_batches(df: DataFrame, ddl: str, function: Callable) -> DataFrame:
    """Run a generator over a task's batches of column lists; it yields lists of row tuples."""
    schema = StructType.fromDDL(ddl)

    def run(batches):
        types = to_arrow_schema(schema)
        for rows in function([c.to_pylist() for c in b.columns] for b in batches):
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    return df.mapInArrow(run, schema)
