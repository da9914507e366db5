"""Sequential cache semantics per tenant, in batch: every query sees all earlier ones.

Which entry answers a query depends on every earlier query of the tenant, so one tenant's log
is sequential by nature; tenants are independent. Spark sorts the log by tenant and sequence, and a
task reads its tenants' rows as a stream, a block at a time, with the entries of one tenant (at most
``max_size``) in hand. No task ever holds more than one block and one set of entries. A cache shared by everybody is :mod:`sembra.streaming.shared`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sembra.functions.text import cache_key
from sembra.functions.vectors import as_double
from sembra.operators.cache import MAX_SIZE, SEARCH_DEPTH, SEQUENCE_BLOCK_ROWS, THRESHOLD
from sembra.streaming.entries import TenantEntries

LOG_FIELDS = (
    "seq long, op string, hit boolean, matched_key string, matched_query string, score double,"
    " answer_seq long, removed long"
)
LOG_NAMES = [f.split()[0] for f in LOG_FIELDS.split(", ")]


def prepare_log(log: DataFrame) -> DataFrame:
    """``tenant, seq, op, query, embedding, dominant_cluster, cluster_distribution`` plus ``key``.

    ``op`` is ``query`` (the default when the column is missing) or ``clear``.
    """
    op = F.coalesce(F.col("op"), F.lit("query")) if "op" in log.columns else F.lit("query")
    return log.select(
        "tenant",
        "seq",
        op.alias("op"),
        "query",
        cache_key(F.col("query")).alias("key"),
        as_double(F.col("embedding")).alias("embedding"),
        F.col("dominant_cluster").cast("int").alias("dominant_cluster"),
        F.col("cluster_distribution").cast("map<int,double>").alias("cluster_distribution"),
    )


def run_rows(cache: TenantEntries, rows: pd.DataFrame) -> pd.DataFrame:
    """Apply rows in ``seq`` order: look up, and on a miss store the query's own answer."""
    out = []
    for row in rows.sort_values("seq").itertuples(index=False):
        if row.op == "clear":
            out.append((row.seq, "clear", None, None, None, None, None, cache.clear()))
            continue
        vector = np.asarray(row.embedding, dtype=np.float64)
        distribution = dict(row.cluster_distribution) if row.cluster_distribution is not None else None
        found = cache.lookup(row.key, vector, row.dominant_cluster, distribution, row.seq)
        if found:
            key, entry, score = found
            out.append((row.seq, "query", True, key, entry.query_text, score, entry.answer_seq, None))
        else:
            cache.store(row.key, row.query, vector, row.dominant_cluster, row.seq)
            out.append((row.seq, "query", False, None, None, None, row.seq, None))
    frame = pd.DataFrame(out, columns=LOG_NAMES)
    for name in ("answer_seq", "removed"):
        frame[name] = frame[name].astype("Int64")
    frame["hit"] = frame["hit"].astype("boolean")
    return frame


def semantic_cache_replay(
    log: DataFrame,
    threshold: float = THRESHOLD,
    max_size: int = MAX_SIZE,
    depth: int = SEARCH_DEPTH,
    block_rows: int = SEQUENCE_BLOCK_ROWS,
) -> DataFrame:
    """Replay every tenant's log; one output row per input row.

    ``answer_seq`` names the query whose stored result answers this one; a ``clear`` row
    reports the number of entries ``removed``.
    """
    prepared = prepare_log(log)
    tenant = prepared.schema["tenant"].dataType.simpleString()
    schema = T.StructType.fromDDL(f"tenant {tenant}, {LOG_FIELDS}")

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(schema)
        cache, of = None, object()
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                rows = batch.slice(start, block_rows).to_pandas(date_as_object=True, maps_as_pydicts="lossy")
                # Runs of one tenant, in the order of the sort.
                runs = rows["tenant"].ne(rows["tenant"].shift()).cumsum()
                for _, run in rows.groupby(runs.to_numpy(), sort=False):
                    name = batch.column("tenant")[start + int(run.index[0])].as_py()
                    if cache is None or name != of:
                        cache, of = TenantEntries(threshold, max_size, depth), name
                    played = run_rows(cache, run).astype(object)
                    played = played.where(played.notna(), None).assign(tenant=pd.Series([name] * len(played), dtype=object))
                    columns = [pa.array(list(played[f.name]), f.type) for f in types]
                    yield pa.RecordBatch.from_arrays(columns, schema=types)

    # A row without a tenant belongs to no cache.
    ordered = prepared.where(F.col("tenant").isNotNull()).repartition("tenant").sortWithinPartitions("tenant", "seq")
    return ordered.mapInArrow(replay, schema)
