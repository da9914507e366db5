"""Sequential cache semantics per tenant on a stream.

The same rules as :mod:`sembra.streaming.replay`. A tenant's entries live in the state store,
one row per entry, so a micro-batch writes back only what it changed. Rows of a micro-batch are
applied in ``seq`` order; between micro-batches arrival order rules. Limit the micro-batch at
the source (``maxFilesPerTrigger`` and the like): its rows of one tenant meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import sembra
from sembra.operators.cache import MAX_SIZE, SEARCH_DEPTH, THRESHOLD
from sembra.streaming.entries import Entry, TenantEntries
from sembra.streaming.replay import LOG_FIELDS, LOG_NAMES, prepare_log, run_rows

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A micro-batch writes what it changed; whole states are written now and then behind it.
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


class CacheProcessor(StatefulProcessor):
    def __init__(self, threshold: float, max_size: int, depth: int):
        self.threshold, self.max_size, self.depth = threshold, max_size, depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState(
            "entries",
            "key string",
            "query_text string, embedding binary, dominant_cluster int, created_seq long, seq long, answer_seq long",
        )

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        cache = TenantEntries(self.threshold, self.max_size, self.depth)
        stored = [
            (k[0], Entry(v[0], np.frombuffer(v[1], dtype=np.float64), v[2], v[3], v[4], v[5]))
            for k, v in self.state.iterator()
        ]
        cache.load(stored)
        out = run_rows(cache, pd.concat(rows, ignore_index=True))
        known = {k for k, _ in stored}
        for gone in cache.removed & known:
            self.state.removeKey((gone,))
        for changed in cache.changed:
            e = cache.entries[changed]
            self.state.updateValue(
                (changed,),
                (e.query_text, e.embedding.tobytes(), int(e.dominant_cluster), int(e.created_seq), int(e.seq),
                 int(e.answer_seq)),
            )
        yield out.assign(tenant=key[0])[["tenant", *LOG_NAMES]]

    def close(self) -> None:
        pass


def semantic_cache_stream(
    log: DataFrame,
    threshold: float = THRESHOLD,
    max_size: int = MAX_SIZE,
    depth: int = SEARCH_DEPTH,
) -> DataFrame:
    """The log rows of :func:`~sembra.streaming.replay.semantic_cache_replay` for a stream."""
    spark = log.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set(CHANGELOG, "true")
    prepared = prepare_log(log)
    tenant = prepared.schema["tenant"].dataType.simpleString()
    # Spark starts this processor once on the driver, without the session's Python files: its
    # code travels with it.
    cloudpickle.register_pickle_by_value(sembra)
    try:
        return prepared.groupBy("tenant").transformWithStateInPandas(
            statefulProcessor=CacheProcessor(threshold, max_size, depth),
            outputStructType=f"tenant {tenant}, {LOG_FIELDS}",
            outputMode="Append",
            timeMode="None",
        )
    finally:
        cloudpickle.unregister_pickle_by_value(sembra)


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None) -> Iterator[None]:
    """Streams started inside keep their state in ``n`` partitions, by default one a core.

    Every micro-batch opens, plays and commits the state of each partition, empty or not, so their number
    must not follow the session's shuffles, which grow with the tables. It stays as it is for the
    life of a checkpoint.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, n or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.set(name, before)
