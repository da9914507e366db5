"""Index documents as they arrive, with models fitted before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sembra.operators.encode import Encoder, HashingEncoder
from sembra.operators.mixture import Mixture
from sembra.plans.index import index_rows


def stream_ingest(
    stream: DataFrame,
    pca: PipelineModel,
    mixture: Mixture,
    path: str,
    checkpoint: str,
    encoder: Callable[[], Encoder] = HashingEncoder,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Clean, embed and assign every arriving document and append it to the store at ``path``.

    All steps are row by row, so the stream keeps no state. ``trigger`` holds the arguments of
    ``DataStreamWriter.trigger``; by default what has arrived is indexed and the stream ends.
    """
    rows = index_rows(stream, pca, mixture, encoder)
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
