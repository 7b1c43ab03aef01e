"""Incremental ingest of new survey sheets.

The source project processes sheets in batch only; this module lets the same
stateless normalisation operators run on files as they arrive (Structured
Streaming file source, exactly-once parquet sink with a checkpoint).  No
stateful streaming operator is needed: everything downstream (diffs, metrics)
runs in batch on the ingested table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_stream(spark: SparkSession, source_dir: str, schema: T.StructType | str,
                  sink_dir: str, checkpoint_dir: str,
                  transform: Callable[[DataFrame], DataFrame] = lambda d: d,
                  fmt: str = "csv", available_now: bool = True, partition_by: tuple[str, ...] = ()):
    """Read new files of ``source_dir`` (explicit schema, no inference), apply
    a stateless ``transform`` and append to a parquet table at ``sink_dir``.

    ``available_now`` processes what is there and stops (batch-like runs);
    otherwise the query keeps running.  Returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = transform(reader.format(fmt).load(source_dir))
    w = (stream.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
