"""Arriving files through clean, stamp, validate and append, with a checkpoint instead of a watermark row."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.clean import clean_table
from tidemark.operators.sink import ROWS_PER_FILE, write_batch
from tidemark.operators.stamp import stamp
from tidemark.operators.validate import Rules, mark


def file_stream(spark: SparkSession, folder: str, schema, glob: str = "*.parquet",
                max_files: int | None = None) -> DataFrame:
    """New parquet files of a folder; `max_files` bounds the size of a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def batch_name(checkpoint: str, epoch: int) -> str:
    """The stream, by its checkpoint, and the number of the micro-batch: two streams into one target do not clash."""
    return f"s{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:12]}_{epoch:012d}"


def start_ingest(stream: DataFrame, target: str, checkpoint: str, rules: Rules, as_of: Callable[[], str],
                 source_system_id: int = 1, rows_per_file: int = ROWS_PER_FILE) -> StreamingQuery:
    """Load what has arrived since the last run, then stop.

    A micro-batch is named by its checkpoint and number. If it runs again after a failure it writes the same
    partition again, so rows are never doubled. A row rejected as future is kept as such; a stream,
    unlike a delta load, does not look at it again.
    """
    def load(batch: DataFrame, epoch: int) -> None:
        now, name = as_of(), batch_name(checkpoint, epoch)
        rows = mark(stamp(clean_table(batch), name, now, source_system_id), rules, now)
        write_batch(rows, target, name, rows_per_file, gather=True)

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
