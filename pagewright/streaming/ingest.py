"""Incremental runs: new reports are found as files and worked off in batches. A report is the unit, so no state goes from batch to batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.sections import section_ranges
from ..schema import PAGE_TEXT


def page_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of ``page_text`` rows; every file holds whole reports."""
    return spark.readStream.schema(PAGE_TEXT).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run_batches(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Works off what is there, batch by batch, and ends. Each batch overwrites its own folder ``batch=<n>``, so a repeated batch leaves its rows
    once."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_section_ranges(spark: SparkSession, folder: str, out: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Section ranges of every new report."""
    return run_batches(page_stream(spark, folder, files_per_batch), section_ranges, out, checkpoint)
