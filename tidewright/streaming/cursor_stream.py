"""Streams into lake tables: each micro-batch is one commit that knows its own number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.cursors import Hwm
from ..operators.windows import batch_hwm
from ..sources.lake_table import LakeTable, Marks

STREAM, BATCH = "stream_id", "stream_batch"


def _done(lake: LakeTable, stream: str) -> int:
    """The last batch of `stream` that the table holds; -1 if none."""
    if not lake.exists():
        return -1
    # Batches are committed in order, so the newest commit of the stream has the last one.
    return next((int(said[BATCH]) for said in lake.log.history() if said.get(STREAM) == stream), -1)


def append_stream(rows: DataFrame, lake: LakeTable, ts: str, key: str, checkpoint: str, name: str) -> StreamingQuery:
    """Appends what a stream of rows has now, batch by batch, with the batch's watermark in its commit.

    A batch that was committed before the stream could note it is told by its
    number and not repeated, so each row is in the table once.
    """

    def commit(batch: DataFrame, number: int) -> None:
        if number <= _done(lake, name):
            return
        batch = batch.persist()  # one batch, read for its watermark and for its files
        r = batch_hwm(batch, ts, key).first()
        before = lake.marks().update if lake.exists() else None
        hwm = Hwm(r.hwm_updated_at, r.hwm_last_id) if r.hwm_updated_at is not None else None
        lake.append(batch, Marks(update=hwm if hwm and hwm.after(before) else before), {STREAM: name, BATCH: str(number)})
        batch.unpersist()

    return rows.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def parquet_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)
