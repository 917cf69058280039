"""Helpers shared by the operators: shared scratch space, cuts of lineage, tables."""

from __future__ import annotations

import contextlib
import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no spark.checkpoint.dir and all runs in one process (tests, one machine).
OWN_CHECKPOINTS = "/tmp/checkpoints"

#: White space of the word rule [^\x20\x09-\x0D]+ , as a Java character class.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; on one machine, else one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or OWN_CHECKPOINTS).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """`df` with its lineage cut by a reliable checkpoint, computed once, now.

    The files go when no plan refers to them any more, if the session sets
    spark.cleaner.referenceTracking.cleanCheckpoints.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


class Scratch:
    """A table or folder below the shared folder that its owner drops when done."""

    def __init__(self, spark: SparkSession, kind: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame) -> DataFrame:
        df.write.parquet(self.path)
        return self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def own_names(columns, *names: str) -> list[str]:
    """`names`, lengthened where `columns` has such a one already (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache() -> types.ModuleType:
    """A module that lives as long as the Python worker; functions pickled by value share it."""
    return sys.modules.setdefault("_tidewright_worker_cache", types.ModuleType("_tidewright_worker_cache"))


def release() -> None:
    """Gives memory that is free back to the system: idle workers live on beside the next stage's."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def forget() -> None:
    """Drops what an earlier stage has kept in this worker."""
    kept = worker_cache().__dict__
    for key in [k for k in kept if isinstance(k, tuple)]:
        del kept[key]


def map_arrow(df: DataFrame, work, schema, keeps: bool = False) -> DataFrame:
    """df.mapInArrow(work, schema), which leaves little behind in its workers; with `keeps` the worker's cache lives on to the next task."""

    def run(batches):
        if not keeps:
            forget()
        yield from work(batches)
        release()

    return df.mapInArrow(run, schema)


def group_arrow(grouped, work, schema: str) -> DataFrame:
    """grouped.applyInArrow(work, schema), which leaves little behind in its workers."""

    def run(group):
        forget()
        out = work(group)
        release()
        return out

    return grouped.applyInArrow(run, schema)


def by_bytes(batch, column: int, size: int):
    """Slices of a batch whose texts have about `size` bytes together."""
    import numpy as np
    import pyarrow.compute as pc

    part = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64) // size
    cuts = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def lake_fs(uri: str):
    """The pyarrow file system of a shared folder's URI, and the path in it; Hadoop's names of S3 are S3 here."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"s3://{rest}" if colon and scheme in ("s3a", "s3n") else uri)


def buckets_for(df: DataFrame, amount, per_bucket: int, least: int = 1) -> int:
    """How many buckets hold sum(amount) at `per_bucket` each; one aggregate over all rows."""
    total = df.agg(F.sum(amount)).first()[0] or 0
    return max(least, -(-int(total) // per_bucket))
