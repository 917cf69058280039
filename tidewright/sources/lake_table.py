"""Lake tables: Parquet files under a commit log that carries the watermarks.

Files are staged first and become visible by one commit, together with the
watermarks that describe exactly them. A crash before the commit leaves files
that nobody reads and vacuum removes.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cursors import Hwm
from ..functions.types import aligned, quoted
from ..operators import upsert as U
from ..operators.windows import dedup_by_key
from .lake_log import CommitConflict, CommitLog, Snapshot, TableMissing, metadata, protocol, removal

#: Commits that are searched for watermarks, and hours that vacuum keeps removed files at least.
LOOKBACK, RETENTION_HOURS = 64, 168
UPDATED, LAST_ID, INSERT_ID, RESET = "hwm_updated_at", "hwm_last_id", "hwm_insert_id", "hwm_reset"

__all__ = ["CommitConflict", "LakeTable", "Marks", "StagedOverwrite", "TableMissing", "VacuumReport"]


@dataclass(frozen=True)
class Marks:
    """Watermarks as a commit keeps them: of the update cursor, and of the insert cursor."""

    update: Hwm | None = None
    insert: int | None = None

    def info(self) -> dict[str, str]:
        out = {} if self.update is None else {UPDATED: self.update.updated_at, LAST_ID: str(self.update.last_id)}
        return out if self.insert is None else out | {INSERT_ID: str(self.insert)}


@dataclass(frozen=True)
class VacuumReport:
    files: list[str]
    files_present: int
    bytes: int
    applied: bool


class LakeTable:
    """One table below `path`. Several readers, one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path.rstrip("/"), CommitLog(spark, path)

    # --- reading ---

    def exists(self) -> bool:
        return bool(self.log.versions())

    def snapshot(self, version: int | None = None) -> Snapshot:
        return self.log.snapshot(version)

    def schema(self) -> T.StructType | None:
        """None if there is no table; other failures are raised."""
        try:
            return self.snapshot().schema
        except TableMissing:
            return None

    def has_data(self) -> bool:
        return self.exists() and bool(self.snapshot().files)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of `version`; columns that a file lacks read as null."""
        return self._files(self.snapshot(version), None)

    def _files(self, snap: Snapshot, names: list[str] | None) -> DataFrame:
        names = list(snap.files) if names is None else names
        if not names:
            return self.spark.createDataFrame([], snap.schema)
        return self.spark.read.schema(snap.schema).parquet(*(f"{self.path}/{n}" for n in names))

    def row_count(self) -> int:
        """From the log alone."""
        return sum(json.loads(a["stats"])["numRecords"] for a in self.snapshot().files.values())

    def marks(self) -> Marks:
        """The newest watermarks; those of the update and of the insert cursor are looked for apart."""
        update = insert = None
        for said in self.log.history(LOOKBACK):
            if update is None and UPDATED in said and LAST_ID in said:
                update = Hwm(said[UPDATED], int(said[LAST_ID]))
            if insert is None and INSERT_ID in said:
                insert = int(said[INSERT_ID])
            if said.get(RESET) or (update and insert is not None):
                break
        return Marks(update, insert)

    # --- staging ---

    def stage(self, df: DataFrame) -> list[dict]:
        """Writes `df` to files of a folder of its own; returns their add actions. Nothing is visible yet."""
        folder = f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        sizes = {n: size for n, size, _ in self._listed(folder)}
        counted = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}").groupBy(F.col("_metadata.file_name").alias("name")).count().collect()  # a row a file
        now, adds = int(time.time() * 1000), []
        for r in sorted(counted):
            name = f"{folder}/{r.name}"
            adds.append({"add": {"path": name, "partitionValues": {}, "size": sizes[name], "modificationTime": now, "dataChange": True, "stats": json.dumps({"numRecords": r["count"]})}})
        return adds

    def _listed(self, folder: str) -> list[tuple[str, int, int]]:
        return [f for f in self.log.files.walk(folder) if f[0].endswith(".parquet")]

    # --- writing ---

    def ensure(self, schema: T.StructType) -> None:
        """Makes the table if there is none."""
        if not self.exists():
            self.log.commit(0, [protocol(), metadata(_nullable(schema))], "CREATE TABLE")

    def append(self, df: DataFrame, marks: Marks | None = None, info: dict | None = None) -> int | None:
        """Appends rows and keeps `marks`, in one commit; new columns join the schema. No rows, no commit."""
        self.ensure(df.schema)
        snap = self.snapshot()
        merged = _merged(snap.schema, df.schema)
        adds = self.stage(aligned(_widened(df, merged), merged))
        if not adds:
            return None
        schema = [] if merged == snap.schema else [metadata(merged, snap.table_id)]
        return self.log.commit(snap.version + 1, schema + adds, "WRITE", {**(marks.info() if marks else {}), **(info or {})})

    def overwrite(self, schema: T.StructType) -> StagedOverwrite:
        """A session whose chunks take the table's place by one commit, with `schema` for its own."""
        return StagedOverwrite(self, _nullable(schema))

    def replace(self, df: DataFrame, marks: Marks | None = None) -> int | None:
        """`df` in the place of all rows, in one commit; no rows, no commit."""
        with self.overwrite(df.schema) as session:
            return session.commit(marks) if session.stage(df) else None

    def commit_marks(self, marks: Marks) -> int:
        """A commit of watermarks alone."""
        return self.log.commit(self.snapshot().version + 1, [], "HWM", marks.info())

    def upsert(self, new: DataFrame, key: str, order_col: str | None = None, marks: Marks | None = None, merge: bool = False) -> int | None:
        """Brings in the last version of each key of `new`, in one commit.

        Only files that hold a matched key are written again, unless `merge` asks
        for the full outer join over the table. Null keys of the table stay; in `new` they are an error.
        """
        self.ensure(new.schema)
        snap = self.snapshot()
        merged = _merged(snap.schema, new.schema)
        new = aligned(_widened(dedup_by_key(new, key, order_col), merged), merged)
        staged = self.stage(new)
        if not staged:
            return None
        fresh = self.spark.read.schema(merged).parquet(*(f"{self.path}/{a['add']['path']}" for a in staged))
        if fresh.where(F.col(quoted(key)).isNull()).limit(1).count():
            raise ValueError(f"rows to upsert have a null {key}")
        count = sum(json.loads(a["add"]["stats"])["numRecords"] for a in staged)
        keys = fresh.select(quoted(key))
        few = F.broadcast(keys) if count <= U.BROADCAST_KEYS else keys
        wide = Snapshot(snap.version, merged, snap.files)
        if merge:
            touched, staged = list(snap.files), self.stage(U.upsert_by_merge(self._files(wide, None), fresh, key))
        else:
            hit = self._files(wide, None).select(F.col(quoted(key)), F.col("_metadata.file_path").alias("__file")).join(few, key, "left_semi").select("__file").distinct().collect() if snap.files else []
            ends = {n.rpartition("/")[2]: n for n in snap.files}  # file names have a unique part
            touched = sorted({ends[_unquoted(r[0]).rpartition("/")[2]] for r in hit})
            if touched:
                staged = staged + self.stage(U.survivors(self._files(wide, touched), keys, key, count))
        schema = [] if merged == snap.schema else [metadata(merged, snap.table_id)]
        return self.log.commit(snap.version + 1, schema + [removal(n, snap.files[n]) for n in touched] + staged, "MERGE" if merge else "UPSERT", marks.info() if marks else {})

    # --- vacuum ---

    def vacuum(self, apply: bool = False, hours: int = RETENTION_HOURS, full: bool = False, force: bool = False, now: float | None = None) -> VacuumReport:
        """Names (and with `apply` deletes) removed files older than `hours`; `full` also files that no commit knows.

        Less than RETENTION_HOURS needs `force`: readers of an old version could lose its files.
        """
        if hours < RETENTION_HOURS and not force:
            raise ValueError(f"{hours} h is less than the {RETENTION_HOURS} h that readers may need; force it if none reads")
        snap, limit = self.snapshot(), ((now or time.time()) - hours * 3600) * 1000
        there = {n: (size, at) for n, size, at in self.log.files.walk() if not n.startswith(CommitLog.FOLDER) and not n.rpartition("/")[2].startswith((".", "_"))}
        names = [n for n, r in snap.tombstones.items() if r["deletionTimestamp"] <= limit]
        if full:
            names += [n for n, (_, at) in there.items() if n not in snap.files and n not in snap.tombstones and at <= limit]
        present = [n for n in names if n in there]
        if apply:
            for n in present:
                self.log.files.delete(n)
        return VacuumReport(sorted(names), len(present), sum(there[n][0] for n in present), apply)


class StagedOverwrite:
    """A table's replacement, chunk by chunk; left without commit(), the table is as it was."""

    def __init__(self, table: LakeTable, schema: T.StructType):
        self.table, self.schema, self.adds, self.done = table, schema, [], False

    def __enter__(self) -> StagedOverwrite:
        return self

    def stage(self, df: DataFrame) -> list[dict]:
        found = self.table.stage(aligned(df, self.schema))
        self.adds += found
        return found

    def staged(self) -> DataFrame:
        if not self.adds:
            return self.table.spark.createDataFrame([], self.schema)
        return self.table.spark.read.schema(self.schema).parquet(*(f"{self.table.path}/{a['add']['path']}" for a in self.adds))

    def commit(self, marks: Marks | None = None) -> int:
        """All old files go, all staged ones come, the schema is theirs; without marks, older ones count no more."""
        self.table.ensure(self.schema)
        snap = self.table.snapshot()
        schema = [] if snap.schema == self.schema else [metadata(self.schema, snap.table_id)]
        gone = [removal(n, a) for n, a in snap.files.items()]
        self.done = True
        return self.table.log.commit(snap.version + 1, gone + schema + self.adds, "WRITE", marks.info() if marks else {RESET: True})

    def abort(self) -> None:
        """Deletes what was staged; may be called again, and after nothing was staged."""
        for folder in {a["add"]["path"].partition("/")[0] for a in self.adds}:
            self.table.log.files.delete(folder, True)
        self.adds = []

    def __exit__(self, *error) -> None:
        if not self.done:
            self.abort()


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


_WIDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def _merged(have: T.StructType, more: T.StructType) -> T.StructType:
    """`have` and the columns that `more` adds; a column keeps the table's type."""
    names = {f.name for f in have.fields}
    return T.StructType([*have.fields, *(T.StructField(f.name, f.dataType, True) for f in more.fields if f.name not in names)])


def _widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    lacks = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(lacks) if lacks else df


def _unquoted(uri: str) -> str:
    from urllib.parse import unquote

    return unquote(uri)
