"""Runs of one table in each mode: windows of the source become commits of the lake.

A window is staged first; its watermark is then taken from the staged files, as
the source may have changed since, checked, and committed with them.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cursors import MAX_LONG, Hwm, keyset_sql, window_sql
from ..functions.types import ColumnInfo, IndexInfo, aligned, evolved_columns, extractable, lake_schema, quoted
from ..operators.windows import batch_hwm, cursor_window, keyset_page
from ..sources.catalog import SourceCatalog, greatest_as_text, null_rows
from ..sources.lake_table import LakeTable, Marks
from .config import FULL_REFRESH, INCREMENTAL, TWO_STREAM, Config
from .decisions import integer_key, resized, resolve, window_rows

log = logging.getLogger(__name__)


@dataclass
class Job:
    """A table and what a run knows of it."""

    spark: SparkSession
    source: SourceCatalog
    lake: LakeTable
    config: Config
    table: str
    columns: list[ColumnInfo]
    indexes: list[IndexInfo]
    selected: list[str]
    rows: int | None
    stop: Callable[[], bool] = lambda: False
    row_bytes: int | None = None

    def window(self, plan, sql: str | None) -> DataFrame:
        """A window planned by the source where it takes SQL, else by Spark."""
        return (self.source.query(sql) if sql else None) or plan()

    def cursor_rows(self, ts: str, key: str, hwm: Hwm | None, cap: int | None = None) -> DataFrame:
        n = self.rows or MAX_LONG
        sql = window_sql(self.table, self.selected, ts, key, hwm, n, cap, self.source.dialect) if hasattr(self.source, "dialect") else None
        return self.window(lambda: cursor_window(self.source.read(self.table), self.selected, ts, key, hwm, self.rows, cap), sql)

    def key_rows(self, key: str, last: int | None) -> DataFrame:
        n = self.rows or MAX_LONG
        sql = keyset_sql(self.table, self.selected, key, last, n, self.source.dialect) if hasattr(self.source, "dialect") else None
        return self.window(lambda: keyset_page(self.source.read(self.table), self.selected, key, last, self.rows), sql)

    def schema(self):
        return lake_schema([c for c in self.columns if c.name in self.selected])

    def whole(self) -> DataFrame:
        """All rows of the source; a database is read by ranges of its integer key where it has one."""
        key = integer_key(self.columns, self.indexes)
        if key and hasattr(self.source, "read_by_key"):
            return self.source.read_by_key(self.table, key, self.config.read_connections)
        return self.source.read(self.table)

    def resize(self, staged: DataFrame) -> None:
        """Fits the next window to the length that rows of this one turned out to have."""
        if self.rows and self.row_bytes:
            actual = measured_row_bytes(staged)
            self.rows, self.row_bytes = resized(self.rows, self.config.target_memory_mb, self.row_bytes, actual), max(1, round(actual)) or self.row_bytes


def measured_row_bytes(rows: DataFrame) -> float:
    """Bytes of a row on average: the lengths of texts and binaries, and the widths of other types."""
    long = [f.name for f in rows.schema.fields if f.dataType.typeName() in ("string", "binary")]
    fixed = {"byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4, "decimal": 16}
    width = sum(fixed.get(f.dataType.typeName(), 8) for f in rows.schema.fields if f.name not in long)
    if not long:
        return float(width)
    found = rows.agg(*(F.avg(F.octet_length(F.col(quoted(c)))).alias(f"a{i}") for i, c in enumerate(long))).first()
    return width + sum(x or 0.0 for x in found)


def _staged_frame(lake: LakeTable, adds: list[dict], schema) -> DataFrame:
    return lake.spark.read.schema(schema).parquet(*(f"{lake.path}/{a['add']['path']}" for a in adds))


def _discard(lake: LakeTable, adds: list[dict]) -> None:
    for folder in {a["add"]["path"].partition("/")[0] for a in adds}:
        lake.log.files.delete(folder, True)


def _window_hwm(staged: DataFrame, ts: str, key: str, before: Hwm | None, full: bool, what: str) -> Hwm:
    """The watermark of a staged window; a window that yields none, or a full one that doesn't get on, is an error."""
    r = batch_hwm(staged, ts, key).first()
    if r.hwm_updated_at is None or r.hwm_last_id is None:
        raise RuntimeError(f"{what}: no watermark can be taken from a window with rows; appending would repeat them next time")
    hwm = Hwm(r.hwm_updated_at, r.hwm_last_id)
    if full and not hwm.after(before):
        raise RuntimeError(f"{what}: a full window did not advance the watermark")
    return hwm


def _rows(adds: list[dict]) -> int:
    import json

    return sum(json.loads(a["add"]["stats"])["numRecords"] for a in adds)


def _warn_of_nulls(job: Job, cursor: str) -> int:
    c = next((c for c in job.columns if c.name == cursor), None)
    n = null_rows(job.source.read(job.table), cursor) if c is None or c.nullable else 0
    if n:
        log.warning("%s: %s rows have no %s and are never taken", job.table, n, cursor)
    return n


def run_incremental(job: Job, ts: str, key: str) -> int:
    """Windows beyond the watermark, each appended with its own in one commit, until one is short."""
    _warn_of_nulls(job, ts)
    hwm = job.lake.marks().update
    if hwm is None and job.table in job.config.initial_hwm:
        hwm = Hwm(*job.config.initial_hwm[job.table])
    if hwm is None and job.lake.has_data():
        raise RuntimeError(f"{job.table} has rows in the lake but no watermark; starting over would repeat them all. Set TABLE_HWM_{job.table} or refresh it in full")
    total, schema = 0, job.schema()
    while not job.stop():
        adds = job.lake.stage(aligned(job.cursor_rows(ts, key, hwm), schema))
        n = _rows(adds)
        if not n:
            _discard(job.lake, adds)
            break
        staged = _staged_frame(job.lake, adds, schema)
        hwm = _window_hwm(staged, ts, key, hwm, n == job.rows, job.table)
        commit_staged(job.lake, adds, schema, Marks(update=hwm))
        total += n
        if job.rows is None or n < job.rows:
            break
        job.resize(staged)
    return total


def commit_staged(lake: LakeTable, adds: list[dict], schema, marks: Marks) -> int:
    """Makes staged files visible with `marks`, and new columns with them."""
    from ..sources.lake_log import metadata
    from ..sources.lake_table import _merged

    lake.ensure(schema)
    snap = lake.snapshot()
    merged = _merged(snap.schema, schema)
    return lake.log.commit(snap.version + 1, ([] if merged == snap.schema else [metadata(merged, snap.table_id)]) + adds, "WRITE", marks.info())


def run_full_refresh(job: Job, seed: Hwm | None = None, insert_key: str | None = None) -> int:
    """All rows take the table's place in one commit; a source without rows leaves it as it is.

    Spark reads the source once, rather than by pages (a database by ranges of
    its integer key, over several connections); with `seed` and `insert_key` the commit re-seeds the watermarks of two streams.
    """
    schema = job.schema()
    with job.lake.overwrite(schema) as session:
        if job.stop():
            return 0
        adds = session.stage(job.whole().select(*(F.col(quoted(c)) for c in job.selected)))
        n = _rows(adds)
        if not n or job.stop():
            return 0
        marks = None
        if seed is not None:
            last = session.staged().agg(F.max(F.col(quoted(insert_key)).cast("long"))).first()[0]
            marks = Marks(seed, last)
        session.commit(marks)
        return n


def run_two_stream(job: Job, insert: str, update: str) -> int:
    """New rows by the insert cursor are appended; then changed rows, up to that cursor, are brought in by key."""
    _warn_of_nulls(job, update)
    have = job.lake.marks()
    last, hwm = have.insert, have.update
    seed = job.config.initial_hwm.get(job.table)
    if last is None and seed:
        last = seed[1]
    if last is None and job.lake.has_data():
        raise RuntimeError(f"{job.table} has rows in the lake but no insert watermark; starting over would repeat them all. Set TABLE_HWM_{job.table} or refresh it in full")
    if hwm is None:
        at = seed[0] if seed else greatest_as_text(job.source.read(job.table), update)
        hwm = Hwm(at, MAX_LONG) if at else None
    if (have.insert, have.update) != (last, hwm):  # else a run without rows would lose the seed
        job.lake.commit_marks(Marks(hwm, last))
    total, schema = 0, job.schema()
    while not job.stop():
        adds = job.lake.stage(aligned(job.key_rows(insert, last), schema))
        n = _rows(adds)
        if not n:
            _discard(job.lake, adds)
            break
        staged = _staged_frame(job.lake, adds, schema)
        r = staged.agg(F.max(F.col(quoted(insert)).cast("long")).alias("m"), F.count_if(F.col(quoted(insert)).isNull()).alias("nulls")).first()
        if r.m is None or r.nulls:
            raise RuntimeError(f"{job.table}: no insert watermark can be taken from a window with rows")
        if n == job.rows and last is not None and r.m <= last:
            raise RuntimeError(f"{job.table}: a full window did not advance the insert watermark")
        last = r.m if last is None else max(last, r.m)
        commit_staged(job.lake, adds, schema, Marks(hwm, last))
        total += n
        if job.rows is None or n < job.rows:
            break
        job.resize(staged)
    while not job.stop():
        # Staged before anything is read from it twice: the source may change.
        adds = job.lake.stage(aligned(job.cursor_rows(update, insert, hwm, last), schema))
        n = _rows(adds)
        if not n:
            _discard(job.lake, adds)
            break
        staged = _staged_frame(job.lake, adds, schema)
        after = _window_hwm(staged, update, insert, hwm, n == job.rows, job.table)
        job.lake.upsert(staged, insert, update, Marks(after, last), merge=job.config.update_strategy == "merge")
        _discard(job.lake, adds)
        hwm = after
        total += n
        if job.rows is None or n < job.rows:
            break
    return total


def run_reconcile(job: Job, insert: str, update: str) -> int:
    """One full snapshot that also re-seeds all watermarks, so that the next run goes on as two streams."""
    if integer_key(job.columns, job.indexes) is None:
        raise ValueError(f"{job.table} has no integer primary key to re-seed the insert cursor from")
    at = greatest_as_text(job.source.read(job.table), update) or "1970-01-01 00:00:00"
    return run_full_refresh(job, Hwm(at, MAX_LONG), insert)


def prepare(spark: SparkSession, source: SourceCatalog, config: Config, table: str, stop=lambda: False, windowed: bool = True, make: bool = True) -> tuple[Job, str, str]:
    """(job, cursor, mode) of a table: its columns, mode, window, and its lake table, with `make` made if there is none."""
    columns = extractable(source.columns(table))
    indexes = source.indexes(table)
    ts, mode = resolve(columns, indexes, config, table)
    if mode == FULL_REFRESH and table in config.initial_hwm:
        raise ValueError(f"TABLE_HWM_{table} is set, but the table is refreshed in full")
    # Windows keep a database's answers small. What Spark reads itself comes whole, in one commit: a window would be a top-n over all that is left.
    windowed = windowed and hasattr(source, "dialect")
    row_bytes = source.average_row_bytes(table) if windowed else None
    rows = window_rows(config.target_memory_mb, row_bytes, config.default_batch_size) if windowed else None
    lake = LakeTable(spark, f"{config.root}/{table}")
    selected = [c.name for c in columns]
    have = lake.schema()
    if have is not None and mode in (INCREMENTAL, TWO_STREAM) and table not in config.reconcile:
        selected = evolved_columns(columns, have)
    job = Job(spark, source, lake, config, table, columns, indexes, selected, rows, stop, row_bytes)
    if make:
        lake.ensure(job.schema())
    return job, ts, mode


def run_table(spark: SparkSession, source: SourceCatalog, config: Config, table: str, stop=lambda: False) -> tuple[str, int]:
    """(mode, rows) of one table's run."""
    job, ts, mode = prepare(spark, source, config, table, stop)
    if mode == TWO_STREAM:
        both = config.two_stream(table)
        return mode, (run_reconcile if table in config.reconcile else run_two_stream)(job, *both)
    if mode == INCREMENTAL:
        return mode, run_incremental(job, ts, integer_key(job.columns, job.indexes) or "id")
    return mode, run_full_refresh(job)
