"""A check before a run: can the lake be written, and is each table's configuration sound."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from ..functions.cursors import Hwm
from ..functions.types import ColumnInfo, IndexInfo
from ..sources.catalog import SourceCatalog
from ..sources.lake_log import Files
from ..sources.lake_table import Marks
from .config import AUTO, INCREMENTAL, TWO_STREAM, Config
from .decisions import integer_key
from .modes import prepare

_NONE = "—"


def check_writable(spark: SparkSession, root: str) -> None:
    """Creates and deletes a file below `root`."""
    files, name = Files(spark, root), f".probe-{uuid.uuid4().hex}"
    files.create(name, "")
    files.delete(name)


def key_reason(columns: list[ColumnInfo], indexes: list[IndexInfo], config: Config, table: str, ts: str, mode: str) -> str:
    """What the mode rests on, in a few words."""
    if mode == TWO_STREAM:
        return "two-stream: {} + {}".format(*config.two_stream(table))
    if config.modes.get(table, AUTO) != AUTO:
        return "override"
    key = integer_key(columns, indexes)
    if mode == INCREMENTAL:
        return f"{key}, {ts}"
    c = next((c for c in columns if c.name == ts and c.data_type in ("timestamp", "datetime")), None)
    if key is None:
        return "no id" if c else f"no id/{ts}"
    return f"nullable {ts} (unsafe cursor)" if c else f"no {ts}"


def shown_hwm(mode: str, update: Hwm | None, insert: int | None) -> str:
    """Watermarks with their names where there are two of them."""
    if mode == TWO_STREAM:
        at, page = (update.updated_at, update.last_id) if update else (_NONE, _NONE)
        return f"ins={_NONE if insert is None else insert} upd={at} page={page}"
    return f"{update.updated_at} / {update.last_id}" if update else _NONE


def check(spark: SparkSession, source: SourceCatalog, config: Config, say: Callable[[str], None] = print) -> int:
    """Says a line for each table; returns how many failed. No table is made."""
    check_writable(spark, config.root)
    say(f"{'TABLE':<30} {'MODE':<15} {'COLUMNS':<10} {'AVG_ROW_LEN':<15} {'KEY':<20} HWM")
    failed = 0
    for table in config.tables:
        try:
            job, ts, mode = prepare(spark, source, config, table, make=False)
            marks, size = job.lake.marks() if job.lake.exists() else Marks(), source.average_row_bytes(table)
            say(f"{table:<30} {mode:<15} {len(job.columns):<10} {size or 'N/A':<15} {key_reason(job.columns, job.indexes, config, table, ts, mode):<20} {shown_hwm(mode, marks.update, marks.insert)}")
        except Exception as e:
            failed += 1
            say(f"{table:<30} FAILED: {e}")
    return failed


__all__ = ["check", "check_writable", "key_reason", "shown_hwm"]
