"""Decisions about a table: its cursor, its mode, how it is paged and how large its windows are."""

from __future__ import annotations

import logging

from ..functions.types import INTEGER_TYPES, OPAQUE_TEXT_TYPES, TEXT_TYPES, ColumnInfo, IndexInfo
from .config import AUTO, DEFAULT_BATCH, FULL_REFRESH, INCREMENTAL, TWO_STREAM, Config

log = logging.getLogger(__name__)

# Names of cursor columns, the first that fits is taken.
CURSOR_NAMES = ("updated_at", "modified_at", "changed_at", "created_at", "created_date", "modified_date")
_TIMES = ("timestamp", "datetime")


def _named(columns: list[ColumnInfo], name: str | None) -> ColumnInfo | None:
    return next((c for c in columns if c.name == name), None)


def detect_timestamp(columns: list[ColumnInfo]) -> str | None:
    """The first of CURSOR_NAMES that is a time and never null."""
    return next((n for n in CURSOR_NAMES if (c := _named(columns, n)) and c.data_type in _TIMES and not c.nullable), None)


def integer_key(columns: list[ColumnInfo], indexes: list[IndexInfo]) -> str | None:
    """The primary key, if it is one integer column."""
    key = next((i.columns[0] for i in indexes if i.name == "PRIMARY" and len(i.columns) == 1), None)
    c = _named(columns, key)
    return key if c and c.data_type in INTEGER_TYPES else None


def string_key(columns: list[ColumnInfo], indexes: list[IndexInfo]) -> str | None:
    """The primary key, if it is one text column."""
    key = next((i.columns[0] for i in indexes if i.name == "PRIMARY" and len(i.columns) == 1), None)
    c = _named(columns, key)
    return key if c and c.data_type in TEXT_TYPES else None


def detect_mode(columns: list[ColumnInfo], asked: str | None, ts: str, has_key: bool) -> str:
    """An explicit mode wins; else a time that is never null and an integer key make a table incremental."""
    c = _named(columns, ts)
    if asked and asked != AUTO:
        if asked == INCREMENTAL and c and c.nullable:
            log.warning("cursor %s may be null; rows where it is are never taken", ts)
        return asked
    if c and c.data_type in _TIMES and has_key:
        if not c.nullable:
            return INCREMENTAL
        log.warning("cursor %s may be null, so the table is refreshed in full", ts)
    return FULL_REFRESH


def check_timestamp(columns: list[ColumnInfo], ts: str) -> None:
    c = _named(columns, ts)
    if not c or c.data_type not in _TIMES:
        raise ValueError(f"the configured cursor {ts} is no column of times")


def check_two_stream(columns: list[ColumnInfo], insert: str, update: str) -> None:
    c = _named(columns, insert)
    if not c or c.data_type not in INTEGER_TYPES:
        raise ValueError(f"the insert cursor {insert} is no integer column")
    c = _named(columns, update)
    if not c or c.data_type not in _TIMES:
        raise ValueError(f"the update cursor {update} is no column of times")
    if c.nullable:
        log.warning("update cursor %s may be null; changes of rows where it is are never taken", update)


def resolve(columns: list[ColumnInfo], indexes: list[IndexInfo], config: Config, table: str) -> tuple[str, str]:
    """(cursor, mode) of a table, the same for runs, checks and verification."""
    own = config.timestamps.get(table)
    if own and config.modes.get(table) != FULL_REFRESH and not config.two_stream(table):
        check_timestamp(columns, own)
    ts = own or detect_timestamp(columns) or CURSOR_NAMES[0]
    if (table in config.insert_cursors) != (table in config.update_cursors):
        raise ValueError(f"two streams need both TABLE_INSERT_CURSOR_{table} and TABLE_UPDATE_CURSOR_{table}")
    if both := config.two_stream(table):
        check_two_stream(columns, *both)
        return ts, TWO_STREAM
    return ts, detect_mode(columns, config.modes.get(table), ts, integer_key(columns, indexes) is not None)


def paging_order(selected: list[str], columns: list[ColumnInfo], indexes: list[IndexInfo]) -> list[tuple[str, bool]]:
    """(column, by bytes) of a total order: a unique index over columns that are never null, else all columns."""
    firm = {c.name for c in columns if not c.nullable}
    usable = [i for i in indexes if i.columns and set(i.columns) <= firm and (i.name == "PRIMARY" or i.unique)]
    if usable:
        best = next((i for i in usable if i.name == "PRIMARY"), usable[0])
        return [(c, False) for c in best.columns]
    kinds = {c.name: c.data_type for c in columns}
    return [(c, kinds.get(c) in (*TEXT_TYPES, *(k for k in OPAQUE_TEXT_TYPES if k != "json"))) for c in selected]


def window_rows(budget_mb: int, row_bytes: int | None, default: int = DEFAULT_BATCH) -> int:
    """Rows of a window that fill the budget, one at least; without a row size the default."""
    return default if not row_bytes else max(1, budget_mb * 1024 * 1024 // row_bytes)


def resized(rows: int, budget_mb: int, estimated: int | None, actual: float) -> int:
    """The window once rows have been seen: kept while they are half to twice as long as was thought."""
    if not estimated or actual <= 0 or 0.5 <= actual / estimated <= 2:
        return rows
    return max(1, int(budget_mb * 1024 * 1024 // actual))


def run_exit_code(succeeded: int, failed: int, interrupted: bool = False) -> int:
    """0 all went well, 1 some did or the run was interrupted, 2 none did."""
    if interrupted:
        return 1
    return 0 if not failed else 1 if succeeded else 2
