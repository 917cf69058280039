"""Which columns of a table could be its cursor, and how good they are."""

from __future__ import annotations

from dataclasses import dataclass

from ..functions.types import ColumnInfo, IndexInfo
from .decisions import integer_key

IDEAL, OK, SLOW, UNSAFE = "ideal", "ok", "usable but slow", "unsafe"
_RANK = (IDEAL, OK, SLOW)
_WHY = {IDEAL: "never null, and an index begins with it", OK: "never null, in an index but not first", SLOW: "never null, but no index has it, so each window sorts the table"}


@dataclass(frozen=True)
class Candidate:
    column: str
    nullable: bool
    indexed: bool
    leading: bool
    verdict: str


@dataclass(frozen=True)
class Report:
    has_id: bool
    id_type: str | None
    id_is_primary: bool
    candidates: list[Candidate]
    configured: str | None
    recommendation: str


def evaluate(table: str, columns: list[ColumnInfo], indexes: list[IndexInfo], configured: str | None = None) -> Report:
    """Grades each column of times: unsafe if it may be null, else by the indexes that have it."""
    own = next((c for c in columns if c.name == "id"), None)
    found = []
    for c in columns:
        if c.data_type not in ("timestamp", "datetime"):
            continue
        indexed, leading = any(c.name in i.columns for i in indexes), any(i.columns[:1] == (c.name,) for i in indexes)
        found.append(Candidate(c.name, c.nullable, indexed, leading, UNSAFE if c.nullable else IDEAL if leading else OK if indexed else SLOW))
    safe = sorted((c for c in found if c.verdict != UNSAFE), key=lambda c: _RANK.index(c.verdict))
    if own is None and integer_key(columns, indexes) is None:
        advice = "no integer primary key of one column: use full_refresh"
    elif not safe:
        advice = "no safe cursor: use full_refresh"
    else:
        advice = f"incremental: set TABLE_TIMESTAMP_{table}={safe[0].column} ({_WHY[safe[0].verdict]})"
        if any(c.column == configured and c.verdict == UNSAFE for c in found):
            advice += f"; the configured {configured} may be null, {safe[0].column} is safer"
    return Report(own is not None, own and own.data_type, bool(own and (own.key == "PRI" or any(i.name == "PRIMARY" and "id" in i.columns for i in indexes))), found, configured, advice)


def render(table: str, report: Report) -> str:
    lines = [f"table {table}"]
    if report.has_id:
        lines.append(f"  id: {report.id_type}{' PRIMARY' if report.id_is_primary else ''}")
    lines += [f"  {c.column}: {c.verdict}{' (nullable)' if c.nullable else ''}{' [configured]' if c.column == report.configured else ''}" for c in report.candidates]
    return "\n".join([*lines, f"  -> {report.recommendation}"])
