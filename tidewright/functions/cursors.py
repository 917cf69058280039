"""Compound cursors: their order, their predicates, and the same as SQL text for a JDBC source."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import quoted

MAX_LONG = (1 << 63) - 1


def parse_time(text: str) -> datetime | None:
    """A cursor's time of day in either form (blank or T, any fraction, date alone); None if it is none."""
    text = text.strip().replace("T", " ", 1)
    day, _, rest = text.partition(" ")
    clock, _, fraction = rest.partition(".")
    parts = clock.split(":") if clock else []
    try:
        y, m, d = (int(x) for x in day.split("-"))
        if len(parts) == 1 or len(parts) > 3 or (fraction and not fraction.isdigit()):
            return None
        h, mi, s = [int(x) for x in (*parts, "0", "0", "0")[:3]]
        return datetime(y, m, d, h, mi, s, int((fraction + "000000")[:6]))
    except ValueError:
        return None


@dataclass(frozen=True)
class Hwm:
    """A high watermark: the last time taken, and the last key at that time."""

    updated_at: str
    last_id: int

    def after(self, other: Hwm | None) -> bool:
        """True if this one lies strictly beyond `other`; times that can't be read are compared as text."""
        if other is None:
            return True
        a, b = parse_time(self.updated_at), parse_time(other.updated_at)
        if a is None or b is None:
            a, b = self.updated_at, other.updated_at
        return (a, self.last_id) > (b, other.last_id)


def _time(hwm: Hwm) -> Column:
    at = parse_time(hwm.updated_at)
    return F.lit(hwm.updated_at) if at is None else F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def beyond(ts: str, key: str, hwm: Hwm | None, key_cap: int | None = None) -> Column:
    """Rows of a cursor window: a time at all, beyond the watermark, and a key within the cap.

    Written out rather than as a comparison of structs, so that it reaches the scan.
    """
    t, k = F.col(quoted(ts)), F.col(quoted(key))
    rows = t.isNotNull()
    if hwm is not None:
        rows = rows & (((t == _time(hwm)) & (k > hwm.last_id)) | (t > _time(hwm)))
    return rows if key_cap is None else rows & (k <= key_cap)


def within(ts: str, key: str, hwm: Hwm) -> Column:
    """Rows at or before the watermark; keys beyond a long compare exactly."""
    t, k = F.col(quoted(ts)), F.col(quoted(key)).cast("decimal(20,0)")
    return (t < _time(hwm)) | ((t == _time(hwm)) & (k <= F.lit(hwm.last_id).cast("decimal(20,0)")))


# --- SQL text, for sources that should plan the window themselves ---


def backticked(name: str) -> str:
    return quoted(name)


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class Dialect:
    """How a source quotes names and orders strings by bytes."""

    quote: str = "`"
    binary: str = "BINARY {}"
    offset: str = "LIMIT {n} OFFSET {m}"
    limit: str = "LIMIT {n}"

    def name(self, n: str) -> str:
        return self.quote + n.replace(self.quote, self.quote * 2) + self.quote

    def columns(self, names: list[str]) -> str:
        return ", ".join(map(self.name, names))


MARIADB = Dialect()
DERBY = Dialect(quote='"', binary="{}", offset="OFFSET {m} ROWS FETCH NEXT {n} ROWS ONLY", limit="FETCH FIRST {n} ROWS ONLY")


def window_sql(table: str, columns: list[str], ts: str, key: str, hwm: Hwm | None, n: int, key_cap: int | None = None, d: Dialect = MARIADB) -> str:
    t, k = d.name(ts), d.name(key)
    where = f"{t} IS NOT NULL"
    if hwm is not None:
        time = parse_time(hwm.updated_at)
        at = literal(hwm.updated_at if time is None else time.isoformat(sep=" "))
        where += f" AND (({t} = {at} AND {k} > {hwm.last_id}) OR {t} > {at})"
    if key_cap is not None:
        where += f" AND {k} <= {key_cap}"
    return f"SELECT {d.columns(columns)} FROM {d.name(table)} WHERE {where} ORDER BY {t}, {k} {d.limit.format(n=n)}"


def keyset_sql(table: str, columns: list[str], key: str, last: int | None, n: int, d: Dialect = MARIADB) -> str:
    """A page by key, for full refreshes and for the insert stream."""
    where = "" if last is None else f" WHERE {d.name(key)} > {last}"
    return f"SELECT {d.columns(columns)} FROM {d.name(table)}{where} ORDER BY {d.name(key)} {d.limit.format(n=n)}"


def offset_sql(table: str, columns: list[str], order: list[tuple[str, bool]], n: int, m: int, d: Dialect = MARIADB) -> str:
    """A page by position; `order` has (column, by bytes) and must be total."""
    by = ", ".join(d.binary.format(d.name(c)) if binary else d.name(c) for c, binary in order)
    return f"SELECT {d.columns(columns)} FROM {d.name(table)} ORDER BY {by} {d.offset.format(n=n, m=m)}"
