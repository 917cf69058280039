"""Verification: is the lake what its source says, as far as aggregates can tell."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fingerprint as P
from ..functions.cursors import Hwm, within
from ..functions.types import TEXT_TYPES, ColumnInfo, extractable, family_differs, quoted
from ..operators.windows import latest_per_key, sample_compare, sample_rows, spread_ids, with_ids
from ..sources.catalog import SourceCatalog, greatest_as_text
from ..sources.lake_table import LakeTable
from .config import INCREMENTAL, TWO_STREAM, Config
from .decisions import integer_key, resolve, string_key

PASS, DRIFT, DISCREPANCY, SKIPPED, PARTIAL = "PASS", "DRIFT", "DISCREPANCY", "SKIPPED", "PARTIALLY_VERIFIED"
#: Rows beyond which a table is only verified on demand, and rows of a sample.
ROW_CAP, SAMPLE = 1_000_000, 100


@dataclass(frozen=True)
class Outcome:
    verdict: str
    reason: str = ""


@dataclass(frozen=True)
class Plan:
    """How a table is verified: as its mode has it, or basic."""

    table: str
    mode: str = "basic"
    cursor: str | None = None
    insert: str | None = None
    hwm: Hwm | None = None


def _same_keys(s: P.KeyStats, d: P.KeyStats) -> bool:
    return s == d or (s.distinct, s.min, s.max, s.distinct_xor, s.sum) == (d.distinct, d.min, d.max, d.distinct_xor, d.sum)


def _inside(inner, outer) -> bool:
    """The inner range lies in the outer one; a range without keys lies in any."""
    low = inner.min is None or (outer.min is not None and inner.min >= outer.min)
    return low and (inner.max is None or (outer.max is not None and inner.max <= outer.max))


def _shown(name: str, x) -> str:
    return f"{name}(count={x.count} distinct={x.distinct} min={x.min} max={x.max})"


def keys_outcome(s: P.KeyStats, d: P.KeyStats, names=("source", "lake")) -> Outcome:
    """Equal key sets pass; a lake that only lacks keys, inside the source's range, has drifted; all else is a discrepancy."""
    if _same_keys(s, d):
        return Outcome(PASS)
    if d.distinct < s.distinct and _inside(d, s):
        return Outcome(DRIFT, f"the source went on since the last run: {_shown(names[0], s)}, {_shown(names[1], d)}")
    return Outcome(DISCREPANCY, f"the key sets differ: {_shown(names[0], s)}, {_shown(names[1], d)}")


def scoped_keys_outcome(s: P.KeyStats, d: P.KeyStats, names=("source up to the watermark", "latest rows of the lake")) -> Outcome:
    """As keys_outcome(); more keys in the lake, inside the source's range, are rows that changed since and left the scope: drift."""
    if not _same_keys(s, d) and d.distinct > s.distinct and _inside(d, s):
        return Outcome(DRIFT, f"rows of the lake changed at the source beyond the watermark: {_shown(names[0], s)}, {_shown(names[1], d)}")
    return keys_outcome(s, d, names)


def duplicate_surplus(d: P.KeyStats) -> int | None:
    """Rows beyond one a key; None if there are none."""
    return d.count - d.distinct if d.count > d.distinct else None


def two_stream_outcome(s: P.KeyStats, d: P.KeyStats, names=("source", "lake")) -> Outcome:
    """Repeated keys in the lake outweigh all else; a lake that holds all of the source's range and more rows has drifted."""
    if surplus := duplicate_surplus(d):
        return Outcome(DISCREPANCY, f"{surplus} rows repeat a key, though two streams keep one row a key; reconcile the table. {_shown(names[1], d)}")
    if s == d:
        return Outcome(PASS)
    covers = s.min is None or (d.min is not None and d.min <= s.min and s.max <= d.max)
    more = s.count <= d.count and s.distinct <= d.distinct and (s.count < d.count or s.distinct < d.distinct)
    if more and covers:
        return Outcome(DRIFT, f"the lake keeps rows that the source no longer has: {_shown(names[0], s)}, {_shown(names[1], d)}")
    return Outcome(DISCREPANCY, f"rows of the source are missing: {_shown(names[0], s)}, {_shown(names[1], d)}")


def string_keys_outcome(s: P.StringKeyStats, d: P.StringKeyStats, names=("source", "lake")) -> Outcome:
    if s == d:
        return Outcome(PASS)
    empty = [x.min is None or x.max is None for x in (s, d)]
    inside = all(empty) or (not any(empty) and d.min >= s.min and d.max <= s.max)
    if d.distinct < s.distinct and inside:
        return Outcome(DRIFT, f"the source went on since the last run: {_shown(names[0], s)}, {_shown(names[1], d)}")
    return Outcome(DISCREPANCY, f"the key sets differ: {_shown(names[0], s)}, {_shown(names[1], d)}")


def fold(outcomes: list[Outcome], strict: bool = False) -> int:
    """Exit code: 1 with a discrepancy, else 3 with a table verified in part, else 0. `strict`: 2 if a probe failed."""
    kinds = {o.verdict for o in outcomes}
    if DISCREPANCY in kinds:
        return 1
    if strict and any(o.verdict == SKIPPED and o.reason.startswith("probe") for o in outcomes):
        return 2
    return 3 if PARTIAL in kinds else 0


def summary(outcomes: list[Outcome]) -> str:
    count = lambda v: sum(o.verdict == v for o in outcomes)
    return f"verify summary: pass={count(PASS)} drift={count(DRIFT)} discrepancy={count(DISCREPANCY)} skipped={count(SKIPPED)} partially_verified={count(PARTIAL)}"


def plan_for(source: SourceCatalog, lake: LakeTable, config: Config, table: str) -> Plan:
    """The plan of a table's own mode; basic where its mode can't be told."""
    try:
        columns = extractable(source.columns(table))
        ts, mode = resolve(columns, source.indexes(table), config, table)
    except Exception:
        return Plan(table)
    if mode == TWO_STREAM:
        insert, update = config.two_stream(table)
        return Plan(table, mode, update, insert)
    return Plan(table, mode, ts, None, lake.marks().update if lake.exists() else None) if mode == INCREMENTAL else Plan(table, mode)


class Verifier:
    """Verifies tables one by one; each side is read by a few aggregates over whole tables."""

    def __init__(self, source: SourceCatalog, lake_of: Callable[[str], LakeTable], deep: bool = False, row_cap: int = ROW_CAP, say: Callable[[str], None] = print):
        self.source, self.lake_of, self.deep, self.row_cap, self.say = source, lake_of, deep, row_cap, say

    def run(self, plans: list[Plan]) -> list[Outcome]:
        """A table whose probes fail is skipped and named; the others go on."""
        outcomes = []
        for plan in plans:
            try:
                outcomes.append(self.table(plan))
            except Exception as e:
                outcomes.append(Outcome(SKIPPED, f"probe error: {e}"))
                self.say(f"verify {plan.table} VERDICT: {SKIPPED}: probe error: {e}")
        self.say(summary(outcomes))
        return outcomes

    def table(self, plan: Plan) -> Outcome:
        t, say = plan.table, self.say
        declared, indexes = extractable(self.source.columns(t)), self.source.indexes(t)
        rows, lake_table = self.source.read(t), self.lake_of(t)
        lake = lake_table.read()
        lake_types = {f.name: f.dataType for f in lake.schema.fields}
        missing = [c.name for c in declared if c.name not in lake_types]
        extra = sorted(set(lake_types) - {c.name for c in declared})
        say(f"verify {t} schema: missing in the lake {missing}, extra in the lake {extra}")
        odd = [c.name for c in declared if c.name in lake_types and family_differs(c.data_type, lake_types[c.name])]
        if odd:
            say(f"verify {t} types differ in kind (no verdict): {odd}")
        if plan.cursor and plan.cursor in lake_types:
            say(f"verify {t} freshness: {plan.cursor} source {greatest_as_text(rows, plan.cursor)}, lake {greatest_as_text(lake, plan.cursor)}")
        key = plan.insert or integer_key(declared, indexes) or next((c.name for c in declared if c.name == "id"), None)
        text_key = None if key or plan.mode == TWO_STREAM else string_key(declared, indexes)
        scope = (plan.cursor, key, plan.hwm) if plan.mode == INCREMENTAL and plan.hwm and key else None
        scoped = rows.where(within(*scope)) if scope else rows
        n_source, n_lake = scoped.count(), lake_table.row_count()
        say(f"verify {t}: source {n_source} rows, lake {n_lake} rows")
        stats = None
        if missing:
            outcome = Outcome(DISCREPANCY, f"columns missing in the lake: {missing}")
        elif not self.deep and max(n_source, n_lake) > self.row_cap:
            outcome = Outcome(SKIPPED, f"{n_source} and {n_lake} rows are more than {self.row_cap}; verify in depth to check them")
        elif text_key:
            outcome = string_keys_outcome(*(P.StringKeyStats(*P.string_key_stats(x, text_key).first()) for x in (rows, lake)))
        elif not key:
            outcome = Outcome(PARTIAL, "no key of one column: the set of rows is not verified, only values")
        else:
            latest = latest_per_key(lake.withColumn("__key", F.col(quoted(key)).cast("decimal(20,0)")), "__key", [plan.cursor, "__key"]).drop("__key") if scope else lake
            s, stats = (P.key_stats_value(P.key_stats(x, key).first()) for x in (scoped, latest))
            outcome = (scoped_keys_outcome if scope else two_stream_outcome if plan.mode == TWO_STREAM else keys_outcome)(s, stats)
        if outcome.verdict in (PASS, PARTIAL):
            outcome = self._values(t, declared, lake_types, key, scope, scoped, lake, stats, outcome)
        say(f"verify {t} VERDICT: {outcome.verdict}{': ' + outcome.reason if outcome.reason else ''}")
        if outcome.verdict == PASS and key and not scope and stats and stats.count == stats.distinct:
            self._details(t, declared, lake_types, key, rows, lake)
        return outcome

    def _values(self, t: str, declared: list[ColumnInfo], lake_types: dict, key, scope, scoped: DataFrame, lake: DataFrame, stats, outcome: Outcome) -> Outcome:
        specs = [s for c in declared if c.name in lake_types and c.name != key and (s := P.agg_for(c))]
        if not specs:
            return outcome
        if scope:
            lake = latest_per_key(lake, key, [scope[0], key], scope)
        elif stats and stats.count != stats.distinct:
            self.say(f"verify {t} values: left out, the lake keeps several versions of a key and no watermark tells which to compare")
            return outcome
        sides = [P.agg_values(P.value_aggregates(x, specs).first(), specs) for x in (scoped, lake)]
        wrong = [f"{s.name}: source {a}, lake {b}" for s, (a, b) in zip(specs, P.fingerprints(specs, *sides), strict=True) if a != b]
        if wrong:
            return Outcome(DISCREPANCY, "values differ in " + "; ".join(wrong))
        self.say(f"verify {t} values: {len(specs)} columns are equal")
        return outcome

    def _details(self, t: str, declared: list[ColumnInfo], lake_types: dict, key: str, rows: DataFrame, lake: DataFrame) -> None:
        """Counts of values and a sample of rows, for the eye alone."""
        common = [c.name for c in declared if c.name in lake_types]
        a, b = (P.non_null_census(x, common).first().asDict() for x in (rows, lake))
        differ = {c: (a[c], b[c]) for c in common if a[c] != b[c]}
        self.say(f"verify {t} census: {differ or 'equal'}")
        plain = [c.name for c in declared if c.name in lake_types and c.name != key and c.data_type in ("smallint", "mediumint", "int", "integer", "bigint", *TEXT_TYPES)]
        if plain:
            near = with_ids(lake, key, spread_ids(rows, key, SAMPLE))
            found = sample_compare(sample_rows(rows, key, plain, SAMPLE), near, key, plain).groupBy("status").count().collect()
            self.say(f"verify {t} sample: {dict(sorted(tuple(r) for r in found))}")
