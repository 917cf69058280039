"""Registered queries of the engine's upkeep and decisions: housekeeping of lake tables, watermarks, guards, types, verdicts, settings.

Those over tables work on all their rows; those over decisions return a row a case.
"""

from __future__ import annotations

import dataclasses
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import catalog_queries as Q
from .functions import fingerprint as P
from .functions.cursors import MAX_LONG, MARIADB, Hwm, keyset_sql, offset_sql, parse_time, window_sql
from .functions.types import ColumnInfo, IndexInfo, cast_exactly, evolved_columns, extractable, family_differs, lake_family, source_family, spark_type
from .operators import windows as W
from .plans import config as C
from .plans import decisions as D
from .plans import modes as M
from .plans import verify as V
from .plans.preflight import check, key_reason, shown_hwm
from .plans.state import State
from .sources.catalog import greatest_as_text, null_rows
from .sources.lake_table import LakeTable, Marks
from .sources.scratch import scratch_folder
from .streaming.cursor_stream import append_stream

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


def _values(names: str, *rows: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(f'({r})' for r in rows)}) x({names})"


def _raises(f) -> bool:
    try:
        f()
    except Exception:
        return True
    return False


def _lake(spark: SparkSession, kind: str) -> LakeTable:
    return LakeTable(spark, scratch_folder(spark, kind))


def _orders(spark, sf_dir) -> DataFrame:
    return Q._read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")


# --- values ---


@query("SELECT CAST(9 * count(*) AS VARCHAR) || lpad(CAST(sum(o_orderkey) AS VARCHAR), 37, '0') || '.00' AS total, '9' || lpad(CAST(min(o_orderkey) AS VARCHAR), 37, '0') AS least, '9' || lpad(CAST(max(o_orderkey) AS VARCHAR), 37, '0') AS most, count(*) AS n FROM orders")
def wide_value_aggregates(spark, sf_dir):
    """Decimals of 38 digits, whose sum needs more."""
    wide = F.concat(F.lit("9"), F.lpad(F.col("o_orderkey").cast("string"), 37, "0")).cast("decimal(38,0)")
    rows = Q._read(spark, sf_dir, "orders").select(wide.alias("v"))
    spec = P.ColumnAgg("v", "decimal", 2)
    (v,) = P.agg_values(P.value_aggregates(rows, [spec]).first(), [spec])
    return spark.createDataFrame([(v.sum, v.min, v.max, v.count)], "total string, least string, most string, n long")


@query(_values("case_name, skipped", "'short', false", "'long sum', false", "'beyond capacity', true", "'no rows', false"))
def sum_guard(spark, sf_dir):
    spec = P.ColumnAgg("v", "decimal", 2)
    cases = {"short": P.AggValues("1", "1", "1", 1), "long sum": P.AggValues("1", "0", "9" * 38, 10**9), "beyond capacity": P.AggValues("1", "0", "9" * 60, 10**9), "no rows": P.AggValues(None, None, None, 0)}
    return spark.createDataFrame([(k, P.sum_may_overflow(spec, v)) for k, v in cases.items()], "case_name string, skipped boolean")


@query("SELECT count(*) AS n_rows, sum(CAST(o_orderkey AS BIGINT)) AS keys, true AS refused FROM orders")
def lossless_coercion(spark, sf_dir):
    """Text that holds numbers goes into a long whole; into a type that is too small it is refused."""
    rows = Q._read(spark, sf_dir, "orders").select((F.col("o_orderkey") + 300).cast("string").alias("k"))
    fits = rows.select(cast_exactly(F.col("k"), T.StringType(), T.LongType()).alias("k")).agg(F.count("k").alias("n_rows"), F.sum(F.col("k") - 300).alias("keys"))
    refused = _raises(lambda: rows.select(cast_exactly(F.col("k"), T.StringType(), T.ByteType()).alias("k")).agg(F.max("k")).collect())
    return fits.withColumn("refused", F.lit(refused))


_TYPES = (
    ("tinyint", "tinyint(4)", "tinyint"), ("tinyint", "tinyint(3) unsigned", "smallint"), ("smallint", "smallint", "smallint"), ("smallint", "smallint(5) unsigned", "int"), ("mediumint", "mediumint(8) unsigned", "int"),
    ("int", "int(11)", "int"), ("int", "int(10) unsigned", "bigint"), ("bigint", "bigint(20) unsigned", "bigint"), ("decimal", "decimal(12,3)", "decimal(12,3)"), ("decimal", "decimal(65,30)", "string"), ("float", "float", "float"),
    ("double", "double", "double"), ("date", "date", "date"), ("datetime", "datetime(6)", "timestamp_ntz"), ("varchar", "varchar(10)", "string"), ("json", "json", "string"), ("blob", "blob", "binary"), ("boolean", "boolean", "tinyint"),
)


@query(_values("data_type, column_type, lake_type", *(", ".join(f"'{x}'" for x in r) for r in _TYPES)))
def type_mapping(spark, sf_dir):
    return spark.createDataFrame([(k, c, spark_type(k, c).simpleString()) for k, c, _ in _TYPES], "data_type string, column_type string, lake_type string")


@query(_values("data_type, family, as_text, as_long", "'bigint', 'int', true, false", "'decimal', 'decimal', false, true", "'datetime', 'time', false, true", "'varchar', 'string', false, true", "'blob', 'binary', true, true", "'double', 'float', true, true"))
def type_families(spark, sf_dir):
    """Kinds of types, and whether a lake column of text or of longs differs in kind."""
    kinds = ("bigint", "decimal", "datetime", "varchar", "blob", "double")
    assert lake_family(T.ShortType()) == "int"
    return spark.createDataFrame([(k, source_family(k), family_differs(k, T.StringType()), family_differs(k, T.LongType())) for k in kinds], "data_type string, family string, as_text boolean, as_long boolean")


@query(_values("data_type, kind", "'bigint', 'integer'", "'decimal', 'decimal'", "'datetime', 'seconds'", "'date', 'day'", "'varchar', 'text'", "'tinyint', NULL", "'double', NULL", "'json', NULL", "'blob', NULL"))
def value_kinds(spark, sf_dir):
    kinds = ("bigint", "decimal", "datetime", "date", "varchar", "tinyint", "double", "json", "blob")
    return spark.createDataFrame([(k, getattr(P.agg_for(ColumnInfo("c", k)), "kind", None)) for k in kinds], "data_type string, kind string")


@query(_values("column_name", "'id'", "'Name'"))
def extractable_columns(spark, sf_dir):
    columns = [ColumnInfo("id", "bigint"), ColumnInfo("Name", "VARCHAR"), ColumnInfo("place", "geometry")]
    return spark.createDataFrame([(c.name,) for c in extractable(columns)], "column_name string")


@query(_values("case_name, selected", "'same', 'id,v'", "'new column', 'id,v,w'", "'new column of no type', 'id,v'", "'column gone', 'refused'", "'type changed', 'refused'", "'narrower integer', 'id,v'"))
def schema_evolution(spark, sf_dir):
    lake = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    have = [ColumnInfo("id", "int", "int"), ColumnInfo("v", "text")]
    cases = {"same": have, "new column": [*have, ColumnInfo("w", "date")], "new column of no type": [*have, ColumnInfo("w", "geometry")], "column gone": have[:1], "type changed": [have[0], ColumnInfo("v", "datetime")], "narrower integer": [ColumnInfo("id", "tinyint", "tinyint"), have[1]]}

    def said(columns):
        try:
            return ",".join(evolved_columns(columns, lake))
        except ValueError:
            return "refused"

    return spark.createDataFrame([(k, said(v)) for k, v in cases.items()], "case_name string, selected string")


# --- watermarks and names ---


@query(_values("said, parsed", "'2024-01-02', '2024-01-02 00:00:00.000000'", "'2024-01-02 03:04', '2024-01-02 03:04:00.000000'", "'2024-01-02T03:04:05.6', '2024-01-02 03:04:05.600000'", "'2024-01-02 03:04:05.1234567', '2024-01-02 03:04:05.123456'", "'2024-13-02', NULL", "'soon', NULL"))
def cursor_forms(spark, sf_dir):
    said = ("2024-01-02", "2024-01-02 03:04", "2024-01-02T03:04:05.6", "2024-01-02 03:04:05.1234567", "2024-13-02", "soon")
    return spark.createDataFrame([(x, t.strftime("%Y-%m-%d %H:%M:%S.%f") if (t := parse_time(x)) else None) for x in said], "said string, parsed string")


@query(_values("a, b, is_after", "'2024-01-02T00:00:00/5', '2024-01-02 00:00:00/4', true", "'2024-01-02 00:00:00/4', '2024-01-02T00:00:00.0/4', false", "'2024-01-01 23:59:59.9/9', '2024-01-02/1', false", "'2024-01-02 10:00:00/1', '2024-01-02 9:00:00/9', true"))
def watermark_order(spark, sf_dir):
    mark = lambda x: Hwm(x.partition("/")[0], int(x.partition("/")[2]))
    pairs = [("2024-01-02T00:00:00/5", "2024-01-02 00:00:00/4"), ("2024-01-02 00:00:00/4", "2024-01-02T00:00:00.0/4"), ("2024-01-01 23:59:59.9/9", "2024-01-02/1"), ("2024-01-02 10:00:00/1", "2024-01-02 9:00:00/9")]
    return spark.createDataFrame([(a, b, mark(a).after(mark(b))) for a, b in pairs], "a string, b string, is_after boolean")


@query(_values("kind, sql_text", "'window', 'SELECT `a``b`, `t` FROM `o''k` WHERE `t` IS NOT NULL AND ((`t` = ''2024-01-02 00:00:00'' AND `id` > 7) OR `t` > ''2024-01-02 00:00:00'') AND `id` <= 9 ORDER BY `t`, `id` LIMIT 5'", "'page', 'SELECT `t` FROM `x` WHERE `id` > 3 ORDER BY `id` LIMIT 5'", "'offset', 'SELECT `t` FROM `x` ORDER BY BINARY `t`, `id` LIMIT 5 OFFSET 10'"))
def planned_sql(spark, sf_dir):
    """What a database is asked, names quoted and texts escaped."""
    rows = [("window", window_sql("o'k", ["a`b", "t"], "t", "id", Hwm("2024-01-02", 7), 5, 9)), ("page", keyset_sql("x", ["t"], "id", 3, 5)), ("offset", offset_sql("x", ["t"], [("t", True), ("id", False)], 5, 10, MARIADB))]
    return spark.createDataFrame(rows, "kind string, sql_text string")


@query("SELECT o_orderkey AS \"a`b\", o_orderstatus AS \"x.y z\" FROM orders WHERE o_orderkey > 10")
def odd_names(spark, sf_dir):
    """Columns whose names need quoting, into a lake table and out by key."""
    lake = _lake(spark, "names")
    lake.append(_orders(spark, sf_dir).select(F.col("o_orderkey").alias("a`b"), F.col("o_orderstatus").alias("x.y z")))
    return W.keyset_page(lake.read(), ["a`b", "x.y z"], "a`b", 10, None)


@query("SELECT user_id, event_id, 7 AS __rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) e WHERE r = 1")
def latest_per_key_beside_a_rank(spark, sf_dir):
    """A column of the caller's that has the name of the rank stays."""
    rows = Q._read(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.lit(7).alias("__rank"))
    return W.latest_per_key(rows, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "__rank")


@query("SELECT count(*) AS n_null, (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') FROM events WHERE event_id % 7 <> 0) AS greatest FROM events WHERE event_id % 7 = 0")
def cursor_probes(spark, sf_dir):
    rows = Q._holes(spark, sf_dir)
    return spark.createDataFrame([(null_rows(rows, "ts"), greatest_as_text(rows, "ts"))], "n_null long, greatest string")


# --- lake tables ---


@query("SELECT count(*) AS n_rows, 0 AS left_behind, true AS old_files_gone, true AS needs_force FROM orders")
def vacuum_removed_files(spark, sf_dir):
    """After an upsert of every order, the replaced files go; what is live stays."""
    lake = _lake(spark, "vacuum")
    lake.append(_orders(spark, sf_dir))
    lake.upsert(_orders(spark, sf_dir), "o_orderkey", "o_orderdate")
    later = time.time() + 3600
    planned = lake.vacuum(hours=0, force=True, now=later)
    done = lake.vacuum(apply=True, hours=0, force=True, full=True, now=later)
    left = lake.vacuum(hours=0, force=True, full=True, now=later).files_present
    return lake.read().agg(F.count("*").alias("n_rows")).withColumns({"left_behind": F.lit(left), "old_files_gone": F.lit(0 < planned.files_present <= done.files_present and not planned.applied), "needs_force": F.lit(_raises(lambda: lake.vacuum(hours=0)))})


@query("SELECT count(*) AS n_rows, '2024-01-02 00:00:00' AS updated_at, CAST(7 AS BIGINT) AS last_id, CAST(max(o_orderkey) AS BIGINT) AS insert_id, 13 AS commits FROM orders")
def marks_survive_housekeeping(spark, sf_dir):
    """Watermarks are found below commits that carry none, each kind by itself."""
    lake = _lake(spark, "marks")
    lake.append(_orders(spark, sf_dir))
    lake.commit_marks(Marks(None, _orders(spark, sf_dir).agg(F.max("o_orderkey")).first()[0]))
    lake.commit_marks(Marks(Hwm("2024-01-02 00:00:00", 7)))
    for _ in range(9):
        lake.log.commit(lake.snapshot().version + 1, [], "OPTIMIZE", {})
    marks = lake.marks()
    return lake.read().agg(F.count("*").alias("n_rows")).withColumns({"updated_at": F.lit(marks.update.updated_at), "last_id": F.lit(marks.update.last_id).cast("long"), "insert_id": F.lit(marks.insert).cast("long"), "commits": F.lit(len(lake.log.versions()))})


@query("SELECT count(*) AS n_rows, true AS same_version, 0 AS files_left FROM orders")
def aborted_overwrite(spark, sf_dir):
    """A replacement that is given up leaves the table and its folder as they were."""
    lake = _lake(spark, "abort")
    version, before = lake.append(_orders(spark, sf_dir)), {n for n, _, _ in lake.log.files.walk()}
    with lake.overwrite(lake.schema()) as session:
        session.stage(_orders(spark, sf_dir).limit(5))
    left = [n for n, _, _ in lake.log.files.walk() if n not in before]
    return lake.read().agg(F.count("*").alias("n_rows")).withColumns({"same_version": F.lit(lake.snapshot().version == version), "files_left": F.lit(len(left))})


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def direct_overwrite(spark, sf_dir):
    lake = _lake(spark, "replace")
    lake.append(_orders(spark, sf_dir))
    lake.replace(_orders(spark, sf_dir).where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"))
    lake.replace(lake.read().limit(0))  # no rows: nothing changes
    return lake.read()


@query("SELECT count(*) AS n_rows, true AS sizes_fit, true AS rows_fit, true AS had_none, true AS has_data, true AS one_table FROM orders")
def lake_listing(spark, sf_dir):
    """What the store lists, the log says and the files hold agree; a table without a row has no data."""
    lake = _lake(spark, "listing")
    none = not lake.exists() and lake.schema() is None
    lake.ensure(_orders(spark, sf_dir).schema)
    empty = not lake.has_data()
    lake.append(_orders(spark, sf_dir))
    listed = {n: size for n, size, _ in lake.log.files.walk()}
    fit = all(listed[n] == a["size"] for n, a in lake.snapshot().files.items())
    rows = lake.read().agg(F.count("*").alias("n_rows"))
    return rows.withColumns({"sizes_fit": F.lit(fit), "rows_fit": F.col("n_rows") == lake.row_count(), "had_none": F.lit(none and empty), "has_data": F.lit(lake.has_data()), "one_table": F.lit(LakeTable(spark, lake.path + "/").snapshot().table_id == lake.snapshot().table_id)})


@query("SELECT event_id, ts, user_id FROM events")
def stream_once(spark, sf_dir):
    """A stream into a lake table, run again with a checkpoint that forgot it: each row is there once."""
    folder = scratch_folder(spark, "stream")
    Q._read(spark, sf_dir, "events").select("event_id", "ts", "user_id").write.parquet(f"{folder}/in")
    lake, schema = LakeTable(spark, f"{folder}/lake"), Q._read(spark, sf_dir, "events").select("event_id", "ts", "user_id").schema
    for turn in range(2):
        append_stream(spark.readStream.schema(schema).parquet(f"{folder}/in"), lake, "ts", "event_id", f"{folder}/checkpoint-{turn}", "events").awaitTermination()
    return lake.read()


# --- runs ---


@query("SELECT event_id, ts, user_id, value FROM (SELECT event_id, user_id, value, CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts FROM events) e WHERE ts IS NOT NULL")
def rows_without_a_cursor(spark, sf_dir):
    """Rows whose cursor is null are never taken, all others once."""
    config = dataclasses.replace(Q._config(spark, "holes", timestamps={"events": "ts"}, modes={"events": "incremental"}), tables=["events"])
    rows = Q._holes(spark, sf_dir).select("event_id", "ts", "user_id", "value")
    for until in (0.5, 1.0):
        size = rows.count()
        job = Q._job(spark, sf_dir, config, rows.where(F.col("event_id") <= size * until), "events", window=max(1, size // 3))
        job.selected = ["event_id", "ts", "user_id", "value"]
        M.run_incremental(job, "ts", "event_id")
    return job.lake.read()


@query(_values("case_name, outcome", "'seeded by settings', 'resumed'", "'rows without a watermark', 'refused'", "'full window without progress', 'refused'", "'window without a watermark', 'refused'", "'first run keeps its seed', 'kept'"))
def run_guards(spark, sf_dir):
    """Where a run begins, and where it stops rather than repeat rows."""
    rows, found = Q._read(spark, sf_dir, "orders").select(*Q.ORDERS), {}
    mid = rows.agg(F.date_format(F.percentile_approx("o_orderdate", 0.5), "yyyy-MM-dd HH:mm:ss").alias("m")).first().m

    def job(kind, **more):
        return Q._job(spark, sf_dir, Q._config(spark, kind, timestamps={"orders": "o_orderdate"}, **more), rows)

    own = job("seeded", initial_hwm={"orders": (mid, MAX_LONG)})
    n = M.run_incremental(own, "o_orderdate", "o_orderkey")
    found["seeded by settings"] = "resumed" if n == rows.where(F.col("o_orderdate") > F.lit(mid).cast("timestamp_ntz")).count() else "wrong"
    own = job("unmarked")
    own.lake.append(rows.limit(10))
    found["rows without a watermark"] = "refused" if _raises(lambda: M.run_incremental(own, "o_orderdate", "o_orderkey")) else "wrong"
    page = rows.orderBy("o_orderdate", "o_orderkey").limit(5)
    last = page.agg(F.max(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("t"), "o_orderkey"))).first()[0]
    found["full window without progress"] = "refused" if _raises(lambda: M._window_hwm(page, "o_orderdate", "o_orderkey", Hwm(last[0], last[1]), True, "orders")) else "wrong"
    found["window without a watermark"] = "refused" if _raises(lambda: M._window_hwm(page.withColumn("o_orderkey", F.lit(None).cast("long")), "o_orderdate", "o_orderkey", None, False, "orders")) else "wrong"
    config = Q._config(spark, "first", insert_cursors={"orders": "o_orderkey"}, update_cursors={"orders": "o_orderdate"})
    own = Q._job(spark, sf_dir, config, rows.limit(0))
    own.source.rows["orders"] = rows
    own.stop = lambda: True  # nothing is taken, and the seed is kept all the same
    M.run_two_stream(own, "o_orderkey", "o_orderdate")
    marks = own.lake.marks()
    found["first run keeps its seed"] = "kept" if marks.update and marks.update.last_id == MAX_LONG and marks.insert is None else "wrong"
    return spark.createDataFrame(list(found.items()), "case_name string, outcome string")


@query(_values("case_name, n_rows", "'no size known', 512", "'256 bytes a row', 2097152", "'larger than the budget', 1", "'as thought', 100", "'eight times as long', 65536", "'an eighth as long', 4194304"))
def window_sizes(spark, sf_dir):
    cases = {"no size known": D.window_rows(512, None, 512), "256 bytes a row": D.window_rows(512, 256), "larger than the budget": D.window_rows(1, 1 << 30), "as thought": D.resized(100, 512, 256, 300.0), "eight times as long": D.resized(100, 128, 256, 2048.0), "an eighth as long": D.resized(100, 128, 256, 32.0)}
    return spark.createDataFrame(list(cases.items()), "case_name string, n_rows long")


@query("SELECT CAST(round(8 + 8 + avg(octet_length(encode(o_orderstatus)))) AS BIGINT) AS row_bytes FROM orders")
def measured_rows(spark, sf_dir):
    return spark.createDataFrame([(round(M.measured_row_bytes(_orders(spark, sf_dir))),)], "row_bytes long")


# --- decisions ---


def _columns(*names: str) -> list[ColumnInfo]:
    """name:type, with a ? where it may be null."""
    return [ColumnInfo(n.partition(":")[0], n.partition(":")[2].rstrip("?"), "", n.endswith("?")) for n in names]


_KEY = [IndexInfo("PRIMARY", True, ("id",))]


@query(_values("case_name, cursor_name, mode", "'key and time', 'updated_at', 'incremental'", "'null times', 'updated_at', 'full_refresh'", "'no key', 'created_at', 'full_refresh'", "'asked', 'created_at', 'incremental'", "'no time', 'updated_at', 'full_refresh'", "'cursor of numbers', 'refused', NULL", "'half a pair of cursors', 'refused', NULL", "'two streams', 'updated_at', 'two_stream'", "'text insert cursor', 'refused', NULL"))
def table_modes(spark, sf_dir):
    """Cursor and mode of tables by their columns, keys and settings."""
    config = lambda **more: C.Config("parquet:", ["t"], "", 512, 512, **more)
    pair = {"insert_cursors": {"t": "id"}, "update_cursors": {"t": "updated_at"}}
    cases = {
        "key and time": (_columns("id:bigint", "updated_at:datetime"), _KEY, config()), "null times": (_columns("id:bigint", "updated_at:datetime?"), _KEY, config()), "no key": (_columns("id:bigint", "created_at:timestamp"), [], config()),
        "asked": (_columns("id:bigint", "created_at:timestamp"), [], config(modes={"t": "incremental"})), "no time": (_columns("id:bigint", "v:text"), _KEY, config()), "cursor of numbers": (_columns("id:bigint", "v:int"), _KEY, config(timestamps={"t": "v"})),
        "half a pair of cursors": (_columns("id:bigint", "updated_at:datetime"), _KEY, config(insert_cursors={"t": "id"})), "two streams": (_columns("id:bigint", "updated_at:datetime"), _KEY, config(**pair)), "text insert cursor": (_columns("id:text", "updated_at:datetime"), _KEY, config(**pair)),
    }

    def said(columns, indexes, settings):
        try:
            return D.resolve(columns, indexes, settings, "t")
        except ValueError:
            return "refused", None

    return spark.createDataFrame([(k, *said(*v)) for k, v in cases.items()], "case_name string, cursor_name string, mode string")


@query(_values("case_name, integer_key, string_key, paging", "'integer', 'id', NULL, 'id'", "'text', NULL, 'code', 'code'", "'two columns', NULL, NULL, 'a,b'", "'none', NULL, NULL, 'binary code,id'", "'unique, may be null', NULL, NULL, 'binary code,id'"))
def table_keys(spark, sf_dir):
    """The key that windows go by, and the total order of pages."""
    columns = _columns("id:bigint", "code:varchar", "a:int", "b:int", "n:int?")
    cases = {"integer": (["id"], _KEY), "text": (["code"], [IndexInfo("PRIMARY", True, ("code",))]), "two columns": (["a", "b"], [IndexInfo("PRIMARY", True, ("a", "b"))]), "none": (["code", "id"], []), "unique, may be null": (["code", "id"], [IndexInfo("u", True, ("n",))])}
    rows = [(k, D.integer_key(columns, i), D.string_key(columns, i), ",".join(("binary " if binary else "") + c for c, binary in D.paging_order(names, columns, i))) for k, (names, i) in cases.items()]
    return spark.createDataFrame(rows, "case_name string, integer_key string, string_key string, paging string")


@query(_values("index_name, is_unique, column_names", "'PRIMARY', true, 'o_orderkey'", "'by_date', false, 'o_orderdate,o_custkey'"))
def index_listing(spark, sf_dir):
    source = Q._Source(spark, sf_dir)
    source.more = {"orders": [IndexInfo("by_date", False, ("o_orderdate", "o_custkey"))]}
    return spark.createDataFrame([(i.name, i.unique, ",".join(i.columns)) for i in source.indexes("orders")], "index_name string, is_unique boolean, column_names string")


@query(_values("table_name, sized", "'orders', true", "'events', true", "'customer', true"))
def row_sizes(spark, sf_dir):
    """Average lengths of rows are known for each table, and lie between a byte and what its columns could hold."""
    source = Q._Source(spark, sf_dir)
    return spark.createDataFrame([(t, 0 < (source.average_row_bytes(t) or 0) < 10_000) for t in ("orders", "events", "customer")], "table_name string, sized boolean")


@query(_values("case_name, verdict", "'same', 'PASS'", "'lake lacks some', 'DRIFT'", "'lake has one beyond', 'DISCREPANCY'", "'same, rows moved on', 'PASS'", "'scoped: lake has more inside', 'DRIFT'", "'scoped: lake lacks some', 'DRIFT'", "'two streams: same', 'PASS'", "'two streams: source lost rows', 'DRIFT'", "'two streams: lake lacks rows', 'DISCREPANCY'", "'two streams: a key twice', 'DISCREPANCY'", "'text: same', 'PASS'", "'text: lake lacks some', 'DRIFT'", "'text: lake has others', 'DISCREPANCY'"))
def key_outcomes(spark, sf_dir):
    """The verdict on two key sets, from their fingerprints over whole tables."""
    keys = Q._read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("k"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("code"))
    high = keys.agg(F.max("o_orderkey")).first()[0]
    some = keys.where((F.col("o_orderkey") % 3 != 1) | F.col("o_orderkey").isin(1, high))
    beyond = keys.unionByName(keys.where(F.col("o_orderkey") == high).withColumn("o_orderkey", F.col("o_orderkey") + 1))
    n = lambda df: P.key_stats_value(P.key_stats(df, "o_orderkey").first())
    s = lambda df: P.StringKeyStats(*P.string_key_stats(df, "code").first())
    whole, part, more, twice = n(keys), n(some), n(beyond), n(keys.unionByName(keys.where(F.col("o_orderkey") == high)))
    text, text_part, text_more = s(keys), s(some), s(keys.unionByName(keys.limit(1).withColumn("code", F.lit("z"))))
    cases = {
        "same": V.keys_outcome(whole, whole), "lake lacks some": V.keys_outcome(whole, part), "lake has one beyond": V.keys_outcome(whole, more), "same, rows moved on": V.scoped_keys_outcome(part, part),
        "scoped: lake has more inside": V.scoped_keys_outcome(part, whole), "scoped: lake lacks some": V.scoped_keys_outcome(whole, part), "two streams: same": V.two_stream_outcome(whole, whole), "two streams: source lost rows": V.two_stream_outcome(part, whole),
        "two streams: lake lacks rows": V.two_stream_outcome(whole, part), "two streams: a key twice": V.two_stream_outcome(whole, twice), "text: same": V.string_keys_outcome(text, text), "text: lake lacks some": V.string_keys_outcome(text, text_part), "text: lake has others": V.string_keys_outcome(text, text_more),
    }
    return spark.createDataFrame([(k, o.verdict) for k, o in cases.items()], "case_name string, verdict string")


@query(_values("case_name, exit_code", "'all pass', 0", "'drift', 0", "'in part', 3", "'discrepancy', 1", "'discrepancy and in part', 1", "'probe failed', 0", "'probe failed, strict', 2", "'run: all well', 0", "'run: some failed', 1", "'run: all failed', 2", "'run: interrupted', 1"))
def exit_codes(spark, sf_dir):
    o = lambda *verdicts: [V.Outcome(v, "probe error: x" if v == V.SKIPPED else "") for v in verdicts]
    cases = {
        "all pass": V.fold(o(V.PASS, V.PASS)), "drift": V.fold(o(V.PASS, V.DRIFT)), "in part": V.fold(o(V.PASS, V.PARTIAL)), "discrepancy": V.fold(o(V.DISCREPANCY)), "discrepancy and in part": V.fold(o(V.PARTIAL, V.DISCREPANCY)), "probe failed": V.fold(o(V.SKIPPED, V.PASS)),
        "probe failed, strict": V.fold(o(V.SKIPPED, V.PASS), strict=True), "run: all well": D.run_exit_code(3, 0), "run: some failed": D.run_exit_code(2, 1), "run: all failed": D.run_exit_code(0, 2), "run: interrupted": D.run_exit_code(3, 0, True),
    }
    return spark.createDataFrame(list(cases.items()), "case_name string, exit_code int")


@query(_values("said", "'verify summary: pass=2 drift=1 discrepancy=0 skipped=1 partially_verified=1'"))
def verify_tallies(spark, sf_dir):
    return spark.createDataFrame([(V.summary([V.Outcome(v) for v in (V.PASS, V.DRIFT, V.PASS, V.SKIPPED, V.PARTIAL)]),)], "said string")


@query(_values("case_name, verdict", "'over the cap', 'SKIPPED'", "'within it', 'PASS'", "'on demand', 'PASS'"))
def size_guard(spark, sf_dir):
    """A large table is verified only on demand."""
    rows = _orders(spark, sf_dir)
    lake, n = _lake(spark, "cap"), rows.count()
    lake.append(rows)
    found = []
    for name, cap, deep in (("over the cap", n - 1, False), ("within it", n, False), ("on demand", n - 1, True)):
        outcome = V.Verifier(Q._Source(spark, sf_dir, {"orders": rows}), lambda _: lake, deep=deep, row_cap=cap, say=lambda _: None).table(V.Plan("orders", "full_refresh"))
        found.append((name, outcome.verdict))
    return spark.createDataFrame(found, "case_name string, verdict string")


@query(_values("table_name, mode, cursor_name, insert_name", "'events', 'incremental', 'ts', NULL", "'orders', 'two_stream', 'o_orderdate', 'o_orderkey'", "'lineitem', 'full_refresh', NULL, NULL", "'nowhere', 'basic', NULL, NULL"))
def verify_plans(spark, sf_dir):
    config = C.Config("parquet:", ["events", "orders", "lineitem", "nowhere"], "", 512, 512, timestamps={"events": "ts"}, insert_cursors={"orders": "o_orderkey"}, update_cursors={"orders": "o_orderdate"})
    plans = [V.plan_for(Q._Source(spark, sf_dir), _lake(spark, "plan"), config, t) for t in config.tables]
    return spark.createDataFrame([(p.table, p.mode, p.cursor, p.insert) for p in plans], "table_name string, mode string, cursor_name string, insert_name string")


# --- settings, checks and state ---

_ENV = {"DATABASE_URL": "mysql://u:p@h/db", "TABLES": "a, b", "TARGET_MEMORY_MB": "100"}


@query(_values("case_name, outcome", "'sound', 'a,b'", "'no tables', 'refused'", "'no memory', 'refused'", "'more memory than there is', 'refused'", "'unknown mode', 'refused'", "'two streams by mode', 'refused'", "'watermark without a key', 'refused'", "'reconcile without cursors', 'refused'", "'unknown strategy', 'refused'", "'zero batch', 'refused'", "'other database', 'refused'", "'S3 without keys', 'refused'"))
def settings(spark, sf_dir):
    """Settings that are taken, and those that are refused before anything runs."""
    cases = {
        "sound": {}, "no tables": {"TABLES": " , "}, "no memory": {"TARGET_MEMORY_MB": ""}, "more memory than there is": {"TARGET_MEMORY_MB": "100000"}, "unknown mode": {"TABLE_MODE_a": "weekly"}, "two streams by mode": {"TABLE_MODE_a": "two_stream"}, "watermark without a key": {"TABLE_HWM_a": "2024-01-01"},
        "reconcile without cursors": {"TABLE_RECONCILE_a": "true"}, "unknown strategy": {"UPDATE_STRATEGY": "append"}, "zero batch": {"DEFAULT_BATCH_SIZE": "0"}, "other database": {"DATABASE_URL": "postgres://x"}, "S3 without keys": {"__local": ""},
    }

    def said(more):
        try:
            return ",".join(C.load(_ENV | more, local=None if "__local" in more else "/lake", memory_mb=4096).tables)
        except C.ConfigError:
            return "refused"

    return spark.createDataFrame([(k, said(v)) for k, v in cases.items()], "case_name string, outcome string")


@query(_values("setting, value", "'A', 'environment'", "'B', 'two words'", "'C', 'x=y'"))
def settings_file(spark, sf_dir):
    """Settings from a file, under those of the environment; a file that is not there does no harm."""
    import os
    import tempfile

    with tempfile.NamedTemporaryFile("w", suffix=".env", delete=False) as f:  # read here and now, by the driver alone
        f.write("# comment\nexport A=file\nB='two words'\nC=x=y\n\nnothing\n")
    found = C.with_env_file({"A": "environment"}, f.name)
    os.unlink(f.name)
    assert C.with_env_file({}, f.name) == {}
    return spark.createDataFrame(sorted(found.items()), "setting string, value string")


@query(_values("case_name, said", "'two streams', 'two-stream: id + updated_at'", "'override', 'override'", "'key and time', 'id, updated_at'", "'no key', 'no id'", "'unsafe', 'nullable updated_at (unsafe cursor)'", "'no time', 'no created_at'", "'mark', '2024-01-02 / 7'", "'two marks', 'ins=5 upd=2024-01-02 page=7'"))
def preflight_reasons(spark, sf_dir):
    config = lambda **more: C.Config("parquet:", ["t"], "", 512, 512, **more)
    columns, unsafe = _columns("id:bigint", "updated_at:datetime"), _columns("id:bigint", "updated_at:datetime?")
    pair = config(insert_cursors={"t": "id"}, update_cursors={"t": "updated_at"})
    rows = [
        ("two streams", key_reason(columns, _KEY, pair, "t", "updated_at", "two_stream")), ("override", key_reason(columns, _KEY, config(modes={"t": "full_refresh"}), "t", "updated_at", "full_refresh")), ("key and time", key_reason(columns, _KEY, config(), "t", "updated_at", "incremental")),
        ("no key", key_reason(columns, [], config(), "t", "updated_at", "full_refresh")), ("unsafe", key_reason(unsafe, _KEY, config(), "t", "updated_at", "full_refresh")), ("no time", key_reason(columns, _KEY, config(), "t", "created_at", "full_refresh")),
        ("mark", shown_hwm("incremental", Hwm("2024-01-02", 7), None)), ("two marks", shown_hwm("two_stream", Hwm("2024-01-02", 7), 5)),
    ]
    return spark.createDataFrame(rows, "case_name string, said string")


@query(_values("table_name, state", "'orders', 'two_stream'", "'events', 'incremental'", "'nowhere', 'FAILED:'"))
def preflight_check(spark, sf_dir):
    """Each table's line of a check before a run; the lake is probed, and no table is made."""
    config = dataclasses.replace(Q._config(spark, "check", timestamps={"events": "ts"}, insert_cursors={"orders": "o_orderkey"}, update_cursors={"orders": "o_orderdate"}), tables=["orders", "events", "nowhere"])
    lines: list[str] = []
    failed = check(spark, Q._Source(spark, sf_dir), config, lines.append)
    assert failed == 1 and not LakeTable(spark, f"{config.root}/orders").exists()
    return spark.createDataFrame([tuple(x.split()[:2]) for x in lines[1:]], "table_name string, state string")


@query(_values("table_name, status, n_rows, mode, failed_with", "'a', 'failed', 5, 'incremental', 'gone'", "'b', 'success', 7, 'full_refresh', NULL"))
def run_state(spark, sf_dir):
    """What is kept of runs: a failure does not make the last success forgotten; a broken file is a first run."""
    import os
    import tempfile

    with tempfile.TemporaryDirectory() as folder:  # the driver's own file, as in a run
        path = os.path.join(folder, "state.json")
        state = State(path)
        state.update("a", "success", "incremental", 5, 1.5)
        state.update("a", "failed", error="gone")
        state.update("b", "success", "full_refresh", 7, 0.1)
        kept = State(path).tables
        with open(path, "w") as f:
            f.write("{broken")
        assert State(path).tables == {}
    return spark.createDataFrame([(t, x["last_run_status"], x["last_run_rows"], x["extraction_mode"], x["error"]) for t, x in sorted(kept.items())], "table_name string, status string, n_rows int, mode string, failed_with string")


__all__ = ["ORACLES", "QUERIES"]
