"""The registered queries of the synchronisation engine, and their SQL.

Each runs one operator, or one whole run, over whole tables. Numbers beyond a
long are text on both sides; doubles are summed as decimals; every limit has a
total order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fingerprint as P
from .functions.cursors import Hwm, within
from .functions.types import ColumnInfo, IndexInfo, lake_schema
from .operators import upsert as U
from .operators import windows as W
from .plans import config as C
from .plans import decisions as D
from .plans import modes as M
from .plans.inspect import evaluate
from .plans.verify import Plan, Verifier
from .sources.catalog import ParquetCatalog
from .sources.lake_table import LakeTable, Marks
from .sources.scratch import scratch_folder

HWM = Hwm("1998-01-01T00:00:00.000000", 100)
EVENTS_HWM = Hwm("2024-01-20 00:00:00", 5000)
ORDERS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_COLS = "o_orderkey, o_custkey, o_totalprice, o_orderdate"
_BEYOND = "o_orderdate IS NOT NULL AND ((o_orderdate = TIMESTAMP '1998-01-01 00:00:00' AND o_orderkey > 100) OR o_orderdate > TIMESTAMP '1998-01-01 00:00:00')"
_WITHIN = "(o_orderdate < TIMESTAMP '1998-01-01 00:00:00' OR (o_orderdate = TIMESTAMP '1998-01-01 00:00:00' AND o_orderkey <= 100))"

# --- scans, windows and pages ---


@query(f"SELECT {_COLS} FROM orders")
def full_scan_projection(spark, sf_dir):
    return _read(spark, sf_dir, "orders").select(*ORDERS)


@query(f"SELECT {_COLS} FROM orders WHERE {_BEYOND} ORDER BY o_orderdate, o_orderkey LIMIT 500")
def incremental_window(spark, sf_dir):
    return W.cursor_window(_read(spark, sf_dir, "orders"), ORDERS, "o_orderdate", "o_orderkey", HWM, 500)


@query(f"SELECT {_COLS} FROM orders WHERE o_orderdate IS NOT NULL ORDER BY o_orderdate, o_orderkey LIMIT 500")
def incremental_first_run(spark, sf_dir):
    return W.cursor_window(_read(spark, sf_dir, "orders"), ORDERS, "o_orderdate", "o_orderkey", None, 500)


@query(f"SELECT {_COLS} FROM orders WHERE {_BEYOND} AND o_orderkey <= 1000 ORDER BY o_orderdate, o_orderkey LIMIT 100000")
def update_window_capped(spark, sf_dir):
    return W.cursor_window(_read(spark, sf_dir, "orders"), ORDERS, "o_orderdate", "o_orderkey", HWM, 100_000, 1000)


@query(f"SELECT {_COLS} FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 500")
def keyset_page(spark, sf_dir):
    return W.keyset_page(_read(spark, sf_dir, "orders"), ORDERS, "o_orderkey", 1000, 500)


@query(f"SELECT {_COLS} FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 200 OFFSET 300")
def offset_page(spark, sf_dir):
    return W.offset_page(_read(spark, sf_dir, "orders"), ORDERS, ["o_orderdate", "o_orderkey"], 200, 300)


@query("SELECT event_id, ts, user_id, event_type FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 300")
def insert_stream_window(spark, sf_dir):
    return W.keyset_page(_read(spark, sf_dir, "events"), ["event_id", "ts", "user_id", "event_type"], "event_id", 500, 300)


@query("SELECT max(event_id) AS hwm_insert_id, count(*) AS n_rows FROM (SELECT event_id FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 300) w")
def insert_watermark(spark, sf_dir):
    return insert_stream_window(spark, sf_dir).agg(F.max("event_id").alias("hwm_insert_id"), F.count("*").alias("n_rows"))


@query("SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS hwm_updated_at, event_id AS hwm_last_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def batch_hwm(spark, sf_dir):
    return W.batch_hwm(_read(spark, sf_dir, "events"), "ts", "event_id")


_HOLES = "(SELECT event_id, user_id, value, CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts FROM events)"


def _holes(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", "user_id", "value", F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts"))


@query(f"SELECT count(*) AS n_null FROM {_HOLES} e WHERE ts IS NULL")
def cursor_null_count(spark, sf_dir):
    return _holes(spark, sf_dir).where(F.col("ts").isNull()).agg(F.count("*").alias("n_null"))


@query(f"SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_cursor FROM {_HOLES} e")
def freshness_max_cursor(spark, sf_dir):
    return _holes(spark, sf_dir).agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("max_cursor"))


# --- the latest row of each key ---

_RANKED = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r"


@query("SELECT event_id, ts, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC) AS r FROM events) e WHERE r = 1")
def dedup_by_key(spark, sf_dir):
    return W.dedup_by_key(_read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"), "user_id", "ts")


@query(f"SELECT event_id, ts, user_id, event_type, props FROM (SELECT *, {_RANKED} FROM events) e WHERE r = 1")
def latest_per_key(spark, sf_dir):
    return W.latest_per_key(_read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props"), "user_id", ["ts", "event_id"])


_SCOPED_EVENTS = "(ts < TIMESTAMP '2024-01-20 00:00:00' OR (ts = TIMESTAMP '2024-01-20 00:00:00' AND event_id <= 5000))"


@query(f"SELECT count(*) AS n_rows, CAST(sum(event_id) AS VARCHAR) AS event_id_sum, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS ts_min, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts_max, CAST(sum(length(event_type)) AS VARCHAR) AS type_mass FROM (SELECT *, {_RANKED} FROM events WHERE {_SCOPED_EVENTS}) e WHERE r = 1")
def latest_per_key_scoped_aggregate(spark, sf_dir):
    latest = W.latest_per_key(_read(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], ("ts", "event_id", EVENTS_HWM))
    specs = [P.ColumnAgg("event_id", "integer"), P.ColumnAgg("ts", "seconds"), P.ColumnAgg("event_type", "text")]
    return P.value_aggregates(latest, specs).select(F.col("event_id__n").alias("n_rows"), F.col("event_id__sum").alias("event_id_sum"), F.col("ts__min").alias("ts_min"), F.col("ts__max").alias("ts_max"), F.col("event_type__sum").alias("type_mass"))


# --- fingerprints ---


def _key_stats_sql(key: str, rows: str) -> str:
    return f"SELECT count(*) AS row_count, count(DISTINCT {key}) AS distinct_keys, CAST(min({key}) AS VARCHAR) AS min_key, CAST(max({key}) AS VARCHAR) AS max_key, bit_xor({key}) AS xor_keys, bit_xor(DISTINCT {key}) AS distinct_xor, CAST(sum(DISTINCT {key}) AS VARCHAR) AS sum_keys FROM {rows}"


@query(_key_stats_sql("o_orderkey", "orders"))
def key_stats(spark, sf_dir):
    return P.key_stats(_read(spark, sf_dir, "orders"), "o_orderkey")


@query(_key_stats_sql("user_id", "events"))
def key_stats_of_repeated_keys(spark, sf_dir):
    return P.key_stats(_read(spark, sf_dir, "events"), "user_id")


@query(_key_stats_sql("o_orderkey", f"orders WHERE {_WITHIN}"))
def key_stats_scoped(spark, sf_dir):
    return P.key_stats(_read(spark, sf_dir, "orders").where(within("o_orderdate", "o_orderkey", HWM)), "o_orderkey")


@query(_key_stats_sql("user_id", f"(SELECT *, {_RANKED} FROM events) e WHERE r = 1"))
def latest_key_stats(spark, sf_dir):
    return P.key_stats(W.latest_per_key(_read(spark, sf_dir, "events"), "user_id", ["ts", "event_id"]), "user_id")


@query("SELECT count(*) AS row_count, count(DISTINCT k) AS distinct_keys, CAST(min(k) AS VARCHAR) AS min_key, CAST(max(k) AS VARCHAR) AS max_key, CAST(sum(k) AS VARCHAR) AS sum_keys FROM (SELECT CAST(o_orderkey AS HUGEINT) + CAST('18446744073709000000' AS HUGEINT) AS k FROM orders) o")
def key_stats_beyond_long(spark, sf_dir):
    far = _read(spark, sf_dir, "orders").select((F.col("o_orderkey").cast("decimal(20,0)") + F.lit("18446744073709000000").cast("decimal(20,0)")).cast("decimal(20,0)").alias("k"))
    return P.key_stats(far, "k").select("row_count", "distinct_keys", "min_key", "max_key", "sum_keys")


@query("SELECT count(*) AS row_count, count(DISTINCT c_name) AS distinct_keys, min(c_name) AS min_key, max(c_name) AS max_key FROM customer")
def string_key_stats(spark, sf_dir):
    return P.string_key_stats(_read(spark, sf_dir, "customer"), "c_name")


@query("SELECT count(*) AS row_count FROM orders")
def row_count(spark, sf_dir):
    return _read(spark, sf_dir, "orders").agg(F.count("*").alias("row_count"))


@query(f"SELECT count(*) AS row_count FROM orders WHERE {_WITHIN}")
def row_count_scoped(spark, sf_dir):
    return _read(spark, sf_dir, "orders").where(within("o_orderdate", "o_orderkey", HWM)).agg(F.count("*").alias("row_count"))


@query("SELECT count(d.doc_id) AS doc_id, count(text) AS text, count(lang) AS lang, count(quality) AS quality, count(toxic) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def non_null_census(spark, sf_dir):
    joined = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang").join(_read(spark, sf_dir, "labels"), "doc_id", "left")
    return P.non_null_census(joined, ["doc_id", "text", "lang", "quality", "toxic"])


def _money(spark, sf_dir):
    return _read(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


_SPECS = [P.ColumnAgg("o_custkey", "integer"), P.ColumnAgg("o_totalprice", "decimal", 2), P.ColumnAgg("o_orderdate", "seconds"), P.ColumnAgg("o_orderpriority", "text")]


@query("SELECT CAST(sum(o_custkey) AS VARCHAR) AS o_custkey__sum, CAST(min(o_custkey) AS VARCHAR) AS o_custkey__min, CAST(max(o_custkey) AS VARCHAR) AS o_custkey__max, count(o_custkey) AS o_custkey__n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS o_totalprice__sum, CAST(min(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS o_totalprice__min, CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS o_totalprice__max, count(o_totalprice) AS o_totalprice__n, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS o_orderdate__min, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS o_orderdate__max, count(o_orderdate) AS o_orderdate__n, CAST(sum(length(o_orderpriority)) AS VARCHAR) AS o_orderpriority__sum, count(o_orderpriority) AS o_orderpriority__n FROM orders")
def value_aggregates(spark, sf_dir):
    return P.value_aggregates(_money(spark, sf_dir), _SPECS).drop("o_orderdate__sum", "o_orderpriority__min", "o_orderpriority__max")


@query("SELECT 'sum=' || CAST(sum(o_custkey) AS VARCHAR) || '|min=' || CAST(min(o_custkey) AS VARCHAR) || '|max=' || CAST(max(o_custkey) AS VARCHAR) || '|n=' || CAST(count(o_custkey) AS VARCHAR) AS o_custkey, 'sum=' || CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) || '|min=' || CAST(min(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) || '|max=' || CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) || '|n=' || CAST(count(o_totalprice) AS VARCHAR) AS o_totalprice, 'min=' || strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') || '|max=' || strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') || '|n=' || CAST(count(o_orderdate) AS VARCHAR) AS o_orderdate, 'len=' || CAST(sum(length(o_orderpriority)) AS VARCHAR) || '|n=' || CAST(count(o_orderpriority) AS VARCHAR) AS o_orderpriority FROM orders")
def fingerprint(spark, sf_dir):
    return P.fingerprint_columns(_money(spark, sf_dir), _SPECS)


@query("SELECT CAST(sum(length(text)) AS VARCHAR) AS text_mass, count(text) AS n FROM documents")
def text_mass(spark, sf_dir):
    return P.value_aggregates(_read(spark, sf_dir, "documents"), [P.ColumnAgg("text", "text")]).select(F.col("text__sum").alias("text_mass"), F.col("text__n").alias("n"))


@query("SELECT CAST(sum(CAST(o_orderkey AS HUGEINT) * 10000000000 + 7) AS VARCHAR) || '0000000000000000000000000000' AS wide_sum, count(*) AS n FROM orders")
def wide_decimal_sum(spark, sf_dir):
    # Numbers of 50 digits, as text: more than any decimal type holds.
    wide = _read(spark, sf_dir, "orders").select(F.concat((F.col("o_orderkey").cast("decimal(38,0)") * F.lit(10_000_000_000) + F.lit(7)).cast("decimal(38,0)").cast("string"), F.lit("0" * 28)).alias("w"))
    limbs = P.value_aggregates(wide, [P.ColumnAgg("w", "decimal", 0)])
    row = limbs.first()
    return spark.createDataFrame([(P.agg_values(row, [P.ColumnAgg("w", "decimal", 0)])[0].sum, row.w__n)], "wide_sum string, n long")


@query("SELECT count(*) - count(DISTINCT user_id) AS surplus FROM events")
def duplicate_key_surplus(spark, sf_dir):
    return P.key_stats(_read(spark, sf_dir, "events"), "user_id").select((F.col("row_count") - F.col("distinct_keys")).alias("surplus"))


@query("SELECT CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS VARCHAR) AS quantity_sum, CAST(max(CAST(l_extendedprice AS DECIMAL(18,2))) AS VARCHAR) AS price_max, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS ship_max, count(*) AS n, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) k) AS surplus FROM lineitem")
def composite_key_has_no_fingerprint_key(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("decimal(18,2)")).withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(18,2)"))
    values = P.value_aggregates(rows, [P.ColumnAgg("l_quantity", "decimal", 2), P.ColumnAgg("l_extendedprice", "decimal", 2), P.ColumnAgg("l_shipdate", "seconds")])
    keys = rows.select("l_orderkey", "l_linenumber").distinct().agg(F.count("*").alias("k"))
    return values.join(F.broadcast(keys)).select(F.col("l_quantity__sum").alias("quantity_sum"), F.col("l_extendedprice__max").alias("price_max"), F.col("l_shipdate__max").alias("ship_max"), F.col("l_quantity__n").alias("n"), (F.col("l_quantity__n") - F.col("k")).alias("surplus"))  # one row each


# --- samples ---

_SPREAD = "(SELECT o_orderkey AS id FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50) a UNION SELECT o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 50) b)"


@query(f"SELECT id FROM {_SPREAD} s")
def sample_ids_spread(spark, sf_dir):
    return W.spread_ids(_read(spark, sf_dir, "orders"), "o_orderkey", 100)


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT id FROM {_SPREAD} s)")
def sample_rows(spark, sf_dir):
    return W.sample_rows(_read(spark, sf_dir, "orders"), "o_orderkey", ["o_custkey", "o_orderstatus", "o_orderpriority"], 100)


@query(f"SELECT s.id, CASE WHEN s.id % 10 = 3 THEN 'missing' WHEN s.id % 10 = 4 THEN 'differ' ELSE 'match' END AS status, CASE WHEN s.id % 10 = 4 THEN 'o_orderstatus' END AS differing FROM {_SPREAD} s")
def sample_compare(spark, sf_dir):
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    rows = W.sample_rows(_read(spark, sf_dir, "orders"), "o_orderkey", columns, 100)
    other = rows.where(F.col("o_orderkey") % 10 != 3).withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 4, F.lit("?")).otherwise(F.col("o_orderstatus")))
    return W.sample_compare(rows, other, "o_orderkey", columns)


# --- upserts and schema ---

_NEW_SQL = "SELECT o_orderkey, o_custkey, CAST(o_totalprice + 1 AS DECIMAL(18,2)) AS o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 10 = 0 UNION ALL SELECT o_orderkey + 10000000, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)), o_orderdate FROM orders WHERE o_orderkey > 14990"
_UPSERT_SQL = f"WITH n AS ({_NEW_SQL}) SELECT * FROM n UNION ALL SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)), o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)"


def _target(spark, sf_dir):
    return _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), "o_orderdate")


def _new_versions(spark, sf_dir):
    rows = _read(spark, sf_dir, "orders")
    changed = rows.where(F.col("o_orderkey") % 10 == 0).select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).cast("decimal(18,2)").alias("o_totalprice"), "o_orderdate")
    return changed.unionByName(_target(spark, sf_dir).where("o_orderkey > 14990").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000))


@query(_UPSERT_SQL)
def upsert_overwrite(spark, sf_dir):
    return U.upsert_by_replacement(_target(spark, sf_dir), _new_versions(spark, sf_dir), "o_orderkey")


@query(_UPSERT_SQL)
def upsert_merge(spark, sf_dir):
    return U.upsert_by_merge(_target(spark, sf_dir), _new_versions(spark, sf_dir), "o_orderkey")


@query(_UPSERT_SQL)
def upsert_in_lake(spark, sf_dir):
    lake = LakeTable(spark, scratch_folder(spark, "upsert"))
    lake.append(_target(spark, sf_dir))
    lake.upsert(_new_versions(spark, sf_dir), "o_orderkey", "o_orderdate")
    return lake.read()


@query(_UPSERT_SQL)
def merge_in_lake(spark, sf_dir):
    lake = LakeTable(spark, scratch_folder(spark, "merge"))
    lake.append(_target(spark, sf_dir))
    lake.upsert(_new_versions(spark, sf_dir), "o_orderkey", "o_orderdate", merge=True)
    return lake.read()


_SPLIT_SQL = "SELECT event_id, ts, user_id, NULL AS props FROM events WHERE event_id < 100 UNION ALL SELECT event_id, ts, user_id, props FROM events WHERE event_id >= 100"


@query(_SPLIT_SQL)
def schema_merge_append(spark, sf_dir):
    rows = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    return U.schema_merged(rows.where("event_id < 100").drop("props"), rows.where("event_id >= 100"))


@query(_SPLIT_SQL)
def schema_merge_in_lake(spark, sf_dir):
    rows = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    lake = LakeTable(spark, scratch_folder(spark, "schema"))
    lake.append(rows.where("event_id < 100").drop("props"))
    lake.append(rows.where("event_id >= 100"))
    return lake.read()


@query("SELECT event_id, ts FROM events WHERE event_id < 100")
def time_travel(spark, sf_dir):
    rows = _read(spark, sf_dir, "events").select("event_id", "ts")
    lake = LakeTable(spark, scratch_folder(spark, "travel"))
    first = lake.append(rows.where("event_id < 100"))
    lake.append(rows.where("event_id >= 100"))
    return lake.read(first)


# --- whole runs ---


class _Source(ParquetCatalog):
    """The tables as a source whose rows can be set: (table, rows) replaces what is in the folder."""

    def __init__(self, spark, folder, rows: dict | None = None):
        super().__init__(spark, folder, {"orders": ["o_orderkey"], "events": ["event_id"], "customer": ["c_name"]}, {"orders": ["o_orderdate"], "events": ["ts"]})
        self.rows = rows or {}

    def read(self, table):
        return self.rows[table] if table in self.rows else super().read(table)


def _config(spark, kind: str, **more) -> C.Config:
    return C.Config("parquet:", ["orders"], scratch_folder(spark, kind), 512, 512, **more)


def _job(spark, sf_dir, config: C.Config, rows: DataFrame, table: str = "orders", window: int | None = None) -> M.Job:
    job, _, _ = M.prepare(spark, _Source(spark, sf_dir, {table: rows}), config, table, windowed=False)
    job.rows = window
    return job


@query(f"SELECT {_COLS} FROM orders")
def incremental_final_state(spark, sf_dir):
    """Three runs by the cursor, each seeing more of the source; one of them in several windows."""
    config = _config(spark, "incremental", timestamps={"orders": "o_orderdate"})
    rows = _read(spark, sf_dir, "orders").select(*ORDERS)
    size = max(1, -(-rows.where("o_orderdate < TIMESTAMP_NTZ '1997-01-01 00:00:00'").count() // 2))
    for until, window in (("1997-01-01", size), ("1999-06-01", None), ("9999-01-01", None)):
        job = _job(spark, sf_dir, config, rows.where(f"o_orderdate < TIMESTAMP_NTZ '{until} 00:00:00'"), window=window)
        M.run_incremental(job, "o_orderdate", "o_orderkey")
    return job.lake.read()


@query(f"SELECT {_COLS} FROM orders WHERE o_orderkey % 2 = 0")
def full_refresh_snapshot(spark, sf_dir):
    """A refresh, and another from a source that has lost rows and a column."""
    config = _config(spark, "refresh", modes={"orders": "full_refresh"})
    rows = _read(spark, sf_dir, "orders")
    M.run_full_refresh(_job(spark, sf_dir, config, rows))
    job = _job(spark, sf_dir, config, rows.where("o_orderkey % 2 = 0").select(*ORDERS))
    M.run_full_refresh(job)
    return job.lake.read()


_TWO_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 AND o_orderkey <= 1000 THEN 'changed' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 10 = 0 AND o_orderkey <= 1000 THEN TIMESTAMP '2030-01-01 00:00:00' ELSE o_orderdate END AS o_orderdate FROM orders"


def _two_stream(spark, sf_dir, **more):
    config = _config(spark, "two-stream", insert_cursors={"orders": "o_orderkey"}, update_cursors={"orders": "o_orderdate"}, **more)
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    M.run_two_stream(_job(spark, sf_dir, config, rows.where("o_orderkey <= 1000")), "o_orderkey", "o_orderdate")
    hit = (F.col("o_orderkey") % 10 == 0) & (F.col("o_orderkey") <= 1000)
    later = rows.select("o_orderkey", F.when(hit, F.lit("changed")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(hit, F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("o_orderdate")).alias("o_orderdate"))
    return config, rows, later


@query(_TWO_SQL)
def two_stream_final_state(spark, sf_dir):
    """New rows by key, then changed rows up to it; files without changed keys are left alone."""
    config, _, later = _two_stream(spark, sf_dir)
    job = _job(spark, sf_dir, config, later)
    M.run_two_stream(job, "o_orderkey", "o_orderdate")
    return job.lake.read()


@query(_TWO_SQL)
def two_stream_merge_final_state(spark, sf_dir):
    config, _, later = _two_stream(spark, sf_dir, update_strategy="merge")
    job = _job(spark, sf_dir, config, later)
    M.run_two_stream(job, "o_orderkey", "o_orderdate")
    return job.lake.read()


@query(f"SELECT count(*) AS n_rows, max(o_orderkey) AS hwm_insert_id, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS hwm_updated_at, 9223372036854775807 AS hwm_last_id FROM ({_TWO_SQL}) t")
def reconcile_marks(spark, sf_dir):
    """A reconcile brings the table level and re-seeds all watermarks, in one commit."""
    config, _, later = _two_stream(spark, sf_dir)
    job = _job(spark, sf_dir, config, later)
    M.run_reconcile(job, "o_orderkey", "o_orderdate")
    marks = job.lake.marks()
    return job.lake.read().agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(marks.insert).cast("long").alias("hwm_insert_id"), F.lit(marks.update.updated_at).alias("hwm_updated_at"), F.lit(marks.update.last_id).cast("long").alias("hwm_last_id"))


@query("SELECT v AS verdict, t AS case_name FROM (VALUES ('PASS', 'equal'), ('DRIFT', 'source went on'), ('DISCREPANCY', 'row too many'), ('DISCREPANCY', 'value changed'), ('PASS', 'text key'), ('PARTIALLY_VERIFIED', 'no key')) x(v, t)")
def verify_verdicts(spark, sf_dir):
    """The verdicts of a table that was synced and then went on, or was tampered with."""
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    changed = rows.withColumn("o_custkey", F.when(F.col("o_orderkey") == 7, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    cases = {
        "equal": ("orders", rows, rows), "source went on": ("orders", rows, rows.where("o_orderkey % 5 <> 1")),
        "row too many": ("orders", rows.where("o_orderkey < 1000"), rows), "value changed": ("orders", rows, changed),
        "text key": ("customer", _read(spark, sf_dir, "customer"), _read(spark, sf_dir, "customer")), "no key": ("lineitem", _read(spark, sf_dir, "lineitem"), _read(spark, sf_dir, "lineitem")),
    }
    found = []
    for name, (table, source, lake_rows) in cases.items():
        lake = LakeTable(spark, scratch_folder(spark, "verify"))
        lake.append(lake_rows)
        outcome = Verifier(_Source(spark, sf_dir, {table: source}), lambda _, lake=lake: lake, deep=True, say=lambda _: None).table(Plan(table, "full_refresh"))
        found.append((outcome.verdict, name))
    return spark.createDataFrame(found, "verdict string, case_name string")


# --- decisions ---


@query("SELECT n AS column_name, s AS source_type, k AS lake_type FROM (VALUES ('o_orderkey', 'bigint', 'bigint'), ('o_custkey', 'bigint', 'bigint'), ('o_orderstatus', 'text', 'string'), ('o_totalprice', 'double', 'double'), ('o_orderdate', 'datetime', 'timestamp_ntz'), ('o_orderpriority', 'text', 'string')) x(n, s, k)")
def schema_discovery(spark, sf_dir):
    columns = _Source(spark, sf_dir).columns("orders")
    schema = lake_schema(columns)
    return spark.createDataFrame([(c.name, c.data_type, schema[c.name].dataType.simpleString()) for c in columns], "column_name string, source_type string, lake_type string")


@query("SELECT t AS table_name, m AS mode FROM (VALUES ('events', 'incremental'), ('orders', 'two_stream'), ('lineitem', 'full_refresh'), ('customer', 'full_refresh')) x(t, m)")
def mode_resolution(spark, sf_dir):
    source = _Source(spark, sf_dir)
    config = C.Config("parquet:", ["events", "orders", "lineitem", "customer"], "", 512, 512, timestamps={"events": "ts"}, insert_cursors={"orders": "o_orderkey"}, update_cursors={"orders": "o_orderdate"})
    return spark.createDataFrame([(t, D.resolve(source.columns(t), source.indexes(t), config, t)[1]) for t in config.tables], "table_name string, mode string")


@query("SELECT c AS cursor_column, v AS verdict FROM (VALUES ('a', 'ideal'), ('b', 'ok'), ('c', 'usable but slow'), ('d', 'unsafe')) x(c, v)")
def cursor_grades(spark, sf_dir):
    columns = [ColumnInfo("id", "bigint", "bigint", False, "PRI"), *(ColumnInfo(n, "datetime", "datetime", n == "d") for n in "abcd")]
    indexes = [IndexInfo("PRIMARY", True, ("id",)), IndexInfo("ia", False, ("a", "b"))]
    return spark.createDataFrame([(c.column, c.verdict) for c in evaluate("t", columns, indexes).candidates], "cursor_column string, verdict string")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows by cursor land in a lake table with their watermarks; the latest order of each customer is read back."""
    config = _config(spark, "flagship", timestamps={"orders": "o_orderdate"})
    job = _job(spark, sf_dir, config, _read(spark, sf_dir, "orders"), window=500)
    M.run_incremental(job, "o_orderdate", "o_orderkey")
    return W.latest_per_key(job.lake.read(), "o_custkey", ["o_orderdate", "o_orderkey"])


__all__ = ["ORACLES", "QUERIES", "Marks", "flagship"]
