"""Windows, pages, samples and the latest version of each key, as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cursors import Hwm, beyond, within
from ..functions.types import quoted


def _cols(names: list[str]):
    return [F.col(quoted(n)) for n in names]


def cursor_window(df: DataFrame, columns: list[str], ts: str, key: str, hwm: Hwm | None, n: int | None, key_cap: int | None = None) -> DataFrame:
    """The next `n` rows beyond a compound cursor, by time and key; filter and columns reach the scan."""
    rows = df.where(beyond(ts, key, hwm, key_cap)).select(*_cols(columns))
    return rows if n is None else rows.orderBy(*_cols([ts, key])).limit(n)


def keyset_page(df: DataFrame, columns: list[str], key: str, last: int | None, n: int | None) -> DataFrame:
    """The next `n` rows by key; the insert stream's window, too."""
    rows = (df if last is None else df.where(F.col(quoted(key)) > last)).select(*_cols(columns))
    return rows if n is None else rows.orderBy(F.col(quoted(key))).limit(n)


def offset_page(df: DataFrame, columns: list[str], order: list[str], n: int, m: int) -> DataFrame:
    """Rows m to m + n of a total order."""
    return df.select(*_cols(columns)).orderBy(*_cols(order)).offset(m).limit(n)


def batch_hwm(df: DataFrame, ts: str, key: str) -> DataFrame:
    """One row: hwm_updated_at (text with T and microseconds) and hwm_last_id, the greatest (time, key); null keys: none."""
    t, k = F.col(quoted(ts)), F.col(quoted(key))
    found = df.agg(F.max(F.when(t.isNotNull(), F.struct(t.alias("t"), k.cast("long").alias("k")))).alias("h"), F.count_if(k.isNull()).alias("null_keys"))
    sound = F.col("null_keys") == 0
    return found.select(F.when(sound, F.date_format("h.t", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("hwm_updated_at"), F.when(sound, F.col("h.k")).alias("hwm_last_id"))


def latest_per_key(df: DataFrame, key: str, order: list[str], scope: tuple[str, str, Hwm] | None = None) -> DataFrame:
    """The last row of each key by `order` (a total order, so the same row each time); `scope` limits rows to a watermark first."""
    if scope:
        df = df.where(within(*scope))
    rank = "__rank"
    while rank in df.columns:
        rank += "_"
    w = Window.partitionBy(F.col(quoted(key))).orderBy(*(F.col(quoted(c)).desc() for c in order))
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)


def dedup_by_key(df: DataFrame, key: str, order_col: str | None) -> DataFrame:
    """One row of each key: the last by `order_col`, ties by all other columns that can be ordered."""
    rest = [c for c, t in df.dtypes if c not in (key, order_col) and not t.startswith("map")]
    return latest_per_key(df, key, [*([order_col] if order_col else []), *rest])


def spread_ids(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The ids of a sample: the lowest half and the highest half of `n`; two top-n, no sort of the table."""
    k = F.col(quoted(key)).cast("long").alias("id")
    ids = df.select(k).where("id IS NOT NULL")
    low, high = ids.orderBy(F.asc("id")).limit(-(-n // 2)), ids.orderBy(F.desc("id")).limit(n // 2)
    return low.union(high).distinct()


def sample_rows(df: DataFrame, key: str, columns: list[str], n: int = 100) -> DataFrame:
    """The rows of spread_ids()."""
    return with_ids(df, key, spread_ids(df, key, n)).select(*_cols([key, *columns]))


def with_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of `df` whose key is among a sample's few ids, which are broadcast."""
    return df.join(F.broadcast(ids.withColumnRenamed("id", "__id")), F.col(quoted(key)).cast("long") == F.col("__id"), "left_semi")


def sample_compare(source: DataFrame, lake: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """id, status (match, differ, missing) and differing columns, for each row of either sample."""
    k = F.col(quoted(key)).cast("long").alias("id")
    pick = lambda df, mark: df.select(k, F.struct(*_cols(columns)).alias(mark))
    both = pick(source, "s").join(pick(lake, "d"), "id", "full_outer")
    differs = F.array_compact(F.array(*(F.when(~F.col(f"s.{quoted(c)}").eqNullSafe(F.col(f"d.{quoted(c)}")), F.lit(c)) for c in columns)))
    status = F.when(F.col("s").isNull() | F.col("d").isNull(), F.lit("missing")).when(F.size(differs) > 0, F.lit("differ")).otherwise(F.lit("match"))
    return both.select("id", status.alias("status"), F.when(status == "differ", F.array_join(differs, ",")).alias("differing"))
