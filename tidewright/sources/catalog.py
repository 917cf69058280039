"""Source catalogs: what tables there are, how they are declared, and their rows."""

from __future__ import annotations

import re
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cursors import DERBY, MARIADB, Dialect
from ..functions.types import ColumnInfo, IndexInfo, quoted


class SourceCatalog(Protocol):
    """What the engine needs of a source."""

    def columns(self, table: str) -> list[ColumnInfo]: ...

    def indexes(self, table: str) -> list[IndexInfo]: ...

    def average_row_bytes(self, table: str) -> int | None: ...

    def read(self, table: str) -> DataFrame: ...

    def query(self, sql: str) -> DataFrame | None:
        """Rows of a statement that the source plans; None where only plans over read() do."""


class SourceTableMissing(Exception):
    pass


# What Spark's types are called at the source.
_DECLARED = {"tinyint": "tinyint", "smallint": "smallint", "int": "int", "bigint": "bigint", "float": "float", "double": "double", "string": "text", "date": "date", "timestamp": "timestamp", "timestamp_ntz": "datetime", "boolean": "boolean", "binary": "blob"}


def declared(field: T.StructField, nullable: bool = True) -> ColumnInfo:
    """A field's declaration: its `source_type` metadata, else what its type is called."""
    said = field.metadata.get("source_type")
    if said:
        return ColumnInfo(field.name, re.split(r"[ (]", said)[0].lower(), said, nullable)
    kind = field.dataType.simpleString()
    if isinstance(field.dataType, T.DecimalType):
        return ColumnInfo(field.name, "decimal", kind, nullable, numeric_scale=field.dataType.scale)
    return ColumnInfo(field.name, _DECLARED.get(kind, kind.partition("<")[0]), kind, nullable)


class ParquetCatalog:
    """Tables that are Parquet below a folder; keys and columns without nulls are said, as files can't say them."""

    def __init__(self, spark: SparkSession, folder: str, keys: dict[str, list[str]] | None = None, not_null: dict[str, list[str]] | None = None, indexes: dict[str, list[IndexInfo]] | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.keys, self.not_null, self.more = keys or {}, not_null or {}, indexes or {}

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def columns(self, table: str) -> list[ColumnInfo]:
        try:
            schema = self.read(table).schema
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                raise SourceTableMissing(f"there is no source table {table}") from None
            raise
        firm = {*self.keys.get(table, []), *self.not_null.get(table, [])}
        return [declared(f, f.name not in firm) for f in schema.fields]

    def indexes(self, table: str) -> list[IndexInfo]:
        key = self.keys.get(table)
        return [*([IndexInfo("PRIMARY", True, tuple(key))] if key else []), *self.more.get(table, [])]

    def average_row_bytes(self, table: str) -> int | None:
        df = self.read(table)
        n = df.count()  # from the footers
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}.parquet")
        size = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
        return size // n if n else None

    def query(self, sql: str) -> DataFrame | None:
        return None


class JdbcCatalog:
    """Tables of a database, by its own catalog (MariaDB) or by JDBC metadata (others)."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str] | None = None, dialect: Dialect | None = None, schema: str | None = None, fetchsize: int = 10_000):
        self.spark, self.url, self.schema = spark, url, schema
        self.properties = {"fetchsize": str(fetchsize), **(properties or {})}
        self.dialect = dialect or (DERBY if ":derby:" in url else MARIADB)
        self.own_catalog = url.startswith(("jdbc:mysql", "jdbc:mariadb"))

    def query(self, sql: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, f"({sql}) w", properties=self.properties)

    def read(self, table: str, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
        """The whole table; `partition` (column, least, greatest, number) reads it by so many connections."""
        if partition is None:
            return self.spark.read.jdbc(self.url, self.dialect.name(table), properties=self.properties)
        column, low, high, n = partition
        return self.spark.read.jdbc(self.url, self.dialect.name(table), column=self.dialect.name(column), lowerBound=low, upperBound=high, numPartitions=n, properties=self.properties)

    def read_by_key(self, table: str, key: str, connections: int) -> DataFrame:
        """The whole table by ranges of an integer key that is never null, each over a connection and task of its own."""
        name = self.dialect.name(key)
        ends = self.query(f"SELECT MIN({name}) a, MAX({name}) b FROM {self.dialect.name(table)}").first()
        if ends[0] is None or connections < 2:
            return self.read(table)
        low, high = int(ends[0]), int(ends[1])
        return self.read(table, (key, low, high + 1, min(connections, high - low + 1)))

    def columns(self, table: str) -> list[ColumnInfo]:
        if self.own_catalog:
            rows = self.query(f"SELECT column_name n, data_type t, column_type c, is_nullable u, column_key k, numeric_scale s, ordinal_position o FROM information_schema.columns WHERE table_schema = DATABASE() AND table_name = '{table.replace(chr(39), chr(39) * 2)}'").collect()  # a row a column
            found = [ColumnInfo(r.n, r.t.lower(), r.c, r.u == "YES", r.k or "", r.s) for r in sorted(rows, key=lambda r: r.o)]
        else:
            found = self._by_metadata(table)
        if not found:
            raise SourceTableMissing(f"there is no source table {table}")
        return found

    def indexes(self, table: str) -> list[IndexInfo]:
        if not self.own_catalog:
            return self._indexes_by_metadata(table)
        parts = self.query(f"SELECT index_name n, non_unique u, seq_in_index s, column_name c FROM information_schema.statistics WHERE table_schema = DATABASE() AND table_name = '{table.replace(chr(39), chr(39) * 2)}'")
        grouped = parts.where("c IS NOT NULL").groupBy("n", "u").agg(F.sort_array(F.collect_list(F.struct("s", "c"))).alias("p")).collect()
        return [IndexInfo(r.n, int(r.u) == 0, tuple(x.c for x in r.p)) for r in sorted(grouped, key=lambda r: (r.n != "PRIMARY", r.n))]

    def average_row_bytes(self, table: str) -> int | None:
        if not self.own_catalog:
            return None
        r = self.query(f"SELECT avg_row_length a FROM information_schema.tables WHERE table_schema = DATABASE() AND table_name = '{table.replace(chr(39), chr(39) * 2)}'").first()
        return int(r.a) if r and r.a else None

    # --- JDBC metadata ---

    def _connection(self):
        jvm = self.spark._jvm
        p = jvm.java.util.Properties()
        for k, v in self.properties.items():
            p.setProperty(k, v)
        return jvm.java.sql.DriverManager.getConnection(self.url, p)

    def _by_metadata(self, table: str) -> list[ColumnInfo]:
        names = {"integer": "int", "clob": "longtext", "timestamp": "timestamp", "blob": "blob", "varchar () for bit data": "varbinary", "char () for bit data": "binary", "real": "float", "long varchar": "text"}
        c = self._connection()
        try:
            rows, out = c.getMetaData().getColumns(None, self.schema, table, None), []
            while rows.next():
                kind = rows.getString("TYPE_NAME").lower()
                kind = names.get(kind, kind)
                size, scale = rows.getInt("COLUMN_SIZE"), rows.getInt("DECIMAL_DIGITS")
                out.append((rows.getInt("ORDINAL_POSITION"), ColumnInfo(rows.getString("COLUMN_NAME"), kind, f"{kind}({size},{scale})" if kind in ("decimal", "numeric") else kind, rows.getInt("NULLABLE") != 0, numeric_scale=scale if kind in ("decimal", "numeric") else None)))
            return [x for _, x in sorted(out, key=lambda x: x[0])]
        finally:
            c.close()

    def _indexes_by_metadata(self, table: str) -> list[IndexInfo]:
        c = self._connection()
        try:
            meta, primary, parts = c.getMetaData(), [], {}
            rows = meta.getPrimaryKeys(None, self.schema, table)
            while rows.next():
                primary.append((rows.getInt("KEY_SEQ"), rows.getString("COLUMN_NAME")))
            rows = meta.getIndexInfo(None, self.schema, table, False, False)
            while rows.next():
                if rows.getString("COLUMN_NAME") is not None:
                    parts.setdefault((rows.getString("INDEX_NAME"), not rows.getBoolean("NON_UNIQUE")), []).append((rows.getInt("ORDINAL_POSITION"), rows.getString("COLUMN_NAME")))
            key = tuple(n for _, n in sorted(primary))
            found = [IndexInfo("PRIMARY", True, key)] if key else []
            return found + [IndexInfo(n, u, cols) for (n, u), p in sorted(parts.items()) if (cols := tuple(x for _, x in sorted(p))) != key]
        finally:
            c.close()


def null_rows(df: DataFrame, column: str) -> int:
    return df.where(F.col(quoted(column)).isNull()).count()


def greatest_as_text(df: DataFrame, column: str) -> str | None:
    """The greatest value, times in the form of a cursor with a blank."""
    kind = dict(df.dtypes)[column]
    c = F.max(F.col(quoted(column)))
    return df.agg((F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if kind.startswith("timestamp") else c.cast("string")).alias("m")).first().m
