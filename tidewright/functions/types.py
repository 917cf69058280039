"""Source types: which are taken, what they become, and how a schema may change."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ColumnInfo:
    """A column as its source declares it."""

    name: str
    data_type: str
    column_type: str = ""
    nullable: bool = True
    key: str = ""
    numeric_scale: int | None = None


@dataclass(frozen=True)
class IndexInfo:
    name: str
    unique: bool
    columns: tuple[str, ...]


# The source types that are taken.
INTEGER_TYPES = ("tinyint", "smallint", "mediumint", "int", "bigint")
FLOAT_TYPES = ("float", "double")
DECIMAL_TYPES = ("decimal", "numeric")
TEXT_TYPES = ("varchar", "char", "text", "tinytext", "mediumtext", "longtext")
OPAQUE_TEXT_TYPES = ("json", "enum", "set")
TIME_TYPES = ("date", "datetime", "timestamp")
BOOLEAN_TYPES = ("boolean", "bool")
BINARY_TYPES = ("blob", "tinyblob", "mediumblob", "longblob", "binary", "varbinary")
EXTRACTABLE = frozenset(INTEGER_TYPES + FLOAT_TYPES + DECIMAL_TYPES + TEXT_TYPES + OPAQUE_TEXT_TYPES + TIME_TYPES + BOOLEAN_TYPES + BINARY_TYPES)


def extractable(columns: list[ColumnInfo]) -> list[ColumnInfo]:
    """The columns whose type is on the list, whatever its letter case; each other one is named in a warning."""
    kept = []
    for c in columns:
        if c.data_type.lower() in EXTRACTABLE:
            kept.append(c)
        else:
            log.warning("column %s has type %s (%s), which is not extracted", c.name, c.data_type, c.column_type)
    return kept


def _decimal(column_type: str) -> T.DataType:
    m = re.search(r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", column_type)
    precision, scale = (int(m[1]), int(m[2] or 0)) if m else (10, 0)
    return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()


def spark_type(data_type: str, column_type: str = "", compat: bool = False) -> T.DataType:
    """The lake's type of a source type.

    Unsigned integers widen to the least signed type that holds them; bigint
    unsigned stays a long, and larger values fail on write. `compat` keeps
    decimals, dates and times as text. Raises for types that are not taken.
    """
    kind, unsigned = data_type.lower(), "unsigned" in column_type.lower()
    signed = {"tinyint": T.ByteType(), "smallint": T.ShortType(), "mediumint": T.IntegerType(), "int": T.IntegerType(), "bigint": T.LongType()}
    wider = {"tinyint": T.ShortType(), "smallint": T.IntegerType(), "mediumint": T.IntegerType(), "int": T.LongType(), "bigint": T.LongType()}
    if kind in signed:
        return wider[kind] if unsigned else signed[kind]
    if kind in FLOAT_TYPES:
        return T.FloatType() if kind == "float" else T.DoubleType()
    if kind in DECIMAL_TYPES:
        return T.StringType() if compat else _decimal(column_type)
    if kind in TIME_TYPES:
        return T.StringType() if compat else T.DateType() if kind == "date" else T.TimestampNTZType()
    if kind in BOOLEAN_TYPES:
        return T.ByteType()
    if kind in BINARY_TYPES:
        return T.BinaryType()
    if kind in TEXT_TYPES + OPAQUE_TEXT_TYPES:
        return T.StringType()
    raise ValueError(f"source type {data_type} ({column_type}) has no place in the lake")


def lake_schema(columns: list[ColumnInfo], compat: bool = False) -> T.StructType:
    """All fields nullable, in the source's order."""
    return T.StructType([T.StructField(c.name, spark_type(c.data_type, c.column_type, compat), True) for c in columns])


def same_type(lake: T.DataType, source: T.DataType) -> bool:
    """The lake keeps integers of 32 bits and less as one type, so these are the same."""
    small = (T.ByteType, T.ShortType, T.IntegerType)
    return lake == source or (isinstance(lake, small) and isinstance(source, small)) or {type(lake), type(source)} <= {T.TimestampType, T.TimestampNTZType}


def evolved_columns(columns: list[ColumnInfo], lake: T.StructType, compat: bool = False) -> list[str]:
    """The columns to select against an existing lake table: those it has, and new ones that can be taken.

    Raises, naming each, if the source lost a column of the lake or changed its type.
    """
    here, wrong = {c.name: c for c in columns}, []
    for field in lake.fields:
        c = here.get(field.name)
        if c is None:
            wrong.append(f"column {field.name} is gone from the source (dropped, renamed, or of a type that is not taken); a full refresh adopts that")
        elif c.data_type.lower() in EXTRACTABLE and not same_type(field.dataType, t := spark_type(c.data_type, c.column_type, compat)):
            wrong.append(f"column {field.name} changed its type: {field.dataType.simpleString()} in the lake, {t.simpleString()} at the source")
    if wrong:
        raise ValueError("the schema does not fit: " + "; ".join(wrong))
    known = {f.name for f in lake.fields}
    return [c.name for c in columns if c.name in known or c.data_type.lower() in EXTRACTABLE]


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` by name in the order and types of `schema`; a missing column or a value that does not fit fails the job."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing")
    return df.select(*(cast_exactly(F.col(quoted(f.name)), df.schema[f.name].dataType, f.dataType).alias(f.name) for f in schema.fields))


def cast_exactly(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A cast that raises on loss, whatever the session's ANSI mode."""
    if have == want:
        return column
    done = column.try_cast(want)
    return F.when(column.isNotNull() & done.isNull(), F.raise_error(F.concat(F.lit(f"a value does not fit {want.simpleString()}: "), column.cast("string"))).cast(want)).otherwise(done)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# Kinds of types for the type diagnostic; the lake side of the reference tables keeps decimals and times as text.
def source_family(data_type: str) -> str:
    kind = data_type.lower()
    if kind in (*INTEGER_TYPES, "integer", *BOOLEAN_TYPES):
        return "int"
    if kind in (*FLOAT_TYPES, "real"):
        return "float"
    if kind in DECIMAL_TYPES:
        return "decimal"
    if kind in TIME_TYPES:
        return "time"
    if kind in TEXT_TYPES + OPAQUE_TEXT_TYPES:
        return "string"
    return "binary" if kind in BINARY_TYPES else kind


def lake_family(t: T.DataType) -> str:
    for kind, name in ((T.IntegralType, "int"), (T.BooleanType, "int"), ((T.FloatType, T.DoubleType), "float"), (T.DecimalType, "decimal"), ((T.DateType, T.TimestampType, T.TimestampNTZType), "time"), (T.StringType, "string"), (T.BinaryType, "binary")):
        if isinstance(t, kind):
            return name
    return "other"


def family_differs(data_type: str, lake: T.DataType) -> bool:
    """True if the kinds differ; decimals and times may be text in the lake."""
    have, want = lake_family(lake), source_family(data_type)
    return have != want and not (have == "string" and want in ("decimal", "time"))
