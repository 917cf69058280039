"""Fingerprints of keys and columns: aggregates in one pass, and their canonical text."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import DECIMAL_TYPES, TEXT_TYPES, ColumnInfo, quoted

#: Digits that a summed column may have; more, and the sum is left out on both sides.
CAPACITY = 65
#: Scale of decimals that declare none, and the largest that is used.
SCALE, MOST_SCALE = 10, 30
NONE = "∅"


@dataclass(frozen=True)
class KeyStats:
    count: int
    distinct: int
    min: int | None
    max: int | None
    xor: int
    distinct_xor: int
    sum: int


@dataclass(frozen=True)
class StringKeyStats:
    count: int
    distinct: int
    min: str | None
    max: str | None


def _key(key: str) -> Column:
    return F.col(quoted(key)).cast("decimal(20,0)")


def _bits(key: str) -> Column:
    """The key's 64 bits as a long; keys of 2**63 and more fold, as xor has no sign."""
    k = _key(key)
    return F.when(k >= F.lit(str(1 << 63)).cast("decimal(20,0)"), k - F.lit(str(1 << 64)).cast("decimal(20,0)")).otherwise(k).cast("long")


def key_stats(df: DataFrame, key: str) -> DataFrame:
    """One row: row_count, distinct_keys, min_key, max_key, xor_keys, distinct_xor, sum_keys (numbers beyond a long as text).

    The distinct figures come from one row a key, so two plain aggregations do, without expanding rows for each distinct.
    """
    per_key = df.select(_key(key).alias("k"), _bits(key).alias("b")).groupBy("k", "b").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum("n"), zero).alias("row_count"), F.count("k").alias("distinct_keys"), F.min("k").cast("string").alias("min_key"), F.max("k").cast("string").alias("max_key"),
        F.coalesce(F.bit_xor(F.when(F.col("n") % 2 == 1, F.col("b"))), zero).alias("xor_keys"), F.coalesce(F.bit_xor("b"), zero).alias("distinct_xor"),
        F.coalesce(F.sum(F.col("k").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("sum_keys"),
    )


def key_stats_value(row) -> KeyStats:
    number = lambda x: None if x is None else int(x)
    return KeyStats(row.row_count, row.distinct_keys, number(row.min_key), number(row.max_key), row.xor_keys, row.distinct_xor, int(row.sum_keys))


def string_key_stats(df: DataFrame, key: str) -> DataFrame:
    """One row: row_count, distinct_keys, min_key, max_key, by bytes."""
    k = F.col(quoted(key))
    per_key = df.groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("row_count"), F.count("k").alias("distinct_keys"), F.min("k").alias("min_key"), F.max("k").alias("max_key"))


def non_null_census(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: for each column how many values it has."""
    return df.agg(*(F.count(F.col(quoted(c))).alias(c) for c in columns))


# --- value aggregates ---


@dataclass(frozen=True)
class ColumnAgg:
    """A column and what is summed up of it: integer, decimal (with a scale), seconds, day, or text."""

    name: str
    kind: str
    scale: int = 0


@dataclass(frozen=True)
class AggValues:
    sum: str | None
    min: str | None
    max: str | None
    count: int


def agg_for(column: ColumnInfo) -> ColumnAgg | None:
    """None for what isn't compared by value: tinyint and booleans, floats, opaque text, binary."""
    kind = column.data_type.lower()
    if kind in ("smallint", "mediumint", "int", "integer", "bigint"):
        return ColumnAgg(column.name, "integer")
    if kind in DECIMAL_TYPES:
        return ColumnAgg(column.name, "decimal", min(SCALE if column.numeric_scale is None else column.numeric_scale, MOST_SCALE))
    if kind in ("datetime", "timestamp"):
        return ColumnAgg(column.name, "seconds")
    if kind == "date":
        return ColumnAgg(column.name, "day")
    return ColumnAgg(column.name, "text") if kind in TEXT_TYPES else None


#: Digits of a limb of a wide sum, limbs on either side of the point, and digits of numbers whose sum a decimal(38) holds, however many.
LIMB, LIMBS, NARROW = 15, 5, 19


def _wide_sum(name: str, text: Column, scale: int) -> list[Column]:
    """Sums of the limbs of a decimal of any length, signed: exact where a decimal(38) would overflow."""
    sign = F.when(text.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    whole = F.regexp_extract(text, r"^[+-]?(\d*)", 1)
    part = F.rpad(F.substring(F.regexp_extract(text, r"\.(\d*)", 1), 1, scale), scale, "0") if scale else F.lit("")
    digits = F.lpad(F.concat(whole, part), LIMB * LIMBS, "0")
    return [F.sum(sign * F.substring(digits, i * LIMB + 1, LIMB).cast("decimal(38,0)")).alias(f"{name}__limb{i}") for i in range(LIMBS)]


def limbs_value(limbs: list, scale: int) -> str | None:
    """The sum that limbs stand for, as plain digits with `scale` of them after the point."""
    if all(x is None for x in limbs):
        return None
    total = 0
    for x in limbs:
        total = total * 10**LIMB + int(x or 0)
    text = f"{abs(total):0{scale + 1}d}"
    return ("-" if total < 0 else "") + (f"{text[:-scale]}.{text[-scale:]}" if scale else text)


def value_aggregates(df: DataFrame, specs: list[ColumnAgg]) -> DataFrame:
    """One row, one scan: for each column its __sum, __min, __max (text) and __n; decimals of more than NARROW digits have limbs for a sum.

    Garbage in a text column that stands for a number or time counts as a value but joins no sum, least or greatest.
    """
    out: list[Column] = []
    for s in specs:
        c, have = F.col(quoted(s.name)), df.schema[s.name].dataType
        n = F.count(c).alias(f"{s.name}__n")
        if s.kind in ("integer", "decimal"):
            if isinstance(have, T.StringType):  # too wide for a decimal, or kept as text
                number = F.when(c.rlike(r"^\s*[+-]?\d+(\.\d*)?\s*$"), F.trim(c))
                whole = F.ltrim(F.regexp_extract(number, r"^[+-]?(\d*)", 1), F.lit("0"))
                size = F.when(number.startswith("-"), -F.length(whole)).otherwise(F.length(whole))
                # Longer numbers are larger; of one length digits decide, upside down below zero.
                rank = F.struct(size.alias("l"), F.when(number.startswith("-"), F.translate(whole, "0123456789", "9876543210")).otherwise(whole).alias("d"), F.when(number.startswith("-"), F.translate(F.regexp_extract(number, r"\.(\d*)", 1), "0123456789", "9876543210")).otherwise(F.regexp_extract(number, r"\.(\d*)", 1)).alias("f"))
                out += _wide_sum(s.name, number, s.scale)
                out += [F.min_by(number, F.when(number.isNotNull(), rank)).alias(f"{s.name}__min"), F.max_by(number, F.when(number.isNotNull(), rank)).alias(f"{s.name}__max"), n]
                continue
            if isinstance(have, T.DecimalType) and have.precision - have.scale + max(s.scale, have.scale) > NARROW:
                text = lambda x: F.translate(F.format_number(x, have.scale), ",", "")  # noqa: B023, E731  plain digits in any mode
                out += [*_wide_sum(s.name, text(c), s.scale), text(F.min(c)).alias(f"{s.name}__min"), text(F.max(c)).alias(f"{s.name}__max"), n]
                continue
            wide = c.cast(f"decimal(38,{s.scale})")
            out += [F.sum(wide).cast("string").alias(f"{s.name}__sum"), F.min(wide).cast("string").alias(f"{s.name}__min"), F.max(wide).cast("string").alias(f"{s.name}__max"), n]
        elif s.kind in ("seconds", "day"):
            form = "yyyy-MM-dd HH:mm:ss" if s.kind == "seconds" else "yyyy-MM-dd"
            at = c.try_cast("timestamp_ntz") if isinstance(have, T.StringType) else c
            out += [F.lit(None).cast("string").alias(f"{s.name}__sum"), F.date_format(F.min(at), form).alias(f"{s.name}__min"), F.date_format(F.max(at), form).alias(f"{s.name}__max"), n]
        else:
            out += [F.sum(F.char_length(c)).cast("string").alias(f"{s.name}__sum"), F.lit(None).cast("string").alias(f"{s.name}__min"), F.lit(None).cast("string").alias(f"{s.name}__max"), n]
    return df.agg(*out)


def agg_values(row, specs: list[ColumnAgg]) -> list[AggValues]:
    have = row.asDict()
    values = []
    for s in specs:
        total = have.get(f"{s.name}__sum")
        if f"{s.name}__limb0" in have:
            total = limbs_value([have[f"{s.name}__limb{i}"] for i in range(LIMBS)], s.scale)
        values.append(AggValues(total, have[f"{s.name}__min"], have[f"{s.name}__max"], have[f"{s.name}__n"]))
    return values


def sum_may_overflow(spec: ColumnAgg, values: AggValues) -> bool:
    """True if so many values of such size could need more than CAPACITY digits."""
    ends = [x for x in (values.min, values.max) if x is not None]
    if values.count <= 0 or not ends:
        return False
    longest = max(max(len(x.lstrip("-").partition(".")[0]), 1) for x in ends)
    return longest + len(str(values.count)) > CAPACITY - (spec.scale if spec.kind == "decimal" else 0)


def _plain(x: str | None, spec: ColumnAgg) -> str:
    """Numbers of either side in one form: `scale` digits after the point."""
    if x is None:
        return NONE
    return f"{Decimal(x):.{spec.scale}f}" if spec.kind in ("integer", "decimal") else x


def fingerprints(specs: list[ColumnAgg], source: list[AggValues], lake: list[AggValues]) -> list[tuple[str, str]]:
    """For each column the pair of texts that must be equal; a sum that may overflow on one side is left out of both."""
    pairs = []
    for spec, *sides in zip(specs, source, lake, strict=True):
        skip = spec.kind in ("integer", "decimal") and any(sum_may_overflow(spec, v) for v in sides)
        texts = []
        for v in sides:
            if spec.kind == "text":
                texts.append(f"len={v.sum or '0'}|n={v.count}")
                continue
            ends = f"min={_plain(v.min, spec)}|max={_plain(v.max, spec)}|n={v.count}"
            texts.append(ends if spec.kind in ("seconds", "day") else f"sum={'skipped' if skip else _plain(v.sum, spec)}|{ends}")
        pairs.append((texts[0], texts[1]))
    return pairs


def fingerprint_columns(df: DataFrame, specs: list[ColumnAgg]) -> DataFrame:
    """One row of value_aggregates() as fingerprints, without leaving Spark (numbers of NARROW digits at most)."""
    values = value_aggregates(df, specs)
    show = lambda c: F.coalesce(F.col(quoted(c)), F.lit(NONE))
    out = []
    for s in specs:
        n = F.col(quoted(f"{s.name}__n")).cast("string")
        if s.kind == "text":
            text = F.concat(F.lit("len="), F.coalesce(F.col(quoted(f"{s.name}__sum")), F.lit("0")), F.lit("|n="), n)
        else:
            head = [F.lit("sum="), show(f"{s.name}__sum"), F.lit("|")] if s.kind in ("integer", "decimal") else []
            text = F.concat(*head, F.lit("min="), show(f"{s.name}__min"), F.lit("|max="), show(f"{s.name}__max"), F.lit("|n="), n)
        out.append(text.alias(s.name))
    return values.select(*out)
