"""Upserts by key, as plans: what a table is once new versions of some rows are in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.types import quoted

#: Keys of a window that may be broadcast; more, and the join picks its own way.
BROADCAST_KEYS = 500_000


def survivors(target: DataFrame, keys: DataFrame, key: str, count: int | None = None) -> DataFrame:
    """Rows of `target` whose key isn't among `keys`; null keys stay. `count` keys are broadcast if they are few."""
    keys = keys.select(F.col(quoted(key)))
    return target.join(F.broadcast(keys) if count is not None and count <= BROADCAST_KEYS else keys, key, "left_anti").select(*target.columns)


def upsert_by_replacement(target: DataFrame, new: DataFrame, key: str, count: int | None = None) -> DataFrame:
    """Survivors and new versions; columns that one side lacks are null there."""
    return survivors(target, new, key, count).unionByName(new, allowMissingColumns=True)


def upsert_by_merge(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The same by a full outer join: matched rows take all of the new version, others stay, new ones come in."""
    k = quoted(key)
    t, s = target.alias("t"), new.withColumn("__new", F.lit(True)).alias("s")
    both = t.join(s, F.col(f"t.{k}") == F.col(f"s.{k}"), "full_outer")
    has = F.col("s.__new").isNotNull()
    return both.select(*(F.when(has, F.col(f"s.{quoted(c)}")).otherwise(F.col(f"t.{quoted(c)}")).alias(c) for c in target.columns))


def schema_merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both; columns that are new in one are null in the other."""
    return first.unionByName(second, allowMissingColumns=True)
