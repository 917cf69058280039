"""Hashes that make up a large share of all, counted over all rows: what would make one key hot."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow

#: A frequent hash has 2**-SHARE of all and LEAST occurrences at least, so there are 2**SHARE of them at most.
SHARE, LEAST = 17, 1024
#: Hashes that a task counts together.
HELD = 4 << 20


class Frequent:
    """Numbers of occurrences of frequent hashes; looked up column-wise."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[hashes & np.uint64((1 << 20) - 1)] = True

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The counts, 0 for hashes that are not frequent."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.hashes):
            maybe = np.flatnonzero(self.bits[hashes & np.uint64((1 << 20) - 1)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            out[maybe] = np.where(self.hashes[at] == hashes[maybe], self.counts[at], 0)
        return out


def frequent(rows: DataFrame, hashes_of, share: int = SHARE, least: int = LEAST) -> Frequent:
    """Counts what `hashes_of` (a batch's first column to arrays of hashes) yields over all rows.

    A task tells of the hashes with that share of a part of its own, and one of
    that share of all has it in some part. Sums of what tasks tell never exceed the
    true counts; they serve balance and order alone, so a count too low does no harm.
    """
    schema = pa.schema([("hash", pa.int64()), ("n", pa.int64())])

    def count(batches):
        held, size = [], 0

        def told():
            if not size:
                return
            every, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= max(8, size >> share)
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array(every[many].view(np.int64)), pa.array(n[many].astype(np.int64))], schema=schema)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([size], pa.int64())], schema=schema)

        for batch in batches:
            for x in hashes_of(batch.column(0)):
                held.append(x)
                size += len(x)
                if size > HELD:
                    yield from told()
                    size = 0
        yield from told()

    sums = cut(map_arrow(rows, count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")))
    total = sums.where("hash IS NULL").first()
    bound = max(least, total.n >> share) if total else least
    found = sums.where(F.col("hash").isNotNull() & (F.col("n") >= bound)).collect()  # 2**share rows at most
    return Frequent(np.array([r.hash for r in found], np.int64).view(np.uint64), np.array([r.n for r in found], np.int64))
