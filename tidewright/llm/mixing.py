"""Mixes sources to target weights, in blocks.

Each source is a stream of words cut into blocks of one length. Multinomial
draws, conditioned on the sources' quotas, say how many slots each output shard
takes of each source; a slot maps to a block by a pseudorandom permutation of
the block numbers, one for each pass over the source; slots meet blocks by number.

Shards draw by halves: of a range of shards, the counts of its first half are
drawn from the counts of all, by a generator of that range's own. So a task makes
the counts of its own shards, with their totals exact, and the driver holds no shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, cut, map_arrow, own_names

WEIGHTS = (5, 2, 1)
MOST = 3.0
#: Words of a block at most, and blocks that a source gets at least (as far as it has words).
BLOCK, LEAST_BLOCKS = 1024, 512
#: Blocks of an output shard, and documents of a lot of one source.
SHARD, LOT = 4096, 2048
#: Output shards of a task that makes slots.
TASK_SHARDS = 12
#: Sources at most (the driver has a row for each), and those that a broadcast may hold.
MOST_SOURCES, BROADCAST_SOURCES = 1_000_000, 10_000
#: Rounds of the permutation, steps that it may walk, and its seed.
ROUNDS, WALK, SEED = 6, 16, 20240607
#: Up to so many slots numpy draws exactly; ranges above are halved in proportion.
DRAWN = 900_000_000


def word_count(text) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: float = MOST) -> dict[str | None, float]:
    """What each source is to give of the sum of all sizes.

    By code point, nulls last, sources weigh 5, 2, 1 and so on. A target above
    `most` times its source's size stops there, and what is left is shared by
    weight among the others, until none is above. All sizes 0: all targets 0.
    """
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weigh = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, left, open_, out = dict(order), float(sum(n for _, n in order)), dict(weigh), {}
    while open_:
        share = left / sum(open_.values())
        over = [s for s, w in open_.items() if share * w > most * size[s]]
        if not over:
            return out | {s: share * w for s, w in open_.items()}
        for s in over:
            out[s] = most * size[s]
            left -= out[s]
            del open_[s]
    return out


def quotas(goal: dict, size: dict) -> dict:
    """For each source: (words of a block, blocks, slots), slots at most MOST times blocks."""
    out = {}
    for s, n in size.items():
        block = max(1, min(BLOCK, n // LEAST_BLOCKS))
        blocks = -(-n // block)
        out[s] = (block, blocks, min(int(MOST * blocks), round(blocks * goal[s] / n)) if n else 0)
    return out


def _halved(counts: np.ndarray, take: int, rng) -> np.ndarray:
    """How many of each source are among the first `take` of sum(counts) slots in random order."""
    total = int(counts.sum())
    if total <= DRAWN:
        return rng.multivariate_hypergeometric(counts, take, method="marginals")
    exact = counts * (take / total)
    got = np.floor(exact).astype(np.int64)
    got[np.argsort(got - exact, kind="stable")[: take - int(got.sum())]] += 1
    return got


def shard_counts(slots: np.ndarray, lo: int, hi: int, seed: int = SEED):
    """(first slot of each source, slots of each source) of the output shards lo to hi - 1.

    All shards' counts add up to `slots`, and a shard's don't depend on which others are asked for.
    """
    slots = np.asarray(slots, np.int64)
    total = int(slots.sum())

    def walk(a: int, b: int, first: np.ndarray, counts: np.ndarray):
        if b <= lo or a >= hi:
            return
        if b - a == 1:
            yield first, counts
            return
        mid = (a + b) // 2
        left = _halved(counts, min((mid - a) * SHARD, int(counts.sum())), np.random.default_rng([seed, a, b]))
        yield from walk(a, mid, first, left)
        yield from walk(mid, b, first + left, counts - left)

    if total:
        yield from walk(0, -(-total // SHARD), np.zeros(len(slots), np.int64), slots)


def permuted(k: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1, keyed: a Feistel network on pairs below a and b, a * b the
    least product of that kind from n on, walked on while it is not below n (as a permutation it gets there).

    a * b exceeds n by less than a, so a walk is longer than WALK with a chance of some
    (1 / sqrt(n)) ** WALK only, and never where a is at most WALK; then it raises.
    """
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.ceil(n / a).cast("long")

    def once(x: Column) -> Column:
        high, low = F.floor(x / b).cast("long"), x % b
        for r in range(0, ROUNDS, 2):
            high = F.pmod(high + F.pmod(F.xxhash64(low, key, F.lit(r)), a), a)
            low = F.pmod(low + F.pmod(F.xxhash64(high, key, F.lit(r + 1)), b), b)
        return high * b + low

    walked = lambda x: F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), x, lambda s, _: F.when(s < n, s).otherwise(once(s)))
    first = F.transform(F.array(once(k)), lambda x: F.when(x < n, x).otherwise(walked(x)))[0]
    return F.transform(F.array(first), lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("the permutation left its domain"))))[0]


def slot_blocks(spark, plan: dict, seed: int = SEED) -> DataFrame:
    """(source_no, block, times): how often the mix takes each block, by the draws and permutations.

    Tasks have TASK_SHARDS shards each, so their number follows the slots.
    """
    given = spark.sparkContext.broadcast((np.array([x[1] for x in plan.values()], np.int64), np.array([x[2] for x in plan.values()], np.int64)))
    total = sum(x[2] for x in plan.values())
    tasks = max(1, -(-total // (SHARD * TASK_SHARDS)))
    schema = pa.schema([("source_no", pa.int32()), ("blocks", pa.int64()), ("first", pa.int64()), ("n", pa.int64())])

    def draw(batches):
        blocks, slots = given.value
        for batch in batches:
            for task in batch.column(0).to_pylist():
                for first, n in shard_counts(slots, task * TASK_SHARDS, (task + 1) * TASK_SHARDS, seed):
                    own = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip((own, blocks[own], first[own], n[own]), schema, strict=True)], schema=schema)

    drawn = map_arrow(spark.range(0, tasks, 1, tasks), draw, "source_no int, blocks long, first long, n long")
    slots = drawn.select("source_no", "blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    key = F.xxhash64(F.lit(seed), "source_no", F.floor(F.col("slot") / F.col("blocks")))
    slots = slots.select("source_no", "blocks", (F.col("slot") % F.col("blocks")).alias("k"), key.alias("key"))
    return slots.select("source_no", permuted(F.col("k"), F.col("blocks"), F.col("key")).alias("block")).groupBy("source_no", "block").agg(F.count("*").alias("times"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces): what the mix takes of each row of `docs`.

    documents: row, doc_id, source, size, source_size, target, taken. pieces: row,
    start, length (words of the row's text), times: the blocks, cut at documents.
    A null text has no words; sources without words have the target 0; a repeated
    row is a document of its own; a rerun gives the same. Sums of sizes go over
    lots of a source, so a source of any share of all rows is spread. Of more than
    MOST_SOURCES sources the driver could not hold a row each; then it raises.
    """
    spark = docs.sparkSession
    # Rows are told apart by place only where all that is read of them is equal.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("print"))
    rows = cut(rows)
    sizes = {r[0]: (r[1], r[2]) for r in rows.groupBy("source").agg(F.sum("size"), F.count("*")).limit(MOST_SOURCES + 1).collect()}  # a row a source
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    goal = targets([(s, n) for s, (n, _) in sizes.items()])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    plan = quotas(goal, {s: sizes[s][0] for s in order})
    facts = spark.createDataFrame([(s, i, sizes[s][0], goal[s], plan[s][0], max(1, -(-sizes[s][1] // LOT))) for i, s in enumerate(order)], "source string, source_no int, source_size long, target double, block_words long, lots long")
    facts = F.broadcast(facts) if len(order) <= BROADCAST_SOURCES else facts
    rows = rows.join(facts, rows["source"].eqNullSafe(facts["source"])).drop(facts["source"])
    rows = rows.withColumn("lot", F.pmod(F.xxhash64("doc_id", "print", F.lit(seed)), F.col("lots")))
    lots = rows.groupBy("source_no", "lot").agg(F.sum("size").alias("n")).withColumn("base", F.sum("n").over(Window.partitionBy("source_no").orderBy("lot")) - F.col("n")).drop("n")
    inner = Window.partitionBy("source_no", "lot").orderBy("doc_id", "print")
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "print").orderBy("source")))
    rows = rows.withColumn("at", F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).join(lots.hint("merge"), ["source_no", "lot"]).withColumn("at", F.col("at") + F.col("base"))
    rows = rows.withColumn("row", F.struct("doc_id", "print", "nth"))
    size, at, words = F.col("size"), F.col("at"), F.col("block_words")
    spans = rows.where(size > 0).select("row", "source_no", "size", "at", "block_words", F.explode(F.sequence(F.floor(at / words), F.floor((at + size - 1) / words))).alias("block"))
    start = F.greatest(F.col("block") * words - at, F.lit(0).cast("long"))
    spans = spans.withColumn("start", start).withColumn("length", F.least((F.col("block") + 1) * words - at, size) - F.col("start"))
    pieces = spans.join(slot_blocks(spark, plan, seed).hint("merge"), ["source_no", "block"]).select("row", "start", "length", "times")
    taken = pieces.groupBy("row").agg(F.sum(F.col("length") * F.col("times")).alias("taken"))
    out = rows.join(taken.hint("merge"), "row", "left").select("row", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    return out, pieces


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", chars_col: str | None = "n_chars", seed: int = SEED) -> DataFrame:
    """The mix as rows of the columns of `docs`: a row for each time that words of a document are taken.

    A pass that takes all of a document keeps its text as it is; else the row's
    text is the words taken, in order, a blank between. `chars_col` becomes its length.
    """
    _, pieces = mix_sources(docs, id_col, text_col, source_col, seed)
    passes = pieces.select("row", "start", "length", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("pass"))
    passes = passes.groupBy("row", "pass").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"), F.sum("length").alias("have"))
    key, text_print, nth, spans, have, words = own_names(docs.columns, "id", "print", "nth", "spans", "have", "words")
    last = F.lit((1 << 63) - 1)
    passes = passes.select(F.coalesce("row.doc_id", last).alias(key), F.col("row.print").alias(text_print), F.col("row.nth").alias(nth), F.col("spans").alias(spans), F.col("have").alias(have))
    keyed = docs.withColumn(key, F.coalesce(F.col(id_col).cast("long"), last)).withColumn(text_print, F.xxhash64(F.coalesce(text_col, F.lit(""))))
    keyed = keyed.withColumn(nth, F.row_number().over(Window.partitionBy(key, text_print).orderBy(F.col(source_col).cast("string"))))
    joined = keyed.join(passes, [key, text_print, nth]).withColumn(words, F.filter(F.split(text_col, f"{SPACE}+"), lambda w: w != ""))
    part = F.array_join(F.flatten(F.transform(spans, lambda s: F.slice(words, (s["start"] + 1).cast("int"), s["length"].cast("int")))), " ")
    joined = joined.withColumn(text_col, F.when(F.col(have) == F.size(words), F.col(text_col)).otherwise(part))
    if chars_col in docs.columns:
        joined = joined.withColumn(chars_col, F.length(text_col).cast(dict(docs.dtypes)[chars_col]))
    return joined.select(*docs.columns)


def op9_source_mixing(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken and source of every row of `documents`; a null text has the size 0, a null source comes last, a repeated row is a document of its own, an empty table gives no rows."""
    from .common import table

    documents, _ = mix_sources(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken", "source")
