"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Equal sets are one set from the start. An inverted index over all shingles,
dealt by shingle, tells every shingle that two sets share; a set that shares too
few can have no partner. Of what is left, each set's rarest shared shingles (as
many as leave less than the required overlap) tie sets into blocks: two similar
sets share one of these, so no link leaves a block. In a block, the inverted
lists of a set are searched for sets that occur in T of them: the short lists are merged (by a heap;
as sorted runs, where there are many postings), the long ones are probed by binary search for what the
merge has found often enough.

A shingle that a large share of all sets have would be one task's bucket. Such
shingles are counted beforehand and go straight to their sets, with that count.

Groups of similar sets are never expanded into all pairs: a candidate that
already is in the set's component is not probed, and what is returned is a
component for each document.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, buckets_for, cut, group_arrow, map_arrow, own_names, table
from .components import connected_components
from .frequent import Frequent, frequent
from .textnp import LOWER, chunks, mix, windows, word_bounds, word_hashes

WORDS = 4
#: Two sets link when 100 * intersection >= 85 * union.
LIKE = (85, 100)
#: Bytes of text that an index bucket stands for, and shingles that a task holds before it sends them.
PER_BUCKET, HELD = 24 << 20, 4 << 20
#: Shingles of the sets that one task searches; larger blocks are searched by pairs of tiles.
GROUP = 1_000_000
#: Sets that a set asks before the others of its block.
NEAREST = 64
#: DivideSkip's weight of list length in the number of long lists.
MU = 0.01
#: Postings that a heap merges; more are merged as sorted runs.
HEAP = 256
#: Keys that a block above GROUP is joined with its size by.
SALTS = 64


def shingle_sets(texts: pa.Array, size: int):
    """For each row: its sorted distinct shingles (64-bit hashes). Fewer words than `size`: all of them as one."""
    for _, offsets, data in chunks(texts):
        data = LOWER[data]
        starts, ends, first = word_bounds(data, offsets)
        hashes = word_hashes(data, starts, ends)
        every = windows(hashes, size)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(every[a : b - size + 1])
            elif b > a:
                yield mix(windows(hashes[a:b], b - a) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def set_print(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _required(n, like: tuple[int, int]):
    """The least intersection of a set of n with any similar one (its union has n at least)."""
    return -(-like[0] * n // like[1])


_POSTED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("prints", pa.binary()), ("sizes", pa.binary()), ("counts", pa.binary()), ("shingles", pa.binary()), ("df", pa.binary())])
_POSTED_SQL = "bucket int, kind int, prints binary, sizes binary, counts binary, shingles binary, df binary"
#: Kinds of postings: dealt by shingle, and dealt by set.
BY_SHINGLE, BY_SET = 0, 1


def _posted(bucket: int, kind: int, prints: np.ndarray, sizes: np.ndarray, counts: np.ndarray, shingles: np.ndarray, df: np.ndarray | None) -> pa.RecordBatch:
    """Postings of some sets: prints, set sizes, numbers of shingles here, the shingles, how many sets have them."""
    raw = (prints.tobytes(), sizes.astype("<u4").tobytes(), counts.astype("<u4").tobytes(), shingles.astype("<u8").tobytes(), b"" if df is None else np.minimum(df, 0xFFFFFFFF).astype("<u4").tobytes())
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), *(pa.array([x], pa.binary()) for x in raw)], schema=_POSTED)


def _dealt(bucket: np.ndarray, kind: int, owner: np.ndarray, prints: np.ndarray, sizes: np.ndarray, shingles: np.ndarray, df: np.ndarray | None):
    """Postings (a shingle of the set `owner`) by bucket; those of one set stay together."""
    order = np.lexsort((owner, bucket))
    bucket, owner, shingles, df = bucket[order], owner[order], shingles[order], None if df is None else df[order]
    cuts = np.append(np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1)), len(bucket)).tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        heads = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
        who = owner[a:b][heads]
        yield _posted(int(bucket[a]), kind, prints[who], sizes[who], np.diff(np.append(heads, b - a)), shingles[a:b], None if df is None else df[a:b])


def _gather(group: pa.Table):
    """What the rows of one bucket hold: prints (n, 2), sizes, counts, shingles, df."""
    read = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(name)])
    return read("prints", "<u8").reshape(-1, 2), read("sizes", "<u4"), read("counts", "<u4").astype(np.int64), read("shingles", "<u8"), read("df", "<u4")


def _set_bucket(prints: np.ndarray, buckets: int) -> np.ndarray:
    return (prints[:, 0] % np.uint64(buckets)).astype(np.int64)


def _numbered(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each different print, and a row of each."""
    order = np.lexsort((prints[:, 1], prints[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (prints[order[1:]] != prints[order[:-1]]).any(axis=1)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return which, order[new]


def _send(size: int, buckets: int, common: Frequent):
    def work(batches):
        seen, held = set(), [[], []]

        def sent():
            if not held[0]:
                return
            prints = np.frombuffer(b"".join(held[0]), "<u8").reshape(-1, 2)
            counts = np.array([len(x) for x in held[1]], np.int64)
            every = np.concatenate(held[1])
            owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
            for x in held:
                x.clear()
            df = common.number(every)
            hot = df > 0
            yield from _dealt(_set_bucket(prints, buckets)[owner[hot]], BY_SET, owner[hot], prints, counts, every[hot], df[hot])
            every, owner = every[~hot], owner[~hot]
            bucket = ((every >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets <= 65535 else np.int64)
            yield from _dealt(bucket, BY_SHINGLE, owner, prints, counts, every, None)

        total = 0
        for batch in batches:
            for shingles in shingle_sets(batch.column(0), size):
                if not len(shingles):
                    continue
                name = set_print(shingles)
                if name in seen:  # of equal sets a task sends one
                    continue
                seen.add(name)
                held[0].append(name)
                held[1].append(shingles)
                total += len(shingles)
                if total > HELD:
                    yield from sent()
                    total = 0
        yield from sent()

    return work


def _shared(buckets: int):
    """Of one bucket of shingles: the postings of those that two sets have, dealt by set. What is dealt by set goes through."""

    def work(group: pa.Table) -> pa.Table:
        if group.column("kind")[0].as_py() == BY_SET:
            return group
        prints, sizes, counts, shingles, _ = _gather(group)
        keep = np.zeros(len(prints), bool)
        keep[_numbered(prints)[1]] = True  # a set sent by several tasks counts once
        owner = np.repeat(np.arange(len(counts)), counts)
        have = keep[owner]
        shingles, owner = shingles[have], owner[have]
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], owner[order]
        heads = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1])) if len(shingles) else np.zeros(0, np.int64)
        df = np.repeat(np.diff(np.append(heads, len(shingles))), np.diff(np.append(heads, len(shingles))))
        shared = df > 1
        owner = owner[shared]
        out = _dealt(_set_bucket(prints, buckets)[owner], BY_SET, owner, prints, sizes, shingles[shared], df[shared])
        return pa.Table.from_batches(out, schema=_POSTED)

    return work


_SETS = pa.schema([("name", pa.binary()), ("n", pa.int64()), ("shingles", pa.binary()), ("rarest", pa.list_(pa.int64()))])


def _survivors(like: tuple[int, int]):
    """Sets with enough shared shingles for a partner; shingles sorted, and those of the rarest that a partner must touch."""

    def work(group: pa.Table) -> pa.Table:
        prints, sizes, counts, shingles, df = _gather(group)
        owner = np.repeat(np.arange(len(counts)), counts)
        which, one = _numbered(prints)
        # A frequent shingle of a set that several tasks have sent is here as often.
        order = np.lexsort((shingles, which[owner]))
        again = np.zeros(len(order), bool)
        again[order[1:]] = (shingles[order[1:]] == shingles[order[:-1]]) & (which[owner[order[1:]]] == which[owner[order[:-1]]])
        owner, shingles, df = owner[~again], shingles[~again], df[~again]
        size_of, name_of = sizes[one].astype(np.int64), prints[one]
        who = which[owner]
        shared = np.bincount(who, minlength=len(size_of))
        alive = shared >= _required(size_of, like)
        have = alive[who]
        who, shingles, df = who[have], shingles[have], df[have]
        order = np.lexsort((shingles, df, who))
        who, shingles = who[order], shingles[order]
        cuts = np.searchsorted(who, np.arange(len(size_of) + 1)).tolist()
        rows = []
        for i in np.flatnonzero(alive).tolist():
            own = shingles[cuts[i] : cuts[i + 1]]
            rarest = own[: int(shared[i] - _required(size_of[i], like) + 1)]
            rows.append((name_of[i].tobytes(), int(size_of[i]), np.sort(own).tobytes(), rarest.astype(np.int64)))
        return pa.Table.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), _SETS, strict=True)], schema=_SETS) if rows else _SETS.empty_table()

    return work


def search_group(sizes: np.ndarray, sets: list[np.ndarray], like: tuple[int, int] = LIKE, blocks: np.ndarray | None = None) -> np.ndarray:
    """For each set the least index of its component: links within its block, found by DivideSkip.

    Sets go by size, each asks those before it that are large enough: first the
    nearest ones, then, unless all others already are in its component, the rest.
    Of its lists the L longest are left out, L as Li, Lu and Lu (2008) choose it;
    who occurs in T - L of the others is probed in the long ones.
    """
    num, den = like
    count = len(sets)
    blocks = np.zeros(count, np.int64) if blocks is None else blocks
    order = np.lexsort((sizes, blocks))
    size, block = sizes[order].astype(np.int64), blocks[order]
    owner = np.repeat(np.arange(count), [len(sets[i]) for i in order])
    every = np.concatenate([sets[i] for i in order]) if count else np.zeros(0, np.uint64)
    values, token = np.unique(every, return_inverse=True)
    token = token.reshape(-1)
    many = np.bincount(token, minlength=len(values)) > 1
    keys = np.sort((token * count + owner)[many[token]])  # the inverted lists, one after the other
    bounds = np.searchsorted(owner, np.arange(count + 1))
    starts = np.searchsorted(block, block)
    group = np.arange(count)

    def merged(begin: np.ndarray, lens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The sets that are in `least` of the lists, and in how many; most often found first."""
        total = int(lens.sum())
        if total <= HEAP:
            lists = [(keys[b : b + n] % count).tolist() for b, n in zip(begin.tolist(), lens.tolist(), strict=True)]
            who, often, last = [], [], -1
            for x in heapq.merge(*lists):
                if x != last:
                    who.append(x)
                    often.append(0)
                    last = x
                often[-1] += 1
            found, times = np.array(who, np.int64), np.array(often, np.int64)
        else:
            at = np.repeat(begin - (np.cumsum(lens) - lens), lens) + np.arange(total)
            run = np.sort(keys[at] % count, kind="stable")  # a merge of sorted runs
            heads = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            found, times = run[heads], np.diff(np.append(heads, total))
        enough = times >= least
        found, times = found[enough], times[enough]
        order = np.argsort(-times, kind="stable")
        return found[order], times[order]

    def search(q: int, own: np.ndarray, low: int, high: int) -> None:
        """Joins q with the components of all sets of [low, high) that are like it."""
        begin, end = np.searchsorted(keys, own + low), np.searchsorted(keys, own + high)
        length = end - begin
        least = -(-num * int(size[q] + size[low]) // (num + den))  # T for the smallest partner
        full = np.flatnonzero(length)
        if len(full) < least:
            return
        full = full[np.argsort(length[full], kind="stable")]
        longest = int(length[full[-1]])
        skip = min(least - 1, int(least / (MU * np.log2(max(longest, 2)) + 1)), len(full) - 1)
        short, long = full[: len(full) - skip], full[len(full) - skip :]
        found, times = merged(begin[short], length[short], least - skip)
        while len(found):
            other = group[found] != group[q]
            found, times = found[other], times[other]
            some, seen, found, times = found[:8], times[:8], found[8:], times[8:]
            if not len(some):
                return
            probe = own[long][:, None] + some[None, :]
            place = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
            overlap = seen + (keys[place] == probe).sum(axis=0)
            linked = (num + den) * overlap >= num * (size[q] + size[some])
            for c in some[linked].tolist():
                x, y = group[c], group[q]
                if x != y:
                    group[group == max(x, y)] = min(x, y)

    for q in range(1, count):
        first = int(starts[q])
        low = first + int(np.searchsorted(size[first:q], _required(int(size[q]), like)))
        if low >= q:
            continue
        own = token[bounds[q] : bounds[q + 1]]
        own = own[many[own]] * count
        near = max(low, q - NEAREST)
        search(q, own, near, q)
        if low < near and (group[low:near] != group[q]).any():
            search(q, own, low, near)
    out = np.empty(count, np.int64)
    least_of = np.full(count, count, np.int64)
    np.minimum.at(least_of, group, order)
    out[order] = least_of[group]
    return out


def _search(like: tuple[int, int]):
    def work(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
        roots = search_group(group.column("n").to_numpy(), sets, like, group.column("root").to_numpy())
        return pa.Table.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[roots], pa.int64())], ["u", "v"])

    return work


def linked_sets(sets: DataFrame, like: tuple[int, int] = LIKE, per_group: int = GROUP) -> DataFrame:
    """(node, root) of all sets (node, n, shingles, rarest) that have a partner, by blocks of their rarest shared shingles."""
    posted = sets.select("node", F.explode("rarest").alias("shingle"))
    centres = posted.groupBy("shingle").agg(F.min("node").alias("centre"), F.count("*").alias("sets")).where("sets > 1").drop("sets")
    ties = posted.join(centres, "shingle").where("node <> centre").select(F.col("node").alias("u"), F.col("centre").alias("v"))
    blocks = connected_components(ties)
    held = sets.select("node", "n", "shingles").join(blocks, "node")
    sizes = cut(held.groupBy("root").agg(F.sum("n").alias("total")))
    groups = buckets_for(sizes, F.col("total"), per_group)
    # Few blocks are larger than a group; their sets may be many, so these are dealt by several keys a block.
    salted = sizes.where(F.col("total") > per_group).select("root", "total", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    held = held.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["root", "salt"], "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long"))).drop("salt")
    small = held.where(F.col("total") <= per_group).withColumn("g", F.pmod(F.xxhash64("root"), F.lit(groups)))
    found = group_arrow(small.groupBy("g"), _search(like), "u long, v long")
    # A block that no task should hold: every two of its tiles meet in a task of their own.
    tiles = F.ceil(2 * F.col("total") / per_group).cast("int")
    large = held.where(F.col("total") > per_group).withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, F.col("tile")).alias("i"), F.greatest(t, F.col("tile")).alias("j")))
    tiled = large.select("root", "node", "n", "shingles", F.explode(pairs).alias("pair")).select("root", "node", "n", "shingles", "pair.i", "pair.j")
    edges = cut(found.unionByName(group_arrow(tiled.groupBy("root", "i", "j"), _search(like), "u long, v long")).where("u <> v"))
    return connected_components(edges)


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, like: tuple[int, int] = LIKE) -> DataFrame:
    """doc_id, n_shingles, component_id, text_print (xxhash64 of the text), part for each row of `docs`.

    component_id is the least doc_id reachable by links, the row's own included
    (nulls count as larger than all); part names the component whatever the ids
    are. Texts without words have 0 shingles, no part, and link with nothing; repeated
    rows have equal sets and are linked; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("text_print", F.xxhash64("text"))
    buckets = buckets_for(rows, F.octet_length("text").cast("long"), PER_BUCKET)

    def describe(batches):
        for batch in batches:
            ns, names = [], []
            for shingles in shingle_sets(batch.column(1), size):
                ns.append(len(shingles))
                names.append(set_print(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ns, pa.int64()), pa.array(names, pa.binary())], ["doc_id", "text_print", "n_shingles", "name"])

    known = cut(map_arrow(rows, describe, "doc_id long, text_print long, n_shingles long, name binary"))
    common = frequent(rows.select("text"), lambda texts: shingle_sets(texts, size))
    posted = map_arrow(rows.select("text"), _send(size, buckets, common), _POSTED_SQL)
    scratch = Scratch(docs.sparkSession, "sets")
    try:
        shared = group_arrow(posted.groupBy("kind", "bucket"), _shared(buckets), _POSTED_SQL)
        sets = group_arrow(shared.groupBy("bucket"), _survivors(like), "name binary, n long, shingles binary, rarest array<long>")
        sets = scratch.write(sets.withColumn("node", F.monotonically_increasing_id()))  # a number for each name, as it is written
        linked = cut(sets.select("name", "node").join(linked_sets(sets, like), "node").select("name", "root"))
    finally:
        scratch.drop()
    classes = known.where("n_shingles > 0").groupBy("name").agg(F.min("doc_id").alias("least")).join(linked, "name", "left")
    # Only sets with a partner need their component's least document looked up.
    best = classes.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("least").alias("component"))
    classes = classes.join(best, "root", "left").select("name", F.coalesce("component", "least").alias("component"), F.coalesce(F.col("root").cast("string"), F.hex("name")).alias("part"))
    return known.join(classes, "name", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), "text_print", "part")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, like: tuple[int, int] = LIKE) -> DataFrame:
    """`docs` with one document of each component: that of the least id, of equal ids the least text_print.

    Rows without an id count as larger than all. An id with texts of several components can stay for each
    of them; texts without words stay once for each id, also for none.
    """
    found = similar_documents(docs, id_col, text_col, size, like).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    last = lambda c: F.coalesce(c, F.lit((1 << 63) - 1))
    alone = [F.when(F.col("part").isNull(), F.col(c)).alias(f"alone_{c}") for c in ("doc_id", "text_print")]
    key, text_print = own_names(docs.columns, "id", "print")
    # Rows of a part that are left have one id, the least, or none.
    kept = found.groupBy("part", *alone).agg(F.min("doc_id").alias("least"), F.min("text_print").alias(text_print)).select(last(F.col("least")).alias(key), text_print)
    keyed = docs.withColumn(key, last(F.col(id_col).cast("long"))).withColumn(text_print, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return keyed.join(kept, [key, text_print], "left_semi").dropDuplicates([key, text_print]).select(*docs.columns)


def op5_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `documents`; a text without words has 0 shingles and is its own component, equal texts are linked, an empty table gives no rows."""
    return similar_documents(table(spark, sf_dir, "documents")).drop("text_print", "part")
