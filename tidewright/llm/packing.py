"""Packs documents into sequences by lexical retrieval.

Shards of documents have a BM25 inverted index each, over token ids, with
document frequencies of the whole corpus. A seed document starts a sequence; its
best unused neighbours fill what is left of the window, the last of them is cut
there and its rest seeds the next sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, by_bytes, cut, map_arrow
from .tokens import CACHE_ENTRIES, Ids

WINDOW = 1024
#: BM25's constants, and documents of a shard.
K1, B, SHARD = 1.2, 0.75, 2048
#: Ids that are rows of a matrix at most, the part of the shard such an id is in at least, and postings added up at once.
ROWS, PART, POSTINGS = 1024, 16, 1 << 20
#: Documents whose terms are counted together, and bytes of texts that are encoded before they are handed on (a longer text is handed on alone).
GROUP, STEP = 256, 4 << 20


def counted(ids: list[np.ndarray], vocabulary: int):
    """For each document: its distinct ids in order, and their counts."""
    for at in range(0, len(ids), GROUP):
        part = ids[at : at + GROUP]
        sizes = np.array([len(x) for x in part])
        kind = np.uint32 if len(part) * vocabulary < 1 << 32 else np.uint64
        keys = np.repeat(np.arange(len(part), dtype=kind) * kind(vocabulary), sizes) + np.concatenate(part).astype(kind)
        keys.sort()
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        counts = np.diff(np.append(heads, len(keys)))
        keys = keys[heads]
        cuts = np.searchsorted(keys, np.arange(len(part), dtype=kind) * kind(vocabulary)).tolist() + [len(keys)]
        keys = (keys % kind(vocabulary)).astype(np.int64)
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield keys[a:b], counts[a:b]


class Index:
    """BM25 over one shard: the commonest ids as a matrix whose product has their part of all scores, postings by token id for the others."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float):
        terms = list(counted(ids, len(idf)))
        sizes = np.array([len(x) for x in ids], np.float32)
        many = [len(x) for x, _ in terms]
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), many)
        keys = np.concatenate([x for x, _ in terms])
        tf = np.concatenate([n for _, n in terms]).astype(np.float32)
        weight = idf[keys] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[owner] / max(mean, 1e-9)))
        lens = np.bincount(keys, minlength=len(idf))
        common = np.argsort(-lens, kind="stable")[:ROWS]
        common = common[lens[common] > max(1, len(ids) // PART)]
        row = np.full(len(idf), -1)
        row[common] = np.arange(len(common))
        at = row[keys]
        dense, rare = at >= 0, (at < 0) & (lens[keys] > 1)  # an id of one document alone finds nothing
        has, weights = np.zeros((len(ids), len(common))), np.zeros((len(common), len(ids)))
        has[owner[dense], at[dense]] = 1
        weights[at[dense], owner[dense]] = weight[dense]
        self.common = has @ weights
        cuts = np.cumsum(np.bincount(owner[rare], minlength=len(ids)))[:-1]
        owner, keys, weight = owner[rare], keys[rare], weight[rare]
        self.rare = np.split(keys, cuts)
        order = np.argsort(keys.astype(np.uint16) if len(idf) <= 1 << 16 else keys, kind="stable")
        self.docs, self.weights = owner[order], weight[order].astype(np.float64)
        self.lists = np.append(0, np.cumsum(np.bincount(keys, minlength=len(idf))))
        self.n = len(ids)

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of all documents of the shard for all distinct ids of `doc` that another one has."""
        out, own = self.common[doc].copy(), self.rare[doc]
        begin, lens = self.lists[own], self.lists[own + 1] - self.lists[own]
        for part in np.array_split(np.arange(len(own)), 1 + int(lens.sum()) // POSTINGS) if len(own) else ():
            n = lens[part]
            at = np.repeat(begin[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out += np.bincount(self.docs[at], self.weights[at], self.n)
        return out


class Packer:
    """Fills sequences; only the last one of a task is left with padding."""

    def __init__(self, window: int, base: int):
        self.window, self.sequence, self.offset = window, base, 0

    def place(self, doc_id, ids: np.ndarray):
        """The pieces of one document, from where the last sequence ends."""
        total, at, data = len(ids), 0, memoryview(ids.astype("<u4")).cast("B")
        while at < total:
            n = min(self.window - self.offset, total - at)
            yield doc_id, at, n, zlib.crc32(data[4 * at : 4 * (at + n)]), total, self.sequence, self.offset
            at, self.offset = at + n, self.offset + n
            if self.offset == self.window:
                self.sequence, self.offset = self.sequence + 1, 0

    def shard(self, docs: list, idf: np.ndarray, mean: float):
        index, free, nxt = Index([ids for _, ids in docs], idf, mean), np.ones(len(docs), bool), 0
        seed = None
        while True:
            if seed is None:
                while nxt < len(docs) and not free[nxt]:
                    nxt += 1
                if nxt == len(docs):
                    return
                seed = nxt
                free[seed] = False
                yield from self.place(*docs[seed])
            scores = None
            found = None
            while self.offset:
                scores = index.scores(seed) if scores is None else scores
                found = int(np.argmax(np.where(free, scores, 0.0)))
                if not free[found] or scores[found] <= 0:
                    found = None
                    break
                free[found] = False
                before = self.sequence
                yield from self.place(*docs[found])
                if self.sequence != before:
                    break  # it was cut, or ended the window: its rest is the next seed
            seed = found if self.offset else None


def pack_sequences(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", entries: int = CACHE_ENTRIES, step: int = STEP) -> DataFrame:
    """Every id of every document in one piece of one sequence of `window` ids at most.

    Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    Null and empty texts are the end id alone; repeated rows are documents of
    their own; no row, no sequence. Ids are written once, with each task's counts
    of documents by id; then each partition makes shards of SHARD documents, so
    memory is bounded and no text is shuffled. A task's last sequence alone is
    shorter than the window. Of neighbours that score alike the earlier one in the shard comes first.
    `entries` (pieces that a worker's tokenizer remembers) and `step` (bytes of text encoded together) change memory, not results.
    """
    spark, width = docs.sparkSession, "<u2" if vocabulary <= 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    made = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("df", pa.list_(pa.int64()))])

    def encode(batches):
        encoder, df, n, total = Ids(tokenizer, entries), np.zeros(vocabulary, np.int64), 0, 0
        for batch in (part for b in batches for part in by_bytes(b, 1, step)):
            ids = [np.append(x, np.uint32(end_id)) for x in encoder.batch(batch.column(1))]
            for keys, _ in counted(ids, vocabulary):
                df[keys] += 1
            n, total = n + len(ids), total + sum(map(len, ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(width).tobytes() for x in ids], pa.binary()), pa.nulls(len(ids), made.field("df").type)], schema=made)
        if n:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([np.append(df, [n, total])], made.field("df").type)], schema=made)

    scratch = Scratch(spark, "packing")
    stored = scratch.write(map_arrow(rows, encode, "doc_id long, ids binary, df array<long>", keeps=True))
    sums = stored.where("df IS NOT NULL").select(F.posexplode("df").alias("id", "n")).groupBy("id").agg(F.sum("n").alias("n")).collect()  # vocabulary + 2 rows
    df = np.zeros(vocabulary + 2, np.int64)
    for i, n in sums:
        df[i] = n
    total, mean = int(df[vocabulary]), float(df[vocabulary + 1]) / max(1, int(df[vocabulary]))
    df = df[:vocabulary]
    idf = spark.sparkContext.broadcast(np.log1p((total - df + 0.5) / (df + 0.5)).astype(np.float32))  # a number for each id
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def pack(batches):
        packer, own = Packer(window, TaskContext.get().partitionId() << 36), []

        def done():
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*packer.shard(own, idf.value, mean), strict=True)], schema=schema)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own.append((doc_id, np.frombuffer(ids.as_buffer(), width)))
                if len(own) == SHARD:
                    yield done()
                    own = []
        if own:
            yield done()

    try:
        return cut(map_arrow(stored.where("ids IS NOT NULL").select("doc_id", "ids"), pack, ", ".join(f"{f.name} long" for f in schema)))
    finally:
        scratch.drop()


def op7_lexical_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of every row of `documents`; null and empty texts are the end id alone, repeated rows are documents of their own, texts of any length are cut, an empty table gives no rows."""
    import public_tokenizers

    from .common import table

    return pack_sequences(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 50257, 0)
