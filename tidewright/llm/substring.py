"""Substring dedup: word windows that occur earlier are found by super-k-mers.

The minimiser of a window is the least hash of its runs of MINIMISER words.
Consecutive windows with one minimiser travel as one packed string to the
minimiser's bucket, so equal windows meet there, and each word is sent about
three times instead of once a window. In its bucket windows are sorted by a hash, those that
meet are compared byte by byte, and all but the earliest of equal ones are removed.

Runs of words that make up a large share of all come last in the order that
minimisers are chosen by, so a common phrase is a window's minimiser only where
the window has nothing rarer, and its bucket gets no more than others.

A string that a task has met already is not sent again: the later one's windows
are removed there and then. So of a passage that a third of all documents share,
a bucket gets one copy a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import buckets_for, by_bytes, cut, group_arrow, map_arrow, own_names, table
from .frequent import Frequent, frequent
from .textnp import chunks, same_bytes, sliding_min, windows, word_bounds, word_hashes

WINDOW, MINIMISER = 20, 3
#: Bytes of text that one bucket stands for, and bytes of strings that a task holds before it sends them.
PER_BUCKET, HELD = 8 << 20, 32 << 20
#: Bytes of text whose words are kept or removed together.
STEP = 4 << 20
#: Stands for a null document id: after all others.
LAST = (1 << 63) - 1

_SENT = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("strings", pa.binary()), ("doc_ids", pa.binary()), ("prints", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary())])
_SPANS = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words with one blank between, and where each begins; where texts meet there may be none."""
    size = ends - starts
    step = size + 1
    at = np.cumsum(step) - step
    out = np.full(int(step.sum()), 32, np.uint8)
    solid = np.ones(len(out), bool)
    solid[at + size] = False
    keep = np.zeros(len(data) + 1, np.int64)
    np.add.at(keep, starts, 1)
    np.add.at(keep, ends, -1)
    out[solid] = data[np.cumsum(keep[:-1]) > 0]
    return out.tobytes(), at


class _Sender:
    """Collects a task's strings and sends them by bucket."""

    def __init__(self, buckets: int, size: int, minimiser: int, common: Frequent):
        self.buckets, self.size, self.minimiser, self.common = buckets, size, minimiser, common
        self._clear()

    def _clear(self) -> None:
        self.seen, self.place, self.bucket, self.held, self.spans = {}, [], [], 0, []

    def add(self, doc_ids: list, prints: list, texts: pa.Array) -> None:
        import zstandard  # noqa: F401  fails here, not after the work, where it is missing

        size = self.size
        for row, offsets, data in chunks(texts):
            starts, ends, first = word_bounds(data, offsets)
            if len(starts) < size:
                continue
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            runs = windows(word_hashes(data, starts, ends), self.minimiser)
            rank = (runs >> np.uint64(1)) | ((self.common.number(runs) > 0).astype(np.uint64) << np.uint64(63))
            least = sliding_min(rank, size - self.minimiser + 1)
            whole = owner[: len(least)] == owner[size - 1 :]  # windows of one text
            same = np.zeros(len(least), bool)
            same[1:] = (least[1:] == least[:-1]) & whole[1:] & whole[:-1]  # so of one text
            heads = np.flatnonzero(whole & ~same)
            if not len(heads):
                continue
            tails = np.flatnonzero(whole & ~np.append(same[1:], False)) + size  # word after the run's last
            text, at = _packed(data, starts, ends)
            upto = at + (ends - starts)
            local = owner[heads]
            for a, b, d, p, m, n in zip(at[heads].tolist(), upto[tails - 1].tolist(), (local + row).tolist(), (heads - first[local]).tolist(), (least[heads] % np.uint64(self.buckets)).tolist(), (tails - heads).tolist(), strict=True):
                string = text[a:b]
                here = (doc_ids[d], prints[d], p)
                known = self.seen.get(string)
                if known is None:
                    self.seen[string] = len(self.place)
                    self.place.append(here)
                    self.bucket.append(m)
                    self.held += b - a + 150
                elif here != (other := self.place[known]):
                    if here < other:
                        self.place[known], here = here, other
                    self.spans.append((*here, here[2] + n))

    def sent(self):
        import zstandard

        if self.place:
            strings, order = list(self.seen), np.argsort(np.array(self.bucket, np.int32), kind="stable")
            buckets = np.array(self.bucket, np.int32)[order]
            ids, prints, at = (np.array(x, np.int64)[order] for x in zip(*self.place, strict=True))
            pack = zstandard.ZstdCompressor(level=3)
            cuts = np.append(np.flatnonzero(np.diff(buckets, prepend=-1)), len(buckets)).tolist()
            listed = order.tolist()
            for a, b in zip(cuts, cuts[1:], strict=False):
                data = pack.compress(b"\n".join([strings[i] for i in listed[a:b]]))
                yield self._batch(int(buckets[a]), 0, data, ids[a:b], prints[a:b], at[a:b], None, pack)
        if self.spans:
            ids, prints, a, b = (np.array(x, np.int64) for x in zip(*self.spans, strict=True))
            pack = zstandard.ZstdCompressor(level=1)
            yield self._batch(int(ids[0] % self.buckets), 1, b"", ids, prints, a, b, pack)
        self._clear()

    def _batch(self, bucket, kind, data, ids, prints, a, b, pack) -> pa.RecordBatch:
        raw = [data, pack.compress(ids.tobytes()), prints.tobytes(), pack.compress(a.astype(np.int32).tobytes()), b"" if b is None else pack.compress(b.astype(np.int32).tobytes())]
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), *(pa.array([x], pa.binary()) for x in raw)], schema=_SENT)


def _merged(ids, prints, starts, ends) -> pa.RecordBatch:
    """Spans in order, those of one text that touch made one."""
    order = np.lexsort((starts, prints, ids))
    ids, prints, starts, ends = ids[order], prints[order], starts[order], ends[order]
    if len(ids):
        new = np.ones(len(ids), bool)
        other = (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1])
        texts = np.concatenate([[0], np.cumsum(other)])
        wide = int(ends.max()) + 1
        reach = np.maximum.accumulate(ends + texts * wide) - texts * wide  # the farthest end so far in this text
        new[1:] = other | (starts[1:] > reach[:-1])
        heads = np.flatnonzero(new)
        ids, prints, starts, ends = ids[heads], prints[heads], starts[heads], np.maximum.reduceat(ends, heads)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, prints, starts, ends)], schema=_SPANS)


def _leads(data: np.ndarray, keys: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of bytes in order of `keys`: an order, and for each place in it that of the first equal range.

    Ranges with one key are compared byte by byte; where unequal ones have one key, these are sorted as bytes.
    """
    order, n = np.arange(len(keys)), len(keys)
    head = np.ones(n, bool)
    head[1:] = keys[1:] != keys[:-1]
    lead = np.flatnonzero(head)[np.cumsum(head) - 1] if n else order
    equal = size == size[lead]
    equal[equal] = same_bytes(data, begin[equal], begin[lead[equal]], size[equal])
    for key in np.unique(keys[~equal]):
        a, b = (int(np.searchsorted(keys, key, side=x)) for x in ("left", "right"))
        said = [data[begin[i] : begin[i] + size[i]].tobytes() for i in range(a, b)]
        order[a:b] = a + np.array(sorted(range(b - a), key=said.__getitem__))  # stable: the first stays first
        firsts: dict[bytes, int] = {}
        lead[a:b] = [firsts.setdefault(said[i - a], place) for place, i in enumerate(order[a:b].tolist(), a)]
    return order, lead


def _later_windows(size: int):
    def work(group: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        first, which, at, begin, length, spans = [], [], [], [], [], []
        ids, prints, texts, base, held = [], [], [], 0, 0
        for row in group.to_pylist():
            own_ids = np.frombuffer(unpack.decompress(row["doc_ids"]), np.int64)
            own_prints = np.frombuffer(row["prints"], np.int64)
            starts = np.frombuffer(unpack.decompress(row["starts"]), np.int32)
            if row["kind"]:
                spans.append((own_ids, own_prints, starts.astype(np.int64), np.frombuffer(unpack.decompress(row["ends"]), np.int32).astype(np.int64)))
                continue
            text = np.frombuffer(unpack.decompress(row["strings"]), np.uint8)
            ends = np.append(np.flatnonzero(text == 10), len(text))
            begins = np.append(0, ends[:-1] + 1)
            step, a = 1 << 14, 0
            while a < len(begins):
                b = min(a + step, len(begins))
                data, offsets = text[begins[a] : ends[b - 1]], np.append(begins[a:b], ends[b - 1]) - begins[a]
                w, x, words = word_bounds(data, offsets)
                owner = np.repeat(np.arange(b - a), np.diff(words))
                whole = np.flatnonzero(owner[: len(w) - size + 1] == owner[size - 1 :])
                first.append(windows(word_hashes(data, w, x), size)[whole])
                which.append((owner[whole] + (base + a)).astype(np.int32))
                at.append((whole - words[owner[whole]] + starts[a:b][owner[whole]]).astype(np.int32))
                begin.append(w[whole] + (held + begins[a]))
                length.append((x[whole + size - 1] - w[whole]).astype(np.int32))
                a = b
            ids.append(own_ids)
            prints.append(own_prints)
            texts.append(text)
            base, held = base + len(own_ids), held + len(text)
        if first:
            first, which, at, begin, length, ids, prints, data = map(np.concatenate, (first, which, at, begin, length, ids, prints, texts))
            texts.clear()
            order = np.argsort(first)
            met = np.zeros(len(order), bool)
            equal = first[order[1:]] == first[order[:-1]]
            met[1:] |= equal
            met[:-1] |= equal
            rows = order[met]
            a, w, p, s, n = first[rows], which[rows], at[rows].astype(np.int64), begin[rows], length[rows].astype(np.int64)
            d, t = ids[w], prints[w]
            order = np.lexsort((p, t, d, a))
            a, d, t, p, s, n = a[order], d[order], t[order], p[order], s[order], n[order]
            order, lead = _leads(data, a, s, n)
            d, t, p = d[order], t[order], p[order]
            later = (d != d[lead]) | (t != t[lead]) | (p != p[lead])  # a repeated row is no later start
            spans.append((d[later], t[later], p[later], p[later] + size))
        parts = [np.concatenate(x) for x in zip(*spans, strict=True)] if spans else [np.zeros(0, np.int64)] * 4
        return pa.Table.from_batches([_merged(*parts)])

    return work


def runs_of(texts: pa.Array, minimiser: int = MINIMISER):
    """Hashes of all runs of `minimiser` words (a few go over the edge of two texts, as in the sender)."""
    for _, offsets, data in chunks(texts):
        starts, ends, _ = word_bounds(data, offsets)
        yield windows(word_hashes(data, starts, ends), minimiser)


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """doc_id, print (hash of the text), spans: sorted [start, end) words of each text that windows met earlier cover.

    Spans of one text may overlap. Earlier is a smaller doc_id (nulls last), for
    one id the smaller print, for one text the smaller start; a repeated row
    (same id, same text) is the same document.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    buckets = buckets_for(rows, F.octet_length("text").cast("long"), PER_BUCKET)
    common = frequent(rows.select("text"), lambda texts: runs_of(texts, minimiser))
    rows = rows.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), F.xxhash64("text").alias("print"), "text")

    def send(batches):
        sender = _Sender(buckets, size, minimiser, common)
        for batch in batches:
            sender.add(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
            if sender.held > HELD:
                yield from sender.sent()
        yield from sender.sent()

    sent = map_arrow(rows, send, "bucket int, kind int, strings binary, doc_ids binary, prints binary, starts binary, ends binary")
    spans = group_arrow(sent.groupBy("bucket"), _later_windows(size), "doc_id long, print long, start long, end long")
    return spans.groupBy("doc_id", "print").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, minimiser: int = MINIMISER, names: tuple = ("n_words", "n_removed", "kept_words")) -> DataFrame:
    """The columns of `docs`, and `names`: words, words removed, and the text without the words of windows that occur earlier.

    Windows are judged on the input. Null texts have no words; texts of fewer
    words than a window lose none; a repeated row loses what the row it repeats loses.
    Columns of `docs` that are called as one of `names` give way.
    """
    docs = docs.drop(*(c for c in names if c not in (id_col, text_col)))
    spans = cut(removed_spans(docs, id_col, text_col, size, minimiser))
    key, text_print, met = own_names([*docs.columns, *names], "id", "print", "spans")
    keyed = docs.withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))).withColumn(text_print, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    found = spans.select(F.col("doc_id").alias(key), F.col("print").alias(text_print), F.col("spans").alias(met))
    joined = keyed.join(found, [key, text_print], "left").drop(key, text_print)
    out = T.StructType([*joined.schema.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()), T.StructField(names[2], T.StringType())])
    place, marks = joined.columns.index(text_col), joined.columns.index(met)

    def keep(batches):
        for batch in (part for b in batches for part in by_bytes(b, place, STEP)):
            counts, lost, kept = [], [], []
            said = batch.column(marks).to_pylist()
            for row, offsets, data in chunks(batch.column(place)):
                starts, ends, first = word_bounds(data, offsets)
                text, at = _packed(data, starts, ends) if len(starts) else (b"", starts)
                ends = at + (ends - starts)
                for i in range(len(offsets) - 1):
                    a, b = int(first[i]), int(first[i + 1])
                    parts, done, gone = [], 0, 0
                    for span in said[row + i] or ():
                        s, e = max(span["start"], done), span["end"]
                        if s > done:
                            parts.append(text[at[a + done] : ends[a + s - 1]])
                        if e > s:
                            gone += e - s
                        done = max(done, e)
                    if done < b - a:
                        parts.append(text[at[a + done] : ends[b - 1]])
                    counts.append(b - a)
                    lost.append(gone)
                    kept.append(b" ".join(parts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], [*batch.schema.names, *names])

    return map_arrow(joined, keep, out).drop(met)


def deduplicated_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """`docs` with repeated passages taken out of the texts; documents that lose all their words go.

    A text that loses nothing stays as it is; else it is its words, a blank between.
    """
    n_words, n_removed, kept = own_names(docs.columns, "n_words", "n_removed", "kept_words")
    done = without_repeats(docs, id_col, text_col, names=(n_words, n_removed, kept))
    done = done.where((F.col(n_removed) == 0) | (F.col(n_removed) < F.col(n_words)))
    lost = F.col(n_removed) > 0
    done = done.withColumn(text_col, F.when(lost, F.col(kept)).otherwise(F.col(text_col)))
    if chars_col in docs.columns:
        done = done.withColumn(chars_col, F.when(lost, F.length(text_col).cast(dict(docs.dtypes)[chars_col])).otherwise(F.col(chars_col)))
    return done.select(*docs.columns)


def op10_super_kmer_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of `documents`; a null text has no words, a repeated row loses what its like loses, an empty table gives no rows."""
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))
