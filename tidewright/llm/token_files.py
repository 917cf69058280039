"""Token-id files: fixed-width bit packing in blocks, read back at random.

A file holds ids in `width` bits each, the least that the vocabulary needs:

    magic | blocks | document ids (int64) | document starts (int64) | block offsets (int64) | footer (JSON) | length

64 ids fill `width` whole 64-bit words, so a block of BLOCK ids starts at a word
and unpacks by numpy lanes. Block offsets give any id without reading the rest.

Files are written below a folder that all executors share, first under a name
of the attempt, then moved: a retried or repeated task leaves one whole file.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, lake_fs, map_arrow
from .tokens import Ids

MAGIC = b"TWIDS001"
#: Ids of a block; a multiple of 64.
BLOCK = 1 << 16
#: Stands for a null document id in a file.
NULL_ID = -(1 << 63)


def bits_for(vocabulary: int) -> int:
    """Bits that ids below `vocabulary` need, 1 to 32."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids (unsigned 32-bit) in `width` bits each, to whole groups of 64 (zeros fill the last)."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    groups = -(-len(ids) // 64)
    full = np.zeros(groups * 64, np.uint64)
    full[: len(ids)] = ids
    if width == 16:  # a lane is a quarter of a word
        return full.astype("<u2").tobytes()
    lanes, out = full.reshape(groups, 64), np.zeros((groups, width), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return out.astype("<u8").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    """The first `count` ids of what pack() made."""
    if width == 16:
        return np.frombuffer(data, "<u2", count).astype(np.uint32)
    words = np.frombuffer(data, "<u8").reshape(-1, width)
    out, mask = np.empty((len(words), 64), np.uint64), np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        lane = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            lane = lane | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = lane & mask
    return out.reshape(-1)[:count].astype(np.uint32)


class Writer:
    """Writes one file; ids are packed as soon as a block is full."""

    def __init__(self, uri: str, width: int):
        self.fs, self.path = lake_fs(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.draft = f"{self.path}.{uuid.uuid4().hex}"
        self.out, self.width = self.fs.open_output_stream(self.draft), width
        self.out.write(MAGIC)
        self.at, self.total, self.held, self.rest = len(MAGIC), 0, 0, []
        self.doc_ids, self.starts, self.blocks = [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """`ids` as little-endian unsigned 32-bit integers."""
        self.doc_ids.append(NULL_ID if doc_id is None else doc_id)
        self.starts.append(self.total)
        self.total += len(ids) // 4
        self.held += len(ids) // 4
        self.rest.append(ids)
        if self.held >= BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.rest), "<u4")
        full = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, full, BLOCK):
            data = pack(ids[at : min(at + BLOCK, full)], self.width)
            self.blocks.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.rest, self.held = [ids[full:].tobytes()], len(ids) - full

    def close(self) -> dict:
        self._flush(True)
        index = [np.array(x, "<i8").tobytes() for x in (self.doc_ids, self.starts, self.blocks)]
        footer = json.dumps({"width": self.width, "block": BLOCK, "ids": self.total, "docs": len(self.doc_ids), "blocks": len(self.blocks), "index": self.at}).encode()
        self.out.write(b"".join(index) + footer + len(footer).to_bytes(8, "little"))
        self.out.close()
        self.fs.move(self.draft, self.path)
        return {"n_docs": len(self.doc_ids), "n_ids": self.total}


class Reader:
    """Random access to the ids of one file."""

    def __init__(self, uri: str):
        fs, path = lake_fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.meta = json.loads(self.file.read_at(tail, size - 8 - tail))
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no token-id file")
        docs, blocks = self.meta["docs"], self.meta["blocks"]
        index = self.file.read_at(8 * (2 * docs + blocks), self.meta["index"])
        whole = np.frombuffer(index, "<i8")
        self.doc_ids, starts, self.blocks = whole[:docs], whole[docs : 2 * docs], whole[2 * docs :]
        self.starts = np.append(starts, self.meta["ids"])
        self.ends = np.append(self.blocks[1:], self.meta["index"])

    def _block(self, k: int) -> np.ndarray:
        data = self.file.read_at(int(self.ends[k] - self.blocks[k]), int(self.blocks[k]))
        return unpack(data, self.meta["width"], min(self.meta["block"], self.meta["ids"] - k * self.meta["block"]))

    def ids(self, start: int, count: int) -> np.ndarray:
        """`count` ids from the file's `start`; reads the blocks they lie in only."""
        if count <= 0:
            return np.zeros(0, np.uint32)
        size = self.meta["block"]
        first, last = start // size, (start + count - 1) // size
        return np.concatenate([self._block(k) for k in range(first, last + 1)])[start - first * size :][:count]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1] - self.starts[k]))

    def documents(self):
        """(document id, its start in the file, its ids), each block read once."""
        size, at, have = self.meta["block"], 0, np.zeros(0, np.uint32)
        nxt = 0
        for k in range(len(self.doc_ids)):
            start, end = int(self.starts[k]), int(self.starts[k + 1])
            parts = []
            while nxt * size < end:
                parts.append(self._block(nxt))
                nxt += 1
            if parts:
                have, at = np.concatenate([have[start - at :], *parts]), start
            yield int(self.doc_ids[k]), start, have[start - at : end - at]

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text, appends `end_id` and writes files in ascending `id_col` order.

    Returns one row a file: shard, path, n_docs, n_ids, base (ids of all files
    before it). Null and empty texts have the end id only; a null document id
    comes first; repeated ids are documents of their own. No row, no file.
    One range shuffle of the texts; files hold what a partition holds.
    """
    width = bits_for(vocabulary)
    schema = "shard int, path string, n_docs long, n_ids long"

    def write(batches):
        shard = TaskContext.get().partitionId()
        encode, out, path = Ids(tokenizer), None, f"{folder}/shard-{shard:06d}.ids"
        tail = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode.batch(batch.column(1)), strict=True):
                if out is None:
                    out = Writer(path, width)
                out.add(doc_id, ids.tobytes() + tail)
        if out is not None:
            done = out.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, **done}], schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # One row a file: the number of files, not of documents, bounds what the driver holds.
    files = sorted(map_arrow(ordered, write, schema, keeps=True).collect(), key=lambda r: r.shard)
    rows, base = [], 0
    for r in files:
        rows.append((r.shard, r.path, r.n_docs, r.n_ids, base))
        base += r.n_ids
    return docs.sparkSession.createDataFrame(rows, schema + ", base long")


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of what `files` lists."""
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(row["path"])
                rows = [(None if d == NULL_ID else d, row["base"] + s, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, s, ids in reader.documents()]
                reader.close()
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    n = max(1, files.count())
    return map_arrow(files.repartitionByRange(n, "shard"), read, T.StructType([T.StructField(f.name, T.LongType()) for f in out]))


def op2_token_files(spark, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row of `documents`, from the files. Null and empty texts have the end id
    alone, rows of one id go by text, texts of any length are one document, an empty table gives no rows."""
    import public_tokenizers

    from .common import cut, table

    scratch = Scratch(spark, "token-ids")
    try:
        return cut(read_token_files(write_token_files(table(spark, sf_dir, "documents"), scratch.path, public_tokenizers.path("word_bpe_49k.json"), 49408, 2)))
    finally:
        scratch.drop()
