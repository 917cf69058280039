"""Whole texts as numpy arrays: words, word hashes and windows without a loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Texts are worked on in pieces of about so many bytes (a longer text is one piece).
CHUNK = 1 << 20
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Keeps the first n of 8 bytes.
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (murmur3's)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def chunks(texts: pa.Array):
    """(first row, row offsets, bytes) of consecutive rows; nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"") if texts.null_count else texts.cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    raw = texts.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]]
        at = to


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (byte positions), and each row's first word."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    before[edge[:-1]] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    after[edge[1:]] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _lanes(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as a number; beyond the end there are zeros."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, in this order; not linear in either."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; it doesn't depend on where the word stands.

    Each 8 bytes are mixed by themselves, with their place, before they are added
    up, so no pattern of letters makes sums of different words cancel.
    """
    size, lanes = ends - starts, _lanes(data)
    out = mix((lanes[starts] & _MASKS[np.minimum(size, 8)]) + np.uint64(0x9E3779B97F4A7C15))
    long = np.flatnonzero(size > 8)
    if len(long):
        more = (size[long] - 1) >> 3
        first = np.cumsum(more) - more
        owner = np.repeat(np.arange(len(long)), more)
        place = np.arange(len(owner)) - first[owner] + 1
        at, left = starts[long][owner] + 8 * place, size[long][owner] - 8 * place
        every = mix((lanes[at] & _MASKS[np.minimum(left, 8)]) + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        out[long] += np.add.reduceat(every, first)
    return mix(out + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, step: int = 1 << 21) -> np.ndarray:
    """Whether data[a:a+size] equals data[b:b+size], for each of many ranges."""
    lanes, many = _lanes(data), (size + 7) >> 3
    out = np.ones(len(a), bool)
    part = np.cumsum(many) // step
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(a)).tolist()
    for x, y in zip(cuts, cuts[1:], strict=False):
        n = many[x:y]
        owner = np.repeat(np.arange(x, y), n)
        place = 8 * (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n))
        differ = ((lanes[a[owner] + place] ^ lanes[b[owner] + place]) & _MASKS[np.minimum(size[owner] - place, 8)]) != 0
        out[owner[differ]] = False
    return out


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of `size` consecutive hashes: runs of powers of two, paired."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    have, width, out, done = hashes, 1, None, 0
    while True:
        if size & width:
            part = have[done : done + n]
            out, done = part if out is None else _pair(out, part), done + width
        if 2 * width > size:
            return out
        have, width = _pair(have[:-width], have[width:]), 2 * width


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """The least of each run of `size` consecutive numbers."""
    have, width = x, 1
    while 2 * width <= size:
        have, width = np.minimum(have[:-width], have[width:]), 2 * width
    rest = size - width
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have
