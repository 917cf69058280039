"""Token ids of whole texts, with a worker-wide cache of pieces.

Both kinds of vocabulary known here split a text at changes between letters,
digits, marks and white space before they merge. So a text's ids are those of
its pieces, and a piece seen before needs no second merge. A tokenizer of any
other kind encodes whole texts.
"""

from __future__ import annotations

import gc
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import worker_cache

#: Pieces of each of the two generations of a worker's cache, unless the caller says otherwise; longer pieces are never kept.
CACHE_ENTRIES, CACHE_BYTES = 250_000, 48
#: Texts of about so many bytes are encoded together.
GROUP_BYTES = 4 << 20
#: Texts with white space besides blanks and line ends; these are encoded whole.
ODD = "[\\t\\x0b\\x0c\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
#: What a tokenizer file says of the two kinds (fixed values of the formats).
WORD_KIND = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "split": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
#: A blank and letters that _split() takes for such: ASCII, Latin-1 and Latin Extended-A, each one character in lower case and composed.
LETTERED = re.compile(rb" (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])+")


def _classes() -> np.ndarray:
    """For each byte its class. OTHER bytes (apostrophes, controls, most of what is not ASCII) keep
    the run of characters around them whole. 0xC3 to 0xC5 begin letters, but for those of _split()."""
    out = np.full(256, OTHER, np.uint8)
    out[[10, 32]] = SPACE
    out[0x21:0x7F] = MARK
    out[0x27] = OTHER
    out[0x30:0x3A] = DIGIT
    out[0x41:0x5B] = out[0x61:0x7B] = LETTER
    out[0xC3:0xC6] = LETTER
    return out


_CLASS = _classes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _split(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces of the texts begin, and the end: a piece is a run of one class with the blank
    before it, a line end, or the white space before the last blank or line end of a run."""
    n = len(data)
    kind = _CLASS[data]
    wide = np.flatnonzero((data & 0xC0) == 0x80)
    if len(wide):  # later bytes of characters
        lead, low = data[wide - 1], data[wide]
        kind[wide] = np.where((lead >= 0xC3) & (lead <= 0xC5), LETTER, OTHER)
        # No letters (multiplication and division signs), or more than one in lower case.
        off = wide[((lead == 0xC3) & ((low == 0x97) | (low == 0xB7))) | ((lead == 0xC4) & (low == 0xB0))]
        kind[off] = kind[off - 1] = OTHER
    space = kind == SPACE
    cut = np.zeros(n + 1, bool)
    cut[1:n] = (kind[1:] != kind[:-1]) & ~space[:-1] & ~space[1:]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    other = kind == OTHER
    if other.any():  # runs that hold such a byte stay whole
        run = np.cumsum(space | edge[:n], dtype=np.int32)
        hit = np.zeros(int(run[-1]) + 1, bool)
        hit[run[other]] = True
        cut[:n] &= ~hit[run]
    before, after = np.zeros(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    after[edge[1:]] = True
    cut[:n] |= space & (~before | ~after)
    cut[1:n] |= (data[:-1] == 10) & ~space[1:]
    return np.flatnonzero(cut | edge)


class Ids:
    """Encodes texts with the tokenizers library into little-endian unsigned 32-bit ids.

    Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        kept = worker_cache()
        state = kept.__dict__.get(("ids", path))
        if state is None:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            kind = self._kind(tokenizer)
            light, edges = tokenizer, np.zeros(tokenizer.get_vocab_size(), bool)
            if kind:
                light = self._light(Tokenizer(tokenizer.model), kind)  # one model for both
                for i in range(len(edges)):
                    token = tokenizer.id_to_token(i) or ""
                    edges[i] = token.endswith("</w>") if kind == "word" else token.startswith("Ġ")
            state = kept.__dict__[("ids", path)] = [tokenizer, light, kind, edges, {}, {}]
        self.state, self.entries = state, entries
        self.tokenizer, self.light, self.kind, self.edges = state[:4]

    @staticmethod
    def _kind(tokenizer) -> str | None:
        """`word` (lower case, white space dropped), `byte` (blanks belong to the next word), or none of these."""
        normal, pre = (json.loads(x.__getstate__()) if x is not None else {} for x in (tokenizer.normalizer, tokenizer.pre_tokenizer))
        if not normal and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            return "byte"
        parts = pre.get("pretokenizers", ())
        if normal == WORD_KIND["normalizer"] and len(parts) == 2 and parts[0].get("pattern") == {"Regex": WORD_KIND["split"]} and parts[0]["invert"] and parts[1].get("use_regex") is False and tokenizer.model.end_of_word_suffix == "</w>":
            return "word"
        return None

    @staticmethod
    def _light(tokenizer, kind: str):
        """The same merges for words of LETTERED, in lower case where case is dropped: nothing is left to normalise or to look for."""
        from tokenizers import normalizers, pre_tokenizers

        if kind == "word":
            tokenizer.normalizer = normalizers.Sequence([])
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed" if kind == "word" else "merged_with_next"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return tokenizer

    def plain(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in got]

    def _lettered(self, words: list[bytes]) -> list[bytes]:
        """plain() for pieces of LETTERED, many in one text; ids at the edge of a word are known as such."""
        out: list[bytes] = []
        for part in (words[i : i + 256] for i in range(0, len(words), 256)):
            text = b"".join(part).decode()
            (got,) = self.light.encode_batch_fast([text.lower() if self.kind == "word" else text], add_special_tokens=False)
            raw = got.ids
            edges = np.flatnonzero(self.edges[raw])
            ids = array("I", raw).tobytes()
            at = [0, *((edges + 1) * 4).tolist()] if self.kind == "word" else [*(edges * 4).tolist(), len(ids)]
            if len(at) != len(part) + 1:
                raise ValueError("ids do not tell where words end")
            out += [ids[a:b] for a, b in zip(at, at[1:])]
        return out

    def __call__(self, text: str | None) -> bytes:
        """The ids of one text, little-endian; none for a null or empty one."""
        return next(self.batch(pa.array([text], pa.string()))).tobytes()

    def batch(self, texts: pa.Array):
        """The ids (unsigned 32-bit) of each text.

        Texts are cut and their pieces counted column-wise; only pieces that differ
        come to Python, and ids are gathered by piece number.
        """
        sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // GROUP_BYTES
        cuts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(texts)).tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = texts.slice(a, b - a).fill_null("")
            if self.kind:
                yield from self._group(part)
            else:
                yield from (np.frombuffer(x, "<u4") for x in self.plain(part.to_pylist()))

    def _group(self, texts: pa.Array):
        odd, whole = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False).astype(bool), texts
        if odd.any():
            texts = pc.if_else(pa.array(odd), "", texts)
        raw = texts.buffers()
        offsets = np.frombuffer(raw[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(raw[2], np.uint8)[offsets[0] : offsets[-1]] if raw[2] is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        if not len(data):
            ids, bounds = np.zeros(0, "<u4"), [0] * (len(texts) + 1)
        else:
            begin = _split(data, offsets)
            if self.kind == "word":
                data = _LOWER[data]
            pieces = pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
            coded = pieces.dictionary_encode()
            collecting = gc.isenabled()
            gc.disable()  # a million strings and no cycle among them
            found = self._lookup(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            if collecting:
                gc.enable()
            which = coded.indices.to_numpy()
            lens = np.fromiter(map(len, found), np.int64, len(found)) >> 2
            every, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(lens) - lens
            size = lens[which]
            ends = np.cumsum(size)
            at = np.repeat(first[which] - (ends - size), size)
            at += np.arange(len(at))
            ids = every[at]
            bounds = np.append(0, ends)[np.searchsorted(begin, offsets)].tolist()
        for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            yield np.frombuffer(self.plain([whole[i].as_py()])[0], "<u4") if odd[i] else ids[a:b]

    def _lookup(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of different pieces. New ones are kept; once the cache is full it becomes the old
        generation, of which only pieces that are met again stay."""
        cache, old = self.state[4:]
        found = list(map(cache.get, pieces))
        lacking = [i for i, x in enumerate(found) if x is None]
        if not lacking:
            return found
        if len(cache) > self.entries:
            self.state[4:] = cache, old = {}, cache
        got = {}
        for i in lacking:
            p = pieces[i]
            if (ids := old.get(p)) is not None:
                got[p] = ids
        new = [pieces[i] for i in lacking if pieces[i] not in got]
        easy = [p for p in new if (p[1:].isalpha() and p[:1] == b" ") or LETTERED.fullmatch(p)]
        got.update(zip(easy, self._lettered(easy), strict=True))
        hard = [p for p in new if p not in got]
        got.update(zip(hard, self.plain([p.decode() for p in hard]), strict=True))
        for i in lacking:
            found[i] = got[pieces[i]]
        cache.update(got)
        for p in [p for p in new if len(p) > CACHE_BYTES]:
            del cache[p]
        return found
