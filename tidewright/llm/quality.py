"""A quality classifier by Bradley-Terry ranking.

Labelled documents make preference pairs, good over bad. Logistic loss on the
difference of their features gives a strength, whatever the corpus; the
threshold is that quantile of the strengths of all documents which tells the
labelled ones apart best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, map_arrow, own_names, table
from .textnp import IS_SPACE, chunks, word_bounds, word_hashes

#: Bound of the labelled rows that the fit reads, and partners that each gets.
FIT_ROWS, PARTNERS = 20_000, 8
#: L2 weight, Newton steps, and steps of the strength that thresholds are sought by.
RIDGE, STEPS, GRID = 1.0, 25, 0.01
LIMIT = 40.0

_NAMES = ("symbols", "upper", "digits", "bangs", "bars", "stops", "commas", "other_marks", "wide", "word_length", "word_length_2", "log_words", "short", "repeated_words", "repeated_pairs", "repeated_lines", "line_words", "blank")


def _classes() -> np.ndarray:
    """For each byte: 1 symbol, 2 capital, 3 digit, 4 bang, 5 bar, 6 stop, 7 comma, 8 other mark, 9 first byte of a wide character, 10 its others."""
    out = np.zeros(256, np.uint8)
    for code, chars in enumerate(("#*$%&<>@^~=\\+_", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!", "|", ".?", ",;:", "()[]{}\"'`/-"), 1):
        out[[ord(c) for c in chars]] = code
    out[0xC0:], out[0x80:0xC0] = 9, 10
    return out


def _repeats(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows: the share of its keys that an earlier one of the row equals."""
    total = np.bincount(owner, minlength=n)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    again = np.zeros(len(k), bool)
    again[1:] = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[again], minlength=n) / np.maximum(total, 1)


def features(texts: pa.Array) -> np.ndarray:
    """A row of numbers for each whole text, of its characters, words and lines alone; an empty text has its own row."""
    classes, blocks = _classes(), []
    for _, offsets, data in chunks(texts):
        n = len(offsets) - 1
        size = np.diff(offsets)
        kind = classes[data]
        rows = np.repeat(np.arange(n), size)
        counts = np.bincount(rows * 11 + kind, minlength=n * 11).reshape(n, 11).astype(float)
        chars = np.maximum(size - counts[:, 10], 1)
        starts, ends, first = word_bounds(data, offsets)
        words = np.diff(first)
        owner = np.repeat(np.arange(n), words)
        hashes = word_hashes(data, starts, ends)
        length = (ends - starts).astype(float)
        mean = np.bincount(owner, length, n) / np.maximum(words, 1)
        square = np.sqrt(np.bincount(owner, length * length, n) / np.maximum(words, 1))
        pair = hashes[:-1] * np.uint64(3) + hashes[1:] if len(hashes) else hashes
        same = owner[:-1] == owner[1:] if len(owner) else np.zeros(0, bool)
        # A line is the sum of its words' hashes, each turned by its place in the line.
        line_no = np.cumsum(data == 10)
        line = line_no[starts] if len(starts) else np.zeros(0, np.int64)
        head = np.ones(len(line), bool)
        head[1:] = (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])
        heads = np.flatnonzero(head)
        place = (np.arange(len(line)) - np.repeat(heads, np.diff(np.append(heads, len(line))))).astype(np.uint64)
        lines = np.add.reduceat(hashes * (place * np.uint64(2) + np.uint64(1)), heads) if len(heads) else np.zeros(0, np.uint64)
        n_lines = np.bincount(owner[heads], minlength=n) if len(heads) else np.zeros(n)
        per_word = np.maximum(words, 1)
        blank = size - np.bincount(rows, ~IS_SPACE[data], n)
        blocks.append(np.column_stack([
            counts[:, 1] / chars, counts[:, 2] / chars, counts[:, 3] / chars, counts[:, 4] / per_word, counts[:, 5] / per_word, counts[:, 6] / per_word, counts[:, 7] / per_word, counts[:, 8] / chars, counts[:, 9] / chars,
            mean / 10, square / 10, np.log1p(words) / 5, words < 30, _repeats(hashes, owner, n), _repeats(pair[same], owner[:-1][same], n) if len(owner) else np.zeros(n), _repeats(lines, owner[heads], n) if len(heads) else np.zeros(n), np.log1p(words / np.maximum(n_lines, 1)) / 5, blank / chars,
        ]))
    return np.vstack(blocks) if blocks else np.zeros((0, len(_NAMES)))


def _spread(x: np.ndarray) -> np.ndarray:
    """Features and their square roots: shares near 0 count as well as large ones."""
    return np.column_stack([x, np.sqrt(np.abs(x))])


def fit(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bradley-Terry weights of pairs (good, bad): (weights, mean, scale). Without both kinds all weights are 0."""
    x = _spread(x)
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    z, w = np.clip((x - mean) / scale, -8, 8), np.zeros(x.shape[1])
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(a) or not len(b):
        return w, mean, scale
    rng, pairs = np.random.default_rng(7), PARTNERS * max(len(a), len(b))
    d = z[a[np.arange(pairs) % len(a)]] - z[rng.permutation(np.resize(b, pairs))]
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(np.clip(d @ w, -50, 50)))
        gradient = d.T @ p / pairs - RIDGE / len(x) * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + np.eye(len(w)) * (RIDGE / len(x) + 1e-9)
        step = np.linalg.solve(curve, gradient)
        w = w + step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-6:
            break
    return w, mean, scale


def strengths(x: np.ndarray, model) -> np.ndarray:
    w, mean, scale = model
    return np.round(np.clip((np.clip((_spread(x) - mean) / scale, -8, 8) * w).sum(axis=1), -LIMIT, LIMIT), 6)


def best_quantile(grid: list[tuple[int, int]], own: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """(quantile, its strength) of all documents, `grid` their counts by step of GRID, that tells the labelled strengths best apart.

    Errors on bad and on good rows weigh alike by number; of equally good quantiles the middle of the longest run.
    """
    if not grid:
        return 0.0, 0.0
    steps = np.array([g[0] for g in grid])
    share = np.cumsum([g[1] for g in grid])
    edges = np.arange(steps[0], steps[-1] + 2)  # documents below edge * GRID are rejected
    at = np.floor(own / GRID).astype(np.int64)
    if not len(own) or good.all() or not good.any():
        edge = edges[0]
    else:
        lost = np.searchsorted(np.sort(at[good]), edges, side="left")
        passed = (~good).sum() - np.searchsorted(np.sort(at[~good]), edges, side="left")
        best = lost + passed == (lost + passed).min()
        change = np.flatnonzero(np.diff(np.concatenate([[0], best.astype(int), [0]])))
        runs = list(zip(change[::2], change[1::2], strict=True))
        lo, hi = max(runs, key=lambda r: r[1] - r[0])
        edge = edges[(lo + hi - 1) // 2]
    below = share[np.searchsorted(steps, edge) - 1] if np.searchsorted(steps, edge) else 0
    return float(below / share[-1]), float(edge * GRID)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> tuple:
    """(Bradley-Terry model, strengths of the labelled rows, which of these are good).

    The fit reads at most `fit_rows` labelled rows whose crc32(id) mod 3 is not
    1, chosen by hash of the id.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("doc_id IS NOT NULL AND quality IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    width = len(_NAMES)

    def measure(batches):
        for batch in batches:
            x = features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float64()))], ["quality", "x"])

    sample = map_arrow(rows.join(F.broadcast(chosen), "doc_id").select("quality", "text"), measure, "quality int, x array<double>").collect()  # fit_rows documents
    sample.sort(key=lambda r: (r.x, r.quality))  # whatever order they came in
    x = np.array([r.x for r in sample]).reshape(len(sample), width)
    good = np.array([r.quality == 1 for r in sample], bool)
    model = fit(x, good)
    return model, strengths(x, model), good


def with_strengths(rows: DataFrame, text_col: str, strength_col: str, model) -> DataFrame:
    """`rows` and the strength of each, in one pass over the texts."""
    place = rows.columns.index(text_col)

    def score(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(strengths(features(batch.column(place)), model))], [*batch.schema.names, strength_col])

    return map_arrow(rows, score, T.StructType([*rows.schema.fields, T.StructField(strength_col, T.DoubleType())]))


def threshold_of(scored: DataFrame, strength_col: str, own: np.ndarray, good: np.ndarray) -> float:
    """The strength at the quantile of all documents that tells the labelled ones apart best."""
    grid = scored.groupBy(F.floor(F.col(strength_col) / GRID).alias("step")).count().collect()  # 2 * LIMIT / GRID rows at most
    return best_quantile(sorted((int(r[0]), r[1]) for r in grid), own, good)[1]


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted, strength for each row of `docs`.

    Null texts are empty texts; labels besides 0 and 1 are left out, of several
    of one document the best counts; without labels of both kinds all scores are
    0.5. Equal texts have equal scores, whatever their length; an empty table gives an empty one.
    """
    model, own, good = train(docs, labels, id_col, text_col, fit_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = cut(with_strengths(rows, "text", "strength", model).select("doc_id", "strength"))
    value = 1 / (1 + F.exp(F.lit(threshold_of(scored, "strength", own, good)) - F.col("strength")))
    out = scored.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), value.alias("score"), "strength")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of `docs` that quality_scores() predicts to be good. Texts are scored once; rows wait for the threshold in a checkpoint, with their strengths."""
    model, own, good = train(docs, labels, id_col, text_col, fit_rows)
    (strength,) = own_names(docs.columns, "strength")
    scored = cut(with_strengths(docs, text_col, strength, model))
    return scored.where(F.col(strength) >= threshold_of(scored, strength, own, good)).select(*docs.columns)


def op1_bradley_terry_quality(spark, sf_dir: str) -> DataFrame:
    """A score for every row of `documents`; null and empty texts are scored too, repeated rows alike, an empty table gives no rows."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
