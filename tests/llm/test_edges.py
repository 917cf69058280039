"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator; results against brute force."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewright.llm import mixing, ngram_join, packing, quality, simhash, substring, token_files, tokens, warc, weak_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words int, row string, spans string, n_words string, doc_ids int"
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))
PROSE = "The first of the days came and the river, which had been low, rose to the old stones. No one had seen it so before. "


def base(n, rng=np.random.default_rng(3)):
    """n texts of their own."""
    syllables = ["ta", "re", "mo", "lin", "ker", "sa", "ul", "ve", "dor", "i"]
    return [" ".join("".join(rng.choice(syllables, 3)) for _ in range(60)) + ".\n" + PROSE for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    own = base(12)
    near = own[0].replace("river", "brook")
    return [(1, own[0]), (2, own[1]), (3, None), (4, ""), (5, " \n\t "), (6, own[0]), (7, near), (8, LONG), (9, own[2] + " " + own[1]), (10, "two words"), (11, "Two  Words"), (None, own[3]), (None, own[3]), (12, own[4]), (12, own[4]), (13, "x\x00y ünï cödé 漢字"), *((20 + i, t) for i, t in enumerate(own[5:]))]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None if i in (2, 9) else f"s{(i or 0) % 3}", len(t or ""), 1, "r", "s", "n", 7) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words(t):
    return WORD.findall(t or "")


# --- tokens ---


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_pieces_are_whole_texts(name):
    rng = np.random.default_rng(1)
    letters = list("aB,b1#%_$-(. \n\t'é\x0b\x1c\x85\x00ßŉ") + ["don't", "<|endoftext|>", "　", "é", " the", ".\n"]
    odd = ["".join(rng.choice(letters, rng.integers(1, 25))) for _ in range(1500)] + ["", "a  b", "\n", " x", "x " + "y" * 300, PROSE, PROSE.upper()]
    encode = tokens.Ids(public_tokenizers.path(name))
    import pyarrow as pa

    got = [x.tobytes() for x in encode.batch(pa.array([*odd, None]))]
    assert got[:-1] == encode.plain(odd) and got[-1] == b""
    assert [x.tobytes() for x in encode.batch(pa.array(["zz", *odd])[1:])] == got[:-1]  # a slice


@pytest.mark.parametrize("width", [1, 7, 16, 17, 31, 32])
def test_packing_bits(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        assert (token_files.unpack(token_files.pack(ids, width), width, n) == ids).all()
    with pytest.raises(ValueError, match="more than"):
        token_files.pack(np.array([1 << width], np.uint64), width) if width < 32 else token_files.pack(np.array([1 << 32], np.uint64), width)


def encoded(name, texts, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return [np.array([*e.ids, end], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_token_files(spark, docs, empty, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 128)
    files = token_files.write_token_files(docs, f"file://{tmp_path}/ids", public_tokenizers.path("word_bpe_49k.json"), 49408, 2)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(files).collect())
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want, start = [], 0
    for (i, _), ids in zip(order, encoded("word_bpe_49k.json", [t for _, t in order], 2), strict=True):
        want.append((start, i, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    reader = token_files.Reader(files.orderBy(F.desc("n_ids")).first().path)
    whole = np.concatenate([x for _, _, x in reader.documents()])
    assert (reader.ids(100, 900) == whole[100:1000]).all() and (reader.document(0) == whole[: int(reader.starts[1])]).all() and len(reader.ids(5, 0)) == 0
    assert token_files.read_token_files(token_files.write_token_files(empty, f"file://{tmp_path}/none", public_tokenizers.path("word_bpe_49k.json"), 49408, 2)).count() == 0


def check_pieces(rows, ids_of, window=1024):
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    lengths = []
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        lengths.append(at)
    want = collections.Counter((i, len(x)) for i, x in ids_of)
    assert {k: sum(r.length for r in v) for k, v in pieces.items()} == {k: n * k[1] for k, n in want.items()}
    by_id = collections.defaultdict(list)
    for i, x in ids_of:
        by_id[i, len(x)].append(x)
    for k, own in pieces.items():
        for r in own:
            assert any(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in by_id[k])
    return lengths


def test_packing(docs, empty, texts):
    args = (public_tokenizers.path("byte_bpe_50k.json"), 50257, 0)
    lengths = check_pieces(packing.pack_sequences(docs, *args).collect(), list(zip([i for i, _ in texts], encoded("byte_bpe_50k.json", [t for _, t in texts], 0), strict=True)))
    assert sum(x < 1024 for x in lengths) <= docs.rdd.getNumPartitions()
    assert packing.pack_sequences(empty, *args).count() == 0


def test_neighbours_fill_the_window():
    ids = [np.array(x, np.uint32) for x in ([1, 2, 3, 4], [50, 51, 52], [1, 2, 3, 9], [60, 61])]
    index = packing.Index(ids, np.ones(100, np.float32), 3.0)
    scores = index.scores(0)
    assert scores[2] > 0 and scores[1] == scores[3] == 0
    packer = packing.Packer(8, 0)
    rows = list(packer.shard([(i, x) for i, x in enumerate(ids)], np.ones(100, np.float32), 3.0))
    assert [r[0] for r in rows][:2] == [0, 2] and rows[0][5] == rows[1][5] == 0


@pytest.mark.parametrize(("rows", "postings"), [(1024, 1 << 20), (7, 50), (0, 1 << 20)])
def test_all_ids_of_a_seed_ask(rows, postings, monkeypatch):
    monkeypatch.setattr(packing, "ROWS", rows, raising=False)
    monkeypatch.setattr(packing, "POSTINGS", postings, raising=False)
    rng = np.random.default_rng(8)
    # Document 1 shares 12 rarer ids with document 0, document 2 shares 60 others; 40 more have ids of both.
    ids = [np.arange(80), np.arange(12), np.arange(12, 72), *(rng.choice(200, rng.integers(20, 90)) for _ in range(40)), np.array([300])]
    ids = [x.astype(np.uint32) for x in ids]
    sets = [dict(zip(*np.unique(x, return_counts=True), strict=True)) for x in ids]
    df = np.bincount([k for s in sets for k in s], minlength=400)
    df[:12] -= 3
    idf, mean = np.log1p((len(ids) - df + 0.5) / (df + 0.5)).astype(np.float32), sum(map(len, ids)) / len(ids)
    index = packing.Index(ids, idf, mean)
    for d in range(len(ids)):
        want = [sum(float(idf[k]) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ids[c]) / mean)) for k, n in sets[c].items() if k in sets[d]) for c in range(len(ids))]
        got = index.scores(d)
        if len(ids[d]) == 1:
            assert not got.any()
            continue
        others = np.arange(len(ids)) != d
        assert np.allclose(got[others], np.array(want)[others], rtol=1e-5)
    packer = packing.Packer(140, 0)
    placed = [r[0] for r in packer.shard(list(enumerate(ids[:3])), idf, mean)]
    assert placed[:2] == [0, 2]


# --- quality ---


def test_quality(spark, docs, empty):
    good = base(40, np.random.default_rng(5))
    data = [(i, t, 1) for i, t in enumerate(good)] + [(100 + i, " ".join(w + "###$$" for w in t.split()), 0) for i, t in enumerate(good)]
    known = spark.createDataFrame(data, "doc_id long, text string, quality int")
    labels = known.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (3, None), (4, 7)], "doc_id long, quality int"))
    got = {r.doc_id: r for r in quality.quality_scores(known.select("doc_id", "text"), labels).collect()}
    held = [(got[i].predicted, q) for i, _, q in data if got[i].held_out]
    assert held and all(a == b for a, b in held)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    out = quality.quality_scores(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(empty, labels).count() == 0 and quality.good_documents(empty, labels).columns == docs.columns
    kept = quality.good_documents(known.select("text", "doc_id"), labels)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.predicted)


def auc(score, good):
    a, b = score[good][:, None], score[~good][None, :]
    return float(((a > b) + 0.5 * (a == b)).mean())


def test_quality_on_held_out_labels(spark):
    """Over the documents: the scores are the model's, recomputed here text by text, and tell held-out labels apart."""
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in quality.op1_bradley_terry_quality(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert set(rows) == set(texts) and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    import pyarrow as pa

    own = {i: quality.features(pa.array([t], pa.string()))[0] for i, t in texts.items()}
    fitted = sorted((own[i].tolist(), q) for i, q in label.items() if not rows[i].held_out)
    x, good = np.array([f for f, _ in fitted]), np.array([q == 1 for _, q in fitted])
    model = quality.fit(x, good)
    strength = {i: float(quality.strengths(f[None, :], model)[0]) for i, f in own.items()}
    assert all(abs(strength[i] - r.strength) < 1e-5 for i, r in rows.items())
    # The threshold by trying every edge: the fewest errors on labelled rows there can be.
    s = np.array([strength[i] for i in label if not rows[i].held_out])
    y = np.array([label[i] == 1 for i in label if not rows[i].held_out])
    predicted = np.array([rows[i].predicted == 1 for i in label if not rows[i].held_out])
    fewest = min((y & (s < e)).sum() + (~y & (s >= e)).sum() for e in np.arange(np.floor(s.min() / quality.GRID), s.max() / quality.GRID + 2) * quality.GRID)
    assert (predicted != y).sum() <= fewest + 1
    held = [i for i in label if rows[i].held_out]
    assert auc(np.array([rows[i].score for i in held]), np.array([label[i] == 1 for i in held])) > 0.98
    assert np.mean([rows[i].predicted == label[i] for i in held]) > 0.95


def test_features_don_t_depend_on_neighbours():
    import pyarrow as pa

    some = [*base(3), "", LONG[:5000], None, "a"]
    together = quality.features(pa.array(some))
    assert together.shape[0] == len(some) and all((quality.features(pa.array([t], pa.string()))[0] == together[i]).all() for i, t in enumerate(some))


def rule_counts(t):
    t = t or ""
    w, lines = words(t), [x for x in t.split("\n") if WORD.search(x)]
    seen, cover = collections.Counter(zip(w, w[1:], w[2:], strict=False)), set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w)


def test_weak_rules(spark, docs, empty, texts):
    more = [(200, "a b c a b c d"), (201, "x\n\nx\n x \n\ty"), (202, "a a a a a"), (203, "#|<> a&b \x0b c")]
    frame = docs.select("doc_id", "text", "n_words").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = collections.Counter((r.doc_id, *(r[n] for n in names)) for r in weak_rules.weak_supervision(frame).collect())
    assert got == collections.Counter((i, *rule_counts(t)) for i, t in [*texts, *more])
    assert weak_rules.weak_supervision(empty).count() == 0
    assert not any(r.kept and r.base_failed for r in weak_rules.weak_supervision(frame).collect())


def test_rules_are_weighed():
    # Two rules that agree, and one that says anything.
    patterns = [((1, 1, 1), 400), ((1, 1, -1), 400), ((-1, -1, 1), 50), ((-1, -1, -1), 50)]
    prior, chances = weak_rules.estimate(patterns, 3)
    assert 0.7 < prior < 0.95 and chances[0][1][0] > 0.6 and abs(chances[2][0][0] - chances[2][1][0]) < 0.3
    assert weak_rules.majority((-1, -1, 1)) < 0.5 < weak_rules.posterior((1, 1, -1), prior, chances)
    assert weak_rules.estimate([], 3) == (0.5, [((0.5, 0.5), (0.5, 0.5))] * 3)
    prior, chances = weak_rules.estimate([((1, 1, 0), 90), ((1, 0, 1), 10)], 3)  # no bad vote: nothing is rejected
    assert all(weak_rules.posterior(p, prior, chances) >= 0.5 for p in ((1, 1, 0), (1, 0, 1), (0, 0, 0)))


def em_by_documents(x):
    """The same model over a matrix of one row a document."""
    good = (1 + (x > 0).sum(axis=1)) / (2 + (x != 0).sum(axis=1))
    w = weak_rules.SMOOTH * len(x)
    for _ in range(weak_rules.ROUNDS):
        chance = np.array([[[(w / 2 + share[x[:, j] == v].sum()) / (w + share[x[:, j] != 0].sum()) for v in (-1, 1)] for j in range(x.shape[1])] for share in (good, 1 - good)])
        prior = (w + good.sum()) / (2 * w + len(x))
        odds = np.log(prior / (1 - prior)) + sum(np.where(x == v, np.log(chance[0, :, i] / chance[1, :, i]), 0).sum(axis=1) for i, v in enumerate((-1, 1)))
        before, good = good, 1 / (1 + np.exp(-odds))
        if abs(good - before).max() < 1e-9:
            break
    return good


def test_expectation_maximisation_decides(spark, sf_dir):
    """By brute force over documents; the verdicts differ from the majority's and agree better with labels."""
    rows = weak_rules.weak_supervision(spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id")).collect()
    names = [f"vote_{n}" for n, _, _ in weak_rules.RULES]
    judged = [r for r in rows if not r.base_failed]
    x = np.array([[r[n] for n in names] for r in judged])
    want = em_by_documents(x)
    assert np.allclose([r.posterior for r in judged], want, atol=1e-6)
    assert [r.kept for r in judged] == (want >= 0.5).tolist()
    assert not any(r.kept for r in rows if r.base_failed)
    start = (1 + (x > 0).sum(axis=1)) / (2 + (x != 0).sum(axis=1)) >= 0.5
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    known = [(r.kept, s, label[r.doc_id] == 1) for r, s in zip(judged, start.tolist(), strict=True) if r.doc_id in label]
    assert any(k != s for k, s, _ in known) and sum(k == y for k, _, y in known) > sum(s == y for _, s, y in known)
    assert all(k for k, _, y in known if y)


BASE_COLUMNS = r"""
    WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
    t AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS tri FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3) x),
    m AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM t) x WHERE n > 1),
    c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM m) x GROUP BY doc_id)
    SELECT w.doc_id, len(ws) AS n_words, coalesce(length(array_to_string(ws, '')), 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(ws) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(ws) AS base_failed
    FROM w JOIN l ON l.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id"""


def test_base_columns_by_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted(tuple(r[n] for n in names) for r in weak_rules.op3_weak_rules(spark, sf_dir).collect())
    assert got == sorted(con.sql(BASE_COLUMNS).fetchall())


# --- archives ---


def test_warc(spark, tmp_path):
    big = "<p>" + "x" * 200 + "é</p>"
    pages = spark.createDataFrame([(5, "http://a/\r\nX: y", big), (2, "http://b", big), (9, None, big), (3, "u", "tiny"), (4, "u", "tiny"), (6, "u", None), (7, "u", ""), (None, "u", big), (2, "again", big)], "page_id long, url string, html string")
    pages = pages.withColumn("digest", F.lit("clash")).withColumn("lot", F.lit(1))
    folder = f"file://{tmp_path}/a"
    warc.write_archive(pages, folder)
    rows = warc.records(warc.read_archive(spark, folder)).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    n = len(big.encode())
    want = [(5, n, sha(big), "revisit", 2), (2, n, sha(big), "response", None), (2, n, sha(big), "response", None), (9, n, sha(big), "revisit", 2), (None, n, sha(big), "revisit", 2), (3, 4, sha("tiny"), "response", None), (4, 4, sha("tiny"), "response", None), (6, 0, sha(""), "response", None), (7, 0, sha(""), "response", None)]
    assert got == sorted(want, key=str)
    assert spark.read.parquet(f"{folder}/payloads").count() == 3
    files = warc.export_files(warc.read_archive(spark, folder), f"file://{tmp_path}/files").collect()
    said = [(h["WARC-Type"], len(b)) for f in files for h, b in warc.read_file("file://" + f.path)]
    assert sum(f.n_records for f in files) == 9 and said.count(("revisit", 0)) == 3 and said.count(("response", n)) == 2
    warc.write_archive(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.records(warc.read_archive(spark, f"file://{tmp_path}/none")).count() == 0


def test_hot_payloads_are_dealt_in_lots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LOT", 10)
    pages = spark.range(100).select(F.col("id").alias("page_id"), F.concat(F.lit("u"), "id").alias("url"), F.lit("y" * 150).alias("html"))
    warc.write_archive(pages, f"file://{tmp_path}/a")
    assert spark.read.parquet(f"file://{tmp_path}/a/headers").select("lot").distinct().count() > 5
    rows = warc.records(warc.read_archive(spark, f"file://{tmp_path}/a")).collect()
    assert len(rows) == 100 and {r.refers_to for r in rows} == {None, 0}


def test_a_changed_payload_is_seen(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([(1, "u", "z" * 120)], "page_id long, url string, html string"), f"file://{tmp_path}/a")
    whole = warc.read_archive(spark, f"file://{tmp_path}/a")
    bad = whole.withColumn("record", F.encode(F.regexp_replace(F.decode("record", "utf-8"), "z{120}", "y" * 120), "utf-8"))
    with pytest.raises(Exception, match="not what its header says"):
        warc.records(bad).collect()
    with pytest.raises(ValueError, match="as long as"):
        warc.parse_record(whole.first().record[:-5])


def test_records_come_back_byte_by_byte(spark, tmp_path):
    """Parsed and as files, a very long payload and one with record ends in it too."""
    html = {1: "a\r\n\r\nWARC/1.1\r\n" + "x" * 200, 2: "é" * (3 << 20), 3: "a\r\n\r\nWARC/1.1\r\n" + "x" * 200, 4: None}
    pages = spark.createDataFrame([(i, f"http://{i}", t) for i, t in html.items()], "page_id long, url string, html string")
    warc.write_archive(pages, f"file://{tmp_path}/a")
    said = {}
    for r in warc.read_archive(spark, f"file://{tmp_path}/a").collect():
        head, body = warc.parse_record(r.record)
        i = int(head["WARC-Record-ID"][len("<urn:page:") : -1])
        said[i] = (head["WARC-Type"], body)
        assert r.record.endswith(body + warc.CLOSE) and r.record.startswith(b"WARC/1.1\r\n") and (r.payload is None) == (i != 3)
    assert said == {i: ("revisit", b"") if i == 3 else ("response", (t or "").encode()) for i, t in html.items()}


def test_a_hot_digest_is_dealt_by_salts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SHARE", 8)
    monkeypatch.setattr(warc, "LOT", 10)
    pages = spark.range(300).selectExpr("id AS page_id", "concat('u', id) AS url", "if(id % 3 = 0, repeat('y', 150), concat(repeat('z', 150), id)) AS html")
    warc.write_archive(pages, f"file://{tmp_path}/a")
    rows = warc.records(warc.read_archive(spark, f"file://{tmp_path}/a")).collect()
    assert sorted(r.page_id for r in rows) == list(range(300)) and sum(r.refers_to == 0 for r in rows) == 99


def test_stores_of_the_engine_s_names():
    from tidewright.llm.common import lake_fs

    assert lake_fs("s3a://bucket/a/b?region=us-east-1")[1] == "bucket/a/b" and lake_fs("file:///tmp/x")[1] == "/tmp/x"


# --- joins ---


def shingles(t, size=4):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def linked(data, like=(85, 100), size=4):
    """Least ids of components by comparing all pairs; nulls last."""
    key = [(i if i is not None else 1 << 63) for i, _ in data]
    sets, group = [shingles(t, size) for _, t in data], list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            o = len(sets[a] & sets[b])
            if sets[a] and sets[b] and like[1] * o >= like[0] * (len(sets[a]) + len(sets[b]) - o):
                ga, gb = group[a], group[b]
                group = [gb if g == ga else g for g in group]
    least = {g: min(k for k, h in zip(key, group, strict=True) if h == g) for g in group}
    return sorted(((i, len(s), None if least[g] == 1 << 63 else least[g]) for (i, _), s, g in zip(data, sets, group, strict=True)), key=str)


def near_texts(n, rng):
    """Families of texts with a few words changed, some at the very edge of the threshold."""
    out = []
    for f in range(n):
        w = [f"f{f}w{i}" for i in range(int(rng.integers(8, 150)))]
        for _ in range(int(rng.integers(1, 9))):
            v = list(w)
            for _ in range(int(rng.integers(0, max(2, len(w) // 25)))):
                v[int(rng.integers(len(v)))] = f"e{rng.integers(1000)}"
            out.append(" ".join(v))
    return out


def test_ngram_join(spark, docs, empty, texts):
    names = lambda df: sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)
    assert names(ngram_join.similar_documents(docs)) == linked(texts)
    assert ngram_join.similar_documents(empty).count() == 0
    data = list(enumerate(near_texts(25, np.random.default_rng(2))))
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    assert names(ngram_join.similar_documents(frame)) == linked(data)
    assert names(ngram_join.similar_documents(frame, size=5, like=(80, 100))) == linked(data, (80, 100), 5)


def test_large_blocks_go_by_tiles(spark, monkeypatch):
    rng = np.random.default_rng(8)
    w = [f"w{i}" for i in range(100)]
    data = []
    for i in range(60):  # a chain: neighbours are alike, the ends are not
        w = list(w)
        w[(7 * i) % 100] = f"n{i}"
        data.append((i, " ".join(w)))
    frame = spark.createDataFrame([data[i] for i in rng.permutation(60)], "doc_id long, text string")
    whole = ngram_join.linked_sets
    monkeypatch.setattr(ngram_join, "linked_sets", lambda sets, like: whole(sets, like, per_group=1000))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_documents(frame).collect()), key=str)
    assert got == linked(data)


def test_one_of_each(docs, texts):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    component = {i: c for i, _, c in linked(texts)}
    assert got == sorted({i for i, _ in texts if component[i] == i}, key=str)


def test_one_of_each_component_not_id(spark):
    own = base(5, np.random.default_rng(11))
    near = lambda i: own[i].replace("river", "brook")
    groups = [
        [(5, own[0]), (5, near(0)), (6, own[0])], [(5, own[1])],  # one id, two texts that are not alike
        [(None, own[2]), (None, near(2)), (None, own[2])], [(None, own[3])],  # near copies without an id
        [(4, own[4]), (5, near(4)), (None, near(4))], [(7, ""), (7, "")], [(None, ""), (None, None)],
    ]
    frame = spark.createDataFrame([r for g in groups for r in g], "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in ngram_join.one_of_each(frame).collect()]
    least = lambda g: min((i for i, _ in g if i is not None), default=None)
    assert len(got) == len(groups)
    assert all(sum((i, t) in [x for x in g if x[0] == least(g)] for i, t in got) == 1 for g in groups)


def removed(data, size=20):
    order = sorted(range(len(data)), key=lambda k: (data[k][0] is None, data[k][0] or 0))
    first, out = {}, []
    for k in order:
        w = words(data[k][1])
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), (data[k], i))
    for k in order:
        w = words(data[k][1])
        gone = bytearray(len(w))
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] != (data[k], i):
                gone[i : i + size] = b"\1" * size
        out.append((data[k][0], len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def test_substrings(spark, docs, empty, texts):
    frame = substring.without_repeats(docs)
    assert set(docs.columns) | {"n_removed", "kept_words"} == set(frame.columns)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_words) for r in frame.collect()), key=str) == removed(texts)
    assert substring.without_repeats(empty).count() == 0
    rng = np.random.default_rng(4)
    passages = [" ".join(f"p{k}w{i}" for i in range(60)) for k in range(4)]
    data = [(int(i), "\n".join(x if rng.random() < 0.5 else " ".join(f"r{rng.integers(50)}" for _ in range(15)) for x in rng.choice(passages, 5))) for i in rng.permutation(40)]
    got = substring.without_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(5))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_words) for r in got.collect()), key=str) == removed(data)
    kept = substring.deduplicated_documents(docs)
    want = {(i, t) if not gone else (i, k) for (i, n, gone, k), (_, t) in zip(removed(texts), sorted(texts, key=lambda x: str((x[0], len(words(x[1]))))), strict=True) if gone == 0 or gone < n}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in want}


def test_spans_are_sent_in_pieces(spark, monkeypatch):
    data = [(i, " ".join(f"w{(i * 3 + j) % 90}" for j in range(50))) for i in range(30)]
    monkeypatch.setattr(substring, "HELD", 2000)
    got = substring.without_repeats(spark.createDataFrame(data, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_words) for r in got.collect()), key=str) == removed(data)


# --- fingerprints ---


def test_simhash(spark, docs, empty, texts):
    rows = simhash.edited_fingerprints(docs, groups=4).collect()
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want = collections.Counter()
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        want[i, len(t), hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    prints = collections.defaultdict(set)
    for r in rows:
        prints[r.doc_id].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == simhash.BITS // 4
    assert prints[1] == prints[6] and prints[3] == prints[4] and prints[1] != prints[2]
    assert simhash.edited_fingerprints(empty, groups=4).count() == 0
    alone = simhash.edited_fingerprints(docs.where("doc_id = 1"), groups=4).first()
    assert alone.near_next == 1.0
    assert {r.doc_id: r.fingerprint for r in simhash.fingerprint_documents(docs).collect()}[1] in prints[1]


@pytest.mark.parametrize(("radius", "tile"), [(3, 256), (3, 2), (5, 3), (0, 2)])
def test_hamming_search(spark, radius, tile):
    rng = np.random.default_rng(6)
    centres = [int.from_bytes(rng.bytes(16)) for _ in range(12)] + [0, (1 << 128) - 1]
    values = [c ^ sum(1 << int(b) for b in rng.choice(128, rng.integers(0, 6), replace=False)) for c in centres for _ in range(9)]
    rows = [(i, f"{v:032x}", i % 3 == 0) for i, v in enumerate(values)] + [(1000, f"{values[0]:032x}", None), (None, f"{values[0]:032x}", True), (1001, None, True)]
    want = {}
    for _, p, asks in rows:
        if asks and p:
            near = [i for i, q, _ in rows if q and (int(p, 16) ^ int(q, 16)).bit_count() <= radius]
            want[p] = (len(near), min((i for i in near if i is not None), default=None))
    got = simhash.near_fingerprints(spark.createDataFrame(rows, "doc_id long, fingerprint string, asks boolean"), radius, tile=tile).collect()
    assert {r.fingerprint: (r.n_near, r.near_least) for r in got} == want and len(got) == len(want)


def votes_by_hand(spark, words):
    """Fingerprints by a plain count of votes, from the hashes of the words."""
    hashed = spark.createDataFrame([(w,) for w in sorted(set(words))], "w string").select("w", *(F.xxhash64("w", F.lit(p)).alias(f"h{p}") for p in range(simhash.BITS // 64))).collect()
    return {r.w: "".join(f"{r[f'h{p}'] % (1 << 64):064b}" for p in range(simhash.BITS // 64)) for r in hashed}


def test_fingerprints_by_a_second_count(spark, sf_dir):
    rows = simhash.op6_simhash(spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    order = sorted(texts)
    bits = votes_by_hand(spark, [w for t in texts.values() for w in words(t)] + [w for t in edits(texts, order).values() for w in words(t)])

    def fingerprint(text):
        votes = np.zeros(simhash.BITS, np.int64)
        for w, n in collections.Counter(words(text)).items():
            weight = min(max(len(w) - 2, 1), 8) ** 2
            votes += n * weight * (2 * np.frombuffer(bits[w].encode(), np.uint8).astype(np.int64) - 97)
        return f"{int(''.join('1' if v > 0 else '0' for v in votes), 2):032x}"

    far = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    prints = {i: fingerprint(t) for i, t in texts.items()}
    edited = {i: fingerprint(t) for i, t in edits(texts, order).items()}
    assert len(rows) == len(texts)
    for r in rows:
        i, after = r.doc_id, order[(order.index(r.doc_id) + 1) % len(order)]
        assert (r.fingerprint, r.edited_fingerprint) == (prints[i], edited[i])
        assert r.near_edited == 1 - far(prints[i], edited[i]) / 128 and r.near_next == 1 - far(prints[i], prints[after]) / 128
        near = [j for j in order if far(prints[i], prints[j]) <= simhash.RADIUS]
        assert (r.n_near, r.near_least) == ((len(near) - 1, min(near)) if i % 20 == 0 else (None, None))


def edits(texts, order):
    out = {}
    for k, i in enumerate(order):
        t, n = texts[i], texts[order[(k + 1) % len(order)]]
        out[i] = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
    return out


# --- mixing ---


def test_mixing(docs, empty, texts):
    out, _ = mixing.mix_sources(docs)
    rows = out.collect()
    assert len(rows) == len(texts) and collections.Counter((r.doc_id, r.size) for r in rows) == collections.Counter((i, len(words(t))) for i, t in texts)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    taken, goal, size = collections.Counter(), {}, {}
    for r in rows:
        taken[r.source] += r.taken
        goal[r.source], size[r.source] = r.target, r.source_size
    assert all(abs(taken[s] - goal[s]) <= max(0.02 * goal[s], 3) for s in goal) and sum(goal.values()) == pytest.approx(sum(size.values()))
    again, _ = mixing.mix_sources(docs.repartition(5))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    assert mixing.mix_sources(empty)[0].count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = collections.Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
    want = collections.Counter()
    for r in rows:
        want[r.doc_id] += r.taken
    assert +got == +want


def test_targets():
    assert mixing.targets([("a", 100), ("b", 100), (None, 100)]) == {"a": 187.5, "b": 75.0, None: 37.5}
    t = mixing.targets([("a", 1), ("b", 100), ("c", 100)])
    assert t["a"] == 3 and t["b"] == pytest.approx(132) and t["c"] == pytest.approx(66)
    assert mixing.targets([("a", 0), ("b", 0)]) == {"a": 0.0, "b": 0.0} and mixing.targets([]) == {}


def test_shards_draw_by_themselves(monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 64)
    slots = np.array([5000, 10, 0, 777])
    whole = list(mixing.shard_counts(slots, 0, 10_000))
    counts = np.array([n for _, n in whole])
    assert (counts.sum(axis=0) == slots).all() and (counts.sum(axis=1)[:-1] == 64).all() and (counts >= 0).all()
    assert (np.array([f for f, _ in whole]) == np.cumsum(counts, axis=0) - counts).all()
    parts = [x for a in range(0, 100, 7) for x in mixing.shard_counts(slots, a, a + 7)]
    assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(whole, parts, strict=True)) and len(parts) == len(whole)
    assert not list(mixing.shard_counts([0, 0], 0, 5)) and not list(mixing.shard_counts([], 0, 5))
    monkeypatch.setattr(mixing, "DRAWN", 1000)  # the halves above are in proportion
    assert (sum(n for _, n in mixing.shard_counts(slots, 0, 10_000)) == slots).all()


def test_mix_by_brute_force(spark, sf_dir, monkeypatch):
    """Every slot walked on its own: draws, passes and blocks give `taken`."""
    monkeypatch.setattr(mixing, "SHARD", 128)
    monkeypatch.setattr(mixing, "LOT", 16)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in mixing.mix_sources(docs)[0].collect()}
    sizes = collections.Counter()
    for r in got.values():
        sizes[r.source] += r.size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = mixing.targets(list(sizes.items()))
    plan = mixing.quotas(goal, {s: sizes[s] for s in order})
    wanted = [(i, slot // plan[s][1], slot % plan[s][1], plan[s][1]) for i, s in enumerate(order) for slot in range(plan[s][2])]
    drawn = sum(n for _, n in mixing.shard_counts([plan[s][2] for s in order], 0, 1 << 30))
    assert drawn.tolist() == [plan[s][2] for s in order]
    frame = spark.createDataFrame(wanted, "i int, turn long, k long, n long")
    blocks = frame.select("i", "turn", "n", mixing.permuted(F.col("k"), F.col("n"), F.xxhash64(F.lit(mixing.SEED), "i", "turn")).alias("block")).collect()
    times = collections.Counter((r.i, r.block) for r in blocks)
    for i, s in enumerate(order):  # a pass has each block once
        full = [r.block for r in blocks if r.i == i and r.turn == 0]
        assert len(set(full)) == len(full) and max(full) < plan[s][1]
    counts = collections.Counter(s for s in (r.source for r in got.values()))
    lots = {s: max(1, -(-n // 16)) for s, n in counts.items()}
    keyed = docs.select("doc_id", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print")).withColumn("h", F.xxhash64("doc_id", "print", F.lit(mixing.SEED))).collect()
    for i, s in enumerate(order):
        stream = sorted((r.h % lots[s], r.doc_id, r.print) for r in keyed if r.source == s)
        at, words = 0, plan[s][0]
        for _, doc_id, _ in stream:
            n = got[doc_id].size
            assert got[doc_id].taken == sum(times[i, (at + w) // words] for w in range(n)) <= 3 * n
            assert got[doc_id].source_size == sizes[s] and got[doc_id].target == pytest.approx(goal[s])
            at += n


def test_permutations(spark):
    for n in (1, 2, 3, 7, 13, 31, 64, 1000, 1025):
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long"))).collect()]
        assert sorted(got) == list(range(n)) and (n < 7 or got != list(range(n)))
