"""Results that must be exact whatever the words, and groups that must stay small whatever the copies."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidewright.llm import components, frequent, ngram_join, substring, textnp

SCHEMA = "doc_id long, text string"


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


A = thue_morse(1024)
B = A.translate(str.maketrans("ab", "ba"))


def test_words_of_two_letters_have_hashes_of_their_own():
    rng = random.Random(3)
    words = {A, B, A[:512], B[:512]} | {"".join(rng.choice("ab") for _ in range(n)) for n in range(1, 300)} | {"a" * n for n in range(1, 100)}
    text = " ".join(sorted(words)).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    starts, ends, _ = textnp.word_bounds(data, offsets)
    assert len(set(textnp.word_hashes(data, starts, ends).tolist())) == len(words)
    moved = np.frombuffer(b"  xyz " + text, np.uint8)
    starts, ends, _ = textnp.word_bounds(moved, np.array([0, len(moved)]))
    assert set(textnp.word_hashes(moved, starts[1:], ends[1:]).tolist()) == set(textnp.word_hashes(data, *textnp.word_bounds(data, offsets)[:2]).tolist())


@pytest.mark.parametrize("size", [1, 2, 3, 5, 20])
def test_windows_tell_orders_apart(size):
    rng = np.random.default_rng(size)
    runs = rng.integers(0, 3, 4000).astype(np.uint64)
    got = textnp.windows(textnp.mix(runs), size)
    want = [tuple(runs[i : i + size].tolist()) for i in range(len(runs) - size + 1)]
    assert len(set(zip(got.tolist(), want, strict=True))) == len(set(got.tolist())) == len(set(want))
    assert len(textnp.windows(runs[: size - 1], size)) == 0


def test_equal_ranges():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    a, b = rng.integers(0, 500, 3000), rng.integers(0, 500, 3000)
    n = rng.integers(1, 40, 3000)
    n[:50], b[:50] = 90, a[:50]
    got = textnp.same_bytes(data, a, b, n, step=64)
    assert got.tolist() == [bytes(data[x : x + k]) == bytes(data[y : y + k]) for x, y, k in zip(a, b, n, strict=True)]


def test_windows_of_one_hash_are_compared():
    data = np.frombuffer(b"aabbaabbcc", np.uint8)
    begin, size = np.array([0, 2, 4, 6, 8, 0]), np.full(6, 2)
    order, lead = substring._leads(data, np.array([1, 1, 1, 1, 1, 9], np.uint64), begin, size)
    words = [bytes(data[b : b + 2]) for b in begin]
    assert [words[i] for i in order] == [b"aa", b"aa", b"bb", b"bb", b"cc", b"aa"] and lead.tolist() == [0, 0, 2, 2, 4, 5] and order.tolist() == [0, 2, 1, 3, 4, 5]


def test_complementary_words(spark):
    tail = [f"w{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, " ".join([A, *tail])), (2, " ".join([B, *tail[:19]])), (3, " ".join([A, *tail[:19]]))], SCHEMA)
    got = {r.doc_id: r.n_removed for r in substring.without_repeats(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 20}
    docs = spark.createDataFrame([(3, f"x y {A} z"), (4, f"x y {B} z"), (5, f"X y {A} z")], SCHEMA)
    assert {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs).collect()} == {3: 3, 4: 4, 5: 3}


def long_word_texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(500, 3000))) for _ in range(12)]
    words += [w.translate(str.maketrans("ab", "ba")) for w in words] + [A, B]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(40)]


def test_long_words_by_brute_force(spark):
    rows = long_word_texts() + [(100, "a b c"), (101, None)]
    seen, want = set(), {}
    for i, text in rows:
        words, gone = (text or "").split(), set()
        for p in range(len(words) - 2):
            if tuple(words[p : p + 3]) in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(tuple(words[p : p + 3]))
        want[i] = len(gone)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert {r.doc_id: r.n_removed for r in substring.without_repeats(docs, size=3, minimiser=2).collect()} == want


def test_frequent_hashes(spark):
    rows = spark.range(0, 3000, 1, 4).selectExpr("id", "concat('all of them ', id, ' ', id % 3) AS text")
    found = frequent.frequent(rows.select("text"), lambda texts: substring.runs_of(texts, 1), least=900)
    words = np.frombuffer(b"all of them 0 1 2 17", np.uint8)
    hashes = textnp.word_hashes(words, *textnp.word_bounds(words, np.array([0, len(words)]))[:2])
    assert found.number(hashes).tolist() == [3000, 3000, 3000, 1001, 1001, 1001, 0]
    nothing = frequent.frequent(rows.select("text").limit(0), lambda texts: substring.runs_of(texts, 1))
    assert nothing.number(hashes).tolist() == [0] * 7


def test_a_common_phrase_makes_no_group(monkeypatch):
    """A run of words in every text is no minimiser and is dealt by no shingle: the largest group holds a small part."""
    rng = random.Random(1)
    texts = [" ".join([f"a{rng.random()}" for _ in range(30)] + ["in", "every", "one", "here"] + [f"b{rng.random()}" for _ in range(30)]) for _ in range(400)]
    column = pa.array(texts)
    every, n = np.unique(np.concatenate(list(substring.runs_of(column))), return_counts=True)
    common = frequent.Frequent(every[n > 100], n[n > 100])
    largest = {}
    for name, table in (("with", common), ("without", frequent.Frequent(every[:0], n[:0]))):
        sender = substring._Sender(10_000, 20, 3, table)
        sender.add(list(range(400)), [0] * 400, column)
        largest[name] = max(np.bincount(sender.bucket))
    assert largest["with"] <= 6
    sets = list(ngram_join.shingle_sets(column, 4))
    every, n = np.unique(np.concatenate(sets), return_counts=True)
    common = frequent.Frequent(every[n > 100], n[n > 100])
    sent = [r for b in ngram_join._send(4, 1000, common)([pa.record_batch([column], ["text"])]) for r in b.to_pylist()]
    by_shingle = [len(r["shingles"]) // 8 for r in sent if r["kind"] == ngram_join.BY_SHINGLE]
    by_set = sum(len(r["shingles"]) // 8 for r in sent if r["kind"] == ngram_join.BY_SET)
    assert by_set == 400 * int((n > 100).sum()) == 400 and max(by_shingle) < 100


def test_common_shingles_keep_links(spark, monkeypatch):
    """With every shared shingle taken for frequent, the components stay those of brute force."""
    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(40)] for _ in range(6)]
    rows = []
    for i in range(60):
        words = list(base[i % 6])
        for _ in range(i % 3):
            words[rng.randrange(40)] = f"x{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    plain = {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs).collect()}
    monkeypatch.setattr(ngram_join, "frequent", lambda rows, of: frequent.frequent(rows, of, least=2))
    assert {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs).collect()} == plain
    shingles = {i: {tuple(t.split()[k : k + 4]) for k in range(37)} for i, t in rows}
    near = {i: [j for j in shingles if 100 * len(shingles[i] & shingles[j]) >= 85 * len(shingles[i] | shingles[j])] for i in shingles}
    want = {}
    for i in shingles:
        todo, met = [i], {i}
        while todo:
            new = [j for j in near[todo.pop()] if j not in met]
            met.update(new)
            todo += new
        want[i] = min(met)
    assert plain == want


def test_stars():
    rng = np.random.default_rng(2)
    u, v = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    node, root = components.stars(u, v)
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert dict(zip(node.tolist(), root.tolist(), strict=True)) == {x: find(x) for x in range(300) if find(x) != x}
