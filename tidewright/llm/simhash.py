"""SimHash fingerprints and searches by Hamming radius. Native.

Each word votes with a weight on every bit, by a hash of the word; the sign of a
bit's votes is the bit. Words become rows, and the votes of two bits share one
long (32 bits each), so a document needs half as many sums as it has bits.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut

#: Bits of a fingerprint, a multiple of 64.
BITS = 128
#: Bits that near fingerprints differ in at most, and prints of a key that one row of a join holds.
RADIUS, TILE = 3, 256
#: Two bits at a time: the lowest bit of each half of a long.
_LANES = 0x0000000100000001


def word_weight(word: Column) -> Column:
    """Long words tell more of a text than short ones: the square of what a word has beyond 2 characters, 1 to 64."""
    extra = F.least(F.greatest(F.length(word) - 2, F.lit(1)), F.lit(8))
    return (extra * extra).cast("long")


def fingerprints(terms: DataFrame, keys: list[str], word_col: str = "word", bits: int = BITS) -> DataFrame:
    """`keys` and `fingerprint` (lower-case hex) from one row a word; null and empty words vote for nothing.

    A bit is set if the votes for it outweigh those against, so a text without words has all zeros.
    Half-sums hold weights up to 2**31, that is 33 million of the heaviest words in a document.
    """
    word, parts = F.col(word_col), bits // 64
    weight = F.when(F.length(word) > 0, word_weight(word)).otherwise(F.lit(0).cast("long"))
    hashed = terms.select(*keys, weight.alias("w"), *(F.xxhash64(word, F.lit(p)).alias(f"h{p}") for p in range(parts)))
    sums = hashed.groupBy(*keys).agg(F.sum("w").alias("w"), *(F.sum(F.shiftrightunsigned(f"h{p}", s).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"s{p}_{s}") for p in range(parts) for s in range(32)))
    low = lambda p, s: F.col(f"s{p}_{s}").bitwiseAND(F.lit(0xFFFFFFFF))
    high = lambda p, s: F.shiftrightunsigned(f"s{p}_{s}", 32)

    def half(p: int, votes) -> Column:
        out = F.lit(0).cast("long")
        for s in range(32):
            out = out + F.when(votes(p, s) * 2 > F.col("w"), F.lit(1 << s).cast("long")).otherwise(F.lit(0).cast("long"))
        return F.lpad(F.lower(F.hex(out)), 8, "0")

    return sums.select(*keys, F.concat(*(x for p in range(parts) for x in (half(p, high), half(p, low)))).alias("fingerprint"))


def hamming(a: Column, b: Column, bits: int = BITS) -> Column:
    """Bits in which two fingerprints differ."""
    part = lambda x, i: F.conv(F.substring(x, 8 * i + 1, 8), 16, 10).cast("long")
    out = F.lit(0)
    for i in range(bits // 32):
        out = out + F.bit_count(part(a, i).bitwiseXOR(part(b, i)))
    return out


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return F.lit(1.0) - hamming(a, b, bits) / F.lit(float(bits))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """`id_col` and fingerprint, one row for each distinct pair of id and text; null texts are empty ones."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    terms = docs.select(F.col(id_col), F.sha2(text, 256).alias("digest"), F.explode_outer(F.split(text, f"{SPACE}+")).alias("word"))
    return fingerprints(terms, [id_col, "digest"], "word", bits).drop("digest")


def _tables(bits: int, radius: int, keep: int) -> list[tuple[list[int], list[list[int]]]]:
    """Each choice of `keep` of radius + keep blocks of bits: its mask, a signed long for each 64 bits, and
    the masks of the blocks before its last that it leaves out."""
    blocks = radius + keep
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]

    def mask(chosen) -> list[int]:
        whole = "".join("1" if any(edges[i] <= b < edges[i + 1] for i in chosen) else "0" for b in range(bits))
        return [(x := int(whole[at : at + 64], 2)) - ((x >> 63) << 64) for at in range(0, bits, 64)]

    return [(mask(chosen), [mask([i]) for i in range(chosen[-1]) if i not in chosen]) for chosen in combinations(range(blocks), keep)]


def near_fingerprints(rows: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", print_col: str = "fingerprint", asks_col: str = "asks", bits: int = BITS, keep: int = 2, tile: int = TILE) -> DataFrame:
    """For each print that a row with `asks_col` has: print_col, n_near (rows whose prints are within `radius`
    bits, those of the print itself included) and near_least (the least id among them; null ids count as larger).

    Bits are cut into radius + keep blocks. Prints within the radius agree in
    `keep` blocks at least, so each choice of `keep` blocks is a permuted table
    whose key they share; a pair counts in the table of the first blocks it agrees
    in. Equal prints are one, with their number. The prints of a key meet as
    arrays: those that ask in tiles of about `tile`, the others likewise, so a
    crowded key is dealt to many tasks and no pair becomes a row. Null prints are left out.
    """
    parts = bits // 64
    words = [f"h{i}" for i in range(parts)]
    distinct = rows.where(F.col(print_col).isNotNull()).groupBy(F.col(print_col).alias("p")).agg(F.count("*").alias("n"), F.min(id_col).alias("least"), F.max(F.coalesce(F.col(asks_col), F.lit(False))).alias("asks"))
    distinct = distinct.select("p", "n", "least", "asks", *(F.conv(F.substring("p", 16 * i + 1, 16), 16, -10).cast("long").alias(w) for i, w in enumerate(words)))
    tables, long = _tables(bits, radius, keep), lambda x: F.lit(x).cast("long")
    keys = [F.struct(F.lit(t).alias("t"), *(F.col(w).bitwiseAND(long(m)).alias(f"k{i}") for i, (w, m) in enumerate(zip(words, mask, strict=True)))) for t, (mask, _) in enumerate(tables)]
    keyed = distinct.select(*words, "n", "least", "asks", F.explode(F.array(*keys)).alias("key"))
    crowds = keyed.groupBy("key").agg(F.count("*").alias("size"), F.max("asks").alias("asked")).where("asked AND size > 1").select("key", F.ceil(F.col("size") / tile).alias("tiles"))
    met = keyed.join(crowds, "key").withColumn("tile", F.pmod(F.xxhash64(*words), F.col("tiles")))
    others = met.groupBy("key", "tile").agg(F.collect_list(F.struct(*words, "n", "least")).alias("others")).drop("tile")
    asked = met.where("asks").groupBy("key", "tile").agg(F.collect_list(F.struct(*words)).alias("asked")).drop("tile")
    none = F.array().cast("array<array<bigint>>")
    out = [F.array(*(F.array(*map(long, m)) for m in masks)) if masks else none for _, masks in tables]
    apart = F.get(F.array(*out), F.col("key.t"))

    def near(a: Column, o: Column) -> Column:
        differ = [a[w].bitwiseXOR(o[w]) for w in words]
        far = sum((F.bit_count(d) for d in differ[1:]), F.bit_count(differ[0]))
        first = F.forall("apart", lambda m: sum(((d.bitwiseAND(m[i]) != 0).cast("int") for i, d in enumerate(differ)), F.lit(0)) > 0)
        return (far <= radius) & (far > 0) & first

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast(dict(rows.dtypes)[id_col]).alias("least"))
    tally = lambda a: F.aggregate(F.filter("others", lambda o: near(a, o)), start, lambda s, o: F.struct((s["n"] + o["n"]).alias("n"), F.least(s["least"], o["least"]).alias("least")))
    found = asked.join(others, "key").withColumn("apart", apart).select(F.explode(F.transform("asked", lambda a: F.struct(*(a[w].alias(w) for w in words), tally(a).alias("met")))).alias("x"))
    found = found.select(*(f"x.{w}" for w in words), "x.met.n", "x.met.least").where("n > 0").groupBy(*words).agg(F.sum("n").alias("more"), F.min("least").alias("other"))
    return distinct.where("asks").join(found, words, "left").select(F.col("p").alias(print_col), (F.col("n") + F.coalesce("more", F.lit(0).cast("long"))).alias("n_near"), F.least("least", "other").alias("near_least"))


def _boundaries(docs: DataFrame, n: int) -> list[int]:
    """Document ids that begin `n` groups at most of about as many rows each; n numbers on the driver."""
    cuts = docs.agg(F.percentile_approx("doc_id", F.lit([i / n for i in range(1, n)]), 20 * n)).first()[0] if n > 1 else None
    return sorted(set(cuts or ()))


def with_next(docs: DataFrame, groups: int) -> DataFrame:
    """Adds grp, nth, halo and next_text to (doc_id, text): the text of the next row by doc_id and text, the first after the last.

    Rows go to groups by ranges of doc_id (nulls first). Rows of the id that begins
    a group also go to the group before as its halo, so the texts are shuffled once
    and no task sorts all rows. Halo rows are in the result, and are no one's text.
    """
    least = docs.agg(F.min("doc_id"), F.count("*"), F.count("doc_id")).first()
    cuts = [c for c in _boundaries(docs, groups) if least[1] > least[2] or c > least[0]]
    start = least[0] if least[1] == least[2] else None
    span, steps = len(cuts), []
    while (1 << len(steps)) <= span:
        steps.insert(0, 1 << len(steps))
    grp, halo = F.lit(0), F.lit(False)
    if cuts:  # the number of cuts at or below the id, by halving
        probe = lambda a, s: F.when((a + s <= span) & (F.get(F.lit(cuts), a + s - 1) <= F.col("doc_id")), a + s).otherwise(a)
        grp = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.aggregate(F.lit(steps), F.lit(0), probe))
        halo = F.coalesce(F.col("doc_id").isin(cuts), F.lit(False))
    place = lambda g, turn: F.struct(g.cast("int").alias("grp"), F.lit(turn).alias("turn"))
    none = F.array().cast("array<struct<grp:int,turn:int>>")
    places = F.concat(
        F.array(place(F.col("grp"), 0)),
        F.when(F.col("halo"), F.array(place(F.col("grp") - 1, 1))).otherwise(none),
        F.when(F.col("doc_id").eqNullSafe(F.lit(start).cast("long")), F.array(place(F.lit(span), 2))).otherwise(none),
    )
    rows = docs.withColumn("grp", grp).withColumn("halo", halo).select("doc_id", "text", F.explode(places).alias("at")).select("doc_id", "text", "at.*")
    order = Window.partitionBy("grp").orderBy("turn", "doc_id", "text")
    return rows.select("grp", F.row_number().over(order).alias("nth"), (F.col("turn") > 0).alias("halo"), "doc_id", "text", F.lead("text").over(order).alias("next_text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, groups: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is the next row's beginning.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. Null texts are empty; rows of one id go by text; a lone row is its
    own next; an empty table gives an empty one.
    """
    groups = groups or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), groups)
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - F.col("half")).cast("int")), F.substring(F.coalesce(F.col("next_text"), F.lit("")), F.lit(1), F.col("half")))
    rows = rows.withColumn("edited", F.when(~F.col("halo"), edited)).withColumn("digest", F.unhex(F.sha2("edited", 256)))
    both = F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("t")), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("t")))
    keys = ["grp", "nth", "doc_id", "n_chars", "digest", "is_edited"]
    texts = rows.select("grp", "nth", "doc_id", "n_chars", "digest", F.explode(both).alias("x")).select("grp", "nth", "doc_id", "n_chars", "digest", "x.*").where("t IS NOT NULL")
    prints = fingerprints(texts.select(*keys, F.explode_outer(F.split("t", f"{SPACE}+")).alias("word")), keys, "word", bits)
    pick = lambda edited: F.max(F.when(F.col("is_edited") == edited, F.col("fingerprint")))
    wide = prints.groupBy("grp", "nth", "doc_id", "n_chars").agg(F.max("digest").alias("digest"), pick(False).alias("fingerprint"), pick(True).alias("edited_fingerprint"))
    wide = wide.withColumn("next", F.lead("fingerprint").over(Window.partitionBy("grp").orderBy("nth"))).where("digest IS NOT NULL")
    return wide.select(
        F.col("doc_id").alias(id_col), "n_chars", F.lower(F.hex("digest")).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), bits).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next"), bits).alias("near_next"),
    )


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every row of `documents`, and, for rows whose id is divisible by 20, of all documents how
    many others are within RADIUS bits (n_near) and the least id of those and itself (near_least); else these are null.

    Null texts are empty ones, rows of one id go by text, an empty table gives no rows.
    """
    from .common import table

    rows = cut(edited_fingerprints(table(spark, sf_dir, "documents")))
    asks = F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))
    near = near_fingerprints(rows.select("doc_id", "fingerprint", asks.alias("asks")))
    found = rows.where(asks).join(near, "fingerprint").withColumn("n_near", F.col("n_near") - 1)
    none = F.lit(None).cast("long")
    return found.unionByName(rows.where(~asks).withColumns({"n_near": none, "near_least": none}))
