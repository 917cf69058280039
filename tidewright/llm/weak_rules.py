"""Quality rules by weak supervision: rules vote or abstain, EM weighs them. Native.

Each rule says good (1), bad (-1) or nothing (0) of a text. Expectation
maximisation over the counts of vote patterns of all documents estimates how
often each rule says what of good and of bad texts; a text's posterior
probability of being good then takes the place of "all rules must pass".

The driver holds the counts of 3**rules patterns at most, whatever the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, table

#: Each rule: (name, bad if, good if) over the columns of measured(); between the two it abstains.
#: Several rules look at each kind of fault from different sides, so that agreement can tell their accuracy.
RULES = (
    ("symbols", "n_symbols > 0.05 * word_chars", "n_symbols <= 0.01 * word_chars"),
    ("symbol_runs", "n_symbol_runs > 0.05 * n_words", "n_symbol_runs <= 0.01 * n_words"),
    ("shouting", "n_upper > 0.40 * word_chars OR n_bangs > 0.10 * n_words", "n_upper <= 0.15 * word_chars AND n_bangs <= 0.02 * n_words"),
    ("repeated_lines", "n_dup_lines >= 3 AND n_dup_lines > 0.30 * n_lines", "n_dup_lines <= 0.05 * n_lines"),
    ("repeated_words", "n_repeat_words > 0.30 * n_words", "n_repeat_words <= 0.10 * n_words"),
    ("word_length", "word_chars < 2.5 * n_words OR word_chars > 12 * n_words", "word_chars BETWEEN 3.5 * n_words AND 7 * n_words"),
    ("sentences", "n_words >= 100 AND n_stops < 0.004 * n_words", "n_stops BETWEEN 0.02 * n_words AND 0.30 * n_words"),
    ("length", "n_words < 50", "n_words >= 100"),
)
#: Weight of the prior of each chance (a bad vote is as likely as a good one) and of each class, as a share of all documents.
SMOOTH, ROUNDS = 0.002, 200


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts that rules read, one row for each row of `docs`; a null text has none.

    n_words, word_chars, n_symbols, n_symbol_runs, n_lines, n_dup_lines, n_repeat_words, n_upper,
    n_bangs, n_stops. Words in 3-word windows that occur again: windows are sorted
    by part of a hash in one long with their place; those that meet there are
    compared as strings, so the count is exact.
    """
    count = lambda keep: F.length(F.regexp_replace("text", f"[^{keep}]+", "")).cast("long")
    step = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    step = step.select(
        "doc_id",
        count("#*$%&|<>").alias("n_symbols"), count("A-ZÀ-ÖØ-Þ").alias("n_upper"), count("!").alias("n_bangs"), count(".?").alias("n_stops"),
        F.regexp_count("text", F.lit("[#*$%&|<>]+")).cast("long").alias("n_symbol_runs"),
        F.length(F.regexp_replace("text", f"{SPACE}+", "")).cast("long").alias("word_chars"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "").alias("words"),
    )
    step = step.select("*", F.size("words").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"), F.when(F.size("words") < 1 << 21, F.lit((1 << 21) - 1)).otherwise(F.lit((1 << 31) - 1)).cast("long").alias("low")).drop("lines")
    three = F.transform(F.slice("hashes", 1, F.greatest(F.size("hashes") - 2, F.lit(0))), lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)).bitwiseAND(F.bitwise_not("low")).bitwiseOR(i.cast("long")))
    step = step.withColumn("sorted", F.sort_array(three)).drop("hashes")
    same = lambda k, j: k.bitwiseAND(F.bitwise_not("low")) == F.get("sorted", j).bitwiseAND(F.bitwise_not("low"))
    step = step.withColumn("met", F.filter("sorted", lambda k, i: same(k, i - 1) | same(k, i + 1))).drop("sorted")
    at = lambda k: k.bitwiseAND(F.col("low")).cast("int")
    step = step.withColumn("named", F.when(F.size("met") > 0, F.array_sort(F.transform("met", lambda k: F.struct(F.concat_ws(" ", F.get("words", at(k)), F.get("words", at(k) + 1), F.get("words", at(k) + 2)).alias("t"), at(k).alias("p")))))).drop("met", "words", "low")
    neighbour = lambda j: F.get("named", j)["t"]
    step = step.withColumn("again", F.when(F.size("named") > 0, F.sort_array(F.transform(F.filter("named", lambda x, i: (x["t"] == neighbour(i - 1)) | (x["t"] == neighbour(i + 1))), lambda x: x["p"])))).drop("named")
    covered = F.aggregate("again", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")), lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("again")


def votes(rules=RULES) -> dict[str, Column]:
    return {f"vote_{name}": F.when(F.expr(bad), F.lit(-1)).when(F.expr(good), F.lit(1)).otherwise(F.lit(0)) for name, bad, good in rules}


def majority(pattern: tuple[int, ...]) -> float:
    """What EM starts from: the share of good votes, with one more vote on either side."""
    good, bad = sum(v > 0 for v in pattern), sum(v < 0 for v in pattern)
    return (1 + good) / (2 + good + bad)


def posterior(pattern: tuple[int, ...], prior: float, chances: list[tuple]) -> float:
    """The probability that a text with these votes is good. A rule that abstains is missing evidence, not evidence."""
    log = math.log(prior / (1 - prior)) + sum(math.log(good[v > 0] / bad[v > 0]) for v, (good, bad) in zip(pattern, chances, strict=True) if v)
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, log))))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: int) -> tuple[float, list[tuple]]:
    """EM over (pattern of votes, number of documents): the share of good texts, and for each
    rule its chances of a bad and of a good vote, if it votes, on good and on bad texts. No documents: even chances.

    It starts from each pattern's majority; of the two classes the one that more good votes speak for is the good one.
    """
    total = sum(n for _, n in patterns)
    if not total:
        return 0.5, [((0.5, 0.5), (0.5, 0.5))] * rules
    now, w = [majority(p) for p, _ in patterns], SMOOTH * total
    for _ in range(ROUNDS):
        sides = []
        for share in (now, [1 - x for x in now]):
            sums = [[w / 2, w / 2] for _ in range(rules)]
            for (pattern, n), x in zip(patterns, share, strict=True):
                for j, v in enumerate(pattern):
                    if v:
                        sums[j][v > 0] += n * x
            sides.append((w + sum(n * x for (_, n), x in zip(patterns, share, strict=True)), [(b / (b + g), g / (b + g)) for b, g in sums]))
        prior, chances = sides[0][0] / (sides[0][0] + sides[1][0]), list(zip(sides[0][1], sides[1][1], strict=True))
        before, now = now, [posterior(p, prior, chances) for p, _ in patterns]
        if max(abs(x - y) for x, y in zip(before, now, strict=True)) < 1e-9:
            break
    if sum(math.log(good[1] / bad[1]) for good, bad in chances) < 0:
        prior, chances = 1 - prior, [(bad, good) for good, bad in chances]
    return prior, chances


def weak_supervision(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, threshold: float = 0.5) -> DataFrame:
    """Counts, votes, the posterior probability of a good text and the verdict for each row.

    base_failed: fewer than 50 words, or more than half of them in repeated 3-word
    windows. EM counts the patterns of all documents that pass the base. kept: not
    base_failed, and the posterior reaches `threshold`. Rows are judged one by one, so equal texts get equal verdicts and repeated rows stay;
    null or empty texts fail the base; an empty table gives an empty one.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = cut(measured(docs, id_col, text_col).withColumns(votes(rules)).withColumn("base_failed", base))
    names = [f"vote_{name}" for name, _, _ in rules]
    counted = rows.where("NOT base_failed").groupBy(*names).count().collect()
    prior, chances = estimate([(tuple(r[:-1]), r[-1]) for r in sorted(counted)], len(rules))
    odds = F.lit(math.log(prior / (1 - prior)))
    for name, (good, bad) in zip(names, chances, strict=True):
        step = [math.log(g / b) for g, b in zip(good, bad, strict=True)]
        odds = odds + F.when(F.col(name) < 0, F.lit(step[0])).when(F.col(name) > 0, F.lit(step[1])).otherwise(F.lit(0.0))
    rows = rows.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)).withColumnRenamed("doc_id", id_col)


def op3_weak_rules(spark, sf_dir: str) -> DataFrame:
    """The base counts, verdicts and posterior of every row of `documents`; null and empty texts fail the base, repeated rows are judged alike, an empty table gives no rows."""
    return weak_supervision(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
