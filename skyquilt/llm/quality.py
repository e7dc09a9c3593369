"""Quality rules under weak supervision: rules vote or abstain, expectation-maximisation weighs them. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, written

GOOD, NONE, BAD = 1, 0, -1
#: What expectation-maximisation starts from and is drawn to: the share of good rows, and how often a rule votes bad, abstains
#: and votes good on bad and on good rows. The draw is worth DRAW of the rows.
PRIOR, START, DRAW, TURNS = 0.85, {BAD: {BAD: 0.30, NONE: 0.10, GOOD: 0.60}, GOOD: {BAD: 0.001, NONE: 0.099, GOOD: 0.90}}, 0.02, 50
LEAST_POSTERIOR = 0.5

#: name: (condition for a bad vote, condition for a good vote), in SQL over the features.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("n_symbols > 0.10 * n_words", "n_symbols <= 0.03 * n_words"),
    "markup": ("n_symbols > 0.020 * word_chars", "n_symbols <= 0.010 * word_chars"),
    "capitals": ("n_upper > 0.40 * n_letters", "n_upper <= 0.20 * n_letters"),
    "letters": ("n_letters < 0.60 * word_chars", "n_letters >= 0.80 * word_chars"),
    "repeats": ("n_repeat_words > 0.30 * n_words", "n_repeat_words <= 0.15 * n_words"),
    "lines": ("n_dup_lines > 0.30 * n_lines", "n_lines > 1 and n_dup_lines <= 0.15 * n_lines"),
    "variety": ("n_distinct < 2.0 * sqrt(n_words)", "n_distinct >= 3.0 * sqrt(n_words)"),
    "sentences": ("n_ends * 60 < n_words or n_shouts > 0.30 * n_words", "n_ends * 40 >= n_words and n_shouts <= 0.05 * n_words"),
    "word_length": ("word_chars < 2.0 * n_words or word_chars > 12.0 * n_words", "word_chars between 3.0 * n_words and 9.0 * n_words"),
}


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and counts of every whole text; null counts as empty.

    A 3-word window is known by a 64-bit hash, so two of the windows of one text are taken for equal by mistake with a
    chance of (windows / 2^32)^2 / 2.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    df = df.select("doc_id", "t", F.array_remove(F.split("t", f"[{SPACE}]+"), "").alias("words"), F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    df = df.withColumn("joined", F.array_join("words", ""))
    df = df.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"), F.char_length("joined").cast("long").alias("word_chars"),
        (F.char_length("joined") - F.char_length(F.regexp_replace("joined", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.char_length(F.regexp_replace("joined", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.char_length(F.regexp_replace("joined", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size(F.filter("words", lambda w: w.endswith(".") | w.endswith("!") | w.endswith("?"))).cast("long").alias("n_ends"),
        F.size(F.filter("words", lambda w: w.endswith("!!"))).cast("long").alias("n_shouts"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    ).drop("words")
    last = F.col("n_words").cast("int") - 3
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2)))
    df = df.withColumn("runs", F.when(last >= 1, runs)).drop("hashes")
    # most texts repeat no window; only the others are sorted
    pairs = F.array_sort(F.transform("runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("order", F.when(F.size(F.array_distinct("runs")) < F.size("runs"), pairs)).drop("runs")
    again = F.filter("order", lambda x, j: F.coalesce(F.get("order", j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("order", j + 1)["h"] == x["h"], F.lit(False)))
    places = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return df.withColumn("n_repeat_words", F.coalesce(F.size(places), F.lit(0)).cast("long")).withColumn("n_repeat_words", F.greatest("n_repeat_words", F.lit(0))).drop("order")


def votes(rows: DataFrame, rules: Mapping[str, tuple[str, str]] = RULES) -> DataFrame:
    """rows with `votes`, a letter for each rule: b bad, g good, - abstains; rows without words have abstentions only."""
    each = [F.when((F.col("n_words") == 0), "-").when(F.expr(bad), "b").when(F.expr(good), "g").otherwise("-") for bad, good in rules.values()]
    return rows.withColumn("votes", F.concat(*each))


def expectation_maximisation(counts: Mapping[str, int]) -> tuple[dict[str, float], float, list[dict[int, dict[int, float]]]]:
    """(posterior of good by pattern of votes, share of good rows, chances of each vote by rule and class), from rows by pattern.

    counts has at most 3 ** rules patterns, however many rows there are. Rules are independent given the class.
    """
    value = {"b": BAD, "-": NONE, "g": GOOD}
    total = sum(counts.values())
    share = PRIOR
    width = max(map(len, counts), default=0)
    chance = [{c: dict(START[c]) for c in START} for _ in range(width)]
    post: dict[str, float] = {}
    for _ in range(TURNS):
        for pattern in counts:
            odds = math.log(share / (1 - share)) + sum(math.log(p[GOOD][value[v]] / p[BAD][value[v]]) for p, v in zip(chance, pattern, strict=True))
            post[pattern] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        draw = DRAW * total
        share = (sum(n * post[p] for p, n in counts.items()) + PRIOR * draw) / (total + draw) if total else PRIOR
        for r in range(width):
            for c in (GOOD, BAD):
                weight = {v: START[c][v] * draw * (PRIOR if c == GOOD else 1 - PRIOR) for v in value.values()}
                for p, n in counts.items():
                    weight[value[p[r]]] += n * (post[p] if c == GOOD else 1 - post[p])
                whole = sum(weight.values())
                chance[r][c] = {v: max(1e-6, w / whole) for v, w in weight.items()}
    return post, share, chance


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Mapping[str, tuple[str, str]] = RULES) -> DataFrame:
    """One row per row of docs: the features, base_failed, votes, posterior, kept.

    base_failed: under 50 words, or more than half of the words in 3-word windows that occur twice or more. kept: not
    base_failed and a posterior of LEAST_POSTERIOR or more. Null and empty texts fail; repeated rows are judged each; extra
    columns are ignored; an empty table gives an empty result. Accuracies are estimated over the rows that pass the base. The features are written once in the shared folder, since
    the rows by pattern of votes are counted before any row is judged.
    """
    rows = votes(features(docs, id_col, text_col), rules).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    rows = written(rows, "features")
    counts = {r["votes"]: r["n"] for r in rows.groupBy("votes").agg(F.count_if(~F.col("base_failed")).alias("n")).collect()}  # 3 ** rules at most
    post, _, _ = expectation_maximisation(counts)
    spark = docs.sparkSession
    table = spark.createDataFrame(sorted(post.items()), "votes string, posterior double")
    return rows.join(F.broadcast(table), "votes", "left").withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= LEAST_POSTERIOR))
