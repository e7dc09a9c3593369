"""Temperature mixing of sources, realised as budgeted block permutations."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, written

#: Rows aimed at in a block of a source.
BLOCK_ROWS = 16_384


def weights_at(tokens: Mapping[str | None, int], exponent: float) -> dict[str | None, float]:
    """Source shares raised to the exponent, normalised. Sources without tokens get nothing."""
    total = sum(tokens.values())
    raw = {k: (v / total) ** exponent if v else 0.0 for k, v in tokens.items()} if total else dict.fromkeys(tokens, 0.0)
    whole = sum(raw.values())
    return {k: v / whole if whole else 0.0 for k, v in raw.items()}


def entropy(weights: Mapping[str | None, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def repeats(tokens: Mapping[str | None, int], weights: Mapping[str | None, float], budget: float) -> float:
    """The most passes that a source makes over its tokens."""
    return max((weights[k] * budget / v for k, v in tokens.items() if v), default=0.0)


def keep_all_budget(tokens: Mapping[str | None, int], weights: Mapping[str | None, float]) -> float:
    """The smallest budget at which every source is passed over at least once."""
    return max((v / weights[k] for k, v in tokens.items() if v), default=0.0)


def solve_exponent(tokens: Mapping[str | None, int], target_entropy: float | None = None, max_repeats: float | None = None, budget: float | None = None, turns: int = 60) -> float:
    """The smallest exponent in [0, 1] (the flattest mix) that keeps to the repetition limit, or whose entropy is the target's at most.

    Entropy and repeats both fall as the exponent rises to 1, so bisection finds the place. budget None: keep_all_budget.
    """

    def fine(a: float) -> bool:
        w = weights_at(tokens, a)
        if target_entropy is not None and entropy(w) > target_entropy:
            return False
        return max_repeats is None or repeats(tokens, w, keep_all_budget(tokens, w) if budget is None else budget) <= max_repeats * (1 + 1e-12)

    low, high = 0.0, 1.0
    if fine(low):
        return low
    for _ in range(turns):
        mid = (low + high) / 2
        low, high = (low, mid) if fine(mid) else (mid, high)
    return high


def turn(seed: int, block: Column, number: Column) -> Column:
    """By which the blocks of a source are permuted in a pass."""
    return F.xxhash64(F.lit(seed), block, number)


def rank(key: Column, number: Column) -> Column:
    """By which the rows of a block are permuted in a pass."""
    return F.xxhash64(key, number)


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = 2.0, budget: float | None = None, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs with mix_tokens, mix_weight, mix_budget (tokens for the row's source), mix_copies (times the row is taken), and mix_block
    and mix_key, from which realised() derives the order of each pass.

    Each pass over a source takes its blocks in an order permuted by pass, and the rows of a block in a permuted order.
    The budget allows whole passes and a part of one, which ends in the first row that reaches it. With budget None
    the total is the least at which every source is passed over once, so no row is lost and small sources repeat, up to
    max_repeats. Tokens are words. A null source is a source of its own; rows without tokens cost nothing and are taken once a
    whole pass, and once at least if their source has no tokens; a null id is an id; repeated rows (of one id and text) are
    taken equally often, so a budget that ends in one of them takes all of these and may be passed by their tokens;
    columns of docs named mix_* are replaced; an empty table gives an empty result. The number of sources must fit the driver.

    Sums run over (source, block) pairs and within the one block of each source where its budget ends.
    """
    docs = docs.drop("mix_tokens", "mix_weight", "mix_budget", "mix_copies", "mix_block", "mix_key")
    by = docs.select(F.col(source_col).alias("s"), n_words(text_col).alias("t"), F.xxhash64(F.lit(seed), F.col(id_col), F.crc32(F.coalesce(F.col(text_col), F.lit("")))).alias("h"))
    key = written(by, "mix")
    sums = {r["s"]: (r["t"], r["n"]) for r in key.groupBy("s").agg(F.sum("t").alias("t"), F.count(F.lit(1)).alias("n")).collect()}  # one row per source
    tokens = {k: int(t) for k, (t, _) in sums.items()}
    exponent = solve_exponent(tokens, target_entropy, max_repeats, budget)
    weights = weights_at(tokens, exponent)
    total = keep_all_budget(tokens, weights) if budget is None else budget
    rows = []
    for k, (t, n) in sums.items():
        want = int(round(weights[k] * total))
        whole = want // t if t else 1
        rows.append((k, weights[k], want, whole, want - whole * t if t else 0, max(1, -(-n // BLOCK_ROWS))))
    spark = docs.sparkSession
    plan = spark.createDataFrame(rows, "s string, weight double, want long, whole long, part long, blocks long").withColumn("s", F.col("s").cast(docs.schema[source_col].dataType))
    of = lambda d: d.join(F.broadcast(plan), d["s"].eqNullSafe(plan["s"])).drop(plan["s"]).withColumn("block", F.pmod(F.col("h"), F.col("blocks"))).withColumn("turn", turn(seed, F.col("block"), F.col("whole")))
    placed = of(key)
    # where in the last, partial pass each block begins
    order = Window.partitionBy("s").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    sized = placed.groupBy("s", "block", "turn", "part").agg(F.sum("t").alias("bt")).withColumn("begin", F.coalesce(F.sum("bt").over(order), F.lit(0)))
    ends = written(sized.where((F.col("begin") < F.col("part")) & (F.col("begin") + F.col("bt") >= F.col("part"))).select(F.col("s").alias("es"), F.col("block").alias("eb"), F.col("turn").alias("et"), "begin"), "ends")  # one row per source at most
    ends = F.broadcast(ends)
    # rows of the block where a budget ends: the cut between those taken once more and the rest
    last = of(key).join(ends, F.col("s").eqNullSafe(F.col("es")) & (F.col("block") == F.col("eb")))
    inner = Window.partitionBy("es", "block").orderBy("rank", "h").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("rank", rank(F.col("h"), F.col("whole"))).withColumn("upto", F.col("begin") + F.sum("t").over(inner))
    cut = last.where(F.col("upto") >= F.col("part")).groupBy(F.col("es").alias("cs")).agg(F.min(F.struct("rank", "h")).alias("cut"))
    bounds = written(ends.join(cut, F.col("es").eqNullSafe(F.col("cs")), "left").select("es", "eb", "et", "cut"), "cuts")
    h = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.crc32(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    new = {"_plan": plan.select(F.struct("s", "weight", "want", "whole", "part", "blocks").alias("_p")), "_cut": bounds.select(F.struct("es", "eb", "et", "cut").alias("_c"))}
    full = docs.join(F.broadcast(new["_plan"]), F.col(f"`{source_col}`").eqNullSafe(F.col("_p.s"))).join(F.broadcast(new["_cut"]), F.col(f"`{source_col}`").eqNullSafe(F.col("_c.es")), "left")
    block = F.pmod(h, F.col("_p.blocks"))
    at = turn(seed, block, F.col("_p.whole"))
    before = (at < F.col("_c.et")) | ((at == F.col("_c.et")) & (block < F.col("_c.eb")))
    inside = (block == F.col("_c.eb")) & (F.struct(rank(h, F.col("_p.whole")), h) <= F.col("_c.cut"))
    more = F.when((F.col("_p.part") > 0) & F.coalesce(before | inside, F.lit(False)), 1).otherwise(0)
    return full.withColumn("mix_tokens", n_words(text_col)).withColumn("mix_weight", F.col("_p.weight")).withColumn("mix_budget", F.col("_p.want")).withColumn("mix_copies", (F.col("_p.whole") + more).cast("long")).withColumn("mix_block", block).withColumn("mix_key", h).drop("_p", "_c")


def realised(mixed: DataFrame, seed: int = 17) -> DataFrame:
    """One row for each time a row of mix() is taken, with mix_pass from 0 and the order of the pass: mix_turn, mix_block, mix_rank, mix_key.

    That is the order in which mix() fills a budget, so the rows of a last, partial pass are the first of that pass. `seed` is
    that of mix(). A null id has a place as any other; repeated rows share theirs; columns named mix_pass, mix_turn and mix_rank
    are replaced; rows taken no times go; an empty table gives an empty result.
    """
    out = mixed.where("mix_copies > 0").withColumn("mix_pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_copies") - 1)))
    number = F.col("mix_pass")
    return out.withColumn("mix_turn", turn(seed, F.col("mix_block"), number)).withColumn("mix_rank", rank(F.col("mix_key"), number))
