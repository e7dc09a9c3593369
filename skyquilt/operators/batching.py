"""Batches of sources that share files, planned from set sizes.

Packing is sequential over the sets in order of size. Sizes are whole numbers, so the sets form runs of equal size, and within a
run the greedy rule is periodic after its first batch. The driver walks over the runs, of which there are at most as
many as sizes below the limit, and every set finds its batch by arithmetic from its rank within its run.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Values of the order column in a stripe; ranks are counted in stripes, so no task sorts a whole group.
STRIPE = 1_000_000


def ranked(df: DataFrame, group: list[str], order: str, name: str = "rank", stripe: int = STRIPE) -> DataFrame:
    """df with the row's place from 0 within its group by `order`, a whole number that is distinct within the group."""
    df = df.withColumn("_stripe", F.floor(F.col(order) / stripe).cast("long"))
    sizes = df.groupBy(*group, "_stripe").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_stripe").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_stripe", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = df.withColumn("_k", F.row_number().over(Window.partitionBy(*group, "_stripe").orderBy(order)))
    return own.join(starts, [*group, "_stripe"]).withColumn(name, F.col("_start") + F.col("_k") - 1).drop("_stripe", "_start", "_k")


def plan_runs(runs: Iterable[tuple[int, int]], most: int, least: int = 500, most_sets: int = 50) -> list[dict]:
    """For runs (size, number of sets) by falling size, all at most `most`: the batches of each run's sets by rank.

    The first `head` sets join batch `open`; the others form batches of `period` sets, from batch `start` on. A batch
    closes once it has `least` sources, or when the next set would bring it over `most` sources or `most_sets` sets.
    """
    out, batch, total, sets = [], 0, 0, 0
    for size, count in runs:
        entry = {"size": size, "head": 0, "open": batch}
        if sets:
            fit, need = min((most - total) // size, most_sets - sets), -(-(least - total) // size)
            entry["head"] = head = min(fit, need, count)
            total, sets = total + head * size, sets + head
            if head == need or head < count:
                batch, total, sets = batch + 1, 0, 0
        fit, need = min(most // size, most_sets), max(1, -(-least // size))
        period = min(fit, need)
        out.append(entry | {"start": batch, "period": period})
        full, rest = divmod(count - entry["head"], period)
        if rest:
            batch, total, sets = batch + full, rest * size, rest
        elif full and need <= fit:
            batch, total, sets = batch + full, 0, 0
        elif full:  # full in sources or sets, but open until the next set comes
            batch, total, sets = batch + full - 1, period * size, period
    return out


def batches(sets: DataFrame, most: int, least: int = 500, most_sets: int = 50, key: str = "key", n: str = "n", order: str = "first") -> tuple[DataFrame, DataFrame]:
    """(large, rest): batch numbers of sets. sets: a key, its number of sources n and a whole number that orders equal sizes.

    large: key, chunks, batch: a set of more than `most` sources gives `chunks` batches of its own from `batch` on, before all
    others. rest: key, batch. Members of large sets take batch + rank div most; see members().
    """
    over = sets.where(F.col(n) > most).select(F.col(key).alias("key"), F.col(n).alias("n"), F.col(order).alias("first"))
    chunks = F.ceil(F.col("n") / most).cast("long")
    by_size = over.groupBy("n").agg(F.count(F.lit(1)).alias("sets")).select("n", "sets", (chunks * F.col("sets")).alias("batches"))
    larger = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)  # one row per distinct size above the limit
    starts = by_size.select("n", F.coalesce(F.sum("batches").over(larger), F.lit(0)).alias("start"))
    large = ranked(over, ["n"], "first").join(starts, "n").select("key", chunks.alias("chunks"), (F.col("start") + F.col("rank") * chunks).alias("batch"))
    used = by_size.agg(F.coalesce(F.sum("batches"), F.lit(0))).first()[0]
    under = sets.where(F.col(n) <= most).select(F.col(key).alias("key"), F.col(n).alias("n"), F.col(order).alias("first"))
    runs = [(r["n"], r["sets"]) for r in under.groupBy("n").agg(F.count(F.lit(1)).alias("sets")).orderBy(F.desc("n")).collect()]  # `most` rows at most
    plan = sets.sparkSession.createDataFrame([(r["size"], r["head"], r["open"], r["start"], r["period"]) for r in plan_runs(runs, most, least, most_sets)], "n long, head long, open long, start long, period long")
    place = F.when(F.col("rank") < F.col("head"), F.col("open")).otherwise(F.col("start") + F.floor((F.col("rank") - F.col("head")) / F.col("period")))
    rest = ranked(under.withColumn("n", F.col("n").cast("long")), ["n"], "first").join(F.broadcast(plan), "n").select("key", (place.cast("long") + used).alias("batch"))
    return large, rest


def members(sources: DataFrame, large: DataFrame, rest: DataFrame, most: int, key: str, order: str) -> DataFrame:
    """sources with their batch. Sources of large sets are cut into chunks of `most` in order; that cut is also what keeps
    a hot set from one task."""
    over = ranked(sources.join(large.withColumnRenamed("key", key), key), [key], order).withColumn("batch", F.col("batch") + F.floor(F.col("rank") / most).cast("long")).drop("rank", "chunks")
    under = sources.join(rest.withColumnRenamed("key", key), key)
    return over.unionByName(under)


def sub_batches(sources: DataFrame, group: list[str], order: str, n: int) -> DataFrame:
    """sources with sub_batch: runs of n within their group, in order."""
    return ranked(sources, group, order).withColumn("sub_batch", F.floor(F.col("rank") / n).cast("long")).drop("rank")


def rows_at(df: DataFrame, wanted: DataFrame, index: str = "row_idx") -> DataFrame:
    """Rows of df by position in the order asked: wanted has index and place. Repeated positions give repeated rows."""
    return wanted.join(df, index).orderBy("place")


def max_sources(total: int | None, configured: int | None = None) -> int:
    """Sources a batch: as configured, else 12,500 under a million sources and 100,000 from there."""
    return configured or (12_500 if total is not None and total < 1_000_000 else 100_000)
