"""Which sources a preview shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows from which a catalogue is thinned, rows kept of its head and drawn from the rest, picks kept.
THIN_FROM, HEAD, DRAWN, PICKS = 20_000, 1_000, 19_000, 200


def hashed(column: str, seed: int):
    return F.pmod(F.col(column) * 2654435761 + seed, F.lit(4294967296))


def thinned(catalogue: DataFrame, index: str, seed: int = 42, thin_from: int = THIN_FROM, head: int = HEAD, drawn: int = DRAWN) -> DataFrame:
    """All rows of a small catalogue; else its first rows and a hashed draw from the others."""
    if catalogue.limit(thin_from + 1).count() <= thin_from:
        return catalogue
    rest = catalogue.where(F.col(index) >= head).orderBy(hashed(index, seed), index).limit(drawn)
    return catalogue.where(F.col(index) < head).unionByName(rest)


def top_set(catalogue: DataFrame, sets: str = "fits_file_paths") -> DataFrame:
    """Sources of the most common set of files, the first in order of its files among equals."""
    best = catalogue.groupBy(sets).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), sets).limit(1)
    return catalogue.join(best.select(sets), sets, "left_semi")


def upper_half(rows: DataFrame, size: str) -> DataFrame:
    """Rows of at least the median size."""
    return rows.crossJoin(rows.agg(F.percentile(size, F.lit(0.5)).alias("_median"))).where(F.col(size) >= F.col("_median")).drop("_median")


def picks(catalogue: DataFrame, index: str, size: str, n: int, seed: int = 42) -> DataFrame:
    """n sources to preview: thinned, of the top set, of the upper half by size, by hash."""
    pool = upper_half(top_set(thinned(catalogue, index, seed)), size).orderBy(hashed(index, seed), index).limit(PICKS)
    return pool.orderBy(hashed(index, seed + 1), index).limit(n)
