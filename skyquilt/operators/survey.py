"""Survey catalogues and tiles: derived sizes, top-n, band tables, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import wcs as W


def with_sizes(rows: DataFrame, area: str, least_area: float = 0.0, multiplier: float = 5.0, least: int = 32, most: int | None = None) -> DataFrame:
    """Rows of at least least_area with diameter_pixel from it."""
    return rows.where(F.col(area) >= least_area).withColumn("diameter_pixel", W.size_from_area(F.col(area), multiplier, least, most))


def largest(rows: DataFrame, area: str, tie: str, n: int) -> DataFrame:
    return rows.orderBy(F.desc(area), tie).limit(n)


def largest_of_each(rows: DataFrame, group: str, area: str, tie: str, n: int) -> DataFrame:
    """n largest rows of each group; Spark cuts each task's rows to n a group before the shuffle."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(area), tie))).where(f"place <= {n}")


def band_table(files: DataFrame, bands: Sequence[str], path: str = "path") -> DataFrame:
    """tile and a path for each band, the first by name; null where a tile lacks the band."""
    named = files.select(P.tile_of(F.col(path)).alias("tile"), P.filter_name(F.col(path)).alias("band"), F.col(path).alias("p")).where("tile <> ''")
    return named.groupBy("tile").pivot("band", list(bands)).agg(F.min("p"))


def complete_tiles(table: DataFrame, bands: Sequence[str]) -> DataFrame:
    return table.dropna(subset=list(bands))


def lacking(table: DataFrame, bands: Sequence[str]) -> DataFrame:
    """tile and the bands that it lacks."""
    gone = F.array_compact(F.array(*[F.when(F.col(f"`{b}`").isNull(), F.lit(b)) for b in bands]))
    return table.select("tile", F.array_join(gone, ",").alias("lacks")).where("lacks <> ''")


def object_id(tile: Column, source: Column) -> Column:
    return F.concat(F.lit("TILE_"), tile, F.lit("_"), source)


def hashed_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by an arithmetic hash of a whole-number key: the same for any partitioning."""
    return rows.orderBy(F.pmod(F.col(key) * 2654435761 + seed, F.lit(4294967296)), key).limit(n)


def chosen(rows: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the wanted keys, wanted keys that no row has)."""
    return rows.join(wanted, key, "left_semi"), wanted.join(rows.select(key), key, "left_anti")
