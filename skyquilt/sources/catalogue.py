"""Catalogues from CSV, Parquet and FITS tables, with file positions, size estimates and reads by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from . import fits_source

SCHEMA = "SourceID string, RA double, Dec double, diameter_pixel int, diameter_arcsec double, fits_file_paths string"


def suffix(path: str) -> str:
    return path.rstrip("/").rpartition(".")[2].lower()


def load(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalogue by its suffix: csv, parquet, fits or fit; ValueError for others. Only `columns` are read if given."""
    kind = suffix(path)
    if kind == "parquet":
        out = spark.read.parquet(path)
    elif kind == "csv":
        head = spark.read.option("header", True).csv(path).columns  # the header line alone
        known = dict(x.split() for x in SCHEMA.split(", "))
        out = spark.read.option("header", True).option("enforceSchema", False).schema(", ".join(f"`{c}` {known.get(c, 'string')}" for c in head)).option("escape", '"').csv(path)
    elif kind in ("fits", "fit"):
        fits_source.register(spark)
        out = spark.read.format("fits_table").option("path", path).load()
    else:
        raise ValueError(f"unsupported catalogue format: {path}")
    return out.select(*columns) if columns else out


def with_row_index(spark: SparkSession, path: str, columns: Sequence[str] | None = None, name: str = "row_idx") -> DataFrame:
    """A catalogue with each row's 0-based position, files in order of their names.

    Parquet rows know their place in their file, so one count a file gives the rest. Others are numbered by
    Spark's partition order, which follows the file, with one count a partition.
    """
    if suffix(path) == "parquet":
        rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        sizes = rows.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
        before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
        starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
        out = rows.join(starts, "_file").withColumn(name, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")
    else:
        rows = load(spark, path).withColumn("_id", F.monotonically_increasing_id())
        part = F.shiftright("_id", 33)
        sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
        starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
        out = rows.withColumn("_part", part).join(starts, "_part").withColumn(name, F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_part", "_start")
    return out.select(name, *columns) if columns else out


def estimated_rows(spark: SparkSession, path: str) -> int:
    """Parquet: the exact count, from footers. CSV: bytes over the mean length of the first ten lines of data. Others: a count."""
    if suffix(path) != "csv":
        return load(spark, path).count()
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    lines = [r[0] for r in spark.read.text(path).limit(11).collect()][1:]
    mean = sum(len(x.encode()) + 1 for x in lines) / len(lines) if lines else 0
    return int(size / mean) if mean else 0


def rows_at(indexed: DataFrame, positions: Sequence[int], name: str = "row_idx") -> DataFrame:
    """Rows at the positions, in the order asked; positions are a short list from the driver."""
    wanted = indexed.sparkSession.createDataFrame([(int(p), i) for i, p in enumerate(positions)], f"{name} long, place long")
    return F.broadcast(wanted).join(indexed, name).orderBy("place").drop("place")


def survey_catalogue(spark: SparkSession, path: str, least_area: float = 0.0, limit: int | None = None, multiplier: float = 5.0, least: int = 32) -> DataFrame:
    """Largest survey objects first, sized by SEGMENTATION_AREA: object id, position, diameter_pixel."""
    from ..operators.survey import with_sizes

    rows = with_sizes(load(spark, path), "SEGMENTATION_AREA", least_area, multiplier, least).select(F.col("OBJECT_ID").cast("string").alias("SourceID"), F.col("RIGHT_ASCENSION").alias("RA"), F.col("DECLINATION").alias("Dec"), "diameter_pixel", "SEGMENTATION_AREA")
    return rows.orderBy(F.desc("SEGMENTATION_AREA"), "SourceID").limit(limit) if limit else rows.orderBy(F.desc("SEGMENTATION_AREA"), "SourceID")


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    """path, size of the files below a folder, as Spark lists them; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")


def tile_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that name a tile: path, tile, band."""
    return files_in(spark, folder).select("path", P.tile_of(F.col("path")).alias("tile"), P.filter_name(F.col("path")).alias("band")).where("tile <> ''")
