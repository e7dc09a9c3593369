"""Catalogue, tiles, images and progress records derived from the driver's tables, so that every operator has data to run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import paths as P


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a source catalogue; some sources are sized in arcseconds, path lists come as literals, bare paths and empty lists."""
    li = table(spark, sf_dir, "lineitem")
    q, k, no = F.col("l_quantity").cast("int"), F.col("l_suppkey") % 10, F.col("l_linenumber")
    both = F.format_string("['/t/./vis_%d.fits', '/t/nir_h_%d.fits']", k, k)
    return li.select(
        F.concat_ws("_", F.lit("SRC"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", q).alias("SourceID"),
        (F.lit(150.0) + (F.col("l_partkey") % 1000) * F.lit(1e-5)).alias("RA"), (F.lit(2.0) + (F.col("l_orderkey") % 1000) * F.lit(1e-5)).alias("Dec"),
        F.when(no % 3 != 0, 1 + q % 8).cast("int").alias("diameter_pixel"), F.when(no % 3 == 0, (4 + q % 30).cast("double")).alias("diameter_arcsec"),
        F.when(F.col("l_partkey") % 97 == 0, "[]").when(no % 5 == 0, F.format_string("/t//vis_%d.fits", k)).otherwise(both).alias("fits_file_paths"),
        k.alias("k"), "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber",
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_catalogue(spark, sf_dir).withColumn("fits_file_paths", P.parsed(F.col("fits_file_paths")))


def headers(spark: SparkSession) -> DataFrame:
    """Ten tiles of 8 x 8 pixels in two bands on one field."""
    t = spark.range(20).select((F.col("id") % 10).cast("int").alias("k"), F.floor(F.col("id") / 10).cast("int").alias("c"))
    f = lambda v: F.lit(float(v))
    wcs = F.struct(f(4.5).alias("crpix1"), f(4.5).alias("crpix2"), f(150.005).alias("crval1"), f(2.005).alias("crval2"), f(-0.00125).alias("cd11"), f(0).alias("cd12"), f(0).alias("cd21"), f(0.00125).alias("cd22"))
    return t.select(F.concat(F.lit("/t/"), F.when(F.col("c") == 0, "vis_").otherwise("nir_h_"), "k", F.lit(".fits")).alias("path"), F.lit("PRIMARY").alias("ext"), wcs.alias("wcs"), F.lit(8).alias("naxis1"), F.lit(8).alias("naxis2"), (F.lit(24.0) + F.col("k") * 0.5 + F.col("c") * 0.25).alias("magzero"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, ext, tile: the first two embeddings of each label are its tile's bands."""
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.col("embedding").cast("array<double>").alias("tile"))
    first = e.withColumn("c", F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))).where("c <= 2")
    return first.select(F.concat(F.lit("/t/"), F.when(F.col("c") == 1, "vis_").otherwise("nir_h_"), "label", F.lit(".fits")).alias("path"), F.lit("PRIMARY").alias("ext"), "tile")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, px: every embedding as an 8 x 8 image."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("px"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, path: a file name for every document, in all spellings of bands, some of none."""
    kinds = ["VIS", "NIR-Y", "NIRH", "nir_j", "NIR-H-STACK", "a_Y_1", "xJ", "h", "KHZ", "none"]
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("doc_id") % 10 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("/d/"), "source", F.lit("/EUC_"), kind, F.when(F.col("doc_id") % 4 == 0, "-PLAIN.fits").otherwise(F.concat(F.lit("_TILE"), (F.floor(F.col("doc_id") / 8) % 50).cast("string"), F.lit("-AB.fits")))).alias("path"))


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for each user of the events table, as of their last event."""
    e = table(spark, sf_dir, "events")
    last = F.max_by(F.struct("event_type", "value", "ts"), F.struct("ts", "event_id")).alias("last")
    r = e.groupBy("user_id").agg(last, F.count(F.lit(1)).alias("n"))
    done = F.when(F.col("user_id") % 4 == 0, F.col("n") * 10).otherwise(F.col("n") * 7)
    return r.select(
        F.col("user_id").alias("process_id"), F.when(F.col("last.event_type") == F.lit("purchase"), "completed").otherwise("processing").alias("status"), (F.col("n") * 10).alias("total_sources"), done.alias("completed_sources"),
        (F.col("user_id") % 3).alias("failed_sources"), F.when(F.col("user_id") % 4 == 0, 100.0).otherwise(70.0).alias("progress_percent"), F.round("last.value", 3).alias("memory_footprint_mb"), F.unix_timestamp("last.ts").alias("last_update"),
        F.when(F.col("user_id") % 11 == 0, 1).otherwise(0).alias("errors"), (F.col("user_id") % 2).cast("int").alias("warnings"),
    )
