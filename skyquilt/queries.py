"""The registered queries of the engine: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import images as I
from .functions import kernels
from .functions import paths as P
from .functions import wcs as W
from .operators import batching, catalogue, cutouts, preview, survey
from .operators import progress as prog
from .oracles import ORACLES
from .plans import fixtures as fx
from .sources import fits
from .streaming import progress as streams

__all__ = ["ORACLES", "QUERIES"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _placed(spark: SparkSession, sf: str, padding: float = 1.0) -> DataFrame:
    return cutouts.on_tiles(fx.catalogue(spark, sf), F.broadcast(fx.headers(spark)), padding)  # 20 headers


def _sum(px: Column, digits: int = 4) -> Column:
    return F.round(F.aggregate(px, F.lit(0.0), lambda s, v: s + v), digits)


def _moment(px: Column, digits: int = 4) -> Column:
    """Sum of values by their places, which tells any two orders apart."""
    return F.round(F.aggregate(F.transform(px, lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v), digits)


def _cells(df: DataFrame, key: str, px: Column, digits: int = 6) -> DataFrame:
    return df.select(key, F.posexplode(px).alias("i", "v")).select(key, "i", F.round(F.col("v").cast("double"), digits).alias("value"))


# -- catalogue ---------------------------------------------------------------------------------------------------
@query
def parse_paths(spark, sf):
    c = fx.catalogue(spark, sf)
    return c.select("SourceID", F.size("fits_file_paths").alias("n_paths"), F.array_join("fits_file_paths", "|").alias("paths"))


@query
def path_normalisation(spark, sf):
    raw = fx.table(spark, sf, "documents").select("doc_id", F.concat(F.lit("/a//"), "source", F.lit("/./x/../"), "lang", F.lit("//"), F.col("doc_id").cast("string"), F.lit(".fits/")).alias("p"))
    return raw.select("doc_id", P.normalised(F.col("p")).alias("path"))


@query
def filter_name(spark, sf):
    return fx.file_names(spark, sf).select("doc_id", P.filter_name(F.col("path")).alias("band"))


@query
def channel_keys(spark, sf):
    ext = F.when(F.col("doc_id") % 3 == 0, "SCI").otherwise("PRIMARY")
    return fx.file_names(spark, sf).select("doc_id", P.channel_key(F.col("path"), ext).alias("channel_key"))


@query
def source_id_cast(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("SourceID"), F.char_length(F.col("o_orderkey").cast("string")).alias("n"))


@query
def row_index(spark, sf):
    """Positions by batch of a hundred keys, as batching numbers them."""
    o = fx.table(spark, sf, "orders").withColumn("part", F.col("o_custkey") % 7)
    return batching.ranked(o, ["part"], "o_orderkey", "row_idx", stripe=1_000).select("o_orderkey", "part", "row_idx")


@query
def row_semi_join(spark, sf):
    wanted = fx.table(spark, sf, "supplier").select((F.col("s_suppkey") * 7).alias("o_orderkey"), (F.lit(1_000_000) - F.col("s_suppkey")).alias("place"))
    return batching.rows_at(fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), wanted, "o_orderkey").select("place", "o_orderkey", "o_custkey")


@query
def fits_set_index(spark, sf):
    index = catalogue.set_index(fx.catalogue(spark, sf), "l_orderkey")
    return index.select(F.array_join("fits_file_paths", "|").alias("paths"), "n", "first")


@query
def set_stats(spark, sf):
    s = catalogue.set_statistics(catalogue.set_index(fx.catalogue(spark, sf), "l_orderkey"))
    return s.withColumn("avg_sources", F.round("avg_sources", 6))


def _order_sets(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Orders with a set each: a customer's, but one large set of the urgent ones."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(-1)).otherwise(F.col("o_custkey")).cast("long").alias("set_key"))
    return o, o.groupBy("set_key").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"))


@query
def greedy_batches(spark, sf):
    orders, sets = _order_sets(spark, sf)
    large, rest = batching.batches(sets, 1000, 500, 50, key="set_key")
    out = batching.members(orders, large, rest, 1000, "set_key", "o_orderkey")
    return out.select("o_orderkey", "set_key", "batch")


@query
def split_oversized(spark, sf):
    li = fx.table(spark, sf, "orders").withColumn("status", F.col("o_orderstatus"))
    return batching.sub_batches(li.select("o_orderkey", "status"), ["status"], "o_orderkey", 700).select("o_orderkey", "status", F.col("sub_batch").alias("chunk"))


@query
def sub_batches(spark, sf):
    orders, _ = _order_sets(spark, sf)
    return batching.sub_batches(orders, ["set_key"], "o_orderkey", 5)


@query
def set_members(spark, sf):
    """Sources grouped by set within a batch; sources without files are in none."""
    c = fx.catalogue(spark, sf).where(F.size("fits_file_paths") > 0).withColumn("batch", F.col("l_orderkey") % 4)
    return c.groupBy("batch", F.array_join("fits_file_paths", "|").alias("paths")).agg(F.count(F.lit(1)).alias("n"))


@query
def range_validation(spark, sf):
    o = fx.table(spark, sf, "orders").select((F.col("o_totalprice") / 1000).alias("RA"), (F.col("o_totalprice") / 2000 - 120).alias("Dec"), (F.col("o_orderkey") % 12000 - 500).alias("diameter_pixel"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice") / 100).alias("diameter_arcsec"))
    return o.agg(*catalogue.out_of_range(["RA", "Dec", "diameter_pixel", "diameter_arcsec"]))


@query
def column_validation(spark, sf):
    p = fx.table(spark, sf, "part").select("p_brand", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand_no"), F.col("p_retailprice").cast("string").alias("price"))
    return p.agg(*catalogue.not_numeric(["p_brand", "brand_no", "price"]))


@query
def resolution_ratio(spark, sf):
    k = F.regexp_extract("path", r"_(\d+)\.fits", 1).cast("int")
    scales = fx.headers(spark).select("path", F.when(F.col("path").contains("nir"), F.lit(4.5) * (1 + (k % 3) * 0.00007)).otherwise(4.5).alias("scale"))
    return catalogue.resolution_conflicts(fx.catalogue(spark, sf), scales).select("SourceID", F.round("spread", 9).alias("spread"))


@query
def distinct_files(spark, sf):
    return catalogue.distinct_files(fx.catalogue(spark, sf))


@query
def missing_files(spark, sf):
    return catalogue.missing_files(fx.catalogue(spark, sf), fx.headers(spark).where("magzero < 27"))


@query
def catalogue_analysis(spark, sf):
    return catalogue.analysis(fx.catalogue(spark, sf)).withColumn("mean_files", F.round("mean_files", 6))


@query
def duplicate_sources(spark, sf):
    li = fx.table(spark, sf, "lineitem").select(F.concat_ws("_", "l_orderkey", "l_linenumber").alias("SourceID"), "l_partkey", "l_suppkey", "l_quantity")
    order = F.struct("l_partkey", "l_suppkey", "l_quantity")
    return catalogue.last_of_duplicates(li.withColumn("o", order), "o").drop("o")


# -- positions ---------------------------------------------------------------------------------------------------
@query
def pixel_scale(spark, sf):
    s = fx.table(spark, sf, "supplier").select("s_suppkey", F.struct(*[F.lit(0.0).alias(k) for k in ("crpix1", "crpix2", "crval1", "crval2")], ((F.col("s_suppkey") % 5) * -2.5e-5).alias("cd11"), ((F.col("s_suppkey") % 3) * 1e-6).alias("cd12"), ((F.col("s_suppkey") % 2) * 1e-6).alias("cd21"), F.lit(2.5e-5).alias("cd22")).alias("wcs"))
    return s.select("s_suppkey", F.round(W.pixel_scale(F.col("wcs")), 9).alias("scale"))


@query
def size_choice(spark, sf):
    c = fx.raw_catalogue(spark, sf)
    none = F.col("l_partkey") % 50 == 0
    return c.select("SourceID", W.source_size(F.when(~none, F.col("diameter_pixel")), F.when(~none, F.col("diameter_arcsec")), F.lit(4.5)).alias("size"))


@query
def sky_to_pixel(spark, sf):
    c = fx.raw_catalogue(spark, sf).crossJoin(F.broadcast(fx.headers(spark).limit(1).select("wcs")))
    x, y = W.sky_to_pixel(F.col("RA"), F.col("Dec"), F.col("wcs"))
    return c.select("SourceID", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query
def extraction_bounds(spark, sf):
    return _placed(spark, sf, 1.25).select("SourceID", "channel_no", "n", "x_min", "x_max", "y_min", "y_max")


@query
def clipped_bounds(spark, sf):
    return _placed(spark, sf, 1.25).select("SourceID", "channel_no", "cx_min", "cx_max", "cy_min", "cy_max")


@query
def valid_regions(spark, sf):
    c = catalogue.exploded(fx.catalogue(spark, sf)).join(F.broadcast(fx.headers(spark)), "path")
    return cutouts.with_bounds(c).groupBy("path").agg(F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("off_tile"))


@query
def pixel_offsets(spark, sf):
    return _placed(spark, sf).select("SourceID", "channel_no", F.round("offset_x", 6).alias("offset_x"), F.round("offset_y", 6).alias("offset_y"))


@query
def offset_rescale(spark, sf):
    p = _placed(spark, sf).withColumn("original", cutouts.original_size(F.col("diameter_pixel"), F.col("diameter_arcsec"), F.col("scale"), True))
    return p.select("SourceID", "channel_no", "original", F.round(W.rescaled(F.col("offset_x"), 256, F.col("original")), 5).alias("offset_x"))


@query
def source_tile_join(spark, sf):
    return _placed(spark, sf).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("pixels"), F.max("magzero").alias("magzero"))


@query
def cutout_slice(spark, sf):
    p = _placed(spark, sf).join(F.broadcast(fx.pixels(spark, sf)), ["path", "ext"])
    raw = I.crop(F.col("tile"), 8, F.col("cy_min"), F.col("cy_max"), F.col("cx_min"), F.col("cx_max"))
    return p.select("SourceID", "channel_no", F.size(raw).alias("pixels"), _sum(raw).alias("total"), _moment(raw).alias("moment"))


@query
def cutout_pad(spark, sf):
    p = cutouts.sliced(_placed(spark, sf), F.broadcast(fx.pixels(spark, sf)))
    return p.select("SourceID", "channel_no", F.size("px").alias("pixels"), _moment(F.col("px")).alias("moment"))


@query
def cutout_true_place(spark, sf):
    p = cutouts.sliced(_placed(spark, sf), F.broadcast(fx.pixels(spark, sf)), true_place=True)
    return p.select("SourceID", "channel_no", _moment(F.col("px")).alias("moment"))


@query
def flux_convert(spark, sf):
    p = cutouts.in_flux(cutouts.sliced(_placed(spark, sf), F.broadcast(fx.pixels(spark, sf))))
    return p.select("SourceID", "channel_no", _sum(F.transform("px", lambda v: v * 1e9)).alias("nano_jansky"))


@query
def cutout_flux(spark, sf):
    """From sky positions to the flux in each band of every source, and how many bands it has."""
    p = cutouts.total_flux(_placed(spark, sf), F.broadcast(fx.pixels(spark, sf))).withColumn("f", F.col("flux") * 1e9)
    at = lambda no: F.round(F.coalesce(F.sum(F.when(F.col("channel_no") == no, F.col("f"))), F.lit(0.0)), 3)
    return p.groupBy("SourceID").agg(F.count(F.lit(1)).alias("channels"), at(0).alias("vis"), at(1).alias("nir"))


@query
def wcs_header(spark, sf):
    p = _placed(spark, sf)
    h = W.cutout_header(F.col("wcs"), F.col("RA"), F.col("Dec"), F.lit(256.0), F.lit(256.0), F.lit(256.0) / F.col("n"), F.col("offset_x"), F.col("offset_y"))
    return p.select("SourceID", "channel_no", F.round(h["crpix1"], 6).alias("crpix1"), F.round(h["crpix2"], 6).alias("crpix2"), F.round(h["cd11"] * 1e6, 6).alias("cd11"), F.round(h["cd22"] * 1e6, 6).alias("cd22"))


@query
def minimal_wcs(spark, sf):
    c = fx.raw_catalogue(spark, sf)
    h = W.minimal_header(F.col("RA"), F.col("Dec"), F.lit(64.0), F.lit(64.0), F.lit(0.1), F.lit(2.0), F.lit(0.25), F.lit(-0.25))
    return c.select("SourceID", h["crpix1"].alias("crpix1"), h["crpix2"].alias("crpix2"), F.round(h["cd11"] * 1e6, 6).alias("cdelt1"), F.round(h["cd22"] * 1e6, 6).alias("cdelt2"))


@query
def fits_filename(spark, sf):
    c = fx.raw_catalogue(spark, sf)
    ra = F.when(F.col("l_partkey") % 100 != 0, F.round(F.col("RA"), 5))
    return c.select("SourceID", P.fits_file_name(F.translate("SourceID", "_", ":"), ra, F.round("Dec", 5), "T?").alias("file"), P.subdirectory(F.col("SourceID")).alias("folder"))


@query
def chunk_shape(spark, sf):
    p = fx.table(spark, sf, "part")
    side = (F.col("p_size") * 300).cast("int")
    c = I.chunk_shape(F.lit(1000), side, side, F.lit(4), F.when(F.col("p_partkey") % 2 == 0, 4).otherwise(1))
    return p.select("p_partkey", c["images"].alias("images"), c["height"].alias("height"), c["width"].alias("width"), c["channels"].alias("channels"))


@query
def source_mapping(spark, sf):
    """Where the images of sources are; every fifth source has none."""
    c = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("SourceID"), F.col("o_orderkey").alias("row_idx"), F.floor(F.col("o_orderkey") / 700).cast("long").alias("batch"))
    return cutouts.mapping(batching.ranked(c.where("row_idx % 5 <> 0"), ["batch"], "row_idx", "idx_in_zarr"))


@query
def resume_remaining(spark, sf):
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("SourceID"), "o_custkey")
    return cutouts.remaining(o, o.where("o_custkey % 3 = 0"))


# -- images ------------------------------------------------------------------------------------------------------
@query
def channel_stack(spark, sf):
    e = fx.images(spark, sf).where("vec_id % 7 <> 0").select(F.floor(F.col("vec_id") / 3).cast("long").alias("source"), (F.col("vec_id") % 3).cast("int").alias("channel_no"), "px")
    s = cutouts.stacked(e, ["source"], 3)
    at = lambda i: _moment(F.get("channels", F.lit(i)))
    return s.select("source", at(0).alias("c0"), at(1).alias("c1"), at(2).alias("c2"))


@query
def raw_stack(spark, sf):
    e = fx.images(spark, sf).where("vec_id % 7 <> 0").select(F.floor(F.col("vec_id") / 3).cast("long").alias("source"), (F.col("vec_id") % 3).cast("int").alias("channel_no"), "px")
    s = cutouts.stacked(e, ["source"], None)
    return s.select("source", F.size("channels").alias("n"), _moment(F.flatten("channels")).alias("moment"))


@query
def channel_mix(spark, sf):
    e = fx.images(spark, sf).select(F.floor(F.col("vec_id") / 3).cast("long").alias("source"), (F.col("vec_id") % 3).cast("int").alias("channel_no"), "px")
    s = cutouts.stacked(e, ["source"], 3)
    return s.select("source", _moment(I.mixed(F.col("channels"), [2.0, 1.0, 0.5])).alias("one"), _moment(I.mixed(F.col("channels"), [0.0, 1.0])).alias("two"))


@query
def minmax_norm(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.min_max(F.col("px")))


@query
def asinh_stretch(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.asinh_stretch(I.min_max(F.col("px")), 0.1))


@query
def log_stretch(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.log_stretch(I.min_max(F.col("px")), 1000.0))


@query
def percentile_clip(spark, sf):
    e = fx.images(spark, sf).withColumn("high", I.quantile(F.col("px"), 0.95)).withColumn("low", F.array_min("px"))
    return _cells(e, "vec_id", I.scaled(F.col("px"), F.col("low"), F.col("high")))


@query
def crop_max(spark, sf):
    return fx.images(spark, sf).select("vec_id", F.round(I.crop_max(F.col("px"), 8, 8, 4, 4), 6).alias("centre"), F.round(I.crop_max(F.col("px"), 8, 8, 9, 4), 6).alias("whole"))


@query
def to_uint8(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.to_uint8(F.transform("px", lambda v: v * 2)))


@query
def to_uint16(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.to_uint16(F.transform("px", lambda v: v * 2)))


@query
def to_int16(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.to_int16(F.transform("px", lambda v: v * 2)))


@query
def nhwc_to_nchw(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.transposed(F.col("px"), 4, 4, 4))


@query
def nchw_to_nhwc(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.transposed(F.col("px"), 4, 4, 4, first=False))


@query
def nearest_resize(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.nearest(F.col("px"), 8, 5))


@query
def block_sum_resize(spark, sf):
    return _cells(fx.images(spark, sf), "vec_id", I.block_sum(F.col("px"), 8, 2))


@query
def preview_rgb(spark, sf):
    e = fx.images(spark, sf).withColumn("n", F.col("vec_id") % 3)
    shifted = lambda k: F.transform("px", lambda v: v * (k + 1))
    chans = F.when(F.col("n") == 0, F.array("px")).when(F.col("n") == 1, F.array("px", shifted(1))).otherwise(F.array("px", shifted(1), shifted(2), shifted(3)))
    return _cells(e, "vec_id", I.display(chans))


# -- survey ------------------------------------------------------------------------------------------------------
@query
def tile_regex(spark, sf):
    return fx.file_names(spark, sf).select("doc_id", P.tile_of(F.col("path")).alias("tile"))


BANDS = ("VIS", "NIR-Y", "NIR-H", "NIR-J")


@query
def band_pivot(spark, sf):
    t = survey.band_table(fx.file_names(spark, sf), BANDS)
    return t.select("tile", *[F.col(f"`{b}`").alias(b.replace("-", "_").lower()) for b in BANDS])


@query
def missing_bands(spark, sf):
    return survey.lacking(survey.band_table(fx.file_names(spark, sf), (*BANDS, "J")), (*BANDS, "J"))


@query
def complete_tiles(spark, sf):
    return survey.complete_tiles(survey.band_table(fx.file_names(spark, sf), BANDS), BANDS).select("tile")


@query
def area_size(spark, sf):
    return survey.with_sizes(fx.table(spark, sf, "part"), "p_retailprice", 910.0, most=175).select("p_partkey", "diameter_pixel")


@query
def topn_by_area(spark, sf):
    return survey.largest(fx.table(spark, sf, "part"), "p_retailprice", "p_partkey", 25).select("p_partkey", "p_retailprice")


@query
def topn_per_tile(spark, sf):
    return survey.largest_of_each(fx.table(spark, sf, "part"), "p_brand", "p_retailprice", "p_partkey", 3).select("p_brand", "p_partkey", "place", survey.object_id(F.col("p_brand"), F.col("p_partkey").cast("string")).alias("object_id"))


@query
def hash_sample(spark, sf):
    return survey.hashed_sample(fx.table(spark, sf, "orders"), "o_orderkey", 100).select("o_orderkey", "o_custkey")


@query
def tile_choice(spark, sf):
    wanted = fx.table(spark, sf, "nation").select(F.concat(F.lit("Brand#"), F.col("n_nationkey") + 10).alias("p_brand"))
    found, gone = survey.chosen(fx.table(spark, sf, "part"), "p_brand", wanted)
    return found.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).unionByName(gone.select("p_brand", F.lit(0).cast("long").alias("n")))


@query
def preview_top_set(spark, sf):
    c = fx.catalogue(spark, sf)
    return preview.top_set(c).select("SourceID", F.array_join("fits_file_paths", "|").alias("paths"))


@query
def preview_upper_half(spark, sf):
    return preview.upper_half(fx.table(spark, sf, "part"), "p_size").select("p_partkey", "p_size")


@query
def preview_thinning(spark, sf):
    return preview.thinned(fx.table(spark, sf, "orders"), "o_orderkey", thin_from=2_000, head=100, drawn=500).select("o_orderkey")


# -- progress ----------------------------------------------------------------------------------------------------
@query
def progress_aggregate(spark, sf):
    a = prog.aggregated(fx.progress(spark, sf), elapsed=3600.0)
    return a.select("total_sources", "completed_sources", "failed_sources", "active_processes", "errors", "warnings", *[F.round(c, 4).alias(c) for c in ("progress_percent", "throughput", "eta_seconds", "memory_mb")])


@query
def completion_status(spark, sf):
    return prog.completion(fx.progress(spark, sf)).withColumn("completion_percent", F.round("completion_percent", 6))


@query
def stale_processes(spark, sf):
    return prog.stale(fx.progress(spark, sf), F.lit(1706659200), 3 * 3600).select("process_id", "last_update")


@query
def retained_records(spark, sf):
    return prog.fresh(fx.progress(spark, sf), F.lit(1706659200), 12).select("process_id", "last_update")


@query
def worker_states(spark, sf):
    return prog.latest(fx.table(spark, sf, "events"), "user_id", ["ts", "event_id"], ["event_id", "event_type", "value"])


def _steps(spark, sf) -> DataFrame:
    return fx.table(spark, sf, "events").select(F.col("event_type").alias("step"), F.round(F.col("value") * 100).cast("long").alias("seconds"))


@query
def step_stats(spark, sf):
    s = prog.step_statistics(_steps(spark, sf))
    return s.select("step", "n", "total", F.round("mean", 6).alias("mean"), "least", "greatest", F.round("percent", 6).alias("percent"))


@query
def bottlenecks(spark, sf):
    return prog.bottlenecks(prog.step_statistics(_steps(spark, sf)), 20.0).select("step", F.round("percent", 6).alias("percent"))


@query
def peak_window(spark, sf):
    e = fx.table(spark, sf, "events").select("user_id", "event_id", F.unix_timestamp("ts").alias("sec"), "value")
    return prog.peak(e, "user_id", "sec", "value", 7200).select("event_id", "peak")


@query
def moving_mean(spark, sf):
    e = fx.table(spark, sf, "events").select("user_id", "event_id", "value")
    return prog.moving(e, "user_id", ["event_id"], "value", 10).select("event_id", F.round("moving_mean", 6).alias("moving_mean"))


@query
def above_baseline(spark, sf):
    e = fx.table(spark, sf, "events").select("user_id", "event_id", "value")
    return prog.above_baseline(e, "user_id", ["event_id"], "value", 5).select("event_id", F.round("above", 6).alias("above"))


@query
def eta_smoothing(spark, sf):
    e = fx.table(spark, sf, "events").select("user_id", "event_id", "value")
    return prog.smoothed(e, "user_id", ["event_id"], "value").select("event_id", F.round("smoothed", 6).alias("smoothed"))


@query
def raw_eta(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select("o_orderkey", prog.clock(prog.raw_eta(F.col("o_orderkey") % 40, F.lit(40), (F.col("o_custkey") % 500).cast("double"))).alias("eta"))


@query
def spawn_decision(spark, sf):
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    peak = F.when(k % 5 != 0, (k % 17 * 100).cast("double"))
    left = prog.remaining_memory(F.lit(4000.0), (k % 13 * 100).cast("double"), 0.15, peak, k % 9)
    return o.select("o_orderkey", F.round(left, 6).alias("left_mb"), prog.spawn_decision(k % 9, F.lit(7), F.lit(1), k % 5 != 0, left, peak, (k % 101).cast("double")).alias("decision"))


@query
def remaining_memory(spark, sf):
    c = fx.table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey", F.round(prog.remaining_memory((k % 64 * 1024).cast("double"), (k % 40 * 100).cast("double"), 0.15, F.when(k % 3 != 0, (k % 900).cast("double")), k % 8), 6).alias("left_mb"))


@query
def worker_memory(spark, sf):
    c = fx.table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey", F.round(prog.worker_memory(F.lit(1000), k % 512, k % 4 + 1, F.when(k % 2 == 0, (k % 300).cast("double"))), 6).alias("mb"))


@query
def batch_size_rule(spark, sf):
    c = fx.table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey", prog.batch_size(k * 1000, F.when(k % 10 == 0, k % 500)).cast("long").alias("batch_size"), prog.workers(F.lit(16), k % 32 + 2).cast("long").alias("workers"))


@query
def scaling_metrics(spark, sf):
    runs = fx.table(spark, sf, "orders").groupBy(F.substring("o_orderpriority", 1, 1).cast("int").alias("workers")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("seconds"))
    return prog.scaling(runs).select("workers", "seconds", F.round("speedup", 6).alias("speedup"), F.round("efficiency", 6).alias("efficiency"))


@query
def tool_summary(spark, sf):
    runs = fx.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("scenario"), F.col("o_orderstatus").alias("tool")).agg(F.count(F.lit(1)).alias("sources"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("seconds"))
    return prog.tool_summary(runs).select("scenario", "tool", "sources", F.round(F.col("rate") * 1e6, 6).alias("rate"), F.round("speedup", 6).alias("speedup"))


@query
def output_size(spark, sf):
    c = fx.table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey", F.round(prog.output_gib(k * 100, k % 4 + 1, F.lit(256), F.when(k % 2 == 0, "float32").otherwise("uint8")), 6).alias("gib"))


@query
def event_window_throughput(spark, sf):
    t = streams.throughput(fx.table(spark, sf, "events"), "6 hours")
    return t.select(F.unix_timestamp(F.col("start").cast("timestamp")).alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query
def session_activity(spark, sf):
    s = streams.sessions(fx.table(spark, sf, "events"), "2 hours")
    return s.select("user_id", F.unix_micros(F.col("start").cast("timestamp")).alias("start"), F.unix_micros(F.col("end").cast("timestamp")).alias("end"), "n")


# -- kernels: numpy in Arrow batches; no SQL form, held against numpy in the tests -------------------------------
def _kernel(spark: SparkSession, sf: str, f: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "values": [f(np.asarray(p, float).reshape(8, 8)).ravel() for p in pdf["px"]]})

    return fx.images(spark, sf).select("vec_id", "px").mapInPandas(run, "vec_id long, values array<double>").select("vec_id", F.posexplode("values").alias("i", "v")).select("vec_id", "i", F.round("v", 9).alias("value"))


@query
def bilinear_resize(spark, sf):
    return _kernel(spark, sf, lambda x: kernels.resize(x, 5, "bilinear"))


@query
def bicubic_resize(spark, sf):
    return _kernel(spark, sf, lambda x: kernels.resize(x, 12, "bicubic"))


@query
def biquadratic_resize(spark, sf):
    return _kernel(spark, sf, lambda x: kernels.resize(x, 12, "biquadratic"))


@query
def drizzle_resize(spark, sf):
    return _kernel(spark, sf, lambda x: kernels.resample_flux(x, 5))


@query
def zscale_stretch(spark, sf):
    return _kernel(spark, sf, lambda x: kernels.stretch(x, "zscale"))


@query
def fits_roundtrip(spark, sf):
    def back(x: np.ndarray) -> np.ndarray:
        f = fits.from_bytes(fits.image_hdu(x, primary=True))
        (_, _, h, at), = fits.extensions(f)
        return fits.window(f, h, at, 0, 8, 0, 8)

    return _kernel(spark, sf, back)
