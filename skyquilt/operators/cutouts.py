"""From sources and tile headers to bounds, pixels and stacked channels, as one declarative plan.

Bounds come from the header table alone, so sources off a tile are dropped before any pixel is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import images as I
from ..functions import paths as P
from ..functions import wcs as W


def with_bounds(files: DataFrame, padding: float = 1.0) -> DataFrame:
    """files: a row per source and file with RA, Dec, diameter_pixel, diameter_arcsec, wcs, naxis1, naxis2.

    Adds scale, size, x, y, n (extraction size), x_min to y_max before and cx_min to cy_max after clipping, valid, and
    offset_x and offset_y of the target from the middle of its cutout as it will be padded.
    """
    df = files.withColumn("scale", W.pixel_scale(F.col("wcs"))).withColumn("size", W.source_size(F.col("diameter_pixel"), F.col("diameter_arcsec"), F.col("scale")))
    x, y = W.sky_to_pixel(F.col("RA"), F.col("Dec"), F.col("wcs"))
    df = df.withColumns({"x": x, "y": y, "n": W.extraction_size(F.col("size"), padding)})
    (x0, x1), (y0, y1) = W.bounds(F.col("x"), F.col("n")), W.bounds(F.col("y"), F.col("n"))
    df = df.withColumns({"x_min": x0, "x_max": x1, "y_min": y0, "y_max": y1})
    df = df.withColumns({"cx_min": F.greatest(F.lit(0), "x_min"), "cx_max": F.least("naxis1", "x_max"), "cy_min": F.greatest(F.lit(0), "y_min"), "cy_max": F.least("naxis2", "y_max")})
    df = df.withColumn("valid", F.coalesce((F.col("cx_max") > F.col("cx_min")) & (F.col("cy_max") > F.col("cy_min")), F.lit(False)))
    pad_x = W.centred_pad(F.col("n"), F.col("cx_max") - F.col("cx_min"))
    pad_y = W.centred_pad(F.col("n"), F.col("cy_max") - F.col("cy_min"))
    return df.withColumns({"offset_x": W.offset(F.col("x"), F.col("x_min"), F.col("n")) - F.when(F.col("valid"), pad_x).otherwise(0), "offset_y": W.offset(F.col("y"), F.col("y_min"), F.col("n")) - F.when(F.col("valid"), pad_y).otherwise(0)})


def on_tiles(catalogue: DataFrame, headers: DataFrame, padding: float = 1.0) -> DataFrame:
    """Valid source and file pairs with their bounds. headers: path, ext, wcs, naxis1, naxis2, magzero.

    A file that the headers lack leaves its channel out; sources of which no file is left are gone.
    """
    files = catalogue.select("*", F.posexplode("fits_file_paths").alias("channel_no", "path")).drop("fits_file_paths")
    return with_bounds(files.join(headers, "path"), padding).where("valid")


def sliced(placed: DataFrame, pixels: DataFrame, true_place: bool = False) -> DataFrame:
    """placed with px, n x n pixels. pixels: path, ext, tile, a row-major array.

    Content of a cutout that hangs over the edge stands in the middle of zeros, or at its true place on request.
    """
    both = placed.join(pixels, ["path", "ext"])
    h, w = F.col("cy_max") - F.col("cy_min"), F.col("cx_max") - F.col("cx_min")
    inner = both.withColumn("raw", I.crop(F.col("tile"), F.col("naxis1"), F.col("cy_min"), F.col("cy_max"), F.col("cx_min"), F.col("cx_max"))).drop("tile")
    px = I.place_true(F.col("raw"), h, w, F.col("n"), F.col("cy_min") - F.col("y_min"), F.col("cx_min") - F.col("x_min")) if true_place else I.pad_centred(F.col("raw"), h, w, F.col("n"))
    return inner.withColumn("px", px).drop("raw")


def in_flux(cutouts: DataFrame) -> DataFrame:
    return cutouts.withColumn("px", I.to_flux(F.col("px"), F.col("magzero")))


def total_flux(placed: DataFrame, pixels: DataFrame) -> DataFrame:
    """placed with flux, the sum of a cutout's pixels in jansky. Zeros around it add nothing, so they are not made."""
    both = placed.join(pixels, ["path", "ext"])
    raw = I.crop(F.col("tile"), F.col("naxis1"), F.col("cy_min"), F.col("cy_max"), F.col("cx_min"), F.col("cx_max"))
    return both.withColumn("flux", F.aggregate(raw, F.lit(0.0), lambda s, v: s + v) * I.flux_factor(F.col("magzero"))).drop("tile")


def stacked(cutouts: DataFrame, source: Sequence[str], channels: int | None, channel: str = "channel_no", pixel: str = "px") -> DataFrame:
    """source columns and `channels`, an array of images by channel number. With a number of channels, a missing one is
    a plane of zeros; with None only those present are stacked, and their sizes must agree."""
    rows = cutouts.groupBy(*source).agg(F.sort_array(F.collect_list(F.struct(F.col(channel).alias("no"), F.col(pixel).alias("px")))).alias("all"))
    if channels is None:
        agree = F.size(F.array_distinct(F.transform("all", lambda c: F.size(c["px"])))) == 1
        return rows.withColumn("channels", F.when(agree, F.transform("all", lambda c: c["px"])).otherwise(F.raise_error(F.lit("channels of one source differ in size")).cast("array<array<double>>"))).drop("all")
    zero = F.transform(F.get("all", F.lit(0))["px"], lambda _: F.lit(0.0))
    found = lambda i: F.get(F.filter("all", lambda c: c["no"] == i), F.lit(0))["px"]
    return rows.withColumn("channels", F.array(*[F.coalesce(found(F.lit(i)), zero) for i in range(channels)])).drop("all")


def mapping(written: DataFrame, source: str = "SourceID", batch: str = "batch", place: str = "idx_in_zarr") -> DataFrame:
    """SourceID, zarr_file, batch_index (the number of the batch) and idx_in_zarr (the place in its array) of the sources written.

    Sources without an image are not in it: they are neither found in another's place nor taken for done.
    """
    return written.select(F.col(source).alias("SourceID"), F.format_string("batch_%03d/images.zarr", F.col(batch)).alias("zarr_file"), F.col(batch).cast("long").alias("batch_index"), F.col(place).cast("long").alias("idx_in_zarr"))


def remaining(catalogue: DataFrame, done: DataFrame) -> DataFrame:
    """Sources that a written mapping does not have yet: what a resumed job still has to do."""
    return catalogue.join(done.select("SourceID"), "SourceID", "left_anti")


def original_size(diameter_pixel: Column, diameter_arcsec: Column, scale: Column, fits_output: bool) -> Column:
    """Pixels across before resizing, for the rescaling of offsets; known for FITS output only."""
    if not fits_output:
        return F.lit(None).cast("int")
    return F.coalesce(W.whole(diameter_pixel.cast("double")), W.whole(F.rint(diameter_arcsec / scale)))


def keys(cutouts: DataFrame) -> DataFrame:
    return cutouts.withColumn("channel_key", P.channel_key(F.col("path"), F.col("ext")))
