"""Positions, sizes and bounds of cutouts as column expressions: tangent-plane projection, sizes, bounds, offsets, headers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pixels across if a source gives no size, and arcseconds a pixel if a header has no usable matrix.
DEFAULT_SIZE, DEFAULT_SCALE = 128, 0.1
WCS_TYPE = "struct<crpix1:double,crpix2:double,crval1:double,crval2:double,cd11:double,cd12:double,cd21:double,cd22:double>"


def whole(x: Column) -> Column:
    """x without its fraction, as an int; null for NaN and what an int cannot hold."""
    return x.try_cast("int")


def pixel_scale(wcs: Column) -> Column:
    """Arcseconds a pixel."""
    scale = F.sqrt(F.abs(wcs["cd11"] * wcs["cd22"] - wcs["cd12"] * wcs["cd21"])) * 3600
    return F.when(scale > 0, scale).otherwise(F.lit(DEFAULT_SCALE))


def arcsec_to_pixels(arcsec: Column, scale: Column) -> Column:
    """Nearest whole number of pixels, halves to even, 1 at least."""
    return F.greatest(F.lit(1), whole(F.rint(arcsec / scale)))


def source_size(diameter_pixel: Column, diameter_arcsec: Column, scale: Column) -> Column:
    """diameter_pixel, else diameter_arcsec by this file's scale, else DEFAULT_SIZE. NaN counts as null."""
    pixel = F.nanvl(diameter_pixel.cast("double"), F.lit(None).cast("double"))
    arcsec = F.nanvl(diameter_arcsec.cast("double"), F.lit(None).cast("double"))
    return F.coalesce(whole(pixel), F.when(arcsec.isNotNull(), arcsec_to_pixels(arcsec, scale)), F.lit(DEFAULT_SIZE))


def sky_to_pixel(ra: Column, dec: Column, wcs: Column) -> tuple[Column, Column]:
    """0-based pixel of a position by the tangent-plane projection; null behind the plane."""
    a, d = F.radians(ra - wcs["crval1"]), F.radians(dec)
    d0 = F.radians(wcs["crval2"])
    depth = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    xi = F.degrees(F.cos(d) * F.sin(a) / depth)
    eta = F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)) / depth)
    det = wcs["cd11"] * wcs["cd22"] - wcs["cd12"] * wcs["cd21"]
    x = wcs["crpix1"] - 1 + (wcs["cd22"] * xi - wcs["cd12"] * eta) / det
    y = wcs["crpix2"] - 1 + (wcs["cd11"] * eta - wcs["cd21"] * xi) / det
    return F.when(depth > 0, x), F.when(depth > 0, y)


def extraction_size(size: Column, padding: float) -> Column:
    return whole(size * F.lit(float(padding)))


def bounds(at: Column, n: Column) -> tuple[Column, Column]:
    """First pixel and the one after the last along an axis, before clipping; fractions are cut off toward zero."""
    left = F.floor(n / 2).cast("int")
    return whole(at - left), whole(at + (n - left))


def offset(at: Column, first: Column, n: Column) -> Column:
    """Of the target from the middle of its cutout."""
    return at - (first + n / 2.0)


def centred_pad(n: Column, inner: Column) -> Column:
    """Zero pixels before content of `inner` pixels that stands in the middle of n."""
    return F.greatest(F.lit(0), F.floor((n - inner) / 2).cast("int"))


def rescaled(shift: Column, target: Column | float, original: Column) -> Column:
    """An offset in final pixels; unchanged where the original size is unknown."""
    to = target if isinstance(target, Column) else F.lit(float(target))
    return F.when(original.isNull() | (original == 0), shift).otherwise(shift * to / original)


def size_from_area(area: Column, multiplier: float = 5.0, least: int = 32, most: int | None = None) -> Column:
    """Even number of pixels across, from a segmentation area taken for a disc."""
    raw = whole(F.lit(2.0) * F.sqrt(area / F.lit(math.pi)) * F.lit(float(multiplier)))
    size = F.greatest(F.lit(least), raw + F.pmod(raw, F.lit(2)))
    return size if most is None else F.least(F.lit(most), size)


def cutout_header(wcs: Column, ra: Column, dec: Column, height: Column, width: Column, factor: Column, dx: Column, dy: Column) -> Column:
    """WCS_TYPE of a cutout: reference at the source in the middle plus offset, matrix divided by the resize factor."""
    return F.struct(
        (width / 2.0 + 0.5 + dx).alias("crpix1"), (height / 2.0 + 0.5 + dy).alias("crpix2"), ra.alias("crval1"), dec.alias("crval2"),
        *[(wcs[k] / factor).alias(k) for k in ("cd11", "cd12", "cd21", "cd22")],
    )


def minimal_header(ra: Column, dec: Column, height: Column, width: Column, scale: Column, factor: Column, dx: Column, dy: Column) -> Column:
    """WCS_TYPE without a parent's: square pixels of scale arcseconds (NaN if null), right ascension falling with x."""
    step = F.coalesce(scale, F.lit(float("nan"))) / 3600 / factor
    zero = F.lit(0.0)
    return F.struct(
        (width / 2.0 + 0.5 + dx).alias("crpix1"), (height / 2.0 + 0.5 + dy).alias("crpix2"), ra.alias("crval1"), dec.alias("crval2"),
        (-step).alias("cd11"), zero.alias("cd12"), zero.alias("cd21"), step.alias("cd22"),
    )
