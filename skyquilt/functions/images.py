"""Images as row-major arrays of double, and what can be done with them without leaving the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Jansky of AB magnitude zero.
AB_ZERO = 3631.0


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value computed once a row; inside a lambda an expression would be computed for every pixel."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _int(x: Column | int) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def crop(px: Column, width: Column | int, y0: Column, y1: Column, x0: Column, x1: Column) -> Column:
    """Rows y0 to y1 - 1 of columns x0 to x1 - 1."""
    return F.flatten(F.transform(F.sequence(y0, y1 - 1), lambda y: F.slice(px, y * _int(width) + x0 + 1, x1 - x0)))


def _placed(p: Column, height: Column, width: Column, n: Column, top: Column, left: Column) -> Column:
    """Content with rows and columns of zeros around it; whole rows are put together, not pixels."""
    zeros = lambda count: F.array_repeat(F.lit(0.0), count.cast("int"))
    row = lambda y: F.concat(zeros(left), F.slice(p, y * width + 1, width), zeros(n - width - left))
    return F.concat(zeros(top * n), F.flatten(F.transform(F.sequence(F.lit(0), height - 1), row)), zeros((n - height - top) * n))


def pad_centred(px: Column, height: Column, width: Column, n: Column) -> Column:
    """Content of height x width in the middle of n x n zeros."""
    top, left = F.floor((n - height) / 2).cast("int"), F.floor((n - width) / 2).cast("int")
    return let(px, lambda p: F.when((height == n) & (width == n), p).otherwise(_placed(p, height, width, n, top, left)))


def place_true(px: Column, height: Column, width: Column, n: Column, top: Column, left: Column) -> Column:
    """Content at its true place in n x n zeros: top and left pixels of the cutout lie outside the tile."""
    return let(px, lambda p: F.when((height == n) & (width == n), p).otherwise(_placed(p, height, width, n, top, left)))


def flux_factor(zero_point: Column) -> Column:
    """Jansky of a count; a missing zero point is an error."""
    factor = F.pow(F.lit(10.0), zero_point * -0.4) * AB_ZERO
    return F.when(zero_point.isNull(), F.raise_error(F.lit("missing zero point")).cast("double")).otherwise(factor)


def to_flux(px: Column, zero_point: Column) -> Column:
    """Jansky from counts; a missing zero point is an error."""
    return let(flux_factor(zero_point), lambda k: F.transform(px, lambda v: v * k))


def mixed(channels: Column, weights: Sequence[float]) -> Column:
    """Weighted sum of an array of images; channels beyond the weights count nothing."""
    def all_pixels(c: Column) -> Column:
        value = lambda i: sum((F.coalesce(F.get(F.get(c, F.lit(k)), i) * float(w), F.lit(0.0)) for k, w in enumerate(weights)), F.lit(0.0))
        return F.transform(F.sequence(F.lit(0), F.size(F.get(c, F.lit(0))) - 1), value)

    return let(channels, all_pixels)


def min_max(px: Column) -> Column:
    """To 0 to 1 by the image's own range; a constant image becomes zeros."""
    ends = F.struct(F.array_min(px).alias("low"), F.array_max(px).alias("high"))
    return let(ends, lambda e: F.transform(px, lambda v: F.when(e["high"] > e["low"], (v - e["low"]) / (e["high"] - e["low"])).otherwise(F.lit(0.0))))


def clipped(px: Column, low: Column, high: Column) -> Column:
    return let(F.struct(low.alias("low"), high.alias("high")), lambda e: F.transform(px, lambda v: F.least(F.greatest(v, e["low"]), e["high"])))


def scaled(px: Column, low: Column, high: Column) -> Column:
    """(v - low) / (high - low) within 0 to 1; zeros if the range is empty."""
    ends = F.struct(low.alias("low"), high.alias("high"))
    return let(ends, lambda e: F.transform(px, lambda v: F.when(e["high"] > e["low"], F.least(F.greatest((v - e["low"]) / (e["high"] - e["low"]), F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))))


def asinh_stretch(unit: Column, a: float = 0.1) -> Column:
    """asinh(x / a) / asinh(1 / a) of values from 0 to 1."""
    return F.transform(unit, lambda v: F.asinh(v / F.lit(a)) / F.asinh(F.lit(1.0) / F.lit(a)))


def log_stretch(unit: Column, a: float = 1000.0) -> Column:
    """ln(a x + 1) / ln(a + 1) of values from 0 to 1."""
    return F.transform(unit, lambda v: F.log1p(v * F.lit(a)) / F.log1p(F.lit(a)))


def quantile(px: Column, q: float) -> Column:
    """The q-quantile of an image's values, between neighbours by proportion."""
    def between(s: Column) -> Column:
        at = (F.size(s) - 1) * F.lit(q)
        low = F.floor(at).cast("int")
        return F.get(s, low) + (F.get(s, F.least(low + 1, F.size(s) - 1)) - F.get(s, low)) * (at - low)

    return let(F.array_sort(px), between)


def crop_max(px: Column, height: int, width: int, crop_height: int, crop_width: int) -> Column:
    """Greatest value in the central window, of the whole image if the window does not fit."""
    if not (0 < crop_height <= height and 0 < crop_width <= width):
        return F.array_max(px)
    y0, x0 = (height - crop_height) // 2, (width - crop_width) // 2
    return F.array_max(crop(px, width, F.lit(y0), F.lit(y0 + crop_height), F.lit(x0), F.lit(x0 + crop_width)))


def to_uint8(unit: Column) -> Column:
    return F.transform(unit, lambda v: F.rint(F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)) * 255).cast("smallint"))


def to_uint16(unit: Column) -> Column:
    return F.transform(unit, lambda v: F.rint(F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)) * 65535).cast("int"))


def to_int16(unit: Column) -> Column:
    """0 to 1 onto -32768 to 32767; the fraction is cut off toward zero."""
    return F.transform(unit, lambda v: (F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)) * 65535 - 32768).cast("smallint"))


def transposed(px: Column, height: int, width: int, channels: int, first: bool = True) -> Column:
    """first: from (y, x, channel) to (channel, y, x); else the other way."""
    plane = height * width
    if first:
        return F.transform(F.sequence(F.lit(0), F.lit(plane * channels - 1)), lambda i: F.get(px, F.pmod(i, F.lit(plane)) * channels + F.floor(i / plane).cast("int")))
    return F.transform(F.sequence(F.lit(0), F.lit(plane * channels - 1)), lambda i: F.get(px, F.pmod(i, F.lit(channels)) * plane + F.floor(i / channels).cast("int")))


def nearest(px: Column, size: int, target: int) -> Column:
    """Square image of target pixels across; each takes the source pixel under its middle."""
    step = size / target
    pick = [min(size - 1, int((k + 0.5) * step)) for k in range(target)]
    at = F.array(*[F.lit(p) for p in pick])
    return F.transform(F.sequence(F.lit(0), F.lit(target * target - 1)), lambda i: F.get(px, F.get(at, F.floor(i / target).cast("int")) * size + F.get(at, F.pmod(i, F.lit(target)))))


def block_sum(px: Column, size: int, factor: int) -> Column:
    """Square image whose pixels are sums of factor x factor blocks: resizing that keeps the flux."""
    target = size // factor
    cells = F.array(*[F.lit(y * size + x) for y in range(factor) for x in range(factor)])
    return F.transform(F.sequence(F.lit(0), F.lit(target * target - 1)), lambda i: F.aggregate(cells, F.lit(0.0), lambda s, c: s + F.get(px, F.floor(i / target).cast("int") * factor * size + F.pmod(i, F.lit(target)) * factor + c)))


def display(channels: Column) -> Column:
    """(y, x, rgb) of 0 to 255 from one (grey), two (red and green) or more images; NaN is 0; the range is that of all shown."""
    n = F.size(channels)
    clean = F.transform(channels, lambda c: F.transform(c, lambda v: F.nanvl(v, F.lit(0.0))))
    zero = F.transform(F.get(clean, F.lit(0)), lambda _: F.lit(0.0))
    three = F.when(n == 1, F.array(F.get(clean, F.lit(0)), F.get(clean, F.lit(0)), F.get(clean, F.lit(0)))).when(n == 2, F.array(F.get(clean, F.lit(0)), F.get(clean, F.lit(1)), zero)).otherwise(F.slice(clean, 1, 3))
    ends = lambda t: F.struct(F.array_min(F.transform(t, F.array_min)).alias("low"), F.array_max(F.transform(t, F.array_max)).alias("high"))
    scale = lambda v, e: F.when(e["high"] > e["low"], ((v - e["low"]) / (e["high"] - e["low"]) * 255).cast("int")).otherwise(0)
    shown = lambda t, e: F.transform(F.sequence(F.lit(0), F.size(F.get(t, F.lit(0))) * 3 - 1), lambda i: scale(F.get(F.get(t, F.pmod(i, F.lit(3))), F.floor(i / 3).cast("int")), e))
    return let(three, lambda t: let(ends(t), lambda e: shown(t, e)))


def chunk_shape(n: Column, height: Column, width: Column, channels: Column, item_bytes: Column, most_gib: float = 1.8) -> Column:
    """Images, height, width and channels of a stored chunk under most_gib."""
    one = height.cast("double") * width * channels * item_bytes
    most = F.lit(most_gib * 1024**3)
    images = F.least(F.greatest(F.lit(1), F.floor(most / one).cast("long")), n.cast("long"))
    shrink = F.sqrt(one / most)
    large = (images == 1) & (one > most)
    side = lambda s: F.when(large, F.greatest(F.lit(1), (s / shrink).cast("int"))).otherwise(s)
    return F.struct(images.alias("images"), side(height).alias("height"), side(width).alias("width"), channels.alias("channels"))
