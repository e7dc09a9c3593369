import math
import posixpath

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyquilt.functions import images as I
from skyquilt.functions import kernels
from skyquilt.functions import paths as P
from skyquilt.functions import wcs as W


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("path", ["/a//b/./c/../d.fits", "a/b/", "./a", "../a/b", "/../a", "", "a/../..", "//x", "/", "a/./../b"])
def test_paths_are_normalised_as_posix_does(spark, path):
    want = posixpath.normpath(path)
    assert one(spark, P.normalised(F.lit(path))) == ("/" + want.lstrip("/") if want.startswith("//") else want)


def test_path_lists(spark):
    got = lambda t: one(spark, P.parsed(F.lit(t)))
    assert got("['/a//b.fits', '/c.fits']") == ["/a/b.fits", "/c.fits"]
    assert got('["/a.fits"]') == ["/a.fits"]
    assert got("  /a/./b.fits ") == ["/a/b.fits"]
    assert got("[]") == [] and got("") == [] and got("   ") == []
    assert got("['/a.fits', '/b.fits', ]") == ["/a.fits", "/b.fits"]
    with pytest.raises(Exception, match="mismatched bracket"):
        got("['/a.fits'")
    for bad in ("[/a/b.fits]", "['/a.fits', None]"):
        with pytest.raises(Exception, match="not a list of paths"):
            got(bad)


@pytest.mark.parametrize(("name", "band"), [("X_VIS_1.fits", "VIS"), ("/VIS/nir_h.fits", "NIR-H"), ("NIRY.fits", "NIR-Y"), ("tile_Y.fits", "Y"), ("H1.fits", "H"), ("THING.fits", "UNKNOWN"), ("J-band", "J")])
def test_bands(spark, name, band):
    from skyquilt.operators.bands import band_of

    assert one(spark, P.filter_name(F.lit(name))) == band == band_of(name)


def test_file_names(spark):
    assert one(spark, P.fits_file_name(F.lit("a:b"), F.lit(1.5), F.lit(-2.0), "m/")) == "m_a_b_1.500000_-2.000000_cutout.fits"
    assert one(spark, P.fits_file_name(F.lit("a"), F.lit(None).cast("double"), F.lit(1.0))) == "a_cutout.fits"
    assert one(spark, P.subdirectory(F.lit("ab"))) == "misc"


@pytest.mark.parametrize("n", range(8, 22))
@pytest.mark.parametrize("shift", [0.0, 0.3, -0.4, 0.7])
def test_offset_points_at_the_target(spark, n, shift):
    """A pixel at x is found at n / 2 + offset of its cutout."""
    x = 50.0 + shift
    first, last = W.bounds(F.lit(x), F.lit(n))
    row = spark.range(1).select(first.alias("a"), last.alias("b")).first()
    assert row["b"] - row["a"] == n
    assert one(spark, W.offset(F.lit(x), F.lit(row["a"]), F.lit(n))) == pytest.approx(x - (math.trunc(x - n // 2) + n / 2), abs=1e-10)


def test_arcsec_rounds_half_to_even(spark):
    got = lambda a, s: one(spark, W.arcsec_to_pixels(F.lit(a), F.lit(s)))
    assert got(3.7, 0.36) == 10 and got(3.2, 0.36) == 9 and got(2.5, 1.0) == 2 and got(0.1, 1.0) == 1


def test_size_takes_nan_for_null(spark):
    nan = F.lit(float("nan"))
    assert one(spark, W.source_size(nan, F.lit(3.6), F.lit(0.36))) == 10
    assert one(spark, W.source_size(nan, nan, F.lit(0.36))) == 128


def test_tangent_plane_round_trip(spark):
    wcs = F.struct(*[F.lit(float(v)).alias(k) for k, v in dict(crpix1=50.5, crpix2=50.5, crval1=180, crval2=-30, cd11=-1e-4, cd12=2e-6, cd21=3e-6, cd22=1e-4).items()])
    x, y = W.sky_to_pixel(F.lit(180.0), F.lit(-30.0), wcs)
    assert (one(spark, x), one(spark, y)) == pytest.approx((49.5, 49.5), abs=1e-9)
    x, _ = W.sky_to_pixel(F.lit(0.0), F.lit(30.0), wcs)
    assert one(spark, x) is None


def test_padding_is_zero_and_centred(spark):
    px = F.array(*[F.lit(float(v)) for v in range(1, 7)])
    assert one(spark, I.pad_centred(px, F.lit(2), F.lit(3), F.lit(5))) == [0, 0, 0, 0, 0, 0, 1, 2, 3, 0, 0, 4, 5, 6, 0] + [0] * 10
    assert one(spark, I.place_true(px, F.lit(2), F.lit(3), F.lit(4), F.lit(2), F.lit(0))) == [0] * 8 + [1, 2, 3, 0, 4, 5, 6, 0]


def test_mixing_constants(spark):
    chans = F.array(*[F.array_repeat(F.lit(float(v)), 4) for v in (100, 200, 300)])
    assert one(spark, I.mixed(chans, [2.0, 1.0, 0.5])) == [550.0] * 4
    assert one(spark, I.mixed(chans, [1.0])) == [100.0] * 4


def test_chunk_shapes(spark):
    got = lambda *a: tuple(one(spark, I.chunk_shape(*[F.lit(x) for x in a])))
    assert got(500, 64, 64, 4, 1) == (500, 64, 64, 4)
    n, h, w, c = got(1000, 512, 512, 3, 4)
    assert n <= 614 and (h, w, c) == (512, 512, 3)
    n, h, w, c = got(1, 32768, 32768, 4, 4)
    assert n == 1 and h < 32768 and h * w * c * 4 <= 1.8 * 2**30


@pytest.mark.parametrize(("n", "target"), [(100, 50), (50, 100), (80, 120), (200, 64)])
def test_flux_is_kept(n, target):
    image = np.zeros((n, n))
    image[n // 4 : n // 2, n // 3 : n // 2] = 1000
    assert kernels.resample_flux(image, target).sum() == pytest.approx(image.sum(), rel=1e-9)


@settings(max_examples=30, deadline=None)
@given(st.integers(2, 30), st.integers(2, 30), st.sampled_from(sorted(kernels.ORDERS)))
def test_resizing_keeps_a_constant(n, target, how):
    assert np.allclose(kernels.resize(np.full((n, n), 3.0), target, how), 3.0)


def test_resize_of_equal_shape_is_a_copy():
    x = np.arange(9.0).reshape(3, 3)
    y = kernels.resize(x, 3)
    assert (x == y).all() and y is not x


def test_interpolation_goes_through_its_samples():
    x = np.random.default_rng(0).normal(size=(8, 8))
    for order in (1, 2, 3):
        assert np.allclose(kernels.resize_matrix(8, 8, order) @ x, x)


def test_zscale_ignores_outliers():
    x = np.random.default_rng(1).normal(10, 1, (64, 64))
    x[3, 3] = 1e6
    low, high = kernels.zscale_limits(x)
    assert 5 < low < 10 < high < 20


@pytest.mark.parametrize("method", ["linear", "none", "log", "asinh", "zscale"])
def test_stretches_rise_within_unit_range(method):
    y = kernels.stretch(np.linspace(-3, 8, 64).reshape(8, 8), method).ravel()
    assert y.min() >= 0 and y.max() <= 1 and (np.diff(y) >= -1e-12).all()
    assert (kernels.stretch(np.full((4, 4), 7.0), method) == 0).all()


def test_types():
    assert kernels.converted(np.array([0, 0.5, 1, 2]), "uint8").tolist() == [0, 128, 255, 255]
    assert kernels.converted(np.array([0, 1]), "int16").tolist() == [-32768, 32767]
    with pytest.raises(ValueError, match="unknown"):
        kernels.converted(np.zeros(1), "text")
