"""Image kernels that have no form in built-in functions, in numpy: resampling, overlap sums, zscale limits.

Definitions are the published ones: a Gaussian prefilter and separable interpolation on the half-pixel grid with mirrored
edges for resizing; area overlap for flux-conserving resampling; the iterative straight-line fit to sorted samples for zscale.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Interpolation names and their spline order; other names count as bilinear.
ORDERS = {"nearest": 0, "bilinear": 1, "biquadratic": 2, "bicubic": 3}


def _mirror(i: np.ndarray, n: int) -> np.ndarray:
    """Indices reflected about the outer edges of the first and last pixel."""
    i = np.mod(i, 2 * n)
    return np.where(i < n, i, 2 * n - 1 - i)


def _basis(order: int, x: np.ndarray) -> np.ndarray:
    """Central B-spline of an order at x."""
    x = np.abs(x)
    if order == 0:
        return (x < 0.5).astype(float)
    if order == 1:
        return np.maximum(0, 1 - x)
    if order == 2:
        return np.where(x < 0.5, 0.75 - x * x, np.where(x < 1.5, 0.5 * (1.5 - x) ** 2, 0))
    return np.where(x < 1, 2 / 3 - x * x + x**3 / 2, np.where(x < 2, (2 - x) ** 3 / 6, 0))


@lru_cache(256)
def resize_matrix(n: int, target: int, order: int) -> np.ndarray:
    """(target, n) weights along an axis: Gaussian prefilter when shrinking, then spline interpolation."""
    ratio = n / target
    at = (np.arange(target) + 0.5) * ratio - 0.5
    if order == 0:
        out = np.zeros((target, n))
        out[np.arange(target), np.clip(np.floor(at + 0.5).astype(int), 0, n - 1)] = 1
    else:
        out = np.zeros((target, n))
        first = np.floor(at).astype(int) - 1
        for k in range(4):
            np.add.at(out, (np.arange(target), _mirror(first + k, n)), _basis(order, at - (first + k)))
        if order > 1:
            knots = np.zeros((n, n))
            for k in range(-2, 3):
                np.add.at(knots, (np.arange(n), _mirror(np.arange(n) + k, n)), _basis(order, np.array(float(k))))
            out = np.linalg.solve(knots.T, out.T).T
    sigma = max(0.0, (ratio - 1) / 2)
    if sigma > 0 and order > 0:
        reach = int(4 * sigma + 0.5)
        g = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
        blur = np.zeros((n, n))
        for k, v in zip(range(-reach, reach + 1), g / g.sum(), strict=True):
            np.add.at(blur, (np.arange(n), _mirror(np.arange(n) + k, n)), v)
        out = out @ blur
    return out


def resize(image: np.ndarray, target: int, interpolation: str = "bilinear") -> np.ndarray:
    """Square image of target pixels across, in the image's own type; an equal shape is copied."""
    h, w = image.shape
    if (h, w) == (target, target):
        return image.copy()
    order = ORDERS.get(interpolation, 1)
    return (resize_matrix(h, target, order) @ image.astype(float) @ resize_matrix(w, target, order).T).astype(image.dtype)


@lru_cache(256)
def overlap_matrix(n: int, target: int, shift: float = 0.0) -> np.ndarray:
    """(target, n) share of each source pixel that falls into each target pixel; shift in target pixels."""
    step = n / target
    low = np.maximum(np.arange(n)[None, :], (np.arange(target)[:, None] - shift) * step)
    high = np.minimum(np.arange(n)[None, :] + 1, (np.arange(target)[:, None] + 1 - shift) * step)
    return np.maximum(0, high - low)


def resample_flux(image: np.ndarray, target: int, centre_shift: bool = False) -> np.ndarray:
    """Square image of target pixels across with the flux of each source pixel split by overlap.

    By default edges are aligned and the whole flux stays. centre_shift moves the grid by 0.5 / r - 0.5 target pixels (r: source
    pixels per target pixel), as reference pixels at half the size of both grids do; flux may leave at the edge.
    """
    h, w = image.shape
    shift = [0.5 * target / n - 0.5 if centre_shift else 0.0 for n in (h, w)]
    return (overlap_matrix(h, target, shift[0]) @ image.astype(float) @ overlap_matrix(w, target, shift[1]).T).astype(image.dtype if image.dtype.kind == "f" else np.float32)


def zscale_limits(image: np.ndarray, n_samples: int = 1000, contrast: float = 0.25, reject: float = 2.5, turns: int = 5) -> tuple[float, float]:
    """Display limits from a line through the sorted samples, outliers rejected in turns."""
    flat = image[np.isfinite(image)].astype(float)
    step = max(1, int(flat.size / n_samples))
    s = np.sort(flat[::step][:n_samples])
    n = len(s)
    if not n:
        return 0.0, 1.0
    least = max(5, int(n * 0.5))
    x = np.arange(n)
    bad = np.zeros(n, bool)
    slope, last, good = 0.0, n + 1, n
    for _ in range(turns):
        if good >= last or good < least:
            break
        slope, base = np.polyfit(x[~bad], s[~bad], 1) if good > 1 else (0.0, s[0])
        off = s - (slope * x + base)
        limit = reject * off[~bad].std()
        bad = np.convolve((off < -limit) | (off > limit), np.ones(max(1, int(n * 0.01))), mode="same") > 0
        last, good = good, int((~bad).sum())
    low, high, middle = float(s[0]), float(s[-1]), float(np.median(s))
    if good >= least:
        slope = slope / contrast if contrast > 0 else slope
        centre = (n - 1) // 2
        low, high = max(low, middle - (centre - 1) * slope), min(high, middle + (n - centre) * slope)
    return low, high


def central(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """The middle of an image; all of it where the window does not fit."""
    h, w = image.shape[:2]
    if not (0 < height <= h and 0 < width <= w):
        return image
    y, x = (h - height) // 2, (w - width) // 2
    return image[y : y + height, x : x + width]


def stretch(image: np.ndarray, method: str, a: float | None = None, percentile: float = 99.8, n_samples: int = 1000, contrast: float = 0.25, crop: tuple[int, int] | None = None) -> np.ndarray:
    """One channel to 0 to 1: linear and none by the range, log, asinh with a percentile clip, or zscale; a constant image to zeros.

    crop takes the greatest value from the image's middle. a defaults to 1000 for log and 0.1 for asinh.
    """
    if method not in ("linear", "none", "log", "asinh", "zscale"):
        raise ValueError(f"unknown stretch {method}")
    x = np.nan_to_num(image.astype(float))
    low, high = float(x.min()), float((central(x, *crop) if crop else x).max())
    if method == "zscale":
        low, high = zscale_limits(x, n_samples, contrast)
    elif method == "asinh":
        high = min(high, float(np.percentile(x, percentile)))
    unit = np.clip((x - low) / (high - low), 0, 1) if high > low else np.zeros_like(x)
    if method == "log":
        a = 1000.0 if a is None else a
        return np.log1p(a * unit) / np.log1p(a)
    if method == "asinh":
        a = 0.1 if a is None else a
        return np.arcsinh(unit / a) / np.arcsinh(1 / a)
    return unit


def converted(unit: np.ndarray, data_type: str) -> np.ndarray:
    """Values of 0 to 1 in an output type; unsigned and short types take the whole range."""
    x = np.clip(unit, 0, 1)
    if data_type in ("float32", "float64"):
        return unit.astype(data_type)
    if data_type in ("uint8", "uint16"):
        return np.rint(x * np.iinfo(data_type).max).astype(data_type)
    if data_type == "int16":
        return np.trunc(x * 65535 - 32768).astype(np.int16)
    raise ValueError(f"unknown data type {data_type}")


def combined(stack: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(out, y, x) from (channel, y, x) by a matrix (out, channel); channels beyond the matrix count nothing."""
    if not weights.size or weights.shape[1] > len(stack):
        raise ValueError("weights need a row for each output and a column for each channel")
    return np.einsum("oc,cyx->oyx", weights, stack[: weights.shape[1]])
