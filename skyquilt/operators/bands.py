"""The band of one file name on the driver, by the patterns of the column expression."""

from __future__ import annotations

import posixpath
import re

from ..functions.paths import FILTERS


def band_of(path: str) -> str:
    name = posixpath.basename(path).upper()
    return next((band for pattern, band in FILTERS if re.search(pattern, name)), "UNKNOWN")
