"""Path lists of a catalogue: parsing, normalising, set signatures, names taken from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The filter patterns in the order in which they are tried, on the upper-cased base name.
FILTERS = (
    ("VIS", "VIS"),
    ("NIR-?Y", "NIR-Y"),
    ("NIR-?H", "NIR-H"),
    ("NIR-?J", "NIR-J"),
    ("NIR_H", "NIR-H"),
    ("NIR_Y", "NIR-Y"),
    ("NIR_J", "NIR-J"),
    ("(?:^|[^A-Z])Y(?:[^A-Z]|$)", "Y"),
    ("(?:^|[^A-Z])J(?:[^A-Z]|$)", "J"),
    ("(?:^|[^A-Z])H(?:[^A-Z]|$)", "H"),
)


def normalised(path: Column) -> Column:
    """A path without repeated slashes, `.` and `..` steps and a trailing slash; `..` above the root of an absolute path goes.
    Most paths have none of these and are not taken apart."""
    return F.when(path.rlike(r"//|(?:^|/)\.\.?(?:/|$)|/$|^$"), _folded(path)).otherwise(path)


def _folded(path: Column) -> Column:
    rooted = path.startswith("/")
    none = F.array().cast("array<string>")
    last = lambda acc: F.get(acc, F.size(acc) - 1)

    def step(acc: Column, part: Column) -> Column:
        up = (part == "..") & (F.size(acc) > 0) & (F.coalesce(last(acc), F.lit("")) != "..")
        return F.when(part.isin("", ".") | ((part == "..") & (F.size(acc) == 0) & rooted), acc).when(up, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(F.concat(acc, F.array(part)))

    parts = F.array_join(F.aggregate(F.split(path, "/"), none, step), "/")
    return F.when(rooted, F.concat(F.lit("/"), parts)).when(parts == "", F.lit(".")).otherwise(parts)


def parsed(text: Column, normalise: bool = True) -> Column:
    """The list that a string holds: a list literal, a bare path, or nothing. One bracket without the other is an error, and so
    are brackets around anything but strings; a comma may follow the last one."""
    value = F.trim(text)
    opened, closed = value.startswith("["), value.endswith("]")
    literal = F.from_json(F.regexp_replace(value, r",\s*\]$", "]"), "array<string>")
    bad = F.raise_error(F.concat(F.lit("not a list of paths: "), value)).cast("array<string>")
    found = (
        F.when(value == "", F.array().cast("array<string>"))
        .when(opened != closed, F.raise_error(F.concat(F.lit("mismatched bracket in path list: "), value)).cast("array<string>"))
        .when(opened & (literal.isNull() | F.exists(literal, lambda p: p.isNull())), bad)
        .when(opened, literal)
        .otherwise(F.array(value))
    )
    return F.transform(found, normalised) if normalise else found


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def filter_name(path: Column) -> Column:
    """The band that a file name tells, UNKNOWN if none."""
    name = F.upper(base_name(path))
    out = F.when(name.rlike(FILTERS[0][0]), FILTERS[0][1])
    for pattern, band in FILTERS[1:]:
        out = out.when(name.rlike(pattern), band)
    return out.otherwise("UNKNOWN")


def channel_key(path: Column, ext: Column) -> Column:
    """File stem, with the extension's name unless it is PRIMARY."""
    stem = F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")
    return F.when(ext == "PRIMARY", stem).otherwise(F.concat_ws("_", stem, ext))


def tile_of(path: Column) -> Column:
    """The tile id between TILE and the next dash; empty if there is none."""
    return F.regexp_extract(path, "TILE([^-]+)-", 1)


def fits_file_name(source_id: Column, ra: Column, dec: Column, modifier: Column | str = "") -> Column:
    """modifier + id_ra_dec_cutout.fits with characters that file systems refuse made underscores; id_cutout.fits without a position."""
    head = modifier if isinstance(modifier, Column) else F.lit(modifier)
    full = F.format_string("%s%s_%.6f_%.6f_cutout.fits", head, source_id, ra, dec)
    return F.translate(F.when(ra.isNull() | dec.isNull(), F.concat(source_id, F.lit("_cutout.fits"))).otherwise(full), '<>:"/\\|?*', "_________")


def subdirectory(source_id: Column) -> Column:
    """First three characters of an id, misc for shorter ones."""
    return F.when(F.char_length(source_id) >= 3, F.substring(source_id, 1, 3)).otherwise("misc")
