"""Catalogue operators: validation, set index, statistics, analysis. Every check runs over all rows in one pass."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P

REQUIRED = ("SourceID", "RA", "Dec", "fits_file_paths")
SIZES = ("diameter_pixel", "diameter_arcsec")
#: Closed or half-open ranges as (low, low allowed, high).
RANGES = {"RA": (0.0, True, 360.0), "Dec": (-90.0, True, 90.0), "diameter_pixel": (0.0, False, 10000.0), "diameter_arcsec": (0.0, False, 3600.0)}
#: Relative difference of pixel scales from which one size in pixels cannot serve several files.
SCALE_TOLERANCE = 1e-4


class CatalogueError(ValueError):
    """A catalogue that cannot be processed; the message lists every finding of the first stage that has one."""


def missing_columns(columns: Iterable[str]) -> list[str]:
    """What a catalogue lacks: required columns, and one of the size columns."""
    have = set(columns)
    out = [f"missing column {c}" for c in REQUIRED if c not in have]
    if not have & set(SIZES):
        out.append(f"missing a size column: {' or '.join(SIZES)}")
    return out


def not_numeric(columns: Iterable[str]) -> list[Column]:
    """For each column, the number of values that are there but are no numbers."""
    return [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(f"{c}_not_numeric") for c in columns]


def out_of_range(columns: Iterable[str]) -> list[Column]:
    """For each column with a range, the numbers of values outside it and of nulls."""
    out = []
    for c in columns:
        low, closed, high = RANGES[c]
        v = F.col(c).try_cast("double")
        bad = (v > high) | ((v < low) if closed else (v <= low)) | F.isnan(v)
        out += [F.count_if(bad).alias(f"{c}_out_of_range"), F.count_if(v.isNull()).alias(f"{c}_null")]
    return out


def range_errors(catalogue: DataFrame) -> list[str]:
    """Messages for values out of range. A row may leave one size column null, not both."""
    present = [c for c in RANGES if c in catalogue.columns]
    sizes = [c for c in SIZES if c in catalogue.columns]
    no_size = F.count_if(~F.coalesce(*[F.col(c).try_cast("double").isNotNull() for c in sizes], F.lit(False)) if len(sizes) == 1 else F.col(sizes[0]).try_cast("double").isNull() & F.col(sizes[1]).try_cast("double").isNull()) if sizes else F.lit(0)
    found = catalogue.agg(*not_numeric(present), *out_of_range(present), no_size.alias("no_size")).first().asDict()
    out = []
    for c in present:
        if found[f"{c}_not_numeric"]:
            out.append(f"{found[f'{c}_not_numeric']} values of {c} are not numeric")
        if found[f"{c}_out_of_range"]:
            low, closed, high = RANGES[c]
            out.append(f"{found[f'{c}_out_of_range']} values of {c} are outside {'[' if closed else '('}{low:g}, {high:g}]")
        if c not in SIZES and found[f"{c}_null"]:
            out.append(f"{found[f'{c}_null']} values of {c} are null")
    if found["no_size"]:
        out.append(f"{found['no_size']} rows have no size")
    return out


def preprocessed(catalogue: DataFrame) -> DataFrame:
    """SourceID as a string, and path lists as normalised arrays whatever they came as."""
    out = catalogue.withColumn("SourceID", F.col("SourceID").cast("string"))
    kind = catalogue.schema["fits_file_paths"].dataType.typeName()
    path = F.col("fits_file_paths")
    return out.withColumn("fits_file_paths", P.parsed(path) if kind == "string" else F.transform(path, P.normalised))


def exploded(catalogue: DataFrame) -> DataFrame:
    """A row for each file of each source, with channel_no from 0; sources without files have none."""
    return catalogue.select("*", F.posexplode("fits_file_paths").alias("channel_no", "path"))


def set_index(catalogue: DataFrame, order: str) -> DataFrame:
    """Per ordered list of files: number of sources, and the smallest `order` of a source. Empty lists belong to no set.

    Row numbers stay in the table: members of a set are found by a join, so no list grows with the data.
    """
    return catalogue.where(F.size("fits_file_paths") > 0).groupBy("fits_file_paths").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))


def set_statistics(index: DataFrame) -> DataFrame:
    """total, unique, mean, greatest and least number of sources; zeros for no sets."""
    zero = F.lit(0)
    return index.agg(F.coalesce(F.sum("n"), zero).alias("total_sources"), F.count(zero).alias("unique_sets"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_sources"), F.coalesce(F.max("n"), zero).alias("max_sources"), F.coalesce(F.min("n"), zero).alias("min_sources"))


def resolution_conflicts(catalogue: DataFrame, scales: DataFrame) -> DataFrame:
    """Sources sized in pixels whose files differ in scale by more than SCALE_TOLERANCE relative to the first.

    scales: path, scale. Returns SourceID, spread.
    """
    files = exploded(catalogue.where(F.col("diameter_pixel").isNotNull() & (F.size("fits_file_paths") > 1)).select("SourceID", "fits_file_paths"))
    per = files.join(scales, "path").groupBy("SourceID").agg(F.min_by("scale", "channel_no").alias("one"), F.max("scale").alias("high"), F.min("scale").alias("low"))
    return per.select("SourceID", F.greatest(F.abs(F.col("high") / F.col("one") - 1), F.abs(F.col("low") / F.col("one") - 1)).alias("spread")).where(f"spread > {SCALE_TOLERANCE}")


def distinct_files(catalogue: DataFrame) -> DataFrame:
    """Each file and the number of sources that use it."""
    return catalogue.select(F.explode(F.array_distinct("fits_file_paths")).alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n_sources"))


def missing_files(catalogue: DataFrame, listing: DataFrame) -> DataFrame:
    """Files that the catalogue names and the listing (path) lacks, with their numbers of sources."""
    return distinct_files(catalogue).join(listing.select("path"), "path", "left_anti")


def analysis(catalogue: DataFrame) -> DataFrame:
    """One row: sources, files, mean files a source, bands. Exact, over all rows, from one pass over the distinct files."""
    files = distinct_files(catalogue).withColumn("band", P.filter_name(F.col("path")))
    by_file = files.agg(F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("n_sources"), F.lit(0)).alias("uses"), F.array_sort(F.collect_set("band")).alias("bands"))
    by_row = catalogue.agg(F.count(F.lit(1)).alias("num_sources"), F.avg(F.size("fits_file_paths")).alias("mean_files"))
    return by_row.crossJoin(by_file).select("num_sources", "num_files", "mean_files", F.array_join("bands", ",").alias("bands"))


def last_of_duplicates(catalogue: DataFrame, order: str) -> DataFrame:
    """Of rows with one SourceID the last by `order`, for parity with sources that overwrite each other."""
    columns = F.struct(*catalogue.columns)
    return catalogue.groupBy("SourceID").agg(F.max_by(columns, order).alias("row")).select("row.*")


def channel_order_errors(wanted: list[str], found: list[str], strict: bool = False) -> list[str]:
    """Why channel names do not follow the configured order: by equal names if strict, else by substrings in order."""
    if strict:
        return [] if wanted == found else [f"channels {found} are not {wanted}"]
    out = [f"missing channel {w}" for w in wanted if not any(w in f for f in found)]
    out += [f"unexpected channel {f}" for f in found if not any(w in f for w in wanted)]
    if not out:
        places = [next(i for i, f in enumerate(found) if w in f) for w in wanted]
        if places != sorted(places):
            out.append(f"channels {found} are not in the order {wanted}")
    return out


def extension_order_errors(files: list[str], weights: list[str]) -> list[str]:
    """Why the bands of a set's files do not stand in the order of the channel weights; unknown bands are not judged."""
    from .bands import band_of

    bands = [b for b in map(band_of, files) if b != "UNKNOWN"]
    return channel_order_errors([w for w in weights if w in bands], bands) if set(weights) & set(bands) else []
