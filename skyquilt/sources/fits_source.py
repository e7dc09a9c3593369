"""Spark readers over FITS files: headers, catalogues, inspection, and windows of pixels."""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from ..functions.wcs import WCS_TYPE
from . import fits

HEADER = f"path string, ext string, naxis1 int, naxis2 int, bitpix int, magzero double, header map<string,string>, wcs {WCS_TYPE}"
#: Rows of a binary table in one read partition.
TABLE_ROWS = 100_000


def _files(path: str) -> list[str]:
    local = path.removeprefix("file://").removeprefix("file:")
    return sorted(glob.glob(f"{local}/*.fit*") if os.path.isdir(local) else glob.glob(local))


class _File(InputPartition):
    def __init__(self, path: str, first: int = 0, last: int = 0) -> None:
        self.path, self.first, self.last = path, first, last


class FitsHeaders(DataSource):
    """format("fits"): a row for each image extension of each file. Options: path, zeropoint (header keyword, MAGZERO)."""

    @classmethod
    def name(cls) -> str:
        return "fits"

    def schema(self) -> str:
        return HEADER

    def reader(self, schema: StructType) -> DataSourceReader:
        return _HeaderReader(self.options)


class _HeaderReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.keyword = options["path"], options.get("zeropoint", "MAGZERO")

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in _files(self.path)] or [_File("")]

    def read(self, partition: _File) -> Iterator[tuple]:
        if partition.path:
            with fits.opened(partition.path) as f:
                for _, name, h, _ in fits.extensions(f):
                    if fits.is_image(h):
                        zero = h.get(self.keyword)
                        yield (partition.path, name, h["NAXIS1"], h["NAXIS2"], h["BITPIX"], None if zero is None else float(zero), {k: str(v) for k, v in h.items()}, tuple(fits.wcs_of(h)[k] for k in ("crpix1", "crpix2", "crval1", "crval2", "cd11", "cd12", "cd21", "cd22")))


class FitsTable(DataSource):
    """format("fits_table"): the first binary table of each file, in partitions of TABLE_ROWS rows."""

    @classmethod
    def name(cls) -> str:
        return "fits_table"

    def _table(self, path: str):
        with fits.opened(path) as f:
            for _, _, h, at in fits.extensions(f):
                if h.get("XTENSION") == "BINTABLE":
                    return h, at
        raise ValueError(f"no binary table in {path}")

    def schema(self) -> StructType:
        h, _ = self._table(_files(self.options["path"])[0])
        kind, out = fits.table_type(h), []
        for k, name in enumerate(kind.names, 1):
            letter = str(h[f"TFORM{k}"]).strip()[-1]
            out.append(StructField(name, StringType() if letter == "A" else BooleanType() if letter == "L" else DoubleType() if letter in "ED" else LongType()))
        return StructType(out)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _TableReader(self, schema)


class _TableReader(DataSourceReader):
    def __init__(self, source: FitsTable, schema: StructType) -> None:
        self.source, self.names = source, schema.names

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for p in _files(self.source.options["path"]):
            n = self.source._table(p)[0]["NAXIS2"]
            out += [_File(p, a, min(n, a + TABLE_ROWS)) for a in range(0, n, TABLE_ROWS)]
        return out or [_File("")]

    def read(self, partition: _File) -> Iterator[tuple]:
        if partition.path:
            h, at = self.source._table(partition.path)
            with fits.opened(partition.path) as f:
                rows = fits.table_rows(f, h, at, partition.first, partition.last)
            yield from zip(*[rows[n] for n in self.names], strict=True)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FitsHeaders)
    spark.dataSource.register(FitsTable)


def headers(spark: SparkSession, path: str, zeropoint: str = "MAGZERO") -> DataFrame:
    register(spark)
    return spark.read.format("fits").option("path", path).option("zeropoint", zeropoint).load()


def inspected(paths: DataFrame) -> DataFrame:
    """path, num_extensions, extensions, error of each file of `path`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([fits.inspect(p) for p in pdf["path"]], columns=["path", "num_extensions", "extensions", "error"])

    return paths.select("path").mapInPandas(run, "path string, num_extensions int, extensions array<struct<index:int,name:string,type:string,has_data:boolean>>, error string")


def with_pixels(placed: DataFrame, rows_in_task: int = 12_500) -> DataFrame:
    """placed (see operators.cutouts.on_tiles) with px: n x n pixels around each source, read as windows of its file.

    Rows are dealt by file and chunk of `rows_in_task` sources, so a popular tile is read by many tasks, and each task
    keeps one file open at a time and reads its windows from top to bottom. A file that is missing or broken gives no rows.
    """
    schema = placed.schema
    names = placed.columns
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "px array<double>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple = (None, None, {})
        for pdf in batches:
            kept, pixels = [], []
            for i, row in enumerate(pdf.itertuples(index=False)):
                if held[0] != row.path:
                    if held[1]:
                        held[1].close()
                    try:
                        f = fits.opened(row.path)
                        held = (row.path, f, {name: (h, at) for _, name, h, at in fits.extensions(f)})
                    except (OSError, ValueError):
                        held = (row.path, None, {})
                if row.ext not in held[2]:
                    continue
                h, at = held[2][row.ext]
                raw = fits.window(held[1], h, at, row.cy_min, row.cy_max, row.cx_min, row.cx_max)
                full = np.zeros((row.n, row.n))
                top, left = (row.n - raw.shape[0]) // 2, (row.n - raw.shape[1]) // 2
                full[top : top + raw.shape[0], left : left + raw.shape[1]] = raw
                kept.append(i)
                pixels.append(full.ravel())
            yield pdf.iloc[kept].assign(px=pixels)[[*names, "px"]]
        if held[1]:
            held[1].close()

    # chunks by a hash of the source: the same rows in the same task on every attempt
    parts = placed.groupBy("path").agg(F.ceil(F.count(F.lit(1)) / rows_in_task).alias("_parts"))
    dealt = placed.join(parts, "path").withColumn("_chunk", F.pmod(F.xxhash64("SourceID", "x_min", "y_min"), "_parts"))
    dealt = dealt.repartition("path", "_chunk").sortWithinPartitions("path", "ext", "cy_min").select(*names)
    return dealt.mapInPandas(run, out)
