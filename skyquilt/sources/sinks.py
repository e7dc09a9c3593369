"""Where cutouts go: Parquet by batch, FITS files, chunked arrays, mappings; and progress records."""

from __future__ import annotations

import json
import math
import os
import time
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fits

METADATA = ("source_id", "ra", "dec", "diameter_arcsec", "diameter_pixel", "original_cutout_size", "processing_timestamp", "rescaled_offset_x", "rescaled_offset_y")


def write_parquet(cutouts: DataFrame, root: str, batch: str = "batch") -> None:
    """Images and metadata as root/batch=N/*.parquet, each batch written by the tasks that hold it."""
    cutouts.write.partitionBy(batch).mode("overwrite").parquet(root)


def write_mapping(mapping: DataFrame, path: str) -> None:
    mapping.write.mode("overwrite").parquet(path)


def chunk_shape(n: int, height: int, width: int, channels: int, item_bytes: int, most_gib: float = 1.8) -> tuple[int, int, int, int]:
    one, most = height * width * channels * item_bytes, most_gib * 1024**3
    images = min(max(1, int(most / one)), n)
    if images == 1 and one > most:
        shrink = math.sqrt(one / most)
        return images, max(1, int(height / shrink)), max(1, int(width / shrink)), channels
    return images, height, width, channels


def fits_file(source: Mapping, images: list[np.ndarray], names: list[str], wcs: list[Mapping | None], data_type: str, stretch: str) -> bytes:
    """A primary HDU with the source's data and an image HDU for each channel."""
    head = [("SOURCE", source["source_id"]), ("RA", source.get("ra")), ("DEC", source.get("dec")), ("SIZEARC", source.get("diameter_arcsec")), ("SIZEPIX", source.get("diameter_pixel")), ("PROCTIME", source.get("processing_timestamp")), ("STRETCH", stretch), ("DTYPE", data_type)]
    out = [fits.image_hdu(None, [(k, v) for k, v in head if v is not None], primary=True)]
    for image, name, w in zip(images, names, wcs, strict=True):
        out.append(fits.image_hdu(image, [("EXTNAME", name), ("CHANNEL", name), ("FILTER", name), *(fits.wcs_cards(w) if w else [])]))
    return b"".join(out)


def write_fits(cutouts: DataFrame, folder: str, data_type: str = "float32", stretch: str = "linear", names: list[str] | None = None, subfolders: bool = False, overwrite: bool = False) -> DataFrame:
    """One FITS file a source in a folder that all executors share; returns SourceID, file, error.

    cutouts: SourceID, RA, Dec, diameter_arcsec, diameter_pixel, size, file_name, images (array of arrays), wcs (array of structs).
    Files appear whole, by rename. A file that is there already is an error unless overwrite; FITS stands for every type but bytes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                at = os.path.join(folder, (r.SourceID[:3] if len(r.SourceID) >= 3 else "misc") if subfolders else "", r.file_name)
                error = None
                if os.path.exists(at) and not overwrite:
                    error = "file exists"
                else:
                    os.makedirs(os.path.dirname(at), exist_ok=True)
                    planes = [np.asarray(p, dtype=data_type).reshape(r.size, r.size) for p in r.images]
                    meta = {"source_id": r.SourceID, "ra": r.RA, "dec": r.Dec, "diameter_arcsec": r.diameter_arcsec, "diameter_pixel": r.diameter_pixel, "processing_timestamp": time.time()}
                    meta = {k: v for k, v in meta.items() if v is not None and v == v}
                    heads = [None if w is None else dict(w if isinstance(w, dict) else w.asDict()) for w in (r.wcs if r.wcs is not None else [None] * len(planes))]
                    with open(f"{at}.part-{os.getpid()}", "wb") as f:
                        f.write(fits_file(meta, planes, names or [f"channel_{k + 1}" for k in range(len(planes))], heads, data_type, stretch))
                    os.replace(f"{at}.part-{os.getpid()}", at)
                out.append((r.SourceID, at, error))
            yield pd.DataFrame(out, columns=["SourceID", "file", "error"])

    return cutouts.mapInPandas(run, "SourceID string, file string, error string")


def write_arrays(cutouts: DataFrame, folder: str, size: int, channels: int, data_type: str = "float32", batch: str = "batch", order: str = "batch_index") -> DataFrame:
    """Each batch as folder/batch_NNN/images.zarr, an uncompressed version 2 array (n, y, x, channel), with a Parquet table of its
    metadata; returns batch, SourceID and idx_in_zarr of every image written. Batches are bounded by the plan that numbers them. Chunks of whole images follow chunk_shape()."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        root = os.path.join(folder, f"batch_{int(key[0]):03d}")
        store = os.path.join(root, "images.zarr")
        os.makedirs(store, exist_ok=True)
        kind = np.dtype(data_type).newbyteorder("<") if np.dtype(data_type).itemsize > 1 else np.dtype(data_type)
        shape = chunk_shape(len(pdf), size, size, channels, kind.itemsize)
        with open(os.path.join(store, ".zarray"), "w") as f:
            json.dump({"zarr_format": 2, "shape": [len(pdf), size, size, channels], "chunks": list(shape), "dtype": kind.str, "compressor": None, "fill_value": 0, "order": "C", "filters": None}, f)
        for k in range(0, len(pdf), shape[0]):
            block = np.zeros((shape[0], size, size, channels), kind)
            for i, planes in enumerate(pdf["images"].iloc[k : k + shape[0]]):
                block[i] = np.stack([np.asarray(p, float).reshape(size, size) for p in planes], axis=-1).astype(kind)
            for y in range(0, size, shape[1]):
                for x in range(0, size, shape[2]):
                    part = np.zeros(shape, kind)
                    cut = block[:, y : y + shape[1], x : x + shape[2]]
                    part[:, : cut.shape[1], : cut.shape[2]] = cut
                    with open(os.path.join(store, f"{k // shape[0]}.{y // shape[1]}.{x // shape[2]}.0"), "wb") as f:
                        f.write(part.tobytes())
        pdf.drop(columns=["images"]).assign(idx_in_zarr=range(len(pdf))).to_parquet(os.path.join(root, "images_metadata.parquet"))
        return pd.DataFrame({"batch": int(key[0]), "SourceID": pdf["SourceID"].astype(str), "idx_in_zarr": range(len(pdf))})

    return cutouts.groupBy(batch).applyInPandas(run, "batch long, SourceID string, idx_in_zarr long")


def read_array(store: str) -> np.ndarray:
    """A stored array, whole: for checks and small readers."""
    with open(os.path.join(store, ".zarray")) as f:
        meta = json.load(f)
    out = np.zeros(meta["shape"], meta["dtype"])
    c = meta["chunks"]
    for i in range(0, out.shape[0], c[0]):
        for y in range(0, out.shape[1], c[1]):
            for x in range(0, out.shape[2], c[2]):
                with open(os.path.join(store, f"{i // c[0]}.{y // c[1]}.{x // c[2]}.0"), "rb") as f:
                    part = np.frombuffer(f.read(), meta["dtype"]).reshape(c)
                at = out[i : i + c[0], y : y + c[1], x : x + c[2]]
                at[:] = part[: at.shape[0], : at.shape[1], : at.shape[2]]
    return out


PROGRESS = "process_id string, status string, total_sources long, completed_sources long, failed_sources long, progress_percent double, memory_footprint_mb double, memory_footprint_samples array<double>, current_source_id string, current_stage string, start_time double, last_update double, completion_time double, errors int, warnings int"


def write_progress(folder: str, record: Mapping) -> str:
    """One worker's record, whole or not at all."""
    os.makedirs(folder, exist_ok=True)
    at = os.path.join(folder, f"progress_{record['process_id']}.json")
    with open(f"{at}.part", "w") as f:
        json.dump(dict(record), f)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f"{at}.part", at)
    return at


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all workers; a corrupt file gives no row."""
    rows = spark.read.schema(PROGRESS + ", _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("pathGlobFilter", "*.json").json(folder)
    return rows.where("_corrupt is null and process_id is not null").drop("_corrupt")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Admission events: timestamp, category, event_type and a map of data, from JSON lines."""
    return spark.read.schema("timestamp double, category string, event_type string, data map<string,string>").json(path)


def read_performance(spark: SparkSession, path: str) -> DataFrame:
    """step, seconds from log lines `PERFORMANCE_DATA: {json}`, summed over the logs."""
    line = spark.read.text(path).where(F.col("value").contains("PERFORMANCE_DATA: "))
    steps = F.from_json(F.split_part("value", F.lit("PERFORMANCE_DATA: "), F.lit(2)), "map<string,double>")
    return line.select(F.explode(steps).alias("step", "seconds")).groupBy("step").agg(F.sum("seconds").alias("seconds"))
