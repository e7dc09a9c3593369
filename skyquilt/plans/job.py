"""A cutout job: catalogue to images, as one lazy plan with a driver-side surface around it."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions import paths as P
from ..functions import wcs as W
from ..operators import batching, catalogue, cutouts, preview
from ..sources import catalogue as tables
from ..sources import config as C
from ..sources import fits_source, sinks

IMAGE = "SourceID string, RA double, Dec double, diameter_pixel int, diameter_arcsec double, row_idx long, batch long, batch_index long, size int, images array<array<float>>, wcs array<" + W.WCS_TYPE + ">, channel_keys array<string>, original_cutout_size int, rescaled_offset_x double, rescaled_offset_y double"


def _number(card: str) -> Any:
    """A header card's value as a number, if it is one."""
    try:
        return float(card)
    except (TypeError, ValueError):
        return card


class CutoutJob:
    """Settings and a catalogue (a path or a DataFrame) to batches, images, files and previews."""

    def __init__(self, spark: SparkSession, config: Mapping[str, Any], status_panel: Any = None) -> None:
        self.spark, self.config, self.panel = spark, C.validated(config), status_panel
        self.group, self.started = f"skyquilt-{id(self)}", None
        self.status: dict[str, Any] = {"status": "idle"}

    # -- plan --------------------------------------------------------------------------------------------------
    def catalogue(self, source: str | DataFrame) -> DataFrame:
        """The catalogue with row_idx, ids as strings and path lists as arrays; CatalogueError for a bad one."""
        raw = tables.with_row_index(self.spark, source) if isinstance(source, str) else source if "row_idx" in source.columns else source.withColumn("row_idx", F.monotonically_increasing_id())
        errors = catalogue.missing_columns(raw.columns) or catalogue.range_errors(raw)
        if errors:
            raise catalogue.CatalogueError("; ".join(errors))
        for name, kind in (("diameter_pixel", "double"), ("diameter_arcsec", "double")):
            raw = raw.withColumn(name, F.nanvl(F.col(name).cast(kind), F.lit(None).cast(kind)) if name in raw.columns else F.lit(None).cast(kind))
        return catalogue.preprocessed(raw)

    def problems(self, rows: DataFrame) -> list[str]:
        """Why the files of rows (of catalogue()) cannot serve them: files that cannot be read, and sources sized in pixels whose files differ in scale.

        Every file's header is read once, by the tasks; files and conflicts are counted, and three of each named.
        """
        files = catalogue.distinct_files(rows).select("path").persist()
        heads = self.headers(files).select("path", "ext", "wcs").persist()
        out = []
        missing = files.join(heads.select("path").distinct(), "path", "left_anti")
        if n := missing.count():
            out.append(f"{n} files cannot be read: {', '.join(r['path'] for r in missing.orderBy('path').limit(3).collect())}")
        scales = heads.where(F.col("ext").isin(C.extension_names(self.config))).groupBy("path").agg(F.min(W.pixel_scale(F.col("wcs"))).alias("scale"))
        conflicts = catalogue.resolution_conflicts(rows, scales)
        if n := conflicts.count():
            out.append(f"{n} sources have a size in pixels and files of different scales: {', '.join(r['SourceID'] for r in conflicts.orderBy('SourceID').limit(3).collect())}")
        heads.unpersist()
        files.unpersist()
        return out

    def batched(self, rows: DataFrame, most: int | None = None) -> DataFrame:
        """rows with batch and batch_index by the sets of files that they share. Rows without files have none and are left out."""
        most = most or batching.max_sources(rows.count(), C.lookup(self.config, "loadbalancer.max_sources_per_process"))
        keyed = rows.where(F.size("fits_file_paths") > 0).withColumn("set_key", F.xxhash64("fits_file_paths"))
        sets = keyed.groupBy("set_key").agg(F.count(F.lit(1)).alias("n"), F.min("row_idx").alias("first"))
        large, rest = batching.batches(sets, most, key="set_key")
        out = batching.members(keyed, large, rest, most, "set_key", "row_idx")
        return batching.ranked(out, ["batch"], "row_idx", "batch_index").drop("set_key")

    def placed(self, rows: DataFrame) -> DataFrame:
        """A row for each source, file and selected extension on its tile, with bounds; tiles are known by headers alone."""
        names = C.extension_names(self.config)
        files = catalogue.distinct_files(rows).select("path")
        heads = self.headers(files).where(F.col("ext").isin(names))
        heads = heads.withColumn("ext_no", F.array_position(F.array(*[F.lit(n) for n in names]), F.col("ext")).cast("int") - 1)
        out = cutouts.on_tiles(rows, heads.drop("bitpix", *([] if self.config.get("user_flux_conversion_function") else ["header"])), float(self.config["padding_factor"]))
        return cutouts.keys(out).withColumn("channel_no", F.col("channel_no") * len(names) + F.col("ext_no"))

    def headers(self, files: DataFrame) -> DataFrame:
        """Headers of the files, each opened once, by the tasks; missing and broken files have none."""
        keyword = C.lookup(self.config, "flux_conversion_keywords.AB_zeropoint") or "MAGZERO"

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            reader = fits_source._HeaderReader({"path": "", "zeropoint": keyword})
            names = [x.split()[0] for x in ("path", "ext", "naxis1", "naxis2", "bitpix", "magzero", "header", "wcs")]
            for pdf in batches:
                rows = []
                for p in pdf["path"]:
                    try:
                        rows += list(reader.read(fits_source._File(p)))
                    except (OSError, ValueError, KeyError):
                        pass
                yield pd.DataFrame([(*r[:-1], dict(zip(("crpix1", "crpix2", "crval1", "crval2", "cd11", "cd12", "cd21", "cd22"), r[-1], strict=True))) for r in rows], columns=names)

        return files.mapInPandas(run, fits_source.HEADER)

    # -- images ------------------------------------------------------------------------------------------------
    def images(self, batched: DataFrame) -> DataFrame:
        """IMAGE rows: pixels read as windows, flux, resize, stack, mix, stretch and type, one row a source."""
        c = self.config
        raw_mode, flux = c["do_only_cutout_extraction"], c["apply_flux_conversion"]
        target, method = c["target_resolution"], c["normalisation_method"]
        fits_out, function = c["output_format"] == "fits", c.get("user_flux_conversion_function")
        weights = np.array(list(c["channel_weights"].values()), float).T
        norm, how, conserve, kind = c["normalisation"], c["interpolation"], c["flux_conserved_resizing"], c["data_type"]
        crop = (norm["crop_height"], norm["crop_width"]) if norm.get("crop_enable") else None
        placed = self.placed(batched)
        placed = placed.withColumn("original", cutouts.original_size(F.col("diameter_pixel"), F.col("diameter_arcsec"), F.col("scale"), fits_out))
        placed = placed.withColumn("channels", F.lit(weights.shape[1] if weights.ndim == 2 else 1))

        def one(pdf: pd.DataFrame) -> dict:
            first = pdf.iloc[0]
            planes, heads = [], []
            for r in pdf.itertuples(index=False):
                px = np.asarray(r.px, np.float64).reshape(r.n, r.n)
                if flux:
                    if function is not None:
                        px = function(px, {k: _number(v) for k, v in dict(r.header).items()} | {"MAGZERO": r.magzero})
                    elif r.magzero is None or r.magzero != r.magzero:
                        raise ValueError(f"no zero point in {r.path}")
                    else:
                        px = px * 10 ** (-0.4 * r.magzero) * 3631.0
                if not raw_mode:
                    px = kernels.resample_flux(px, target) if conserve else kernels.resize(px, target, how)
                factor = px.shape[0] / r.n
                to = px.shape[0] / r.original if r.original == r.original and r.original else 1.0
                w = dict(r.wcs if isinstance(r.wcs, dict) else r.wcs.asDict())
                heads.append({**{k: w[k] / factor for k in ("cd11", "cd12", "cd21", "cd22")}, "crval1": r.RA, "crval2": r.Dec, "crpix1": px.shape[1] / 2 + 0.5 + r.offset_x * to, "crpix2": px.shape[0] / 2 + 0.5 + r.offset_y * to})
                planes.append(px)
            if not raw_mode:
                full = np.zeros((max(weights.shape[1], int(pdf["channel_no"].max()) + 1), target, target))
                for no, px in zip(pdf["channel_no"], planes, strict=True):
                    full[int(no)] = px
                mixed = kernels.combined(full, weights)
                stretched = [kernels.stretch(m, method, norm.get("a"), norm["percentile"], norm["n_samples"], norm["contrast"], crop) for m in mixed]
                planes = [kernels.converted(s, kind) for s in stretched]
                heads = heads[:1] * len(planes)
            scale = planes[0].shape[0] / first.original if first.original == first.original and first.original else 1.0
            meta = {k: getattr(first, k) for k in ("SourceID", "RA", "Dec", "diameter_pixel", "diameter_arcsec", "row_idx", "batch", "batch_index")}
            return meta | {"size": planes[0].shape[0], "images": [p.astype(np.float32).ravel() for p in planes], "wcs": heads, "channel_keys": list(pdf["channel_key"]), "original_cutout_size": first.original, "rescaled_offset_x": first.offset_x * scale, "rescaled_offset_y": first.offset_y * scale}

        names = [f.split(" ")[0] for f in IMAGE.split(", ")]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = None  # rows of a source that an Arrow batch cuts wait for the next
            for pdf in batches:
                held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
                last = (held["batch"] == held["batch"].iloc[-1]) & (held["row_idx"] == held["row_idx"].iloc[-1]) if len(held) else None
                if last is not None and not last.all():
                    done, held = held[~last], held[last].reset_index(drop=True)
                    edges = np.flatnonzero(np.concatenate([[True], (done["row_idx"].to_numpy()[1:] != done["row_idx"].to_numpy()[:-1]) | (done["batch"].to_numpy()[1:] != done["batch"].to_numpy()[:-1]), [True]]))
                    for k in range(0, len(edges) - 1, 200):
                        yield pd.DataFrame([one(done.iloc[a:b]) for a, b in zip(edges[k : k + 200], edges[k + 1 : k + 201], strict=False)], columns=names)
            if held is not None and len(held):
                yield pd.DataFrame([one(held)], columns=names)

        rows = fits_source.with_pixels(placed.drop("size")).repartition("batch", "row_idx").sortWithinPartitions("batch", "row_idx", "channel_no")
        return rows.mapInPandas(run, IMAGE)

    # -- runs --------------------------------------------------------------------------------------------------
    def run(self, source: str | DataFrame | None = None, skip_fits_check: bool = False) -> dict[str, Any]:
        """Write all cutouts, metadata and the mapping; a failure is reported in the result, not raised.

        A catalogue that is given by path is held against its files first (problems()) unless skip_fits_check.

        Sources of which no image was written, because they lie off their tiles or have no file that can be read, count as failed.
        """
        self.started = time.time()
        try:
            C.validated_for_processing(dict(self.config) | {"source_catalogue": source if isinstance(source, str) else self.config.get("source_catalogue") or "frame"})
            source = self.config["source_catalogue"] if source is None else source
            self.spark.sparkContext.setJobGroup(self.group, "cutouts", True)
            whole = self.catalogue(source)
            if isinstance(source, str) and not skip_fits_check and (errors := self.problems(whole)):
                raise catalogue.CatalogueError("; ".join(errors))
            rows = self.batched(whole).persist()
            root, total = self.config["output_dir"], whole.count()
            self._tell(status="running", total_sources=total)
            out = self.images(rows)
            if self.config["output_format"] == "fits":
                named = out.withColumn("file_name", P.fits_file_name(F.col("SourceID"), F.col("RA"), F.col("Dec")))
                channels = list(self.config["channel_weights"]) if self.config["do_only_cutout_extraction"] else None
                written = sinks.write_fits(named, root, "float32" if self.config["do_only_cutout_extraction"] else self.config["data_type"], self.config["normalisation_method"], channels)
                mapping = f"{root}/source_to_fits_mapping.parquet"
                sinks.write_mapping(written, mapping)
                done = self.spark.read.parquet(mapping).where("error is null").count()
            else:
                n = len(next(iter(self.config["channel_weights"].values())))
                mapping = f"{root}/source_to_zarr_mapping.parquet"
                # images are written as the mapping is: one pass, and no source in it that has none
                sinks.write_mapping(cutouts.mapping(sinks.write_arrays(out, root, self.config["target_resolution"], n, self.config["data_type"])), mapping)
                done = self.spark.read.parquet(mapping).count()
            batches = rows.select("batch").distinct().count()
            self._tell(status="completed", completed_sources=done, failed_sources=total - done, mapping_parquet=mapping, completed_batches=batches)
            rows.unpersist()
        except Exception as e:  # the caller gets a report, as a batch job's
            self._tell(status="failed", error=str(e), error_type=type(e).__name__)
        return self.status

    def _tell(self, **change: Any) -> None:
        self.status = self.status | change | {"start_time": self.started, "elapsed": time.time() - (self.started or time.time())}
        if self.panel is not None:
            self.panel.receive_status_UI_update(self.status)

    def get_progress(self) -> dict[str, Any]:
        """The last report, with Spark's finished and all tasks of the running job."""
        tracker = self.spark.sparkContext.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(self.group) if (i := tracker.getJobInfo(j)) for k in i.stageIds if (s := tracker.getStageInfo(k))]
        return self.status | {"tasks": sum(s.numTasks for s in stages), "tasks_done": sum(s.numCompletedTasks for s in stages)}

    def stop(self) -> None:
        self.spark.sparkContext.cancelJobGroup(self.group)
        self._tell(status="stopped")

    def can_resume(self, mapping: str) -> bool:
        """Whether a mapping is there that says what is done."""
        try:
            return self.spark.read.parquet(mapping).limit(1).count() > 0
        except Exception:
            return False

    def previews(self, source: str | DataFrame, n: int = 10, size: int = 256) -> DataFrame:
        """IMAGE rows of n sources from the upper half by size of the most common set, resized to `size`."""
        rows = preview.picks(self.catalogue(source), "row_idx", "diameter_pixel", n).withColumn("batch", F.lit(0).cast("long")).withColumn("batch_index", F.col("row_idx"))
        over = {"target_resolution": size}
        if self.config["do_only_cutout_extraction"]:
            over = {"target_resolution": 500, "do_only_cutout_extraction": False, "normalisation_method": "linear", "interpolation": "nearest"}
        elif self.config["flux_conserved_resizing"] or self.config["normalisation_method"] == "none":
            over["normalisation_method"] = "linear"
        return CutoutJob(self.spark, dict(self.config) | over).images(rows)
