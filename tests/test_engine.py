"""Files, jobs, batches, settings."""

import json
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyquilt import CutoutJob, CutoutStream, create_config, load_toml, save_toml
from skyquilt.operators import batching, catalogue, preview
from skyquilt.sources import catalogue as tables
from skyquilt.sources import config as C
from skyquilt.sources import fits, fits_source, sinks

WCS = {"crpix1": 50.5, "crpix2": 50.5, "crval1": 180.0, "crval2": 0.0, "cd11": -1e-4, "cd12": 0.0, "cd21": 0.0, "cd22": 1e-4}


@pytest.fixture(scope="module")
def sky(spark, tmp_path_factory):
    """Two tiles of 100 x 100 pixels, a catalogue of 20 sources over them, one of them off the tile."""
    d = str(tmp_path_factory.mktemp("sky"))
    rng = np.random.default_rng(1)
    images = {}
    for band, zero in (("VIS", 25.0), ("NIR-H", 24.0)):
        images[band] = rng.normal(5, 1, (100, 100)).astype(np.float32)
        with open(f"{d}/{band}.fits", "wb") as f:
            f.write(fits.image_hdu(images[band], [*fits.wcs_cards(WCS), ("MAGZERO", zero)], primary=True))
    rows = [(f"s{i:02d}", 180.0 + (i - 10) * 3e-4 + (5.0 if i == 19 else 0), (i - 10) * 2e-4, 9 + i % 4, None, f"['{d}/VIS.fits', '{d}//NIR-H.fits']") for i in range(20)]
    cat = spark.createDataFrame(rows, "SourceID string, RA double, Dec double, diameter_pixel int, diameter_arcsec double, fits_file_paths string")
    cat.coalesce(1).write.parquet(f"{d}/cat.parquet")
    cat.coalesce(1).write.option("header", True).csv(f"{d}/cat.csv")
    return d, images


def config(d, **more):
    return create_config({"output_dir": f"{d}/out", "source_catalogue": f"{d}/cat.parquet", "target_resolution": 16, "selected_extensions": ["PRIMARY"], "channel_weights": {"VIS": [1.0, 0.5], "NIR-H": [0.0, 0.5]}} | more)


def test_job_writes_arrays_metadata_and_mapping(spark, sky):
    d, _ = sky
    done = CutoutJob(spark, config(d)).run()
    assert done["status"] == "completed", done
    assert done["completed_sources"] == 19  # one is off the tile
    a = sinks.read_array(f"{d}/out/batch_000/images.zarr")
    assert a.shape == (19, 16, 16, 2) and a.min() >= 0 and a.max() <= 1
    assert done["total_sources"] == 20 == done["completed_sources"] + done["failed_sources"]
    found = {r["SourceID"]: r for r in spark.read.parquet(f"{d}/out/source_to_zarr_mapping.parquet").collect()}
    assert set(found) == {f"s{i:02d}" for i in range(19)} and {r["batch_index"] for r in found.values()} == {0}
    meta = {r["SourceID"]: r["idx_in_zarr"] for r in spark.read.parquet(f"{d}/out/batch_000/images_metadata.parquet").collect()}
    assert meta == {k: r["idx_in_zarr"] for k, r in found.items()}


def test_a_source_is_found_in_its_own_place(spark, sky):
    """Sources off the tile, at the catalogue's start too, move no other's place."""
    d, _ = sky
    rows = [(i, f"t{i}", 180.0 + (5.0 if i in (0, 3, 6) else (i - 5) * 1e-4), 0.0, 5 + 2 * i, f"{d}/VIS.fits") for i in range(10)]
    cat = spark.createDataFrame(rows, "row_idx long, SourceID string, RA double, Dec double, diameter_pixel int, fits_file_paths string")
    done = CutoutJob(spark, config(d, output_dir=f"{d}/place", channel_weights={"VIS": [1.0]}, do_only_cutout_extraction=False)).run(cat)
    assert (done["total_sources"], done["completed_sources"], done["failed_sources"]) == (10, 7, 3), done
    meta = {r["idx_in_zarr"]: r for r in spark.read.parquet(f"{d}/place/batch_000/images_metadata.parquet").collect()}
    for r in spark.read.parquet(done["mapping_parquet"]).collect():
        assert meta[r["idx_in_zarr"]]["SourceID"] == r["SourceID"]
        assert meta[r["idx_in_zarr"]]["diameter_pixel"] == 5 + 2 * int(r["SourceID"][1:])


def test_raw_cutouts_hold_the_tile_pixels(spark, sky):
    d, images = sky
    c = config(d, output_dir=f"{d}/raw", output_format="fits", do_only_cutout_extraction=True, apply_flux_conversion=False, channel_weights={"VIS": [1.0], "NIR-H": [0.0]})
    assert CutoutJob(spark, c).run()["status"] == "completed"
    with open(f"{d}/raw/s10_180.000000_0.000000_cutout.fits", "rb") as f:
        found = {name: (h, fits.window(f, h, at, 0, h["NAXIS2"], 0, h["NAXIS1"])) for _, name, h, at in list(fits.extensions(f))[1:]}
    h, px = found["VIS"]
    n = 9 + 10 % 4
    start = int(49.5 - n // 2)
    assert np.array_equal(px, images["VIS"][start : start + n, start : start + n])
    assert h["CRVAL1"] == 180.0 and set(found) == {"VIS", "NIR-H"}
    again = CutoutJob(spark, c).run()
    assert again["failed_sources"] == 20  # files are there already, and one is off the tile


def test_failures_are_reported(spark, sky):
    d, _ = sky
    assert CutoutJob(spark, config(d, selected_extensions=[])).run()["error_type"] == "ConfigError"
    assert CutoutJob(spark, config(d)).run(f"{d}/nothing.parquet")["status"] == "failed"


def test_files_are_checked_before_a_run(spark, sky):
    d, images = sky
    with open(f"{d}/coarse.fits", "wb") as f:
        f.write(fits.image_hdu(images["VIS"], [*fits.wcs_cards(WCS | {"cd11": -3e-4, "cd22": 3e-4}), ("MAGZERO", 25.0)], primary=True))
    of = lambda name, files: spark.createDataFrame([("a", 180.0, 0.0, 9, files), ("b", 180.0, 0.0, 9, f"{d}/VIS.fits")], "SourceID string, RA double, Dec double, diameter_pixel int, fits_file_paths string").write.mode("overwrite").parquet(f"{d}/{name}")
    of("lost.parquet", f"['{d}/VIS.fits', '{d}/nowhere.fits']")
    of("scales.parquet", f"['{d}/VIS.fits', '{d}/coarse.fits']")
    job = CutoutJob(spark, config(d, output_dir=f"{d}/checked"))
    found = job.run(f"{d}/lost.parquet")
    assert found["error_type"] == "CatalogueError" and "nowhere.fits" in found["error"] and "scale" not in found["error"]
    found = job.run(f"{d}/scales.parquet")
    assert found["error_type"] == "CatalogueError" and "1 sources" in found["error"] and "scales: a" in found["error"]
    assert job.run(f"{d}/lost.parquet", skip_fits_check=True)["status"] == "completed"


def test_flux_function_gets_the_header(spark, sky):
    d, images = sky
    c = config(d, output_dir=f"{d}/own", output_format="fits", do_only_cutout_extraction=True, apply_flux_conversion=True, channel_weights={"VIS": [1.0], "NIR-H": [0.0]}, user_flux_conversion_function=lambda px, header: px * 0 + header["CRPIX1"] + header["NAXIS2"])
    done = CutoutJob(spark, c).run()
    assert done["status"] == "completed", done
    with open(f"{d}/own/s10_180.000000_0.000000_cutout.fits", "rb") as f:
        parts = list(fits.extensions(f))
        name, h, at = parts[1][1:]
        assert np.all(fits.window(f, h, at, 0, h["NAXIS2"], 0, h["NAXIS1"]) == 150.5)
        assert parts[0][2]["PROCTIME"] > 1.6e9


def test_stream_gives_every_source_once(spark, sky):
    d, _ = sky
    for synchronised in (True, False):
        s = CutoutStream(CutoutJob(spark, config(d)))
        with pytest.raises(RuntimeError):
            s.get_batch(0)
        assert s.init_streaming(f"{d}/cat.parquet", 7, synchronised) == 3 == s.get_batch_count()
        seen = [m["SourceID"] for b in s for m in b["metadata"]]
        assert sorted(seen) == [f"s{i:02d}" for i in range(19)]
        with pytest.raises(IndexError):
            s.next_batch()
        assert s.get_batch(1)["cutouts"].shape[1:] == (16, 16, 2)
        s.cleanup()


def test_previews(spark, sky):
    d, _ = sky
    rows = CutoutJob(spark, config(d)).previews(f"{d}/cat.parquet", 3, 32).collect()
    assert 0 < len(rows) <= 3 and all(r["size"] == 32 for r in rows)


def test_catalogue_sources_agree(spark, sky):
    d, _ = sky
    a, b = (tables.with_row_index(spark, f"{d}/cat.{k}").orderBy("row_idx").collect() for k in ("parquet", "csv"))
    assert [(r["row_idx"], r["SourceID"], r["RA"]) for r in a] == [(r["row_idx"], r["SourceID"], r["RA"]) for r in b] and [r["row_idx"] for r in a] == list(range(20))
    assert tables.estimated_rows(spark, f"{d}/cat.parquet") == 20 and abs(tables.estimated_rows(spark, f"{d}/cat.csv") - 20) <= 2
    assert [r["SourceID"] for r in tables.rows_at(tables.with_row_index(spark, f"{d}/cat.parquet"), [7, 3, 7]).collect()] == ["s07", "s03", "s07"]
    with pytest.raises(ValueError, match="unsupported"):
        tables.load(spark, "x.txt")


def test_fits_table_catalogue(spark, tmp_path):
    path = str(tmp_path / "t.fits")
    with open(path, "wb") as f:
        f.write(fits.image_hdu(None, primary=True) + fits.table_hdu({"OBJECT_ID": [1, 2, 3], "RIGHT_ASCENSION": [1.0, 2.0, 3.0], "DECLINATION": [0.0, 0.5, 1.0], "SEGMENTATION_AREA": [50.0, 500.0, 100.0], "NAME": ["a", "bb", "ccc"], "OK": [True, False, True]}))
    rows = tables.load(spark, path).orderBy("OBJECT_ID").collect()
    assert [(r["OBJECT_ID"], r["NAME"], r["OK"]) for r in rows] == [(1, "a", True), (2, "bb", False), (3, "ccc", True)]
    assert [r["SourceID"] for r in tables.survey_catalogue(spark, path, 60, 1).collect()] == ["2"]


def test_fits_headers_and_inspection(spark, sky, tmp_path):
    d, _ = sky
    heads = fits_source.headers(spark, d).collect()
    assert sorted(r["magzero"] for r in heads) == [24.0, 25.0] and heads[0]["wcs"]["cd22"] == 1e-4
    (tmp_path / "bad.fits").write_bytes(b"nothing")
    got = {os.path.basename(r["path"]): r for r in fits_source.inspected(spark.createDataFrame([(f"{d}/VIS.fits",), (str(tmp_path / "bad.fits"),), ("/none.fits",)], "path string")).collect()}
    assert got["VIS.fits"]["error"] is None and got["VIS.fits"]["extensions"][0]["type"] == "PrimaryHDU"
    assert got["bad.fits"]["error"] and got["none.fits"]["error"]


@pytest.mark.parametrize("kind", ["u1", "i2", "i4", "f4", "f8", "u2"])
def test_images_survive_fits(kind):
    x = (np.random.default_rng(3).random((7, 5)) * 200).astype(kind)
    f = fits.from_bytes(fits.image_hdu(x, [("NOTE", "it's"), ("N", 3), ("R", 2.5), ("B", True)], primary=True))
    ((_, _, h, at),) = fits.extensions(f)
    assert np.array_equal(fits.window(f, h, at, 1, 6, 2, 5), x[1:6, 2:5]) and (h["NOTE"], h["N"], h["R"], h["B"]) == ("it's", 3, 2.5, True)


def greedy(sizes, most, least, sets):
    out, b, cur, n = [], 0, 0, 0
    for s in sizes:
        if n and (cur + s > most or n + 1 > sets):
            b, cur, n = b + 1, 0, 0
        out.append(b)
        cur, n = cur + s, n + 1
        if cur >= least:
            b, cur, n = b + 1, 0, 0
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=40), st.integers(60, 200), st.integers(1, 300), st.integers(1, 9))
def test_runs_follow_the_greedy_rule(sizes, most, least, sets):
    sizes = sorted(sizes, reverse=True)
    runs = [(s, sizes.count(s)) for s in sorted(set(sizes), reverse=True)]
    found = [r["open"] if i < r["head"] else r["start"] + (i - r["head"]) // r["period"] for (_, n), r in zip(runs, batching.plan_runs(runs, most, least, sets), strict=True) for i in range(n)]
    assert found == greedy(sizes, most, least, sets)


def test_batch_sizes():
    assert batching.max_sources(999_999) == 12_500 and batching.max_sources(1_000_000) == 100_000 and batching.max_sources(10, 77) == 77


def test_catalogue_errors(spark):
    assert catalogue.missing_columns(["SourceID", "RA"]) == ["missing column Dec", "missing column fits_file_paths", "missing a size column: diameter_pixel or diameter_arcsec"]
    bad = spark.createDataFrame([("a", 361.0, 0.0, 5), ("b", 1.0, None, 0), ("c", 1.0, 1.0, 7)], "SourceID string, RA double, Dec double, diameter_pixel int")
    assert catalogue.range_errors(bad) == ["1 values of RA are outside [0, 360]", "1 values of Dec are null", "1 values of diameter_pixel are outside (0, 10000]"]
    assert catalogue.channel_order_errors(["VIS", "H"], ["X_VIS", "X_H"]) == [] and catalogue.channel_order_errors(["VIS", "H"], ["X_H", "X_VIS"])
    assert catalogue.extension_order_errors(["a_VIS.fits", "a_NIR-H.fits"], ["NIR-H", "VIS"]) and not catalogue.extension_order_errors(["a_VIS.fits"], ["VIS"])


def test_preview_picks_are_bounded(spark):
    c = spark.range(3000).select(F.col("id").alias("row_idx"), (F.col("id") % 50).alias("size"), F.array(F.concat(F.lit("f"), F.col("id") % 3)).alias("fits_file_paths"))
    got = preview.picks(c, "row_idx", "size", 10).collect()
    assert len(got) == 10 and all(r["size"] >= 24 for r in got) and len({tuple(r["fits_file_paths"]) for r in got}) == 1


def test_settings_round_trip(tmp_path):
    c = create_config({"target_resolution": 64, "channel_weights": {"b": [1.0], "a": [0.5]}, "user_flux_conversion_function": lambda i, h: i})
    back = load_toml(save_toml(c, str(tmp_path / "c.toml")))
    assert back["target_resolution"] == 64 and list(back["channel_weights"]) == ["b", "a"] and back["user_flux_conversion_function"] is None
    assert os.path.basename(C.save_with_timestamp(c, str(tmp_path))).startswith("skyquilt_config_")


@pytest.mark.parametrize("change", [{"target_resolution": 5}, {"output_format": "png"}, {"padding_factor": "x"}, {"channel_weights": {}}, {"channel_weights": {"a": [1], "b": [1, 2]}}, {"do_only_cutout_extraction": True}, {"user_flux_conversion_function": lambda x: x}, {"write_to_disk": 1}])
def test_bad_settings(change):
    with pytest.raises(C.ConfigError):
        C.validated(create_config(change))


def test_unexpected_settings_only_warn():
    assert C.unexpected(create_config({"novel": 1})) == ["novel"] and C.validated(create_config({"novel": 1}))
    assert C.extension_names({"selected_extensions": [{"name": "PrimaryHDU"}, "SCI"]}) == ["PRIMARY", "SCI"] and C.extension_names({}) == ["PRIMARY"]


def test_progress_records(spark, tmp_path):
    d = str(tmp_path / "p")
    sinks.write_progress(d, {"process_id": "a", "status": "running", "total_sources": 10, "completed_sources": 4})
    with open(f"{d}/progress_b.json", "w") as f:
        f.write("{broken")
    assert [r["process_id"] for r in sinks.read_progress(spark, d).collect()] == ["a"]
    (tmp_path / "log").write_text('x PERFORMANCE_DATA: {"a": 1.5, "b": 2}\nnoise\nPERFORMANCE_DATA: {"a": 0.5}\n')
    assert {r["step"]: r["seconds"] for r in sinks.read_performance(spark, str(tmp_path / "log")).collect()} == {"a": 2.0, "b": 2.0}
    (tmp_path / "ev.jsonl").write_text(json.dumps({"timestamp": 1.0, "category": "Spawn", "event_type": "decision", "data": {"can_spawn": "true"}}) + "\n")
    assert sinks.read_events(spark, str(tmp_path / "ev.jsonl")).first()["data"] == {"can_spawn": "true"}


def test_new_catalogue_files_are_handed_over_once(spark, tmp_path):
    from skyquilt.streaming.progress import follow_catalogues

    seen = []
    folder, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    for k in range(2):
        spark.range(k * 3, k * 3 + 3).coalesce(1).write.mode("append").parquet(folder)
        follow_catalogues(spark, folder, "id long", lambda df, _: seen.extend(r["id"] for r in df.collect()), mark)
    assert sorted(seen) == list(range(6))
