"""SQL for the engine's queries, in DuckDB's dialect; relations are derived here independently of the Spark code."""

from __future__ import annotations

_CAT = """
    li AS (SELECT *, CAST(l_quantity AS BIGINT) AS q, l_suppkey % 10 AS k FROM lineitem),
    cat AS (SELECT 'SRC_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || q AS SourceID,
            150 + (l_partkey % 1000) * CAST(1e-5 AS DOUBLE) AS RA, 2 + (l_orderkey % 1000) * CAST(1e-5 AS DOUBLE) AS "Dec",
            CASE WHEN l_linenumber % 3 <> 0 THEN CAST(1 + q % 8 AS INT) END AS diameter_pixel,
            CASE WHEN l_linenumber % 3 = 0 THEN CAST(4 + q % 30 AS DOUBLE) END AS diameter_arcsec,
            k, l_orderkey, l_partkey, l_suppkey, l_linenumber,
            CASE WHEN l_partkey % 97 = 0 THEN CAST([] AS VARCHAR[]) WHEN l_linenumber % 5 = 0 THEN ['/t/vis_' || k || '.fits']
                 ELSE ['/t/vis_' || k || '.fits', '/t/nir_h_' || k || '.fits'] END AS files FROM li)"""

_FILES = _CAT + """,
    fl AS (SELECT *, files[channel_no + 1] AS path FROM (SELECT *, unnest(range(len(files))) AS channel_no FROM cat)),
    tiles AS (SELECT '/t/' || CASE c WHEN 0 THEN 'vis_' ELSE 'nir_h_' END || k || '.fits' AS path, 24 + k * CAST(0.5 AS DOUBLE) + c * CAST(0.25 AS DOUBLE) AS magzero
              FROM range(10) t(k), range(2) u(c))"""

_XY = """
    ang AS (SELECT fl.*, radians(RA - 150.005) AS a, radians("Dec") AS d, radians(CAST(2.005 AS DOUBLE)) AS d0, magzero FROM fl JOIN tiles USING (path)),
    dep AS (SELECT *, sin(d0) * sin(d) + cos(d0) * cos(d) * cos(a) AS depth FROM ang),
    pln AS (SELECT *, degrees(cos(d) * sin(a) / depth) AS xi, degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(a)) / depth) AS eta,
            CAST(-0.00125 AS DOUBLE) AS cd11, CAST(0.00125 AS DOUBLE) AS cd22 FROM dep),
    xy AS (SELECT *, 4.5 - 1 + (cd22 * xi - 0 * eta) / (cd11 * cd22) AS x, 4.5 - 1 + (cd11 * eta - 0 * xi) / (cd11 * cd22) AS y, sqrt(abs(cd11 * cd22)) * 3600 AS scale FROM pln)"""


def _placed(padding: str = "1.0") -> str:
    return f"""{_FILES},{_XY},
    sz AS (SELECT *, CAST(trunc(coalesce(diameter_pixel, greatest(1, CAST(round_even(diameter_arcsec / scale, 0) AS INT)), 128) * CAST({padding} AS DOUBLE)) AS INT) AS n FROM xy),
    bd AS (SELECT *, CAST(trunc(x - n // 2) AS INT) AS x_min, CAST(trunc(x + (n - n // 2)) AS INT) AS x_max, CAST(trunc(y - n // 2) AS INT) AS y_min, CAST(trunc(y + (n - n // 2)) AS INT) AS y_max FROM sz),
    cl AS (SELECT *, greatest(0, x_min) AS cx_min, least(8, x_max) AS cx_max, greatest(0, y_min) AS cy_min, least(8, y_max) AS cy_max FROM bd),
    vd AS (SELECT *, cx_max > cx_min AND cy_max > cy_min AS valid FROM cl),
    pl AS (SELECT *, (n - (cx_max - cx_min)) // 2 AS pad_x, (n - (cy_max - cy_min)) // 2 AS pad_y, x - (x_min + n / CAST(2 AS DOUBLE)) - (n - (cx_max - cx_min)) // 2 AS offset_x,
           y - (y_min + n / CAST(2 AS DOUBLE)) - (n - (cy_max - cy_min)) // 2 AS offset_y FROM vd WHERE valid)"""


_PX = """,
    rk AS (SELECT label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS c FROM embeddings),
    px AS (SELECT '/t/' || CASE c WHEN 1 THEN 'vis_' ELSE 'nir_h_' END || label || '.fits' AS path, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM rk WHERE c <= 2),
    cell AS (SELECT pl.*, i // 8 - cy_min AS ry, i % 8 - cx_min AS rx, i // 8 AS ty, i % 8 AS tx, v FROM pl JOIN px USING (path) WHERE i // 8 >= cy_min AND i // 8 < cy_max AND i % 8 >= cx_min AND i % 8 < cx_max)"""

_IMG = "e AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS px FROM embeddings), p AS (SELECT vec_id, unnest(range(64)) AS i, unnest(px) AS v FROM e)"
_UNIT = _IMG + ", r AS (SELECT vec_id, min(v) AS lo, max(v) AS hi FROM p GROUP BY 1), u AS (SELECT vec_id, i, CASE WHEN hi > lo THEN (v - lo) / (hi - lo) ELSE 0 END AS x FROM p JOIN r USING (vec_id))"
_NAMES = """nm AS (SELECT doc_id, '/d/' || source || '/EUC_' || ['VIS', 'NIR-Y', 'NIRH', 'nir_j', 'NIR-H-STACK', 'a_Y_1', 'xJ', 'h', 'KHZ', 'none'][doc_id % 10 + 1]
            || CASE WHEN doc_id % 4 = 0 THEN '-PLAIN.fits' ELSE '_TILE' || (doc_id // 8) % 50 || '-AB.fits' END AS path FROM documents),
    up AS (SELECT doc_id, path, upper(regexp_extract(path, '[^/]+$')) AS b FROM nm),
    bn AS (SELECT doc_id, path, CASE WHEN contains(b, 'VIS') THEN 'VIS' WHEN regexp_matches(b, 'NIR-?Y') THEN 'NIR-Y' WHEN regexp_matches(b, 'NIR-?H') THEN 'NIR-H'
            WHEN regexp_matches(b, 'NIR-?J') THEN 'NIR-J' WHEN contains(b, 'NIR_H') THEN 'NIR-H' WHEN contains(b, 'NIR_Y') THEN 'NIR-Y' WHEN contains(b, 'NIR_J') THEN 'NIR-J'
            WHEN regexp_matches(b, '(^|[^A-Z])Y([^A-Z]|$)') THEN 'Y' WHEN regexp_matches(b, '(^|[^A-Z])J([^A-Z]|$)') THEN 'J' WHEN regexp_matches(b, '(^|[^A-Z])H([^A-Z]|$)') THEN 'H' ELSE 'UNKNOWN' END AS band FROM up),
    tb AS (SELECT regexp_extract(path, 'TILE([^-]+)-', 1) AS tile, min(path) FILTER (band = 'VIS') AS vis, min(path) FILTER (band = 'NIR-Y') AS nir_y, min(path) FILTER (band = 'NIR-H') AS nir_h,
            min(path) FILTER (band = 'NIR-J') AS nir_j, min(path) FILTER (band = 'J') AS j FROM bn WHERE regexp_extract(path, 'TILE([^-]+)-', 1) <> '' GROUP BY 1)"""
_STACK = """e AS (SELECT vec_id // 3 AS source, vec_id % 3 AS c, embedding FROM embeddings WHERE vec_id % 7 <> 0), q AS (SELECT source, c, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM e)"""
_PROG = """lst AS (SELECT user_id, count(*) AS n, max_by(event_type, (ts, event_id)) AS et, max_by(value, (ts, event_id)) AS v, max(ts) AS t FROM events GROUP BY 1),
    pr AS (SELECT user_id AS process_id, CASE WHEN et = 'purchase' THEN 'completed' ELSE 'processing' END AS status, n * 10 AS total_sources, CASE WHEN user_id % 4 = 0 THEN n * 10 ELSE n * 7 END AS completed_sources,
            user_id % 3 AS failed_sources, CASE WHEN user_id % 4 = 0 THEN 100.0 ELSE 70.0 END AS pct, round(v, 3) AS mb, CAST(floor(epoch(t)) AS BIGINT) AS last_update, CASE WHEN user_id % 11 = 0 THEN 1 ELSE 0 END AS errors, user_id % 2 AS warnings FROM lst),
    pd AS (SELECT *, status = 'completed' OR (total_sources > 0 AND completed_sources >= total_sources) OR pct >= 100 AS done FROM pr)"""
_SETS = """o AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN -1 ELSE o_custkey END AS set_key FROM orders),
    s AS (SELECT set_key, count(*) AS n, min(o_orderkey) AS first FROM o GROUP BY 1)"""
_STEPS = "st AS (SELECT event_type AS step, CAST(round(value * 100) AS BIGINT) AS seconds FROM events), ag AS (SELECT step, count(*) AS n, sum(seconds) AS total, avg(seconds) AS mean, min(seconds) AS least, max(seconds) AS greatest FROM st GROUP BY 1), pc AS (SELECT *, total * 100.0 / sum(total) OVER () AS percent FROM ag)"
_HASH = "(({k}) * 2654435761 + 42) % 4294967296"

ORACLES = {
    "parse_paths": f"WITH {_CAT} SELECT SourceID, len(files) AS n_paths, array_to_string(files, '|') AS paths FROM cat",
    "path_normalisation": "SELECT doc_id, '/a/' || source || '/' || lang || '/' || doc_id || '.fits' AS path FROM documents",
    "filter_name": f"WITH {_NAMES} SELECT doc_id, band FROM bn",
    "channel_keys": f"WITH {_NAMES} SELECT doc_id, regexp_replace(regexp_extract(path, '[^/]+$'), '[.]fits$', '') || CASE WHEN doc_id % 3 = 0 THEN '_SCI' ELSE '' END AS channel_key FROM nm",
    "source_id_cast": "SELECT CAST(o_orderkey AS VARCHAR) AS SourceID, length(CAST(o_orderkey AS VARCHAR)) AS n FROM orders",
    "row_index": "SELECT o_orderkey, o_custkey % 7 AS part, row_number() OVER (PARTITION BY o_custkey % 7 ORDER BY o_orderkey) - 1 AS row_idx FROM orders",
    "row_semi_join": "SELECT 1000000 - s_suppkey AS place, o_orderkey, o_custkey FROM supplier JOIN orders ON o_orderkey = s_suppkey * 7",
    "fits_set_index": f"WITH {_CAT} SELECT array_to_string(files, '|') AS paths, count(*) AS n, min(l_orderkey) AS first FROM cat WHERE len(files) > 0 GROUP BY 1",
    "set_stats": f"WITH {_CAT}, s AS (SELECT files, count(*) AS n FROM cat WHERE len(files) > 0 GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS total_sources, count(*) AS unique_sets, round(avg(n), 6) AS avg_sources, max(n) AS max_sources, min(n) AS min_sources FROM s",
    "greedy_batches": f"""WITH RECURSIVE {_SETS},
        big AS (SELECT set_key, n, (n + 999) // 1000 AS chunks, coalesce(sum((n + 999) // 1000) OVER (ORDER BY n DESC, first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM s WHERE n > 1000),
        used AS (SELECT coalesce(sum(chunks), 0) AS b FROM big),
        rn AS (SELECT set_key, n, row_number() OVER (ORDER BY n DESC, first) AS i FROM s WHERE n <= 1000),
        walk AS (SELECT i, set_key, CAST(0 AS BIGINT) AS b, n AS cur, 1 AS cnt FROM rn WHERE i = 1
            UNION ALL SELECT rn.i, rn.set_key, CASE WHEN cur >= 500 OR cur + rn.n > 1000 OR cnt + 1 > 50 THEN b + 1 ELSE b END, CASE WHEN cur >= 500 OR cur + rn.n > 1000 OR cnt + 1 > 50 THEN rn.n ELSE cur + rn.n END,
            CASE WHEN cur >= 500 OR cur + rn.n > 1000 OR cnt + 1 > 50 THEN 1 ELSE cnt + 1 END FROM walk JOIN rn ON rn.i = walk.i + 1)
        SELECT o_orderkey, o.set_key, CAST(b + (SELECT b FROM used) AS BIGINT) AS batch FROM o JOIN walk USING (set_key)
        UNION ALL SELECT o_orderkey, o.set_key, CAST(start + (row_number() OVER (PARTITION BY o.set_key ORDER BY o_orderkey) - 1) // 1000 AS BIGINT) FROM o JOIN big USING (set_key)""",
    "split_oversized": "SELECT o_orderkey, o_orderstatus AS status, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 700 AS chunk FROM orders",
    "sub_batches": f"WITH {_SETS} SELECT o_orderkey, set_key, (row_number() OVER (PARTITION BY set_key ORDER BY o_orderkey) - 1) // 5 AS sub_batch FROM o",
    "set_members": f"WITH {_CAT} SELECT l_orderkey % 4 AS batch, array_to_string(files, '|') AS paths, count(*) AS n FROM cat WHERE len(files) > 0 GROUP BY 1, 2",
    "range_validation": """WITH o AS (SELECT o_totalprice / 1000 AS ra, o_totalprice / 2000 - 120 AS de, o_orderkey % 12000 - 500 AS dp, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice / 100 END AS da FROM orders)
        SELECT count(*) FILTER (ra > 360 OR ra < 0) AS "RA_out_of_range", count(*) FILTER (ra IS NULL) AS "RA_null", count(*) FILTER (de > 90 OR de < -90) AS "Dec_out_of_range", count(*) FILTER (de IS NULL) AS "Dec_null",
        count(*) FILTER (dp > 10000 OR dp <= 0) AS diameter_pixel_out_of_range, count(*) FILTER (dp IS NULL) AS diameter_pixel_null, count(*) FILTER (da > 3600 OR da <= 0) AS diameter_arcsec_out_of_range, count(*) FILTER (da IS NULL) AS diameter_arcsec_null FROM o""",
    "column_validation": "SELECT count(*) FILTER (try_cast(p_brand AS DOUBLE) IS NULL) AS p_brand_not_numeric, count(*) FILTER (try_cast(split_part(p_brand, '#', 2) AS DOUBLE) IS NULL) AS brand_no_not_numeric, count(*) FILTER (try_cast(CAST(p_retailprice AS VARCHAR) AS DOUBLE) IS NULL) AS price_not_numeric FROM part",
    "resolution_ratio": f"""WITH {_CAT} SELECT SourceID, round(abs(4.5 * (1 + (k % 3) * CAST(0.00007 AS DOUBLE)) / CAST(4.5 AS DOUBLE) - 1), 9) AS spread FROM cat
        WHERE diameter_pixel IS NOT NULL AND len(files) > 1 AND abs(4.5 * (1 + (k % 3) * CAST(0.00007 AS DOUBLE)) / CAST(4.5 AS DOUBLE) - 1) > 1e-4""",
    "distinct_files": f"WITH {_FILES} SELECT path, count(*) AS n_sources FROM fl GROUP BY 1",
    "missing_files": f"WITH {_FILES} SELECT path, count(*) AS n_sources FROM fl WHERE path NOT IN (SELECT path FROM tiles WHERE magzero < 27) GROUP BY 1",
    "catalogue_analysis": f"WITH {_FILES} SELECT (SELECT count(*) FROM cat) AS num_sources, (SELECT count(DISTINCT path) FROM fl) AS num_files, round((SELECT avg(len(files)) FROM cat), 6) AS mean_files, 'NIR-H,VIS' AS bands",
    "duplicate_sources": "SELECT SourceID, l_partkey, l_suppkey, l_quantity FROM (SELECT l_orderkey || '_' || l_linenumber AS SourceID, l_partkey, l_suppkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS r FROM lineitem) WHERE r = 1",
    "pixel_scale": """WITH s AS (SELECT s_suppkey, abs((s_suppkey % 5) * CAST(-2.5e-5 AS DOUBLE) * CAST(2.5e-5 AS DOUBLE) - (s_suppkey % 3) * CAST(1e-6 AS DOUBLE) * ((s_suppkey % 2) * CAST(1e-6 AS DOUBLE))) AS det FROM supplier)
        SELECT s_suppkey, round(CASE WHEN det > 0 THEN sqrt(det) * 3600 ELSE 0.1 END, 9) AS scale FROM s""",
    "size_choice": f"WITH {_CAT} SELECT SourceID, CASE WHEN l_partkey % 50 = 0 THEN 128 ELSE coalesce(diameter_pixel, greatest(1, CAST(round_even(diameter_arcsec / 4.5, 0) AS INT))) END AS size FROM cat",
    "sky_to_pixel": f"WITH {_CAT}, fl AS (SELECT *, 'x' AS path FROM cat), tiles AS (SELECT 'x' AS path, 0 AS magzero),{_XY} SELECT SourceID, round(x, 6) AS x, round(y, 6) AS y FROM xy",
    "extraction_bounds": f"WITH {_placed('1.25')} SELECT SourceID, channel_no, n, x_min, x_max, y_min, y_max FROM pl",
    "clipped_bounds": f"WITH {_placed('1.25')} SELECT SourceID, channel_no, cx_min, cx_max, cy_min, cy_max FROM pl",
    "valid_regions": f"WITH {_placed()} SELECT path, count(*) FILTER (valid) AS valid, count(*) FILTER (NOT valid) AS off_tile FROM vd GROUP BY 1",
    "pixel_offsets": f"WITH {_placed()} SELECT SourceID, channel_no, round(offset_x, 6) AS offset_x, round(offset_y, 6) AS offset_y FROM pl",
    "offset_rescale": f"WITH {_placed()}, og AS (SELECT *, coalesce(diameter_pixel, CAST(round_even(diameter_arcsec / scale, 0) AS INT)) AS original FROM pl) SELECT SourceID, channel_no, original, round(CASE WHEN original = 0 THEN offset_x ELSE offset_x * 256 / original END, 5) AS offset_x FROM og",
    "source_tile_join": f"WITH {_placed()} SELECT path, count(*) AS n, sum(n) AS pixels, max(magzero) AS magzero FROM pl GROUP BY 1",
    "cutout_slice": f"WITH {_placed()}{_PX} SELECT SourceID, channel_no, count(*) AS pixels, round(sum(v), 4) AS total, round(sum(v * (ry * (cx_max - cx_min) + rx + 1)), 4) AS moment FROM cell GROUP BY SourceID, channel_no",
    "cutout_pad": f"WITH {_placed()}{_PX} SELECT SourceID, channel_no, any_value(n * n) AS pixels, round(sum(v * ((ry + pad_y) * n + rx + pad_x + 1)), 4) AS moment FROM cell GROUP BY SourceID, channel_no",
    "cutout_true_place": f"WITH {_placed()}{_PX} SELECT SourceID, channel_no, round(sum(v * ((ty - y_min) * n + tx - x_min + 1)), 4) AS moment FROM cell GROUP BY SourceID, channel_no",
    "flux_convert": f"WITH {_placed()}{_PX} SELECT SourceID, channel_no, round(sum(v * (power(10, magzero * -0.4) * 3631.0) * 1e9), 4) AS nano_jansky FROM cell GROUP BY SourceID, channel_no",
    "cutout_flux": f"WITH {_placed()}{_PX}, fx AS (SELECT SourceID, channel_no, sum(v * (power(10, magzero * -0.4) * 3631.0) * 1e9) AS f FROM cell GROUP BY SourceID, channel_no) SELECT SourceID, count(*) AS channels, round(coalesce(sum(f) FILTER (channel_no = 0), 0), 3) AS vis, round(coalesce(sum(f) FILTER (channel_no = 1), 0), 3) AS nir FROM fx GROUP BY 1",
    "wcs_header": f"WITH {_placed()} SELECT SourceID, channel_no, round(128.5 + offset_x, 6) AS crpix1, round(128.5 + offset_y, 6) AS crpix2, round(cd11 / (CAST(256 AS DOUBLE) / n) * 1e6, 6) AS cd11, round(cd22 / (CAST(256 AS DOUBLE) / n) * 1e6, 6) AS cd22 FROM pl",
    "minimal_wcs": f"WITH {_CAT} SELECT SourceID, CAST(32.75 AS DOUBLE) AS crpix1, CAST(32.25 AS DOUBLE) AS crpix2, round(-(CAST(0.1 AS DOUBLE) / 3600 / 2) * 1e6, 6) AS cdelt1, round(CAST(0.1 AS DOUBLE) / 3600 / 2 * 1e6, 6) AS cdelt2 FROM cat",
    "fits_filename": f"WITH {_CAT} SELECT SourceID, CASE WHEN l_partkey % 100 = 0 THEN SourceID || '_cutout.fits' ELSE 'T_' || SourceID || '_' || printf('%.6f', round(RA, 5)) || '_' || printf('%.6f', round(\"Dec\", 5)) || '_cutout.fits' END AS file, 'SRC' AS folder FROM cat",
    "chunk_shape": """WITH p AS (SELECT p_partkey, CAST(p_size * 300 AS INT) AS side, CASE WHEN p_partkey % 2 = 0 THEN 4 ELSE 1 END AS b FROM part), z AS (SELECT *, CAST(side AS DOUBLE) * side * 4 * b AS one, CAST(1.8 AS DOUBLE) * 1073741824 AS most FROM p),
        c AS (SELECT *, least(1000, greatest(1, CAST(floor(most / one) AS BIGINT))) AS images FROM z)
        SELECT p_partkey, images, CASE WHEN images = 1 AND one > most THEN greatest(1, CAST(trunc(side / sqrt(one / most)) AS INT)) ELSE side END AS height, CASE WHEN images = 1 AND one > most THEN greatest(1, CAST(trunc(side / sqrt(one / most)) AS INT)) ELSE side END AS width, 4 AS channels FROM c""",
    "source_mapping": "SELECT CAST(o_orderkey AS VARCHAR) AS SourceID, printf('batch_%03d/images.zarr', o_orderkey // 700) AS zarr_file, o_orderkey // 700 AS batch_index, row_number() OVER (PARTITION BY o_orderkey // 700 ORDER BY o_orderkey) - 1 AS idx_in_zarr FROM orders WHERE o_orderkey % 5 <> 0",
    "resume_remaining": "SELECT CAST(o_orderkey AS VARCHAR) AS SourceID, o_custkey FROM orders WHERE o_custkey % 3 <> 0",
    "channel_stack": f"WITH {_STACK} SELECT source, round(coalesce(sum(v * (i + 1)) FILTER (c = 0), 0), 4) AS c0, round(coalesce(sum(v * (i + 1)) FILTER (c = 1), 0), 4) AS c1, round(coalesce(sum(v * (i + 1)) FILTER (c = 2), 0), 4) AS c2 FROM q GROUP BY 1",
    "raw_stack": f"WITH {_STACK}, k AS (SELECT source, c, row_number() OVER (PARTITION BY source ORDER BY c) - 1 AS place FROM e) SELECT source, count(DISTINCT c) AS n, round(sum(v * (place * 64 + i + 1)), 4) AS moment FROM q JOIN k USING (source, c) GROUP BY 1",
    "channel_mix": "WITH q AS (SELECT vec_id // 3 AS source, vec_id % 3 AS c, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) SELECT source, round(sum(v * (i + 1) * CASE c WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0.5 END), 4) AS one, round(sum(v * (i + 1) * CASE c WHEN 1 THEN 1 ELSE 0 END), 4) AS two FROM q GROUP BY 1",
    "minmax_norm": f"WITH {_UNIT} SELECT vec_id, i, round(x, 6) AS value FROM u",
    "asinh_stretch": f"WITH {_UNIT} SELECT vec_id, i, round(asinh(x / CAST(0.1 AS DOUBLE)) / asinh(1 / CAST(0.1 AS DOUBLE)), 6) AS value FROM u",
    "log_stretch": f"WITH {_UNIT} SELECT vec_id, i, round(ln(1 + x * 1000) / ln(CAST(1001 AS DOUBLE)), 6) AS value FROM u",
    "percentile_clip": f"WITH {_IMG}, r AS (SELECT vec_id, min(v) AS lo, quantile_cont(v, 0.95) AS hi FROM p GROUP BY 1) SELECT vec_id, i, round(CASE WHEN hi > lo THEN least(greatest((v - lo) / (hi - lo), 0), 1) ELSE 0 END, 6) AS value FROM p JOIN r USING (vec_id)",
    "crop_max": f"WITH {_IMG} SELECT vec_id, round(max(v) FILTER (i // 8 BETWEEN 2 AND 5 AND i % 8 BETWEEN 2 AND 5), 6) AS centre, round(max(v), 6) AS whole FROM p GROUP BY 1",
    "to_uint8": f"WITH {_IMG} SELECT vec_id, i, round_even(least(greatest(v * 2, 0), 1) * 255, 0) AS value FROM p",
    "to_uint16": f"WITH {_IMG} SELECT vec_id, i, round_even(least(greatest(v * 2, 0), 1) * 65535, 0) AS value FROM p",
    "to_int16": f"WITH {_IMG} SELECT vec_id, i, CAST(CAST(trunc(least(greatest(v * 2, 0), 1) * 65535 - 32768) AS INT) AS DOUBLE) AS value FROM p",
    "nhwc_to_nchw": f"WITH {_IMG} SELECT vec_id, (i % 4) * 16 + i // 4 AS i, round(v, 6) AS value FROM p",
    "nchw_to_nhwc": f"WITH {_IMG} SELECT vec_id, (i % 16) * 4 + i // 16 AS i, round(v, 6) AS value FROM p",
    "nearest_resize": f"WITH {_IMG}, k AS (SELECT t, CAST(least(7, trunc((t + 0.5) * 8 / 5)) AS INT) AS s FROM range(5) x(t)) SELECT vec_id, ky.t * 5 + kx.t AS i, round(v, 6) AS value FROM k ky, k kx JOIN p ON p.i = ky.s * 8 + kx.s",
    "drizzle_resize": f"WITH {_IMG}, w AS (SELECT t, s, greatest(0, least(s + 1, (t + 1) * 1.6::DOUBLE) - greatest(s, t * 1.6::DOUBLE)) AS w FROM range(5) x(t), range(8) y(s)) SELECT vec_id, y.t * 5 + x.t AS i, round(sum(y.w * x.w * v), 9) AS value FROM p JOIN w y ON y.s = i // 8 JOIN w x ON x.s = i % 8 GROUP BY ALL",
    "bilinear_resize": f"""WITH {_IMG}, g AS (SELECT k, exp(-0.5 * (k / 0.3) ** 2) / sum(exp(-0.5 * (k / 0.3) ** 2)) OVER () AS g FROM range(-1, 2) x(k)),
        l AS (SELECT t, CASE WHEN s < 0 THEN -1 - s WHEN s > 7 THEN 15 - s ELSE s END AS m, 1 - abs((t + 0.5) * 1.6 - 0.5 - s)::DOUBLE AS w FROM range(5) x(t), range(-1, 9) y(s) WHERE abs((t + 0.5) * 1.6 - 0.5 - s) < 1),
        w AS (SELECT t, CASE WHEN m + k < 0 THEN -1 - m - k WHEN m + k > 7 THEN 15 - m - k ELSE m + k END AS s, sum(w * g) AS w FROM l, g GROUP BY ALL)
        SELECT vec_id, y.t * 5 + x.t AS i, round(sum(y.w * x.w * v), 9) AS value FROM p JOIN w y ON y.s = i // 8 JOIN w x ON x.s = i % 8 GROUP BY ALL""",
    "fits_roundtrip": f"WITH {_IMG} SELECT vec_id, i, round(v, 9) AS value FROM p",
    "block_sum_resize": f"WITH {_IMG} SELECT vec_id, (i // 16) * 4 + (i % 8) // 2 AS i, round(sum(v), 6) AS value FROM p GROUP BY 1, 2",
    "preview_rgb": f"""WITH {_IMG}, c AS (SELECT vec_id, i, b, CASE WHEN vec_id % 3 = 0 THEN v WHEN vec_id % 3 = 1 AND b = 2 THEN 0 ELSE v * (b + 1) END AS x FROM p, range(3) t(b)),
        r AS (SELECT vec_id, min(x) AS lo, max(x) AS hi FROM c GROUP BY 1) SELECT vec_id, i * 3 + b AS i, CASE WHEN hi > lo THEN trunc((x - lo) / (hi - lo) * 255) ELSE 0 END AS value FROM c JOIN r USING (vec_id)""",
    "tile_regex": f"WITH {_NAMES} SELECT doc_id, regexp_extract(path, 'TILE([^-]+)-', 1) AS tile FROM nm",
    "band_pivot": f"WITH {_NAMES} SELECT tile, vis, nir_y, nir_h, nir_j FROM tb",
    "missing_bands": f"WITH {_NAMES}, l AS (SELECT tile, concat_ws(',', CASE WHEN vis IS NULL THEN 'VIS' END, CASE WHEN nir_y IS NULL THEN 'NIR-Y' END, CASE WHEN nir_h IS NULL THEN 'NIR-H' END, CASE WHEN nir_j IS NULL THEN 'NIR-J' END, CASE WHEN j IS NULL THEN 'J' END) AS lacks FROM tb) SELECT tile, lacks FROM l WHERE lacks <> ''",
    "complete_tiles": f"WITH {_NAMES} SELECT tile FROM tb WHERE vis IS NOT NULL AND nir_y IS NOT NULL AND nir_h IS NOT NULL AND nir_j IS NOT NULL",
    "area_size": "WITH a AS (SELECT p_partkey, CAST(trunc(2 * sqrt(p_retailprice / pi()) * 5) AS INT) AS r FROM part WHERE p_retailprice >= 910) SELECT p_partkey, least(175, greatest(32, r + r % 2)) AS diameter_pixel FROM a",
    "topn_by_area": "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25",
    "topn_per_tile": "SELECT p_brand, p_partkey, place, 'TILE_' || p_brand || '_' || p_partkey AS object_id FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place FROM part) WHERE place <= 3",
    "hash_sample": f"SELECT o_orderkey, o_custkey FROM orders ORDER BY {_HASH.format(k='o_orderkey')}, o_orderkey LIMIT 100",
    "tile_choice": "SELECT w.p_brand, count(p_partkey) AS n FROM (SELECT 'Brand#' || (n_nationkey + 10) AS p_brand FROM nation) w LEFT JOIN part USING (p_brand) GROUP BY 1",
    "preview_top_set": f"WITH {_CAT}, b AS (SELECT files, count(*) AS n FROM cat GROUP BY 1 ORDER BY n DESC, files LIMIT 1) SELECT SourceID, array_to_string(files, '|') AS paths FROM cat JOIN b USING (files)",
    "preview_upper_half": "SELECT p_partkey, p_size FROM part WHERE p_size >= (SELECT quantile_cont(p_size, 0.5) FROM part)",
    "preview_thinning": f"WITH n AS (SELECT count(*) AS c FROM orders), r AS (SELECT o_orderkey FROM orders WHERE o_orderkey >= 100 ORDER BY {_HASH.format(k='o_orderkey')}, o_orderkey LIMIT 500) SELECT o_orderkey FROM orders, n WHERE c <= 2000 OR o_orderkey < 100 OR o_orderkey IN (SELECT o_orderkey FROM r)",
    "progress_aggregate": f"""WITH {_PROG}, a AS (SELECT CAST(sum(total_sources) AS BIGINT) AS t, CAST(sum(completed_sources) AS BIGINT) AS c, CAST(sum(failed_sources) AS BIGINT) AS f, count(*) FILTER (NOT done) AS active, CAST(sum(errors) AS BIGINT) AS er, CAST(sum(warnings) AS BIGINT) AS wa, sum(mb) AS mem FROM pd)
        SELECT t AS total_sources, c AS completed_sources, f AS failed_sources, active AS active_processes, er AS errors, wa AS warnings, round(c * 100.0 / t, 4) AS progress_percent, round(c / 3600.0, 4) AS throughput, round(greatest(t - c - f, 0) / (c / 3600.0), 4) AS eta_seconds, round(mem, 4) AS memory_mb FROM a""",
    "completion_status": f"WITH {_PROG} SELECT count(*) AS total_processes, count(*) FILTER (done) AS completed_processes, CAST(sum(total_sources) AS BIGINT) AS total_sources, CAST(sum(completed_sources) AS BIGINT) AS completed_sources, round(count(*) FILTER (done) * 100.0 / count(*), 6) AS completion_percent, bool_and(done) AS is_fully_completed FROM pd",
    "stale_processes": f"WITH {_PROG} SELECT process_id, last_update FROM pr WHERE 1706659200 - last_update > 10800",
    "retained_records": f"WITH {_PROG} SELECT process_id, last_update FROM pr WHERE 1706659200 - last_update <= 43200",
    "worker_states": "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "step_stats": f"WITH {_STEPS} SELECT step, n, CAST(total AS BIGINT) AS total, round(mean, 6) AS mean, least, greatest, round(percent, 6) AS percent FROM pc",
    "bottlenecks": f"WITH {_STEPS} SELECT step, round(percent, 6) AS percent FROM pc WHERE percent >= 20",
    "peak_window": "SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 7200 PRECEDING AND CURRENT ROW) AS peak FROM events",
    "moving_mean": "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS moving_mean FROM events",
    "above_baseline": "SELECT event_id, round(max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) - first_value(value) OVER (PARTITION BY user_id ORDER BY event_id), 6) AS above FROM events",
    "eta_smoothing": "WITH RECURSIVE r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events), s AS (SELECT user_id, event_id, i, value AS e FROM r WHERE i = 1 UNION ALL SELECT r.user_id, r.event_id, r.i, CAST(0.3 AS DOUBLE) * r.value + CAST(0.7 AS DOUBLE) * s.e FROM s JOIN r ON r.user_id = s.user_id AND r.i = s.i + 1) SELECT event_id, round(e, 6) AS smoothed FROM s",
    "raw_eta": "WITH x AS (SELECT o_orderkey, o_orderkey % 40 AS d, CAST(o_custkey % 500 AS DOUBLE) AS t FROM orders), y AS (SELECT o_orderkey, CASE WHEN d > 0 AND t > 0 THEN CAST(floor((40 - d) / (d / t)) AS BIGINT) END AS s FROM x) SELECT o_orderkey, CASE WHEN s IS NULL THEN '--' ELSE printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) END AS eta FROM y",
    "spawn_decision": """WITH x AS (SELECT o_orderkey, o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 17 * 100 AS DOUBLE) END AS peak FROM orders), y AS (SELECT *, greatest(0, CAST(4000 AS DOUBLE) - (k % 13 * 100) * CAST(1.2 AS DOUBLE) - CAST(4000 AS DOUBLE) * CAST(0.15 AS DOUBLE) - coalesce(peak, 0) * (k % 9)) AS l FROM x)
        SELECT o_orderkey, round(l, 6) AS left_mb, CASE WHEN k % 9 >= 7 THEN 'cpu_limit' WHEN k % 9 < 1 THEN 'initial' WHEN peak IS NULL THEN 'calibration' WHEN l < peak THEN 'memory' WHEN k % 101 > 90 THEN 'cpu_busy' ELSE 'spawn' END AS decision FROM y""",
    "remaining_memory": "SELECT c_custkey, round(greatest(0, CAST(c_custkey % 64 * 1024 AS DOUBLE) - (c_custkey % 40 * 100) * CAST(1.2 AS DOUBLE) - CAST(c_custkey % 64 * 1024 AS DOUBLE) * CAST(0.15 AS DOUBLE) - CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 900 ELSE 0 END * (c_custkey % 8)), 6) AS left_mb FROM customer",
    "worker_memory": "SELECT c_custkey, round(CAST(1000 * (c_custkey % 512) * (c_custkey % 512) * (c_custkey % 4 + 1) * 4 AS DOUBLE) * 2.5 / 1048576 + CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 300 ELSE 500 END, 6) AS mb FROM customer",
    "batch_size_rule": "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 AND c_custkey % 500 > 0 THEN c_custkey % 500 WHEN c_custkey * 1000 < 1000000 THEN 12500 ELSE 100000 END AS batch_size, least(16, c_custkey % 32 + 1) AS workers FROM customer",
    "scaling_metrics": "WITH r AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS workers, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS seconds FROM orders GROUP BY 1), o AS (SELECT min(seconds) AS one FROM r WHERE workers = 1) SELECT workers, seconds, round(one / seconds, 6) AS speedup, round(one / seconds / workers, 6) AS efficiency FROM r, o",
    "tool_summary": "WITH r AS (SELECT o_orderpriority AS scenario, o_orderstatus AS tool, count(*) AS sources, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS seconds FROM orders GROUP BY 1, 2) SELECT scenario, tool, sources, round(sources / seconds * 1e6, 6) AS rate, round(max(seconds) OVER (PARTITION BY scenario) / seconds, 6) AS speedup FROM r",
    "output_size": "SELECT c_custkey, round(CAST(c_custkey * 100 AS DOUBLE) * (c_custkey % 4 + 1) * 65536 * CASE WHEN c_custkey % 2 = 0 THEN 4 ELSE 1 END / 1073741824, 6) AS gib FROM customer",
    "event_window_throughput": "SELECT CAST(epoch(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')) AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "session_activity": """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL '2 hours' THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
        SELECT user_id, epoch_us(min(ts)) AS start, epoch_us(max(ts) + INTERVAL '2 hours') AS "end", count(*) AS n FROM s GROUP BY user_id, k""",
}
