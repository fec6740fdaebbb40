"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from .queries import CENTRE, CLIP, CROP, LATE, SERIES, SKIP, START, STOP

_SKIPPED = sorted({n for part in SKIP.split(",") for lo, hi in [(part.split("-") * 2)[:2]] for n in range(int(lo), int(hi) + 1)})
_SKIP = ", ".join(map(str, _SKIPPED))
#: Each view stands on those before it.
_FILES = """
WITH e AS (SELECT 'c' || (user_id % 5) AS collection, event_type AS position, ts AS mtime, event_id, CAST(floor(value * 100) AS BIGINT) AS length, event_id % 7 <> 0 AS valid,
  CAST((row_number() OVER (PARTITION BY user_id % 5, event_type ORDER BY ts, event_id) - 1) // 3 AS INTEGER) AS seq FROM events),
files AS (SELECT collection, position, seq, collection || '_' || position || CASE WHEN seq > 0 THEN '_' || lpad(CAST(seq AS VARCHAR), 4, '0') ELSE '' END AS dataset_name,
  'vol_' || event_id || CASE WHEN event_id % 11 = 0 THEN '_Histogram' ELSE '' END || '.hdf5' AS file_name, mtime, length, valid FROM e),
good AS (SELECT * FROM files WHERE valid AND NOT contains(lower(file_name), 'histogram')),
latest AS (SELECT collection, position, seq, dataset_name, file_name, mtime, length FROM good QUALIFY row_number() OVER (PARTITION BY collection, position, seq ORDER BY mtime DESC, file_name DESC) = 1)
"""


def _pairs(where: str) -> str:
    return f"""{_FILES}, members AS (SELECT * FROM latest WHERE seq NOT IN ({_SKIP}) AND {where}),
    pairs AS (SELECT collection, position, seq, dataset_name, file_name, lag(seq) OVER o AS prev_seq, lag(dataset_name) OVER o AS prev_dataset_name, lag(file_name) OVER o AS prev_file_name
      FROM members WINDOW o AS (PARTITION BY collection, position ORDER BY seq) QUALIFY prev_seq IS NOT NULL)
    """


_RANGED = _pairs(f"seq BETWEEN {START} AND {STOP}")
_BLOCKS = """
WITH blocks AS (SELECT l_orderkey AS scan, l_linenumber AS block, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS frame_count, CAST(l_linenumber % 4 AS INTEGER) AS image_key FROM lineitem GROUP BY 1, 2),
scans AS (SELECT scan, CAST(sum(frame_count) AS BIGINT) AS frames, count(*) AS blocks, arg_min(image_key, block) AS image_key FROM blocks GROUP BY scan),
kinds AS (SELECT *, CASE image_key WHEN 0 THEN 'projection' WHEN 1 THEN 'flat' WHEN 2 THEN 'dark' ELSE 'unknown' END AS kind FROM scans),
places AS (SELECT *, CAST(sum(frame_count) OVER (PARTITION BY scan ORDER BY block ROWS UNBOUNDED PRECEDING) AS BIGINT) AS last FROM blocks)
"""
_LISTING = f"""{_BLOCKS},
paths AS (SELECT *, root || '/scan' || lpad(CAST(scan AS VARCHAR), 6, '0') AS scan_path FROM (SELECT *, '/data/c/c_p' || (scan // 8) % 3 || '_' || lpad(CAST((scan // 8) % 10000 AS VARCHAR), 4, '0') AS root FROM blocks)),
kind_of AS (SELECT scan_path, root, CAST(sum(frame_count) AS BIGINT) AS frames, CASE arg_min(image_key, block) WHEN 0 THEN 'projection' WHEN 1 THEN 'flat' WHEN 2 THEN 'dark' ELSE 'unknown' END AS kind FROM paths GROUP BY 1, 2)
"""
_VOXELS = """
WITH vox AS (SELECT 'vectors' AS series, CAST(vec_id // 20 AS INTEGER) AS seq, CAST(vec_id % 20 AS INTEGER) AS z, CAST((i - 1) // 8 AS INTEGER) AS y, CAST((i - 1) % 8 AS INTEGER) AS x, CAST(embedding[i] AS FLOAT) AS v
  FROM embeddings, unnest(range(1, 65)) t(i))
"""
_RAW = f"""{_VOXELS},
raw AS (SELECT a.series, a.seq, b.seq AS prev_seq, a.z, a.y, a.x, CAST(a.v - b.v AS FLOAT) AS d FROM vox a JOIN vox b ON b.seq = a.seq - 1 AND a.z = b.z AND a.y = b.y AND a.x = b.x)
"""
#: The same differences in one pass, for queries of them alone.
_LAGGED = f"""{_VOXELS},
raw AS (SELECT series, seq, lag(seq) OVER o AS prev_seq, z, y, x, CAST(v - lag(v) OVER o AS FLOAT) AS d FROM vox WINDOW o AS (PARTITION BY z, y, x ORDER BY seq) QUALIFY prev_seq IS NOT NULL)
"""
_DIFFS = f"""{_RAW},
med AS (SELECT seq, median(CAST(d AS DOUBLE)) AS m, stddev_pop(CAST(d AS DOUBLE)) AS sd FROM raw GROUP BY seq),
sig AS (SELECT seq, CASE WHEN median(abs(d - m)) > 0 THEN median(abs(CAST(d AS DOUBLE) - m)) / 0.6744897501960817 ELSE first(sd) END AS sigma FROM raw JOIN med USING (seq) GROUP BY seq),
base AS (SELECT CAST(arg_min(sigma, seq) * 2.0 AS FLOAT) AS t FROM sig),
mask AS (SELECT * FROM raw, base WHERE abs(d) >= t),
tops AS (SELECT series, seq, prev_seq, z, CAST(max(abs(d)) AS DOUBLE) AS max_abs_diff FROM raw GROUP BY 1, 2, 3, 4)
"""


def labels_sql(diffs: str) -> str:
    """Regions within slices, on top of mask."""
    return f"""{diffs.replace("WITH", "WITH RECURSIVE", 1)},
reach AS (SELECT seq, z, y, x, y * 100 + x AS label FROM mask
  UNION SELECT m.seq, m.z, m.y, m.x, r.label FROM reach r JOIN mask m ON m.seq = r.seq AND m.z = r.z AND abs(m.y - r.y) <= 1 AND abs(m.x - r.x) <= 1),
labels AS (SELECT seq, z, y, x, min(label) AS label FROM reach GROUP BY 1, 2, 3, 4),
comp AS (SELECT seq, z, label, min(y) AS y_min, max(y) AS y_max, min(x) AS x_min, max(x) AS x_max, count(*) AS voxel_count, CAST(max(abs(d)) AS DOUBLE) AS peak_abs_diff,
  CAST(arg_max(d, (abs(d), -y, -x)) AS DOUBLE) AS peak_signed_diff, sum(abs(CAST(d AS DOUBLE))) AS sum_abs_diff, sum(CAST(d AS DOUBLE)) AS sum_signed_diff,
  CAST(sum(y) AS DOUBLE) AS y_weighted_sum, CAST(sum(x) AS DOUBLE) AS x_weighted_sum, CAST(z * count(*) AS DOUBLE) AS z_weighted_sum
  FROM labels JOIN mask USING (seq, z, y, x) GROUP BY 1, 2, 3)
"""


_LABELS = labels_sql(_DIFFS)
#: The fold over the regions of a pair: one region a step, with all events so far as a list in order of their numbers.
_SUMMED = ["sum_abs_diff", "sum_signed_diff", "z_weighted_sum", "y_weighted_sum", "x_weighted_sum"]
_LOWS, _HIGHS = ["z_min", "y_min", "x_min"], ["z_max", "y_max", "x_max"]
_EVENT_TYPE = ", ".join(
    ["event_id INTEGER", "last_z INTEGER"] + [f"{c} INTEGER" for c in _LOWS + _HIGHS]
    + ["voxel_count BIGINT", "peak_abs_diff DOUBLE", "peak_signed_diff DOUBLE"] + [f"{c} DOUBLE" for c in _SUMMED]
)
_NEAR = " AND ".join(["e.last_z = z - 1"] + [f"e.{a}_min <= {a}_max + 1 AND {a}_min <= e.{a}_max + 1" for a in "yx"])


def _over(function: str, column: str) -> str:
    return f"list_{function}(list_transform(parts, lambda e: e.{column}))"


_MERGED = ", ".join(
    [f"event_id := {_over('min', 'event_id')}", "last_z := z"]
    + [f"{c} := {_over('min', c)}" for c in _LOWS] + [f"{c} := {_over('max', c)}" for c in _HIGHS]
    + [f"voxel_count := CAST({_over('sum', 'voxel_count')} AS BIGINT)", "peak_abs_diff := peak"]
    + ["peak_signed_diff := list_filter(parts, lambda e: e.peak_abs_diff = peak)[1].peak_signed_diff"]
    + [f"{c} := {_over('sum', c)}" for c in _SUMMED]
)
_AS_EVENT = ", ".join(
    ["event_id := CAST(started + 1 AS INTEGER)", "last_z := z", "z_min := z", "y_min := y_min", "x_min := x_min", "z_max := z", "y_max := y_max", "x_max := x_max"]
    + [f"{c} := {c}" for c in ["voxel_count", "peak_abs_diff", "peak_signed_diff", *_SUMMED]]
)


def fold_sql(labels: str) -> str:
    """Events of each pair, on top of comp."""
    return f"""{labels},
regions AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY z, label) AS step FROM comp),
folded(seq, step, started, events) AS (
  SELECT DISTINCT seq, CAST(0 AS BIGINT), 0, CAST([] AS STRUCT({_EVENT_TYPE})[]) FROM regions
  UNION ALL
  SELECT seq, step, CASE WHEN len(hit) = 0 THEN started + 1 ELSE started END, list_sort(list_append(rest, CAST(struct_pack({_MERGED}) AS STRUCT({_EVENT_TYPE}))))
  FROM (SELECT *, {_over('max', 'peak_abs_diff')} AS peak FROM
    (SELECT *, list_append(hit, CAST(struct_pack({_AS_EVENT}) AS STRUCT({_EVENT_TYPE}))) AS parts FROM
      (SELECT f.started, r.*, list_filter(f.events, lambda e: {_NEAR}) AS hit, list_filter(f.events, lambda e: NOT ({_NEAR})) AS rest
       FROM folded f JOIN regions r ON r.seq = f.seq AND r.step = f.step + 1)))),
ended AS (SELECT seq, unnest(events, recursive := true) FROM folded QUALIFY step = max(step) OVER (PARTITION BY seq)),
found AS (SELECT * FROM (SELECT 'vectors' AS series, seq, seq - 1 AS prev_seq, CAST(row_number() OVER (PARTITION BY seq ORDER BY last_z, event_id) - 1 AS INTEGER) AS finish_order, * EXCLUDE (seq, last_z) FROM ended)
  WHERE voxel_count >= 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY seq ORDER BY peak_abs_diff DESC, finish_order) AS INTEGER) AS event_rank FROM found QUALIFY event_rank <= 100),
compared AS (SELECT t.series, t.seq, t.prev_seq, coalesce(n, 0) AS detected_event_count, least(coalesce(n, 0), 100) AS stored_event_count, t.max_abs_diff
  FROM (SELECT series, seq, prev_seq, round(max(max_abs_diff), 6) AS max_abs_diff FROM tops GROUP BY 1, 2, 3) t LEFT JOIN (SELECT seq, count(*) AS n FROM found GROUP BY seq) USING (seq))
"""


_FOLD = fold_sql(_LABELS)
_STATS = """, picked AS (SELECT series, seq, CAST(v AS DOUBLE) AS v FROM vox WHERE z % {step} = 0 AND y % {step} = 0 AND x % {step} = 0),
m AS (SELECT series, seq, median(v) AS m, stddev_pop(v) AS sd FROM picked GROUP BY 1, 2),
s AS (SELECT series, seq, CASE WHEN median(abs(v - m)) > 0 THEN median(abs(v - m)) / 0.6744897501960817 ELSE first(sd) END AS sigma FROM picked JOIN m USING (series, seq) GROUP BY 1, 2),
st AS (SELECT series, seq, count(*) AS n, min(v) AS low, max(v) AS high, quantile_cont(v, [0.001, 0.005, 0.01, 0.05, 0.5, 0.95, 0.99, 0.995, 0.999]) AS p FROM picked GROUP BY 1, 2)
"""
_LOW, _HIGH = CLIP
_CLIPPED = f"greatest(least(v, CAST({_HIGH} AS FLOAT)), CAST({_LOW} AS FLOAT))"
_MASKED = f"CASE WHEN abs({_CLIPPED}) < CAST(0.05 AS FLOAT) THEN 0 ELSE {_CLIPPED} END"
_Z, _Y, _X = CENTRE


_PLANES = f"""{_VOXELS},
planes AS (SELECT series, seq, 'xy' AS plane, y, x, CAST(v AS DOUBLE) AS v FROM vox WHERE z = {_Z} UNION ALL SELECT series, seq, 'xz', z, x, v FROM vox WHERE y = {_Y} UNION ALL SELECT series, seq, 'yz', z, y, v FROM vox WHERE x = {_X})
"""


def _r(*cols: str, digits: int = 6) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) AS {c.split('.')[-1]}" for c in cols)


#: A number of bytes as text.
SIZE = "CASE " + " ".join(f"WHEN {{0}} < {2**(p + 10)} THEN printf('%.1f {u}', CAST({{0}} AS DOUBLE) / {2**p})" for p, u in ((0, "B"), (10, "KB"), (20, "MB"), (30, "GB"))) + f" ELSE printf('%.1f TB', CAST({{0}} AS DOUBLE) / {2**40}) END"
_PLACE = ", ".join(f"{a}_{c}" for a in "zyx" for c in ("min", "max"))
_FOUND = f"series, seq, prev_seq, event_id, finish_order, {_PLACE}, voxel_count, {_r('peak_abs_diff', 'peak_signed_diff', *_SUMMED, digits=4)}"
_DESCRIBED = ", ".join(
    [_FOUND, "event_rank"]
    + [f"round({c} / greatest(voxel_count, 1), 4) AS {n}" for c, n in (("sum_abs_diff", "mean_abs_diff"), ("sum_signed_diff", "mean_signed_diff"))]
    + [f"round({a}_weighted_sum / greatest(voxel_count, 1), 4) AS {p}{a}_centroid" for a in "zyx" for p in ("", "full_")]
    + [f"{a}_{c} AS full_{a}_{c}" for a in "zyx" for c in ("min", "max")]
)




def tracked_sql(series: list[str], skip: list[int], crop: tuple[tuple[int, int], ...], where: str = "true") -> str:
    """Pairs of the catalog, and the events of their volumes within a crop. Here seq is a number of the pair, in all series."""
    names, (z, y, x) = ", ".join(f"'{n}'" for n in series), crop
    inside = " AND ".join(f"{a} BETWEEN {r[0]} AND {r[1] - 1}" for a, r in zip("zyx", crop))
    raw = f"""{_FILES},
    vox AS (SELECT ['{"', '".join(series)}'][1 + CAST(vec_id // 20 AS INTEGER) % {len(series)}] AS series, CAST(vec_id // 20 // {len(series)} AS INTEGER) AS seq, CAST(vec_id % 20 AS INTEGER) AS z,
      CAST((i - 1) // 8 AS INTEGER) AS y, CAST((i - 1) % 8 AS INTEGER) AS x, CAST(embedding[i] AS FLOAT) AS v FROM embeddings, unnest(range(1, 65)) t(i)),
    members AS (SELECT collection || '_' || position AS series, seq, dataset_name, file_name, mtime FROM latest WHERE collection || '_' || position IN ({names}) AND seq NOT IN ({", ".join(map(str, skip))}) AND {where}),
    pairs AS (SELECT *, list_position([{names}], series) * 100000 + seq AS pair, lag(seq) OVER o AS prev_seq, lag(dataset_name) OVER o AS prev_dataset_name, lag(file_name) OVER o AS prev_file_name, lag(mtime) OVER o AS prev_mtime
      FROM members SEMI JOIN vox USING (series, seq) WINDOW o AS (PARTITION BY series ORDER BY seq) QUALIFY prev_seq IS NOT NULL),
    cut AS MATERIALIZED (SELECT series, seq, z - {z[0]} AS z, y - {y[0]} AS y, x - {x[0]} AS x, v FROM vox WHERE {inside}),
    raw AS MATERIALIZED (SELECT p.series, p.pair AS seq, p.prev_seq, a.z, a.y, a.x, CAST(a.v - b.v AS FLOAT) AS d FROM pairs p JOIN cut a USING (series, seq) JOIN cut b ON b.series = p.series AND b.seq = p.prev_seq AND a.z = b.z AND a.y = b.y AND a.x = b.x)
    """
    diffs = _DIFFS.replace(_RAW, raw)
    diffs = diffs.replace("base AS (SELECT CAST(arg_min(sigma, seq) * 2.0 AS FLOAT) AS t FROM sig)", "base AS (SELECT seq // 100000 AS line, arg_min(sigma, seq) AS sigma, CAST(arg_min(sigma, seq) * 2.0 AS FLOAT) AS t FROM sig GROUP BY 1)")
    diffs = diffs.replace("mask AS (SELECT * FROM raw, base WHERE abs(d) >= t)", "mask AS (SELECT raw.* FROM raw JOIN base ON line = seq // 100000 WHERE abs(d) >= t)")
    return fold_sql(labels_sql(diffs)).replace("'vectors' AS series, seq, seq - 1 AS prev_seq", "seq")\
        .replace("t.series, t.seq, t.prev_seq", "t.seq").replace("SELECT series, seq, prev_seq, round(max(max_abs_diff), 6) AS max_abs_diff FROM tops GROUP BY 1, 2, 3", "SELECT seq, round(max(max_abs_diff), 6) AS max_abs_diff FROM tops GROUP BY 1")


def described_sql(start: tuple[int, ...], digits: int = 4) -> str:
    """Columns of an event, with places in the whole volume."""
    n = "greatest(voxel_count, 1)"
    cols = ["event_rank", "voxel_count", *(f"round({c}, {digits}) AS {c}" for c in ("peak_abs_diff", "peak_signed_diff"))]
    cols += [f"round(sum_{m}_diff / {n}, {digits}) AS mean_{m}_diff" for m in ("abs", "signed")]
    cols += [f"round({a}_weighted_sum / {n}, {digits}) AS {a}_centroid" for a in "zyx"] + [f"{a}_{e}" for a in "zyx" for e in ("min", "max")]
    cols += [f"round({a}_weighted_sum / {n} + {s}, {digits}) AS full_{a}_centroid" for a, s in zip("zyx", start)]
    return ", ".join(cols + [f"{a}_{e} + {s} AS full_{a}_{e}" for a, s in zip("zyx", start) for e in ("min", "max")])


_RUN = tracked_sql(SERIES, _SKIPPED, (CROP.z, CROP.y, CROP.x), f"seq BETWEEN {START} AND {STOP}")

ORACLE: dict[str, str] = {
    "series_names": f"""{_FILES} SELECT DISTINCT collection, dataset_name, regexp_replace(dataset_name, '_\\d{{4}}$', '') AS series_name, coalesce(TRY_CAST(regexp_extract(dataset_name, '_(\\d{{4}})$', 1) AS INTEGER), 0) AS seq,
        coalesce(TRY_CAST(regexp_extract(dataset_name, '_(\\d+)$', 1) AS INTEGER), 0) AS seq_live, position AS position_name, dataset_name || '_compressed.hdf5' AS output_name FROM files""",
    "latest_files": f"{_FILES} SELECT * FROM latest",
    "newest_dataset": f"{_FILES} SELECT collection, seq, dataset_name, file_name, mtime FROM latest QUALIFY row_number() OVER (PARTITION BY collection ORDER BY seq DESC, mtime DESC, dataset_name DESC) = 1",
    "skip_list": f"{_FILES} SELECT DISTINCT dataset_name, concat_ws(',', seq, seq + 2, seq + 3, seq + 4) AS numbers FROM files",
    "admitted_members": f"{_FILES} SELECT collection, position, seq, file_name FROM latest WHERE seq BETWEEN {START} AND {STOP} AND seq NOT IN ({_SKIP})",
    "pairs_lag": f"{_pairs('true')} SELECT * FROM pairs",
    "pairs_preview": f"""{_FILES}, roots AS (SELECT DISTINCT collection, position, seq FROM files),
        p AS (SELECT collection, position, seq, file_name, lag(seq) OVER o AS prev_seq, lag(file_name) OVER o AS prev_file_name FROM roots LEFT JOIN latest USING (collection, position, seq) WINDOW o AS (PARTITION BY collection, position ORDER BY seq))
        SELECT * FROM p WHERE file_name IS NOT NULL AND prev_file_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY collection, position ORDER BY seq) = 1""",
    "duplicate_sequences": f"{_FILES} SELECT collection, position, seq, count(*) AS n, string_agg(file_name, ',' ORDER BY file_name) AS file_names FROM files WHERE valid GROUP BY 1, 2, 3 HAVING count(*) > 1",
    "range_audit": f"""{_FILES}, wanted AS (SELECT DISTINCT collection, position, seq FROM (SELECT collection, position FROM files), (SELECT CAST(unnest(range({START}, {STOP + 1})) AS INTEGER) AS seq))
        SELECT collection, position, seq, CASE WHEN seq IN ({_SKIP}) THEN 'skipped' WHEN (collection, position, seq) IN (SELECT (collection, position, seq) FROM latest) THEN 'admitted'
        WHEN (collection, position, seq) NOT IN (SELECT (collection, position, seq) FROM files) THEN 'missing' ELSE 'unresolved' END AS status FROM wanted""",
    "used_members": f"{_RANGED} SELECT collection, position, seq FROM pairs UNION SELECT collection, position, prev_seq FROM pairs",
    "baseline_pair": f"{_RANGED} SELECT collection, position, seq, prev_seq FROM pairs QUALIFY row_number() OVER (PARTITION BY collection, position ORDER BY seq) = 1",
    "frame_numbers": f"{_FILES} SELECT collection, position, seq, CAST(row_number() OVER (PARTITION BY collection, position ORDER BY seq) AS INTEGER) AS frame_index FROM latest WHERE seq NOT IN ({_SKIP})",
    "preview_target": f"""{_FILES}, kept AS (SELECT collection, position, seq, dataset_name, file_name FROM latest WHERE seq BETWEEN {START} AND {STOP} AND seq NOT IN ({_SKIP}))
        SELECT * FROM kept WHERE seq = 5 UNION ALL (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY collection, position ORDER BY seq) = 1)""",
    "readable_files": f"{_FILES} SELECT collection, position, file_name, mtime, length, valid AND seq % 2 = 0 AS known, valid AND (seq % 2 = 0 OR seq % 4 = 1) AS readable FROM files",
    "second_targets": f"""{_FILES}, same AS (SELECT * FROM latest QUALIFY row_number() OVER (PARTITION BY collection, position ORDER BY seq DESC, mtime DESC, dataset_name DESC) = 1),
        anywhere AS (SELECT * FROM latest QUALIFY row_number() OVER (PARTITION BY collection ORDER BY seq DESC, mtime DESC, dataset_name DESC) = 1),
        pairs AS (SELECT 'same' AS mode, l.*, t.seq AS target_seq, l.position AS held_to, t.dataset_name AS td, t.file_name AS tf FROM latest l JOIN same t USING (collection, position)
          UNION ALL SELECT 'all', l.*, t.seq, NULL, t.dataset_name, t.file_name FROM latest l JOIN anywhere t USING (collection))
        SELECT mode, collection, position, seq, target_seq, held_to, 'reference: ' || dataset_name || ' | ' || file_name || chr(10) || 'current: ' || td || ' | ' || tf AS title FROM pairs WHERE target_seq >= seq""",
    "plane_lists": f"""{_FILES} SELECT DISTINCT dataset_name, ' XY ,,' || upper(position) || CASE WHEN seq % 2 = 0 THEN ',yz' ELSE '' END AS raw, 'xy+' || lower(position) || CASE WHEN seq % 2 = 0 THEN '+yz' ELSE '' END AS planes, lower(position) AS unknown FROM files""",
    "file_times": f"""{_FILES} SELECT dataset_name, strftime(mtime, '%Y-%m-%dT%H:%M:%S+00:00') AS mtime_iso, {SIZE.format('length')} AS size FROM latest""",
    "follow_emitted": f"""{_FILES}, b AS (SELECT date_diff('day', DATE '1970-01-01', CAST(mtime AS DATE)) AS batch, * FROM good),
        m AS (SELECT CAST(batch AS INTEGER) AS batch, collection, position, seq, mtime, file_name FROM b QUALIFY row_number() OVER (PARTITION BY batch, collection, position ORDER BY seq DESC, mtime DESC, file_name DESC) = 1)
        SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m q WHERE q.collection = m.collection AND q.position = m.position AND q.batch < m.batch AND (q.seq, q.mtime, q.file_name) >= (m.seq, m.mtime, m.file_name))""",
    "follow_state": f"""{_FILES}, m AS (SELECT day(mtime) // 11 AS batch, collection, position, seq, mtime, file_name FROM good QUALIFY row_number() OVER (PARTITION BY day(mtime) // 11, collection, position ORDER BY seq DESC, mtime DESC, file_name DESC) = 1)
        SELECT collection, position, seq, mtime, file_name FROM m WHERE NOT EXISTS (SELECT 1 FROM m q WHERE q.collection = m.collection AND q.position = m.position AND q.batch < m.batch AND (q.seq, q.mtime, q.file_name) >= (m.seq, m.mtime, m.file_name))""",
    "dataset_directories": f"""{_LISTING}, roots AS (SELECT root, bool_or(scan % 8 = 0 AND scan % 3 = 0) AS master, bool_or(scan % 8 = 0 AND scan % 5 = 0) AS vols FROM paths GROUP BY root)
        SELECT root, CASE WHEN master THEN 'master,' ELSE '' END || 'scans' || CASE WHEN vols THEN ',volumes' ELSE '' END AS kinds FROM roots""",
    "resolved_scans": f"""{_LISTING} SELECT p.scan_path || '/part_' || block || '.h5' AS path, p.root, 'scan' || lpad(CAST(scan AS VARCHAR), 6, '0') AS scan,
        CASE WHEN kind <> 'projection' THEN p.scan_path || '/part_' || block || '.h5 is a ' || kind || ' scan; only projections can be shown' END AS refusal FROM paths p JOIN kind_of USING (scan_path)""",
    "projection_datasets": f"""{_LISTING}, firsts AS (SELECT root, scan_path, frames FROM kind_of WHERE kind = 'projection' QUALIFY row_number() OVER (PARTITION BY root ORDER BY scan_path) = 1)
        SELECT root, CAST(right(root, 4) AS INTEGER) AS seq, right(scan_path, 10) AS scan, frames FROM firsts WHERE frames > 60 AND CAST(right(root, 4) AS INTEGER) >= 2""",
    "history_preload": f"{_FILES} SELECT collection, position, seq, file_name FROM latest WHERE seq BETWEEN 0 AND 5",
    "scan_frames": f"{_BLOCKS} SELECT * FROM kinds",
    "block_offsets": f"{_BLOCKS} SELECT *, last - frame_count AS first FROM places",
    "frame_lookup": f"{_BLOCKS} SELECT scan, frames // 2 AS frame_index, block, frames // 2 - (last - frame_count) AS frame_in_block FROM scans JOIN places USING (scan) WHERE frames // 2 >= last - frame_count AND frames // 2 < last",
    "latest_projection": f"{_BLOCKS} SELECT kind, max(scan) AS scan FROM kinds GROUP BY kind",
    "scan_refusals": f"{_BLOCKS} SELECT scan, CASE WHEN kind <> 'projection' THEN scan || ' is a ' || kind || ' scan; only projections can be shown' END AS refusal FROM kinds",
    "volume_shapes": f"{_VOXELS} SELECT series, seq, max(z) + 1 AS nz, max(y) + 1 AS ny, max(x) + 1 AS nx, count(*) AS voxels, count(*) = (max(z) + 1) * 64 AS complete FROM vox GROUP BY 1, 2",
    "crop_filter": f"{_VOXELS} SELECT series, seq, z, y, x, {_r('v')} FROM vox WHERE z BETWEEN 2 AND 17 AND y BETWEEN 1 AND 6 AND x BETWEEN 3 AND 7",
    "axis_slice": f"{_VOXELS} SELECT series, seq, z, y, {_r('v')} FROM vox WHERE x = 3",
    "planes_in_crop": f"""{_VOXELS}, c AS (SELECT series, seq, z - 1 AS z, y, x - 2 AS x, v FROM vox WHERE z BETWEEN 1 AND 18 AND y BETWEEN 0 AND 6 AND x BETWEEN 2 AND 7),
        p AS (SELECT series, seq, 'xy' AS plane, y AS r, x AS k, v FROM c WHERE z = 9 UNION ALL SELECT series, seq, 'xz', z, x, v FROM c WHERE y = 3 UNION ALL SELECT series, seq, 'yz', z, y, v FROM c WHERE x = 2)
        SELECT series, seq, plane, r // 2 AS y, k // 2 AS x, {_r('v')} FROM p WHERE r % 2 = 0 AND k % 2 = 0""",
    "strided_slice": f"{_VOXELS} SELECT series, seq, z, (y - 1) // 3 AS y, x // 3 AS x, {_r('v')} FROM vox WHERE z = 5 AND y >= 1 AND (y - 1) % 3 = 0 AND x % 3 = 0",
    "orthogonal_planes": f"""{_VOXELS} SELECT series, seq, 'xy' AS plane, y AS row, x AS col, {_r('v')} FROM vox WHERE z = {_Z} UNION ALL SELECT series, seq, 'xz', z, x, {_r('v')} FROM vox WHERE y = {_Y}
        UNION ALL SELECT series, seq, 'yz', z, y, {_r('v')} FROM vox WHERE x = {_X}""",
    "index_lists": f"""{_BLOCKS} SELECT scan, n, CAST(k AS INTEGER) AS k, CASE WHEN k = 1 THEN CAST(n // 2 AS VARCHAR) ELSE array_to_string(list_transform(range(k), lambda i: i * (n - 1) // (k - 1)), ',') END AS indices
        FROM (SELECT scan, CAST(frames AS INTEGER) AS n, unnest(range(1, least(6, frames) + 1)) AS k FROM scans WHERE frames > 0)""",
    "crop_ranges": f"""{_BLOCKS} SELECT scan, n, raw, CAST(a AS INTEGER) AS start, CAST(b AS INTEGER) AS stop FROM (SELECT scan, CAST(frames AS INTEGER) AS n FROM scans WHERE frames > 0),
        LATERAL (VALUES ('0:5', 0, least(5, n)), (':5', 0, least(5, n)), ('-1:', n - 1, n), ('-3:', greatest(n - 3, 0), n), ('-20000:4', 0, least(4, n)), ('0:99', 0, least(99, n)), (':', 0, n)) t(raw, a, b)""",
    "voxel_diff": f"{_LAGGED} SELECT series, seq, prev_seq, z, y, x, {_r('d')} FROM raw",
    "diff_maxima": f"{_DIFFS} SELECT series, seq, prev_seq, round(max(max_abs_diff), 6) AS max_abs_diff FROM tops GROUP BY 1, 2, 3",
    "slice_pair": f"{_LAGGED} SELECT series, seq, prev_seq, z, y, x, {_r('d')} FROM raw WHERE z = 7",
    "sigma_mad": f"{_DIFFS} SELECT 'vectors' AS series, seq, round(sigma, 6) AS sigma FROM sig",
    "threshold_mask": f"{_DIFFS} SELECT series, seq, prev_seq, z, y, x, {_r('d')} FROM mask",
    "preview_slice": f"{_DIFFS} SELECT series, seq, prev_seq, z, {_r('max_abs_diff')} FROM tops QUALIFY row_number() OVER (PARTITION BY seq ORDER BY tops.max_abs_diff DESC, z) = 1",
    "reference_diff": f"{_VOXELS} SELECT a.series, a.seq, 3 AS prev_seq, round(CAST(max(abs(CAST(a.v - b.v AS FLOAT))) AS DOUBLE), 6) AS max_abs_diff FROM vox a JOIN vox b ON b.seq = 3 AND a.seq <> 3 AND a.z = b.z AND a.y = b.y AND a.x = b.x GROUP BY 1, 2",
    "deadband_diff": f"{_LAGGED} SELECT seq, z, y, x, round(sign(d) * greatest(abs(CAST(d AS DOUBLE)) - 0.2, 0), 6) AS d FROM raw",
    "pair_stages": f"""{_DIFFS}, one AS (SELECT * FROM raw WHERE seq = 1), best AS (SELECT z FROM tops WHERE seq = 1 ORDER BY max_abs_diff DESC, z LIMIT 1)
        SELECT 'shape' AS stage, CAST(count(*) AS BIGINT) AS rows, CAST(max(z) + 1 AS DOUBLE) AS value FROM vox WHERE seq IN (0, 1) UNION ALL SELECT 'slice_pair', count(*), 4 * count(*) FROM vox WHERE seq IN (0, 1) AND z = 10
        UNION ALL SELECT 'diff_slice_' || z, count(*), round(CAST(max(abs(d)) AS DOUBLE), 6) FROM one WHERE z BETWEEN 9 AND 11 GROUP BY z UNION ALL SELECT 'noise', 1, round(2.0 * sigma, 6) FROM sig WHERE seq = 1
        UNION ALL SELECT 'preview_slice', 1, z FROM best UNION ALL SELECT 'window', count(*), round(CAST(max(abs(m.d)) AS DOUBLE), 6) FROM mask m, best b WHERE m.seq = 1 AND abs(m.z - b.z) <= 2""",
    "local_window": f"""{_DIFFS}, best AS (SELECT seq, z AS centre FROM tops QUALIFY row_number() OVER (PARTITION BY seq ORDER BY max_abs_diff DESC, z) = 1)
        SELECT seq, centre, z, {_r('max_abs_diff')} FROM tops JOIN best USING (seq) WHERE abs(z - centre) <= 2""",
    "aligned_diff": f"""{_VOXELS}, p AS MATERIALIZED (SELECT seq * 20 + z AS key, y, x, v FROM vox)
        SELECT key, y, x, round(CAST(d AS DOUBLE), 6) AS d FROM (SELECT key, y, x, CAST(lead(v, 9) OVER (PARTITION BY key ORDER BY y, x) - v AS FLOAT) AS d FROM p) WHERE y < 5 AND x < 6""",
    "slice_labels": f"{_LABELS} SELECT seq, z, y, x, label // 100 AS label_y, label % 100 AS label_x FROM labels",
    "slice_components": f"{_LABELS} SELECT seq, z, y_min, y_max, x_min, x_max, voxel_count, {_r('peak_abs_diff', 'peak_signed_diff', 'sum_abs_diff', 'sum_signed_diff', 'z_weighted_sum', 'y_weighted_sum', 'x_weighted_sum', digits=4)} FROM comp",
    "large_components": f"{_LABELS} SELECT seq, z, y_min, y_max, x_min, x_max, voxel_count, {_r('peak_abs_diff', digits=4)} FROM comp WHERE voxel_count >= 2",
    "box_neighbours": f"""{_LABELS} SELECT a.seq, a.z, count(*) AS n FROM comp a JOIN comp b ON a.seq = b.seq AND a.z = b.z + 1 AND b.y_min <= a.y_max + 1 AND a.y_min <= b.y_max + 1 AND b.x_min <= a.x_max + 1 AND a.x_min <= b.x_max + 1 GROUP BY 1, 2""",
    "event_fold": f"{_FOLD} SELECT {_FOUND} FROM found",
    "track_events": f"{_FOLD} SELECT {_DESCRIBED} FROM ranked",
    "comparisons": f"{_FOLD} SELECT * FROM compared",
    "events_export": f"{_FOLD} SELECT * FROM compared JOIN (SELECT {_DESCRIBED} FROM ranked) USING (series, seq, prev_seq)",
    "catalog_events": f"{_RUN} SELECT p.series AS run_id, p.seq AS sequence_number, r.* EXCLUDE (seq) FROM pairs p JOIN (SELECT seq, {described_sql(CROP.start)} FROM ranked) r ON r.seq = pair",
    "catalog_comparisons": f"""{_RUN} SELECT p.series || '/' || p.seq AS id, p.series AS run_id, p.seq AS sequence_number, prev_seq AS previous_sequence_number, prev_dataset_name AS previous_dataset_root, prev_file_name AS previous_reconstruction_file,
        prev_mtime AS previous_reconstruction_mtime, dataset_name AS dataset_root, file_name AS reconstruction_file, mtime AS reconstruction_mtime, detected_event_count, stored_event_count, round(max_abs_diff, 4) AS max_abs_diff
        FROM pairs p JOIN compared c ON c.seq = pair""",
    "run_orphans": f"""{_RUN} SELECT 'comparisons' AS table, series || '/' || seq AS id, series AS missing FROM pairs WHERE seq % 2 = 0 AND series = '{SERIES[0]}'
        UNION ALL SELECT 'events', p.series || '/' || p.seq || '/' || event_rank, p.series || '/' || p.seq FROM ranked r JOIN pairs p ON r.seq = pair WHERE p.seq % 2 = 1""",
    "bucketed_diffs": f"{_LAGGED} SELECT series, seq, prev_seq, z, y, x, {_r('d')} FROM raw",
    "tiled_labels": f"{_LABELS} SELECT seq, z, y, x, label // 100 AS label_y, label % 100 AS label_x FROM labels",
    "tiled_components": f"{_LABELS} SELECT seq, z, y_min, y_max, x_min, x_max, voxel_count, {_r('peak_abs_diff', 'peak_signed_diff', 'sum_abs_diff', 'sum_signed_diff', 'z_weighted_sum', 'y_weighted_sum', 'x_weighted_sum', digits=4)} FROM comp",
    "events_on_slice": f"{_FOLD} SELECT {_DESCRIBED} FROM ranked WHERE z_min <= 10 AND z_max >= 10",
    "top_differences": f"{_DIFFS} SELECT series, seq, prev_seq, round(tops.max_abs_diff, 6) AS peak_abs_diff, z AS finish_order, CAST(row_number() OVER (PARTITION BY seq ORDER BY tops.max_abs_diff DESC, z) AS INTEGER) AS event_rank FROM tops QUALIFY event_rank <= 3",
    "block_mean_2d": f"{_VOXELS} SELECT series, seq, z, y // 3 AS y, x // 3 AS x, round(avg(CAST(v AS DOUBLE)), 6) AS v FROM vox GROUP BY 1, 2, 3, vox.y // 3, vox.x // 3",
    "block_mean_3d": f"{_VOXELS} SELECT series, seq, z // 3 AS z, y // 3 AS y, x // 3 AS x, round(avg(CAST(v AS DOUBLE)), 6) AS v FROM vox GROUP BY 1, 2, vox.z // 3, vox.y // 3, vox.x // 3",
    "subsample_3d": f"{_VOXELS} SELECT series, seq, z // 3 AS z, y // 3 AS y, x // 3 AS x, {_r('v')} FROM vox WHERE vox.z % 3 = 0 AND vox.y % 3 = 0 AND vox.x % 3 = 0",
    "slab_mean": f"{_VOXELS} SELECT series, seq, y, x, round(avg(CAST(v AS DOUBLE)), 6) AS v FROM vox WHERE z BETWEEN 4 AND 8 GROUP BY 1, 2, 3, 4",
    "sampled_stats": f"""{_VOXELS}{_STATS.format(step=2)} SELECT series, seq, n, {_r('low', 'high')}, {", ".join(f"round(p[{i + 1}], 6) AS {c}" for i, c in enumerate("p0_1 p0_5 p1 p5 p50 p95 p99 p99_5 p99_9".split()))}, {_r('sigma')}
        FROM st JOIN s USING (series, seq)""",
    "suggested_settings": f"""{_VOXELS}{_STATS.format(step=2)} SELECT series, seq, round(p[2], 6) AS clip_min, round(p[8], 6) AS clip_max, round(3 * sigma, 6) AS mask_below, 3 AS downsample, '640.0 B' AS size, '160.0 B' AS uint8_size,
        '80.0 B' AS size_by_2, '12.0 B' AS size_by_4 FROM st JOIN s USING (series, seq)""",
    "slab_mean_x": f"{_VOXELS} SELECT series, seq, z, y, round(avg(CAST(v AS DOUBLE)), 6) AS v FROM vox WHERE x BETWEEN 2 AND 6 GROUP BY 1, 2, 3, 4",
    "sigma_counted": f"{_LAGGED}, med AS (SELECT seq, median(CAST(d AS DOUBLE)) AS m FROM raw GROUP BY seq) SELECT 'vectors' AS series, seq, round(median(abs(CAST(d AS DOUBLE) - m)) / 0.6744897501960817, 6) AS sigma FROM raw JOIN med USING (seq) GROUP BY seq",
    "percentiles_counted": f"""{_VOXELS}{_STATS.format(step=1)} SELECT series, seq, n, {", ".join(f"round(p[{i + 1}], 6) AS {c}" for i, c in enumerate("p0_1 p0_5 p1 p5 p50 p95 p99 p99_5 p99_9".split()))} FROM st""",
    "preview_slice_strided": f"""{_LAGGED}, tops AS (SELECT series, seq, prev_seq, z, CAST(max(abs(d)) AS DOUBLE) AS top FROM raw WHERE (z % 5 = 0 OR z = 19) AND y % 2 = 0 AND x % 2 = 0 GROUP BY 1, 2, 3, 4)
        SELECT series, seq, prev_seq, z, round(top, 6) AS max_abs_diff FROM tops QUALIFY row_number() OVER (PARTITION BY seq ORDER BY top DESC, z) = 1""",
    "one_sided_range": f"""{_FILES}, ends AS (SELECT collection, position, max(seq) AS high FROM latest GROUP BY 1, 2)
        SELECT collection, position, seq, file_name FROM latest JOIN ends USING (collection, position) WHERE seq BETWEEN least({LATE}, high) AND greatest({LATE}, high) AND seq NOT IN ({_SKIP})""",
    "clip_mask": f"{_VOXELS} SELECT series, seq, z // 2 AS z, y // 2 AS y, x // 2 AS x, round(CAST({_MASKED} AS DOUBLE), 6) AS v FROM vox WHERE vox.z % 2 = 0 AND vox.y % 2 = 0 AND vox.x % 2 = 0",
    "to_uint8": f"""{_VOXELS} SELECT series, seq, (z - 1) // 2 AS z, y // 2 AS y, x // 2 AS x, CAST(floor(least(greatest((CAST({_MASKED} AS DOUBLE) - CAST({_LOW} AS DOUBLE)) / (CAST({_HIGH} AS DOUBLE) - CAST({_LOW} AS DOUBLE)), 0), 1) * 255) AS SMALLINT) AS v
        FROM vox WHERE vox.z BETWEEN 1 AND 18 AND (vox.z - 1) % 2 = 0 AND vox.y % 2 = 0 AND vox.x % 2 = 0""",
    "preview_views": f"""{_VOXELS}, views AS (SELECT series, seq, 'xy' AS plane, y // 3 AS row, x // 3 AS col, v FROM vox WHERE z BETWEEN 7 AND 9 AND y % 3 = 0 AND x % 3 = 0
          UNION ALL SELECT series, seq, 'xz', (z - 1) // 3, x // 3, v FROM vox WHERE z BETWEEN 1 AND 18 AND (z - 1) % 3 = 0 AND y BETWEEN 3 AND 5 AND x % 3 = 0
          UNION ALL SELECT series, seq, 'yz', (z - 1) // 3, y // 3, v FROM vox WHERE z BETWEEN 1 AND 18 AND (z - 1) % 3 = 0 AND x BETWEEN 3 AND 5 AND y % 3 = 0),
        m AS (SELECT series, seq, plane, row, col, CAST(avg(CAST(v AS DOUBLE)) AS FLOAT) AS v FROM views GROUP BY 1, 2, 3, 4, 5)
        SELECT series, seq, plane, row, col, round(CAST({_MASKED} AS DOUBLE), 6) AS v FROM m""",
    "preview_means": f"""{_VOXELS}, views AS (SELECT series, seq, 'xy' AS plane, y // 3 AS row, x // 3 AS col, v FROM vox WHERE z BETWEEN 6 AND 8
          UNION ALL SELECT series, seq, 'xz', z // 3, x // 3, v FROM vox WHERE y BETWEEN 3 AND 5 UNION ALL SELECT series, seq, 'yz', z // 3, y // 3, v FROM vox WHERE x BETWEEN 3 AND 5)
        SELECT series, seq, plane, row, col, round(CAST(CAST(avg(CAST(v AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) AS v FROM views GROUP BY 1, 2, 3, 4, 5""",
    "output_sizes": f"{_VOXELS} SELECT DISTINCT seq, '7,3,3' AS shape, CAST(252 AS BIGINT) AS bytes, '7,3,3' AS chunk FROM vox",
    "frame_grey": f"""{_VOXELS} SELECT seq, z, y, x, g AS r, g, g AS b FROM (SELECT seq, z, y, x, CAST(floor(least(greatest((CAST(v AS DOUBLE) - CAST(-0.25 AS DOUBLE)) / (CAST(0.25 AS DOUBLE) - CAST(-0.25 AS DOUBLE)), 0), 1) * 255) AS SMALLINT) AS g FROM vox)""",
    "frame_hot": f"""{_VOXELS}, t AS (SELECT CAST(i AS INTEGER) AS i, i / CAST(255 AS DOUBLE) AS p FROM range(256) r(i)),
        hot AS (SELECT i, CAST(floor(255 * CASE WHEN p < 0.365079 THEN 0.0416 + (1 - 0.0416) * p / 0.365079 ELSE 1 END) AS SMALLINT) AS r,
          CAST(floor(255 * CASE WHEN p < 0.365079 THEN 0 WHEN p < 0.746032 THEN (p - 0.365079) / (0.746032 - 0.365079) ELSE 1 END) AS SMALLINT) AS g,
          CAST(floor(255 * CASE WHEN p < 0.746032 THEN 0 WHEN p < 1 THEN (p - 0.746032) / (1 - 0.746032) ELSE 1 END) AS SMALLINT) AS b FROM t),
        v AS (SELECT seq, z, y, x, CAST(least(floor(256 * least(greatest((CAST(v AS DOUBLE) - CAST(-0.25 AS DOUBLE)) / (CAST(0.25 AS DOUBLE) - CAST(-0.25 AS DOUBLE)), 0), 1)), 255) AS INTEGER) AS i FROM vox)
        SELECT seq, z, y, x, r, g, b FROM v JOIN hot USING (i)""",
    "raw_volume_range": f"{_VOXELS} SELECT series, seq, z, y, x, {_r('v')} FROM vox WHERE seq BETWEEN 4 AND 15 AND z BETWEEN 3 AND 8",
    "frame_percentiles": f"{_VOXELS} SELECT seq, z, round(quantile_cont(CAST(v AS DOUBLE), 0.01), 6) AS low, round(quantile_cont(CAST(v AS DOUBLE), 0.99), 6) AS high FROM vox GROUP BY seq, z",
    "frame_pairs": f"""{_LAGGED}, grid AS (SELECT seq, z, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x FROM (SELECT DISTINCT seq, z FROM raw), range(8) a(y), range(20) b(x))
        SELECT g.seq, g.z, g.y, g.x, round(CASE WHEN g.x < 8 THEN CAST(v.v AS DOUBLE) WHEN g.x < 12 THEN 1.0 ELSE coalesce(CAST(d.d AS DOUBLE), 0.0) END, 6) AS v
        FROM grid g LEFT JOIN vox v ON v.seq = g.seq AND v.z = g.z AND v.y = g.y AND v.x = g.x LEFT JOIN raw d ON d.seq = g.seq AND d.z = g.z AND d.y = g.y AND d.y < 6 AND d.x = g.x - 12""",
    "screening_frames": f"""{_PLANES} SELECT series, plane, seq, y, x, round(least(greatest((v - CAST(-0.3 AS DOUBLE)) / (CAST(0.3 AS DOUBLE) - CAST(-0.3 AS DOUBLE)), 0), 1), 6) AS v FROM planes""",
    "comparison_frames": f"""{_DIFFS}, dv AS (SELECT series, seq, z, y, x, sign(d) * greatest(abs(CAST(d AS DOUBLE)) - CAST(0.1 AS DOUBLE), 0) AS v FROM raw),
        lp AS (SELECT series, seq, 'xy' AS plane, y, x, CAST(v AS DOUBLE) AS v FROM vox WHERE z = {_Z} UNION ALL SELECT series, seq, 'xz', z, x, v FROM vox WHERE y = {_Y} UNION ALL SELECT series, seq, 'yz', z, y, v FROM vox WHERE x = {_X}),
        rp AS (SELECT series, seq, 'xy' AS plane, y, x, v FROM dv WHERE z = {_Z} UNION ALL SELECT series, seq, 'xz', z, x, v FROM dv WHERE y = {_Y} UNION ALL SELECT series, seq, 'yz', z, y, v FROM dv WHERE x = {_X}),
        lim AS (SELECT series, plane, seq, quantile_cont(v, 0.01) AS low, quantile_cont(v, 0.99) AS high FROM lp GROUP BY 1, 2, 3),
        out AS (SELECT series, plane, seq, y, x, least(greatest((v - low) / (high - low), 0), 1) AS v FROM lp JOIN lim USING (series, plane, seq) WHERE seq > 0
          UNION ALL SELECT series, plane, seq, y, x + 12, least(greatest(v + CAST(0.5 AS DOUBLE), 0), 1) FROM rp
          UNION ALL SELECT DISTINCT series, plane, seq, y, CAST(8 + g AS INTEGER), CAST(1.0 AS DOUBLE) FROM rp, range(4) t(g))
        SELECT series, plane, seq, y, x, round(v, 6) AS v FROM out""",
    "stage_positions": """SELECT DISTINCT l_partkey, round(-1 * (l_partkey - CAST(2016.0 AS DOUBLE) / 2) * CAST(0.65 AS DOUBLE) / 1000, 6) AS mm, round(CAST(l_partkey AS DOUBLE) / 2 * CAST(0.8 AS DOUBLE) * CAST(0.65 AS DOUBLE) / 1000, 6) AS half_mm,
        round(fmod(fmod(l_partkey * CAST(-7.5 AS DOUBLE), 360) + 360, 360), 6) AS angle FROM lineitem""",
}
