"""The jobs as registered queries, and their SQL."""

from __future__ import annotations

import json

from voxelweave.plans import oracle

from . import portal_index, track_series

QUERIES = {f.__name__: f for f in (track_series.job1_track_series, portal_index.job2_portal_index)}

_TRACK = json.loads(track_series.CONFIG.read_text())
_CROP = tuple(tuple(_TRACK["crop"][a]) for a in "zyx")

JOB1 = f"""{oracle.tracked_sql(_TRACK["series"], [int(_TRACK["skip"])], _CROP)}
SELECT p.series AS run_id, p.seq AS sequence_number, p.prev_seq AS previous_sequence_number, dataset_name AS dataset_root, prev_dataset_name AS previous_dataset_root, file_name AS reconstruction_file,
  prev_file_name AS previous_reconstruction_file, mtime AS reconstruction_mtime, prev_mtime AS previous_reconstruction_mtime, e.* EXCLUDE (seq),
  detected_event_count, stored_event_count, round(max_abs_diff, 4) AS max_abs_diff, round(sigma, 4) AS baseline_sigma, round(2.0 * sigma, 4) AS threshold_value
FROM pairs p JOIN base ON line = pair // 100000 JOIN compared c ON c.seq = pair
LEFT JOIN (SELECT seq, {oracle.described_sql(tuple(r[0] for r in _CROP))} FROM ranked) e ON e.seq = pair
"""

_POSITIONS = ", ".join(f"'{p}'" for p in json.loads(portal_index.CONFIG.read_text())["positions"])

JOB2 = f"""
WITH u AS (SELECT page_id, url, coalesce(html, '') AS html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, nullif(lower(regexp_extract(rest, '^[^/?#]*')), '') AS host, list_filter(string_split(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '/'), lambda p: p <> '') AS parts FROM u),
s AS (SELECT *, CASE WHEN host IS NOT NULL AND len(parts) = 2 THEN TRY_CAST(nullif(regexp_extract(parts[2], '^([0-9]+)(\\.[a-z]+)?$', 1), '') AS INTEGER) END AS seq FROM h),
e AS (SELECT page_id, host AS collection, CASE WHEN seq IS NOT NULL THEN parts[1] END AS position, seq, host || '_' || parts[1] || '_' || printf('%04d', seq) AS dataset_name, CASE WHEN seq IS NOT NULL THEN parts[2] END AS file_name,
  nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') AS title, CAST(strlen(html) AS BIGINT) AS length, url FROM s),
n AS (SELECT collection, position, count(*) AS entries, CAST(sum(length) AS BIGINT) AS bytes, min(seq) AS first_seq, max(seq) AS newest_seq FROM e WHERE seq IS NOT NULL GROUP BY 1, 2),
l AS (SELECT collection, position, page_id AS newest_page FROM e WHERE seq IS NOT NULL QUALIFY row_number() OVER (PARTITION BY collection, position ORDER BY seq DESC, page_id DESC NULLS LAST) = 1)
SELECT e.*, regexp_replace(dataset_name, '_\\d{{4}}$', '') AS series, {oracle.SIZE.format('length')} AS size, CASE WHEN position IN ({_POSITIONS}) THEN position ELSE 'other' END AS section, entries, bytes, first_seq, newest_seq, newest_page
FROM e LEFT JOIN n USING (collection, position) LEFT JOIN l USING (collection, position)
"""

ORACLE = {"job1_track_series": JOB1, "job2_portal_index": JOB2}
