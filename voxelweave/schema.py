"""Column layouts of tiles, components, events and result tables."""

from __future__ import annotations

TILE = "series string, seq int, z int, y0 int, x0 int, ny int, nx int, data array<float>"
RECON_FILE = "collection string, position string, seq int, dataset_name string, file_name string, mtime timestamp_ntz, length bigint, valid boolean"
COMPONENT = (
    "label bigint, y_min int, y_max int, x_min int, x_max int, voxel_count bigint, peak_abs_diff double, peak_signed_diff double, "
    "sum_abs_diff double, sum_signed_diff double, z_weighted_sum double, y_weighted_sum double, x_weighted_sum double"
)
EVENT = (
    "event_id int, finish_order int, z_min int, z_max int, y_min int, y_max int, x_min int, x_max int, voxel_count bigint, peak_abs_diff double, "
    "peak_signed_diff double, sum_abs_diff double, sum_signed_diff double, z_weighted_sum double, y_weighted_sum double, x_weighted_sum double"
)
#: Columns of the result tables.
RUNS = """id created_at reference_path reference_dataset_root reference_reconstruction_file dataset_path start_number stop_number
    skipped_scans baseline_sigma threshold_sigma threshold_value min_event_size min_slice_component_size merge_gap crop_z_start crop_y_start
    crop_x_start max_events""".split()
COMPARISONS = """id run_id sequence_number previous_sequence_number previous_dataset_root previous_reconstruction_file
    previous_reconstruction_mtime dataset_root reconstruction_file reconstruction_mtime detected_event_count stored_event_count
    max_abs_diff""".split()
EVENTS = """id comparison_id event_rank voxel_count peak_abs_diff peak_signed_diff mean_abs_diff mean_signed_diff z_centroid y_centroid
    x_centroid z_min z_max y_min y_max x_min x_max full_z_centroid full_y_centroid full_x_centroid full_z_min full_z_max full_y_min
    full_y_max full_x_min full_x_max""".split()
