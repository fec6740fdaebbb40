import math

import pytest
from pyspark.sql import functions as F

from voxelweave.functions import names, ranges, scalars


def one(spark, **columns):
    row = spark.range(1).select(*(c.alias(n) for n, c in columns.items())).head()
    return row[0] if len(columns) == 1 else row


@pytest.mark.parametrize(
    ("raw", "want"),
    [(None, (0, 10)), ("2:5", (2, 5)), (":5", (0, 5)), ("3:", (3, 10)), ("-3:", (7, 10)), ("-20:4", (0, 4)), ("2:99", (2, 10)), (" 1 : 2 ", (1, 2))],
)
def test_crop_range(spark, raw, want):
    assert tuple(one(spark, r=ranges.crop_range(F.lit(raw).cast("string"), F.lit(10)))) == want


@pytest.mark.parametrize("raw", ["5:5", "7", "8:3", "a:3", "1:2:3"])
def test_bad_crop_range(spark, raw):
    with pytest.raises(Exception, match="crop range"):
        one(spark, r=ranges.crop_range(F.lit(raw), F.lit(10)))


@pytest.mark.parametrize(
    ("raw", "want"),
    [("7,12,15-17", [7, 12, 15, 16, 17]), ("17-15", [15, 16, 17]), ("", []), (None, []), ("1,,2", [1, 2]), (" 3 , 1-2 ", [1, 2, 3]), ("12,12", [12])],
)
def test_number_list(spark, raw, want):
    assert one(spark, r=ranges.number_list(F.lit(raw).cast("string"))) == want


def test_number_list_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, r=ranges.number_list(F.lit("a")))


@pytest.mark.parametrize(("k", "want"), [(1, [5]), (4, [0, 3, 6, 9]), (3, [0, 4, 9]), (2, [0, 9])])
def test_slice_indices(spark, k, want):
    assert one(spark, r=ranges.slice_indices(F.lit(10), F.lit(k))) == want


def test_centre(spark):
    sizes = F.array(F.lit(20), F.lit(8), F.lit(7))
    assert one(spark, r=ranges.centre(F.lit(None).cast("string"), sizes)) == [10, 4, 3]
    assert one(spark, r=ranges.centre(F.lit("-1, 99,2"), sizes)) == [0, 7, 2]


@pytest.mark.parametrize(("voxels", "target", "want"), [(1280, 1280, 1), (1280, 160, 2), (1280, 0, 1), (1000, 1, 10), (1001, 1, 11), (10**12, 10**6, 100)])
def test_sampling_step(voxels, target, want):
    assert ranges.sampling_step(voxels, target) == want


@pytest.mark.parametrize(("voxels", "target"), [(1280, 1280), (1280, 160), (1280, 0), (1000, 1), (1001, 1), (999, 1), (10**12, 10**6), (2368 * 3300 * 3300, 10**6), (0, 5)])
def test_stride_of_a_column(spark, voxels, target):
    assert one(spark, r=ranges.stride(F.lit(voxels).cast("bigint"), target)) == ranges.sampling_step(voxels, target)


def test_options_are_checked():
    with pytest.raises(ValueError, match="b must"):
        ranges.check_options(a=1, b=0, c=None)


def test_names(spark):
    def both(n):
        c = F.lit(n)
        return tuple(one(spark, a=names.sequence_number(c), b=names.sequence_number(c, r"_(\d+)$")))

    assert [both(n) for n in ("a_0002", "a", "a_12", "a_00012")] == [(2, 2), (0, 0), (0, 12), (0, 12)]
    assert one(spark, p=names.position_name(F.lit("c0_click_0003"), F.lit("c0"))) == "click"
    assert one(spark, p=names.position_name(F.lit("other_0003"), F.lit("c0"))) == "other"
    assert one(spark, p=names.dataset_root(F.lit("/a/b/c_0001/reconstructed_volumes/x/y.hdf5"))) == "/a/b/c_0001"
    assert one(spark, p=names.is_volume_file(F.lit("V_HistoGram.hdf5"))) is False
    assert one(spark, p=names.frame_label(F.lit(7), F.lit(3))) == "#0007 prev #0003"
    assert [one(spark, k=names.scan_kind(F.lit(k).cast("int"))) for k in (0, 1, 2, 3, None)] == ["projection", "flat", "dark", "unknown", "unknown"]


def test_bytes(spark):
    def byte(v, low=0.0, high=10.0, mask=None):
        return one(spark, b=scalars.to_uint8(scalars.clip_and_mask(F.lit(v), low, high, mask), low, high))

    assert [byte(v) for v in (-1.0, 5.0, 9.999, 10.0)] == [0, 127, 254, 255]
    assert byte(0.5, -10.0, 10.0, 1.0) == 127


def test_deadband(spark):
    assert [one(spark, d=scalars.deadband(F.lit(v), 2.0)) for v in (5.0, -5.0, 1.0)] == [3.0, -3.0, 0.0]
    assert one(spark, d=scalars.deadband(F.lit(5.0), -1.0)) == 5.0


def test_normalised(spark):
    def n(v, a, b):
        return one(spark, v=scalars.normalised(F.lit(v), F.lit(a), F.lit(b)))

    assert n(math.nan, -1.0, 1.0) == 0.5 and n(math.inf, 0.0, 1.0) == 0.0 and n(3.0, 3.0, 3.0) == 0.5 and n(9.0, 0.0, 1.0) == 1.0


def test_shapes_and_text(spark):
    shape = F.array(F.lit(20), F.lit(8), F.lit(8))
    assert one(spark, s=scalars.output_shape(shape, 3)) == [7, 3, 3]
    assert one(spark, s=scalars.size_bytes(shape, 4)) == 5120
    assert [one(spark, s=scalars.readable_bytes(F.lit(n))) for n in (5, 1023, 1280, 2048, 5 << 20, 3 << 30, 7 << 40, 2000 << 40)] == ["5.0 B", "1023.0 B", "1.2 KB", "2.0 KB", "5.0 MB", "3.0 GB", "7.0 TB", "2000.0 TB"]
    assert one(spark, s=scalars.progress_bar(F.lit(1), F.lit(2), 4)) == "[##--]"
    assert one(spark, a=scalars.full_turn(F.lit(-7.0))) == 353.0
    assert one(spark, m=scalars.overlaid(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3)))) == {"a": 1, "b": 3}


def test_planes_and_centres(spark):
    assert one(spark, p=ranges.checked_planes(F.lit(" XY ,,yz"))) == ["xy", "yz"]
    assert one(spark, p=ranges.plane_list(F.lit(None).cast("string"))) == []
    with pytest.raises(Exception, match="no such planes: ab, q"):
        one(spark, p=ranges.checked_planes(F.lit("ab,xz,Q")))
    sizes = F.array(F.lit(20), F.lit(8), F.lit(8))
    assert one(spark, c=ranges.centre(F.lit("30,1,-2"), sizes)) == [19, 1, 0]
    assert one(spark, c=ranges.centre(F.lit("3, 1,2"), sizes, strict=True)) == [3, 1, 2]
    with pytest.raises(Exception, match="centre outside"):
        one(spark, c=ranges.centre(F.lit("20,1,2"), sizes, strict=True))
    assert ranges.target_to_source(4, 3, 2) == 11


def test_titles_and_positions(spark):
    def held(mode, chosen):
        return one(spark, p=names.comparison_position_name(F.lit(mode), F.lit("a"), F.lit(chosen).cast("string")))

    assert [held("same", None), held("same", "b"), held("all", "b")] == ["a", "b", None]
    title = names.display_title(F.lit("d"), F.lit("f.h5"), F.lit("e"), F.lit("g.h5"))
    assert one(spark, t=title) == "reference: d | f.h5\ncurrent: e | g.h5"


@pytest.mark.parametrize(
    ("options", "wrong"),
    [
        ({"output_name": "a", "start": 3, "output": "o"}, "names one volume"), ({"output": None}, "output is needed"), ({"level": 10}, "between 0 and 9"), ({"display_min": 2.0, "display_max": 2.0}, "display_min"),
        ({"merge_gap": -1}, "merge_gap must not"), ({"floor_fraction": -0.1}, "floor_fraction"), ({"frames_only": True, "preview": True}, "leaves out"), ({"jobs": 0}, "jobs must"), ({"frames_per_second": 0}, "frames_per_second must"),
    ],
)
def test_requests_are_checked(options, wrong):
    with pytest.raises(ValueError, match=wrong):
        ranges.check_request(**options)


def test_fine_requests():
    ranges.check_request()
    ranges.check_request(output=None, preview_only=True, level=0, display_min=1.0, merge_gap=0, frames_only=True, preview=False, jobs=2)
    ranges.check_request(output="o", output_name="a", start=None)
