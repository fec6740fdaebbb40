import random

import pandas as pd
import pytest

from voxelweave.operators.events import fold

COLS = ["z", "label", "y_min", "y_max", "x_min", "x_max", "voxel_count", "peak_abs_diff", "peak_signed_diff", "sum_abs_diff", "sum_signed_diff", "z_weighted_sum", "y_weighted_sum", "x_weighted_sum"]


def region(z, x0, x1, label=None, n=1, peak=1.0, y=(0, 0)):
    return (z, x0 if label is None else label, *y, x0, x1, n, peak, -peak, peak, -peak, z * n, 0.0, 0.0)


def run(*regions, gap=0):
    return [(e.number, e.box, e.voxels, e.peak[0]) for e in fold(pd.DataFrame(regions, columns=COLS), gap)]


def test_split_forks():
    out = run(region(0, 0, 9), region(1, 0, 2), region(1, 6, 9))
    assert out == [(1, [0, 0, 0, 1, 0, 9], 2, 1.0), (2, [1, 0, 6, 1, 0, 9], 1, 1.0)]


def test_merge_joins_into_the_oldest():
    out = run(region(0, 0, 2), region(0, 6, 9, peak=3.0), region(1, 1, 7))
    assert out == [(1, [0, 0, 0, 1, 0, 9], 3, 3.0)]


def test_gap_in_z_ends_an_event():
    assert len(run(region(0, 0, 2), region(2, 0, 2))) == 2


def test_box_of_all_slices_counts():
    # the region at z=2 touches only the box of z=0
    assert len(run(region(0, 0, 20), region(1, 0, 1), region(2, 18, 20))) == 1


@pytest.mark.parametrize(("gap", "n"), [(2, 1), (1, 2)])
def test_merge_gap(gap, n):
    assert len(run(region(0, 0, 2), region(1, 4, 5), gap=gap)) == n


def test_equal_peaks_keep_the_first():
    rows = [region(0, 0, 2, peak=2.0), region(1, 0, 2, peak=2.0)]
    rows[1] = (*rows[1][:8], 2.0, *rows[1][9:])
    e = fold(pd.DataFrame(rows, columns=COLS), 0)[0]
    assert e.peak == (2.0, -2.0)


def naive(regions, gap):
    """The rules, step by step, over plain lists."""
    events, ended, n = [], [], 0
    for z in range(min(r[0] for r in regions), max(r[0] for r in regions) + 1):
        for r in sorted((r for r in regions if r[0] == z), key=lambda r: r[1]):
            def close(e, r=r):
                return e["y1"] + gap >= r[2] and r[3] + gap >= e["y0"] and e["x1"] + gap >= r[4] and r[5] + gap >= e["x0"]

            match = [e for e in events if e["last"] == z - 1 and close(e)]
            if not match:
                n += 1
                match = [{"id": n, "y0": r[2], "y1": r[3], "x0": r[4], "x1": r[5], "n": 0, "last": z}]
                events.append(match[0])
            target = match[0]
            for e in match[1:]:
                target.update(y0=min(target["y0"], e["y0"]), y1=max(target["y1"], e["y1"]), x0=min(target["x0"], e["x0"]), x1=max(target["x1"], e["x1"]), n=target["n"] + e["n"])
                events.remove(e)
            target.update(y0=min(target["y0"], r[2]), y1=max(target["y1"], r[3]), x0=min(target["x0"], r[4]), x1=max(target["x1"], r[5]), n=target["n"] + r[6], last=z)
        ended += [e for e in events if e["last"] != z]
        events = [e for e in events if e["last"] == z]
    return [(e["id"], e["n"], e["y0"], e["y1"], e["x0"], e["x1"]) for e in ended + events]


@pytest.mark.parametrize("seed", range(30))
def test_fold_equals_the_rules(seed):
    rnd = random.Random(seed)
    regions = []
    for z in range(12):
        for k in range(rnd.randint(0, 5)):
            x, y = rnd.randint(0, 30), rnd.randint(0, 6)
            regions.append(region(z, x, x + rnd.randint(0, 5), label=k, n=rnd.randint(1, 9), y=(y, y + rnd.randint(0, 2))))
    if regions:
        gap = rnd.randint(0, 3)
        got = [(e.number, e.voxels, e.box[1], e.box[4], e.box[2], e.box[5]) for e in fold(pd.DataFrame(regions, columns=COLS), gap)]
        assert got == naive(regions, gap)
