import struct
import zlib

import numpy as np
import pytest

from voxelweave import images


def read_png(data):
    at, body, head = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + part)
        head = struct.unpack(">IIBB", part[:10]) if kind == b"IHDR" else head
        body += part if kind == b"IDAT" else b""
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(head[1], -1)
    return rows[:, 1:].reshape(head[1], head[0], -1).squeeze()


def read_gif(data):
    """Frames of a GIF with a global palette, by the format's description."""
    assert data[:6] == b"GIF89a"
    at, frames = 13 + 768, []
    while data[at] != 0x3B:
        if data[at] == 0x21:
            at += 2
            while data[at]:
                at += data[at] + 1
            at += 1
            continue
        w, h = struct.unpack("<HH", data[at + 5 : at + 9])
        at += 11
        codes = bytearray()
        while data[at]:
            codes += data[at + 1 : at + 1 + data[at]]
            at += data[at] + 1
        at += 1
        frames.append(np.frombuffer(unpack(codes), np.uint8).reshape(h, w))
    return frames


def unpack(codes):
    value, have, at, width = 0, 0, 0, 9
    table, last, out = {}, None, bytearray()
    while True:
        while have < width:
            value |= codes[at] << have
            have, at = have + 8, at + 1
        code, value, have = value & ((1 << width) - 1), value >> width, have - width
        if code == 257:
            return bytes(out)
        if code == 256:
            table, width, last = {k: bytes([k]) for k in range(256)}, 9, None
            continue
        entry = table[code] if code in table else last + last[:1]
        out += entry
        if last is not None and len(table) < 4096 - 2:
            table[len(table) + 2] = last + entry[:1]
            if len(table) + 2 == 1 << width and width < 12:
                width += 1
        last = entry


@pytest.mark.parametrize("shape", [(1, 1), (5, 9), (120, 130)])
def test_round_trips(shape):
    rng = np.random.default_rng(1)
    grey, flat = rng.integers(0, 256, shape).astype(np.uint8), np.full(shape, 7, np.uint8)
    assert (read_png(images.png(grey)) == grey.squeeze()).all()
    colour = rng.integers(0, 256, (*shape, 3)).astype(np.uint8)
    assert (read_png(images.png(colour)) == colour.squeeze()).all()
    out = read_gif(images.gif([grey, flat, grey[:1]]))
    assert (out[0] == grey).all() and (out[1] == flat).all() and (out[2] == grey[:1]).all()


def test_frames_become_files(spark):
    rows = [(s, y, x, (s + y + x) / 10) for s in (2, 1, 3) for y in range(2) for x in range(3)]
    df = spark.createDataFrame([("a", *r) for r in rows], "plane string, seq int, y int, x int, v double")
    out = {r.seq: read_png(bytes(r.png)) for r in images.encode_png(df, ["plane", "seq"]).collect()}
    assert out[1].tolist() == [[25, 51, 76], [51, 76, 102]]
    row = images.encode_gif(df, ["plane"], "seq").head()
    frames = read_gif(bytes(row.gif))
    assert row.frames == 3 and [f[0, 0] for f in frames] == [25, 51, 76]
