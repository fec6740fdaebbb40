"""Encoders of frames: PNG and animated GIF, from rows to bytes, without imaging libraries."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def png(image: np.ndarray) -> bytes:
    """A grey (h, w) or colour (h, w, 3) image of bytes."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w = image.shape[:2]
    rows = np.zeros((h, 1 + image[0].size), np.uint8)  # each row starts with filter 0
    rows[:, 1:] = image.reshape(h, -1)
    head = struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def _lzw(pixels: bytes) -> bytes:
    """GIF's variable-width codes over 8-bit pixels, in sub-blocks."""
    clear, end = 256, 257
    table: dict[tuple[int, int], int] = {}
    out, bits, n, width, prefix = bytearray(), 0, 0, 9, -1

    def put(code: int) -> None:
        nonlocal bits, n
        bits |= code << n
        n += width
        while n >= 8:
            out.append(bits & 255)
            bits >>= 8
            n -= 8

    put(clear)
    for p in pixels:
        if prefix < 0:
            prefix = p
        elif (prefix, p) in table:
            prefix = table[prefix, p]
        else:
            put(prefix)
            code = 258 + len(table)
            if code > 4095:
                put(clear)
                table.clear()
                width = 9
            else:
                table[prefix, p] = code
                if code == 1 << width and width < 12:
                    width += 1
            prefix = p
    if prefix >= 0:
        put(prefix)
    put(end)
    if n:
        out.append(bits & 255)
    return b"".join(bytes([len(out[i : i + 255])]) + out[i : i + 255] for i in range(0, len(out), 255)) + b"\0"


def gif(images: list[np.ndarray], fps: float = 2.0) -> bytes:
    """A looping animation of grey (h, w) images; smaller ones stand in the upper left corner."""
    h, w = max(i.shape[0] for i in images), max(i.shape[1] for i in images)
    delay = round(100 / max(fps, 1))
    palette = bytes(v for k in range(256) for v in (k, k, k))
    out = [b"GIF89a" + struct.pack("<HHBBB", w, h, 0xF7, 0, 0) + palette + b"\x21\xff\x0bNETSCAPE2.0\x03\x01\0\0\0"]
    for i in images:
        out.append(b"\x21\xf9\x04\x04" + struct.pack("<H", delay) + b"\0\0")
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, i.shape[1], i.shape[0], 0) + b"\x08" + _lzw(i.astype(np.uint8).tobytes()))
    return b"".join(out) + b"\x3b"


def _image(pdf: pd.DataFrame) -> np.ndarray:
    out = np.zeros((int(pdf.y.max()) + 1, int(pdf.x.max()) + 1), np.uint8)
    out[pdf.y, pdf.x] = np.floor(np.clip(pdf.v, 0, 1) * 255)
    return out


def encode_png(frames: DataFrame, by: list[str]) -> DataFrame:
    """(by, png) of normalised frames (by, y, x, v in 0..1); a group is one image."""
    kinds = ", ".join(f"{c} {frames.schema[c].dataType.simpleString()}" for c in by)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, png(_image(pdf)))], columns=[*by, "png"])

    return frames.groupBy(*by).applyInPandas(run, f"{kinds}, png binary")


def encode_gif(frames: DataFrame, by: list[str], order: str, fps: float = 2.0) -> DataFrame:
    """(by, frames, gif): one animation for each group, its frames in the given order."""
    kinds = ", ".join(f"{c} {frames.schema[c].dataType.simpleString()}" for c in by)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        images = [_image(f) for _, f in pdf.groupby(order, sort=True)]
        return pd.DataFrame([(*key, len(images), gif(images, fps))], columns=[*by, "frames", "gif"])

    return frames.groupBy(*by).applyInPandas(run, f"{kinds}, frames int, gif binary")
