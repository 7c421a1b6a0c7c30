"""Decoding of image files that need no codec library: PNG, BMP and binary PNM. Other formats take an injected decoder."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def decode_rgb(data: bytes | None) -> np.ndarray | None:
    """(H, W, 3) bytes in order red, green, blue; None if the file cannot be read."""
    try:
        if not data:
            return None
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(data)
        if data[:2] == b"BM":
            return _bmp(data)
        if data[:2] in (b"P5", b"P6"):
            return _pnm(data)
    except (ValueError, IndexError, KeyError, struct.error, zlib.error):
        return None
    return None


def decode_bgr(data: bytes | None) -> np.ndarray | None:
    """The same in order blue, green, red."""
    image = decode_rgb(data)
    return None if image is None else image[..., ::-1]


def _png(data: bytes) -> np.ndarray:
    at, packed, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, dtype=np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    width, height, depth, colour, _, _, interlace = head
    if interlace:
        raise ValueError("interlaced")
    channels = _CHANNELS[colour]
    step, stride = max(1, channels * depth // 8), (width * channels * depth + 7) // 8
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8)[: height * (stride + 1)].reshape(height, stride + 1)
    rows, above = np.empty((height, stride), dtype=np.uint8), np.zeros(stride, dtype=np.uint8)
    for y in range(height):
        above = rows[y] = _unfilter(int(raw[y, 0]), raw[y, 1:], above, step)
    if depth == 16:
        rows = rows[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(rows, axis=1).reshape(height, -1, depth)[:, : width * channels]
        rows = bits @ (1 << np.arange(depth)[::-1])
        if colour != 3:
            rows = rows * 255 // ((1 << depth) - 1)
    pixels = rows.reshape(height, width, channels)
    if colour == 3:
        return palette[pixels[..., 0]]
    return (np.repeat(pixels[..., :1], 3, axis=2) if channels < 3 else pixels[..., :3]).astype(np.uint8)


def _unfilter(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return row
    if kind == 2:
        return row + above
    if kind == 1:  # each byte adds the one of the pixel before: a running sum per channel
        wide = np.zeros(-(-len(row) // step) * step, dtype=np.uint8)
        wide[: len(row)] = row
        return np.cumsum(wide.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)[: len(row)]
    if kind not in (3, 4):
        raise ValueError("unknown filter")
    out, up = bytearray(row.tobytes()), above.tobytes()
    for i in range(len(out)):
        a, b = out[i - step] if i >= step else 0, up[i]
        if kind == 3:
            guess = (a + b) // 2
        else:
            c = up[i - step] if i >= step else 0
            p = a + b - c
            guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        out[i] = (out[i] + guess) & 255
    return np.frombuffer(bytes(out), dtype=np.uint8)


def _bmp(data: bytes) -> np.ndarray:
    begin, width, height, bits = struct.unpack_from("<I", data, 10)[0], *struct.unpack_from("<ii", data, 18), struct.unpack_from("<H", data, 28)[0]
    if bits not in (24, 32) or struct.unpack_from("<I", data, 30)[0] not in (0, 3):
        raise ValueError("unsupported BMP")
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, dtype=np.uint8, offset=begin, count=stride * abs(height)).reshape(abs(height), stride)
    pixels = rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[..., 2::-1]
    return pixels[::-1] if height > 0 else pixels


def _pnm(data: bytes) -> np.ndarray:
    fields, at = [], 2
    while len(fields) < 3:
        while data[at : at + 1].isspace() or data[at : at + 1] == b"#":
            at = data.index(b"\n", at) + 1 if data[at : at + 1] == b"#" else at + 1
        end = at
        while data[end : end + 1].isdigit():
            end += 1
        fields.append(int(data[at:end]))
        at = end
    width, height, most = fields
    if most != 255:
        raise ValueError("unsupported PNM")
    channels = 3 if data[:2] == b"P6" else 1
    pixels = np.frombuffer(data, dtype=np.uint8, offset=at + 1, count=width * height * channels).reshape(height, width, channels)
    return np.repeat(pixels, 3, axis=2) if channels == 1 else pixels
