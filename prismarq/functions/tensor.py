"""Array and tensor arithmetic: higher-order column expressions, and NumPy for whole tensors."""

from __future__ import annotations

import ast
import struct

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-8


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def _sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(doubles(v), lambda x: x * x)))


def cosine(a: Column, b: Column, eps: float = EPS) -> Column:
    """Cosine similarity; ``eps`` is added to each norm."""
    return dot(a, b) / ((norm(a) + F.lit(eps)) * (norm(b) + F.lit(eps)))


def l2_normalise(v: Column, eps: float = 1e-5) -> Column:
    """v / (norm + eps)."""
    n = norm(v)
    return F.transform(doubles(v), lambda x: x / (n + F.lit(eps)))


def l2_normalise_floor(v: Column, floor: float = EPS) -> Column:
    """v / max(norm, floor)."""
    n = F.greatest(norm(v), F.lit(floor))
    return F.transform(doubles(v), lambda x: x / n)


def argmax(v: Column) -> Column:
    """First position, from 0, of the largest element."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("bigint")


def min_max(v: Column) -> Column:
    """Elements scaled to [0, 1]; all 0 if they are equal."""
    lo, hi = F.array_min(doubles(v)), F.array_max(doubles(v))
    return F.transform(doubles(v), lambda x: F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(F.lit(0.0)))


def foreground_min_max(v: Column, mask: Column) -> Column:
    """Elements where ``mask`` is positive scaled to [0, 1] by their own range; background 0."""
    pairs = F.zip_with(doubles(v), mask, lambda x, m: F.struct(x.alias("x"), (m > 0).alias("fg")))
    inside = F.transform(F.filter(pairs, lambda p: p["fg"]), lambda p: p["x"])
    lo, hi = F.array_min(inside), F.array_max(inside)
    return F.transform(pairs, lambda p: F.when(p["fg"] & (hi > lo), (p["x"] - lo) / (hi - lo)).otherwise(F.lit(0.0)))


def clip_range(x: Column, lo: Column, hi: Column) -> Column:
    """x between two bounds scaled to [0, 1] and clipped; 0 if the bounds meet."""
    return F.when(hi > lo, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - lo) / (hi - lo)))).otherwise(F.lit(0.0))


def simcc_peak(x: Column, y: Column, ratio: float = 2.0) -> Column:
    """Struct (x, y, conf) from two one-dimensional score arrays; -1 where the confidence is not positive."""
    conf = F.least(F.array_max(x), F.array_max(y))
    place = lambda v: F.when(conf > 0, argmax(v) / F.lit(ratio)).otherwise(F.lit(-1.0))
    return F.struct(place(x).alias("x"), place(y).alias("y"), conf.alias("conf"))


def patch_tokens(tokens: Column, registers: int = 4) -> Column:
    """Patch rows of a token sequence: after the class token and the registers."""
    return F.slice(tokens, 2 + registers, F.greatest(F.size(tokens) - 1 - registers, F.lit(0)))


def mean_pool(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, pos, mean): mean of ``vector`` by position over the rows of each key, with map-side partial sums."""
    long = df.select(key, F.posexplode(doubles(F.col(vector))).alias("pos", "x"))
    return long.groupBy(key, "pos").agg(F.avg("x").alias("mean"))


# --- .npy -------------------------------------------------------------------------------


def npy_header(content: Column) -> Column:
    """Struct (descr, shape) read from the first bytes of a .npy file; null if it is none.

    Only the header is touched, so a scan may hand over a prefix of the file.
    """
    magic = F.hex(F.substring(content, 1, 6)) == "934E554D5059"
    major = F.conv(F.hex(F.substring(content, 7, 1)), 16, 10).cast("int")
    byte = lambda i: F.conv(F.hex(F.substring(content, i, 1)), 16, 10).cast("int")
    size = F.when(major == 1, byte(9) + byte(10) * 256).otherwise(byte(9) + byte(10) * 256 + byte(11) * 65536)
    begin = F.when(major == 1, 11).otherwise(13)
    text = F.decode(F.substr(content, begin, size), "ISO-8859-1")
    descr = F.regexp_extract(text, r"'descr':\s*'([^']*)'", 1)
    dims = F.regexp_extract(text, r"'shape':\s*\(([^)]*)\)", 1)
    shape = F.transform(F.filter(F.split(dims, ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).try_cast("int"))
    return F.when(magic & (descr != ""), F.struct(descr.alias("descr"), shape.alias("shape")))


def encode_npy(array: np.ndarray) -> bytes:
    """A version 1.0 .npy file, C order."""
    array = np.asarray(array, order="C")
    head = f"{{'descr': {array.dtype.str!r}, 'fortran_order': False, 'shape': {array.shape!r}, }}"
    head += " " * (-(len(head) + 11) % 64) + "\n"
    return b"\x93NUMPY\x01\x00" + struct.pack("<H", len(head)) + head.encode("latin1") + array.tobytes()


def decode_npy(data: bytes) -> np.ndarray:
    """The array of a .npy file; ValueError if it is damaged."""
    if data[:6] != b"\x93NUMPY" or len(data) < 12:
        raise ValueError("not a npy file")
    wide = data[6] > 1
    size = struct.unpack_from("<I" if wide else "<H", data, 8)[0]
    begin = (12 if wide else 10) + size
    try:
        head = ast.literal_eval(data[begin - size : begin].decode("latin1"))
        array = np.frombuffer(data, dtype=np.dtype(head["descr"]), offset=begin, count=int(np.prod(head["shape"], dtype=np.int64)))
    except (SyntaxError, KeyError, TypeError) as broken:
        raise ValueError("damaged npy header") from broken
    return array.reshape(head["shape"], order="F" if head["fortran_order"] else "C")
