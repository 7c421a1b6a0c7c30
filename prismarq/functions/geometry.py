"""Aspect buckets, crops, boxes and keypoints as Spark column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (width, height) of the aspect buckets, in tie-break order.
BUCKETS = ((1024, 1024), (832, 1216), (1216, 832), (768, 1280), (1280, 768), (704, 1344), (1344, 704))
PATCH = 16
DETECTOR_SIZE = 640
CROP_WIDTH, CROP_HEIGHT = 288, 384
BOX_PADDING = 1.25


def aspect_ratio(w: Column, h: Column) -> Column:
    """w / h; 1 where the height is not positive."""
    return F.when(h > 0, w / h).otherwise(F.lit(1.0))


def nearest_bucket(w: Column, h: Column, buckets: Sequence[tuple[int, int]] = BUCKETS) -> Column:
    """``WxH`` of the bucket with the closest ratio; the first wins ties."""
    ratio = aspect_ratio(w, h)
    options = [F.struct(F.abs(ratio - F.lit(bw / bh)).alias("d"), F.lit(i).alias("i"), F.lit(f"{bw}x{bh}").alias("name")) for i, (bw, bh) in enumerate(buckets)]
    return F.array_min(F.array(*options))["name"]


def parse_bucket(label: Column) -> Column:
    """Struct (w, h) of ``WxH`` or ``bucket_WxH``; null for other text."""
    part = lambda i: F.regexp_extract(label, r"^(?:bucket_)?\s*([+-]?\d+)\s*x\s*([+-]?\d+)\s*$", i).try_cast("bigint")
    return F.when(part(1).isNotNull() & part(2).isNotNull(), F.struct(part(1).alias("w"), part(2).alias("h")))


def crop_plan(w: Column, h: Column, bw: Column, bh: Column) -> Column:
    """Struct (new_w, new_h, left, top): resize to cover the bucket, then crop its centre."""
    scale = F.greatest(bw / w, bh / h)
    new_w, new_h = F.ceil(w * scale), F.ceil(h * scale)
    middle = lambda big, little: F.greatest(F.lit(0).cast("bigint"), F.floor((big - little) / 2))
    return F.struct(new_w.alias("new_w"), new_h.alias("new_h"), middle(new_w, bw).alias("left"), middle(new_h, bh).alias("top"))


def patch_size(n: Column) -> Column:
    """Nearest multiple of the patch, halves to even."""
    return (F.bround(n / PATCH) * PATCH).cast("bigint")


def letterbox(w: Column, h: Column, size: int = DETECTOR_SIZE) -> Column:
    """Struct (ratio, new_w, new_h) that fits an image into a square."""
    ratio = F.least(size / w, size / h)
    return F.struct(ratio.alias("ratio"), (w * ratio).cast("bigint").alias("new_w"), (h * ratio).cast("bigint").alias("new_h"))


def to_unit(pixel: Column, size: Column) -> Column:
    """Pixel coordinate in [-1, 1]."""
    return 2.0 * pixel / size - 1.0


def to_pixel(unit: Column, size: Column) -> Column:
    return (unit + 1.0) * size / 2.0


def corners(cx: Column, cy: Column, w: Column, h: Column, ratio: Column | None = None) -> Column:
    """Struct (x1, y1, x2, y2) of a centred box, over the letterbox ratio."""
    r = F.lit(1.0) if ratio is None else ratio
    return F.struct(((cx - w / 2) / r).alias("x1"), ((cy - h / 2) / r).alias("y1"), ((cx + w / 2) / r).alias("x2"), ((cy + h / 2) / r).alias("y2"))


def box_area(b: Column) -> Column:
    """Area with the one-pixel convention."""
    return (b["x2"] - b["x1"] + 1) * (b["y2"] - b["y1"] + 1)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union with the one-pixel convention."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]) + 1)
    both = side("x1", "x2") * side("y1", "y2")
    return both / (box_area(a) + box_area(b) - both)


# Keypoints of the face, whose dots need more than the threshold; lines of a skeleton keep its equals, too.
FACE_POINTS, POINT_CONFIDENCE = (23, 90), 0.3


def is_drawn(index: Column, confidence: Column, threshold: float = POINT_CONFIDENCE) -> Column:
    """Whether a whole-body keypoint is confident enough to be drawn."""
    return F.when(index.between(*FACE_POINTS), confidence > threshold).otherwise(confidence >= threshold)


def centre_scale(b: Column, padding: float = BOX_PADDING) -> Column:
    """Struct (cx, cy, sw, sh): centre and padded size of a corner box."""
    return F.struct(
        ((b["x1"] + b["x2"]) * 0.5).alias("cx"), ((b["y1"] + b["y2"]) * 0.5).alias("cy"),
        ((b["x2"] - b["x1"]) * F.lit(padding)).alias("sw"), ((b["y2"] - b["y1"]) * F.lit(padding)).alias("sh"))


def fix_aspect(sw: Column, sh: Column, ratio: float = CROP_WIDTH / CROP_HEIGHT) -> Column:
    """Struct (sw, sh) grown to a width over height of ``ratio``."""
    wide = sw > sh * F.lit(ratio)
    return F.struct(F.when(wide, sw).otherwise(sh * F.lit(ratio)).alias("sw"), F.when(wide, sw / F.lit(ratio)).otherwise(sh).alias("sh"))


def back_project(k: Column, crop: float, scale: Column, centre: Column) -> Column:
    """A crop coordinate in the image."""
    return k / F.lit(float(crop)) * scale + centre - scale / 2
