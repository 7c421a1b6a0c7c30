"""Integrity rules over parsed artifact headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.functions.geometry import parse_bucket
from prismarq.functions.text import strip

# Artifact -> (expected shape, dtype). Letters stand for bucket height and width; None for any number.
EXPECTED = {
    "dinov3_cls": ((1024,), "<f2"), "dinov3_patches": ((None, 1024), "<f2"), "t5_hidden": ((512, 1024), "<f2"), "t5_mask": ((512,), "|u1"),
    "pixel": ((3, "h", "w"), "<f2"), "pose": ((133, 3), "<f2"), "seg": (("h", "w"), "|u1"), "depth": (("h", "w"), "<f2"), "normal": (("h", "w", 3), "<f2"),
}
ISSUE = "struct<kind:string,detail:string>"


def _issue(kind: str, detail: Column | str) -> Column:
    return F.struct(F.lit(kind).alias("kind"), (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"))


def tensor_issues(artifact: Column, header: Column, bucket: Column) -> Column:
    """Array of issues of one .npy artifact from its header struct (descr, shape) and bucket struct (w, h).

    A header that could not be read is corrupt; the shape is tested before the
    dtype and hides it, except for patches, where both are reported; artifacts
    sized by the bucket are only tested if the bucket is known.
    """
    none = F.expr(f"cast(array() as array<{ISSUE}>)")
    out = none
    for name, (shape, dtype) in EXPECTED.items():
        dims = [F.lit(None) if d is None else bucket[d] if isinstance(d, str) else F.lit(d) for d in shape]
        fits = F.size(header["shape"]) == len(shape)
        for i, d in enumerate(shape):
            if d is not None:
                fits = fits & (F.get(header["shape"], F.lit(i)) == dims[i])
        got = F.concat(F.lit("("), F.array_join(header["shape"].cast("array<string>"), ", "), F.lit(")"))
        wrong_shape, wrong_type = _issue("shape", F.concat(F.lit("shape "), got)), _issue("dtype", F.concat(F.lit("dtype "), header["descr"]))
        typed = header["descr"] == dtype
        if name == "dinov3_patches":
            tests = F.concat(F.when(~fits, F.array(wrong_shape)).otherwise(none), F.when(~typed, F.array(wrong_type)).otherwise(none))
        else:
            tests = F.when(~fits, F.array(wrong_shape)).when(~typed, F.array(wrong_type)).otherwise(none)
        tests = F.when(header.isNull(), F.array(_issue("corrupt", "unreadable header"))).otherwise(tests)
        if any(isinstance(d, str) for d in shape):
            tests = F.when(bucket.isNull(), none).otherwise(tests)
        out = F.when(artifact == name, tests).otherwise(out)
    return out


def issues(artifacts: DataFrame, metadata: DataFrame) -> DataFrame:
    """(image_id, artifact, kind, detail) of every issue.

    ``artifacts``: image_id, artifact, header (struct or null), text (of captions).
    ``metadata``: image_id, ok (parsed), aspect_bucket: one row per image.  An
    image without readable metadata has that one issue and no other.
    """
    bad = metadata.where("not ok").select("image_id", F.lit("metadata").alias("artifact"), F.lit("corrupt").alias("kind"), F.lit("missing or unreadable").alias("detail"))
    good = metadata.where("ok").select("image_id", parse_bucket(F.col("aspect_bucket")).alias("bucket"))
    rows = artifacts.join(good, "image_id")
    blank = F.when((F.col("artifact") == "caption") & (F.length(strip(F.coalesce("text", F.lit("")))) == 0), F.array(_issue("empty", "empty caption")))
    found = F.coalesce(blank, tensor_issues(F.col("artifact"), F.col("header"), F.col("bucket")))
    return rows.select("image_id", "artifact", F.explode(found).alias("i")).select("image_id", "artifact", "i.kind", "i.detail").unionByName(bad)


def summary(metadata: DataFrame, found: DataFrame) -> DataFrame:
    """One row: images, images with issues, issues."""
    images = metadata.agg(F.count_distinct("image_id").alias("images"))
    problems = found.agg(F.count_distinct("image_id").alias("bad_images"), F.count(F.lit(1)).alias("issues"))
    return images.join(F.broadcast(problems))  # one row each
