"""The artifact catalogue: what each image has, lacks, and is ready for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Artifact name -> file name.
ARTIFACTS = {
    "metadata": "metadata.json", "caption": "caption.txt", "dinov3_cls": "dinov3_cls.npy", "dinov3_patches": "dinov3_patches.npy",
    "t5_hidden": "t5_hidden.npy", "t5_mask": "t5_mask.npy", "pixel": "pixel.npy", "pose": "pose.npy", "seg": "seg.npy", "depth": "depth.npy",
    "normal": "normal.npy", "seg2": "seg2.npy", "normal2": "normal2.npy", "pointmap": "pointmap.npy", "pose2": "pose2.npy", "matting": "matting.npy",
}
# Publishable layer -> artifacts it needs.
LAYERS = {
    "caption": ("caption",), "dinov3": ("dinov3_cls", "dinov3_patches"), "t5": ("t5_hidden", "t5_mask"),
    "pose": ("pose",), "seg": ("seg",), "depth": ("depth",), "normal": ("normal",),
}
#: pass -> artifacts it makes, and artifacts it needs first.
MAKES = {
    "caption": ("caption",), "dinov3": ("dinov3_cls", "dinov3_patches"), "t5": ("t5_hidden", "t5_mask"), "pose": ("pose",), "seg": ("seg",), "depth": ("depth",),
    "normal": ("normal",), "pixel": ("pixel",), "seg2": ("seg2",), "pose2": ("pose2",), "matting": ("matting",), "normal2": ("normal2",), "pointmap": ("pointmap",),
}
NEEDS = {"t5": ("caption",), "depth": ("seg",), "normal": ("seg",), "normal2": ("seg2",), "pointmap": ("seg2",)}


def presence(images: DataFrame, artifacts: DataFrame, names: Sequence[str]) -> DataFrame:
    """``images`` with one boolean column per artifact name: one partial aggregation and one join, however many artifacts.

    ``artifacts``: (image_id, artifact, ...), a row for each file that exists.
    """
    has = artifacts.where(F.col("artifact").isin(*names)).groupBy("image_id").agg(*[F.max(F.col("artifact") == n).alias(n) for n in names])
    return images.join(has, "image_id", "left").select(*images.columns, *[F.coalesce(n, F.lit(False)).alias(n) for n in names])


def complete(artifacts: DataFrame, required: Sequence[str]) -> DataFrame:
    """image_ids that have every required artifact: division by counting distinct matches."""
    mine = artifacts.where(F.col("artifact").isin(*required))
    return mine.groupBy("image_id").agg(F.count_distinct("artifact").alias("n")).where(F.col("n") == len(set(required))).select("image_id")


def pending(images: DataFrame, artifacts: DataFrame, made: Sequence[str]) -> DataFrame:
    """Images that lack one of the artifacts that a pass makes."""
    return images.join(complete(artifacts, made), "image_id", "left_anti")


def ready(images: DataFrame, artifacts: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Images that have all artifacts that a pass needs."""
    return images if not needed else images.join(complete(artifacts, needed), "image_id", "left_semi")


def status(images: DataFrame, artifacts: DataFrame, names: Sequence[str]) -> DataFrame:
    """(artifact, n, total, pct) for every name, zero rows included, sorted by name."""
    total = images.agg(F.count(F.lit(1)).alias("total"))
    found = artifacts.where(F.col("artifact").isin(*names)).join(images.select("image_id"), "image_id", "left_semi")
    counts = found.groupBy("artifact").agg(F.count_distinct("image_id").alias("n"))
    wanted = images.sparkSession.createDataFrame([(n,) for n in names], "artifact string")
    rows = F.broadcast(wanted).join(counts, "artifact", "left").join(F.broadcast(total))  # one row of totals
    share: Column = F.when(F.col("total") > 0, F.round(100.0 * F.coalesce("n", F.lit(0)) / F.col("total"), 1)).otherwise(F.lit(0.0))
    return rows.select("artifact", F.coalesce("n", F.lit(0)).alias("n"), "total", share.alias("pct")).orderBy("artifact")


def shared_ids(images: DataFrame) -> DataFrame:
    """image_ids that more than one source file would write to."""
    return images.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("path")).alias("paths")).where("n > 1")


def layer_bytes(artifacts: DataFrame, layers: dict[str, Sequence[str]] = LAYERS) -> DataFrame:
    """(layer, image_id, bytes) of images that have all files of the layer."""
    table = artifacts.sparkSession.createDataFrame([(k, a, len(v)) for k, v in layers.items() for a in v], "layer string, artifact string, need int")
    rows = artifacts.join(F.broadcast(table), "artifact")
    sums = rows.groupBy("layer", "image_id", "need").agg(F.count_distinct("artifact").alias("have"), F.sum("length").alias("bytes"))
    return sums.where("have = need").select("layer", "image_id", "bytes")
