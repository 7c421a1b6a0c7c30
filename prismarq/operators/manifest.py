"""Chunks of published layers: labels, merging, rebuilding, overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismarq.functions.text import parse_range_label

# Fixed value: what a missing or unreadable manifest stands for.
EMPTY = {"version": "0.0.0", "total_images": 0, "layers": {}}
CHUNKS = "layer string, start bigint, end bigint, label string, n bigint"


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Chunks (layer, label, ...) of both; of equal labels the new one counts, overlapping others stay."""
    return old.join(new.select("layer", "label"), ["layer", "label"], "left_anti").unionByName(new)


def layer_counts(chunks: DataFrame) -> DataFrame:
    """(layer, chunks, count)."""
    return chunks.groupBy("layer").agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("count"))


def from_listing(files: DataFrame) -> DataFrame:
    """Chunks named by a listing (column ``path``) of ``data/<range>.parquet`` and ``<layer>/<range>.tar`` files.

    Other files are passed over; a range counts once however often it is named.
    """
    parts = F.split("path", "/")
    named = files.where(F.size(parts) == 2).select(parts[0].alias("dir"), parts[1].alias("file"))
    named = named.withColumn("range", parse_range_label(F.col("file")))
    is_data = (F.col("dir") == "data") & F.endswith("file", F.lit(".parquet"))
    is_tar = (F.col("dir") != "data") & F.endswith("file", F.lit(".tar"))
    kept = named.where(F.col("range").isNotNull() & (is_data | is_tar))
    layer = F.when(F.col("dir") == "data", "caption").otherwise(F.col("dir"))
    rows = kept.select(layer.alias("layer"), F.col("range.start").alias("start"), F.col("range.end").alias("end"), F.regexp_extract("file", r"^(\d+-\d+)\.", 1).alias("label"))
    return rows.withColumn("n", F.col("end") - F.col("start") + 1).dropDuplicates(["layer", "start", "end"])


def total_images(chunks: DataFrame) -> DataFrame:
    """One row: largest end + 1, or 0."""
    return chunks.agg(F.coalesce(F.max("end") + 1, F.lit(0)).alias("total_images"))


def overlaps(chunks: DataFrame) -> DataFrame:
    """Pairs of chunks of one layer that share positions (they would count twice).

    Sorted sweep instead of a range self-join: a chunk overlaps an earlier one if
    it begins at or before the largest end so far; that earlier chunk is named.
    """
    from pyspark.sql import Window

    before = Window.partitionBy("layer").orderBy("start", "end", "label").rowsBetween(Window.unboundedPreceding, -1)
    swept = chunks.withColumn("reach", F.max(F.struct("end", "label")).over(before))
    return swept.where(F.col("reach.end") >= F.col("start")).select("layer", F.col("reach.label").alias("earlier"), F.col("label").alias("later"))


def to_manifest(chunks: DataFrame, version: str, total: int, updated_at: str | None = None) -> dict:
    """The manifest as a JSON-ready dict; one driver row per layer, chunks as a map."""
    entry = F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n"))))
    rows = chunks.groupBy("layer").agg(entry.alias("chunks"), F.sum("n").alias("count")).orderBy("layer").collect()
    layers = {r["layer"]: {"format": "parquet" if r["layer"] == "caption" else "npy_tar", "chunks": dict(sorted(r["chunks"].items())), "count": r["count"]} for r in rows}
    out = {"version": version, "total_images": total, "layers": layers}
    return out | ({"updated_at": updated_at} if updated_at else {})


def from_manifest(spark, manifest: dict) -> DataFrame:
    """Chunk rows of a manifest dict."""
    rows = []
    for layer, held in manifest.get("layers", {}).items():
        for label, n in held.get("chunks", {}).items():
            start, _, end = label.partition("-")
            rows.append((layer, int(start), int(end), label, int(n)))
    return spark.createDataFrame(rows, CHUNKS)


def bump(version: str) -> str:
    """Patch number one higher, on the driver."""
    parts = ([int(p) for p in version.split(".")] + [0, 0, 0])[:3]
    return f"{parts[0]}.{parts[1]}.{parts[2] + 1}"
