"""Import of older record files: one JSON object a line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismarq.functions import text as X

# Modality directory of the old layout -> artifact of the catalogue.
MODALITIES = {"dinov3": "dinov3_cls", "dinov3_patches": "dinov3_patches", "t5_hidden": "t5_hidden", "images": "pixel", "pose": "pose"}
RECORD = "image_id string, image_path string, width bigint, height bigint, aspect_bucket string, caption string, t5_attention_mask array<int>"


def parse_lines(lines: DataFrame) -> DataFrame:
    """Records of ``lines`` (line, value): blank lines vanish; what is no JSON object, or names no image, has a null image_id.

    Without an id, the image's file name without its last suffix stands in.
    """
    value = X.strip(F.col("value"))
    rows = lines.withColumn("value", value).where("value <> ''")
    is_object = F.startswith("value", F.lit("{"))
    rows = rows.withColumn("r", F.when(is_object, F.from_json("value", RECORD + ", _bad string", {"columnNameOfCorruptRecord": "_bad"})))
    good = F.col("r").isNotNull() & F.col("r._bad").isNull()
    stem = F.regexp_replace(F.regexp_extract("r.image_path", "[^/]*$", 0), r"(?<=.)\.[^.]+$", "")
    image = F.when(good, F.coalesce(F.nullif("r.image_id", F.lit("")), F.nullif(stem, F.lit(""))))
    fields = [F.when(good, F.col(f"r.{c.split()[0]}")).alias(c.split()[0]) for c in RECORD.split(", ")[1:]]
    return rows.select("line", image.alias("image_id"), *fields)


def first_records(records: DataFrame) -> DataFrame:
    """The first line of each image_id: one partial aggregation, no sort."""
    cols = [c for c in records.columns if c != "image_id"]
    best = records.where("image_id is not null").groupBy("image_id").agg(F.min_by(F.struct(*cols), "line").alias("r"))
    return best.select("image_id", *[F.col(f"r.{c}").alias(c) for c in cols])


def new_records(records: DataFrame, existing: DataFrame) -> DataFrame:
    """First lines of images that ``existing`` (image_id) lacks."""
    return first_records(records).join(existing.select("image_id"), "image_id", "left_anti")


def attach_files(records: DataFrame, files: DataFrame) -> DataFrame:
    """``records`` with a map of artifact to path, from ``files`` (modality, image_id, path): one join for all modalities."""
    names = F.create_map(*[F.lit(x) for kv in MODALITIES.items() for x in kv])
    known = files.where(F.col("modality").isin(*MODALITIES))
    held = known.groupBy("image_id").agg(F.map_from_entries(F.collect_list(F.struct(names[F.col("modality")], "path"))).alias("files"))
    return records.join(held, "image_id", "left").withColumn("files", F.coalesce("files", F.expr("cast(map() as map<string,string>)")))


def counters(records: DataFrame) -> DataFrame:
    """One row: lines, migrated images, errors, skipped repeats."""
    c = F.col("image_id")
    return records.agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct(c).alias("migrated"), F.sum(c.isNull().cast("bigint")).alias("errors"),
        (F.count(c) - F.count_distinct(c)).alias("skipped"))
