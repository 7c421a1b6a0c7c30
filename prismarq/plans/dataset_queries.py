"""Queries that run whole commands on small datasets in the shared folder, one image per nation."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import functions as F

from prismarq.functions import dense as D
from prismarq.functions.tensor import encode_npy
from prismarq.operators import colocated
from prismarq.plans import commands, publish
from prismarq.plans.catalogue import query
from prismarq.sources.files import locate, write_bytes
from prismarq.sources.hub import FolderHub
from prismarq.sources.shared import shared_folder


def _mounted(spark) -> str:
    """A new shared folder as a path that the driver can list, too."""
    return locate(shared_folder(spark))[1]


def _dataset(t, write) -> str:
    """A dataset folder; ``write(folder of an image, key, region)`` adds files to each image's metadata."""
    top = _mounted(t.spark)

    def run(parts):
        for pdf in parts:
            for key, region in zip(pdf["n_nationkey"], pdf["n_regionkey"], strict=True):
                folder = f"{top}/img{key:05d}"
                meta = {"image_id": f"img{key:05d}", "source_path": f"/in/{key}.png", "width": 1024, "height": 1024, "aspect_bucket": "1024x1024"}
                write_bytes(f"{folder}/metadata.json", json.dumps(meta).encode())
                write(folder, int(key), int(region))
            yield pdf[["n_nationkey"]]

    t.nation.select("n_nationkey", "n_regionkey").mapInPandas(run, "n_nationkey bigint").count()
    return top


def _broken(folder: str, key: int, region: int) -> None:
    write_bytes(f"{folder}/dinov3_cls.npy", encode_npy(np.zeros(1024, dtype=np.float32 if key % 2 else np.float16)))
    write_bytes(f"{folder}/pose.npy", b"not an array" if region == 1 else encode_npy(np.zeros((133, 3), dtype=np.float16)))
    write_bytes(f"{folder}/caption.txt", b" \n" if region == 2 else b"a caption\n")


@query("""SELECT count(*) AS images, sum(n_nationkey % 2 + CASE WHEN n_regionkey IN (1, 2) THEN 1 ELSE 0 END) AS issues, sum(n_nationkey % 2) AS converted,
  count(*) FILTER (n_regionkey = 1) AS deleted, count(*) FILTER (n_regionkey = 2) AS left_over FROM nation""")
def verify_fix(t):
    """Issues of a dataset, what fixing does, and what it leaves (empty captions)."""
    top = _dataset(t, _broken)
    counts = commands.verify(t.spark, top, fix=True)[1]
    left = commands.verify(t.spark, top)[1]["issues"]
    row = (counts["images"], counts["issues"], counts["converted"], counts["deleted"], left)
    return t.spark.createDataFrame([row], "images long, issues long, converted long, deleted long, left_over long")


def _complete(folder: str, key: int, region: int) -> None:
    write_bytes(f"{folder}/caption.txt", f" caption {key}\n".encode())
    if region != 3:
        write_bytes(f"{folder}/pose.npy", encode_npy(np.full((133, 3), key, dtype=np.float16)))


@query("""WITH p AS (SELECT *, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos FROM nation),
q AS (SELECT pos, (row_number() OVER (ORDER BY pos) - 1) // 10 AS grp FROM p WHERE n_regionkey <> 3)
SELECT 'caption' AS layer, printf('%05d-%05d', 0, max(pos)) AS label, count(*) AS n, max(pos) + 1 AS total_images FROM p
UNION ALL SELECT 'pose', printf('%05d-%05d', min(pos), max(pos)), max(pos) - min(pos) + 1, (SELECT max(pos) + 1 FROM p) FROM q GROUP BY grp""")
def publish_round_trip(t):
    """Two layers published in archives of ten images, and the manifest that the hub's files call for."""
    top, hub = _dataset(t, _complete), FolderHub(_mounted(t.spark))
    publish.publish(t.spark, top, hub, "u/r", ["caption", "pose"], max_files=10, staging=_mounted(t.spark))
    found = publish.reconcile(t.spark, hub, "u/r")
    rows = [(layer, label, n, found["total_images"]) for layer, x in found["layers"].items() for label, n in x["chunks"].items()]
    return t.spark.createDataFrame(rows, "layer string, label string, n long, total_images long")


@query("""SELECT coalesce(d.image_id, p.image_id) AS image_id, n_chars, lang, path, CASE WHEN d.image_id IS NULL THEN 'original' WHEN p.image_id IS NULL THEN 'published' ELSE 'both' END AS side
FROM (SELECT 'img' || doc_id AS image_id, n_chars, lang FROM documents) d FULL JOIN (SELECT 'img' || page_id AS image_id, url AS path FROM pages) p ON d.image_id = p.image_id""")
def published_with_originals(t):
    """Documents as published rows, pages as originals, each laid out by image once: joined without a shuffle."""
    image = lambda c: F.concat(F.lit("img"), F.col(c).cast("string")).alias("image_id")
    published = t.documents.select(image("doc_id"), "n_chars", "lang")
    originals = t.pages.select(image("page_id"), F.col("url").alias("path"))
    buckets = colocated.buckets_for(t.documents.count())
    return colocated.published_with_originals(colocated.lay_out(published, "image_id", buckets), colocated.lay_out(originals, "image_id", buckets))


@query("""SELECT artifact, count(*) AS n FROM (SELECT unnest(['metadata', CASE WHEN n_regionkey <> 3 THEN 'caption' END, CASE WHEN n_nationkey % 2 = 1 THEN 'pose' END, CASE WHEN n_regionkey = 0 THEN 't5_mask' END]) AS artifact FROM nation)
WHERE artifact IS NOT NULL GROUP BY artifact""")
def migrate_files(t):
    """Old records with tabs around them, and files of a modality, imported: files by artifact."""
    top = _mounted(t.spark)
    rows = t.nation.select("n_nationkey", "n_regionkey").collect()  # 25 rows: the table is fixed
    lines = []
    for r in rows:
        record = {"image_id": f"img{r['n_nationkey']}", "width": 5, "height": 6, "caption": None if r["n_regionkey"] == 3 else "c"}
        lines += ["\t" + json.dumps(record | ({"t5_attention_mask": [1, 0]} if r["n_regionkey"] == 0 else {})) + "\t", " \t "]
    write_bytes(f"{top}/old.jsonl", "\n".join(lines).encode())
    for r in rows:
        if r["n_nationkey"] % 2:
            write_bytes(f"{top}/derived/pose/img{r['n_nationkey']}.npy", encode_npy(np.zeros((133, 3), dtype=np.float16)))
    commands.migrate(t.spark, f"{top}/old.jsonl", f"{top}/derived", f"{top}/out")
    return commands.status(t.spark, f"{top}/out").where("n > 0").select("artifact", F.col("n").cast("long").alias("n"))


@query("""SELECT n_nationkey, n_regionkey AS class, round(n_regionkey * 0.25, 3) AS alpha, CASE WHEN n_regionkey > 0 THEN 1.0 ELSE 0.0 END AS normal, CASE WHEN n_regionkey > 0 THEN 2.0 ELSE 0.0 END AS depth_metres FROM nation""")
def dense_maps(t):
    """Maps of flat model outputs: class, matte, unit normal and metric point of each image's centre."""

    def run(parts):
        import pandas as pd

        for pdf in parts:
            rows = []
            for key, region in zip(pdf["n_nationkey"], pdf["n_regionkey"], strict=True):
                seg = D.class_map(np.eye(5)[int(region)][:, None, None] * np.ones((1, 6, 8)), 12, 16)
                matte = D.alpha(np.full((4, 6, 8), region * 0.25), 12, 16)
                normal = D.normal_map_padded(np.stack([np.zeros((8, 8)), np.zeros((8, 8)), np.full((8, 8), 7.0)]), (0, 0, 1, 1), seg)
                points = D.point_map(np.full((3, 8, 8), 3.0), 1.5, (0, 0, 1, 1), seg)
                rows.append((key, int(seg[6, 8]), round(float(matte[6, 8]), 3), float(normal[6, 8, 2]), float(points[6, 8, 2])))
            yield pd.DataFrame(rows, columns=["n_nationkey", "class", "alpha", "normal", "depth_metres"])

    out = t.nation.select("n_nationkey", "n_regionkey").mapInPandas(run, "n_nationkey bigint, class bigint, alpha double, normal double, depth_metres double")
    return out.withColumn("normal", F.round("normal", 3)).withColumn("depth_metres", F.round("depth_metres", 3))
