"""Queries that exercise files: headers, archives, passes, streams. SQL has no counterpart for most."""

from __future__ import annotations

import struct
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from prismarq.functions import dense as D
from prismarq.functions.tensor import decode_npy, encode_npy, npy_header
from prismarq.operators import verify as R
from prismarq.operators.passes import IMAGES_PER_TASK
from prismarq.operators.persons import PersonPose
from prismarq.plans.catalogue import query
from prismarq.plans.commands import process_all
from prismarq.sources import images as I
from prismarq.sources import tar
from prismarq.sources.decode import decode_bgr, decode_rgb
from prismarq.sources.files import read_bytes, write_bytes
from prismarq.sources.shared import shared_folder, spread


_ISSUES = """m AS (SELECT doc_id AS image_id, text IS NOT NULL AND doc_id % 50 <> 0 AS ok, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE [1024, 832, 768][1 + doc_id % 3] END AS w FROM documents),
a AS (SELECT doc_id AS image_id, ['dinov3_cls', 'dinov3_patches', 'seg', 'caption'][1 + doc_id % 4] AS artifact, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN [1024, 1024] ELSE [1024] END AS shape,
  CASE WHEN doc_id % 5 = 0 THEN '<f4' WHEN doc_id % 2 = 0 THEN '<f2' ELSE '|u1' END AS descr, CASE WHEN doc_id % 8 = 3 THEN ' ' ELSE 'x' END AS text FROM documents),
j AS (SELECT a.*, m.w FROM a JOIN m ON a.image_id = m.image_id WHERE m.ok),
i AS (SELECT image_id, artifact, unnest(CASE
  WHEN artifact = 'caption' THEN CASE WHEN trim(text) = '' THEN ['empty'] ELSE [] END
  WHEN artifact = 'seg' AND w IS NULL THEN []
  WHEN shape IS NULL THEN ['corrupt']
  WHEN artifact = 'dinov3_cls' THEN CASE WHEN shape <> [1024] THEN ['shape'] WHEN descr <> '<f2' THEN ['dtype'] ELSE [] END
  WHEN artifact = 'dinov3_patches' THEN list_concat(CASE WHEN len(shape) <> 2 OR shape[2] <> 1024 THEN ['shape'] ELSE [] END, CASE WHEN descr <> '<f2' THEN ['dtype'] ELSE [] END)
  ELSE CASE WHEN shape <> [w, w] THEN ['shape'] WHEN descr <> '|u1' THEN ['dtype'] ELSE [] END END) AS kind FROM j),
issues AS (SELECT image_id, artifact, kind FROM i UNION ALL SELECT image_id, 'metadata', 'corrupt' FROM m WHERE NOT ok)"""


@query(f"WITH {_ISSUES} SELECT * FROM issues")
def verify_issues(t):
    return _issues(t)[1].select("image_id", "artifact", "kind")


def _issues(t):
    """Headers made of document numbers, and what the rules find in them."""
    k = F.col("doc_id")
    pick = lambda values, n: F.element_at(F.lit(values), (k % n + 1).cast("int"))
    w = F.when(k % 4 != 0, pick([1024, 832, 768], 3).cast("string"))
    meta = t.documents.select(k.alias("image_id"), (F.col("text").isNotNull() & (k % 50 != 0)).alias("ok"), F.concat(w, F.lit("x"), w).alias("aspect_bucket"))
    shape = F.when(k % 3 == 0, F.lit([1024, 1024])).otherwise(F.lit([1024]))
    descr = F.when(k % 5 == 0, "<f4").when(k % 2 == 0, "<f2").otherwise("|u1")
    header = F.when(k % 7 != 0, F.struct(descr.alias("descr"), shape.alias("shape")))
    arts = t.documents.select(k.alias("image_id"), pick(["dinov3_cls", "dinov3_patches", "seg", "caption"], 4).alias("artifact"), header.alias("header"), F.when(k % 8 == 3, " ").otherwise("x").alias("text"))
    return meta, R.issues(arts, meta)


@query(f"WITH {_ISSUES} SELECT (SELECT count(*) FROM m) AS images, count(DISTINCT image_id) AS bad_images, count(*) AS issues FROM issues")
def verify_summary(t):
    return R.summary(*_issues(t))


def _half_files(t):
    """Vectors as .npy files of half floats."""

    def encode(parts):
        for pdf in parts:
            files = [encode_npy(np.asarray(v, dtype=np.float16)) for v in pdf["embedding"]]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "content": files})

    return t.embeddings.mapInPandas(encode, "vec_id bigint, label int, content binary")


@query("SELECT vec_id, '<f2' AS descr, CAST(len(embedding) AS VARCHAR) AS shape, 2 * len(embedding) AS data_bytes FROM embeddings")
def npy_headers(t):
    rows = _half_files(t).withColumn("h", npy_header(F.substring("content", 1, 1024)))
    header = 10 + F.conv(F.hex(F.substring("content", 9, 1)), 16, 10).cast("int") + F.conv(F.hex(F.substring("content", 10, 1)), 16, 10).cast("int") * 256
    return rows.select("vec_id", "h.descr", F.array_join(F.col("h.shape").cast("array<string>"), ",").alias("shape"), (F.length("content") - header).cast("bigint").alias("data_bytes"))


@query("SELECT vec_id, true AS close FROM embeddings")
def half_round_trip(t):
    """Half floats decode to within their precision of the source."""

    def decode(parts):
        for pdf in parts:
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "back": [decode_npy(bytes(c)).astype(np.float32) for c in pdf["content"]]})

    back = _half_files(t).mapInPandas(decode, "vec_id bigint, back array<float>").join(t.embeddings, "vec_id")
    return back.select("vec_id", F.forall(F.zip_with("back", "embedding", lambda a, b: F.abs(a - b) <= F.abs(b) * 0.001 + 1e-6), lambda x: x).alias("close"))


@query("""WITH p AS (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings)
SELECT printf('%05d-%05d', label, label) || '.tar' AS shard, pos, 'v' || vec_id AS "key", 'dinov3_cls.npy' AS member, 128 + 2 * len(embedding) AS bytes FROM p""")
def tar_round_trip(t):
    """Archives by label, written through the tar sink and scanned again."""
    folder = _vector_archives(t)
    return tar.read_tars(t.spark, folder).select("shard", "pos", "key", "member", F.length("content").cast("bigint").alias("bytes"))


@query("""WITH p AS (SELECT label, vec_id, 128 + 2 * len(embedding) AS bytes, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings),
q AS (SELECT *, sum(512 + (bytes + 511) // 512 * 512) OVER (PARTITION BY label ORDER BY pos) AS upto FROM p)
SELECT printf('%05d-%05d', label, label) || '.tar' AS shard, pos, 'v' || vec_id AS "key", 'dinov3_cls.npy' AS member, CAST(upto - (bytes + 511) // 512 * 512 AS BIGINT) AS start, bytes AS length, bytes AS fetched FROM q""")
def tar_index(t):
    """Indexed archives: the place of every member, and what a scan in byte ranges fetches there."""
    folder = _vector_archives(t, True)
    fetched = tar.read_tars(t.spark, folder, splitBytes=100_000).select("shard", "key", "member", F.length("content").cast("bigint").alias("fetched"))
    return tar.read_places(t.spark, folder).join(fetched, ["shard", "key", "member"])


def _vector_archives(t, index: bool = False) -> str:
    """A folder of archives of vectors by label."""
    from pyspark.sql import Window

    from prismarq.functions.text import range_label

    pos = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    rows = _half_files(t).select(
        range_label(F.col("label"), F.col("label")).alias("label"), pos.cast("bigint").alias("pos"), F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("image_id"),
        F.lit("dinov3_cls.npy").alias("file"), "content")
    folder = shared_folder(t.spark)
    tar.write_tars(rows, folder, index=index)
    return folder


@query("SELECT p_partkey, 3 AS channels, 24 AS height, 16 AS width, round((p_size * 5) / 255.0, 2) AS value FROM part")
def pixel_tensor(t):
    """A grey image per part through the pixel pass."""

    def run(parts):
        for pdf in parts:
            rows = []
            for key, size in zip(pdf["p_partkey"], pdf["p_size"], strict=True):
                x = D.pixels(D.cover_crop(np.full((30, 20, 3), size * 5, dtype=np.uint8), 16, 24))
                rows.append((key, *x.shape, float(x.mean(dtype=np.float64))))
            yield pd.DataFrame(rows, columns=["p_partkey", "channels", "height", "width", "value"])

    return spread(t.part.select("p_partkey", "p_size"), 10_000, "p_partkey").mapInPandas(run, "p_partkey bigint, channels int, height int, width int, value double").withColumn("value", F.round("value", 2))


def _png(image) -> bytes:
    """An RGB image as a PNG file, rows unfiltered."""
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    h, w = image.shape[:2]
    rows = np.concatenate([np.zeros((h, 1), dtype=np.uint8), image.reshape(h, -1)], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


def _picture_files(rows, key: str, value: str) -> str:
    """A folder of one picture per row, p<key>.png: red and green tell the value, blue is 7; every tenth is broken."""
    folder = shared_folder(rows.sparkSession)

    def write(parts):
        for pdf in parts:
            for k, v in zip(pdf["k"], pdf["v"], strict=True):
                image = np.empty((3 + k % 5, 4 + k % 7, 3), dtype=np.uint8)
                image[...] = (v, 2 * v, 7)
                write_bytes(f"{folder}/p{k}.png", b"no picture" if k % 10 == 0 else _png(image))
            yield pdf[["k"]]

    spread(rows.select(F.col(key).cast("long").alias("k"), F.col(value).cast("long").alias("v")), 2000, "k").mapInPandas(write, "k bigint").count()
    return folder


@query("SELECT 'p' || s_suppkey AS image_id, CASE WHEN s_suppkey % 10 <> 0 THEN 4 + s_suppkey % 7 END AS width, CASE WHEN s_suppkey % 10 <> 0 THEN 3 + s_suppkey % 5 END AS height FROM supplier")
def image_headers(t):
    """Sizes of pictures in the shared folder, from the first bytes that tasks fetch."""
    folder = _picture_files(t.supplier, "s_suppkey", "s_nationkey")
    return I.with_size(I.scan_images(t.spark, folder).select("path", "image_id")).select("image_id", "width", "height")


@query("SELECT 'p' || s_suppkey AS image_id, CASE WHEN s_suppkey % 10 <> 0 THEN s_nationkey END AS red, CASE WHEN s_suppkey % 10 <> 0 THEN 7 END AS blue_first FROM supplier")
def image_decode(t):
    """Pictures decoded as RGB and as BGR; an unreadable one is a row of nulls."""

    def read(parts):
        for pdf in parts:
            rows = []
            for image_id, path in zip(pdf["image_id"], pdf["path"], strict=True):
                data = read_bytes(path)
                rgb, bgr = decode_rgb(data), decode_bgr(data)
                rows.append((image_id, None, None) if rgb is None else (image_id, int(rgb[0, 0, 0]), int(bgr[0, 0, 0])))
            yield pd.DataFrame(rows, columns=["image_id", "red", "blue_first"]).astype({"red": "Int64", "blue_first": "Int64"})

    folder = _picture_files(t.supplier, "s_suppkey", "s_nationkey")
    return I.scan_images(t.spark, folder).select("image_id", "path").mapInPandas(read, "image_id string, red long, blue_first long")


@query("""SELECT 'p' || n_nationkey AS image_id, p AS "pass", CASE WHEN n_nationkey % 10 = 0 THEN 'error' WHEN p = 'depth' THEN 'skipped_dependency' ELSE 'processed' END AS outcome
FROM nation, (SELECT unnest(['caption', 'pixel', 'depth', 'pose2', 'metadata']) AS p) WHERE (p = 'metadata') = (n_nationkey % 10 = 0)""")
def passes_run(t):
    """Passes with small stand-in models over pictures in the shared folder: outcomes, unreadable pictures among them."""
    backends = {"caption": lambda image, n: "a picture", "pose2": PersonPose(_nobody, _whole_crop)}
    root, output = _picture_files(t.nation, "n_nationkey", "n_regionkey"), shared_folder(t.spark)
    done, errors = process_all(t.spark, root, output, ["caption", "pixel", "depth", "pose2"], decode_rgb, backends)
    return done.unionByName(errors).select("image_id", "pass", "outcome")


@query("""WITH k AS (SELECT s_suppkey % 10 = 0 AS bad FROM supplier)
SELECT CAST(3 * count(*) FILTER (NOT bad) AS BIGINT) AS processed, CAST(count(*) FILTER (bad) AS BIGINT) AS error, CAST(count(*) FILTER (NOT bad) AS BIGINT) AS skipped_dependency, true AS batched FROM k""")
def passes_observed(t):
    """Counters that the jobs of the passes observe as they run, with read-ahead and a model that takes eight images in a call."""
    root, output, counts = _picture_files(t.supplier, "s_suppkey", "s_nationkey"), shared_folder(t.spark), Counter()
    done, _ = process_all(t.spark, root, output, ["caption", "matting", "depth", "pose2"], decode_rgb, {"caption": _Captions(), "matting": lambda image: np.zeros((4, 2, 2)), "pose2": PersonPose(_nobody, _whole_crop)}, counts=counts)

    def read(parts):
        for pdf in parts:
            yield pd.DataFrame({"value": [int(read_bytes(p)) for p in pdf["path"]]}, dtype="int64")

    captions = _made(done, output).where("artifact = 'caption'").mapInPandas(read, "value long")
    batched = captions.agg((F.max("value") > 1).alias("batched"))
    return batched.select(*[F.lit(counts[o]).cast("long").alias(o) for o in ("processed", "error", "skipped_dependency")], "batched")


def _made(done, output: str):
    """Artifacts of the images of OUTCOME rows."""
    return I.artifacts_of(spread(done.select("image_id").distinct(), IMAGES_PER_TASK, "image_id"), output)


class _Captions:
    """Captions that tell how many images their call had."""

    batch = 8

    def many(self, calls):
        return [str(len(calls))] * len(calls)


# --- passes with numeric stand-in models ------------------------------------------------

_SHADES = "k AS (SELECT s_suppkey AS id, s_nationkey AS v FROM supplier WHERE s_suppkey % 10 <> 0)"


@query(f"""WITH {_SHADES}, r AS (SELECT id, v, unnest([
  {{'a': 'caption', 'x': 'shade ' || v}}, {{'a': 't5_hidden', 'x': printf('%.2f', 1.0::DOUBLE * (length('shade ' || v)))}}, {{'a': 't5_mask', 'x': printf('%.2f', 1.0::DOUBLE * (length('shade ' || v)))}},
  {{'a': 'dinov3_cls', 'x': printf('%.2f', 1.0::DOUBLE * (v))}}, {{'a': 'dinov3_patches', 'x': printf('%.2f', 1.0::DOUBLE * (v + 6))}},
  {{'a': 'pose2', 'x': printf('%.2f', 1.0::DOUBLE * ((v + v + 1) / 2.0))}}, {{'a': 'seg2', 'x': printf('%.2f', 1.0::DOUBLE * (v % 3))}},
  {{'a': 'matting', 'x': printf('%.2f', 1.0::DOUBLE * (v / 25.0))}}, {{'a': 'normal2', 'x': printf('%.2f', 1.0::DOUBLE * (CASE WHEN v % 3 = 0 THEN 0 ELSE 0.6 END))}},
  {{'a': 'pointmap', 'x': printf('%.2f', 1.0::DOUBLE * (CASE WHEN v % 3 = 0 THEN 0 ELSE (v + 1) / 2.0 END))}}]) AS s FROM k)
SELECT 'p' || id AS image_id, s.a AS artifact, s.x AS value FROM r""")
def passes_artifacts(t):
    """Passes of the second generation over pictures, and what they wrote: means of maps and vectors that follow from each picture's shade."""
    root, output = _picture_files(t.supplier, "s_suppkey", "s_nationkey"), shared_folder(t.spark)
    done, _ = process_all(t.spark, root, output, ["caption", "t5", "dinov3", "pose2", "seg2", "matting", "normal2", "pointmap"], decode_rgb, {
        "caption": lambda image, n: f"shade {_shade(image)}", "t5": lambda text: (np.full((3, 4), len(text)), np.arange(20) < len(text)), "dinov3": lambda image: np.arange(8)[:, None] + np.full((8, 4), _shade(image)),
        "pose2": lambda image: (np.full((1, 308, 2), _shade(image)) + np.arange(2), np.ones((1, 308))), "seg2": lambda image: np.eye(3)[_shade(image) % 3][:, None, None] * np.ones((1, 6, 8)),
        "matting": lambda image: np.full((4, 6, 8), _shade(image) / 25), "normal2": lambda image: (np.array([3.0, 0.0, 4.0])[:, None, None] * np.ones((1, 8, 8)) * (1 + _shade(image)), (1, 1, 2, 0)),
        "pointmap": lambda image: (np.full((3, 8, 8), 1.0 + _shade(image)), 2.0, (0, 2, 1, 1)),
    })

    def read(parts):
        for pdf in parts:
            values = []
            for artifact, path in zip(pdf["artifact"], pdf["path"], strict=True):
                data = read_bytes(path)
                if artifact == "caption":
                    values.append(data.decode())
                    continue
                x = decode_npy(data).astype(np.float64)
                mean = {"t5_mask": x.sum, "normal2": lambda x=x: x[..., 0].mean(), "pose2": lambda x=x: x[..., :2].mean()}.get(artifact, x.mean)()
                values.append(f"{mean:.2f}")
            yield pdf.assign(value=values)[["image_id", "artifact", "value"]]

    return _made(done, output).where("artifact <> 'metadata'").mapInPandas(read, "image_id string, artifact string, value string")


def _shade(image) -> int:
    """What the red of a picture was made of."""
    return int(image[0, 0, 0])


@query("""SELECT l_orderkey, l_linenumber, sum_class AS classes, round(left_edge, 3) AS left_edge, round(middle, 3) AS middle FROM (
  SELECT l_orderkey, l_linenumber, l_quantity AS q, CAST(4 * (CASE WHEN l_quantity % 2 = 1 THEN 1 ELSE 0 END) + 4 * 2 AS BIGINT) AS sum_class, l_quantity * 0.25 AS left_edge, l_quantity * 0.5 AS middle FROM lineitem WHERE l_linenumber = 1)""")
def dense_ramps(t):
    """Maps of varying pixels, resized to twice their width: two halves of classes, and a ramp between half-pixel centres."""

    def run(parts):
        for pdf in parts:
            rows = []
            for key, line, q in zip(pdf["l_orderkey"], pdf["l_linenumber"], pdf["l_quantity"], strict=True):
                halves = np.zeros((3, 1, 4))
                halves[int(q) % 2, :, :2] = halves[2, :, 2:] = 1.0
                ramp = D.resize(np.array([[0.0, float(q)]]), 1, 4)
                rows.append((key, line, int(D.class_map(halves, 1, 8).sum()), round(float(ramp[0, 1]), 3), round(float((ramp[0, 1] + ramp[0, 2]) / 2), 3)))
            yield pd.DataFrame(rows, columns=["l_orderkey", "l_linenumber", "classes", "left_edge", "middle"])

    return spread(t.lineitem.where("l_linenumber = 1").select("l_orderkey", "l_linenumber", "l_quantity"), 50_000, "l_orderkey").mapInPandas(run, "l_orderkey bigint, l_linenumber int, classes bigint, left_edge double, middle double")


def _nobody(image):
    return np.zeros(0), np.zeros(0), np.zeros((0, 4))


def _whole_crop(image, box):
    size = np.array([image.shape[1], image.shape[0]])
    return np.zeros((308, 2)), np.ones(308), size, size / 2, size
