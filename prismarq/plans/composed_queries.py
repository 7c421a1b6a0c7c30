"""Queries on composed detection, crops, colours, image lists and shards; models are numeric stand-ins that follow from the tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from prismarq.functions import charts as C
from prismarq.functions import dense as D
from prismarq.operators import detection as T
from prismarq.operators import positional as P
from prismarq.operators.persons import PERSON_2, WholeBody, person_boxes_2
from prismarq.plans.catalogue import query
from prismarq.sources import images as I
from prismarq.sources.shared import shared_folder, spread


@query("""SELECT p_partkey, CAST(84 AS BIGINT) AS cells, round(8 * (64 * a + 224) + 16 * (16 * a + 24) + 32 * (4 * a + 2), 4) AS cx, round(8 * (64 * 0.5::DOUBLE + 224) + 16 * (16 * 0.5::DOUBLE + 24) + 32 * (4 * 0.5::DOUBLE + 2), 4) AS cy,
  round(exp(a) * (8 * 64 + 16 * 16 + 32 * 4), 4) AS w FROM (SELECT p_partkey, p_size / 50.0::DOUBLE AS a FROM part)""")
def grid_decode(t):
    """Cells of three strides over a detector input of 64 pixels: sums of their decoded centres and widths."""

    def run(parts):
        for pdf in parts:
            rows = []
            for key, size in zip(pdf["p_partkey"], pdf["p_size"], strict=True):
                cells = T.decode_grid(np.tile([size / 50.0, 0.5, size / 50.0, 0.0], (84, 1)), 64)
                rows.append((key, len(cells), *(round(float(x), 4) for x in cells[:, :3].sum(axis=0))))
            yield pd.DataFrame(rows, columns=["p_partkey", "cells", "cx", "cy", "w"])

    return spread(t.part.select("p_partkey", "p_size"), 10_000, "p_partkey").mapInPandas(run, "p_partkey bigint, cells bigint, cx double, cy double, w double")


@query("""SELECT p_partkey, round(32.0::DOUBLE + 2 * 24.0::DOUBLE, 4) AS middle, round((32 - 3 * s / 12) + 2 * (24 - 4 * s / 12), 4) AS quarter, round(((32 - 3 * s / 12) + 2 * (24 - 4 * s / 12) - 123.675::DOUBLE) / 58.395::DOUBLE, 4) AS model
FROM (SELECT p_partkey, (p_size % 30 + 4)::DOUBLE AS s FROM part)""")
def crop_warp(t):
    """Crops of a ramp (x + 2 y) around its centre, at different scales: two pixels, and one of them as the keypoint model's input."""
    ramp = np.repeat((np.arange(64)[None, :] + 2 * np.arange(48)[:, None])[..., None], 3, axis=2).astype(np.float64)

    def run(parts):
        for pdf in parts:
            for i in range(0, len(pdf), 256):
                some = pdf[i : i + 256]
                wide = some["p_size"].to_numpy() % 30 + 4.0
                centre, scale = np.tile([32.0, 24.0], (len(some), 1)), np.column_stack([wide, wide * 4 / 3])
                crop = D.warp(ramp, D.crop_matrix(centre, scale, (12, 16)), (12, 16))
                model = D.crop_input(ramp, centre, scale, (12, 16))[:, 0, 4, 3].astype(np.float64)
                yield pd.DataFrame({"p_partkey": some["p_partkey"], "middle": crop[:, 8, 6, 0].round(4), "quarter": crop[:, 4, 3, 0].round(4), "model": model.round(4)})

    out = spread(t.part.select("p_partkey", "p_size"), 10_000, "p_partkey").mapInPandas(run, "p_partkey bigint, middle double, quarter double, model double")
    return out.withColumn("model", F.round("model", 4))


class _OneCell:
    """A detector of one person, 80 by 100 pixels, whose centre the picture's first pixel tells."""

    def __call__(self, batch):
        out = np.zeros((1, 8400, 6))
        out[0, 0] = ((100 + batch[0, 0, 0, 0]) / 8, 120 / 8, math.log(10), math.log(12.5), 1.0, 0.9)
        return out


def _rising(batch):
    """Rows of scores that peak at 4 k and 5 k for keypoint k."""
    n, k = len(batch), np.arange(133)
    x, y = np.zeros((n, 133, 576)), np.zeros((n, 133, 768))
    x[:, k, 4 * k], y[:, k, 5 * k] = 0.9, 0.8
    return x, y


@query("""WITH k AS (SELECT s_suppkey, s_nationkey AS v, unnest(range(133)) AS k FROM supplier)
SELECT s_suppkey, k AS point, round(4 * k / 2.0::DOUBLE / 288 * 100 + (100 + v) - 50, 4) AS x, round(5 * k / 2.0::DOUBLE / 384 * (400 / 3.0::DOUBLE) + 120 - 200 / 3.0::DOUBLE, 4) AS y, 0.8::DOUBLE AS score FROM k""")
def whole_body(t):
    """Persons found, cropped and turned into 133 keypoints in the image, one picture per supplier."""

    def run(parts):
        backend = WholeBody(_OneCell(), _rising)
        for pdf in parts:
            for key, v in zip(pdf["s_suppkey"], pdf["s_nationkey"], strict=True):
                points, scores = backend(np.full((640, 640, 3), v, dtype=np.uint8))
                yield pd.DataFrame({"s_suppkey": key, "point": np.arange(133), "x": points[:, 0].round(4), "y": points[:, 1].round(4), "score": scores.round(3)})

    return spread(t.supplier.select("s_suppkey", "s_nationkey"), 100, "s_suppkey").mapInPandas(run, "s_suppkey bigint, point bigint, x double, y double, score double")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount * 10 > 0.3::DOUBLE AS found FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN found THEN q ELSE 0 END AS x1, CASE WHEN found THEN 2 * q ELSE 39 END AS x2, CAST(1 AS BIGINT) AS boxes FROM b""")
def person_boxes(t):
    """Detections of the second generation: the person that is sure enough, one of two that overlap, or the whole image."""

    def run(parts):
        image = np.zeros((20, 40, 3))
        for pdf in parts:
            found = np.empty((len(pdf), 3))
            for i, (q, d) in enumerate(zip(pdf["l_quantity"].tolist(), pdf["l_discount"].tolist(), strict=True)):
                box = [q, 0.0, 2 * q, 19.0]
                near = [x + 1 for x in box]
                boxes = person_boxes_2(image, lambda _, d=d, box=box, near=near: ([PERSON_2, PERSON_2, PERSON_2 + 1], [d * 10, d * 5, 1.0], [box, box, near]))
                found[i] = boxes[0, 0], boxes[0, 2], len(boxes)
            yield pdf[["l_orderkey", "l_linenumber"]].assign(x1=found[:, 0], x2=found[:, 1], boxes=found[:, 2].astype(np.int64))

    rows = spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"), 50_000, "l_orderkey", "l_linenumber")
    return rows.mapInPandas(run, "l_orderkey bigint, l_linenumber int, x1 double, x2 double, boxes bigint")


@query("""WITH p AS (SELECT p_partkey, p_size AS s, p_size % 3 AS c FROM part)
SELECT p_partkey, CASE WHEN c = 0 THEN s::DOUBLE ELSE floor(s * 0.5::DOUBLE + [0, 200, 40][c + 1] * 0.5::DOUBLE) END AS red, CASE WHEN c = 0 THEN 30.0::DOUBLE ELSE floor((s / 51.0::DOUBLE + 1.001::DOUBLE) / 2 * 255) END AS normal_x FROM p""")
def map_colours(t):
    """Colours of a class over a grey picture, and of a normal; what is no foreground stays as it is, or turns grey."""
    palette = np.array([[0, 0, 0], [200, 10, 10], [40, 90, 90]])

    def run(parts):
        for pdf in parts:
            rows = []
            for key, s in zip(pdf["p_partkey"], pdf["p_size"], strict=True):
                over = C.class_overlay(np.full((4, 4, 3), s, dtype=np.uint8), np.full((2, 2), s % 3, dtype=np.uint8), palette)
                normal = np.full((2, 2, 3), 0.0 if s % 3 == 0 else s / 51.0 + 0.001)
                rows.append((key, int(over[1, 1, 0]), int(C.normal_colours(normal, 4, 4)[1, 1, 0])))
            yield pd.DataFrame(rows, columns=["p_partkey", "red", "normal_x"])

    return spread(t.part.select("p_partkey", "p_size"), 10_000, "p_partkey").mapInPandas(run, "p_partkey bigint, red double, normal_x double")


@query("SELECT 'p' || s_suppkey AS image_id FROM supplier")
def image_list(t):
    """A list of images with folders to be resolved, one line per supplier."""
    folder = shared_folder(t.spark)
    lines = t.supplier.select(F.concat(F.lit("  ./sub/../p"), F.col("s_suppkey"), F.lit(".png ")).alias("value"))
    lines.write.text(folder)
    return I.scan_list(t.spark, folder, "/in").where(F.col("path") == F.concat(F.lit("/in/"), "image_id", F.lit(".png"))).select("image_id")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) % 3 AS worker FROM orders")
def shard_union(t):
    """The shards of three workers: every row in exactly one."""
    parts = [P.shard(t.orders.select("o_orderkey"), i, 3, "o_orderkey").withColumn("worker", F.lit(i).cast("long")) for i in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
