"""Percentiles from sorted ranges, overlaps by tiles, and joins of layouts, against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from prismarq.operators import colocated, detection
from prismarq.operators.selection import percentiles
from prismarq.plans.detection_queries import _six


@pytest.mark.parametrize("ranges", [None, 7])
def test_percentiles(spark, ranges):
    """One key holds most rows, and one value most of them; ranges cut keys and runs of equal values."""
    rng = np.random.default_rng(1)
    rows = [("big", float(x)) for x in np.where(rng.random(600) < 0.5, 3.0, rng.normal(size=600))] + [("two", 1.0), ("two", 2.0), ("one", -5.0), (None, 4.0), (None, 6.0), ("none", None)]
    shares = [0.0, 0.02, 0.5, 0.98, 1.0]
    got = {r["key"]: (r["n"], r["q"]) for r in percentiles(spark.createDataFrame(rows, "key string, x double").repartition(5), ["key"], "x", shares, ranges=ranges).collect()}
    assert set(got) == {"big", "two", "one", None}
    for key, (n, q) in got.items():
        own = [x for k, x in rows if k == key and x is not None]
        assert n == len(own) and np.allclose(q, np.quantile(own, shares), rtol=0, atol=1e-12)
    assert percentiles(spark.createDataFrame([], "key string, x double"), ["key"], "x", [0.5]).count() == 0


def iou(p, q):
    w, h = max(0, min(p[2], q[2]) - max(p[0], q[0]) + 1), max(0, min(p[3], q[3]) - max(p[1], q[1]) + 1)
    area = lambda b: (b[2] - b[0] + 1) * (b[3] - b[1] + 1)
    return w * h / (area(p) + area(q) - w * h)


@pytest.mark.parametrize("threshold", [0.05, 0.45, 0.9])
def test_overlaps_are_those_of_all_pairs(spark, threshold):
    """Boxes from one pixel to the whole picture, at negative places and at tile edges; equal boxes; boxes without an extent."""
    rng = np.random.default_rng(2)
    rows = []
    for image in (1, 2, None):
        for i in range(150):
            side = float(2 ** rng.integers(0, 11))
            x, y = (float(v) for v in (rng.integers(-64, 1000, 2) if i % 3 else rng.integers(-1, 16, 2) * 64))
            rows.append((image, 0, len(rows), x, y, x + side * float(rng.choice([1.0, 0.7])) - 1, y + side - 1))
        rows.append((image, 0, len(rows), *rows[-1][3:]))
        rows.append((image, 0, len(rows), 5.0, 5.0, 3.0, 9.0))
    df = spark.createDataFrame(rows, "image_id int, cls int, box_id long, x1 double, y1 double, x2 double, y2 double")
    got = {(r["image_id"], r["a"], r["b"]): r["iou"] for r in detection.overlaps(df, threshold).collect()}
    want = {}
    for i, p in enumerate(rows):
        for q in rows[:i]:
            if p[0] is not None and p[0] == q[0] and p[5] > p[3] - 1 and q[5] > q[3] - 1 and iou(p[3:], q[3:]) > threshold:
                want[(p[0], q[2], p[2])] = iou(p[3:], q[3:])
    assert got == pytest.approx(want)
    pairs = detection.overlap_candidates(df, threshold)
    assert pairs.count() == pairs.select("image_id", "a", "b").distinct().count()


def test_few_pairs_are_examined(spark):
    """A picture full of small boxes: pairs grow with the boxes, not with their square."""
    boxes = spark.range(4000).select(F.lit(1).alias("image_id"), F.lit(0).alias("cls"), F.col("id").alias("box_id"), (F.col("id") % 80 * 25).cast("double").alias("x1"), (F.floor(F.col("id") / 80) * 25).cast("double").alias("y1"))
    boxes = boxes.withColumns({"x2": F.col("x1") + 29, "y2": F.col("y1") + 29})
    assert detection.overlap_candidates(boxes, 0.45).count() < 4000 * 10  # of 8 million
    with pytest.raises(ValueError):
        detection.overlaps(boxes, 0)


def crowd(spark, n=600):
    """One image of boxes, every third of them one of twenty places; two boxes share an id, one has none, two lack a side."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        x, y = (i % 20, 3) if i % 3 == 0 else (int(v) for v in rng.integers(0, 60, 2))
        rows.append((1, 0, i, float(x), float(y), x + 20.0, y + (20.0 if i % 3 == 0 else float(rng.integers(10, 40)))))
    rows += [(1, 0, 5, 1.0, 1.0, 9.0, 9.0), (1, 0, None, 1.0, 1.0, 9.0, 9.0), (None, 0, 7, 1.0, 1.0, 9.0, 9.0), (1, 0, n, None, 1.0, 9.0, 9.0), (1, 0, n + 1, None, 1.0, 9.0, 9.0)]
    return rows, spark.createDataFrame(rows, "image_id int, cls int, box_id long, x1 double, y1 double, x2 double, y2 double").repartition(3)


def test_pairs_of_one_crowded_image_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(detection, "COPIES", 4)
    monkeypatch.setattr(detection, "SLICE", 64)
    rows, boxes = crowd(spark)
    got = detection.iou_pairs(boxes).withColumn("task", F.spark_partition_id()).collect()
    own = [r for r in rows if r[0] == 1 and r[2] is not None]
    want = sorted((*sorted((p[2], q[2])), -1.0 if None in (*p, *q) else round(iou(p[3:], q[3:]), 9)) for i, p in enumerate(own) for q in own[:i] if p[2] != q[2])
    assert sorted((r["a"], r["b"], -1.0 if r["iou"] is None else round(r["iou"], 9)) for r in got) == want
    assert len({r["task"] for r in got}) > 4


def test_overlaps_of_one_crowded_tile_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(detection, "COPIES", 4)
    monkeypatch.setattr(detection, "SLICE", 64)
    rows, _ = crowd(spark)
    rows = [(i, c, k, x % 4, y % 4, x % 4 + 59 - k % 50, y % 4 + 59 - k % 10) for i, c, k, x, y, _, _ in rows if i == 1 and k is not None and x is not None]
    boxes = spark.createDataFrame(rows, "image_id int, cls int, box_id long, x1 double, y1 double, x2 double, y2 double").repartition(3)
    got = detection.overlaps(boxes, 0.6).withColumn("task", F.spark_partition_id()).collect()
    want = sorted((*sorted((p[2], q[2])), iou(p[3:], q[3:])) for i, p in enumerate(rows) for q in rows[:i] if p[2] != q[2] and iou(p[3:], q[3:]) > 0.6)
    assert sorted((r["a"], r["b"], r["iou"]) for r in got) == want and len(want) > 10_000
    assert len({r["task"] for r in got}) > 4


@pytest.mark.parametrize("mixed", [False, True])
def test_a_crowded_place_is_shuffled_a_bounded_number_of_times(spark, monkeypatch, mixed):
    """Rows are not copied in proportion to the place's boxes, and every pair meets once."""
    monkeypatch.setattr(detection, "SLICE", 4)
    rows = [(1, c, (0.0, 0.0, 9.0, 9.0 + c), [c], not mixed or c % 5 > 0) for c in range(500)]
    made = spark.createDataFrame(rows, "p int, c long, box struct<x1 double, y1 double, x2 double, y2 double>, ids array<long>, equal boolean")
    large = made.where("equal").selectExpr("p", "c as l", "box as lb", "ids as li")
    other = made.selectExpr("p", "c as s", "box as sb", "ids as si", "equal")
    left, right, tasks = detection._sliced(large, other, ["p"])
    assert left.count() + right.count() <= 2 * detection.SLICES * 500 and 1 <= tasks <= detection.SLICES**2
    assert mixed or left.count() + right.count() <= (detection.SLICES + 1) * 500 * 1.2
    got = sorted(tuple(sorted((r["l"], r["s"]))) for r in detection._meet(large, other, ["p"]).select("l", "s").collect())
    assert got == sorted((a, b) for a in range(500) for b in range(a, 500) if rows[a][4] or (rows[b][4] and a != b))


def test_six_places(spark):
    """Halves go up, as in DuckDB."""
    values = [0.0, 1.0, 1 / 128, 3 / 128, 1 / 3, 2 / 3, 0.1234565, 0.9999995, 0.49999999999999994e-6, None]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", _six(F.col("v")).alias("r")).orderBy("i").select("r").collect()]
    con = duckdb.connect()
    assert got == [con.execute("SELECT round(?::DOUBLE, 6)", [v]).fetchone()[0] for v in values]


def test_layouts_meet_without_a_shuffle(spark):
    left = spark.range(1000).select(F.concat(F.lit("img"), F.col("id")).alias("image_id"), (F.col("id") * 2).alias("n"))
    right = spark.range(500, 1500).select(F.concat(F.lit("img"), F.col("id")).alias("image_id"), F.col("id").alias("n"))
    n = colocated.buckets_for(1000)
    rows = colocated.published_with_originals(colocated.lay_out(left, "image_id", n), colocated.lay_out(right, "image_id", n))
    found = {r["image_id"]: (r["n"], r["original_n"], r["side"]) for r in rows.collect()}
    assert len(found) == 1500 and found["img3"] == (6, None, "published") and found["img700"] == (1400, 700, "both") and found["img1200"] == (None, 1200, "original")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert [colocated.buckets_for(x) for x in (0, 8_000_000, 8_000_001, 10**12)] == [8, 8, 16, 20_000]
