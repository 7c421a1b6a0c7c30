"""Queries on buckets, crops, boxes and keypoints' coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismarq.functions import geometry as G
from prismarq.plans.catalogue import query

_SIZES = "sizes AS (SELECT p_partkey, CAST(256 + p_size * 16 AS BIGINT) AS w, CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE 256 + (p_partkey % 50) * 16 END AS h FROM part)"
_RATIO = "CASE WHEN h > 0 THEN w / h ELSE 1.0::DOUBLE END"
_LIST = "(VALUES (0, 1024, 1024), (1, 832, 1216), (2, 1216, 832), (3, 768, 1280), (4, 1280, 768), (5, 704, 1344), (6, 1344, 704)) b(i, bw, bh)"
_NEAREST = f"""near AS (SELECT p_partkey, w, h, {_RATIO} AS ratio, bw || 'x' || bh AS bucket, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(({_RATIO}) - bw / bh), i) AS rn FROM sizes, {_LIST})"""


def _sizes(part):
    h = F.when(F.col("p_partkey") % 97 == 0, F.lit(0)).otherwise(256 + (F.col("p_partkey") % 50) * 16).cast("bigint")
    return part.select("p_partkey", (256 + F.col("p_size") * 16).cast("bigint").alias("w"), h.alias("h"))


@query(f"WITH {_SIZES}, {_NEAREST} SELECT p_partkey, ratio, bucket FROM near WHERE rn = 1")
def aspect_bucket_assign(t):
    w, h = F.col("w"), F.col("h")
    return _sizes(t.part).select("p_partkey", G.aspect_ratio(w, h).alias("ratio"), G.nearest_bucket(w, h).alias("bucket"))


@query(f"WITH {_SIZES}, {_NEAREST} SELECT bucket, count(*) AS images FROM near WHERE rn = 1 GROUP BY bucket")
def aspect_bucket_histogram(t):
    bucket = G.nearest_bucket(F.col("w"), F.col("h")).alias("bucket")
    return _sizes(t.part).select(bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("images"))


@query(r"""WITH l AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'bucket_' || p_size || 'x' || p_partkey WHEN 1 THEN p_size || 'x' || p_partkey WHEN 2 THEN ' ' || p_size || ' x ' || p_partkey WHEN 3 THEN 'invalid' WHEN 4 THEN '' ELSE p_size || 'x' END AS label FROM part)
SELECT p_partkey, TRY_CAST(nullif(regexp_extract(label, '^(?:bucket_)?\s*([+-]?\d+)\s*x\s*([+-]?\d+)\s*$', 1), '') AS BIGINT) AS w, TRY_CAST(nullif(regexp_extract(label, '^(?:bucket_)?\s*([+-]?\d+)\s*x\s*([+-]?\d+)\s*$', 2), '') AS BIGINT) AS h FROM l""")
def bucket_dims_parse(t):
    size, key, kind = F.col("p_size").cast("string"), F.col("p_partkey").cast("string"), F.col("p_partkey") % 6
    label = (
        F.when(kind == 0, F.concat(F.lit("bucket_"), size, F.lit("x"), key)).when(kind == 1, F.concat(size, F.lit("x"), key))
        .when(kind == 2, F.concat(F.lit(" "), size, F.lit(" x "), key)).when(kind == 3, "invalid").when(kind == 4, "").otherwise(F.concat(size, F.lit("x")))
    )
    d = G.parse_bucket(label)
    return t.part.select("p_partkey", d["w"].alias("w"), d["h"].alias("h"))


@query("""WITH s AS (SELECT p_partkey, 300 + p_size * 13 AS w, 200 + (p_partkey % 61) * 11 AS h FROM part),
g AS (SELECT p_partkey, CAST(ceil(w * greatest(832 / w, 1216 / h)) AS BIGINT) AS new_w, CAST(ceil(h * greatest(832 / w, 1216 / h)) AS BIGINT) AS new_h FROM s)
SELECT p_partkey, new_w, new_h, CAST(greatest(0, floor((new_w - 832) / 2)) AS BIGINT) AS "left", CAST(greatest(0, floor((new_h - 1216) / 2)) AS BIGINT) AS top FROM g""")
def crop_geometry(t):
    w, h = (300 + F.col("p_size") * 13), (200 + (F.col("p_partkey") % 61) * 11)
    return t.part.select("p_partkey", G.crop_plan(w, h, F.lit(832), F.lit(1216)).alias("c")).select("p_partkey", "c.*")


@query("""SELECT p_partkey, CAST(round_even(p_size * 5 / 16.0, 0) * 16 AS BIGINT) AS w, CAST(round_even((p_partkey % 333) / 16.0, 0) * 16 AS BIGINT) AS h FROM part""")
def patch_grid(t):
    return t.part.select("p_partkey", G.patch_size(F.col("p_size") * 5).alias("w"), G.patch_size(F.col("p_partkey") % 333).alias("h"))


@query("""SELECT p_partkey, r AS ratio, CAST(floor(w * r) AS BIGINT) AS new_w, CAST(floor(h * r) AS BIGINT) AS new_h FROM
(SELECT p_partkey, w, h, least(640 / w, 640 / h) AS r FROM (SELECT p_partkey, 300 + p_size * 13 AS w, 200 + (p_partkey % 61) * 11 AS h FROM part))""")
def letterbox_geometry(t):
    w, h = (300 + F.col("p_size") * 13), (200 + (F.col("p_partkey") % 61) * 11)
    return t.part.select("p_partkey", G.letterbox(w, h).alias("c")).select("p_partkey", "c.*")


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_KEYS = _LINE.split(", ")


@query(f"SELECT {_LINE}, round(2.0::DOUBLE * l_quantity / 50 - 1, 6) AS x, round(2.0::DOUBLE * l_extendedprice / 110000 - 1, 6) AS y, l_discount AS conf FROM lineitem")
def keypoint_normalize(t):
    x, y = G.to_unit(F.col("l_quantity"), F.lit(50)), G.to_unit(F.col("l_extendedprice"), F.lit(110000))
    return t.lineitem.select(*_KEYS, F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), F.col("l_discount").alias("conf"))


@query(f"SELECT {_LINE}, round((l_discount + 1) * 832 / 2, 6) AS px, round((l_tax + 1) * 1216 / 2, 6) AS py FROM lineitem")
def keypoint_denormalize(t):
    return t.lineitem.select(*_KEYS, F.round(G.to_pixel(F.col("l_discount"), F.lit(832)), 6).alias("px"), F.round(G.to_pixel(F.col("l_tax"), F.lit(1216)), 6).alias("py"))


@query("""SELECT l_orderkey, count(*) AS n, min(l_quantity) AS min_x, max(l_quantity) AS max_x, min(l_extendedprice) AS min_y, max(l_extendedprice) AS max_y
FROM lineitem WHERE l_discount * 10 > 0.3 GROUP BY l_orderkey""")
def keypoint_filter(t):
    valid = t.lineitem.where(F.col("l_discount") * 10 > 0.3)
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return valid.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min(q).alias("min_x"), F.max(q).alias("max_x"), F.min(p).alias("min_y"), F.max(p).alias("max_y"))


@query(f"SELECT {_LINE}, CASE WHEN l_partkey % 133 BETWEEN 23 AND 90 THEN l_discount * 10 > 0.3::DOUBLE ELSE l_discount * 10 >= 0.3::DOUBLE END AS drawn FROM lineitem")
def keypoint_drawn(t):
    """Face dots need more than the threshold, lines of the skeleton keep what equals it."""
    return t.lineitem.select(*_KEYS, G.is_drawn(F.col("l_partkey") % 133, F.col("l_discount") * 10).alias("drawn"))


_BOX = """boxes AS (SELECT p_partkey, (p_partkey % 640) - (p_size * 4.0::DOUBLE) / 2 AS x1, (p_partkey % 480) - (p_retailprice / 10) / 2 AS y1,
  (p_partkey % 640) + (p_size * 4.0::DOUBLE) / 2 AS x2, (p_partkey % 480) + (p_retailprice / 10) / 2 AS y2 FROM part)"""


@query(f"""WITH {_BOX}, s AS (SELECT p_partkey, (x1 + x2) * 0.5::DOUBLE AS cx, (y1 + y2) * 0.5::DOUBLE AS cy, (x2 - x1) * 1.25::DOUBLE AS sw, (y2 - y1) * 1.25::DOUBLE AS sh FROM boxes)
SELECT p_partkey, round(cx, 6) AS cx, round(cy, 6) AS cy, round(CASE WHEN sw > sh * 0.75::DOUBLE THEN sw ELSE sh * 0.75::DOUBLE END, 6) AS sw, round(CASE WHEN sw > sh * 0.75::DOUBLE THEN sw / 0.75::DOUBLE ELSE sh END, 6) AS sh FROM s""")
def bbox_transform(t):
    box = G.corners(F.col("p_partkey") % 640, F.col("p_partkey") % 480, F.col("p_size") * 4.0, F.col("p_retailprice") / 10)
    rows = t.part.select("p_partkey", G.centre_scale(box).alias("c"))
    fixed = G.fix_aspect(F.col("c.sw"), F.col("c.sh"))
    return rows.select("p_partkey", F.round("c.cx", 6).alias("cx"), F.round("c.cy", 6).alias("cy"), F.round(fixed["sw"], 6).alias("sw"), F.round(fixed["sh"], 6).alias("sh"))


@query(f"SELECT {_LINE}, round(l_quantity / 288.0::DOUBLE * l_suppkey + l_partkey - l_suppkey / 2, 6) AS x FROM lineitem")
def keypoint_back_project(t):
    x = G.back_project(F.col("l_quantity"), G.CROP_WIDTH, F.col("l_suppkey"), F.col("l_partkey"))
    return t.lineitem.select(*_KEYS, F.round(x, 6).alias("x"))
