"""Queries on vectors and on values as masks and maps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from prismarq.functions import charts as C
from prismarq.functions import tensor as V
from prismarq.operators.selection import percentiles
from prismarq.plans.catalogue import query
from prismarq.sources.shared import write_table

_V = "CAST(embedding AS DOUBLE[])"
_NORM = f"sqrt(list_sum(list_transform({_V}, lambda x: x * x)))"


@query(f"SELECT vec_id, round({_NORM}, 6) AS norm FROM embeddings")
def vector_norms(t):
    return t.embeddings.select("vec_id", F.round(V.norm(F.col("embedding")), 6).alias("norm"))


def _long(embeddings, vector):
    """One row for each element of a vector."""
    rows = embeddings.select("vec_id", F.posexplode(vector).alias("pos", "x"))
    return rows.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"))


@query(f"SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, round(unnest({_V}) / (n + 1e-5::DOUBLE), 6) AS x FROM (SELECT vec_id, embedding, {_NORM} AS n FROM embeddings)")
def l2_normalize(t):
    return _long(t.embeddings, V.l2_normalise(F.col("embedding")))


@query(f"SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, round(unnest({_V}) / greatest(n, 1e-8::DOUBLE), 6) AS x FROM (SELECT vec_id, embedding, {_NORM} AS n FROM embeddings)")
def l2_normalize_floor(t):
    return _long(t.embeddings, V.l2_normalise_floor(F.col("embedding")))


def _to_anchor(embeddings):
    """Cosine of each vector with vector 0, which is one row."""
    anchor = embeddings.where("vec_id = 0").select(F.col("embedding").alias("anchor")).limit(1)
    return embeddings.join(F.broadcast(anchor)).select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("anchor")), 6).alias("cosine"))


_COSINE = f"""SELECT e.vec_id, round(list_sum(list_transform(list_zip({_V.replace('embedding', 'e.embedding')}, CAST(a.embedding AS DOUBLE[])), lambda p: p[1] * p[2]))
  / ((sqrt(list_sum(list_transform(CAST(e.embedding AS DOUBLE[]), lambda x: x * x))) + 1e-8::DOUBLE) * (sqrt(list_sum(list_transform(CAST(a.embedding AS DOUBLE[]), lambda x: x * x))) + 1e-8::DOUBLE)), 6) AS cosine
  FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) a"""


@query(_COSINE)
def cosine_to_anchor(t):
    return _to_anchor(t.embeddings)


@query(f"SELECT * FROM ({_COSINE}) ORDER BY cosine DESC, vec_id LIMIT 10")
def cosine_topk(t):
    return _to_anchor(t.embeddings).orderBy(F.desc("cosine"), "vec_id").limit(10)


@query(f"""WITH n AS (SELECT label, {_NORM} AS norm, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings)
SELECT label, round(avg(norm) FILTER (pos < 4), 6) AS first_norm, round(avg(norm) FILTER (pos >= 4), 6) AS rest_norm, count(*) > 8 AND avg(norm) FILTER (pos < 4) > 1.4::DOUBLE * avg(norm) FILTER (pos >= 4) AS has_registers FROM n GROUP BY label""")
def register_detect(t):
    pos = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    rows = t.embeddings.select("label", V.norm(F.col("embedding")).alias("norm"), pos.alias("pos"))
    first, rest = F.avg(F.when(F.col("pos") < 4, F.col("norm"))), F.avg(F.when(F.col("pos") >= 4, F.col("norm")))
    return rows.groupBy("label").agg(F.round(first, 6).alias("first_norm"), F.round(rest, 6).alias("rest_norm"), ((F.count(F.lit(1)) > 8) & (first > 1.4 * rest)).alias("has_registers"))


@query("""WITH b AS (SELECT event_type, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM events GROUP BY event_type)
SELECT event_id, round(CASE WHEN hi > lo THEN greatest(0, least(1, (value - lo) / (hi - lo))) ELSE 0 END, 6) AS clipped FROM events JOIN b USING (event_type)""")
def percentile_clip(t):
    bounds = percentiles(t.events, ["event_type"], "value", [0.02, 0.98])
    rows = t.events.join(bounds, "event_type")
    return rows.select("event_id", F.round(V.clip_range(F.col("value"), F.get("q", F.lit(0)), F.get("q", F.lit(1))), 6).alias("clipped"))


@query("""SELECT count(l_extendedprice) AS n, round(min(l_extendedprice), 4) AS p0, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
  round(quantile_cont(l_extendedprice, 0.98), 4) AS p98, round(max(l_extendedprice), 4) AS p100 FROM lineitem""")
def price_percentiles(t):
    """One key for all rows: no task sees them all."""
    rows = percentiles(t.lineitem.withColumn("all", F.lit(1)), ["all"], "l_extendedprice", [0.0, 0.25, 0.5, 0.98, 1.0])
    return rows.select("n", *[F.round(F.get("q", F.lit(i)), 4).alias(f"p{p}") for i, p in enumerate((0, 25, 50, 98, 100))])


@query("""WITH b AS (SELECT l_orderkey, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey)
SELECT l.l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN l_returnflag <> 'N' AND hi > lo THEN (l_extendedprice - lo) / (hi - lo) ELSE 0 END, 6) AS depth FROM lineitem l LEFT JOIN b ON l.l_orderkey = b.l_orderkey""")
def foreground_minmax(t):
    inside = F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice"))
    w = Window.partitionBy("l_orderkey")
    rows = t.lineitem.withColumn("lo", F.min(inside).over(w)).withColumn("hi", F.max(inside).over(w))
    depth = F.when(inside.isNotNull() & (F.col("hi") > F.col("lo")), (inside - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(F.lit(0.0))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(depth, 6).alias("depth"))


@query(f"""SELECT vec_id, pos, round(CASE WHEN x > 0 AND hi > lo THEN (x - lo) / (hi - lo) ELSE 0 END, 6) AS x FROM
(SELECT vec_id, unnest({_V}) AS x, generate_subscripts(embedding, 1) - 1 AS pos, lo, hi FROM (SELECT vec_id, embedding, list_min(list_filter({_V}, lambda x: x > 0)) AS lo, list_max(list_filter({_V}, lambda x: x > 0)) AS hi FROM embeddings))""")
def foreground_minmax_array(t):
    mask = F.transform("embedding", lambda x: F.when(x > 0, 1).otherwise(0))
    return _long(t.embeddings, V.foreground_min_max(F.col("embedding"), mask))


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS cls FROM embeddings")
def argmax_class(t):
    return t.embeddings.select("vec_id", V.argmax(F.col("embedding")).alias("cls"))


@query("SELECT label, array_to_string(list_sort(list_distinct(list(list_position(embedding, list_max(embedding)) - 1))), ',') AS classes FROM embeddings GROUP BY label")
def class_presence(t):
    rows = t.embeddings.select("label", V.argmax(F.col("embedding")).cast("int").alias("c"))
    return rows.groupBy("label").agg(F.array_join(F.sort_array(F.collect_set("c")).cast("array<string>"), ",").alias("classes"))


@query("SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS BIGINT) AS n_tokens FROM embeddings")
def masked_token_count(t):
    mask = F.transform("embedding", lambda x: F.when(x > 0, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return t.embeddings.select("vec_id", F.aggregate(mask, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_tokens"))


@query(f"SELECT label, pos - 1 AS pos, round(avg(x), 6) AS mean FROM (SELECT label, unnest({_V}) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY label, pos")
def mean_pool(t):
    return V.mean_pool(t.embeddings, "label", "embedding").select("label", F.col("pos").cast("bigint").alias("pos"), F.round("mean", 6).alias("mean"))


@query(f"SELECT vec_id, pos, round(CASE WHEN hi > lo THEN (x - lo) / (hi - lo) ELSE 0 END, 6) AS x FROM (SELECT vec_id, unnest({_V}) AS x, generate_subscripts(embedding, 1) - 1 AS pos, lo, hi FROM (SELECT vec_id, embedding, list_min({_V}) AS lo, list_max({_V}) AS hi FROM embeddings))")
def token_minmax(t):
    return _long(t.embeddings, V.min_max(F.col("embedding")))


_HALF = f"{_V}[1:32]"
_REST = f"{_V}[33:64]"


@query(f"""SELECT vec_id, CASE WHEN conf > 0 THEN (list_position({_HALF}, mx) - 1) / 2.0::DOUBLE ELSE -1 END AS x, CASE WHEN conf > 0 THEN (list_position({_REST}, my) - 1) / 2.0::DOUBLE ELSE -1 END AS y, round(conf, 6) AS conf
FROM (SELECT *, least(mx, my) AS conf FROM (SELECT vec_id, embedding, list_max({_HALF}) AS mx, list_max({_REST}) AS my FROM embeddings))""")
def simcc_decode(t):
    v = V.doubles(F.col("embedding"))
    rows = t.embeddings.select("vec_id", V.simcc_peak(F.slice(v, 1, 32), F.slice(v, 33, 32)).alias("k"))
    return rows.select("vec_id", "k.x", "k.y", F.round("k.conf", 6).alias("conf"))


@query("SELECT vec_id, CAST(len(embedding[6:]) AS BIGINT) AS n, round(list_sum(CAST(embedding[6:] AS DOUBLE[])), 5) AS total FROM embeddings")
def patch_slice(t):
    tokens = V.doubles(V.patch_tokens(F.col("embedding")))
    return t.embeddings.select("vec_id", F.size(tokens).cast("bigint").alias("n"), F.round(F.aggregate(tokens, F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


@query(f"""WITH n AS (SELECT vec_id, label, {_V} AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings),
cls AS (SELECT label, v AS c FROM n WHERE pos = 0),
cos AS (SELECT n.label, pos - 5 AS p, list_sum(list_transform(list_zip(v, c), lambda q: q[1] * q[2])) / ((sqrt(list_sum(list_transform(v, lambda x: x * x))) + 1e-8::DOUBLE) * (sqrt(list_sum(list_transform(c, lambda x: x * x))) + 1e-8::DOUBLE)) AS s
  FROM n JOIN cls ON n.label = cls.label WHERE pos >= 5),
g AS (SELECT label, CAST(ceil(sqrt(count(*))) AS BIGINT) AS side, quantile_cont(s, 0.02) AS lo, quantile_cont(s, 0.98) AS hi FROM cos GROUP BY label)
SELECT cos.label, p // side AS "row", p % side AS col, round(CASE WHEN hi > lo THEN greatest(0, least(1, (s - lo) / (hi - lo))) ELSE 0 END, 5) AS heat FROM cos JOIN g ON cos.label = g.label""")
def patch_heatmap(t):
    """Class token against patches, clipped between percentiles and laid out in a square."""
    pos = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    rows = t.embeddings.select("label", "embedding", pos.alias("pos"))
    cls = rows.where("pos = 0").select("label", F.col("embedding").alias("cls"))
    cos = rows.where("pos >= 5").join(cls, "label").select("label", (F.col("pos") - 5).alias("p"), V.cosine(F.col("embedding"), F.col("cls")).alias("s"))
    cos = write_table(cos)
    grid = percentiles(cos, ["label"], "s", [0.02, 0.98]).withColumn("side", F.ceil(F.sqrt("n")))
    heat = V.clip_range(F.col("s"), F.get("q", F.lit(0)), F.get("q", F.lit(1)))
    out = cos.join(grid, "label")
    return out.select("label", F.floor(F.col("p") / F.col("side")).alias("row"), (F.col("p") % F.col("side")).alias("col"), F.round(heat, 5).alias("heat"))


_IMAGES = f"n AS (SELECT vec_id, label, {_V} AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings)"


def _by_image(vectors, work, schema):
    """``work`` on the vectors of each label, in order of vec_id: tokens of one image, as many as a model has."""

    def run(pdf):
        pdf = pdf.sort_values("vec_id")
        return work(int(pdf["label"].iloc[0]), np.stack(pdf["embedding"].to_numpy()).astype(np.float64))

    return vectors.select("label", "vec_id", "embedding").groupBy("label").applyInPandas(run, schema)


@query(f"""WITH {_IMAGES}, c AS (SELECT label, v AS c FROM n WHERE pos = 0), tok AS (SELECT label, v, pos - 1 AS p, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM n WHERE pos > 0),
r AS (SELECT label, CASE WHEN count(*) > 8 AND avg(norm) FILTER (p < 4) > 1.4::DOUBLE * avg(norm) FILTER (p >= 4) THEN 4 ELSE 0 END AS r FROM tok GROUP BY label),
s AS (SELECT tok.label, p - r AS p, list_sum(list_transform(list_zip(v, c), lambda q: q[1] * q[2])) / ((norm + 1e-8::DOUBLE) * (sqrt(list_sum(list_transform(c, lambda x: x * x))) + 1e-8::DOUBLE)) AS s
  FROM tok JOIN c ON tok.label = c.label JOIN r ON tok.label = r.label WHERE p >= r),
g AS (SELECT label, CAST(ceil(sqrt(count(*))) AS BIGINT) AS side FROM s GROUP BY label),
cells AS (SELECT g.label, side, i AS cell, coalesce(s.s, 0) AS s FROM (SELECT label, side, unnest(range(side * side)) AS i FROM g) g LEFT JOIN s ON g.label = s.label AND g.i = s.p),
q AS (SELECT label, quantile_cont(s, 0.02) AS lo, quantile_cont(s, 0.98) AS hi FROM cells GROUP BY label)
SELECT cells.label, 2 * (cell // side) + dy AS y, 2 * (cell % side) + dx AS x, round(greatest(0, least(1, (s - lo) / (hi - lo + 1e-8::DOUBLE))), 5) AS heat
FROM cells JOIN q ON cells.label = q.label, (SELECT unnest([0, 1]) AS dy), (SELECT unnest([0, 1]) AS dx)""")
def similarity_map(t):
    """Class token against patches of each image: registers found and dropped, square grid, percentiles, blocks of two by two."""

    def work(label, tokens):
        patches = tokens[1:]
        n = len(patches) - (C.REGISTERS if C.has_registers(patches) else 0)
        side = 2 * int(np.ceil(np.sqrt(n)))
        heat = C.similarity_map(tokens[0], patches, side, side)
        y, x = np.divmod(np.arange(side * side), side)
        return pd.DataFrame({"label": label, "y": y, "x": x, "heat": heat.ravel()})

    return _by_image(t.embeddings, work, "label bigint, y bigint, x bigint, heat double").withColumn("heat", F.round("heat", 5))


@query(f"""WITH {_IMAGES}, k AS (SELECT label, count(*) * 3 // 4 AS r FROM n GROUP BY label), m AS (SELECT n.label, pos, r, (1 + vec_id % 7) * CAST(sqrt(list_sum(list_transform(v, lambda x: x * x))) AS DOUBLE) AS norm FROM n JOIN k ON n.label = k.label),
b AS (SELECT label, min(norm) FILTER (pos < r) AS lo, max(norm) FILTER (pos < r) AS hi FROM m GROUP BY label)
SELECT m.label, pos, r AS "real", round(norm, 3) AS norm, round(CASE WHEN pos < r THEN (norm - lo) / (hi - lo + 1e-8::DOUBLE) END, 3) AS scaled FROM m JOIN b ON m.label = b.label""")
def token_chart(t):
    """Strength of every token of each image (vectors of seven lengths), scaled over the real ones: three quarters of them."""

    def work(label, tokens):
        mask = (np.arange(len(tokens)) < len(tokens) * 3 // 4).astype(int)
        chart = C.token_chart(mask, "", tokens)
        scaled = pd.Series(chart["scaled"].astype(np.float64)).reindex(range(len(tokens)))
        return pd.DataFrame({"label": label, "pos": range(len(tokens)), "real": chart["real"], "norm": chart["norms"].astype(np.float64), "scaled": scaled})

    strong = t.embeddings.withColumn("embedding", F.transform("embedding", lambda x: x * (1 + F.col("vec_id") % 7)))
    out = _by_image(strong, work, "label bigint, pos bigint, real bigint, norm double, scaled double")
    return out.withColumn("norm", F.round("norm", 3)).withColumn("scaled", F.when(~F.isnan("scaled"), F.round("scaled", 3)))
