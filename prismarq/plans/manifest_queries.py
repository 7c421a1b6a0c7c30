"""Queries on chunks and manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismarq.functions.text import range_label
from prismarq.operators import manifest as M
from prismarq.plans.catalogue import query

_OLD = """old AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'caption' WHEN 1 THEN 'seg' ELSE 'pose' END AS layer, (o_orderkey // 3 % 200) * 1000 AS start, (o_orderkey // 3 % 200) * 1000 + 999 AS "end", min(o_custkey) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)"""
_NEW = _OLD.replace("old AS", "new AS").replace("= 'F'", "<> 'F'").replace("min(o_custkey)", "max(o_custkey)")
_MERGED = f"""{_OLD}, {_NEW}, merged AS (SELECT layer, start, "end", n FROM old WHERE (layer, start) NOT IN (SELECT (layer, start) FROM new) UNION ALL SELECT layer, start, "end", n FROM new)"""


def _chunks(orders, status, n):
    k = F.col("o_orderkey") % 3
    layer = F.when(k == 0, "caption").when(k == 1, "seg").otherwise("pose")
    start = (F.floor(F.col("o_orderkey") / 3) % 200) * 1000
    rows = orders.where(status).groupBy(layer.alias("layer"), start.alias("start")).agg(n.alias("n"))
    return rows.select("layer", "start", (F.col("start") + 999).alias("end"), range_label(F.col("start"), F.col("start") + 999).alias("label"), "n")


def _merged(t):
    old = _chunks(t.orders, "o_orderstatus = 'F'", F.min("o_custkey"))
    return M.merge(old, _chunks(t.orders, "o_orderstatus <> 'F'", F.max("o_custkey")))


@query(f"""WITH {_MERGED} SELECT layer, printf('%05d-%05d', start, "end") AS label, start, "end", n FROM merged""")
def manifest_merge(t):
    return _merged(t).select("layer", "label", "start", "end", "n")


@query(f"""WITH {_MERGED} SELECT layer, count(*) AS chunks, CAST(sum(n) AS BIGINT) AS count FROM merged GROUP BY layer""")
def manifest_counts(t):
    return M.layer_counts(_merged(t))


_FILES = r"""files AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'data/' || printf('%05d-%05d', s, s + 999) || '.parquet' WHEN 1 THEN 'seg/' || printf('%05d-%05d', s, s + 999) || '.tar' WHEN 2 THEN 'manifest.json'
  WHEN 3 THEN 'data/' || printf('%05d-%05d', s, s + 999) || '.tar' ELSE 'a/b/' || printf('%05d-%05d', s, s + 999) || '.tar' END AS path FROM (SELECT o_orderkey, (o_orderkey // 5 % 300) * 1000 AS s FROM orders)),
listed AS (SELECT DISTINCT CASE WHEN starts_with(path, 'data/') THEN 'caption' ELSE split_part(path, '/', 1) END AS layer, CAST(regexp_extract(path, '/(\d+)-(\d+)\.', 1) AS BIGINT) AS start, CAST(regexp_extract(path, '/(\d+)-(\d+)\.', 2) AS BIGINT) AS "end"
  FROM files WHERE regexp_matches(path, '^data/\d+-\d+\.parquet$') OR (regexp_matches(path, '^[^/]+/\d+-\d+\.tar$') AND NOT starts_with(path, 'data/')))"""


def _listing(t):
    k, s = F.col("o_orderkey") % 5, (F.floor(F.col("o_orderkey") / 5) % 300) * 1000
    label = range_label(s, s + 999)
    path = (
        F.when(k == 0, F.concat(F.lit("data/"), label, F.lit(".parquet"))).when(k == 1, F.concat(F.lit("seg/"), label, F.lit(".tar"))).when(k == 2, "manifest.json")
        .when(k == 3, F.concat(F.lit("data/"), label, F.lit(".tar"))).otherwise(F.concat(F.lit("a/b/"), label, F.lit(".tar")))
    )
    return t.orders.select(path.alias("path"))


@query(f"""WITH {_FILES} SELECT layer, count(*) AS chunks, CAST(sum("end" - start + 1) AS BIGINT) AS count FROM listed GROUP BY layer""")
def manifest_rebuild(t):
    return M.layer_counts(M.from_listing(_listing(t)))


@query(f"""WITH {_FILES} SELECT coalesce(max("end") + 1, 0) AS total_images FROM listed""")
def manifest_total(t):
    return M.total_images(M.from_listing(_listing(t)))


@query("""WITH c AS (SELECT o_orderpriority AS layer, o_orderkey * 10 AS start, o_orderkey * 10 + o_custkey AS "end" FROM orders),
s AS (SELECT *, max(ROW("end", printf('%05d-%05d', start, "end"))) OVER (PARTITION BY layer ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c)
SELECT layer, reach[2] AS earlier, printf('%05d-%05d', start, "end") AS later FROM s WHERE reach[1] >= start""")
def chunk_overlap_check(t):
    start = F.col("o_orderkey") * 10
    end = start + F.col("o_custkey")
    return M.overlaps(t.orders.select(F.col("o_orderpriority").alias("layer"), start.alias("start"), end.alias("end"), range_label(start, end).alias("label")))
