"""Queries on paths, captions, labels and sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismarq.functions import text as T
from prismarq.operators.positional import with_position
from prismarq.plans.catalogue import query

_URL_PATH = r"^[a-z]+://([^?#]*)"
_SUFFIXES = ["jpg", "JPG", "jpeg", "png", "webp", "txt", "bmp", "tiff", "tif", "json", ""]
_SQL_SUFFIX = "['jpg','JPG','jpeg','png','webp','txt','bmp','tiff','tif','json',''][1 + page_id % 11]"
_SQL_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _paths(pages):
    """A path per page: its URL's host and path, with one of several suffixes by page number."""
    end = F.element_at(F.lit(_SUFFIXES), (F.col("page_id") % len(_SUFFIXES) + 1).cast("int"))
    stem = F.regexp_replace(F.regexp_extract("url", _URL_PATH, 1), "/$", "")
    return pages.select("page_id", F.when(end == "", stem).otherwise(F.concat(stem, F.lit("."), end)).alias("path"))


_SQL_PATHS = rf"""paths AS (SELECT page_id, CASE WHEN {_SQL_SUFFIX} = '' THEN stem ELSE stem || '.' || {_SQL_SUFFIX} END AS path
  FROM (SELECT page_id, regexp_replace(regexp_extract(url, '{_URL_PATH}', 1), '/$', '') AS stem FROM pages))"""


@query(rf"""WITH {_SQL_PATHS} SELECT page_id, regexp_replace(path, '([^/])\.[^./]+$', '\1') AS image_id, 'out/' || regexp_replace(path, '([^/])\.[^./]+$', '\1') AS output_dir FROM paths""")
def image_id_from_url(t):
    ids = _paths(t.pages).withColumn("image_id", T.image_id(F.col("path")))
    return ids.select("page_id", "image_id", T.output_dir(F.lit("out"), F.col("image_id")).alias("output_dir"))


@query(rf"""WITH {_SQL_PATHS} SELECT page_id, path, lower(regexp_extract(path, '[^/](\.[^./]+)$', 1)) AS suffix FROM paths
WHERE lower(regexp_extract(path, '[^/](\.[^./]+)$', 1)) IN ('.jpg', '.jpeg', '.png', '.webp', '.bmp', '.tiff', '.tif')""")
def image_scan_filter(t):
    rows = _paths(t.pages)
    return rows.where(T.is_image(F.col("path"))).select("page_id", "path", T.suffix(F.col("path")).alias("suffix"))


@query(rf"""WITH {_SQL_PATHS} SELECT page_id, path, row_number() OVER (ORDER BY string_split(path, '/'), page_id) - 1 AS pos FROM paths""")
def path_component_order(t):
    return with_position(_paths(t.pages), T.components(F.col("path")), F.col("page_id")).select("page_id", "path", "pos")


@query(rf"""SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '{_SQL_WHITE}', ' ', 'g')) AS caption FROM documents""")
def caption_normalize(t):
    return t.documents.select("doc_id", T.single_paragraph(F.col("text")).alias("caption"))


@query(rf"""SELECT doc_id, regexp_replace(regexp_replace(text, '^{_SQL_WHITE}', ''), '{_SQL_WHITE}$', '') AS caption FROM documents""")
def caption_strip(t):
    return t.documents.select("doc_id", T.strip(F.col("text")).alias("caption"))


@query("""SELECT doc_id, CASE WHEN length(text) > 120 THEN left(text, 120) || '...' ELSE text END AS preview FROM documents""")
def caption_preview(t):
    return t.documents.select("doc_id", T.preview(F.col("text")).alias("preview"))


@query("""SELECT doc_id, n, CASE WHEN n < 1024 THEN printf('%d B', n) WHEN n < 1048576 THEN printf('%.1f KB', n / 1024.0::DOUBLE)
  WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576.0::DOUBLE) WHEN n < 1099511627776 THEN printf('%.1f GB', n / 1073741824.0::DOUBLE)
  ELSE printf('%.1f TB', n / 1099511627776.0::DOUBLE) END AS size FROM (SELECT doc_id, n_chars * (doc_id * doc_id + 1) AS n FROM documents)""")
def human_size(t):
    n = F.col("n_chars") * (F.col("doc_id") * F.col("doc_id") + 1)
    return t.documents.select("doc_id", n.alias("n")).withColumn("size", T.human_size(F.col("n")))


@query("""SELECT o_orderkey, printf('%05d-%05d', (rn // 1000) * 1000, (rn // 1000) * 1000 + 999) AS label FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders)""")
def range_labels(t):
    rows = with_position(t.orders.select("o_orderkey"), "o_orderkey")
    first = F.floor(F.col("pos") / 1000) * 1000
    return rows.select("o_orderkey", T.range_label(first, first + 999).alias("label"))


_ODD = ["%s.parquet", "%s.tar", "manifest.json", "README.md", "", "%s", "x%s.tar"]


@query(r"""WITH names AS (SELECT o_orderkey, printf('%05d-%05d', o_orderkey, o_orderkey + o_custkey) AS label FROM orders),
files AS (SELECT o_orderkey, [label || '.parquet', label || '.tar', 'manifest.json', 'README.md', '', label, 'x' || label || '.tar'][1 + o_orderkey % 7] AS name FROM names)
SELECT o_orderkey, name, TRY_CAST(nullif(regexp_extract(name, '^(\d+)-(\d+)\.', 1), '') AS BIGINT) AS start, TRY_CAST(nullif(regexp_extract(name, '^(\d+)-(\d+)\.', 2), '') AS BIGINT) AS "end" FROM files""")
def range_label_parse(t):
    label = T.range_label(F.col("o_orderkey"), F.col("o_orderkey") + F.col("o_custkey"))
    name = F.element_at(F.array(*[F.replace(F.lit(p), F.lit("%s"), label) for p in _ODD]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    rows = t.orders.select("o_orderkey", name.alias("name")).withColumn("r", T.parse_range_label(F.col("name")))
    return rows.select("o_orderkey", "name", F.col("r.start").alias("start"), F.col("r.end").alias("end"))


@query(r"""WITH v AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '1.2.' || o_custkey WHEN 1 THEN '0.' || o_custkey WHEN 2 THEN '' || o_custkey ELSE '1.0.' || o_custkey || '.9' END AS version FROM orders)
SELECT o_orderkey, version, p[1] || '.' || p[2] || '.' || (p[3] + 1) AS bumped FROM (SELECT o_orderkey, version, list_transform(list_concat(string_split(version, '.'), ['0', '0', '0'])[1:3], lambda x: CAST(x AS BIGINT)) AS p FROM v)""")
def version_bump(t):
    c = F.col("o_custkey").cast("string")
    kind = F.col("o_orderkey") % 4
    version = F.when(kind == 0, F.concat(F.lit("1.2."), c)).when(kind == 1, F.concat(F.lit("0."), c)).when(kind == 2, c).otherwise(F.concat(F.lit("1.0."), c, F.lit(".9")))
    return t.orders.select("o_orderkey", version.alias("version")).withColumn("bumped", T.bump_version(F.col("version")))


@query("""SELECT p_partkey, trim(split_part(p_name || ': ' || p_type, ':', 1)) AS issue, regexp_replace(lower(trim(split_part(p_name || ' (' || p_brand || ')', '(', 1))), '[ -]', '_', 'g') AS slug,
  replace(p_brand || '/' || p_name, '/', '--') AS repo FROM part""")
def name_forms(t):
    issue = T.issue_name(F.concat("p_name", F.lit(": "), "p_type"))
    slug = T.slug(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")))
    return t.part.select("p_partkey", issue.alias("issue"), slug.alias("slug"), T.safe_repo(F.concat("p_brand", F.lit("/"), "p_name")).alias("repo"))


_MESSAGES = ["HTTP 429 Too Many Requests", "Connection reset by peer", "[Errno 104] reset", "read timed out", "403 Forbidden", "Broken pipe", "no such file"]


@query("""WITH m AS (SELECT event_id, lower(['HTTP 429 Too Many Requests', 'Connection reset by peer', '[Errno 104] reset', 'read timed out', '403 Forbidden', 'Broken pipe', 'no such file'][1 + event_id % 7]) AS m FROM events)
SELECT event_id, CASE WHEN contains(m, '429') THEN 'rate_limited' WHEN contains(m, 'connection reset') OR contains(m, 'connection abort') OR contains(m, 'broken pipe') OR contains(m, 'timed out') OR contains(m, 'timeout')
  OR contains(m, 'errno 104') OR contains(m, 'errno 110') OR contains(m, 'errno 32') THEN 'transient' ELSE 'fatal' END AS class FROM m""")
def error_classify(t):
    message = F.element_at(F.lit(_MESSAGES), (F.col("event_id") % 7 + 1).cast("int"))
    return t.events.select("event_id", T.error_class(message).alias("class"))
