"""Queries on presence, completeness, positions, packing and import."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismarq.operators import catalog as C
from prismarq.operators import importer, positional as P
from prismarq.plans.catalogue import query


def _images(t):
    return t.documents.select(F.col("doc_id").alias("image_id"))


def _artifacts(t):
    """Artifacts of documents: captions of those with text, masks of labelled ones, poses of good ones, parts of the dino pair by id."""
    d, lab = t.documents, t.labels
    row = lambda df, name: df.select(F.col("doc_id").alias("image_id"), F.lit(name).alias("artifact"))
    out = row(d.where("length(text) > 0"), "caption").unionByName(row(d, "metadata"))
    out = out.unionByName(row(lab, "seg")).unionByName(row(lab.where("quality = 1"), "pose"))
    return out.unionByName(row(d.where("doc_id % 3 = 0"), "dinov3_cls")).unionByName(row(d.where("doc_id % 6 = 0"), "dinov3_patches"))


_ARTIFACTS = """images AS (SELECT doc_id AS image_id FROM documents),
artifacts AS (SELECT doc_id AS image_id, 'caption' AS artifact FROM documents WHERE length(text) > 0 UNION ALL SELECT doc_id, 'metadata' FROM documents
  UNION ALL SELECT doc_id, 'seg' FROM labels UNION ALL SELECT doc_id, 'pose' FROM labels WHERE quality = 1
  UNION ALL SELECT doc_id, 'dinov3_cls' FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'dinov3_patches' FROM documents WHERE doc_id % 6 = 0)"""
_NAMES = ["caption", "depth", "dinov3_cls", "dinov3_patches", "metadata", "pose", "seg"]
_VALUES = ", ".join(f"('{n}')" for n in _NAMES)


@query(f"""WITH {_ARTIFACTS} SELECT w.artifact, count(DISTINCT a.image_id) AS n, (SELECT count(*) FROM images) AS total, round(100.0::DOUBLE * count(DISTINCT a.image_id) / (SELECT count(*) FROM images), 1) AS pct
FROM (VALUES {_VALUES}) w(artifact) LEFT JOIN artifacts a ON a.artifact = w.artifact GROUP BY w.artifact""")
def status_completeness(t):
    return C.status(_images(t), _artifacts(t), _NAMES)


@query(f"""WITH {_ARTIFACTS} SELECT i.image_id, {", ".join(f"coalesce(bool_or(artifact = '{n}'), false) AS {n}" for n in _NAMES)} FROM images i LEFT JOIN artifacts a ON i.image_id = a.image_id GROUP BY i.image_id""")
def artifact_presence(t):
    return C.presence(_images(t), _artifacts(t), _NAMES)


@query(f"WITH {_ARTIFACTS} SELECT image_id FROM images WHERE image_id NOT IN (SELECT image_id FROM artifacts WHERE artifact IN ('dinov3_cls', 'dinov3_patches') GROUP BY image_id HAVING count(DISTINCT artifact) = 2)")
def pending_work(t):
    return C.pending(_images(t), _artifacts(t), C.MAKES["dinov3"])


@query(f"WITH {_ARTIFACTS} SELECT image_id FROM images WHERE image_id IN (SELECT image_id FROM artifacts WHERE artifact = 'seg')")
def dependency_ready(t):
    return C.ready(_images(t), _artifacts(t), C.NEEDS["depth"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orders_without_lines(t):
    return t.orders.select("o_orderkey", "o_custkey").join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 3)")
def layer_complete(t):
    parts = t.lineitem.select(F.col("l_orderkey").alias("image_id"), F.col("l_returnflag").alias("artifact"))
    done = C.complete(parts, ["A", "N", "R"]).withColumnRenamed("image_id", "o_orderkey")
    return t.orders.select("o_orderkey").join(done, "o_orderkey", "left_semi")


@query("""SELECT layer, l_orderkey AS image_id, CAST(sum(l_partkey) AS BIGINT) AS bytes FROM (SELECT l_orderkey, l_partkey, l_returnflag, CASE l_returnflag WHEN 'N' THEN 'seg' ELSE 'dinov3' END AS layer FROM lineitem)
GROUP BY layer, l_orderkey HAVING count(DISTINCT l_returnflag) = CASE layer WHEN 'seg' THEN 1 ELSE 2 END""")
def layer_sizes(t):
    names = F.when(F.col("l_returnflag") == "N", "seg").when(F.col("l_returnflag") == "A", "dinov3_cls").otherwise("dinov3_patches")
    files = t.lineitem.select(F.col("l_orderkey").alias("image_id"), names.alias("artifact"), F.col("l_partkey").alias("length"))
    return C.layer_bytes(files, {k: C.LAYERS[k] for k in ("seg", "dinov3")})


@query("""SELECT image_id, count(*) AS n, array_to_string(list_sort(list_distinct(list(path))), ',') AS paths FROM (SELECT doc_id // 2 AS image_id, (doc_id // 2) || CASE WHEN doc_id % 2 = 0 THEN '.png' ELSE '.jpg' END AS path FROM documents) GROUP BY image_id HAVING count(*) > 1""")
def shared_image_ids(t):
    half = F.floor(F.col("doc_id") / 2)
    rows = t.documents.select(half.alias("image_id"), F.concat(half.cast("string"), F.when(F.col("doc_id") % 2 == 0, ".png").otherwise(".jpg")).alias("path"))
    return C.shared_ids(rows).withColumn("paths", F.array_join("paths", ","))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 7 AS shard FROM documents")
def shard_assign(t):
    return P.with_position(t.documents.select("doc_id"), "doc_id").select("doc_id", (F.col("pos") % 7).alias("shard"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents) WHERE pos % 4 = 2")
def shard_one(t):
    return P.shard(t.documents.select("doc_id"), *P.parse_shard("2/4"), "doc_id")


@query("SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents ORDER BY doc_id LIMIT 250 OFFSET 100")
def publish_page(t):
    return P.page(t.documents.select("doc_id", "source"), 100, 250, "doc_id")


@query("SELECT doc_id, pos // 300 AS grp FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)")
def tar_split_count(t):
    return P.pack_by_count(P.with_position(t.documents.select("doc_id"), "doc_id"), 300).select("doc_id", "grp")


@query("""WITH RECURSIVE r AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
f AS (SELECT source, doc_id, n_chars, rn, 0::BIGINT AS grp, n_chars AS bytes, 1::BIGINT AS n FROM r WHERE rn = 1
  UNION ALL SELECT r.source, r.doc_id, r.n_chars, r.rn, CASE WHEN f.bytes + r.n_chars > 9000 OR f.n >= 5 THEN f.grp + 1 ELSE f.grp END,
    CASE WHEN f.bytes + r.n_chars > 9000 OR f.n >= 5 THEN r.n_chars ELSE f.bytes + r.n_chars END, CASE WHEN f.bytes + r.n_chars > 9000 OR f.n >= 5 THEN 1 ELSE f.n + 1 END
    FROM f JOIN r ON f.source = r.source AND r.rn = f.rn + 1)
SELECT source, doc_id, n_chars, grp FROM f""")
def tar_split_greedy(t):
    return P.pack_greedy(t.documents, ["source"], "doc_id", "n_chars", 9000, 5)


@query("""WITH p AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents)
SELECT source, pos // 20 AS grp, count(*) AS n, printf('%05d-%05d', min(pos), max(pos)) AS label FROM p GROUP BY source, pos // 20""")
def chunk_labels(t):
    from pyspark.sql import Window

    from prismarq.functions.text import range_label

    pos = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    rows = P.pack_by_count(t.documents.select("source", pos.alias("pos")), 20)
    return rows.groupBy("source", "grp").agg(F.count(F.lit(1)).alias("n"), range_label(F.min("pos"), F.max("pos")).alias("label"))


@query("""SELECT d.doc_id AS image_id, coalesce(quality, 0) AS width, coalesce(toxic, 0) AS height, coalesce(d.lang, '') AS aspect_bucket, coalesce(CASE WHEN l.doc_id IS NOT NULL THEN trim(d.text, ' ' || chr(9) || chr(10) || chr(13)) END, '') AS caption
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def data_export(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    caption = F.when(F.col("quality").isNotNull(), F.regexp_replace("text", r"^[ \t\n\r]+|[ \t\n\r]+\z", ""))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return rows.select(F.col("doc_id").alias("image_id"), zero("quality").alias("width"), zero("toxic").alias("height"), F.coalesce("lang", F.lit("")).alias("aspect_bucket"), F.coalesce(caption, F.lit("")).alias("caption"))


_JSONL = """lines AS (SELECT event_id AS line, CASE event_id % 5 WHEN 0 THEN '{"image_id": "u' || user_id || '", "width": ' || event_id || '}' WHEN 1 THEN '{"image_path": "a/b/u' || user_id || '.v1.png"}' WHEN 2 THEN 'not json' WHEN 3 THEN '' ELSE '{"caption": "no id"}' END AS value FROM events),
parsed AS (SELECT line, value, CASE WHEN json_valid(value) THEN value END AS j FROM lines WHERE trim(value) <> ''),
named AS (SELECT line, j IS NULL AS broken, coalesce(nullif(j ->> '$.image_id', ''), nullif(regexp_replace(regexp_extract(j ->> '$.image_path', '[^/]*$'), '(.)\\.[^.]+$', '\\1'), '')) AS image_id, CAST(j ->> '$.width' AS BIGINT) AS width FROM parsed)"""


def _lines(t):
    k, u = F.col("event_id") % 5, F.col("user_id").cast("string")
    value = (
        F.when(k == 0, F.concat(F.lit('{"image_id": "u'), u, F.lit('", "width": '), F.col("event_id").cast("string"), F.lit("}")))
        .when(k == 1, F.concat(F.lit('{"image_path": "a/b/u'), u, F.lit('.v1.png"}'))).when(k == 2, "not json").when(k == 3, "").otherwise('{"caption": "no id"}')
    )
    return t.events.select(F.col("event_id").alias("line"), value.alias("value"))


@query(f"WITH {_JSONL} SELECT image_id, line, width FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY line) AS rn FROM named WHERE image_id IS NOT NULL) WHERE rn = 1".replace("\\\\", "\\"))
def jsonl_import(t):
    return importer.first_records(importer.parse_lines(_lines(t))).select("image_id", "line", "width")


@query(f"""WITH {_JSONL} SELECT count(*) AS lines, count(DISTINCT image_id) AS migrated, CAST(sum(CASE WHEN image_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS errors,
count(image_id) - count(DISTINCT image_id) AS skipped FROM named""".replace("\\\\", "\\"))
def import_counters(t):
    return importer.counters(importer.parse_lines(_lines(t)))


@query("""SELECT event_type, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM events), 1) AS pct FROM events GROUP BY event_type""")
def run_counters(t):
    total = t.events.agg(F.count(F.lit(1)).alias("total"))
    counts = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(total)).select("event_type", "n", F.round(100.0 * F.col("n") / F.col("total"), 1).alias("pct"))


@query("""WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents), b AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings)
SELECT a.pos, doc_id, vec_id, doc_id = vec_id AS same_key FROM a JOIN b ON a.pos = b.pos""")
def shard_zip(t):
    """Two modalities joined by position, with their keys compared rather than trusted."""
    a = P.with_position(t.documents.select("doc_id"), "doc_id")
    b = P.with_position(t.embeddings.select("vec_id"), "vec_id")
    return a.join(b, "pos").select("pos", "doc_id", "vec_id", (F.col("doc_id") == F.col("vec_id")).alias("same_key"))
