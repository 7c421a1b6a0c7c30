"""Queries that run streams to their end: changes of a dataset, and a chunk table kept up to date."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismarq.plans.catalogue import query
from prismarq.sources.files import delete, write_bytes
from prismarq.sources.shared import shared_folder
from prismarq.streaming import datasets, incremental


@query("""SELECT 'img' || s_suppkey AS image_id, CASE WHEN s_suppkey % 3 = 0 THEN 'caption' ELSE 'pose' END AS artifact, CASE WHEN s_suppkey % 3 = 0 THEN 'lost' ELSE 'made' END AS change
FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey % 5 = 0""")
def stream_changes(t):
    """Artifacts that were lost and made between two scans of a dataset, one image per supplier."""
    top, state, checkpoint, found = (shared_folder(t.spark) for _ in range(4))

    def write(parts):
        for pdf in parts:
            for k in pdf["s_suppkey"]:
                write_bytes(f"{top}/img{k}/metadata.json", b"{}")
                write_bytes(f"{top}/img{k}/caption.txt", b"x")
            yield pdf

    def change(parts):
        for pdf in parts:
            for k in pdf["s_suppkey"]:
                if k % 3 == 0:
                    delete(f"{top}/img{k}/caption.txt")
                elif k % 5 == 0:
                    write_bytes(f"{top}/img{k}/pose.npy", b"x")
            yield pdf

    keys = t.supplier.select("s_suppkey")
    stream = datasets.changes(t.spark, top, state, 8)
    keys.mapInPandas(write, "s_suppkey bigint").count()
    datasets.process_changes(stream, lambda batch, n: None, checkpoint).awaitTermination()
    keys.mapInPandas(change, "s_suppkey bigint").count()
    datasets.process_changes(stream, lambda batch, n: batch.write.mode("overwrite").parquet(found), checkpoint).awaitTermination()
    return t.spark.read.schema(datasets.CHANGES).parquet(found)


@query("""SELECT o_orderpriority AS layer, o_orderkey AS start, o_orderkey + 9 AS "end", printf('%05d-%05d', o_orderkey, o_orderkey + 9) AS label, o_custkey AS n FROM orders""")
def stream_chunks(t):
    """Chunk rows that arrive as files, merged into the newest version of a table, batch by batch."""
    table, checkpoint, arrived = (shared_folder(t.spark) for _ in range(3))
    key = F.col("o_orderkey")
    rows = t.orders.select(F.col("o_orderpriority").alias("layer"), key.alias("start"), (key + 9).alias("end"), F.format_string("%05d-%05d", key, key + 9).alias("label"), F.col("o_custkey").cast("long").alias("n"))
    rows.repartition(3, "start").write.parquet(arrived)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(arrived)
    incremental.process_new(stream, incremental.upsert_chunks(table), checkpoint).awaitTermination()
    return incremental.current_chunks(t.spark, table).select("layer", "start", "end", "label", "n")
