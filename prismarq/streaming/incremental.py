"""Incremental work with Structured Streaming: new files once each, chunk tables kept up to date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from prismarq.functions import text as X
from prismarq.operators import manifest as M
from prismarq.sources.images import relative

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def new_images(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of (path, length, image_id) of image files; ``files_per_batch`` bounds what is in flight."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).load(root)
    rows = files.select("path", "length").where(X.is_image(F.col("path")))
    return rows.withColumn("image_id", X.image_id(relative(F.col("path"), root)))


def process_new(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Give what is new since the checkpoint to ``work`` batch by batch, then stop. ``work`` must bear being given a batch twice."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_chunks(table: str) -> Callable[[DataFrame, int], None]:
    """A batch function that merges chunk rows into versions of a Parquet table: ``<table>/v=<batch>``.

    A batch that comes again writes the same version again.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = current_chunks(spark, table, before=number)
        new = batch.select("layer", "start", "end", "label", "n").dropDuplicates(["layer", "label"])
        M.merge(old, new).write.mode("overwrite").parquet(f"{table}/v={number}")

    return run


def current_chunks(spark: SparkSession, table: str, before: int | None = None) -> DataFrame:
    """The newest version of a chunk table (older than ``before``); empty if there is none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    done = [int(n[2:]) for n in names if n.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{table}/{n}/_SUCCESS"))]
    done = [v for v in done if before is None or v < before]
    return spark.read.schema(M.CHUNKS).parquet(f"{table}/v={max(done)}") if done else spark.createDataFrame([], M.CHUNKS)
