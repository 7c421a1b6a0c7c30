"""Scans of .npy files by header, for integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismarq.functions import text as X
from prismarq.functions.tensor import npy_header
from prismarq.operators.catalog import ARTIFACTS
from prismarq.sources.files import with_heads
from prismarq.sources.images import relative


#: Bytes that hold the header of any array the catalogue knows.
HEADER_BYTES = 1024


def scan_headers(spark: SparkSession, dataset: str) -> DataFrame:
    """(image_id, artifact, path, header, text) of .npy and caption files: header is null for a broken file, text is the caption's.

    Of an array, tasks fetch the header alone.
    """
    def scan(glob: str) -> DataFrame:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(dataset)

    arrays = with_heads(scan("*.npy").select("path"), HEADER_BYTES).select("path", npy_header(F.col("head")).alias("header"), F.lit(None).cast("string").alias("text"))
    texts = scan("*.txt").select("path", F.lit(None).cast("struct<descr:string,shape:array<int>>").alias("header"), F.decode("content", "UTF-8").alias("text"))
    names = spark.createDataFrame([(f, a) for a, f in ARTIFACTS.items()], "file string, artifact string")
    rows = arrays.unionByName(texts).withColumn("file", F.regexp_extract("path", "[^/]*$", 0)).withColumn("image_id", X.parent_dir(relative(F.col("path"), dataset)))
    return rows.join(F.broadcast(names), "file").select("image_id", "artifact", "path", "header", "text")


def read_tensors(spark: SparkSession, dataset: str, artifact: str) -> DataFrame:
    """(image_id, dtype, shape, data) of one artifact: raw bytes, as Spark has no half-precision type."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", ARTIFACTS[artifact]).load(dataset)
    rows = files.select(X.parent_dir(relative(F.col("path"), dataset)).alias("image_id"), npy_header(F.substring("content", 1, 1024)).alias("h"), "content")
    wide = F.conv(F.hex(F.substring("content", 7, 1)), 16, 10).cast("int") > 1
    size = F.conv(F.hex(F.substring("content", 9, 1)), 16, 10).cast("int") + F.conv(F.hex(F.substring("content", 10, 1)), 16, 10).cast("int") * 256
    begin = F.when(wide, 13).otherwise(11) + size
    return rows.where("h is not null").select("image_id", F.col("h.descr").alias("dtype"), F.col("h.shape").alias("shape"), F.substr("content", begin).alias("data"))
