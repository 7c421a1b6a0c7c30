"""Scans of image collections and of dataset folders."""

from __future__ import annotations

import os
import posixpath
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prismarq.functions import text as X
from prismarq.functions.geometry import nearest_bucket
from prismarq.operators.catalog import ARTIFACTS
from prismarq.sources.files import files_in, read_bytes, with_heads

METADATA = "image_id string, source_path string, width bigint, height bigint, aspect_bucket string"
_BAD = "_bad string"


def relative(path: Column, root: str) -> Column:
    """Path below ``root``, whichever way either is written as a URI; null if it lies elsewhere."""
    bare = lambda c: F.regexp_replace(c, r"^file:(//)?(?=/)", "")
    top = bare(F.lit(root.rstrip("/") + "/"))
    return F.when(F.startswith(bare(path), top), F.substr(bare(path), F.length(top) + 1))


def scan_images(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, image_id) of image files below ``root``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return files.where(X.is_image(F.col("path"))).withColumn("image_id", X.image_id(relative(F.col("path"), root)))


def scan_list(spark: SparkSession, listing: str, root: str) -> DataFrame:
    """(path, image_id) of a text file's lines, in order of path: trimmed, blank ones dropped, relative ones taken below ``root``.

    ``.``, ``..`` and links are resolved by the tasks, as are those of ``root``; on other file systems than the local one there are no links.
    Lines are neither filtered nor made distinct.
    """
    lines = spark.read.text(listing).select(X.strip(F.col("value")).alias("line")).where("line <> ''")
    path = F.when(F.col("line").rlike("^(/|[A-Za-z][A-Za-z0-9+.-]*:/)"), F.col("line")).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), F.col("line")))

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([resolved(p) for p in batch.column(0).to_pylist()], pa.string())], ["path"])

    rows = lines.select(path.alias("path")).mapInArrow(resolve, "path string")
    return rows.withColumn("image_id", X.image_id(relative(F.col("path"), resolved(root)))).orderBy(X.components(F.col("path")))


def resolved(path: str) -> str:
    """A path without ``.``, ``..`` and, where it is local, links; a URI keeps its scheme and host."""
    scheme, host, bare = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(?=/))?(.*)", path, re.DOTALL).groups()
    if scheme is None or scheme == "file":
        return os.path.realpath(bare)
    return f"{scheme}://{host or ''}{posixpath.normpath(bare)}"


# --- headers ----------------------------------------------------------------------------

#: Bytes of a file that are enough for the size of PNG, GIF, BMP and WebP, and for most JPEGs; other files are parsed whole.
HEADER_BYTES = 65_536


def image_size(content: bytes | None) -> tuple[int, int] | None:
    """(width, height) from an image file's first bytes; None if it is no known image."""
    b = content or b""
    if b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
        return int.from_bytes(b[16:20]), int.from_bytes(b[20:24])
    if b[:6] in (b"GIF87a", b"GIF89a") and len(b) >= 10:
        return int.from_bytes(b[6:8], "little"), int.from_bytes(b[8:10], "little")
    if b[:2] == b"BM" and len(b) >= 26:
        return int.from_bytes(b[18:22], "little", signed=True), abs(int.from_bytes(b[22:26], "little", signed=True))
    if b[:4] == b"RIFF" and b[8:12] == b"WEBP" and len(b) >= 30:
        if b[12:16] == b"VP8X":
            return 1 + int.from_bytes(b[24:27], "little"), 1 + int.from_bytes(b[27:30], "little")
        if b[12:16] == b"VP8L":
            bits = int.from_bytes(b[21:25], "little")
            return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
        return int.from_bytes(b[26:28], "little") & 0x3FFF, int.from_bytes(b[28:30], "little") & 0x3FFF
    if b[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(b) and b[at] == 0xFF:
            if 0xC0 <= b[at + 1] <= 0xCF and b[at + 1] not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(b[at + 7 : at + 9]), int.from_bytes(b[at + 5 : at + 7])
            at += 2 + int.from_bytes(b[at + 2 : at + 4])
    if b[:4] in (b"II*\x00", b"MM\x00*"):
        order = "little" if b[:2] == b"II" else "big"
        at, found = int.from_bytes(b[4:8], order), {}
        n = int.from_bytes(b[at : at + 2], order)
        for i in range(n if at + 2 + 12 * n <= len(b) else 0):  # a directory that is cut off tells nothing
            e = b[at + 2 + 12 * i : at + 14 + 12 * i]
            size = 2 if int.from_bytes(e[2:4], order) == 3 else 4
            found[int.from_bytes(e[:2], order)] = int.from_bytes(e[8 : 8 + size], order)
        if 256 in found and 257 in found:
            return found[256], found[257]
    return None


def with_size(images: DataFrame) -> DataFrame:
    """``images`` (path, ...) with width and height; null where the file cannot be read.

    Tasks fetch the first bytes of each file, and the whole of those whose first bytes do not tell.
    """

    def size(path: str, head: bytes | None) -> tuple[int | None, int | None]:
        found = image_size(head)
        if found is None and head is not None and len(head) == HEADER_BYTES:
            try:
                found = image_size(read_bytes(path))
            except OSError:
                found = None
        return found or (None, None)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [size(*x) for x in zip(batch.column("path").to_pylist(), batch.column("head").to_pylist(), strict=True)]
            batch = batch.drop_columns(["head"])
            for i, name in enumerate(("width", "height")):
                batch = batch.append_column(name, pa.array([x[i] for x in found], pa.int64()))
            yield batch

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in images.schema.fields)
    return with_heads(images, HEADER_BYTES).mapInArrow(sizes, f"{kinds}, width long, height long")


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, image_id, content) of image files, for work that takes whole files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "content")
    return files.where(X.is_image(F.col("path"))).withColumn("image_id", X.image_id(relative(F.col("path"), root)))


# --- dataset folders --------------------------------------------------------------------


def scan_metadata(spark: SparkSession, dataset: str) -> DataFrame:
    """(dir, rel, ok, METADATA...) of every metadata.json; a broken file is a row with ``ok`` false."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "metadata.json").load(dataset)
    parsed = F.from_json(F.decode("content", "UTF-8"), f"{METADATA}, {_BAD}", {"columnNameOfCorruptRecord": "_bad"})
    rows = files.select(X.parent_dir(F.col("path")).alias("dir"), X.parent_dir(relative(F.col("path"), dataset)).alias("rel"), parsed.alias("m"))
    ok = F.col("m").isNotNull() & F.col("m._bad").isNull() & F.coalesce(F.col("m.image_id"), F.col("m.source_path"), F.col("m.aspect_bucket"), F.col("m.width").cast("string")).isNotNull()
    return rows.select("dir", "rel", ok.alias("ok"), *[F.col(f"m.{c.split()[0]}").alias(c.split()[0]) for c in METADATA.split(", ")])


def ensure_metadata(images: DataFrame, metadata: DataFrame) -> DataFrame:
    """METADATA of ``images`` (image_id, path, width, height): what is on disk and readable, else computed anew; ``made`` marks the latter."""
    held = metadata.where("ok").select("rel", *[F.col(c.split()[0]).alias(f"old_{c.split()[0]}") for c in METADATA.split(", ")])
    rows = images.join(held, F.col("image_id") == F.col("rel"), "left").where(F.col("rel").isNotNull() | F.col("width").isNotNull())
    fresh = {"image_id": F.col("image_id"), "source_path": F.col("path"), "width": F.col("width"), "height": F.col("height"), "aspect_bucket": nearest_bucket(F.col("width"), F.col("height"))}
    return rows.select(*[F.when(F.col("rel").isNotNull(), F.col(f"old_{k}")).otherwise(v).alias(k) for k, v in fresh.items()], F.col("rel").isNull().alias("made"))


def scan_artifacts(spark: SparkSession, dataset: str) -> DataFrame:
    """(image_id, artifact, path, length) of every artifact file, by its folder and name; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(dataset).select("path", "length")
    names = spark.createDataFrame([(f, a) for a, f in ARTIFACTS.items()], "file string, artifact string")
    rows = files.select(X.parent_dir(relative(F.col("path"), dataset)).alias("image_id"), F.regexp_extract("path", "[^/]*$", 0).alias("file"), "path", "length")
    return rows.join(F.broadcast(names), "file").select("image_id", "artifact", "path", "length")


def artifacts_of(images: DataFrame, dataset: str) -> DataFrame:
    """The same of ``images`` (image_id) alone: tasks list the folder of each image, so no driver lists the dataset and no task is made of a few small files."""
    names = {f: a for a, f in ARTIFACTS.items()}

    def found(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            folders = [(i, f"{dataset.rstrip('/')}/{i}") for i in pdf["image_id"]]
            rows = [(i, names[f], f"{folder}/{f}", n) for i, folder in folders for f, n in files_in(folder).items() if f in names]
            yield pd.DataFrame(rows, columns=["image_id", "artifact", "path", "length"])

    return images.select("image_id").mapInPandas(found, "image_id string, artifact string, path string, length long")
