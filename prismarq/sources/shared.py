"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that may be broadcast: tables are counted against this before they are.
BROADCAST_ROWS = 200_000
#: Bytes, as JSON, that columns of varying width may have then; tables of few rows are not measured.
BROADCAST_BYTES, FEW_ROWS = 64 << 20, 1000


_MADE: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder path below the one that the cluster names in ``spark.checkpoint.dir``.

    Where that is unset and there is one machine (tests), a temporary folder takes its place.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = getattr(shared_folder, "own", None)
        if top is None:
            top = shared_folder.own = tempfile.mkdtemp(prefix="prismarq-")
    _MADE.append(f"{top.rstrip('/')}/{uuid.uuid4().hex}")
    return _MADE[-1]


def clean(spark: SparkSession) -> int:
    """Delete the folders that this process has made, when no DataFrame that reads them is needed any more; how many were there."""
    found = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        found += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return found


def write_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, per_task: int, *by: str) -> DataFrame:
    """``rows`` in tasks of about ``per_task`` each, by a hash of ``by``, for work whose cost lies in Python and not in the bytes of a file.

    A file of few bytes, or of one row group, is one task however many rows it has.
    """
    return rows.repartition(max(1, -(-rows.count() // per_task)), *by)


def small(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast only if it has at most ``limit`` rows, and its columns of varying width ``most_bytes``; give a written table."""
    rows = df.count()
    if rows > limit:
        return df
    wide = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct", "string", "binary")]
    if wide and rows > FEW_ROWS:
        size = sum((F.sum(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`"))))) for c in wide), F.lit(0))
        if (df.select(size.alias("n")).first()["n"] or 0) > most_bytes:
            return df
    return F.broadcast(df)


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where only the driver's path names it (one machine)."""
    from pathlib import Path

    top = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if top not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{top}:{known}".rstrip(":")
