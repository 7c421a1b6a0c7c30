"""Queries over the test tables, one or more for each operator of the engine, with equivalent SQL.

Tables stand in for datasets of images: documents are images, labels a sparse
artifact, embeddings class and patch vectors, parts and line items sizes, boxes
and keypoints, pages paths, orders chunk rows, events a run log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prismarq.sources.shared import reach_workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The test tables of a folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name, with SQL for DuckDB if there is any."""

    def register(f: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            reach_workers(spark)
            return f(Tables(spark, folder))

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


from prismarq.plans import catalog_queries, composed_queries, dataset_queries, detection_queries, file_queries, geometry_queries, manifest_queries, stream_queries, tensor_queries, text_queries  # noqa: E402, F401
