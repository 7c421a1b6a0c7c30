import os
import sys
from pathlib import Path

import pytest

TOP = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, TOP)
os.environ["PYTHONPATH"] = f"{TOP}:{TOP}/tests:{os.environ.get('PYTHONPATH', '')}".rstrip(":")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def same_rows(got, expected) -> None:
    """Two pandas frames with equal columns and equal rows in any order; whole numbers compare by value."""
    import pandas as pd

    assert sorted(got.columns) == sorted(expected.columns)
    cols = sorted(got.columns)

    def plain(v):
        v = v.item() if hasattr(v, "item") and getattr(v, "size", 1) == 1 else v
        if v is None or v is pd.NA or isinstance(v, float) and v != v:
            return None
        return int(v) if isinstance(v, (int, float)) and v == int(v) else v

    rows = lambda df: sorted(repr(tuple(plain(v) for v in r)) for r in df[cols].itertuples(index=False))
    assert rows(got) == rows(expected)


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p if p.is_file() else p / '*.parquet'}'")
    return con
