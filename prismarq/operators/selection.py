"""Exact percentiles of keys of any size: ranks from sorted ranges, never a key's values in one task's memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismarq.operators.positional import with_position
from prismarq.sources.shared import small, write_table


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], out: str = "q", ranges: int | None = None) -> DataFrame:
    """(keys, n, out): the percentiles ``shares`` (0 to 1) of each key's values, interpolated between neighbours.

    Values are sorted by key in ranges, in which equal ones are spread, and written once; counts per key and range turn places
    into ranks, and only the rows at the two ranks around each percentile are fetched.  Nulls do not count; a
    key without values has none.
    """
    lean = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(value).cast("double").alias("v")).where("v is not null")
    lean = lean.withColumn("tie", F.monotonically_increasing_id())  # equal values are alike; this deals them to several ranges
    names = [f"k{i}" for i in range(len(keys))]
    ranked = with_position(lean, *names, "v", "tie", ranges=ranges)
    first = ranked.groupBy(*names).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    first = write_table(first)
    places = [F.struct(F.lit(i).alias("i"), (F.lit(float(s)) * (F.col("n") - 1)).alias("h")) for i, s in enumerate(shares)]
    asked = first.select(*names, "n", "first", F.inline(F.array(*places)))
    low, high = F.floor("h"), F.ceil("h")
    ends = asked.select(*names, "n", "i", F.explode(F.array(F.struct((F.col("first") + low).alias("pos"), (1 - (F.col("h") - low)).alias("w")), F.struct((F.col("first") + high).alias("pos"), (F.col("h") - low).alias("w")))).alias("e"))
    ends = write_table(ends.select(*names, "n", "i", "e.pos", "e.w").where("w > 0"))
    found = ranked.select("pos", "v").join(small(ends), "pos")  # at most two rows for each key and share
    parts = found.groupBy(*names, "n", "i").agg(F.sum(F.col("v") * F.col("w")).alias("x"))
    rows = parts.groupBy(*names, "n").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias(out))
    return rows.select(*[F.col(a).alias(k) for a, k in zip(names, keys, strict=True)], "n", out)
