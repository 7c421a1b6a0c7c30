"""Operators on a global order: positions, shards, pages, and size-bounded packing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.sources.shared import write_table

#: Rows per sorted range.
ROWS_PER_RANGE = 500_000
_INDEX_BITS = 33  # of the row number within a partition in monotonically_increasing_id


def with_position(df: DataFrame, *order: Column | str, name: str = "pos", ranges: int | None = None) -> DataFrame:
    """``df`` with the row number, from 0, in the given total order.

    Ranges are sorted side by side and written once; their sizes, one row each,
    become offsets.  No single task sees all rows.
    """
    ranges = ranges or max(1, min(10_000, -(-df.count() // ROWS_PER_RANGE)))
    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    done = write_table(ordered)
    part = F.shiftright("__id", _INDEX_BITS).cast("int")
    sizes = dict(done.groupBy(part.alias("p")).count().collect())
    starts, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    offset = F.element_at(F.lit(starts or [0]).cast("array<bigint>"), part + 1)
    return done.withColumn(name, offset + F.col("__id").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))).drop("__id")


def parse_shard(text: str) -> tuple[int, int]:
    """``N/M`` with 0 <= N < M; ValueError otherwise."""
    worker, slash, total = text.partition("/")
    if not slash:
        raise ValueError(f"shard must be N/M, not {text!r}")
    n, m = int(worker), int(total)
    if not 0 <= n < m:
        raise ValueError(f"shard needs 0 <= N < M, not {text!r}")
    return n, m


def shard(df: DataFrame, worker: int, total: int, *order: Column | str) -> DataFrame:
    """Every ``total``-th row from ``worker`` in the order."""
    return with_position(df, *order).where(F.col("pos") % total == worker).drop("pos")


def page(df: DataFrame, offset: int, limit: int | None, *order: Column | str) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the order, with ``pos``."""
    rows = with_position(df, *order).where(F.col("pos") >= offset)
    return rows if limit is None else rows.where(F.col("pos") < offset + limit)


def pack_by_count(df: DataFrame, most: int, position: str = "pos") -> DataFrame:
    """Group number when groups hold ``most`` rows each: no state needed."""
    return df.withColumn("grp", F.floor(F.col(position) / most).cast("bigint"))


class GreedyRange:
    """One range of the rows of a key, for greedy packing: where groups would begin, whatever comes before.

    ``jump[i]`` is where the next group begins if one begins at row ``i`` (the number of rows: in a later range).
    """

    def __init__(self, sizes: np.ndarray, most_bytes: int | None, most_rows: int | None):
        self.n, self.most_bytes, self.most_rows = len(sizes), most_bytes, most_rows
        self.total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        at = np.arange(self.n)
        stop = np.full(self.n, self.n) if most_bytes is None else np.searchsorted(self.total, self.total[:-1] + most_bytes, side="right") - 1
        if most_rows is not None:
            stop = np.minimum(stop, at + most_rows)
        self.jump = np.minimum(np.maximum(stop, at + 1), self.n)  # a row beyond the limit is a group of its own

    def joining(self) -> int:
        """The most rows that a group begun in an earlier range may take from this one."""
        rows = self.n if self.most_bytes is None else int(np.searchsorted(self.total, self.most_bytes, side="right")) - 1
        return max(0, min(rows, self.n if self.most_rows is None else self.most_rows - 1))

    def outcomes(self) -> list[tuple[int, int, int, int, int]]:
        """(rows, bytes, groups, open_bytes, open_rows): what follows if so many rows join the open group.

        ``groups`` begin in this range and the last of them stays open with ``open_bytes`` and ``open_rows``; where none
        begins, the open group grows by them.  Only numbers of rows are listed at which what follows changes: groups that
        begin at different places soon fall together, so these are few.  Found by pointer doubling over ``jump``.
        """
        n = self.n
        jump, count = np.append(self.jump, n), np.append((self.jump < n).astype(np.int64), 0)
        last = np.append(np.where(self.jump < n, self.jump, np.arange(n)), n)  # the start of the last group
        for _ in range(max(1, n.bit_length())):
            count, last, jump = count + count[jump], np.where(jump < n, last[jump], last), jump[jump]
        upto = self.joining()
        groups, start = count[: upto + 1] + (np.arange(upto + 1) < n), last[: upto + 1]
        change = np.flatnonzero(np.append(True, (np.diff(groups) != 0) | (np.diff(start) != 0)))
        begin = np.where(groups[change] > 0, start[change], 0)
        return [(int(i), int(self.total[i]), int(g), int(self.total[n] - self.total[b]), int(n - b)) for i, g, b in zip(change, groups[change], begin, strict=True)]

    def joined(self, held: int, rows: int) -> int:
        """How many rows join an open group of ``rows`` rows (0: there is none) and ``held`` bytes."""
        if rows == 0:
            return 0
        most = self.n if self.most_bytes is None else int(np.searchsorted(self.total, self.most_bytes - held, side="right")) - 1
        return max(0, most if self.most_rows is None else min(most, self.most_rows - rows))

    def numbers(self, joined: int, group: int) -> np.ndarray:
        """Group number of each row if the first ``joined`` rows belong to ``group``; one step per group."""
        out = np.full(self.n, group, dtype=np.int64)
        at = joined
        while at < self.n:
            group += 1
            out[at : self.jump[at]] = group
            at = int(self.jump[at])
        return out


def greedy_groups(sizes: np.ndarray, most_bytes: int | None, most_rows: int | None) -> np.ndarray:
    """Group number, from 0, of each row."""
    return GreedyRange(sizes, most_bytes, most_rows).numbers(0, -1)


def _chain(keys: Sequence[str], most_bytes: int | None, most_rows: int | None):
    """Compose the outcomes of a key's ranges, in order: (keys, range, held, rows, group), the open group as each range is entered.

    One open group is all that is held at a time, whatever the number of ranges.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = place = found = None
        held, rows, group, entered = 0, 0, -1, []  # bytes and rows of the open group, its number

        def leave() -> None:
            nonlocal held, rows, group
            groups, open_bytes, open_rows = found
            entered.append((*key, place, held, rows, group))
            group += groups
            held, rows = (open_bytes, open_rows) if groups else (held + open_bytes, rows + open_rows)

        for pdf in parts:
            for *own, at, n, size, groups, open_bytes, open_rows in pdf.itertuples(index=False, name=None):
                own = tuple(None if pd.isna(v) else v for v in own)
                if (own, at) != (key, place):
                    if found is not None:
                        leave()
                    if own != key:
                        key, held, rows, group = own, 0, 0, -1
                    place = at
                    found = (groups, open_bytes, open_rows)  # no row joins
                elif rows and (most_bytes is None or held + size <= most_bytes) and (most_rows is None or rows + n <= most_rows):
                    found = (groups, open_bytes, open_rows)
            yield pd.DataFrame(entered, columns=[*keys, "range", "held", "rows", "group"])
            entered = []
        if found is not None:
            leave()
            yield pd.DataFrame(entered, columns=[*keys, "range", "held", "rows", "group"])

    return run


def pack_greedy(df: DataFrame, keys: Sequence[str], position: str, size: str, most_bytes: int | None, most_rows: int | None, ranges: int | None = None) -> DataFrame:
    """(keys, position, size, grp): a new group begins when the size limit would be passed or the row limit is reached.

    Rows are sorted in ranges, so that no task sees more than a range of a key.  What a range does to any open group that may
    enter it is a short table of outcomes; the tables of a key are composed in order, and the ranges then number
    their groups side by side.
    """
    ranges = ranges or max(1, min(10_000, -(-df.count() // ROWS_PER_RANGE)))
    lean = df.select(*keys, F.col(position).cast("bigint").alias(position), F.col(size).cast("bigint").alias(size))
    kinds = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in lean.schema.fields}
    of, names = ", ".join(kinds[k] for k in keys), [*keys, "range"]
    ranged = write_table(lean.repartitionByRange(ranges, *keys, position).withColumn("range", F.spark_partition_id()))

    def tables(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf.sort_values(position, kind="stable")[size].to_numpy(dtype=np.int64)
        out = pd.DataFrame(GreedyRange(sizes, most_bytes, most_rows).outcomes(), columns=["n", "bytes", "groups", "open_bytes", "open_rows"])
        for i, k in enumerate(names):
            out.insert(i, k, [pdf[k].iloc[0]] * len(out))
        return out

    def number(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(position, kind="stable").drop(columns="range")
        own = GreedyRange(pdf[size].to_numpy(dtype=np.int64), most_bytes, most_rows)
        held, rows, group = (int(entry[c].iloc[0]) for c in ("held", "rows", "group"))
        return pdf.assign(grp=own.numbers(own.joined(held, rows), group))

    found = ranged.groupBy(*names).applyInPandas(tables, f"{of}, range int, n bigint, bytes bigint, groups bigint, open_bytes bigint, open_rows bigint")
    ordered = found.repartition(*keys).sortWithinPartitions(*keys, "range", "n")
    entered = ordered.mapInPandas(_chain(keys, most_bytes, most_rows), f"{of}, range int, held bigint, rows bigint, group bigint")
    return ranged.groupBy(*names).cogroup(write_table(entered).groupBy(*names)).applyInPandas(number, f"{', '.join(kinds.values())}, grp bigint")
