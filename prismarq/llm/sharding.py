"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows are dealt by a hash into blocks of about ``BLOCK_ROWS``.  The number of rows
that each block sends to each shard is drawn on the driver from the multivariate
hypergeometric law, given the exact sizes of blocks and shards; it needs the
blocks' counts alone.  Every block permutes its rows and cuts them into runs of
those lengths; the shards take their runs (the exchange) and permute them again,
inside bins whose counts give each bin its first slot.  Given uniform hashes every
assignment with these shard sizes is equally likely.

The driver holds one row per block, and one per shard and bin: a ``BLOCK_ROWS``-th
of the rows.  The matrix goes back as a table, joined by block.

Shard sizes differ by one row at most (law ``rows``).  Groups of equal texts are
not kept together: one may hold a third of all rows, and no shard could take it.

All randomness comes from hashes of the row's own values and the seed, so a lost
executor's work comes out the same when it is done again.  Equal rows are told
apart by nothing, so which of them goes where is of no consequence; rows that
are equal in every column share a block, copies under other ids do not.

Defined cases: null ids and texts are values like others; an empty table gives an
empty result; fewer rows than shards leave shards empty; input columns pass
through, and ones named ``shard``, ``slot`` or ``law`` are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prismarq.llm.common import fresh, small

SHARDS = 24
#: Rows of a block, and of a slot bin inside a shard, about; the fewest blocks, and bins of a shard.
BLOCK_ROWS, MIN_BLOCKS, MIN_BINS = 100_000, 512, 32
SEED = 8
#: Populations from this size on are beyond numpy's draws.
_NUMPY_LIMIT = 1_000_000_000


def communication_matrix(blocks: np.ndarray, shards: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Rows that each block sends to each shard: uniform among all tables with these margins, by their number of arrangements."""
    rng = np.random.default_rng(seed)
    left = np.array(shards, dtype=np.int64)
    out = np.zeros((len(blocks), len(left)), dtype=np.int64)
    for i, n in enumerate(blocks):
        room = int(left.sum())
        for j in range(len(left)):  # one hypergeometric draw at a time: no bound on the margins
            if n == 0:
                break
            room -= int(left[j])
            out[i, j] = hypergeometric(rng, int(left[j]), room, int(n))
            n -= out[i, j]
        left -= out[i]
    return out


def hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    """One hypergeometric draw for populations of any size."""
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    if max(good, bad) < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    return _ratio_of_uniforms(rng, good, bad, draws)


def _log_factorial_ratio(a: int, b: int) -> float:
    """log(a! / b!) for nearby a and b, without the cancellation of two large logarithms."""
    if min(a, b) < 64:
        return math.lgamma(a + 1) - math.lgamma(b + 1)
    rest = lambda n: 1 / (12 * n) - 1 / (360 * n**3) + 1 / (1260 * n**5)
    return (b + 0.5) * math.log1p((a - b) / b) + (a - b) * (math.log(a) - 1) + rest(a) - rest(b)


def _ratio_of_uniforms(rng, good: int, bad: int, draws: int) -> int:
    """Rejection from a ratio of uniforms around the mode: the law itself, to the precision of doubles."""
    if 2 * draws > good + bad:  # what is left behind is the smaller sample
        return good - _ratio_of_uniforms(rng, good, bad, good + bad - draws)
    if good > bad:
        return draws - _ratio_of_uniforms(rng, bad, good, draws)
    total = good + bad
    mean = draws * (good / total)
    deviation = math.sqrt(max(0.0, mean * (bad / total) * ((total - draws) / (total - 1))) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * deviation + 3 - 2 * math.sqrt(3 / math.e)
    mode = (draws + 1) * (good + 1) // (total + 2)
    while True:
        u, v = 1 - rng.random(), rng.random()
        x = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if 0 <= x <= min(good, draws):
            log_p = sum(_log_factorial_ratio(m, y) for m, y in ((mode, x), (good - mode, good - x), (draws - mode, draws - x), (bad - draws + mode, bad - draws + x)))
            if 2 * math.log(u) <= log_p:
                return x


def shard_sizes(n: int, shards: int) -> np.ndarray:
    return np.array([n // shards + (i < n % shards) for i in range(shards)], dtype=np.int64)


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, blocks: int | None = None, bins: int | None = None, seed: int = SEED, keys: list[str] | None = None) -> DataFrame:
    """``df`` with ``law``, ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    ``keys``: columns that the hashes read (all of an orderable or plain type by default).
    """
    df = df.drop("law", "shard", "slot")
    n = df.count()
    blocks = blocks or max(MIN_BLOCKS, -(-n // BLOCK_ROWS))
    bins = bins or max(MIN_BINS, -(-n // (shards * BLOCK_ROWS)))
    keys = keys or [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    names = fresh(df, "block", "order", "place", "bin", "again", "b", "ends", "s", "begin")
    block, order, place, bin_, again, b, ends, s, begin = names
    key = [F.col(f"`{c}`") for c in keys]
    hashed = df.withColumn(order, F.xxhash64(F.lit(seed), *key)).withColumn(again, F.xxhash64(F.lit(seed + 1), *key))
    hashed = hashed.withColumn(block, F.pmod(F.xxhash64(F.col(order), F.lit(seed + 2)), F.lit(blocks)).cast("int"))
    counts = sorted(hashed.groupBy(block).count().collect())  # at most ``blocks`` rows
    matrix = communication_matrix(np.array([r[1] for r in counts], dtype=np.int64), shard_sizes(sum(r[1] for r in counts), shards), seed)
    table = [(r[0], row) for r, row in zip(counts, np.cumsum(matrix, axis=1).tolist(), strict=True)]
    matrix = df.sparkSession.createDataFrame(table, f"{b} int, {ends} array<bigint>")
    permuted = hashed.withColumn(place, F.row_number().over(Window.partitionBy(block).orderBy(order, again)) - 1)
    sent = permuted.join(small(matrix), F.col(block) == F.col(b))
    sent = sent.withColumn("shard", F.size(F.filter(ends, lambda e: e <= F.col(place))).cast("int")).drop(b, ends)
    sent = sent.withColumn(bin_, F.pmod(F.xxhash64(F.col(again), F.col(place)), F.lit(bins)).cast("int"))
    # The bins' counts per block follow from the rows alone; at most shards * bins rows reach the driver.
    held = sorted(sent.groupBy("shard", bin_).count().collect())
    starts, upto = [], {}
    for shard, number, rows in held:
        starts.append((shard, number, upto.get(shard, 0)))
        upto[shard] = upto.get(shard, 0) + rows
    first = df.sparkSession.createDataFrame(starts, f"{s} int, {b} int, {begin} bigint")
    within = Window.partitionBy("shard", bin_).orderBy(again, place, block)
    placed = sent.withColumn("slot", F.row_number().over(within).cast("long"))
    placed = placed.join(small(first), (F.col("shard") == F.col(s)) & (F.col(bin_) == F.col(b)))
    out = placed.withColumn("slot", F.col(begin) + F.col("slot") - 1)
    return out.withColumn("law", F.lit("rows")).drop(*names)


def op8_hypergeometric_shards(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = shuffle_into_shards(docs)
    return out.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
