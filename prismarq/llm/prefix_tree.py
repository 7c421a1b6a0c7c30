"""Prefix trees of conversations, encoded by preorder intervals.

Every distinct sequence of first turns is a node.  Nodes are ranked in preorder
(siblings by the SHA-256 of their turn), each node keeps the position where its
subtree ends, and whatever is summed over a subtree (leaves, saved bytes) is a
difference of two prefix sums over that order.

No row ever holds a conversation: a turn is one row with the digest of its role
and text; running values along a conversation are taken in blocks of ``BLOCK``
turns and then over the blocks; prefix sums come from sorted ranges and one row of
sums per range.  A node is known by two salted 64-bit hashes of its turns; that
nodes of equal hashes have equal parents and equal turns is verified, and the
tree is built again with another salt if one does not.

How preorder is found: a node of ``n`` members takes ``n`` places in the sequence
of members.  A child begins behind its parent's place, the members that end at
the parent, and the members of earlier siblings; the places of a node are
thus a sum along its path, and nodes sorted by (first place, depth) are in preorder.

Defined cases: rows without a conversation id belong to none and are left out;
null turns come first; turns of one number follow each other by role, then by the
digest of role and text; equal rows are turns one after the other; null roles and
texts are empty; a table without conversations has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prismarq.llm.common import write_table

#: Turns of a conversation whose running values one window takes.
BLOCK = 1024
#: Rows of a sorted range, and the most ranges.
RANGE_ROWS, MOST_RANGES = 500_000, 10_000


def prefix_sums(df: DataFrame, order: list[Column | str], **sums: str) -> DataFrame:
    """``df`` with, for each ``new=column`` of longs, the sum of the column over all earlier rows of a total order.

    Ranges are sorted and summed side by side; one row of sums per range gives the offsets.
    """
    ranges = max(1, min(MOST_RANGES, -(-df.count() // RANGE_ROWS)))
    names, kinds = list(sums), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = dict.fromkeys(names, 0)
        for batch in batches:
            for name in names:
                own = batch.column(sums[name]).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.cumsum(own)
                batch = batch.append_column(name, pa.array(before[name] + upto - own))
                before[name] += int(upto[-1]) if len(own) else 0
            yield batch.append_column("__range", pa.array(np.full(len(batch), TaskContext.get().partitionId(), dtype=np.int32)))

    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    done = write_table(ordered.mapInArrow(run, f"{kinds}, {', '.join(f'`{n}` bigint' for n in names)}, `__range` int"))
    totals = {r["__range"]: r for r in done.groupBy("__range").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).collect()}  # one row per range
    offsets = {n: [0] for n in names}
    for k in range(max(totals, default=-1)):
        for n in names:
            offsets[n].append(offsets[n][-1] + (totals[k][n] if k in totals else 0))
    at = F.col("__range") + 1
    return done.withColumns({n: F.col(n) + F.element_at(F.lit(offsets[n]).cast("array<bigint>"), at) for n in names}).drop("__range")


def running(df: DataFrame, by: str, depth: str, combine, **columns: str) -> DataFrame:
    """``df`` with, for each ``new=column``, the column combined from the first row of ``by`` up to this one in the order of ``depth`` (dense, from 1)."""
    df = df.withColumn("__block", F.floor((F.col(depth) - 1) / BLOCK))
    inside = Window.partitionBy(by, "__block").orderBy(depth).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = df.groupBy(by, "__block").agg(*[combine(c).alias(f"__{n}") for n, c in columns.items()])
    carried = blocks.select(by, "__block", *[combine(f"__{n}").over(before).alias(f"__{n}") for n in columns]).where("__block > 0")
    out = df.withColumns({n: combine(c).over(inside) for n, c in columns.items()}).join(carried, [by, "__block"], "left")
    merged = {n: F.when(F.col(f"__{n}").isNull(), F.col(n)).otherwise(F.col(n).bitwiseXOR(F.col(f"__{n}")) if combine is F.bit_xor else F.col(n) + F.col(f"__{n}")) for n in columns}
    return out.withColumns(merged).drop("__block", *[f"__{n}" for n in columns])


def rows_of_turns(conversations: DataFrame) -> DataFrame:
    """(conv, p, symbol, bytes): each turn's place in its conversation, from 1, the digest of its role and text, and its text's bytes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    symbol = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    lean = write_table(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), symbol.alias("symbol"), F.octet_length(text).cast("long").alias("bytes"), F.lit(1).cast("long").alias("one")))
    placed = prefix_sums(lean, ["conv", F.col("turn").asc_nulls_first(), "role", "symbol"], at="one")
    first = placed.groupBy("conv").agg(F.min("at").alias("first"))
    return placed.join(first, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("p"), "symbol", "bytes")


def rebuild(turns: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of the first one of their family.

    Conversation c takes the first ``h = crc32(c) % heads`` turns of conversation ``c - c % family``, then its own turns behind its first
    ``h``.  Returns the turns (conv, d, symbol, bytes), d from 1, and (conv, n_turns) of all conversations, turnless ones included.
    """
    convs = turns.groupBy("conv").agg(F.count("*").alias("own"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("long")
    convs = convs.select("conv", "own", (F.col("conv") - F.col("conv") % family).alias("base"), h.alias("h"))
    convs = write_table(convs.join(convs.select(F.col("conv").alias("base"), F.col("own").alias("base_own")), "base", "left"))
    convs = convs.select("conv", "base", "h", F.least("h", F.coalesce("base_own", F.lit(0))).alias("taken"), "own")
    own = turns.join(convs.select("conv", "h", "taken"), "conv").where("p > h").select("conv", (F.col("p") - F.col("h") + F.col("taken")).alias("d"), "symbol", "bytes")
    begun = turns.where((F.col("conv") % family == 0) & (F.col("p") < heads)).withColumnRenamed("conv", "base")
    begun = begun.join(convs.select("conv", "base", "h"), "base").where("p <= h").select("conv", F.col("p").alias("d"), "symbol", "bytes")
    sizes = convs.select("conv", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("n_turns"))
    return own.unionByName(begun), sizes


def _keyed(turns: DataFrame, salt: int) -> DataFrame:
    """Turns with the hashes of their node (k1, k2) and of its parent (q1, q2); the root's are 0."""
    own = {"f1": F.xxhash64(F.lit(salt), "d", "symbol"), "f2": F.xxhash64("symbol", "d", F.lit(salt + 1))}
    keyed = running(turns.withColumns(own), "conv", "d", F.bit_xor, k1="f1", k2="f2")
    return keyed.select("conv", "d", "symbol", "bytes", "k1", "k2", F.col("k1").bitwiseXOR(F.col("f1")).alias("q1"), F.col("k2").bitwiseXOR(F.col("f2")).alias("q2"))


def _digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): digest of the ascending, comma-joined ids of (k1, k2, conv), in bounded memory.

    Sorted ranges join their ids to pieces of text; a node's pieces, in order, then pass through one running hash.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("k1", "k2", "conv")]
            new = np.flatnonzero(np.r_[True, (np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)]) if len(batch) else np.zeros(0, dtype=int)
            ids = keys[2].tolist()
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(new, [*new[1:], len(ids)], strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(k[new]) for k in keys), pa.array(texts, pa.string())], ["k1", "k2", "conv", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if at == (k1, k2):
                    state.update(b"," + ids.encode())
                    continue
                out += [(*at, state.hexdigest())] if at else []
                at, state = (k1, k2), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else ([], [], []), (pa.int64(), pa.int64(), pa.string()))], ["k1", "k2", "ends_sha256"])
        if at:
            yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([state.hexdigest()])], ["k1", "k2", "ends_sha256"])

    pieces = ends.repartitionByRange("k1", "k2", "conv").sortWithinPartitions("k1", "k2", "conv").mapInArrow(join, "k1 bigint, k2 bigint, conv bigint, ids string")
    return pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv").mapInArrow(digest, "k1 bigint, k2 bigint, ends_sha256 string")


def _nodes(keyed: DataFrame, sizes: DataFrame) -> tuple[DataFrame, bool]:
    """All nodes, the root first, and whether equal hashes stand for equal sequences."""
    ended = keyed.join(sizes.select("conv", F.col("n_turns").alias("d"), F.lit(1).cast("long").alias("ends")), ["conv", "d"], "left")
    same = ["d", "symbol", "q1", "q2"]
    grouped = ended.groupBy("k1", "k2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("members"), F.coalesce(F.sum("ends"), F.lit(0)).alias("ends"), F.max("bytes").alias("bytes"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_") for c in same])
    grouped = write_table(grouped)
    sound = grouped.where(" or ".join([*(f"{c} <> {c}_" for c in same), "(k1 = 0 and k2 = 0)"])).isEmpty()
    root = sizes.agg(F.min("conv").alias("conv"), F.count("*").alias("members"), F.coalesce(F.sum((F.col("n_turns") == 0).cast("long")), F.lit(0)).alias("ends")).where("members > 0")
    zero = lambda name: F.lit(0).cast("long").alias(name)
    root = root.select(zero("k1"), zero("k2"), "conv", "members", "ends", zero("bytes"), zero("d"), F.lit(None).cast("binary").alias("symbol"), F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"))
    return root.unionByName(grouped.drop(*[f"{c}_" for c in same])), sound


def encode(turns: DataFrame, sizes: DataFrame, salt: int = 0x51ED270B, tries: int = 4) -> DataFrame:
    """The prefix tree of (conv, d, symbol, bytes) and (conv, n_turns): one row per node.

    ``preorder`` is the node's rank from 0 and ``subtree_end`` the rank of the last node below it; ``conv_id`` the smallest member,
    ``n_leaves`` and ``saved_bytes`` (members but one times the bytes of the last text) are sums over the subtree.
    """
    for k in range(tries):
        keyed = write_table(_keyed(turns, salt + 2 * k))
        nodes, sound = _nodes(keyed, sizes)
        if sound:
            break
    else:
        raise RuntimeError(f"hashes of {tries} salts do not tell nodes apart")
    nodes = write_table(nodes)
    # Members of earlier siblings, from one prefix sum over all nodes by (parent, symbol).
    below = nodes.where("d > 0").select("k1", "k2", "q1", "q2", "symbol", "members")
    sided = prefix_sums(below, ["q1", "q2", "symbol"], g="members")
    family = sided.groupBy("q1", "q2").agg(F.min("g").alias("g0"), F.count("*").alias("n_children"))
    parents = write_table(nodes.select("k1", "k2", "conv", "ends").join(family.withColumnsRenamed({"q1": "k1", "q2": "k2"}), ["k1", "k2"], "left"))
    above = parents.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv").alias("parent"), F.col("ends").alias("ended"), "g0")
    placed = write_table(sided.join(above, ["q1", "q2"]).select("k1", "k2", "parent", (F.col("ended") + F.col("g") - F.col("g0")).alias("skip")))
    # The first place of a node: the sum of the steps along the path of its smallest member.
    steps = keyed.select("conv", "d", "k1", "k2").join(placed, ["k1", "k2"])
    starts = running(steps, "conv", "d", F.sum, start="skip").select("k1", "k2", "conv", "parent", "start")
    starts = starts.join(nodes.select("k1", "k2", "conv", "members", "d", "bytes"), ["k1", "k2", "conv"])
    top = nodes.where("d = 0").select("k1", "k2", "conv", F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("start"), "members", "d", "bytes")
    family = parents.select("k1", "k2", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"))
    full = starts.unionByName(top).join(family, ["k1", "k2"])
    full = write_table(full.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("members") - 1) * F.col("bytes"), "one": F.lit(1).cast("long"), "stop": F.col("start") + F.col("members")}))
    ranked = prefix_sums(full, ["start", "d"], preorder="one", leaves="leaf", saves="saved")
    # What follows a subtree begins at the place where the subtree's places stop; behind the last subtree are the totals.
    total = full.agg(F.count("*").alias("t_n"), F.sum("leaf").alias("t_leaf"), F.sum("saved").alias("t_saved"))
    next_ = ranked.groupBy(F.col("start").alias("stop")).agg(F.min("preorder").alias("n_next"), F.min("leaves").alias("l_next"), F.min("saves").alias("s_next"))
    ended = ranked.join(next_, "stop", "left").join(F.broadcast(total))
    ends = keyed.join(sizes.withColumnRenamed("n_turns", "d"), ["conv", "d"], "left_semi").select("k1", "k2", "conv")
    ends = ends.unionByName(sizes.where("n_turns = 0").select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "conv"))
    digests = _digests(ends)
    return ended.join(digests, ["k1", "k2"], "left").select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("members").alias("n_convs"), "n_children",
        (F.coalesce("l_next", "t_leaf") - F.col("leaves")).alias("n_leaves"), (F.coalesce("s_next", "t_saved") - F.col("saves")).alias("saved_bytes"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "preorder", (F.coalesce("n_next", "t_n") - 1).alias("subtree_end"))


def op13_prefix_tree(spark, sf_dir: str) -> DataFrame:
    """Nodes of the prefix tree of all rebuilt ``conversations``."""
    turns = write_table(rows_of_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")))
    rebuilt, sizes = rebuild(turns)
    return encode(write_table(rebuilt), write_table(sizes)).withColumnRenamed("saved_bytes", "saved_tokens")


#: Paths are lists of digests; the tree is made of all their beginnings.
ORACLE_SQL = """
WITH turns AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
marked AS (SELECT c, turn, r, sha256(concat(octet_length(encode(r))::VARCHAR, ':', r, t)) AS s, octet_length(encode(t))::BIGINT AS b FROM turns),
seq AS (SELECT c, s, b, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, s) AS p FROM marked),
bits AS (SELECT c, c::VARCHAR AS txt FROM (SELECT DISTINCT c FROM seq)),
crc AS (SELECT c, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(txt) + 1), lambda i: ascii(txt[i])::BIGINT)),
  lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)::BIGINT[]), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS v FROM bits),
conv AS (SELECT c, c - c % 5 AS base, xor(v, 4294967295) % 9 AS h FROM crc),
kept AS (SELECT conv.c, p AS k, s, b FROM conv JOIN seq ON seq.c = base WHERE p <= h
  UNION ALL SELECT conv.c, 1000000000 + p, s, b FROM conv JOIN seq ON seq.c = conv.c WHERE p > h),
path AS (SELECT conv.c, coalesce(list(s ORDER BY k) FILTER (WHERE s IS NOT NULL), []) AS w, coalesce(list(b ORDER BY k) FILTER (WHERE s IS NOT NULL), []) AS bs FROM conv LEFT JOIN kept ON kept.c = conv.c GROUP BY conv.c),
pre AS (SELECT c, w, bs, unnest(range(0, len(w) + 1)) AS d FROM path),
node AS (SELECT w[1:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs, max(CASE WHEN d = 0 THEN 0 ELSE bs[d] END) AS bytes,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = len(w)), '')) AS ends_sha256 FROM pre GROUP BY 1, 2),
kids AS (SELECT k[1:d - 1] AS up, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
full_ AS (SELECT node.*, coalesce(n, 0) AS n_children FROM node LEFT JOIN kids ON up = k),
sums AS (SELECT k[1:j] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved, count(*) AS size
  FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM full_) GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY k) - 1 AS preorder FROM full_)
SELECT r.conv_id, r.d AS depth, p.conv_id AS parent_conv_id, r.n_convs, r.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, r.ends_sha256,
  r.preorder, CAST(r.preorder + size - 1 AS BIGINT) AS subtree_end
FROM ranked r JOIN sums USING (k) LEFT JOIN ranked p ON r.d > 0 AND p.k = r.k[1:r.d - 1]"""
