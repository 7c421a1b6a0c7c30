"""Ranked lexical search by dual-sorted wavelet trees, one per shard of documents.

A shard holds the postings of its documents as one sequence of document numbers:
term after term, each term's by falling impact.  The sequence stands in a wavelet
tree over the numbers, which ascend with ``doc_id``: every level splits the
documents in halves and keeps the order of the postings, so that a term's range in
any node is still by falling impact and its first posting bounds the term's part of
the score below that node.  A search descends with the ranges of all terms at once,
best bound first, several nodes in a step; at a leaf the bound is the score.  It
ends when no node can better the k-th result, which a task carries on from shard to
shard.  Results are exact.

Scans cut shards from what each task reads, by bytes of text, so texts are never
shuffled, a frequent term is spread over all shards, and memory is bounded whatever the
number of documents (a longer text is a shard of its own).  Terms are told apart by two
seeded hashes while a shard is built, with other seeds if the first collide, and are
looked up by their bytes.  Items are asked in slices of about ``SLICE_BYTES`` of text:
one slice of items, and what was found for it, is all that a task and the driver hold.

Defined cases: null and empty texts have no terms: such documents are never found and such items find nothing; rows that share
a doc_id are documents of their own; equal scores go by ascending doc_id, null last; every row of items is an item, and
rows that share an id each get their own ranks; terms that no document holds count for nothing; without documents nothing is
found; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import secrets
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prismarq.llm.common import Texts, give_back, hash_slices, write_table

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text in a shard, and of items that are asked together.
SHARD_BYTES, SLICE_BYTES = 8 << 20, 4 << 20
#: Nodes that a step of the search opens.
STEP = 64
#: Results of an item.
TOP = 10

_IN_TERM = np.ones(256, dtype=bool)
_IN_TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LAST = np.iinfo(np.int64).max
_SHARD = "n_terms bigint, ids binary, no_id binary, seed bigint, hashes binary, words binary, word_ends binary, starts binary, impacts binary, bits binary"
_COLUMNS = [c.strip().split()[0] for c in _SHARD.split(",")]


def _bounds(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the terms in ``raw``; none crosses one of ``edges``."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = _IN_TERM[raw]
    cut = np.zeros(len(raw) + 2, dtype=bool)
    cut[edges + 1] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[1:-1]))
    return starts, np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[2:])) + 1


def _pieces(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(bytes, starts, stops, text of each term, place) of consecutive pieces."""
    for at, raw in texts.pieces():
        edges = texts.offsets[np.searchsorted(texts.offsets, at) : np.searchsorted(texts.offsets, at + len(raw))] - at
        starts, stops = _bounds(raw, edges)
        yield raw, starts, stops, np.searchsorted(texts.offsets, starts + at, side="right") - 1, at


def terms_of(text: str | None) -> list[bytes]:
    """Terms of one text, in order."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    lower = _LOWER[raw].tobytes()
    return [lower[a:b] for a, b in zip(*_bounds(raw, np.zeros(0, dtype=np.int64)), strict=True)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        for texts in Texts(batch.column("text")).groups():
            n = np.zeros(len(texts), dtype=np.int64)
            for _, starts, _, owner, _ in _pieces(texts):
                n += np.bincount(owner, minlength=len(texts))
            docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
    yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], ["docs", "terms"])


# --- building ---------------------------------------------------------------------------


def _postings(texts: Texts, seed: int) -> tuple[np.ndarray, ...] | None:
    """(hashes, first byte, length, term, text, tf): the distinct terms by hash, and postings by (term, text); None if hashes collide."""
    found = []
    for raw, starts, stops, owner, at in _pieces(texts):
        low = _LOWER[raw]
        codes, first, of = np.unique(hash_slices(low, starts, stops, seed), return_index=True, return_inverse=True)
        other = hash_slices(low, starts, stops, seed ^ 0x5555555555555555)
        if (other != other[first][of]).any():
            return None
        pairs, tf = np.unique(of * len(texts) + owner, return_counts=True)
        found.append((codes, other[first], starts[first] + at, (stops - starts)[first], codes[pairs // len(texts)], pairs % len(texts), tf))
    if not found:
        found.append((np.zeros(0, dtype=np.uint64),) * 2 + (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),) + (np.zeros(0, dtype=np.int64),) * 2)
    codes, other, begin, size, code, owner, tf = (np.concatenate(x) for x in zip(*found, strict=True))
    hashes, first, of = np.unique(codes, return_index=True, return_inverse=True)
    if (other != other[first][of]).any():
        return None
    pairs, of = np.unique(np.searchsorted(hashes, code) * len(texts) + owner, return_inverse=True)
    return hashes, begin[first], size[first], pairs // len(texts), pairs % len(texts), np.bincount(of, weights=tf, minlength=len(pairs)).astype(np.int64)


def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A posting's part of the score, before the term's weight; ``n`` are the terms of its document."""
    m = 25 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def split_levels(sequence: np.ndarray, levels: int) -> Iterator[np.ndarray]:
    """The bits of each level: postings of lower document numbers go first, in their order, into the next level."""
    for k in range(levels - 1, -1, -1):
        bit = (sequence >> k) & 1 == 1
        yield bit
        sequence = np.concatenate([sequence[~bit], sequence[bit]])


def build_shard(ids: np.ndarray, no_id: np.ndarray, texts: Texts, n_docs: int, n_terms: int, seed: int) -> tuple:
    """A row of ``_SHARD`` from the documents' ids (and which have none) and texts."""
    while (got := _postings(texts, seed)) is None:
        seed = (seed * 0x5851F42D4C957F2D + 1) % (1 << 63)
    hashes, begin, size, term, text, tf = got
    n = np.bincount(text, weights=tf, minlength=len(texts)).astype(np.int64)
    order = np.lexsort((ids, no_id))
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    got = impact(tf, n[text], n_docs, n_terms)
    by = np.lexsort((number[text], -got, term))
    sequence, got = number[text][by], got[by].astype("<u4")
    starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(hashes)))]).astype("<i8")
    low = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    bits = [np.packbits(b).tobytes() for b in split_levels(sequence, levels_of(len(texts)))]
    return (
        int(n.sum()), ids[order].astype("<i8").tobytes(), no_id[order].tobytes(), seed, hashes.astype("<u8").tobytes(), _LOWER[texts.data[low]].tobytes(), np.cumsum(size).astype("<i8").tobytes(),
        starts.tobytes(), got.tobytes(), b"".join(bits))


def levels_of(documents: int) -> int:
    return max(1, (documents - 1).bit_length())


@dataclass(frozen=True)
class Index:
    """Shards, one row each, with the number of documents that have terms and of all their terms."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> Index:
    """Index every row of ``docs`` (doc_id, text); texts are read twice, once for the counts that impacts need, and not moved."""
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs, n_terms = lean.select("text").mapInArrow(_counts, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms, seed = n_docs or 0, max(1, n_terms or 0), secrets.randbits(62)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray, bytes, np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            ids, no_id, parts, sizes = zip(*pending, strict=True)
            texts = Texts([b"".join(parts)])
            texts.offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
            row = build_shard(np.concatenate(ids), np.concatenate(no_id), texts, n_docs, n_terms, seed)
            pending.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for v in row], _COLUMNS)

        for batch in batches:
            texts, column = Texts(batch.column("text")), batch.column("doc_id")
            no_id = column.is_null().to_numpy(zero_copy_only=False)
            ids = column.fill_null(_LAST).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(texts.offsets, texts.offsets[at] + shard_bytes - held, side="right")) - 1)
                stop = min(stop, len(texts), at + (1 << 20))
                a, b = texts.offsets[at], texts.offsets[stop]
                pending.append((ids[at:stop], no_id[at:stop], texts.data[a:b].tobytes(), np.diff(texts.offsets[at : stop + 1])))
                held, at = held + int(b - a) + 8 * (stop - at), stop
                if held >= shard_bytes:
                    yield flush()
        if pending:
            yield flush()
        give_back()

    return Index(write_table(lean.mapInArrow(build, _SHARD)), n_docs, n_terms)


# --- searching --------------------------------------------------------------------------


class Dictionary:
    """Terms of a shard: ``ranges`` gives the bounds of their postings."""

    def __init__(self, row: dict):
        self.seed, self.words = row["seed"], row["words"]
        self.hashes = np.frombuffer(row["hashes"], dtype="<u8")
        self.ends = np.frombuffer(row["word_ends"], dtype="<i8")
        self.starts = np.frombuffer(row["starts"], dtype="<i8")

    def ranges(self, terms: list[bytes], data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each term's postings (equal: none); ``data`` holds the terms, ``begin`` their bounds."""
        code = hash_slices(data, begin[:-1], begin[1:], self.seed)
        at = np.minimum(np.searchsorted(self.hashes, code), max(0, len(self.hashes) - 1))
        low, high = np.zeros(len(terms), dtype=np.int64), np.zeros(len(terms), dtype=np.int64)
        for i in np.flatnonzero(self.hashes[at] == code) if len(self.hashes) else ():
            k = int(at[i])
            if self.words[(self.ends[k - 1] if k else 0) : self.ends[k]] == terms[i]:
                low[i], high[i] = self.starts[k], self.starts[k + 1]
        return low, high


class Tree:
    """The wavelet tree of a shard: ranks of all levels, and each level's impacts in its order."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], dtype="<i8")
        self.no_id = np.frombuffer(row["no_id"], dtype=bool)
        best = np.frombuffer(row["impacts"], dtype="<u4").astype(np.int32)
        self.n, self.levels = len(best), levels_of(len(self.ids))
        packed = np.frombuffer(row["bits"], dtype=np.uint8).reshape(self.levels, -1)
        self.rank = np.zeros((self.levels, self.n + 1), dtype=np.int32)  # postings before a place that go to the lower half
        self.best = np.zeros((self.levels + 1, self.n + 1), dtype=np.int32)
        for k in range(self.levels):
            zero = np.unpackbits(packed[k], count=self.n) == 0
            np.cumsum(zero, out=self.rank[k, 1:])
            self.best[k, :-1] = best
            best = np.concatenate([best[zero], best[~zero]])
        self.best[self.levels, :-1] = best
        self.zeros = self.rank[:, -1].astype(np.int64)


class Best:
    """The ``k`` best (score, document) so far: highest score, then smallest id, null last."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def floor(self) -> tuple[int, int]:
        """A score must be higher than this, or as high with an id up to that."""
        if len(self.heap) < self.k:
            return 0, -_LAST
        key = -self.heap[0][1]
        return self.heap[0][0], key if key == _LAST else key - 1  # the largest id may stand for none

    def add(self, score: int, key: int, null: bool) -> None:
        entry = (score, -key, not null)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


def best_first(tree: Tree, low: np.ndarray, high: np.ndarray, weight: np.ndarray, best: Best, step: int = STEP) -> int:
    """Add to ``best`` what the shard holds for weighted ranges of postings; returns how many nodes were opened."""
    use = (high > low) & (weight > 0)
    low, high, weight = low[use], high[use], weight[use]
    if not len(low):
        return 0
    rank, impacts, width, opened = tree.rank.ravel(), tree.best.ravel(), tree.n + 1, 0
    heap = [(-int((weight * tree.best[0, low]).sum()), 0, 0, low, high)]  # (bound, first document, level, ranges)
    while heap:
        score, key = best.floor()
        nodes = []
        while heap and len(nodes) < step:
            bound, first, level, *_ = node = heapq.heappop(heap)
            if -bound < score or -bound == score and tree.ids[first] > key:
                heap.clear()  # no other node has a higher bound, or as high a one with smaller ids
            else:
                nodes.append(node)
        if not nodes:
            break
        opened += len(nodes)
        level = np.array([n[2] for n in nodes])
        first = np.array([n[1] for n in nodes])
        low, high = np.stack([n[3] for n in nodes]), np.stack([n[4] for n in nodes])
        row = level[:, None] * width
        low0, high0 = rank[row + low].astype(np.int64), rank[row + high].astype(np.int64)
        shift = tree.zeros[level][:, None]
        low = np.concatenate([low0, low - low0 + shift])
        high = np.concatenate([high0, high - high0 + shift])
        first = np.concatenate([first, first + (1 << (tree.levels - 1 - level))])
        level = np.concatenate([level, level]) + 1
        bound = (np.where(high > low, impacts[level[:, None] * width + low], 0) * weight).sum(axis=1)
        hope = (bound > score) | (bound == score) & (bound > 0)
        hope[hope] &= (bound[hope] > score) | (tree.ids[first[hope]] <= key)
        for i in np.flatnonzero(hope):
            if level[i] == tree.levels:
                best.add(int(bound[i]), int(tree.ids[first[i]]), bool(tree.no_id[first[i]]))
            else:
                heapq.heappush(heap, (-int(bound[i]), int(first[i]), int(level[i]), low[i], high[i]))
    return opened


def _joined(terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(terms), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)


def document_frequencies(index: Index, terms: list[bytes]) -> np.ndarray:
    """Number of documents that hold each term, from the lengths of its postings in all shards."""
    joined = _joined(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                low, high = Dictionary(row).ranges(terms, *joined)
                n += high - low
        have = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(n[have])], ["term", "n"])

    rows = index.shards.select("seed", "hashes", "words", "word_ends", "starts").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(terms), dtype=np.int64)
    for term, n in rows:  # at most the terms of one slice
        out[term] = n
    return out


def _search(index: Index, items: pd.DataFrame, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best results of each item (columns item, text)."""
    counts = [Counter(terms_of(t)) for t in items["text"]]
    terms = sorted(set().union(*counts)) if counts else []
    place, joined = {t: i for i, t in enumerate(terms)}, _joined(terms)
    df = document_frequencies(index, terms) if terms else np.zeros(0, dtype=np.int64)
    weight = [math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * int(n) + 1))) for n in df]
    asked = [(int(i), np.array([place[t] for t in c], dtype=np.int64), np.array([weight[place[t]] * n for t, n in c.items()], dtype=np.int64)) for i, c in zip(items["item"], counts, strict=True)]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in asked]
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree(row)
                low, high = Dictionary(row).ranges(terms, *joined)
                for (_, own, weights), found in zip(asked, best, strict=True):
                    best_first(tree, low[own], high[own], weights, found)
        rows = [(item, -key if known else None, score) for (item, _, _), found in zip(asked, best, strict=True) for score, key, known in found.heap]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))], ["item", "doc_id", "score"])
        give_back()

    return index.shards.mapInArrow(search, "item bigint, doc_id bigint, score bigint")


def search(index: Index, items: DataFrame, k: int = TOP, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of each row of ``items`` (item_id, text)."""
    held = write_table(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")))
    slices = 1 + (held.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) // slice_bytes
    parts = []
    for i in range(slices):
        some = held.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == i).select("item", "text").toPandas()  # about slice_bytes
        parts.append(write_table(_search(index, some, k)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(held.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_wavelet_search(spark, sf_dir: str) -> DataFrame:
    """The ten best ``documents`` of every ``benchmark`` item."""
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')"
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
c AS (SELECT count(*)::BIGINT AS nd, sum(len(w))::BIGINT AS nt FROM d WHERE len(w) > 0),
p AS (SELECT r, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM d) GROUP BY ALL),
f AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS wt FROM p, c GROUP BY t, nd),
i AS (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS w FROM benchmark),
qt AS (SELECT q, item_id, t, count(*)::BIGINT AS times FROM (SELECT q, item_id, unnest(w) AS t FROM i) GROUP BY ALL),
s AS (SELECT q, item_id, r, doc_id, sum(times * wt * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nt))))::BIGINT AS score
  FROM qt JOIN f USING (t) JOIN p USING (t), c GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= {TOP}"""
