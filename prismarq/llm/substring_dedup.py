"""Exact substring removal by a sparse, range-partitioned suffix array.

Every byte covered by a ``LENGTH``-byte string that starts at another place too is
removed.  Instead of all suffixes, those at content-defined anchors are sorted:
the anchor of a window (a string of LENGTH bytes) is the place of the least hash
among its ``GRAM``-byte grams, so equal windows have equal anchors at equal
offsets.  Windows of a text that share an anchor are consecutive: a run.

1. Sampled splitters cut the order of the suffixes at anchors (leading bytes, gram,
   context) into buckets, and a run goes to the bucket of its anchor.  A gram that
   very many texts share takes several buckets, not one.
2. A bucket is sorted in that order.  A gram met once settles its run: no window of
   it repeats.  Runs with one and the same context repeat as a whole.  Each bucket
   hands its first and last gram over; a gram that goes on beyond a boundary is
   compared there too.
3. Where a gram has several contexts, one run of each brings its bytes to the bucket
   of its suffix, the first one where the gram begins.  There the windows are suffixes,
   sorted by multikey quicksort, eight bytes at a level, refining only what is still
   tied.  Neighbours that stay tied over all of LENGTH bytes are equal.
4. Runs and windows found to repeat become spans; each text loses their union.

No bucket should hold all windows of a gram with more than ``GIANT`` contexts: those
windows are counted over all buckets by 128-bit digests.  Texts move twice (to give
the bytes of contexts, and to be cut).  Grams and whole contexts are told apart by
64-bit hashes of their bytes; windows are compared as bytes.

Defined cases: null text is empty; matches never cross texts; a text shorter than
LENGTH keeps everything; equal rows lose everything if long enough; a row without
doc_id is treated like others; an empty table gives an empty result; input
columns pass through, and those named like an output are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.llm.common import Rolling, as_bytes, batches, corpus_seed, fresh, give_back, mix64, small, write_table

LENGTH = 200
GRAM = 50
#: Documents whose anchors are sampled for splitters, about, and anchors of each.
SAMPLE_DOCS, SAMPLE_EACH = 2000, 8
#: Input rows per bucket.
ROWS_PER_BUCKET, MOST_BUCKETS = 1500, 20_000
#: Contexts of one gram that meet in one bucket.
GIANT = 20_000
#: Windows that are sorted at a time.
SORT_WINDOWS = 60_000

_POSITION = np.uint64((1 << 24) - 1)
#: The order of suffixes at anchors.
_ORDER = ("lead", "gram", "context")
_RUN = "doc long, bucket int, lead long, gram long, context long, start int, n int, off int, many boolean"
#: Buffers hold fewer bytes than positions in a packed key can count.
_BUFFER = 1 << 20


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def find_runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, seed: int = 0) -> dict[str, np.ndarray]:
    """Runs of windows by anchor: owner, start, n (windows), off (anchor less start), lead, gram, context.

    Grams and contexts are told apart by 64-bit hashes with a seed; who does not know it can't make two that collide.
    """
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    none = {k: np.zeros(0, dtype=np.int64) for k in ("owner", "start", "n", "off", "lead", "gram", "context")}
    if len(raw) < length:
        return none
    # Eight bytes make a code: sums of codes of single bytes are too alike in texts of few letters.
    rolling = Rolling(mix64(_eights(raw) ^ np.uint64(seed)))
    at = np.arange(len(raw) - gram + 1)
    hashes = rolling.slices(at, at + gram - 7)
    if len(raw) <= int(_POSITION):
        least = _sliding_min((hashes & ~_POSITION) | at.astype(np.uint64), length - gram + 1)
        anchor = (least & _POSITION).astype(np.int64)
    else:  # one text too long for packed keys: in pieces that overlap by a window
        piece, anchors = int(_POSITION), []
        for i in range(0, len(raw) - length + 1, piece - length + 1):
            h = hashes[i : i + piece - gram + 1]
            least = _sliding_min((h & ~_POSITION) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
            anchors.append((least & _POSITION).astype(np.int64) + i)
        anchor = np.concatenate(anchors)[: len(raw) - length + 1]
    # Windows that cross the end of a text don't count.
    valid = np.zeros(len(anchor) + 1, dtype=np.int32)
    whole = sizes >= length
    np.add.at(valid, (ends - sizes)[whole], 1)
    np.add.at(valid, np.minimum(ends - length + 1, len(anchor))[whole], -1)
    valid = np.cumsum(valid[:-1]) > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(new)
    if not len(begin):
        return none
    stops = np.flatnonzero(new | ~valid)
    after = np.searchsorted(stops, begin, side="right")
    stop = np.where(after < len(stops), stops[np.minimum(after, len(stops) - 1)], len(anchor))
    owner = np.searchsorted(ends, begin, side="right")
    place = anchor[begin]
    n, off = stop - begin, place - begin
    context = rolling.slices(begin, stop - 8 + length) ^ mix64((n << 20 | off).astype(np.uint64))
    lead = _eights(raw)[place].byteswap()
    return {"owner": owner, "start": begin - (ends - sizes)[owner], "n": n, "off": off, "lead": (lead ^ np.uint64(1 << 63)).view(np.int64), "gram": hashes[place].view(np.int64), "context": context.view(np.int64)}


def _eights(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one little-endian number; zeros follow the end."""
    padded = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    return np.ndarray(len(raw), dtype="<u8", buffer=padded, strides=(1,))


def buckets_of(keys: list[np.ndarray], splitters: list[np.ndarray]) -> np.ndarray:
    """Number of splitters below each suffix; both in the order of their columns, the first one first."""
    low = np.searchsorted(splitters[0], keys[0], side="left")
    if len(keys) == 1:
        return low
    high = np.searchsorted(splitters[0], keys[0], side="right")
    out, tied = low.copy(), np.flatnonzero(low < high)
    for a in np.unique(low[tied]):
        rows = tied[low[tied] == a]
        out[rows] += buckets_of([k[rows] for k in keys[1:]], [x[a : high[rows[0]]] for x in splitters[1:]])
    return out


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Mark runs whose context is met twice among these rows as ``many``; keep one of each to stand for them in its bucket (bucket -1: only a result)."""
    order = np.lexsort((pdf["context"].to_numpy(), pdf["gram"].to_numpy()))
    g, c = pdf["gram"].to_numpy()[order], pdf["context"].to_numpy()[order]
    same = (g[1:] == g[:-1]) & (c[1:] == c[:-1])
    many = np.zeros(len(pdf), dtype=bool)
    many[order[1:][same]] = True
    later = many.copy()
    many[order[:-1][same]] = True
    pdf["many"] = many
    pdf.loc[later, "bucket"] = -1
    return pdf


def _run_maker(splitters: list[np.ndarray], seed: int):
    def make(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            texts, out = as_bytes(pdf["text"]), []
            docs = pdf["doc"].to_numpy()
            for i, j in batches(texts, _BUFFER):
                r = find_runs(texts[i:j], seed=seed)
                doc = docs[i:j][r.pop("owner")] if len(r["start"]) else np.zeros(0, dtype=np.int64)
                out.append(pd.DataFrame({"doc": doc, "bucket": buckets_of([r[x] for x in _ORDER], splitters), **r}))
            if out:
                yield _settle(pd.concat(out, ignore_index=True))[[x.split()[0] for x in _RUN.split(", ")]]
        give_back()

    return make


def _whole_groups(parts: Iterator[pd.DataFrame], columns: list[str], least: int = 0) -> Iterator[pd.DataFrame]:
    """Consecutive rows cut at changes of ``columns``: every group whole in one frame."""
    held: list[pd.DataFrame] = []
    rows = 0
    for pdf in parts:
        if not len(pdf):
            continue
        change = np.zeros(len(pdf), dtype=bool)
        for c in columns:
            v = pdf[c].to_numpy()
            change[1:] |= v[1:] != v[:-1]
            if held:
                change[0] |= v[0] != held[-1][c].iloc[-1]
        cuts = np.flatnonzero(change)
        if len(cuts) and rows + cuts[-1] >= least:
            held.append(pdf.iloc[: cuts[-1]])
            yield pd.concat(held, ignore_index=True)
            held, rows = [pdf.iloc[cuts[-1] :]], len(pdf) - cuts[-1]
        else:
            held.append(pdf)
            rows += len(pdf)
    if held:
        yield pd.concat(held, ignore_index=True)


_JUDGED = "doc long, start int, n int, off int, bucket int, gram long, again boolean, ask boolean, contexts long, edge boolean"


def _judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs that repeat (``again``), one run of each context of grams that have several (``ask``), and one of each context of grams that may go on beyond a boundary (``edge``)."""
    for pdf in _whole_groups(parts, ["bucket", "lead", "gram"]):
        done = pdf["bucket"].to_numpy() < 0  # results already, with no part in the comparison
        if done.any():
            yield pdf[done][["doc", "start", "n", "off", "bucket", "gram"]].assign(again=True, ask=False, contexts=1, edge=False)
            pdf = pdf[~done].reset_index(drop=True)
            if not len(pdf):
                continue
        gram, context, bucket = (pdf[x].to_numpy() for x in ("gram", "context", "bucket"))
        new_bucket = np.ones(len(pdf), dtype=bool)
        new_bucket[1:] = bucket[1:] != bucket[:-1]
        new_gram = new_bucket.copy()
        new_gram[1:] |= (gram[1:] != gram[:-1]) | (pdf["lead"].to_numpy()[1:] != pdf["lead"].to_numpy()[:-1])
        new_context = new_gram.copy()
        new_context[1:] |= context[1:] != context[:-1]
        which = np.cumsum(new_context) - 1
        many = (np.bincount(which) > 1) | (np.bincount(which, weights=pdf["many"].to_numpy()) > 0)
        group = np.cumsum(new_gram) - 1
        contexts = np.bincount(group, weights=new_context).astype(np.int64)[group]
        first = np.flatnonzero(new_bucket)
        outer = np.zeros(group[-1] + 1, dtype=bool)  # first and last grams of buckets, as far as these rows tell
        outer[group[first]] = outer[group[np.append(first[1:], len(pdf)) - 1]] = True
        again, ask = many[which], new_context & (contexts > 1)
        edge = outer[group] & new_context
        out = pd.DataFrame({"doc": pdf["doc"], "start": pdf["start"], "n": pdf["n"], "off": pdf["off"], "bucket": bucket, "gram": gram, "again": again, "ask": ask, "contexts": contexts, "edge": edge})
        yield out[again | ask | edge]
    give_back()


_SLICE = "doc long, start int, n int, home int, gram long, again boolean, contexts long, bytes binary"


def _slicer(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the runs that are asked for, from each text once."""
    for pdf in parts:
        rows = []
        for doc, text, asked in zip(pdf["doc"], as_bytes(pdf["text"]), pdf["asked"], strict=True):
            for a in asked:
                rows.append((doc, a["start"], a["n"], a["home"], a["gram"], a["again"], a["contexts"], text[a["start"] : a["start"] + a["n"] - 1 + LENGTH]))
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in _SLICE.split(", ")])


def equal_windows(flat: np.ndarray, at: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of the suffixes of ``flat`` that begin ``at`` agree with another one in their first ``length`` bytes.

    Multikey quicksort: eight bytes at a level, in byte order, and from level to level only suffixes still tied.
    """
    eights = _eights(flat)
    rows, group = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
    for depth in range(0, length, 8):
        if not len(rows):
            break
        k = eights[at[rows] + depth].byteswap()
        if length - depth < 8:
            k >>= np.uint64(8 * (8 - length + depth))
        order = np.lexsort((k, group))
        rows, group, k = rows[order], group[order], k[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (k[1:] != k[:-1])
        group = np.cumsum(new) - 1
        tied = np.bincount(group)[group] > 1
        rows, group = rows[tied], group[tied]
    out = np.zeros(len(at), dtype=bool)
    out[rows] = True
    return out


def _windows(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of these runs: row, place in ``flat``, place in the text; and ``flat``, all bytes."""
    flat = np.frombuffer(b"".join(pdf["bytes"]), dtype=np.uint8)
    n = pdf["n"].to_numpy().astype(np.int64)
    sizes = n - 1 + LENGTH
    begin = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(pdf)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, begin[row] + step, pdf["start"].to_numpy()[row] + step, flat


def _compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of windows that occur in another context of the same gram."""
    for frame in _whole_groups(parts, ["home", "gram"]):
        total = np.cumsum(frame["n"].to_numpy())
        gram = frame["gram"].to_numpy()
        ends = np.append(np.flatnonzero(gram[1:] != gram[:-1]) + 1, len(frame))
        begin = 0
        while begin < len(frame):  # as many whole grams as SORT_WINDOWS holds, one at least
            fit = ends[(ends > begin) & (total[ends - 1] - (total[begin - 1] if begin else 0) <= SORT_WINDOWS)]
            stop = fit[-1] if len(fit) else ends[ends > begin][0]
            pdf = frame.iloc[begin:stop]
            begin = stop
            row, begin_at, at, flat = _windows(pdf)
            hit = equal_windows(flat, begin_at) & ~pdf["again"].to_numpy()[row]
            where = np.flatnonzero(hit)
            new = np.ones(len(where), dtype=bool)
            new[1:] = (np.diff(where) > 1) | (row[where][1:] != row[where][:-1])
            first = where[new]
            count = np.diff(np.append(np.flatnonzero(new), len(where)))
            yield pd.DataFrame({"doc": pdf["doc"].to_numpy()[row[first]], "start": at[first], "n": count})
    give_back()


def _expand(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows of giant grams with two hashes, to be counted over all buckets."""
    for pdf in parts:
        for i in range(0, len(pdf), 256):
            part = pdf.iloc[i : i + 256]
            row, begin, at, flat = _windows(part)
            keys = [hashlib.blake2b(flat[x : x + LENGTH], digest_size=16).digest() for x in begin]
            yield pd.DataFrame({"doc": part["doc"].to_numpy()[row], "start": at, "window": keys, "again": part["again"].to_numpy()[row]})


def _cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Remaining bytes and removed spans of each text, from its packed runs."""
    for texts, spans in parts:
        rows = []
        for text, packed in zip(as_bytes(texts), spans, strict=True):
            removed: list[list[int]] = []
            for s, n in sorted((int(x) >> 32, int(x) & 0xFFFFFFFF) for x in (() if packed is None else packed)):
                stop = s + n - 1 + LENGTH
                if removed and s <= removed[-1][1]:
                    removed[-1][1] = max(removed[-1][1], stop)
                else:
                    removed.append([s, stop])
            kept, at = [], 0
            for s, e in removed:
                kept.append(text[at:s])
                at = e
            kept.append(text[at:])
            rows.append((b"".join(kept), [{"start": s, "length": e - s} for s, e in removed]))
        yield pd.DataFrame(rows, columns=["kept_bytes", "removed"])


def splitters_of(texts: DataFrame, n: int, buckets: int, seed: int) -> list[np.ndarray]:
    """``buckets - 1`` splitters (columns of _ORDER) of the suffixes at anchors, sampled from about SAMPLE_DOCS of ``n`` rows: they only balance the buckets."""

    def sample(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            t = as_bytes(pdf["text"])
            for i, j in batches(t, _BUFFER):
                r = find_runs(t[i:j], seed=seed)
                chance = mix64((r["owner"].astype(np.uint64) << np.uint64(32)) + r["start"].astype(np.uint64))
                order = np.lexsort((chance, r["owner"]))  # not by gram: frequent grams must be sampled as often as they are
                first = np.searchsorted(r["owner"][order], np.arange(j - i + 1))
                pick = [order[a : min(a + SAMPLE_EACH, b)] for a, b in zip(first[:-1], first[1:], strict=True)]
                pick = np.concatenate(pick) if pick else np.zeros(0, dtype=np.int64)
                yield pd.DataFrame({x: r[x][pick] for x in _ORDER})

    every = max(1, n // SAMPLE_DOCS)
    some = texts.where(F.pmod(F.col("doc"), F.lit(every)) == 0).select("text")
    found = some.mapInPandas(sample, ", ".join(f"{x} long" for x in _ORDER)).limit(4 * SAMPLE_DOCS * SAMPLE_EACH).collect()
    found = np.array(sorted(tuple(r) for r in found), dtype=np.int64).reshape(-1, len(_ORDER))
    cuts = (np.arange(1, buckets) * len(found)) // buckets if len(found) else np.zeros(0, dtype=np.int64)
    return [found[cuts, i] for i in range(len(_ORDER))]


def document_key(doc_id: Column, text: Column) -> Column:
    """64 bits that stand for a row's id and text; equal rows share them and their fate."""
    return F.xxhash64(doc_id, F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def repeated_runs(texts: DataFrame) -> DataFrame:
    """(doc, span): runs of repeated windows of ``texts`` (doc, text), packed as start * 2**32 + windows."""
    texts = texts.where(F.octet_length("text") >= LENGTH)
    n = texts.count()
    buckets = min(MOST_BUCKETS, max(64, n // ROWS_PER_BUCKET))
    seed = corpus_seed(texts, "doc")
    runs = texts.mapInPandas(_run_maker(splitters_of(texts, n, buckets, seed), seed), _RUN)
    runs = runs.repartition(buckets, F.col("bucket"), F.when(F.col("bucket") < 0, F.col("doc")))
    judged = write_table(runs.sortWithinPartitions("bucket", *_ORDER, "doc", "start").mapInPandas(_judge, _JUDGED))
    # Grams that buckets handed over and that more than one bucket knows: at most two a bucket, and two a batch of rows.
    beyond = judged.where("edge").select("gram", "bucket", "contexts").distinct().groupBy("gram")
    beyond = beyond.agg(F.min("bucket").alias("home"), F.sum("contexts").alias("all"), F.countDistinct("bucket").alias("n")).where("n > 1").select("gram", "home", "all")
    ask = judged.where("ask or edge").join(small(write_table(beyond)), "gram", "left").where("ask or home is not null")
    ask = ask.select("doc", "start", "n", "gram", "again", F.coalesce("home", "bucket").alias("home"), F.coalesce("all", "contexts").alias("contexts"))
    asked = write_table(ask.groupBy("doc").agg(F.collect_list(F.struct("start", "n", "home", "gram", "again", "contexts")).alias("asked")))
    slices = texts.join(asked, "doc").select("doc", "text", "asked").mapInPandas(_slicer, _SLICE)
    giant = not asked.where(F.exists("asked", lambda a: a["contexts"] > GIANT)).isEmpty()
    if giant:
        slices = write_table(slices)
    near = slices.where(F.col("contexts") <= GIANT) if giant else slices
    found = near.repartition(buckets, "home").sortWithinPartitions("home", "gram").mapInPandas(_compare, "doc long, start int, n int")
    out = judged.where("again").select("doc", "start", "n").unionByName(found)
    if giant:
        windows = write_table(slices.where(F.col("contexts") > GIANT).mapInPandas(_expand, "doc long, start int, window binary, again boolean"))
        twice = windows.groupBy("window").count().where("count > 1").select("window")
        out = out.unionByName(windows.where("not again").join(twice, "window", "left_semi").select("doc", "start", F.lit(1).alias("n")))
    return out.select("doc", (F.col("start").cast("long") * (1 << 32) + F.col("n")).alias("span"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``kept_bytes`` (what is left of the text) and ``removed`` (structs of start and length in bytes)."""
    key, spans, x = fresh(docs, "doc", "spans", "cut")
    docs = docs.drop("kept_bytes", "removed")
    keyed = docs.withColumn(key, document_key(F.col("doc_id"), F.col("text")))
    found = repeated_runs(keyed.select(F.col(key).alias("doc"), "text"))
    per = found.groupBy(F.col("doc").alias(key)).agg(F.collect_set("span").alias(spans))
    cut = F.pandas_udf(_cut, "kept_bytes binary, removed array<struct<start:int,length:int>>")
    out = keyed.join(per, key, "left").withColumn(x, cut(F.coalesce("text", F.lit("")), F.col(spans)))
    return out.select(*docs.columns, F.col(x)["kept_bytes"].alias("kept_bytes"), F.col(x)["removed"].alias("removed"))


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 200-byte strings."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    total = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["length"])
    return remove_repeats(docs).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), total.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))
