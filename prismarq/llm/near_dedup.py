"""Near-duplicate components by a chosen-path set similarity join.

A document's set holds its distinct k-word shingles.  Documents with equal sets
become one representative.  Independent trees branch the representatives: at each
of up to ``LEVELS`` levels a node picks one minwise token, or two with a chance
that makes the expected number of children 1 / threshold, and a document goes to
the children named by its tokens.  A node with at most ``LEAF`` documents is not
split further; every node that ends a branch is compared exhaustively by
signatures, whose generous bound keeps all but about one in a million true pairs.
Trees repeat until a pair at the threshold is missed with chance ``1 - recall``.

Groups are compared in stages that use what is known: the nodes of the first trees
come first, and the others only need pairs whose documents are not connected yet,
so a group of near copies costs few links however many trees it meets in.  A group
of more than ``CHUNK`` documents is compared chunk by chunk, then by one document of
each connected part, and what is still apart meets all chunks in pairs: every pair
is compared or already connected.

What passes forms coarse components, and their links are confirmed exactly on
full sets in the same stages, with chunks of at most ``BLOCK`` documents and about
``BLOCK_BYTES`` of sets.  So links are spanning sets of confirmed pairs, never all
pairs of a group, and the components are those of all links that the trees find.

Defined cases: null, blank or missing text has an empty set, links with nothing
and is kept; fewer than k words make the whole sequence one shingle; a row
without doc_id links with nothing, has a null component and is kept; equal rows
share their fate; an empty table gives an empty result; input columns pass
through, and those named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.llm.common import Texts, corpus_seed, fresh, give_back, mix64, small, write_table
from prismarq.llm.components import components, labels_of

THRESHOLD = 0.8
SHINGLE = 5
RECALL = 0.9999
LEVELS = 3
LEAF = 64
#: Trees whose nodes are compared before anything is known.
FIRST_TREES = 2
#: Documents of a node at the last level that are compared in one go.
CHUNK = 512
#: Documents, and bytes of their sets (or one document's), that meet in one task of the exact comparison.
BLOCK = 1024
BLOCK_BYTES = 16 << 20
#: Representatives whose nodes are compared in one task, about.
TASK_ROWS = 20_000
#: Shingles that are hashed at a time.
SEGMENT = 1 << 18
#: Signature agreement below which a pair is not confirmed: five standard deviations under the threshold.
SIGNATURE_SLACK = 5.0


def trees_for(threshold: float, recall: float) -> int:
    """Trees with which a pair at the threshold shares the end of a branch with chance ``recall``."""
    reach = 1.0  # of meeting below one node, level by level from the bottom
    for _ in range(LEVELS):
        one, two = threshold * reach, 1 - (1 - threshold * reach) ** 2
        extra = 1 / threshold - 1
        reach = (1 - extra) * one + extra * two
    return math.ceil(math.log(1 - recall) / math.log(1 - reach))


def shingle_sets(texts: Texts, k: int, seed: int | None = None) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    words = texts.words(lower=True, seed=seed)
    at, hashes = words.windows(k)
    ends = np.searchsorted(at, words.first)
    out = [np.unique(hashes[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    for i, h in zip(short, words.whole(short), strict=True):
        out[i] = np.array([h], dtype=np.uint64)
    return out


def minwise(sets: list[np.ndarray], n: int, seed: int) -> np.ndarray:
    """``n`` minwise tokens of each (non-empty) set, as hashes."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *map(len, sets)])
    seeds = mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20))
    out = np.full((len(sets), n), np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(flat), SEGMENT):
        part = flat[low : low + SEGMENT]
        i = int(np.searchsorted(begin, low, side="right")) - 1
        j = int(np.searchsorted(begin, low + len(part), side="left"))
        starts = np.maximum(begin[i:j] - low, 0)
        for t, s in enumerate(seeds):
            h = (part ^ s) * (s | np.uint64(1))
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out[i:j, t] = np.minimum(out[i:j, t], np.minimum.reduceat(h, starts))
    return out


def _paths(tokens: np.ndarray, trees: int, extra: float) -> tuple[np.ndarray, np.ndarray]:
    """(document, [tree, nodes at each level]) of every branch, by document; ``tokens``: two for each level of each tree."""
    bar = np.uint64(int(extra * (1 << 32)))
    owners, nodes = [], []
    for t in range(trees):
        doc = np.arange(len(tokens))
        here = np.full(len(tokens), mix64(np.array([t + 1], dtype=np.uint64))[0])
        trail = np.full((len(tokens), 1), t, dtype=np.uint64)
        for level in range(LEVELS):
            twice = np.flatnonzero((mix64(here) >> np.uint64(32)) < bar)
            a = mix64(here ^ tokens[doc, (t * LEVELS + level) * 2])
            b = mix64(here[twice] ^ tokens[doc[twice], (t * LEVELS + level) * 2 + 1] ^ np.uint64(0x5BD1E995))
            trail = np.concatenate([np.column_stack([trail, a]), np.column_stack([trail[twice], b])])
            here, doc = np.concatenate([a, b]), np.concatenate([doc, doc[twice]])
        owners.append(doc)
        nodes.append(trail)
    owner, found = np.concatenate(owners), np.concatenate(nodes)
    order = np.argsort(owner, kind="stable")
    return owner[order], found[order]


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


_SKETCH = "n_shingles long, key binary, sig binary, tree array<long>, n1 array<long>, n2 array<long>, n3 array<long>"


def _sketcher(k: int, trees: int, threshold: float, seed: int):
    def sketch_some(texts: Texts) -> pa.StructArray:
        sets = shingle_sets(texts, k, seed)
        n = np.array([len(x) for x in sets], dtype=np.int64)
        full = np.flatnonzero(n)
        keys, sigs = np.full(len(n), b"", dtype=object), np.full(len(n), b"", dtype=object)
        ends, nodes = np.zeros(len(n) + 1, dtype=np.int32), np.zeros((0, LEVELS + 1), dtype=np.uint64)
        if len(full):
            tokens = minwise([sets[i] for i in full], trees * LEVELS * 2, 1)
            owner, nodes = _paths(tokens, trees, 1 / threshold - 1)
            ends = np.searchsorted(full[owner], np.arange(len(n) + 1)).astype(np.int32)
            short = (tokens >> np.uint64(40)).astype(np.uint8)
            keys[full] = [set_key(sets[i]) for i in full]
            sigs[full] = [x.tobytes() for x in short]
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(nodes[:, i]).view(np.int64))) for i in range(LEVELS + 1)]
        return pa.StructArray.from_arrays([pa.array(n), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), *lists], ["n_shingles", "key", "sig", "tree", "n1", "n2", "n3"])

    def sketch(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [sketch_some(part) for part in Texts(column).groups()]
            yield pa.concat_arrays(parts) if parts else sketch_some(Texts([]))
            del column, parts
        give_back()

    return F.arrow_udf(sketch, _SKETCH)


# --- comparison of groups ---------------------------------------------------------------


def spanning_links(ids: np.ndarray, labels: np.ndarray, similar: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect all similar pairs of one group, beyond what ``labels`` connect already.

    ``similar(x, rows)`` tells which of ``rows`` are similar to row ``x``.  Breadth first:
    what joins a component is compared with what is still outside, and with nothing else.
    """
    links, todo = [], np.arange(len(ids))
    while len(todo) > 1 and (labels[todo] != labels[todo[0]]).any():
        wave, todo = [todo[0]], todo[1:]
        while wave and len(todo):
            x = wave.pop()
            same = labels[todo] == labels[x]
            near = same.copy()
            apart = np.flatnonzero(~same)
            if not len(apart):
                return links
            hit = apart[similar(x, todo[apart])]
            near[hit] = True
            found, one = np.unique(labels[todo[hit]], return_index=True)
            links.extend((int(ids[x]), int(ids[todo[hit[i]]])) for i in one)
            if len(found):  # the whole of a label that is met is connected now
                near |= np.isin(labels[todo], found)
            wave.extend(todo[near])
            todo = todo[~near]
    return links


def _link_frame(links: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame({"a": np.array([x for x, _ in links], dtype=np.int64), "b": np.array([y for _, y in links], dtype=np.int64)})


def _whole_groups(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Consecutive rows of equal (key, chunk), no group cut; with a mark at each group's first row."""
    held: list[pd.DataFrame] = []
    for pdf in parts:
        if not len(pdf):
            continue
        key, chunk = pdf["key"].to_numpy(), pdf["chunk"].to_numpy()
        new = np.ones(len(pdf), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])
        if held:
            new[0] = key[0] != held[-1]["key"].iloc[-1] or chunk[0] != held[-1]["chunk"].iloc[-1]
        cuts = np.flatnonzero(new)
        if len(cuts) and (held or cuts[-1] > 0):
            held.append(pdf.iloc[: cuts[-1]])
            yield _marked(held)
            held = [pdf.iloc[cuts[-1] :]]
        else:
            held.append(pdf)
    if held:
        yield _marked(held)


def _marked(held: list[pd.DataFrame]) -> tuple[pd.DataFrame, np.ndarray]:
    pdf = pd.concat(held, ignore_index=True)
    key, chunk = pdf["key"].to_numpy(), pdf["chunk"].to_numpy()
    new = np.ones(len(pdf), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])
    return pdf, new


def _near_pairs(ids: np.ndarray, labels: np.ndarray, sigs: np.ndarray, group: np.ndarray, bar: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of small groups whose signatures agree in ``bar`` places: rows side by side at every distance."""
    a, b = [], []
    ends = np.searchsorted(group, group, side="right")
    at = np.arange(len(ids))
    for step in range(1, len(ids)):
        at = at[at + step < ends[at]]
        if not len(at):
            break
        pairs = at[labels[at] != labels[at + step]]
        pairs = pairs[(sigs[pairs] == sigs[pairs + step]).sum(axis=1, dtype=np.uint8) >= bar]
        a.append(ids[pairs])
        b.append(ids[pairs + step])
    return (np.concatenate(a), np.concatenate(b)) if a else (ids[:0], ids[:0])


def _signature_linker(bar: int):
    """Links of rows (key, chunk, rep, label, sig) whose signatures agree in ``bar`` places, group by group; a spanning forest of each batch."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, new in _whole_groups(parts):
            ids, labels = pdf["rep"].to_numpy(), pdf["label"].to_numpy()
            sigs = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint8).reshape(len(ids), -1)
            starts = np.flatnonzero(new)
            number = np.cumsum(new) - 1
            pivot = starts[number]
            near = (labels == labels[pivot]) | ((sigs == sigs[pivot]).sum(axis=1, dtype=np.uint8) >= bar)
            across = near & (labels != labels[pivot])
            a, b = [ids[pivot[across]]], [ids[across]]
            sizes = np.diff([*starts, len(ids)])
            open_ = np.zeros(len(starts), dtype=bool)
            open_[number[~near]] = True  # the first row did not settle these
            little = np.flatnonzero((open_ & (sizes > 2) & (sizes <= LEAF))[number])
            x, y = _near_pairs(ids[little], labels[little], sigs[little], number[little], bar)
            a.append(x)
            b.append(y)
            for g in np.flatnonzero(open_ & (sizes > LEAF)):
                at = slice(starts[g], starts[g] + sizes[g])
                mine = sigs[at]
                found = _link_frame(spanning_links(ids[at], labels[at], lambda x, rows, m=mine: (m[rows] == m[x]).sum(axis=1, dtype=np.uint8) >= bar))
                a.append(found["a"].to_numpy())
                b.append(found["b"].to_numpy())
            v, low = labels_of(np.concatenate(a), np.concatenate(b))
            yield pd.DataFrame({"a": v, "b": low})[v != low]
        give_back()

    return run


def linked(x: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether set ``x`` and each of ``others`` (sorted, not empty) have 100 * intersection >= percent * union."""
    flat = np.concatenate(others)
    at = np.searchsorted(x, flat)
    hit = x[np.minimum(at, len(x) - 1)] == flat
    sizes = np.array([len(o) for o in others])
    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * both >= percent * (len(x) + sizes - both)


def _exact_linker(bar: int, percent: int):
    """Links of rows (key, chunk, rep, label, sig, shingles) confirmed on full sets, group by group."""

    def confirm(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in pdf["shingles"]]
        sizes = np.array([len(s) for s in sets])
        sigs = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint8).reshape(len(sets), -1)

        def similar(x: int, rows: np.ndarray) -> np.ndarray:
            out = (100 * np.minimum(sizes[rows], sizes[x]) >= percent * np.maximum(sizes[rows], sizes[x])) & ((sigs[rows] == sigs[x]).sum(axis=1) >= bar)
            where = np.flatnonzero(out)
            for i in range(0, len(where), 256):
                out[where[i : i + 256]] = linked(sets[x], [sets[y] for y in rows[where[i : i + 256]]], percent)
            return out

        return _link_frame(spanning_links(pdf["rep"].to_numpy(), pdf["label"].to_numpy(), similar))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, new in _whole_groups(parts):
            cuts = [*np.flatnonzero(new), len(pdf)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                yield confirm(pdf.iloc[i:j].drop_duplicates("rep"))
            del pdf
        give_back()

    return run


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the label of ``rep``: its component's, or itself."""
    rows = rows.drop("label")
    if labels is None:
        return rows.withColumn("label", F.col("rep"))
    return rows.join(small(labels), rows.rep == labels.v, "left").withColumn("label", F.coalesce("label", "rep")).drop("v")


def _merge(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(v, label): components of ``links`` together with what ``labels`` connect."""
    links = links.select("a", "b")
    return components(links if labels is None else links.unionByName(labels.select(F.col("v").alias("a"), F.col("label").alias("b"))), forests=True)


def _chunks_together(large: DataFrame, links_in: Callable[[DataFrame], DataFrame], labels: DataFrame) -> DataFrame:
    """(v, label) after comparing what the chunks of each ``key`` of ``large`` (key, chunk, chunks, rep) leave apart.

    ``large`` is a written table; ``links_in`` finds the links within groups (key, chunk, rep, label).
    One document of each connected part of each chunk comes first, and what is still apart meets all chunks.
    """
    if large.isEmpty():
        return labels
    rows = _labelled(large.select("key", "chunk", "chunks", "rep"), labels)
    parts = rows.groupBy("key", "chunk", "chunks", "label").agg(F.min("rep").alias("rep"))
    parts = parts.withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("chunks")))
    labels = _merge(links_in(parts.select("key", "chunk", "rep", "label")), labels)
    return _merge(links_in(_across(large, labels)), labels)


def _across(large: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, chunk, rep, label): groups in which all pairs of one key and different labels meet.

    Of such a pair one is outside the key's commonest label: those documents, in parts of
    about a chunk, meet every chunk, and ``chunk`` numbers the pairs of part and chunk.
    """
    known = write_table(_labelled(large.select("key", "chunk", "chunks", "rep"), labels))
    tops = known.groupBy("key", "label").count().groupBy("key").agg(F.max_by("label", F.struct("count", "label")).alias("top"), F.sum("count").alias("all"))
    outside = write_table(known.join(tops, "key").where("label <> top").select("key", "rep", "chunk", "chunks", "label", "all"))
    parts = write_table(outside.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * F.first("chunks") / F.first("all")).alias("parts")))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    pool = known.join(small(parts), "key").select("key", "rep", "chunk", "chunks", "label", upto("parts").alias("part"))
    probe = outside.join(small(parts), "key").withColumn("part", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("parts")))
    probe = probe.withColumn("other", upto("chunks")).where("other <> chunk")  # it is in its own chunk's pool
    groups = pool.unionByName(probe.select("key", "rep", F.col("other").alias("chunk"), "chunks", "label", "part"))
    return groups.select("key", (F.col("part") * F.col("chunks") + F.col("chunk")).alias("chunk"), "rep", "label")


def _bar(threshold: float, width: int) -> int:
    # Signatures agree by chance once in 256 places: counted in the bound's favour, as it only adds candidates.
    return math.floor(width * threshold - SIGNATURE_SLACK * math.sqrt(width * threshold * (1 - threshold)))


def _coarse(reps: DataFrame, threshold: float, width: int, n: int) -> DataFrame:
    """(v, label): representatives in coarse components of two or more. ``n``: rows of ``reps``."""
    bar, tasks = _bar(threshold, width), max(int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // TASK_ROWS)
    first = lambda c: (F.col("i") == 0) | (F.array_position(F.col(c), F.col(f"p.{c}")) == F.col("i") + 1)

    def paths(rows: DataFrame, *more: str) -> DataFrame:
        rows = rows.select("rep", *more, F.posexplode(F.arrays_zip("tree", "n1", "n2", "n3")).alias("i", "p"), "n1", "n2")
        return rows.select("rep", *more, "p.tree", "p.n1", "p.n2", "p.n3", first("n1").alias("f1"), first("n2").alias("f2"))

    nothing = reps.sparkSession.createDataFrame([(None, 0)], "key long, count long")

    def over(keys: DataFrame, most: int) -> DataFrame:
        """Nodes of more than ``most`` documents, and a row that matches no node: an empty table would change the plan."""
        return write_table(keys.groupBy("key").count().where(F.col("count") > most).unionByName(nothing))

    big1 = over(reps.select(F.explode(F.array_distinct("n1")).alias("key")), LEAF).select(F.col("key").alias("k1"))
    two = paths(reps).where("f2").join(small(big1), F.col("n1") == F.col("k1"), "left_semi")
    big2 = over(two.select(F.col("n2").alias("key")), LEAF).select(F.col("key").alias("k2"))
    three = paths(reps).join(small(big2), F.col("n2") == F.col("k2"), "left_semi")
    big3 = over(three.select(F.col("n3").alias("key")), CHUNK).select(F.col("key").alias("k3"), F.ceil(F.col("count") / CHUNK).alias("chunks"))

    def ends(rows: DataFrame, *more: str) -> DataFrame:
        """(key, chunk, chunks, rep, tree, ...) of the nodes that end branches."""
        rows = paths(rows, *more).join(small(big1), F.col("n1") == F.col("k1"), "left").join(small(big2), F.col("n2") == F.col("k2"), "left")
        rows = rows.where(F.when(F.col("k1").isNull(), F.col("f1")).when(F.col("k2").isNull(), F.col("f2")).otherwise(True))
        rows = rows.withColumn("key", F.when(F.col("k1").isNull(), F.col("n1")).when(F.col("k2").isNull(), F.col("n2")).otherwise(F.col("n3")))
        rows = rows.join(small(big3), F.col("key") == F.col("k3"), "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        return rows.select("key", F.pmod(F.xxhash64("rep"), F.col("chunks")).alias("chunk"), "chunks", "rep", "tree", *more)

    def linked_rows(rows: DataFrame) -> DataFrame:
        rows = rows.select("key", "chunk", "rep", "label", "sig").repartition(tasks, F.col("key"), F.col("chunk")).sortWithinPartitions("key", "chunk", "rep")
        return rows.mapInPandas(_signature_linker(bar), "a long, b long")

    early = F.col("tree") < FIRST_TREES
    labels = _merge(linked_rows(ends(_labelled(reps, None), "label", "sig").where(early)), None)
    labels = _merge(linked_rows(ends(_labelled(reps, labels), "label", "sig").where(~early)), labels)
    if big3.where("k3 is not null").isEmpty():
        return labels
    large = write_table(ends(reps).where("chunks > 1").select("key", "chunk", "chunks", "rep"))
    return _chunks_together(large, lambda groups: linked_rows(groups.join(reps.select("rep", "sig"), "rep")), labels)


def _set_maker(k: int, seed: int):
    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            keys, rest = batch.column("set"), batch.drop_columns(["set", "text"])
            for part in Texts(batch.column("text")).groups():
                sets = shingle_sets(part, k, seed)
                right = [len(s) > 0 and set_key(s) == keys[part.first + i].as_py() for i, s in enumerate(sets)]
                some = rest.slice(part.first, len(part)).append_column("shingles", pa.array([s.tobytes() for s in sets], pa.binary()))
                yield some.filter(pa.array(right))
            del batch, rest
        give_back()

    return make


_SETS = "key long, chunk long, chunks long, rep long, sig binary, shingles binary"


def _confirmed(texts: DataFrame, reps: DataFrame, coarse: DataFrame, k: int, percent: int, bar: int, seed: int) -> DataFrame:
    """(v, label): components of the links that full sets confirm within coarse components."""
    held = coarse.join(reps.select(F.col("rep").alias("v"), F.col("key").alias("set"), "sig", "n_shingles"), "v")
    count = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES))
    sizes = held.groupBy("label").agg(F.count(F.lit(1)).alias("n"), count.alias("chunks")).where("n > 1").select("label", "chunks")
    members = held.join(sizes, "label").select(F.col("label").alias("key"), F.pmod(F.xxhash64("v"), F.col("chunks")).alias("chunk"), "chunks", F.col("v").alias("rep"), "set", "sig")
    members = write_table(members)

    def sets(rows: DataFrame) -> DataFrame:
        found = texts.join(small(rows), texts.doc_id == F.col("rep")).select("key", "chunk", "chunks", "rep", "sig", "set", "text")
        return found.mapInArrow(_set_maker(k, seed), _SETS)

    def confirm(rows: DataFrame) -> DataFrame:
        rows = rows.repartition(F.col("key"), F.col("chunk")).sortWithinPartitions("key", "chunk", "rep")
        return rows.mapInPandas(_exact_linker(bar, percent), "a long, b long")

    columns = ("key", "chunk", "rep", "label", "sig", "shingles")
    links = confirm(sets(members.where("chunks = 1")).withColumn("label", F.col("rep")).select(*columns))
    if members.where("chunks > 1").isEmpty():
        return components(links, forests=True)
    large = write_table(sets(members.where("chunks > 1")))
    known = large.select("rep", "sig", "shingles")
    inside = _merge(confirm(large.withColumn("label", F.col("rep")).select(*columns)), None)
    done = _chunks_together(large.select("key", "chunk", "chunks", "rep"), lambda groups: confirm(groups.join(known, "rep").select(*columns)), inside)
    return _merge(links, done)


def verdicts(docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, digest, n_shingles, component_id) of every row of ``docs`` (doc_id, text); ``digest``: MD5 of the text."""
    trees, percent = trees_for(threshold, recall), round(100 * threshold)
    width = trees * LEVELS * 2
    texts, seed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), corpus_seed(docs)
    lean = texts.withColumn("s", _sketcher(k, trees, threshold, seed)(F.col("text")))
    lean = write_table(lean.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "s.*"))
    named = lean.where("n_shingles > 0 and doc_id is not null")
    # One id may stand for several sets (repeated ids): links then run through the id, as its rows are one document.
    copies = write_table(named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("rep")).where("n > 1").select(F.col("key").alias("set"), F.col("rep").alias("r")))
    reps = named.join(small(copies), F.col("key") == F.col("set"), "left").withColumn("rep", F.coalesce("r", "doc_id")).where("doc_id = rep")
    reps = reps.select("rep", "key", "sig", "n_shingles", "tree", "n1", "n2", "n3", "set")
    reps = write_table(reps.where("set is null").unionByName(reps.where("set is not null").dropDuplicates(["set"])).drop("set"))
    coarse = _coarse(reps, threshold, width, reps.count())
    texts = texts.where("doc_id is not null")
    again = write_table(lean.where("doc_id is not null").groupBy("doc_id", "digest").count().where("count > 1").select("doc_id").distinct())
    if not again.isEmpty():  # of equal rows, one text will do
        again = small(again)
        texts = texts.join(again, "doc_id", "left_anti").unionByName(texts.join(again, "doc_id", "left_semi").distinct())
    found = _confirmed(texts, reps, coarse, k, percent, _bar(threshold, width), seed)
    owners = reps.select("key", "rep").join(small(found.withColumnRenamed("v", "rep")), "rep").select("key", "label")
    # Documents that share neither key nor label with another one are components by themselves.
    owners = copies.select(F.col("set").alias("key"), F.col("r").alias("rep")).join(owners, "key", "full")
    owners = write_table(owners.select("key", F.coalesce("label", "rep").alias("component")))
    judged = lean.where("n_shingles > 0").select("doc_id", "digest", "n_shingles", "key").join(small(owners), "key", "left").drop("key")
    empty = lean.where("n_shingles = 0").select("doc_id", "digest", "n_shingles", F.lit(None).cast("long").alias("component"))  # all share one key
    judged = judged.unionByName(empty)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return judged.select("doc_id", "digest", "n_shingles", component.alias("component_id"))


def _kept(component: str, doc_id: str) -> Column:
    return F.coalesce(F.col(component) == F.col(doc_id), F.lit(True))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` with ``n_shingles, component_id, kept``.

    ``threshold`` counts in whole percent.  ``component_id`` is the smallest doc_id
    (bigint) that links reach; ``kept`` marks one document of each component.
    """
    docs = docs.drop("n_shingles", "component_id", "kept")
    d, t = fresh(docs, "doc", "text")
    judged = verdicts(docs, k, threshold, recall).withColumnsRenamed({"doc_id": d, "digest": t}).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & F.unhex(F.md5(F.col("text").cast("binary"))).eqNullSafe(F.col(t))
    out = docs.join(judged, same).withColumn("kept", _kept("component_id", d))
    return out.drop(d, t)


def drop_near_duplicates(docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` without the rows that ``near_duplicates`` does not keep; texts move only if those are many."""
    d, t = fresh(docs, "doc", "text")
    judged = verdicts(docs, k, threshold, recall)
    gone = write_table(judged.where(~_kept("component_id", "doc_id")).select(F.col("doc_id").alias(d), F.col("digest").alias(t)).distinct())
    same = (F.col("doc_id").cast("long") == F.col(d)) & (F.unhex(F.md5(F.col("text").cast("binary"))) == F.col(t))
    return docs.join(small(gone), same, "left_anti")


def op5_chosen_path(spark, sf_dir: str) -> DataFrame:
    """Component of every document under links of 2-word shingle sets."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return verdicts(docs, k=2).select("doc_id", "n_shingles", "component_id", _kept("component_id", "doc_id").alias("kept"))
