"""Lexical search, WARC archives and prefix trees against brute force, on odd rows and small limits."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismarq.llm import lexical_search, prefix_tree, warc
from prismarq.sources.files import list_files, read_bytes, write_bytes
from prismarq.sources.shared import shared_folder

TERM = re.compile(lexical_search.TERM)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- lexical search ----------------------------------------------------------------------


def brute_search(docs, items, k):
    """Every document scored for every item."""
    words = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(map(bool, words)), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    out = []
    for item, text in items:
        asked, found = Counter(TERM.findall((text or "").translate(LOWER))), []
        for (doc, _), w in zip(docs, words, strict=True):
            tf, m = Counter(w), 25 + 75 * len(w) * n_docs // max(1, n_terms)
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t, q in asked.items() if t in tf)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, i, None if null else doc, -score) for i, (score, null, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(80)] + ["É", "ü9", "漢字", "UPPER", "upper", "x" * 700]
    docs = [(rng.randrange(1000), " ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=rng.randrange(1, 60)))) for _ in range(n)]
    docs += [(7, "same text here w3"), (7, "same text here w3"), (None, "same text here w3"), (5, None), (6, ""), (8, " .,-\n"), (9, "w1 " * 5000), (None, None)]
    docs += [(i, "many equal copies w2 w5") for i in range(2000, 2060)]
    items = [(1, "w3 w3 W5, upper!"), (1, "w3 w3 W5, upper!"), (2, None), (3, "nowhere"), (None, "same text"), (4, "many equal copies"), (5, "x" * 700 + " É w79"), (6, "")]
    return docs, items


@pytest.mark.parametrize(("shard_bytes", "slice_bytes", "step"), [(1 << 20, 1 << 20, 64), (700, 80, 1), (3000, 1 << 20, 3)])
def test_search(spark, shard_bytes, slice_bytes, step, monkeypatch):
    docs, items = corpus(150, step)
    monkeypatch.setattr(lexical_search, "STEP", step)
    index = lexical_search.build_index(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(3), shard_bytes)
    assert index.shards.count() > (20 if shard_bytes == 700 else 0)
    got = lexical_search.search(index, spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int"), 10, slice_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(docs, items, 10)


def test_search_without_documents_or_items(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = some.withColumnRenamed("doc_id", "item_id")
    assert lexical_search.search(lexical_search.build_index(nothing), items).count() == 0
    assert lexical_search.search(lexical_search.build_index(some), items.where("false")).count() == 0
    assert lexical_search.search(lexical_search.build_index(spark.createDataFrame([(1, None)], "doc_id long, text string")), items).count() == 0
    assert [tuple(r) for r in lexical_search.search(lexical_search.build_index(some), items).collect()] == brute_search([(1, "a b")], [(1, "a b")], 10)


def shard_of(texts, n_docs, n_terms, seed=5):
    data = [t.encode() for t in texts]
    view = lexical_search.Texts(data)
    return dict(zip(lexical_search._COLUMNS, lexical_search.build_shard(np.arange(len(data)), np.zeros(len(data), dtype=bool), view, n_docs, n_terms, seed), strict=True))


def test_tree_bounds_prune():
    """Ranges stay by falling impact in every node, and a rare term opens the path to its document, not all nodes."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(30)], k=40)) + (" needle" if i == 300 else "") for i in range(512)]
    row = shard_of(texts, 512, 512 * 40)
    tree, words = lexical_search.Tree(row), lexical_search.Dictionary(row)
    terms = [b"needle", b"w1", b"absent"]
    low, high = words.ranges(terms, *lexical_search._joined(terms))
    assert high[0] - low[0] == 1 and high[2] == low[2]
    for a, b in zip(words.starts[:-1], words.starts[1:], strict=True):
        assert (np.diff(tree.best[0, a:b]) <= 0).all()
    best = lexical_search.Best(1)
    opened = lexical_search.best_first(tree, low, high, np.array([5000, 1, 1]), best, step=1)
    assert tree.ids[300] == -best.heap[0][1] and opened <= 2 * tree.levels


def test_colliding_terms_take_another_seed(monkeypatch):
    """Terms that one hash takes for one are told apart by the second, and the shard is built with another seed."""
    plain, seen = lexical_search.hash_slices, []

    def weak(raw, starts, stops, seed):
        seen.append(seed)
        return plain(raw, starts, stops, seed) if seed != 5 else np.zeros(len(starts), dtype=np.uint64)

    monkeypatch.setattr(lexical_search, "hash_slices", weak)
    row = shard_of(["alpha beta", "beta gamma"], 2, 4)
    assert row["seed"] != 5 and 5 in seen and len(row["hashes"]) == 3 * 8


# --- WARC --------------------------------------------------------------------------------


PAGES = [
    (1, "http://www.example.com/a?x=1", "<p>one</p>"), (2, "https://example.com:8080/b#f", "<p>two</p>"), (3, "http://example.com/a b\nc", "<p>one</p>"), (9, "http://example.com/a", "<p>one</p>"),
    (9, "http://example.com/a", "<p>one</p>"), (None, "http://example.com/a", "<p>one</p>"), (4, None, None), (5, "no scheme", ""), (6, "http://user@Sub.Example.com/é漢", "é" * 3000), (7, "http://other.net", "<p>two</p>"),
    (8, "http://www.example.com/a?x=1", "again"),
]
SCHEMA = "page_id long, url string, html string, digest string"


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def roles(rows, least=0):
    """(page, bytes, digest, type, refers) by comparing all payloads."""
    groups = defaultdict(list)
    for p, _, t in rows:
        groups[(t or "").encode()].append(p)
    out = []
    for body, ids in groups.items():
        ids = sorted(ids, key=lambda p: (p is not None, p or 0), reverse=True)
        for i, p in enumerate(ids):
            first = i == 0 or len(body) < least
            out.append((p, len(body), warc.digest_of(body), "response" if first else "revisit", None if first else ids[0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("lines", [1, 3, 1000])
def test_archives(spark, lines, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    monkeypatch.setattr(warc, "PART_LINES", 2 * lines)
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    folder = shared_folder(spark)
    captures = warc.write_archives(pages(spark).repartition(2), folder)
    index = warc.build_index(captures, folder)
    everything = warc.read_records(warc.lookup(index, pages(spark)), folder)
    got = everything.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == roles(PAGES)
    held = {(r["page_id"], r["url"]): r["payload"] for r in everything.where("record_type = 'response'").collect()}
    assert all(bytes(body).decode() in {t or "" for p, u, t in PAGES if (p, u) == k} for k, body in held.items())
    one = warc.lookup(index, spark.createDataFrame([("http://www.example.com/a?x=1",), ("http://www.example.com/a?x=1",), ("http://www.example.com/zzz",)], "url string"))
    assert sorted(r["page_id"] for r in warc.read_records(one, folder, payload=False).collect()) == [1, 8]
    under = warc.lookup(index, spark.createDataFrame([("http://example.com/a",)], "url string"), prefix=True)
    assert sorted(str(r["page_id"]) for r in warc.read_records(under, folder).collect()) == ["3", "9", "9", "None"]
    files = [f for f in list_files(folder) if f.endswith(".warc.gz")]
    assert len(files) > 1 and all(gzip.decompress(read_bytes(f"{folder}/{f}")).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") for f in files)


def test_least_bytes_and_no_pages(spark):
    folder = shared_folder(spark)
    captures = warc.write_archives(pages(spark), folder, least_bytes=10)
    got = warc.read_records(warc.lookup(warc.build_index(captures, folder), pages(spark)), folder)
    got = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == roles(PAGES, 10)
    folder, none = shared_folder(spark), pages(spark).where("false")
    index = warc.build_index(warc.write_archives(none, folder), folder)
    assert index.parts == [] and warc.read_records(warc.lookup(index, pages(spark)), folder).count() == 0


def test_keys_and_damage(spark):
    rows = spark.createDataFrame([(u,) for u in ("http://www.Example.com:80/A?b", "https://u:p@a.b", "plain", None, "x://h/\t")], "url string")
    assert [r[0] for r in rows.select(warc.url_key(F.col("url"))).collect()] == ["com,example,www:80)/A?b", "b,a)", "plain", "", "h)/+"]
    folder = shared_folder(spark)
    captures = warc.write_archives(pages(spark, PAGES[:1]), folder)
    c = captures.first()
    data = bytearray(gzip.decompress(read_bytes(f"{folder}/{c['file']}", c["length"], c["start"])).replace(b"<p>one", b"<p>two"))
    write_bytes(f"{folder}/{c['file']}", bytes(c["start"]) + gzip.compress(bytes(data)))
    size = len(gzip.compress(bytes(data)))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_records(captures.withColumn("length", F.lit(size).cast("long")), folder).collect()


# --- prefix trees ------------------------------------------------------------------------


def brute_tree(rows):
    """Nodes of the rebuilt conversations, from all prefixes as tuples."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            symbol = hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).hexdigest()
            turns[c].append(((t is not None, t or 0), r or "", symbol, len((x or "").encode())))
    own = {c: [(s, b) for _, _, s, b in sorted(v)] for c, v in turns.items()}
    path = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        path[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members, ends, size = defaultdict(list), defaultdict(list), {}
    for c, p in path.items():
        names = tuple(s for s, _ in p)
        for d in range(len(p) + 1):
            members[names[:d]].append(c)
            size[names[:d]] = p[d - 1][1] if d else 0
        ends[names].append(c)
    order = {k: i for i, k in enumerate(sorted(members))}
    kids = Counter(k[:-1] for k in members if k)
    out = []
    for k, own_members in members.items():
        below = [x for x in members if x[: len(k)] == k]
        out.append((
            min(own_members), len(k), min(members[k[:-1]]) if k else None, len(own_members), kids[k], sum(kids[x] == 0 for x in below), sum((len(members[x]) - 1) * size[x] for x in below),
            hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest(), order[k], order[k] + len(below) - 1))
    return sorted(out, key=repr)


def tree_of(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(3)
    turns = prefix_tree.rows_of_turns(df)
    return sorted((tuple(r) for r in prefix_tree.encode(*prefix_tree.rebuild(turns)).collect()), key=repr)


@pytest.mark.parametrize(("block", "range_rows"), [(1024, 500_000), (2, 7)])
def test_tree(spark, block, range_rows, monkeypatch):
    monkeypatch.setattr(prefix_tree, "BLOCK", block)
    monkeypatch.setattr(prefix_tree, "RANGE_ROWS", range_rows)
    rng = random.Random(block)
    texts = ["a", "b", "", None, "é漢"]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for c in (*range(-7, 23), 40, 41) for t in range(rng.randrange(1, 12)) if c % 7 != 3 or t > 9]
    rows += [(c, None, "user", "first") for c in (1, 5, 6)] + [(2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "system", "z"), (None, 0, "user", "a")]
    rows += [(50, t, "user", "same") for t in range(40)] + [(55, t, "user", "same") for t in range(40)]
    rows.append((59, 0, "user", "lost"))  # turnless once rebuilt, if its family has no head
    assert tree_of(spark, rows) == brute_tree(rows)


def test_tree_of_nothing(spark):
    assert tree_of(spark, []) == [] and tree_of(spark, [(None, 1, "user", "x")]) == []


def test_colliding_nodes_take_another_salt(spark, monkeypatch):
    """Hashes that stand for two sequences are seen, and other ones are taken."""
    keyed, tried = prefix_tree._keyed, []

    def weak(turns, salt):
        tried.append(salt)
        out = keyed(turns, salt)
        return out.withColumns({"k1": F.lit(1).cast("long"), "k2": F.lit(1).cast("long")}) if len(tried) == 1 else out

    monkeypatch.setattr(prefix_tree, "_keyed", weak)
    rows = [(c, t, "user", str((c * t) % 3)) for c in range(5) for t in range(4)]
    assert tree_of(spark, rows) == brute_tree(rows) and len(tried) == 2
