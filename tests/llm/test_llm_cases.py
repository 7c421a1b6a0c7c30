"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names, and what each operator is for."""

import io
import struct
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prismarq.llm import common, compression_classifier, components, decontaminate, html_extract, mixing, near_dedup, quality_rules, sharding, substring_dedup, token_files, url_filter
from test_llm_queries import brute_components, brute_repeats

KIND = "doc_id bigint, text string, source string, __sketch int, shard int, n_words int, score string"
LONG = "lorem ipsum dolor sit amet " * 9000


def odd(spark, n=None):
    """Documents with every odd case; other columns clash with outputs and working names."""
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(400)]
    text = lambda k: " ".join(rng.choice(words, k))
    base = text(120)
    rows = [
        (1, base, "a"), (2, base, "a"), (3, base + " tail", None), (4, None, "a"), (5, "", "b"), (6, " \n\t", "b"), (7, "one", None), (8, "one", "b"),
        (None, base, "a"), (None, None, None), (9, LONG, "c"), (10, text(150), "c"), (10, text(150), "c"), (1, base, "a"), (11, "é ü 漢字 " * 30, "ü"), (12, base.upper(), "b"),
    ]
    rows = [(*r, i, 5, 6, "x") for i, r in enumerate(rows)]
    return spark.createDataFrame(rows if n is None else rows[:n], KIND)


def nothing(spark):
    return spark.createDataFrame([], KIND)


def test_classifier(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 400)] + [(None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame([(i, ("### *** $$$ " if i % 2 == 0 else "plain words in a row ") * (i % 7 + 3)) for i in range(1, 400)], "doc_id bigint, text string")
    model = compression_classifier.fit(compression_classifier.labelled_sample(docs, labels))
    got = compression_classifier.classify(odd(spark), model)
    assert got.count() == 16 and set(odd(spark).columns) - {"score"} <= set(got.columns) and got.where("score is null or score < 0 or score > 1").isEmpty()
    seen = compression_classifier.classify(docs, model).join(labels, "doc_id").where("predicted = quality").count()
    assert seen > 380
    assert len(compression_classifier.labelled_sample(docs, labels, most=50)) == 50
    assert sum(len(t) for t, _, _ in compression_classifier.labelled_sample(docs, labels, most_bytes=500)) <= 500
    empty = compression_classifier.fit(compression_classifier.labelled_sample(nothing(spark), labels))
    assert compression_classifier.classify(odd(spark), empty).select("score").distinct().count() == 1
    assert compression_classifier.classify(nothing(spark), model).count() == 0


def test_sample_is_filled_in_hash_order(spark):
    """A byte budget that runs out takes the first labels of the hash order, not of the ids."""
    docs = spark.createDataFrame([(i, f"{i:05d}" * 20) for i in range(400)], "doc_id bigint, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    free = labels.where(~compression_classifier.held_out(F.col("doc_id"))).withColumn("o", F.xxhash64("doc_id", "quality"))
    want = [f"{r['doc_id']:05d}".encode() * 20 for r in free.orderBy("o").limit(30).collect()]
    assert [t for t, _, _ in compression_classifier.labelled_sample(docs, labels, most_bytes=3000)] == want


def test_repeated_documents_against_labels(spark):
    """A label whose document is there a thousand times is one row, with the shortest text."""
    docs = spark.range(3000).selectExpr("id % 3 + 2 AS doc_id", "repeat('word ', int(id % 3 + 1 + id % 2)) AS text")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2, 5)], "doc_id bigint, quality int")
    got = compression_classifier.labelled_sample(docs, labels)
    free = [r["doc_id"] for r in labels.where(~compression_classifier.held_out(F.col("doc_id"))).collect()]
    assert sorted((t, q) for t, q, _ in got) == sorted((b"word " * (i - 1), i % 2) for i in free)


def test_scores_against_plain_compression():
    """The score by the definition: two compressed sizes, and a logistic curve fitted by plain descent."""
    import zstandard

    rng = np.random.default_rng(11)
    words = {q: [f"{'good' if q else 'bad'}{i}" for i in range(60)] for q in (0, 1)}
    text = lambda q: " ".join(rng.choice(words[q] + words[1 - q][:40], int(rng.integers(5, 80)))).encode()
    rows = [(text(i % 2), i % 2, i % 3 == 0) for i in range(400)]
    model = compression_classifier.fit(rows)
    sizes = {}
    for name, kind in (("good", model.good), ("bad", model.bad)):
        packer = zstandard.ZstdCompressor(level=compression_classifier.LEVEL, dict_data=zstandard.ZstdCompressionDict(kind), write_content_size=False, write_dict_id=False)
        sizes[name] = [len(packer.compress(t)) for t, _, _ in rows]
    x = np.array([(b - g) / (len(t) + 200) for (t, _, _), g, b in zip(rows, sizes["good"], sizes["bad"])])
    aside = np.array([a for _, _, a in rows])
    y, scale = np.array([q for _, q, _ in rows], dtype=float)[aside], x[aside].std()
    w, b = 0.0, 0.0
    for _ in range(60_000):
        p = 1 / (1 + np.exp(-(w * x[aside] / scale + b)))
        w, b = w - 0.02 * ((p - y) @ (x[aside] / scale) + 0.05 * w), b - 0.02 * (p - y).sum()
    want = 1 / (1 + np.exp(-(w * x / scale + b)))
    got = compression_classifier._scores(model, [t for t, _, _ in rows])
    np.testing.assert_allclose(got, want, atol=2e-3)
    assert (((got >= 0.5) == [q for _, q, _ in rows])[~aside]).mean() > 0.9


def test_mixing(spark):
    got = mixing.mix_sources(odd(spark).withColumnRenamed("n_words", "taken")).toPandas()
    assert len(got) == 16 and (got.taken == got.copies * got["size"]).all() and (got.taken <= 3 * got["size"]).all()
    assert set(got[got.source.isna()].source_size) == {122}
    assert mixing.mix_sources(nothing(spark)).count() == 0
    many = spark.createDataFrame([(i, "w " * (1 + i * 7 % 50), "s%d" % (i % 3)) for i in range(900)], "doc_id bigint, text string, source string")
    mixed = mixing.mix_sources(many).toPandas()
    for _, part in mixed.groupby("source"):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 0.01 * part.target.iloc[0]
    assert mixing.repeat_rows(mixing.mix_sources(many), many.columns).count() == mixed.copies.sum()


def brute_rates(sizes: np.ndarray, rest: float) -> np.ndarray:
    """Inclusion probabilities in a line over size classes, around the share that is wanted, whose words add up to ``rest``."""
    r, size_class = rest / sizes.sum(), np.array([len(f"{n:b}") for n in sizes])
    below = np.average(size_class, weights=sizes) - size_class
    p = r + r * (1 - r) * below / abs(below).max()
    assert abs((p * sizes).sum() - rest) < 1e-6 * rest and 0 < p.min() < p.max() < 1
    return p


def test_inclusion():
    """Over many seeds each document is drawn as often as its probability says, and words come near the target."""
    rng = np.random.default_rng(12)
    sizes = np.clip(rng.lognormal(3.3, 0.8, 600), 2, 250).astype(int)
    docs = pd.DataFrame({"doc_id": range(600), "text": ["w " * n for n in sizes], "source": [f"s{i % 3}" for i in range(600)]})
    con = duckdb.connect()
    con.register("documents", docs)
    runs, counts, off = 250, np.zeros(600), []
    for seed in range(runs):
        got = con.execute(mixing.oracle(f"t{seed}")).fetch_df().sort_values("doc_id")
        counts += got.taken.to_numpy() / sizes
        by = got.groupby(docs.source.to_numpy()).agg(taken=("taken", "sum"), target=("target", "first"))
        off.append((abs(by.taken - by.target) / by.target).max())
    assert np.median(off) < 0.01 and max(off) < 0.06
    for s in ("s0", "s1", "s2"):
        mine = (docs.source == s).to_numpy()
        target = got.target.to_numpy()[mine][0]
        whole = target // sizes[mine].sum()
        p = brute_rates(sizes[mine], target - whole * sizes[mine].sum())
        drawn = counts[mine] / runs - whole
        error = (drawn - p) / np.sqrt(np.maximum(p * (1 - p), 0.01) / runs)
        assert abs(drawn.mean() - p.mean()) < 0.02 and abs(error).max() < 6


def test_mixing_of_equal_rows(spark):
    """Rows without ids: different texts are drawn one by one, and a group of equal rows in part."""
    rows = [(None, "one two three four five", "a")] * 300 + [(None, f"x{i} two three four five", "b") for i in range(300)] + [(i, "w " * 50, "c") for i in range(60)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).toPandas()
    for s, tolerance in (("a", 0.15), ("b", 0.01), ("c", 0.02)):
        part = got[got.source == s]
        assert abs(part.taken.sum() - part.target.iloc[0]) <= tolerance * part.target.iloc[0]
    assert set(got[got.source == "a"].copies) <= {0, 1, 2, 3}


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 10), ("c", 1000), (None, 4)], "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    shares, left, weight = {"a": 30.0, "b": 30.0, None: 12.0}, 1024.0 - 72, None  # all small sources stop at three times their size
    assert got == pytest.approx(shares | {"c": left}) and weight is None


def test_repeats(spark):
    docs = odd(spark)
    rows = docs.select("doc_id", "text").collect()
    got = substring_dedup.remove_repeats(docs.withColumnRenamed("score", "removed"))
    found = sorted((r["doc_id"] or 0, bytes(r["kept_bytes"])) for r in got.collect())
    texts = [(r["text"] or "").encode() for r in rows]
    hits = brute_repeats(texts, 200)
    want = sorted((r["doc_id"] or 0, np.frombuffer(t, dtype=np.uint8)[~h].tobytes()) for r, t, h in zip(rows, texts, hits))
    assert found == want
    assert substring_dedup.remove_repeats(nothing(spark)).count() == 0


@pytest.mark.parametrize("length", [8, 16, 21])
def test_multikey_sort(length):
    rng = np.random.default_rng(2)
    flat = rng.integers(0, 2, 900, dtype=np.uint8)
    at = rng.permutation(len(flat) - length)[:500]
    keys = [flat[i : i + length].tobytes() for i in at]
    assert substring_dedup.equal_windows(flat, at, length).tolist() == [keys.count(k) > 1 for k in keys]


def test_buckets():
    """Buckets follow the order of all three columns; equal suffixes share one, and a hot lead spreads over several."""
    rng = np.random.default_rng(7)
    rows = sorted({tuple(x) for x in rng.integers(-2, 3, (400, 3)).tolist()} | {(0, 0, int(i)) for i in rng.integers(-(1 << 60), 1 << 60, 300)})
    splitters = [rows[i] for i in range(0, len(rows), 9)]
    got = substring_dedup.buckets_of([np.array(c) for c in zip(*rows)], [np.array(c) for c in zip(*splitters)])
    assert got.tolist() == [sum(s < r for s in splitters) for r in rows]


def test_grams_beyond_boundaries(spark, monkeypatch):
    """Buckets of a few rows: grams of a shared passage, with a context in each text, go on over many boundaries."""
    monkeypatch.setattr(substring_dedup, "ROWS_PER_BUCKET", 1)
    rng = np.random.default_rng(8)
    text = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared = text(330)
    rows = [(i, text(int(rng.integers(1, 200))) + shared[: int(rng.integers(190, 331))] + text(int(rng.integers(1, 200)))) for i in range(70)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    hits = brute_repeats([t.encode() for _, t in rows], 200)
    want = [np.frombuffer(t.encode(), dtype=np.uint8)[~h].tobytes() for (_, t), h in zip(rows, hits)]
    assert [bytes(r["kept_bytes"]) for r in got.orderBy("doc_id").collect()] == want
    assert sum(h.sum() for h in hits) > 9000


def test_texts_of_two_letters(spark):
    """Runs that a polynomial hash modulo 2**64 cannot tell apart are no repeats."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id bigint, text string")
    got = {r["doc_id"]: bytes(r["kept_bytes"]) for r in substring_dedup.remove_repeats(docs).collect()}
    hits = brute_repeats([a.encode(), b.encode()], 200)
    assert got == {i: np.frombuffer(t.encode(), dtype=np.uint8)[~h].tobytes() for i, t, h in zip((1, 2), (a, b), hits)}


def test_text_beyond_packed_positions(spark, monkeypatch):
    """A text with more places than a packed key can number is cut into overlapping pieces."""
    rng = np.random.default_rng(10)
    text = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    passage = text(260)
    long = text(900) + passage + text(700) + passage + text(500)
    want = substring_dedup.find_runs([long.encode(), passage.encode()])
    monkeypatch.setattr(substring_dedup, "_POSITION", np.uint64((1 << 10) - 1))
    got = substring_dedup.find_runs([long.encode(), passage.encode()])
    spread = lambda r: {(int(o), int(s) + i) for o, s, n in zip(r["owner"], r["start"], r["n"]) for i in range(n)}
    assert spread(got) == spread(want) == {(0, i) for i in range(len(long) - 199)} | {(1, i) for i in range(61)}
    assert (got["off"] + 50 <= got["n"] - 1 + 200).all()


PAGE = """<html><body><header><h1>Site</h1></header><nav><a href=x>Home, sweet, home</a></nav><div class="cookie-banner">We, use, cookies, a, lot.</div>
<div class="layout with-sidebar"><main><article><h1>Title &amp; more</h1><p>First, long paragraph with <a href=x>a link</a>, and text.<p>Second   one&nbsp;here<br>on.<ul><li>x<li>y</ul></article>
<aside><p>Side, bar, with, many, commas, in, it.</p></aside></main></div><section id="comments"><article class="comment"><p>I, liked, it, a, lot, really.</p></article></section>
<form><p>Name, please</p></form><script>var a = "<p>no</p>";</script><footer>(c)</footer></body></html>"""


def test_html_without_article():
    """Scoring finds the container by itself, and a constant score would not."""
    story = "".join(f"<p>Sentence {i}, with a clause, and another one that goes on for a while.</p>" for i in range(6))
    page = f"<body><div><div><a href=x>Home</a> <a href=y>More, links, here</a></div><div>Short teaser.</div></div><div><div>{story}</div><div><a href=z>Next, page</a></div></div></body>"
    want = "\n".join(f"Sentence {i}, with a clause, and another one that goes on for a while." for i in range(6))
    assert html_extract.main_text(page) == want


def test_html_fails_without_scores(monkeypatch):
    story = "".join(f"<p>Sentence {i}, with a clause, and another one that goes on for a while.</p>" for i in range(6))
    page = f"<body><div><p>Teaser.</p></div><div>{story}</div></body>"
    right = html_extract.main_text(page)
    score = html_extract._Tree.score
    monkeypatch.setattr(html_extract._Tree, "score", lambda self: [0.0 * x for x in score(self)])
    assert html_extract.main_text(page) != right


def test_html_names_weigh():
    page = """<body><article><header><h2><a><b><i><u><em>Title</em></u></i></b></a></h2></header><div class="related-work"><p>Related work, in our field, is broad.</p></div>
    <div class="related-posts"><p>Another post, to read, today.</p></div><div class="shared-notice-links"><a href=x>One, two, three</a></div><div class="comment-box"><p>I, too, liked, it.</p></div></article></body>"""
    assert html_extract.main_text(page) == "Title\nRelated work, in our field, is broad."


def test_html_in_linear_time():
    import time

    pages = [lambda n: "<div>text, here" * n, lambda n: "<i>" * n + "</b>" * n + "<h1>x" * n, lambda n: "<p>a<b>" * n + "</div>" * n, lambda n: "<li>x<ul>" * n, lambda n: "<table><tr><td>" * n + "x"]
    for page in pages:
        began = time.perf_counter()
        html_extract.main_text(page(4000))
        short = time.perf_counter() - began
        began = time.perf_counter()
        html_extract.main_text(page(32000))
        assert time.perf_counter() - began < 24 * short + 1


def test_html(spark):
    body = "Title & more\nFirst, long paragraph with a link, and text.\nSecond one here on.\nx\ny"
    assert html_extract.main_text(PAGE) == body
    for text, want in (("", ""), (None, ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<!-- x", ""), ("<script>never closed", ""), ("a < b", "a < b"), ("<div>" * 3000 + "deep", "deep")):
        assert html_extract.main_text(text) == want
    pages = spark.createDataFrame([(1, PAGE, "x"), (1, PAGE, "x"), (None, None, "y")], "page_id bigint, html string, text string")
    assert [r["n"] for r in html_extract.extract_text(pages).selectExpr("length(text) n").collect()] == [len(body), len(body), 0]
    assert html_extract.extract_text(pages.where("false")).count() == 0


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, k):
    docs = odd(spark).withColumnRenamed("n_words", "component_id")
    got = near_dedup.near_duplicates(docs, k=k).toPandas()
    named = got[got.doc_id.notna() & (got.doc_id != 10)]
    want = brute_components({int(i): t for i, t in zip(named.doc_id, named.text)}, k)
    for r in named.itertuples():
        assert (r.n_shingles, r.component_id, r.kept) == (*want[int(r.doc_id)], want[int(r.doc_id)][1] == r.doc_id)
    assert got[got.doc_id.isna()].kept.all() and got[got.doc_id.isna()].component_id.isna().all() and len(got) == 16
    assert near_dedup.near_duplicates(nothing(spark), k=k).count() == 0


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """A group larger than a block, of copies that differ in a word or so each, next to texts that share a passage."""
    rng = np.random.default_rng(3)
    base, rows = rng.integers(0, 500, 60), []
    for i in range(90):
        w = base.copy()
        w[rng.integers(0, 60, 2)] = rng.integers(500, 900, 2)
        rows.append((i, " ".join(f"w{x}" for x in w)))
    rows += [(100 + i, " ".join(f"w{x}" for x in [*base[:20], *rng.integers(0, 2000, 40)])) for i in range(40)]
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "LEAF", 8)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), k=2).toPandas().set_index("doc_id")
    want = brute_components(dict(rows), 2)
    assert all(got.component_id[i] == c for i, (_, c) in want.items())


def test_near_duplicates_in_chunks(spark, monkeypatch):
    """Pairs in different chunks of a node, next to many texts that share their frequent lines but are no near copies."""
    rng = np.random.default_rng(5)
    common, rows = rng.integers(0, 500, 45), []
    for i in range(60):
        w = np.concatenate([common, rng.integers(1000, 90000, 20)])
        for j in range(2):
            twin = w.copy()
            twin[-1 - j] = 100_000 + 2 * i + j
            rows.append((int(rng.integers(1 << 40)), " ".join(f"w{x}" for x in twin)))
    monkeypatch.setattr(near_dedup, "LEAF", 2)
    monkeypatch.setattr(near_dedup, "CHUNK", 2)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), k=2).toPandas().set_index("doc_id")
    want = brute_components(dict(rows), 2)
    assert len({c for _, c in want.values()}) == 60
    assert all(got.component_id[i] == c for i, (_, c) in want.items())


def test_chunks_of_one_node(spark, monkeypatch):
    """All signatures in one last-level node: equal ones share a label, whichever chunks they are in."""
    rng = np.random.default_rng(6)
    sigs = rng.integers(0, 256, (40, 54), dtype=np.uint8)
    reps = [(int(r), bytearray(sigs[i % 40].tobytes()), [0], [1], [2], [3]) for i, r in enumerate(rng.permutation(80))]
    monkeypatch.setattr(near_dedup, "LEAF", 2)
    monkeypatch.setattr(near_dedup, "CHUNK", 2)
    df = spark.createDataFrame(reps, "rep bigint, sig binary, tree array<bigint>, n1 array<bigint>, n2 array<bigint>, n3 array<bigint>")
    label = {r["v"]: r["label"] for r in near_dedup._coarse(df, 0.8, 54, 80).collect()}
    assert all(label.get(a[0], a[0]) == label.get(b[0], b[0]) for a, b in zip(reps[:40], reps[40:]))


@pytest.mark.parametrize("one_task", [0, 1000])
def test_components(spark, one_task):
    """Both ways, with and without a table that one task may settle."""
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 49), (50, 51), (60, 60)] + [(70, i) for i in range(71, 90)] * 2, "a bigint, b bigint").repartition(5)
    got = {r["v"]: r["label"] for r in components.components(links, one_task=one_task).collect()}
    assert got == {i: 0 for i in range(41)} | {49: 49, 50: 49, 51: 49} | {i: 70 for i in range(70, 90)}
    assert components.components(links.where("false"), one_task=one_task).count() == 0
    rng = np.random.default_rng(9)
    a, b = rng.integers(0, 3000, 1500), rng.integers(0, 3000, 1500)
    v, low = components.labels_of(a, b)
    want = {int(x): int(x) for x in v}
    for _ in range(200):
        for x, y in zip(a.tolist(), b.tolist()):
            want[x] = want[y] = min(want[x], want[y])
    assert dict(zip(v.tolist(), low.tolist())) == want


@pytest.mark.parametrize("bits", [1, 4, 16, 22])
def test_coder(bits):
    rng = np.random.default_rng(bits)
    blocks = [rng.integers(0, 1 << bits, n) for n in (0, 1, 700, 33)] + [np.full(900, (1 << bits) - 1), rng.zipf(1.5, 800) % (1 << bits), np.tile(rng.integers(0, 1 << bits, 20), 40)]
    table = token_files.Frequencies.of(np.concatenate(blocks))
    assert table.counts.sum() == 1 << table.bits and table.counts.min() > 0
    coded = token_files.encode_blocks(blocks, table)
    for a, b in zip(blocks, token_files.decode_blocks(coded, [len(b) for b in blocks], table)):
        np.testing.assert_array_equal(a, b)
    assert len(coded[4]) < 900 * bits / 8 / 4 and len(coded[6]) < 800 * max(bits, 8) / 8 / 3  # it learns
    np.testing.assert_array_equal(token_files.decode_blocks(coded[3:4], [33], table)[0], blocks[3])  # blocks are independent
    none = token_files.Frequencies.of(np.zeros(0, dtype=np.int64))
    assert token_files.encode_blocks([], none) == [] and token_files.decode_blocks([], [], none) == []


def test_large_ids_round_trip():
    """Ids of 32 bits, many blocks, and packed frequencies."""
    rng = np.random.default_rng(5)
    docs = [(i, rng.integers(0, 1 << 32, int(rng.integers(0, 3000)), dtype=np.uint64).astype("<u4")) for i in range(40)]
    data = b"PRSMIDS2" + token_files.group_bytes(docs) + token_files.group_bytes([]) + b"END1" + struct.pack("<QQ", 40, sum(len(x) for _, x in docs))
    back = [d for g in token_files.read_groups(io.BytesIO(data)) for d in g]
    assert [i for i, _ in back] == list(range(40)) and all((a == b).all() for (_, a), (_, b) in zip(docs, back))


def test_token_files(spark, tmp_path):
    docs = odd(spark)
    files = token_files.write_ids(docs, f"{tmp_path}/ids", token_files.vocabulary_path(), files=3)
    got = token_files.read_ids(spark, f"{tmp_path}/ids", files).orderBy("start").collect()
    assert len(got) == 16 and [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in docs.collect()), key=lambda d: (d is not None, d))
    assert all(r["start"] == sum(len(x["ids"]) // 4 for x in got[:i]) for i, r in enumerate(got))
    assert all(bytes(r["ids"]).endswith(b"\2\0\0\0") for r in got)
    name = f"{tmp_path}/ids/{files[-1][0]}"
    data = bytearray(open(name, "rb").read())
    data[-40] ^= 1
    open(name, "wb").write(data)
    with open(name, "rb") as f, pytest.raises(token_files.CorruptFile):
        list(token_files.read_groups(f))
    empty = token_files.write_ids(nothing(spark), f"{tmp_path}/none", token_files.vocabulary_path())
    assert empty == [] and token_files.read_ids(spark, f"{tmp_path}/none", empty).count() == 0


def test_words_encode_like_whole_texts(monkeypatch):
    encoder = token_files.WordEncoder(token_files.vocabulary_path())
    texts = ["It's  here\n\nand 12 there!", " a b\tc\r\n", "<|startoftext|> x", "ÉTÉ é é ΣΑΣ Σ", "漢字 かな", "a\x1cb \u0085"]
    for t, ids in zip(texts, encoder(texts)):
        assert ids.tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_words_of_letters_share_ids():
    """A word is encoded once whatever its case and the signs behind it, and words of a later call are known."""
    encoder = token_files.WordEncoder(token_files.vocabulary_path())
    seen = []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **options):
            seen.extend(w for t in texts for w in t.split())
            return self.inner.encode_batch_fast(texts, **options)

    whole = encoder.tokenizer
    encoder.tokenizer = Counting(whole)
    if getattr(encoder, "bare", None) is not None:
        encoder.bare = Counting(encoder.bare)
    words = [f"{a}straße{b}" for a in ("x", "tür", "où") for b in ("q", "漢", "ж")]
    texts = [" ".join(f"{w} {w}. {w.replace('s', 'S')}***\n{w.replace('t', 'T')}?!" for w in words)] * 2
    for _ in range(2):
        for t, ids in zip(texts, encoder(texts)):
            assert ids.tolist() == whole.encode(t, add_special_tokens=False).ids
    assert sorted(w for w in seen if w[0].isalpha()) == sorted(words)


def test_letters_that_decompose_before_signs():
    encoder = token_files.WordEncoder(token_files.vocabulary_path())
    texts = ["\u0958.", "a\ufb1f! b", "\u1112\u1161\u11ab, H\u0331.", "\u0130. i\u0307?", "it's! x'.", "<|endoftext|>. A<|endoftext|>", "", " \n", "\U00016d63\U00016d67."]
    for t, ids in zip(texts, encoder(texts)):
        assert ids.tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_known_words_are_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_BYTES", 2000)
    encoder = token_files.WordEncoder(token_files.vocabulary_path())
    for i in range(30):
        texts = [f"Common w{chr(97 + i % 26)}{chr(97 + j)}{'z' * (i // 26)}x, 7{j}" for j in range(26)]
        for t, ids in zip(texts, encoder(texts)):
            assert ids.tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids
    assert len(encoder.words) < 400


def test_file_bytes_stay():
    """Files of one format have the same bytes, however blocks are coded."""
    ids = (np.arange(9000, dtype=np.uint64) ** 2 % 997 % 331).astype("<u4")
    data = token_files.group_bytes([(1, ids[:4000]), (None, ids[4000:])])
    assert (len(data), zlib.crc32(data)) == (9487, 3815306959)


def test_urls(spark):
    urls = ["http://A.org/x", "https://sub.example.org/es/1", "http://example.org/en/12?x", "http://x.com/fr/#y", "ftp://x.com/de/", "http://spam-farm.example.net", None, "no url", "http://x.spam-farm.example.org/a", "http://"]
    rows = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls * 2)], "page_id bigint, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(rows).collect()}
    want = [
        ("a.org", "/x", "org/", "allow"), ("sub.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("x.com", "/fr/", "com/fr/", "allow"),
        ("x.com", "/de/", "com/de/", "block"), ("spam-farm.example.net", "", None, "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("x.spam-farm.example.org", "/a", "org/", "allow"), ("", "", None, "allow"),
    ]
    assert [got[i] for i in range(20)] == want * 2
    assert url_filter.filter_urls(rows.where("false")).count() == 0
    assert url_filter.filter_urls(rows, listed=[]).where("verdict = 'block'").count() == 6


def test_urls_with_many_dots(spark):
    host = ".".join(["a"] * 30_000)
    rows = spark.createDataFrame([(1, f"http://{host}.spam-farm.example.com/x"), (2, f"http://{host}/x")], "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(rows).collect()}
    assert got == {1: "block", 2: "allow"}


def test_cascade(spark):
    universe = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("key % 50 = 0")
    levels = url_filter.build_cascade(listed, universe)
    got = universe.withColumn("x", url_filter.listed_by(levels, F.col("key")))
    assert len(levels) > 1 and got.where("x <> (key % 50 = 0)").count() == 0


def test_sharding(spark):
    got = sharding.shuffle_into_shards(odd(spark), shards=5).toPandas()
    assert sorted(got.groupby("shard").size()) == [3, 3, 3, 3, 4] and len(got) == 16
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert sharding.shuffle_into_shards(nothing(spark), shards=5).count() == 0
    few = sharding.shuffle_into_shards(odd(spark, 2), shards=5).toPandas()
    assert len(set(few.shard)) == 2
    equal = spark.range(900).selectExpr("IF(id % 3 = 0, null, id) AS doc_id", "'same' AS text")
    spread = sharding.shuffle_into_shards(equal, shards=4).toPandas()
    assert spread.groupby("shard").size().tolist() == [225] * 4
    for _, part in spread.groupby("shard"):
        assert sorted(part.slot) == list(range(225)) and 40 < part.doc_id.isna().sum() < 110


@pytest.mark.parametrize("bins,blocks", [(3, 5), (None, None)])
def test_shuffle_is_uniform(spark, bins, blocks):
    """Shard and place are independent of what a row holds and of each other (chi squares within 5 standard deviations)."""
    n, shards = 12_000, 6
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    got = sharding.shuffle_into_shards(docs, shards=shards, bins=bins, blocks=blocks).toPandas()
    place = got.slot * 10 // (n // shards)
    for a, b in ((got.doc_id % 8, got.shard), (got.doc_id % 8, place), (got.doc_id * 8 // n, got.shard), (got.doc_id * 8 // n, place), (got.sort_values("doc_id").shard.shift().fillna(0), got.sort_values("doc_id").shard)):
        table = pd.crosstab(np.asarray(a), np.asarray(b)).to_numpy().astype(float)
        want = table.sum(axis=1, keepdims=True) * table.sum(axis=0, keepdims=True) / table.sum()
        free = (table.shape[0] - 1) * (table.shape[1] - 1)
        assert abs(((table - want) ** 2 / want).sum() - free) < 5 * (2 * free) ** 0.5


def test_draws_of_large_populations():
    """Both ways to draw follow one law; beyond numpy's limit the moments are right."""
    rng = np.random.default_rng(3)
    for good, bad, draws in ((5, 9, 6), (30, 200, 50), (400, 300, 600), (3, 1000, 900)):
        ours = np.array([sharding._ratio_of_uniforms(rng, good, bad, draws) for _ in range(6000)])
        theirs = rng.hypergeometric(good, bad, draws, 6000)
        k = np.arange(max(ours.max(), theirs.max()) + 1)
        a, b = (np.bincount(x, minlength=len(k)) for x in (ours, theirs))
        some = a + b > 10
        assert ((a - b)[some] ** 2 / (a + b)[some]).sum() < some.sum() + 5 * (2 * some.sum()) ** 0.5
    big = np.array([sharding.hypergeometric(rng, 5 * 10**9, 7 * 10**9, 100_000) for _ in range(3000)])
    assert abs(big.mean() - 100_000 * 5 / 12) < 12 and abs(big.var() / (100_000 * 35 / 144) - 1) < 0.1


def test_matrix():
    rng = np.random.default_rng(4)
    blocks = rng.integers(0, 300, 40)
    shards = sharding.shard_sizes(int(blocks.sum()), 7)
    m = sharding.communication_matrix(blocks, shards)
    assert (m.sum(axis=0) == shards).all() and (m.sum(axis=1) == blocks).all() and (m >= 0).all()
    draws = np.array([sharding.communication_matrix(np.array([6, 6]), np.array([4, 8]), seed)[0, 0] for seed in range(3000)])
    assert abs(draws.mean() - 2) < 0.06 and abs(draws.var() - 2 * (2 / 3) * (6 / 11)) < 0.06


def test_rules(spark):
    got = quality_rules.apply_rules(odd(spark)).toPandas()
    assert len(got) == 16 and (got[got.text.isna()].n_words == 0).all() and got[got.doc_id == 9].base_failed.all()
    assert quality_rules.apply_rules(nothing(spark)).count() == 0
    good = "a fine text of many different words number %d " + " ".join(f"word{i}" for i in range(30))
    rows = [(i, good % i if i % 40 == 0 or i >= 80 else "# # # short", "bad.example" if i < 80 else f"h{i % 7}") for i in range(600)]
    judged = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).toPandas()
    assert not judged[judged.source == "bad.example"].kept.any() and judged[judged.source != "bad.example"].kept.all()


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(30))), (2, "Short item"), (3, None), (None, "null id"), (2, "short  ITEM")], "item_id bigint, text string")
    inside = "x y z " + " ".join(f"B{i}," for i in range(5, 20)) + " end"
    texts = [inside, "a short-item here", "a short here item", "nothing", None, "", inside, "null id " + "w " * 60]
    rows = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)] + [(0, inside, 9)], "doc_id bigint, text string, n_words int")
    found = decontaminate.decontaminate(rows, bench)
    got = {r["doc_id"]: (r["n_words"], len(r["hits"]), list(r["items"]), r["contaminated"]) for r in found.collect()}
    assert got == {
        0: (19, 15, ["1"], True), 1: (4, 2, ["2"], True), 2: (4, 0, [], False), 3: (1, 0, [], False), 4: (0, 0, [], False), 5: (0, 0, [], False), 6: (19, 15, ["1"], True), 7: (62, 2, [], False),
    }
    assert found.count() == 9 and decontaminate.remove_documents(found).count() == 5
    assert decontaminate.remove_spans(found).where("doc_id = 6").first()["text"] == "x y z, end"
    assert decontaminate.decontaminate(rows, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.decontaminate(rows.where("false"), bench).count() == 0
    assert decontaminate.drop_contaminated(rows, bench).count() == 5
    whole, marks = decontaminate.scan(rows, bench, size=2)  # the set in many slices
    assert whole.count() == 9 and {(r["doc_id"], len(r["hits"])) for r in marks.collect()} == {(0, 15), (1, 2), (6, 15), (7, 2)}
    upper = spark.createDataFrame([(1, "KEEP THIS " + inside.upper() + " AND THIS", 0)], "doc_id bigint, text string, n_words int")
    assert decontaminate.remove_spans(decontaminate.decontaminate(upper, bench)).first()["text"] == "KEEP THIS X Y Z, END AND THIS"
    long = spark.createDataFrame([(1, "w " * 300_000 + inside, 0)], "doc_id bigint, text string, n_words int")
    assert [len(r["hits"]) for r in decontaminate.decontaminate(long, bench).collect()] == [15]


def test_words_in_pieces(monkeypatch):
    """Words, windows and bounds do not depend on how the bytes are cut into pieces."""
    texts = ["", "Aa  aAé", None, "x" * 40 + " y", " \n", "aa aaé x y aa aaé"]
    column = pa.array(["skipped", *texts]).slice(1)
    kinds = set()
    for most in (3, 10, 1000):
        monkeypatch.setattr(common.Texts.pieces, "__defaults__", (most,))
        w = common.Texts(column).words(lower=True)
        assert w.counts.tolist() == [0, 2, 0, 2, 0, 6]
        h = w.hashes.tolist()
        assert h[0] == h[4] == h[8] and h[1] == h[5] == h[9] and h[3] == h[7] and len(set(h)) == 5
        at, two = w.windows(2)
        assert at.tolist() == [0, 2, 4, 5, 6, 7, 8] and two[0] == two[2] == two[6] and len(set(two.tolist())) == 5
        kinds.add((tuple(h), tuple(two.tolist()), int(w.whole(np.array([1]))[0])))
    assert len(kinds) == 1
    assert [len(g) for g in common.Texts([b"a" * 5, b"b" * 5, b"c" * 50]).groups(12)] == [2, 1]


def test_words_of_two_letters():
    """Words that a polynomial hash modulo 2**64 cannot tell apart (Thue-Morse and its complement)."""
    a, b = b"a", b"b"
    for _ in range(13):
        assert len(set(common.Texts([a, b]).words().hashes.tolist())) == 2
        a, b = a + b, b + a
    k = 1024
    letters = [b"a " if x == ord("a") else b"b " for x in a[:k]]
    other = [b"b " if x == b"a " else b"a " for x in letters]
    hashes = [common.Texts([b"".join(t)]).words().windows(k)[1][0] for t in (letters, other)]
    assert hashes[0] != hashes[1]
