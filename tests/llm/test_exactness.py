"""What must not depend on partitions, on hashes that someone chose, on the length of a text or of a list."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismarq.llm import common, decontaminate, mixing, near_dedup, quality_rules, url_filter
from prismarq.llm.html_extract import main_text

#: Two words that the hash takes for one where its seed is known.
TWINS = ("fkntjasaaaaaaeaa", "wxxtntotfjlfgzpv")


# --- mixing ------------------------------------------------------------------------------


def equal_rows(spark, n=300):
    rows = [(None, "a b c d e", "a")] * n + [(i, "x " * 40, "b") for i in range(30)] + [(7, "y z", "b")] * 50
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_equal_rows_are_drawn_alike_under_any_partitioning(spark):
    found = []
    for parts in (1, 3, 8):
        mixed = mixing.mix_sources(equal_rows(spark).repartition(parts))
        rows = mixed.groupBy("source", "doc_id", "size", "copies").count().collect()
        found.append(sorted((tuple(r) for r in rows), key=repr))
    assert found[0] == found[1] == found[2]
    taken = {}
    for source, _, size, copies, n in found[0]:
        taken[source] = taken.get(source, 0) + size * copies * n
    target = {r["source"]: r["target"] for r in mixed.select("source", "target").distinct().collect()}
    assert target["a"] - 5 < taken["a"] <= target["a"]  # as many rows of five words as fit


def test_the_place_of_a_cut_is_exact(spark):
    """One source of equal rows over many partitions: the number drawn is the number that fits."""
    lean = spark.range(0, 1000, 1, 13).select(F.lit(4).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit(3).cast("long").alias("size"), F.lit("d").alias("digest"), F.monotonically_increasing_id().alias("spot"))
    lean = common.write_table(lean)
    row = lean.withColumns({"rank": F.lit(0.5), "has_id": F.lit(True), "gap": F.lit(1000.0)})
    (cut,) = mixing._cut(row).collect()
    assert cut["used"] == 999 and lean.where(F.col("spot") < cut["cut"]["place"]).count() == 333


# --- decontamination ---------------------------------------------------------------------


def test_a_million_words_take_seconds(spark):
    """The work grows with the words of a text: twice as long, about twice the time, and the hits are where they are."""
    item = " ".join(f"k{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    took = []
    for n in (500_000, 1_000_000):
        text = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("w"), i % 9973)), " "), F.lit(f" {item}"))
        docs = common.write_table(spark.range(1).select(F.col("id").alias("doc_id"), text.alias("text")))
        began = time.monotonic()
        (row,) = decontaminate.decontaminate(docs, bench).select("n_words", F.size("hits").alias("n_hit"), "contaminated").collect()
        took.append(time.monotonic() - began)
        assert tuple(row) == (n + 20, 20, False)
    assert took[1] < 60 and took[1] < 3 * took[0] + 10


def test_hits_over_a_whole_text(spark):
    """A long text that is all benchmark: as many places as words, each found once."""
    item = " ".join(f"k{i}" for i in range(40))
    docs = spark.createDataFrame([(1, " ".join([item] * 500)), (1, " ".join([item] * 500)), (2, None)], "doc_id long, text string")
    rows = decontaminate.decontaminate(docs, spark.createDataFrame([(1, item), (2, "k1 k2 k3")], "item_id long, text string"))
    assert sorted((r["doc_id"], r["n_words"], r["n"], r["items"]) for r in rows.withColumn("n", F.size("hits")).collect()) == [(1, 20_000, 20_000, ["1", "2"])] * 2 + [(2, 0, 0, [])]


# --- hashes ------------------------------------------------------------------------------


def test_words_are_hashed_with_a_seed():
    raw = np.frombuffer("".join(TWINS).encode(), dtype=np.uint8)
    at = np.array([0, 16])
    plain, seeded = common.hash_slices(raw, at, at + 16), common.hash_slices(raw, at, at + 16, 12345)
    assert plain[0] == plain[1] and seeded[0] != seeded[1]


def test_twin_words_repeat_nothing():
    text = " ".join(TWINS[i % 2 == 0 and i < 8] + f" a{i % 8}" for i in range(16))
    got = quality_rules.measure_texts(common.Texts([text.encode()]))
    words = text.split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    assert got["n_repeat_words"][0] == len({i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)})


def test_twin_words_link_nothing(spark):
    docs = spark.createDataFrame([(1, f"{TWINS[0]} x"), (2, f"{TWINS[1]} x"), (3, f"{TWINS[0]} X")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, k=2).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    assert common.corpus_seed(docs) == common.corpus_seed(docs.repartition(3)) != common.corpus_seed(docs.where("doc_id > 1"))


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs of similarity 0.80 to 0.82, the hardest that count: all but a few in a thousand share a component."""
    rng = np.random.default_rng(21)
    rows, pairs = [], 1000
    for p in range(pairs):
        words = [f"p{p}w{i}" for i in range(110)]
        n = int(rng.integers(11, 13))  # of 109 shingles so many are new: 98/120 = 0.817 or 97/121 = 0.802
        other = words[:-n] + [f"q{p}w{i}" for i in range(n)]
        rows += [(2 * p, " ".join(words)), (2 * p + 1, " ".join(other))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2)
    similar = lambda a, b: len(a & b) / len(a | b)
    sets = [set(zip(t.split(), t.split()[1:])) for _, t in rows]
    assert all(0.8 <= similar(sets[2 * p], sets[2 * p + 1]) < 0.82 for p in range(pairs))
    found = got.where("component_id = doc_id - 1 and doc_id % 2 = 1").count()
    print("linked pairs of similarity 0.80 to 0.82:", found, "of", pairs)
    assert found >= 0.997 * pairs


# --- hosts -------------------------------------------------------------------------------


def test_bad_hosts_are_rejected_and_small_ones_judged_by_the_corpus(spark):
    good, bad = "plain words that make a text of some length and no repeats at all here " * 2, "few words"
    rows = [("good", good)] * 300 + [("bad", bad)] * 95 + [("bad", good)] * 5 + [("small", bad)] + [(f"h{i}", good) for i in range(40)]
    rows = [(i, s, " ".join(f"{w}{i}{j}" for j, w in enumerate(t.split()))) for i, (s, t) in enumerate(rows)]
    got = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    assert {r[0] for r in got.where("host_rejected").select("source").distinct().collect()} == {"bad"}
    assert got.where("source = 'bad' and not base_failed and not kept").count() == 5  # good texts of a bad host
    assert got.where("source = 'good' and not kept").count() == 0


def test_weight_of_the_prior():
    """Hosts drawn from a beta prior give its weight back, whatever their sizes; hosts of one rate give the highest."""
    rng = np.random.default_rng(5)
    for a, b in ((2.0, 18.0), (0.5, 1.5)):
        n = rng.integers(1, 400, 4000)
        x = rng.binomial(n, rng.beta(a, b, len(n)))
        mean = x.sum() / n.sum()
        weight = quality_rules.prior_weight(mean, float((n * (x / n - mean) ** 2).sum()), len(n), int(n.sum()), float((n.astype(float) ** 2).sum()))
        assert weight == pytest.approx(a + b, rel=0.15)
    x = rng.binomial(n, 0.1)
    mean = x.sum() / n.sum()
    assert quality_rules.prior_weight(mean, float((n * (x / n - mean) ** 2).sum()), len(n), int(n.sum()), float((n.astype(float) ** 2).sum())) > 300
    assert quality_rules.prior_weight(0.0, 0.0, 0, 0, 0.0) == quality_rules.PRIOR_WEIGHT[1]


# --- lists of hosts ----------------------------------------------------------------------


def test_a_list_is_split_into_cascades(spark):
    universe = spark.range(6000).select(F.concat(F.lit("h"), "id").alias("key"))
    listed = universe.where("pmod(xxhash64(key), 5) = 0")
    cascades = url_filter.build_cascades(listed, universe, most_bits=1 << 10)
    assert len(cascades.parts) > 3 and all(levels[0].bits <= 1 << 11 for levels in cascades.parts)
    wrong = universe.withColumn("said", url_filter.listed_in(cascades, F.col("key"))).join(listed.withColumn("is", F.lit(True)), "key", "left").where("said <> coalesce(is, false)")
    assert wrong.count() == 0


def test_a_hundred_thousand_names_in_seconds(spark):
    listed = spark.range(100_000).select(F.concat(F.lit("bad"), "id", F.lit(".example")).alias("key"))
    pages = spark.range(120_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://"), F.when(F.col("id") % 2 == 0, "bad").otherwise("good"), "id", F.lit(".example/x")).alias("url"))
    began = time.monotonic()
    blocked = url_filter.filter_urls(pages, listed=listed).where("verdict = 'block'").count()
    assert blocked == 50_000 and time.monotonic() - began < 60


# --- articles ----------------------------------------------------------------------------


PROSE = "This is a paragraph of prose, with commas, that says something about the matter at hand and is long enough to read like text."


@pytest.mark.parametrize(("part", "kept"), [
    ('<section id="discussion"><h2>Discussion</h2><p>{}</p></section>', "Discussion\n" + PROSE), ('<div class="feedback"><p>{}</p></div>', PROSE), ('<div id="print"><p>{}</p></div>', PROSE),
    ('<div class="section-header"><p>{}</p></div>', PROSE), ('<div class="article-header"><h2>Sub</h2><p>{}</p></div>', "Sub\n" + PROSE), ("<p>so a <math><mi>x</mi><mo>+</mo><mi>y</mi></math> b</p>", "so a x+y b"),
    ('<div class="comments"><p>{}</p></div>', None), ('<div class="feedback"><form><input></form><a href="1">Yes</a> <a href="2">No</a></div>', None), ('<div class="ad"><p>{}</p></div>', None), ('<div class="cookie-notice"><p>{}</p></div>', None),
])
def test_names_inside_an_article_only_weigh(part, kept):
    page = f"<html><body><nav><a href=x>menu</a></nav><article><h1>Title</h1><p>{PROSE} One.</p>{part.format(PROSE)}<p>{PROSE} Two.</p></article><footer>foot</footer></body></html>"
    assert main_text(page) == "\n".join(["Title", f"{PROSE} One.", *([kept] if kept else []), f"{PROSE} Two."])


def test_a_page_of_a_megabyte():
    began = time.monotonic()
    blocks = [f"{PROSE} {i}." for i in range(9000)]
    assert main_text("<html><body><div class=menu><a href=1>x</a></div><div>" + "".join(f"<p>{b}</p>" for b in blocks) + "</div></body></html>") == "\n".join(blocks)
    assert time.monotonic() - began < 20
