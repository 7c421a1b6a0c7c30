"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

Benchmark items become windows of ``WINDOW`` words (an item of fewer words is one
window).  The 64-bit hashes of all distinct windows are the hash set: one broadcast
table, or several of at most ``SLICE`` hashes of which each scans the texts by
itself, so no task ever holds more.  A training text is scanned in its own row:
words are hashed once, every window of a length that the benchmark has is hashed
from them and looked up in the set by a broadcast semi-join.  The rows looked up hold a
hash and its place, never the text, so the work grows with the words.  Texts in
which windows are found are read again, and their windows verified as
whole strings against the benchmark's windows.

Only found windows and one narrow row per document leave the scan; texts are never
shuffled by it.  All of it is DataFrame expressions.

Defined cases: null and empty texts have no words, no hits and are clean; items
without words match nothing; items that share an id count once; an item with a
null id marks words as hit but is not counted or listed; equal rows get equal
results; an empty table on either side is no error; input columns pass through,
and those named like an output are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.llm.common import fresh, lower_ascii, small, write_table

TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z are lower-cased.
RAW_TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A word with what stands before it, or what stands after the last word.
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+\z"
WINDOW = 13
#: Hashes of benchmark windows that one broadcast holds: 16 bytes each.
SLICE = 1 << 21
#: A document is contaminated if hits are at least 1 in so many of its words.
SHARE = 20
#: Stands after a document's windows and is in the set, so that every document leaves the scan.
_LAST = 0x5DEECE66D


def raw_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RAW_TOKEN), F.lit(0))


def _plain(word: Column) -> Column:
    """A word with A-Z lower-cased; the quick way where it is all ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(lower_ascii(word))


def _gram(words: Column, start: Column, n: Column) -> Column:
    """``n`` words from position ``start`` (from 0) as one string; words hold no spaces."""
    return F.array_join(F.transform(F.slice(words, start + 1, n), _plain), " ")


def _starts(last: Column) -> Column:
    """0, 1, ... up to ``last``; empty if that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.expr("cast(array() as array<int>)"))


def _codes(words: Column, size: Column, n: int) -> Column:
    """Hashes of all windows of ``n`` words, given the hashes of all ``size`` words."""
    return F.transform(_starts(size - n), lambda i: F.xxhash64(F.lit(n), F.slice(words, i + 1, n)))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (code, n, gram, item): each window's hash, number of words, words, and an item that holds it."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), raw_tokens(F.col("text")).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    at = items.select("item", "w", n.alias("n"), F.explode(_starts(F.size("w") - n)).alias("i"))
    grams = at.select("item", "n", F.transform(F.slice("w", F.col("i") + 1, F.col("n")), _plain).alias("w"))
    code = F.xxhash64("n", F.transform("w", lambda x: F.xxhash64(x)))
    return grams.select(code.alias("code"), "n", F.array_join("w", " ").alias("gram"), "item").distinct()


def _found(words: DataFrame, windows: DataFrame, lengths: list[int], size: int) -> DataFrame:
    """(doc_id, digest, n_words, at, n): places of windows of documents whose hash is in the set, and for each row of ``words`` one with null ``at``."""
    codes = windows.select("code").distinct()
    slices = max(1, -(-codes.count() // size))
    m = F.col("n_words")
    every = F.concat(*[_codes(F.col("h"), m, n) for n in lengths], F.array(F.lit(_LAST).cast("long")))
    hashed = words.select("doc_id", "digest", F.size("w").alias("n_words"), F.transform("w", lambda x: F.xxhash64(_plain(x))).alias("h"))
    scanned = hashed.select("doc_id", "digest", "n_words", F.posexplode(every).alias("place", "code"))
    n, at, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    for k in lengths:
        here = F.col("place") < before + F.greatest(m - k + 1, F.lit(0))
        n, at = F.when(n.isNull() & here, F.lit(k)).otherwise(n), F.when(n.isNull() & here, F.col("place") - before).otherwise(at)
        before = before + F.greatest(m - k + 1, F.lit(0))
    last = codes.sparkSession.range(1).select(F.lit(_LAST).cast("long").alias("code"))
    parts = []
    for i in range(slices):
        some = codes.where(F.pmod("code", F.lit(slices)) == i)
        some = F.broadcast(some.unionByName(last) if i == 0 else some)  # hashes are spread evenly: about ``size`` rows
        hit = scanned.join(some, "code", "left_semi").withColumn("n", n).withColumn("at", at)
        parts.append(hit.select("doc_id", "digest", "n_words", "at", "n"))
    return reduce(DataFrame.unionByName, parts)


def _digest() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _grams(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (doc_id, digest, at, n) with ``gram``, from the texts of the documents that it names."""
    spots = write_table(found.groupBy(F.col("doc_id").alias("d"), F.col("digest").alias("g")).agg(F.collect_set(F.struct("at", "n")).alias("spots")))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g"))
    held = docs.select("doc_id", _digest().alias("digest"), "text").join(small(spots), same)
    words = held.select("doc_id", "digest", raw_tokens(F.col("text")).alias("w"), "spots")
    grams = F.transform("spots", lambda s: F.struct(s["at"].alias("at"), s["n"].alias("n"), _gram(F.col("w"), s["at"], s["n"]).alias("gram")))
    return words.select("doc_id", "digest", F.inline(grams)).distinct()


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, digest, n_words) of all ``docs``, and (doc_id, digest, hits, items) of those with hits.

    ``digest`` is the text's MD5 (null for null), ``hits`` the sorted positions of
    hit words, ``items`` the sorted ids of items with occurring windows.
    """
    windows = write_table(benchmark_windows(benchmark, window))
    lengths = sorted(r[0] for r in windows.select("n").distinct().collect())  # at most ``window`` rows
    words = docs.select("doc_id", _digest().alias("digest"), raw_tokens(F.col("text")).alias("w"))
    found = write_table(_found(words, windows, lengths, size))
    rows = found.where("at is null").select("doc_id", "digest", "n_words")
    near = _grams(docs, found.where("at is not null").select("doc_id", "digest", "at", "n"))
    true = write_table(near.join(small(windows.select("gram", "n").distinct()), ["gram", "n"], "left_semi"))
    spans = true.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    spans = spans.select("doc_id", "digest", F.sort_array(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1))))).alias("hits"))
    named = windows.where("item is not null").select("gram", "n", "item")
    held = true.select("doc_id", "digest", "gram", "n").distinct().join(small(named), ["gram", "n"]).select("doc_id", "digest", "item").distinct()
    items = held.groupBy(F.col("doc_id").alias("d"), F.col("digest").alias("g")).agg(F.sort_array(F.collect_list("item")).alias("items"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g"))
    none = F.expr("cast(array() as array<string>)")
    marks = spans.join(items, same, "left").select("doc_id", "digest", "hits", F.coalesce("items", none).alias("items"))
    return rows, write_table(marks)


def _marked(rows: DataFrame, marks: DataFrame, digest: Column, share: int) -> DataFrame:
    """``rows`` (doc_id, n_words, ...) with ``hits, items, contaminated``; documents with hits are broadcast only if counted few."""
    d, g, n = fresh(rows, "doc", "digest", "n")
    marks = marks.select(F.col("doc_id").alias(d), F.col("digest").alias(g), "hits", "items")
    out = rows.join(small(marks), F.col("doc_id").eqNullSafe(F.col(d)) & (digest == F.col(g)), "left").drop(d, g)
    empty = lambda kind: F.expr(f"cast(array() as array<{kind}>)")
    out = out.withColumn("hits", F.coalesce("hits", empty("int"))).withColumn("items", F.coalesce("items", empty("string"))).withColumn(n, F.size("hits"))
    return out.withColumn("contaminated", (F.col(n) > 0) & (share * F.col(n) >= F.col("n_words"))).drop(n)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``docs`` with ``n_words, hits, items, contaminated``: contaminated if hits are at least 1 in ``share`` words."""
    docs = docs.drop("n_words", "hits", "items", "contaminated")
    _, marks = scan(docs, benchmark, window)
    counted = docs.withColumn("n_words", F.coalesce(F.regexp_count("text", F.lit(RAW_TOKEN)), F.lit(0)))
    return _marked(counted, marks, _digest(), share)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``docs`` without contaminated rows; texts move only if those are many."""
    rows, marks = scan(docs, benchmark, window)
    d, g = fresh(docs, "doc", "digest")
    gone = _marked(rows, marks, F.col("digest"), share).where("contaminated").select(F.col("doc_id").alias(d), F.col("digest").alias(g)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(d)) & (_digest() == F.col(g))
    return docs.join(small(write_table(gone)), same, "left_anti")


def remove_spans(found: DataFrame) -> DataFrame:
    """Output of ``decontaminate`` with ``text`` free of hit words and of what stands before each."""
    pieces = F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))
    kept = F.filter(pieces, lambda p, i: ~F.array_contains("hits", i))
    return found.withColumn("text", F.when(F.size("hits") > 0, F.array_join(kept, "")).otherwise(F.col("text")))


def remove_documents(found: DataFrame) -> DataFrame:
    return found.where(~F.col("contaminated"))


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Hits of benchmark windows in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows, marks = scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = _marked(rows, marks, F.col("digest"), SHARE)
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def _oracle() -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TOKEN}')"
    return f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
bn AS (SELECT item, w, least(len(w), {WINDOW}) AS n FROM b WHERE len(w) > 0),
bi AS (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bn),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM bi),
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
dn AS (SELECT d.*, l.n FROM d, (SELECT DISTINCT n FROM bw) l WHERE len(d.w) >= l.n),
di AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dn),
hit AS (SELECT r, i, di.n, item FROM di JOIN bw ON di.n = bw.n AND array_to_string(w[i : i + di.n - 1], ' ') = bw.gram),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""


ORACLE_SQL = _oracle()
