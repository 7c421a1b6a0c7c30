"""Quality rules on documents and on the hosts that published them.

Each text is measured on its own; failures of each rule are summed by host, the
failure rates are shrunk toward the corpus by a beta prior whose weight the method of
moments finds: from how much hosts differ beyond what their numbers of documents
alone let expect, each host counting by its documents.  A host whose shrunken rate of any rule is
above ``HOST_LIMIT`` loses all its documents.  Texts are measured once, in place,
into a written table, and never shuffled: only sums per host are, after partial
aggregation, so a host with a third of all rows costs no more than another.

Defined cases: null text counts as empty; a null host is one more host; equal
rows are judged alike; an empty table gives an empty result; input columns pass
through, and those named like an output are replaced.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.llm.common import _SPACE, WORD_PATTERN, Texts, Words, fresh, give_back, mix64, small, write_table

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
#: A host is rejected if the shrunken share of its documents that fail one rule is larger.
HOST_LIMIT = 0.75
#: Bounds of the prior's weight in documents.
PRIOR_WEIGHT = (1.0, 1000.0)
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Words are told apart by hashes with a seed that each worker draws; windows are compared within a text only.
_SEED = secrets.randbits(62)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS.encode())] = True


def _repeated(w: Words) -> np.ndarray:
    """For each text, words inside windows of REPEAT_WINDOW words that it holds twice or more."""
    at, hashes = w.windows(REPEAT_WINDOW)
    if not len(at):
        return np.zeros(len(w.counts), dtype=np.int64)
    keys = hashes ^ mix64(w.owner[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(w.hashes) + 1, dtype=np.int32)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + REPEAT_WINDOW, -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return hit[w.first[1:]] - hit[w.first[:-1]]


def _duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def measure_texts(texts: Texts) -> dict[str, np.ndarray]:
    """MEASURES of each text, in pieces of about 1 MB (or one longer text's words)."""
    out = {m: np.zeros(len(texts), dtype=np.int64) for m in MEASURES}
    for part in texts.groups():
        rows = slice(part.first, part.first + len(part))
        for at, raw in part.pieces():
            owner = lambda mask: np.bincount(np.searchsorted(part.offsets, np.flatnonzero(mask) + at, side="right") - 1, minlength=len(part))  # noqa: B023, E731
            out["n_symbols"][rows] += owner(_SYMBOL[raw])
            chars = np.concatenate([[0], np.cumsum(((raw & 0xC0) != 0x80) & ~_SPACE[raw], dtype=np.int32)])
            ends = np.clip(part.offsets - at, 0, len(raw))
            out["word_chars"][rows] += np.diff(chars[ends])
        words = part.words(seed=_SEED)
        out["n_words"][rows] = words.counts
        out["n_repeat_words"][rows] = _repeated(words)
        for i in range(len(part)):
            x = part.first + i
            out["n_lines"][x], out["n_dup_lines"][x] = _duplicate_lines(part[i])
    return out


def _measure(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in columns:
        found = measure_texts(Texts(column))
        yield pa.StructArray.from_arrays([pa.array(found[m]) for m in MEASURES], list(MEASURES))
        del column, found
    give_back()


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


#: Failures that are summed by host, as SQL conditions on the measures.
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
}


def prior_weight(mean: float, spread: float, hosts: int, n: int, squares: float) -> float:
    """Weight, in documents, of the beta prior of hosts' rates: from rates' squared distances to the mean, summed by documents.

    Hosts of one rate would have a ``spread`` of (hosts - 1) * mean * (1 - mean); ``n`` and ``squares`` are sums of the hosts' documents and
    of their squares.  What exceeds that is the share of the hosts in the variance, 1 / (weight + 1).
    """
    low, high = PRIOR_WEIGHT
    alone = mean * (1 - mean)
    room = alone * (n - squares / n - (hosts - 1)) if n else 0.0
    share = (spread - (hosts - 1) * alone) / room if room > 0 else 0.0
    return min(max(1 / share - 1, low), high) if share > 0 else high


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """Per host: ``n`` documents, failures of each rule, shrunken rate ``<rule>_rate`` and ``rejected``."""
    names = list(RULES)
    per = write_table(measured.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.expr(c).cast("long")).alias(k) for k, c in RULES.items()]))
    total = per.agg(F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum(F.col("n").cast("double") ** 2).alias("squares"), *[(F.sum(k) / F.sum("n")).alias(k) for k in names]).first()
    mean = {k: total[k] or 0.0 for k in names}
    spread = per.agg(*[F.sum(F.col("n") * (F.col(k) / F.col("n") - F.lit(mean[k])) ** 2).alias(k) for k in names]).first()
    for k in names:
        m, weight = mean[k], prior_weight(mean[k], spread[k] or 0.0, total["hosts"], total["n"] or 0, total["squares"] or 0.0)
        per = per.withColumn(f"{k}_rate", (F.col(k) + F.lit(m * weight)) / (F.col("n") + F.lit(weight)))
    worst = F.greatest(*[F.col(f"{k}_rate") for k in names])
    return write_table(per.withColumn("rejected", worst > HOST_LIMIT))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with MEASURES."""
    (m,) = fresh(docs, "m")
    docs = docs.drop(*MEASURES)
    found = F.arrow_udf(_measure, ", ".join(f"{k} long" for k in MEASURES))
    return docs.withColumn(m, found(F.col(text))).select(*docs.columns, *[F.col(m)[k].alias(k) for k in MEASURES])


def judge(measured: DataFrame, host: str = "source") -> DataFrame:
    """``measured`` (a written table with MEASURES) with ``base_failed``, ``host_rejected`` and ``kept``."""
    (h,) = fresh(measured, "h")
    measured = measured.drop("base_failed", "host_rejected", "kept")
    bad = host_rates(measured, host).where("rejected").select(F.col("host").alias(h), F.lit(True).alias("host_rejected"))
    out = measured.join(small(bad), F.col(host).eqNullSafe(F.col(h)), "left").drop(h)
    out = out.withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False))).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def apply_rules(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with MEASURES, ``base_failed``, ``host_rejected`` and ``kept``."""
    return judge(write_table(measure(docs, text)), host)


def op9_host_rules(spark, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; its source stands for the host."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    measured = write_table(measure(docs).drop("text"))
    return judge(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    names = list(RULES)
    low, high = PRIOR_WEIGHT
    sums = ", ".join(f"CAST(sum(CASE WHEN {RULES[k]} THEN 1 ELSE 0 END) AS DOUBLE) AS {k}" for k in names)
    means = ", ".join(f"sum({k}) / sum(n) AS m_{k}" for k in names)
    spreads = ", ".join(f"sum(n * ({k} / n - m_{k}) * ({k} / n - m_{k})) AS v_{k}" for k in names)
    shares = ", ".join(f"CASE WHEN m_{k} * (1 - m_{k}) * free > 0 THEN (v_{k} - (hosts - 1) * m_{k} * (1 - m_{k})) / (m_{k} * (1 - m_{k}) * free) ELSE 0 END AS s_{k}" for k in names)
    weights = ", ".join(f"CASE WHEN s_{k} > 0 THEN least(greatest(1 / s_{k} - 1, {low}), {high}) ELSE {high} END AS w_{k}" for k in names)
    rates = ", ".join(f"({k} + m_{k} * w_{k}) / (n + w_{k})" for k in names)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD_PATTERN}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD_PATTERN}')) AS l FROM d),
win AS (SELECT r, i, array_to_string(w[i : i + {REPEAT_WINDOW - 1}], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - {REPEAT_WINDOW} + 2)) AS i FROM w WHERE len(w) >= {REPEAT_WINDOW})),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {REPEAT_WINDOW})) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1) GROUP BY r),
m AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN rep USING (r)),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {sums} FROM m GROUP BY source),
a AS (SELECT {means} FROM h),
z AS (SELECT count(*) AS hosts, sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS free, {", ".join(f"any_value(m_{k}) AS m_{k}" for k in names)}, {spreads} FROM h, a),
v AS (SELECT {weights} FROM (SELECT {shares} FROM z)),
bad AS (SELECT source, greatest({rates}) > {HOST_LIMIT} AS rejected FROM h, a, v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND NOT rejected AS kept
FROM m JOIN bad ON m.source IS NOT DISTINCT FROM bad.source"""


ORACLE_SQL = _oracle()
