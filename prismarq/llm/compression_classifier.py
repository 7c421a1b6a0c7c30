"""Quality classifier: which of two zstandard dictionaries shortens a text more.

One dictionary is trained on labelled good texts, one on bad ones.  A text's
evidence is the difference of its two compressed sizes over its length (plus
``PAD`` bytes, so that short texts stay near zero); a logistic curve, fitted on
labelled texts that neither dictionary has seen, turns it into a score.

Learning takes a bounded sample: at most ``MAX_LABELLED`` rows in hash order,
skipping those that would bring their texts beyond ``MAX_BYTES``.  Scoring covers
every whole text, in place, with no shuffle.

Defined cases: null text scores as empty text; labels that are null, or whose
document is missing, teach nothing; a document with several labels counts once
for each; without both labels every score is the share of good labels, (good + 1)
/ (all + 2); an empty table gives an empty result; a null doc_id is not held out;
input columns pass through, and those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.llm.common import as_bytes, fresh

MAX_LABELLED = 4000
MAX_BYTES = 24 << 20
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
PAD = 200
#: Labelled rows of this share of hash values calibrate; the others fill the dictionaries.
CALIBRATION_SHARE = 3


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the logistic curve over their difference; no dictionaries: a constant score."""

    good: bytes
    bad: bytes
    slope: float
    offset: float


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.ZstdCompressionDict(dictionary)
    kind.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=kind, write_content_size=False, write_dict_id=False)


def evidence(model: Model, texts: list[bytes]) -> np.ndarray:
    """(size with the bad dictionary - size with the good one) / (length + PAD)."""
    if not model.good:
        return np.zeros(len(texts))
    good, bad = _compressor(model.good), _compressor(model.bad)
    return np.array([(len(bad.compress(t)) - len(good.compress(t))) / (len(t) + PAD) for t in texts], dtype=np.float64)


def _scores(model: Model, texts: list[bytes]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.slope * evidence(model, texts) + model.offset, -40, 40)))


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; with too few texts to train on, the texts themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY_BYTES:].rjust(16, b"\n")


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method; a faint pull toward 0 keeps separable data finite."""
    scale = float(np.std(x)) or 1.0
    a = np.stack([x / scale, np.ones(len(x))], axis=1)
    w, pull = np.zeros(2), np.diag([0.05, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + pull, a.T @ (y - p) - pull @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(rows: list[tuple[bytes, int, bool]]) -> Model:
    """Model from (text, label 0 or 1, for calibration) rows."""
    all_good = sum(q for _, q, _ in rows)
    prior = (all_good + 1) / (len(rows) + 2)
    constant = Model(b"", b"", 0.0, float(np.log(prior / (1 - prior))))
    by = {q: [t for t, label, aside in rows if label == q and not aside and t] for q in (0, 1)}
    aside = [(t, q) for t, q, a in rows if a]
    if not by[0] or not by[1] or len({q for _, q in aside}) < 2:
        return constant
    raw = Model(_dictionary(by[1]), _dictionary(by[0]), 1.0, 0.0)
    slope, offset = _logistic(evidence(raw, [t for t, _ in aside]), np.array([q for _, q in aside], dtype=np.float64))
    return Model(raw.good, raw.bad, slope, offset)


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves remainder 1 modulo 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_LABELLED, most_bytes: int = MAX_BYTES) -> list[tuple[bytes, int, bool]]:
    """At most ``most`` labelled rows with at most ``most_bytes`` of text, the same on every run."""
    named = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label")).where("id is not null and label in (0, 1)").where(~held_out(F.col("id")))
    order = F.xxhash64("id", "label")
    picked = named.withColumn("o", order).orderBy("o", "id", "label").limit(most)  # a top-k, never a full sort
    joined = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("id"))
    # One row per label, however often its document is there: of repeated documents the shortest.
    sizes = joined.groupBy("id", "label", "o").agg(F.min(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n"))
    wanted, room = set(), most_bytes
    for r in sorted(sizes.collect(), key=lambda r: (r["o"], r["id"], r["label"])):  # at most ``most`` rows
        pass_on = (r["id"], r["label"], r["o"], r["n"])
        if pass_on not in wanted and r["n"] <= room:
            wanted.add(pass_on)
            room -= r["n"]
    if not wanted:
        return []
    keys = docs.sparkSession.createDataFrame(sorted(wanted), "id bigint, label int, o bigint, n int")
    same = (F.col("doc_id") == F.col("id")) & (F.coalesce(F.octet_length("text"), F.lit(0)) == F.col("n"))
    rows = docs.select("doc_id", "text").join(F.broadcast(keys), same).groupBy("id", "label", "o").agg(F.min("text").alias("text"))
    return [(as_bytes([r["text"]])[0], r["label"], r["o"] % CALIBRATION_SHARE == 0) for r in sorted(rows.collect(), key=lambda r: (r["o"], r["id"], r["label"]))]


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``."""

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(_scores(model, as_bytes(s)))

    (x,) = fresh(docs, "score")
    docs = docs.drop("score", "predicted").withColumn(x, F.pandas_udf(score, "double")(F.col(text)))
    return docs.withColumn("score", F.col(x)).withColumn("predicted", (F.col(x) >= 0.5).cast("int")).drop(x)


def op1_compression_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(labelled_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return classify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
