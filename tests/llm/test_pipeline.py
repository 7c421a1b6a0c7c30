"""The pipeline's stages, each against a brute-force version on what the one before kept."""

import os
import re

import duckdb
import pandas as pd
import pytest
from test_llm_queries import brute_components

import corpus_pipeline
from prismarq.llm import decontaminate, mixing, quality_rules
from prismarq.llm.common import write_table

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TOKEN = re.compile(decontaminate.TOKEN)


def grams(text, n=13):
    w = TOKEN.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return w, [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]


def by_sql(sql: str, docs: pd.DataFrame) -> pd.DataFrame:
    """``sql`` over ``docs`` as the table of documents."""
    con = duckdb.connect()
    con.register("documents", docs)
    return con.execute(sql).fetch_df()


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage gives on what the one before kept."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = write_table(stage(spark, docs, SF))
        assert name == "sharding" or docs.columns == columns
        out[name] = docs.toPandas()
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mixing", "sharding"]


def test_rules(kept):
    source = pd.read_parquet(f"{SF}/documents.parquet")
    judged = by_sql(quality_rules.ORACLE_SQL, source)
    assert set(kept["quality_rules"].doc_id) == set(judged[judged.kept].doc_id) < set(source.doc_id)


def test_dedup(kept):
    before = kept["quality_rules"]
    want = {i for i, (_, c) in brute_components(dict(zip(before.doc_id, before.text)), 5).items() if c == i}
    assert set(kept["near_dedup"].doc_id) == want


def test_clean(kept):
    bench = {g for t in pd.read_parquet(f"{SF}/benchmark.parquet").text for g in grams(t)[1]}
    clean = set()
    for i, t in zip(kept["near_dedup"].doc_id, kept["near_dedup"].text):
        w, gs = grams(t)
        hit = {p for at, g in enumerate(gs) if g in bench for p in range(at, at + 13)}
        if not (hit and 20 * len(hit) >= len(w)):
            clean.add(i)
    assert set(kept["decontamination"].doc_id) == clean


def test_mix(kept):
    want = by_sql(mixing.ORACLE_SQL, kept["decontamination"])
    copies = {int(i): int(t) // int(n) for i, t, n in zip(want.doc_id, want.taken, want["size"]) if t}
    assert kept["mixing"].doc_id.value_counts().to_dict() == copies


def test_shard(kept):
    last = kept["sharding"]
    assert sorted(last.doc_id) == sorted(kept["mixing"].doc_id)
    sizes = last.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and set(last.law) == {"rows"}
    for _, part in last.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_run(spark, kept):
    """run() gives the rows of the stages one after the other."""
    out = corpus_pipeline.run(spark, SF).toPandas()
    key = ["shard", "slot"]
    pd.testing.assert_frame_equal(out.sort_values(key).reset_index(drop=True), kept["sharding"].sort_values(key).reset_index(drop=True)[out.columns], check_dtype=False)


GOOD = "a plain text of many different words " + " ".join(f"word{i}" for i in range(40))
ODD = [
    (1, GOOD + " one", "a"), (1, GOOD + " one", "a"), (2, GOOD + " one two", "a"), (None, GOOD + " three", None), (None, None, None), (3, None, "b"), (4, "", "b"), (5, " \n", "c"),
    (6, "word " * 5000, "c"), (7, " ".join(f"é{i} 漢字{i}" for i in range(60)), "ü"), (8, " ".join(f"other{i}" for i in range(9000)), None),
]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, name, stage):
    """Nulls, empty and long texts, repeated rows, columns named like outputs, and an empty table."""
    kind = "doc_id bigint, text string, source string, kept string, shard string, copies string, digest string, label string"
    docs = spark.createDataFrame([(*r, "k", "s", "c", "d", "l") for r in ODD], kind)
    out = stage(spark, docs, SF)
    empty = stage(spark, docs.where("false"), SF)
    assert empty.count() == 0 and empty.columns == out.columns
    rows = out.toPandas()
    if name == "sharding":
        assert set(docs.columns) | {"law", "slot"} == set(out.columns) and len(rows) == len(ODD)
        return
    assert out.columns == docs.columns
    assert set(rows.digest) == {"d"} and set(rows.label) == {"l"}
    ids = sorted(rows.doc_id.fillna(0).astype(int))
    want = {"quality_rules": [0, 1, 1, 2, 7, 8], "near_dedup": [0, 0, 1, 1, 3, 4, 5, 6, 7, 8], "decontamination": [0, 0, 1, 1, 2, 3, 4, 5, 6, 7, 8]}
    if name in want:
        assert ids == want[name]
    else:
        assert set(ids) <= {0, 1, 2, 3, 4, 5, 6, 7, 8} and max(rows.doc_id.value_counts()) <= 6
