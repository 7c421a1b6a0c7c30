"""Queries with SQL against DuckDB, the others against brute force, on the smallest tables."""

import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from conftest import duck, same_rows

from prismarq.llm import compression_classifier, html_extract, near_dedup, registry, sharding, substring_dedup, token_files

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    got = registry.queries()[name](spark, SF).toPandas()
    same_rows(got, duck(SF).execute(registry.oracle_sql()[name]).fetch_df())


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in registry.queries()} == set(range(1, 14))


def brute_components(texts: dict[int, str], k: int, percent: int = 80) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    up[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_op5(spark, documents):
    got = near_dedup.op5_chosen_path(spark, SF).toPandas().set_index("doc_id")
    for i, (n, c) in brute_components(dict(zip(documents.doc_id, documents.text)), 2).items():
        assert (got.n_shingles[i], got.component_id[i], got.kept[i]) == (n, c, c == i)


def brute_repeats(texts: list[bytes], length: int) -> list[np.ndarray]:
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        out.append(np.cumsum(cover[:-1]) > 0)
    return out


@pytest.mark.parametrize("giant", [20_000, 1])
def test_op3(spark, documents, giant, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GIANT", giant)
    got = substring_dedup.op3_suffix_dedup(spark, SF).toPandas().set_index("doc_id")
    texts = [t.encode() for t in documents.text]
    for i, t, hit in zip(documents.doc_id, texts, brute_repeats(texts, 200)):
        spans = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        kept = np.frombuffer(t, dtype=np.uint8)[~hit].tobytes()
        assert tuple(got.loc[i]) == (len(t), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_op6(spark, documents):
    from tokenizers import Tokenizer

    got = token_files.op6_token_files(spark, SF).toPandas().set_index("doc_id")
    tokenizer, at = Tokenizer.from_file(token_files.vocabulary_path()), 0
    for i, t in zip(documents.doc_id, documents.text):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        assert tuple(got.loc[i]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_op8(spark, documents):
    got = sharding.op8_hypergeometric_shards(spark, SF).toPandas()
    assert sorted(got.doc_id) == sorted(documents.doc_id)
    want = {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in zip(documents.doc_id, documents.text)}
    assert {i: (s, c) for i, s, c in zip(got.doc_id, got["size"], got.text_crc32)} == want
    counts = got.groupby("shard").slot.agg(["count", "min", "max"])
    assert counts["count"].max() - counts["count"].min() <= 1 and list(counts.index) == list(range(24))
    assert (counts["min"] == 0).all() and (counts["max"] == counts["count"] - 1).all()
    assert set(got.law) == {"rows"} and got.grown_shard.isna().all()
    again = sharding.op8_hypergeometric_shards(spark, SF).toPandas()
    pd.testing.assert_frame_equal(got.sort_values("doc_id", ignore_index=True), again.sort_values("doc_id", ignore_index=True))


def test_op1(spark):
    folder = SF.replace("sf0.001", "sf0.01")
    got = compression_classifier.op1_compression_quality(spark, folder).toPandas()
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    known = got.merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    out = known[known.held_out]
    assert (out.predicted == out.quality).mean() > 0.9


def test_op4(spark):
    import html

    got = html_extract.op4_tree_scoring(spark, SF).toPandas().set_index("page_id")
    for page, text in pd.read_parquet(f"{SF}/pages.parquet")[["page_id", "html"]].itertuples(index=False):
        inside = text[text.index("<article>") + 9 :].split("</article>")[0].split("<footer>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"</?(b|br)>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        want = "\n".join(b for b in blocks if b)
        assert (got.text[page], got.n_chars[page]) == (want, len(want))
