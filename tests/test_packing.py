"""Greedy packing by composition against the fold, on sizes that break groups at the ends of ranges."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prismarq.operators.positional import GreedyRange, greedy_groups, pack_greedy

LIMITS = st.one_of(st.none(), st.integers(1, 30)), st.one_of(st.none(), st.integers(1, 6))


def fold(sizes, most_bytes, most_rows):
    """Row by row, the way a person would pack."""
    out, group, held, rows = [], -1, 0, 0
    for s in sizes:
        if group < 0 or most_bytes is not None and held + s > most_bytes or most_rows is not None and rows >= most_rows:
            group, held, rows = group + 1, 0, 0
        held, rows = held + s, rows + 1
        out.append(group)
    return out


@given(st.lists(st.integers(0, 12), max_size=50), *LIMITS, st.lists(st.integers(0, 50), max_size=4))
@settings(max_examples=400, deadline=None)
def test_ranges_compose_to_the_fold(sizes, most_bytes, most_rows, cuts):
    want = fold(sizes, most_bytes, most_rows)
    assert greedy_groups(np.array(sizes, dtype=np.int64), most_bytes, most_rows).tolist() == want
    held, rows, group, got = 0, 0, -1, []
    for part in np.split(np.array(sizes, dtype=np.int64), sorted(min(c, len(sizes)) for c in cuts)):
        if len(part) == 0:
            continue
        own = GreedyRange(part, most_bytes, most_rows)
        got += own.numbers(own.joined(held, rows), group).tolist()
        table = own.outcomes()
        fit = [x for x in table[1:] if rows and (most_bytes is None or held + x[1] <= most_bytes) and (most_rows is None or rows + x[0] <= most_rows)]
        _, _, groups, open_bytes, open_rows = fit[-1] if fit else table[0]
        group += groups
        held, rows = (open_bytes, open_rows) if groups else (held + open_bytes, rows + open_rows)
    assert got == want


@pytest.mark.parametrize(("most_bytes", "most_rows"), [(100, None), (None, 7), (60, 5), (1, None), (None, None)])
@pytest.mark.parametrize("ranges", [1, 6])
def test_pack_greedy(spark, most_bytes, most_rows, ranges):
    """One layer holds most rows and spans ranges; null keys are a key."""
    rng = np.random.default_rng(3)
    rows = [(layer, p, int(s)) for layer, n in (("big", 400), (None, 30), ("one", 1)) for p, s in enumerate(rng.integers(0, 40, n))]
    got = pack_greedy(spark.createDataFrame(rows, "layer string, pos long, bytes long"), ["layer"], "pos", "bytes", most_bytes, most_rows, ranges).toPandas()
    assert list(got.columns) == ["layer", "pos", "bytes", "grp"] and len(got) == len(rows)
    for layer in ("big", None, "one"):
        own = got[got.layer.isna() if layer is None else got.layer == layer].sort_values("pos")
        assert own.grp.tolist() == fold([s for k, _, s in rows if k == layer], most_bytes, most_rows)


def test_outcomes_are_few():
    """Groups that begin at different rows fall together: what a range hands on does not grow with its rows."""
    rng = np.random.default_rng(4)
    few = [len(GreedyRange(rng.integers(1, 2000, n), 1_000_000, 5000).outcomes()) for n in (20_000, 200_000)]
    assert few[1] <= 2 * few[0] + 50


def test_nothing_to_pack(spark):
    empty = spark.createDataFrame([], "layer string, pos long, bytes long")
    assert pack_greedy(empty, ["layer"], "pos", "bytes", 10, None).count() == 0
    assert isinstance(pack_greedy(empty, ["layer"], "pos", "bytes", 10, None).toPandas(), pd.DataFrame)
