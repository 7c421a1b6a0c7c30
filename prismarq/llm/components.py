"""Connected components of a link table.

Every task first reduces its links to a spanning forest (or those that make them do), so a group that is linked
many times over costs each task one link per vertex.  A table that is then counted
to have at most ``ONE_TASK`` links (16 bytes each) is settled by union-find in one
task; a larger one by minimum labels with pointer jumping: each round hands every
vertex the smallest label among its neighbours and then the label of that label.
Both are joins and partial aggregations, so a vertex with very many links is one
aggregated row per task.  Rounds are written to the shared folder; nothing but a
count reaches the driver.  Both ways give the same labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismarq.llm.common import give_back, write_table

ONE_TASK = 2_000_000


def labels_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices of the links (a, b), and the smallest vertex of each one's component."""
    ids, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    up = np.arange(len(ids))
    while len(x):
        x, y = up[x], up[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up[up] != up).any():
            up = up[up]
    return ids, ids[up]


def _forest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of each vertex of these rows to the smallest one of its component."""
    held = [(p["a"].to_numpy(), p["b"].to_numpy()) for p in parts]
    if held:
        v, low = labels_of(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]))
        del held
        yield pd.DataFrame({"a": v, "b": low})
    give_back()


def components(links: DataFrame, most_rounds: int = 100, one_task: int = ONE_TASK, forests: bool = False) -> DataFrame:
    """(v, label) for every vertex of ``links`` (a, b: bigint; vertices linked only to themselves left out); the label is the smallest vertex of its component.

    ``forests``: the tasks that make ``links`` send forests already, and need no second Python worker beside them.
    """
    links = links.where("a <> b").select("a", "b")
    if not forests:
        links = links.mapInPandas(_forest, "a long, b long").where("a <> b")
    links = write_table(links.distinct())
    if links.count() <= one_task:
        return write_table(links.coalesce(1).mapInPandas(_forest, "a long, b long").toDF("v", "label"))
    both = write_table(links.union(links.select("b", "a")))
    labels = write_table(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "v"))
    for _ in range(most_rounds):
        near = both.join(labels, both.b == labels.v).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, labels.v == near.a).select("v", F.col("label").alias("was"), F.least("label", "near").alias("low"))
        up = labels.select(F.col("v").alias("u"), F.col("label").alias("over"))
        nxt = low.join(up, low.low == up.u).select("v", "was", F.least("low", "over").alias("label"))
        nxt = write_table(nxt)
        labels = nxt.select("v", "label")
        if nxt.where("label <> was").isEmpty():
            return labels
    raise RuntimeError("components did not settle; raise most_rounds")
