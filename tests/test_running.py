"""Read-ahead, batches of images, observed counters and progress, resource profiles, image lists and clashes."""

import os
import threading
import time
from collections import Counter

import numpy as np
import pytest

from prismarq.functions.tensor import decode_npy
from prismarq.operators import passes
from prismarq.operators.batching import Group, alone, batch_size, call_many
from prismarq.operators.progress import Progress
from prismarq.plans import catalogue, commands
from prismarq.sources import images
from prismarq.sources.readahead import ahead
from test_datasets import png, put


# --- read-ahead --------------------------------------------------------------------------


def test_order_and_bound():
    """Items come in order; what is read never runs further ahead than the depth."""
    read, lock = [], threading.Lock()

    def fetch(i):
        time.sleep(0.002 * (i % 3))
        with lock:
            read.append(i)
        return i * i

    got = []
    for n, (item, value, problem) in enumerate(ahead(range(30), fetch, depth=4, threads=3)):
        assert problem is None and value == item * item
        got.append(item)
        with lock:
            assert len(read) <= n + 1 + 4
    assert got == list(range(30)) and sorted(read) == got


def test_a_failed_read_is_an_item():
    def fetch(i):
        if i == 2:
            raise OSError("gone")
        return i

    got = list(ahead(range(5), fetch, depth=2))
    assert [v for _, v, _ in got] == [0, 1, None, 3, 4] and isinstance(got[2][2], OSError)
    assert list(ahead([], fetch)) == []


def test_closing_early_leaves_no_thread():
    begun = []
    stream = ahead(range(1000), lambda i: begun.append(i) or time.sleep(0.01), depth=5)
    next(stream)
    stream.close()
    assert len(begun) <= 7 and not [t for t in threading.enumerate() if t.name.startswith("read-ahead")]


def test_items_are_taken_as_they_are_needed():
    """A stream of rows is not drained into memory."""
    taken = []
    source = (taken.append(i) or i for i in range(100))
    stream = ahead(source, lambda i: i, depth=3)
    next(stream)
    assert len(taken) <= 4
    stream.close()


# --- batches -----------------------------------------------------------------------------


class Adder:
    """Adds one; notes how large its calls were and from which thread they came."""

    batch = 4

    def __init__(self):
        self.sizes, self.threads = [], set()

    def many(self, calls):
        self.sizes.append(len(calls))
        self.threads.add(threading.get_ident())
        if any(x < 0 for (x,) in calls):
            raise ValueError("negative")
        return [x + 1 for (x,) in calls]


def test_calls_go_out_together():
    one, two = Adder(), Adder()

    def work(k):
        def run(wrap):
            x = wrap(one)(k)
            return wrap(two)(x) if k % 2 else x

        return run

    assert Group().run([work(k) for k in range(6)]) == [k + 1 + k % 2 for k in range(6)]
    assert one.sizes == [4, 2] and two.sizes == [3] and one.threads == {threading.get_ident()}
    assert Group().run([]) == []


def test_one_image_is_a_batch_of_one():
    own = Adder()
    assert alone(own)(3) == 4 and own.sizes == [1] and alone(abs)(-2) == 2
    with pytest.raises(ValueError):
        alone(own)(-1)


def test_one_bad_call_spoils_no_other():
    answers = call_many(Adder(), [(1,), (-1,), (3,)])
    assert [a for a, _ in answers] == [2, None, 4] and isinstance(answers[1][1], ValueError)
    short = type("Short", (), {"batch": 2, "many": lambda self, calls: []})()
    assert isinstance(call_many(short, [(1,)])[0][1], RuntimeError)
    assert [call_many(lambda x: x * 2, [(2,), (3,)]), batch_size(lambda: 0), batch_size(Adder())] == [[(4, None), (6, None)], 1, 4]


class Flat:
    """A segmentation of one class per picture, eight pictures in a call."""

    batch = 8

    def many(self, calls):
        sizes.append(len(calls))
        return [np.eye(28)[int(x.mean() > 0)][:, None, None] * np.ones((1, 8, 8)) for (x,) in calls]


sizes: list[int] = []


def test_runner_batches_and_keeps_order(tmp_path):
    import pandas as pd

    rows = []
    for i in range(11):
        put(f"{tmp_path}/in/{i}.png", b"bad" if i == 4 else png(16, 16))
        rows.append((f"i{i:02d}", f"{tmp_path}/in/{i}.png", "bucket_16x16", ["seg", "pixel"]))
    frame = pd.DataFrame(rows, columns=["image_id", "path", "aspect_bucket", "todo"])
    sizes.clear()
    from test_datasets import decode

    out = pd.concat(list(passes._runner(decode, {"seg": Flat()}, f"{tmp_path}/out", depth=3)([frame])))
    assert out.image_id.tolist() == [r[0] for r in rows for _ in range(2)]
    assert sorted(out[out.outcome == "error"].image_id) == ["i04", "i04"] and (out[out.outcome == "error"].message == "ValueError: unreadable image").all()
    assert sizes == [7, 3]  # eight images a group, one of them unreadable
    with open(f"{tmp_path}/out/i10/seg.npy", "rb") as f:
        assert decode_npy(f.read()).shape == (16, 16)


# --- counters, progress, profiles --------------------------------------------------------


def test_counters_come_from_the_jobs(spark, tmp_path):
    from test_datasets import decode

    for i in range(5):
        put(f"{tmp_path}/in/{i}.png", png(32, 32))
    put(f"{tmp_path}/in/bad.png", b"no image")
    counts, lines = Counter(), []
    done, errors = commands.process_all(spark, f"{tmp_path}/in", f"{tmp_path}/out", ["pixel", "depth"], decode, {"depth": None}, counts=counts)
    rows = Counter(r["outcome"] for r in done.unionByName(errors).collect())
    assert counts == rows == {"processed": 5, "skipped_dependency": 5, "error": 1}
    again = Counter()
    commands.process_all(spark, f"{tmp_path}/in", f"{tmp_path}/out", ["pixel"], decode, {}, counts=again)
    assert again == {"skipped": 5, "error": 1}
    none = spark.createDataFrame([], "image_id string, path string, aspect_bucket string")
    nothing = Counter()
    assert passes.run_passes(none, lambda: images.scan_artifacts(spark, f"{tmp_path}/out"), ["pixel"], decode, {}, "x", nothing, report=lines.append).count() == 0
    assert nothing == {} and lines == []


def test_progress_reports_as_tasks_end(spark):
    lines = []
    with Progress(spark, 60, "pixel", lines.append, every=20, wait=0.01) as seen:

        def run(parts):
            for pdf in parts:
                time.sleep(0.4 + 0.4 * (pdf.id.min() // 10))
                seen.add(len(pdf))
                yield pdf

        assert spark.range(0, 60, 1, 6).mapInPandas(run, "id long").count() == 60
    told = [int(x.split(": ")[1].split(" of ")[0]) for x in lines]
    assert told == sorted(told) and told[-1] == 60 and len(told) >= 2 and lines[-1].startswith("pixel: 60 of 60 images, ") and lines[-1].endswith(" a second")


def test_profiles(spark):
    """Without GPUs, or on a local master, passes run as they are; elsewhere each task of a level asks for its share."""
    assert passes.gpu_profile(spark, 0) is None and passes.gpu_profile(spark, 1) is None

    class Away:
        """A cluster's session, as far as the profile looks at it."""

        def __init__(self, **conf):
            self.conf, self.sparkContext = conf, type("Context", (), {"master": "spark://host:7077"})

    assert passes.gpu_profile(Away(), 1) is None
    fixed = passes.gpu_profile(Away(**{"spark.executor.resource.gpu.amount": "2"}), 0.5)
    assert fixed.taskResources["gpu"].amount == 0.5 and not fixed.executorResources
    grown = passes.gpu_profile(Away(**{"spark.dynamicAllocation.enabled": "true"}), 1.0)
    assert grown.executorResources["gpu"].amount == 1 and grown.taskResources["cpus"].amount == 1
    plan = spark.range(3).mapInPandas(lambda parts: parts, "id long", profile=fixed)._jdf.queryExecution().logical()
    assert plan.profile().isDefined()


# --- image lists -------------------------------------------------------------------------


def test_lists_are_resolved_and_sorted(spark, tmp_path):
    top = os.path.realpath(tmp_path)
    put(f"{top}/set/b/two.png", b"x")
    put(f"{top}/set/a.png", b"x")
    os.symlink(f"{top}/set/b", f"{top}/set/link")
    os.symlink(f"{top}/set", f"{top}/other")
    put(f"{top}/list.txt", f"link/two.png\n b/../a.png \n\n./b/two.png\n{top}/elsewhere/../set/a.png\nhdfs://host/x/../y.png\n")
    rows = [tuple(r) for r in images.scan_list(spark, f"{top}/list.txt", f"{top}/other").collect()]
    assert [r for r in rows if r[0].startswith("/")] == [(f"{top}/set/a.png", "a"), (f"{top}/set/a.png", "a"), (f"{top}/set/b/two.png", "b/two"), (f"{top}/set/b/two.png", "b/two")]
    assert [r[0] for r in rows if not r[0].startswith("/")] == ["hdfs://host/y.png"]


def test_clashing_ids_are_named(spark, tmp_path, capsys):
    from test_datasets import decode

    put(f"{tmp_path}/in/a.png", png(8, 8))
    put(f"{tmp_path}/in/a.jpg", b"\xff\xd8")
    commands.process_all(spark, f"{tmp_path}/in", f"{tmp_path}/out", [], decode, {})
    said = [x for x in capsys.readouterr().err.splitlines() if "has the image id of" in x]
    assert len(said) == 1 and said[0].split()[1].endswith("a.png") and "a.jpg" in said[0]


@pytest.mark.parametrize(("path", "want"), [("file:///a/../b", "/b"), ("s3://bucket/x/./y/../z", "s3://bucket/x/z"), ("/a//b/", "/a/b")])
def test_resolved(path, want):
    assert images.resolved(path) == want


# --- tasks of work that lies in Python ---------------------------------------------------

TABLES = {
    "supplier": ["id AS s_suppkey", "CAST(id % 25 AS int) AS s_nationkey"],
    "part": ["id AS p_partkey", "CAST(id % 50 + 1 AS int) AS p_size"],
    "lineitem": ["id AS l_orderkey", "1 AS l_linenumber", "CAST(id % 50 AS double) AS l_quantity", "0.05D AS l_discount"],
}
SPREAD = [("whole_body", "supplier", 1000), ("crop_warp", "part", 100_000), ("pixel_tensor", "part", 100_000), ("person_boxes", "lineitem", 500_000), ("map_colours", "part", 100_000), ("grid_decode", "part", 100_000), ("dense_ramps", "lineitem", 500_000)]


@pytest.mark.parametrize("name, table, rows", SPREAD)
def test_rows_of_a_small_file_are_spread_over_tasks(spark, tmp_path, name, table, rows):
    spark.range(rows).selectExpr(*TABLES[table]).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    assert catalogue.QUERIES[name](spark, str(tmp_path)).rdd.getNumPartitions() == 10


def test_images_of_a_level_are_spread_over_tasks(spark, tmp_path, monkeypatch):
    """Tasks list the folders of their own images, and find what a scan of the dataset finds."""
    from pyspark import TaskContext

    monkeypatch.setattr(passes, "IMAGES_PER_TASK", 5, raising=False)
    for i in range(20):
        put(tmp_path / "in" / f"d{i % 2}" / f"p{i}.png", png(4, 5))
    out = str(tmp_path / "out")
    commands.process_all(spark, str(tmp_path / "in"), out, ["caption"], lambda data: np.zeros((5, 4, 3), dtype=np.uint8), {"caption": lambda image, n: str(TaskContext.get().partitionId())})
    captions = [p.read_text() for p in (tmp_path / "out").rglob("caption.txt")]
    assert len(captions) == 20 and len(set(captions)) > 2
    put(tmp_path / "out" / "d0" / "p0" / "other.txt", b"x")
    rows = lambda df: sorted((r["image_id"], r["artifact"], r["length"]) for r in df.collect())
    wanted = images.scan_artifacts(spark, out)
    assert rows(images.artifacts_of(wanted.select("image_id").distinct(), out)) == rows(wanted)
    assert images.artifacts_of(spark.createDataFrame([("none",)], "image_id string"), out).count() == 0
