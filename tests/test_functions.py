import numpy as np
import pytest
from pyspark.sql import functions as F

from prismarq.functions import dense as D
from prismarq.functions import geometry as G
from prismarq.functions import tensor as V
from prismarq.functions import text as X
from prismarq.operators import detection, manifest, positional
from prismarq.sources import hub


def column(spark, values, kind, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", f(F.col("v")).alias("r"))
    return [r["r"] for r in sorted(rows.collect())]


def test_image_ids(spark):
    names = ["a.png", "a.b.png", ".hid", "d/.hid", "d/a.", "d/e/f.JPG", "x"]
    assert column(spark, names, "string", X.image_id) == ["a", "a.b", ".hid", "d/.hid", "d/a.", "d/e/f", "x"]
    assert column(spark, names, "string", X.is_image) == [True, True, False, False, False, True, False]


def test_captions(spark):
    texts = ["a\r\nb", " \tx y\u0085", "\x1c z", None, "", "one  two"]
    assert column(spark, texts, "string", X.single_paragraph) == ["a b", "x y", "z", "", "", "one two"]
    assert column(spark, ["x" * 121, "y"], "string", X.preview) == ["x" * 120 + "...", "y"]


def test_labels_and_versions(spark):
    got = column(spark, ["00000-09999.parquet", "70000-79999.tar", "manifest.json", "", "00000-09999"], "string", X.parse_range_label)
    assert [tuple(g) if g else None for g in got] == [(0, 9999), (70000, 79999), None, None, None]
    assert column(spark, ["0.0.5", "1", "1.2.3.4"], "string", X.bump_version) == ["0.0.6", "1.0.1", "1.2.4"]
    assert [manifest.bump(v) for v in ("0.0.5", "1", "1.2.3.4")] == ["0.0.6", "1.0.1", "1.2.4"]
    assert column(spark, [0, 1023, 1024, 1536, 1 << 30], "bigint", X.human_size) == ["0 B", "1023 B", "1.0 KB", "1.5 KB", "1.0 GB"]


def test_buckets(spark):
    rows = spark.createDataFrame([(1024, 1024), (800, 1200), (10, 0), (2097, 2796)], "w bigint, h bigint")
    assert [r[0] for r in rows.select(G.nearest_bucket(F.col("w"), F.col("h"))).collect()] == ["1024x1024", "832x1216", "1024x1024", "832x1216"]
    got = column(spark, ["832x1216", "bucket_832x1216", "invalid", ""], "string", G.parse_bucket)
    assert [tuple(g) if g else None for g in got] == [(832, 1216), (832, 1216), None, None]


def test_boxes(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 9.0, 9.0, 5.0, 0.0, 14.0, 9.0)], "a double, b double, c double, d double, e double, f double, g double, h double")
    box = lambda *n: F.struct(*[F.col(x).alias(k) for x, k in zip(n, ("x1", "y1", "x2", "y2"))])
    assert rows.select(G.iou(box("a", "b", "c", "d"), box("e", "f", "g", "h"))).first()[0] == pytest.approx(50 / 150)
    one = detection.suppress(*[np.array(v, dtype=float) for v in ([0, 0, 50], [0, 0, 50], [9, 9, 60], [9, 8, 60])], np.arange(3), 0.45)
    assert one.tolist() == [True, False, True]


@pytest.mark.parametrize("dtype", ["<f2", "<f4", "|u1", "<i4"])
def test_npy(spark, dtype):
    for shape in ((1024,), (4, 5), (3, 2, 2), ()):
        a = np.arange(int(np.prod(shape))).reshape(shape).astype(dtype)
        data = V.encode_npy(a)
        np.testing.assert_array_equal(V.decode_npy(data), a)
        head = spark.createDataFrame([(bytearray(data),)], "c binary").select(V.npy_header(F.col("c")).alias("h")).first()["h"]
        assert (head["descr"], tuple(head["shape"])) == (dtype, shape)


def test_broken_npy(spark):
    rows = spark.createDataFrame([(bytearray(b"not a valid npy file"),), (bytearray(b""),), (None,)], "c binary")
    assert [r["h"] for r in rows.select(V.npy_header(F.col("c")).alias("h")).collect()] == [None] * 3
    with pytest.raises(ValueError):
        V.decode_npy(b"not a valid npy file")


def test_packing():
    sizes = np.array([10, 10, 10, 1, 1, 1, 30, 5])
    assert positional.greedy_groups(sizes, 25, 3).tolist() == [0, 0, 1, 1, 1, 2, 3, 4]
    assert positional.greedy_groups(np.array([5, 5]), 1, None).tolist() == [0, 1]
    assert positional.greedy_groups(np.ones(5, dtype=int), None, 2).tolist() == [0, 0, 1, 1, 2]
    assert positional.greedy_groups(np.zeros(0, dtype=int), 1, 1).tolist() == []


def test_positions_and_shards(spark):
    rows = spark.createDataFrame([(f"{x}/n",) for x in ("a-b", "a", "b", "c", "d")], "p string")
    got = positional.with_position(rows, X.components(F.col("p")), ranges=3).orderBy("pos").collect()
    assert [r["pos"] for r in got] == [0, 1, 2, 3, 4] and [r["p"] for r in got] == ["a/n", "a-b/n", "b/n", "c/n", "d/n"]
    parts = [{r["p"] for r in positional.shard(rows, n, 3, "p").collect()} for n in range(3)]
    assert set.union(*parts) == {r["p"] for r in got} and sum(map(len, parts)) == 5
    assert positional.with_position(rows.where("false"), "p").count() == 0
    for wrong in ("3/3", "-1/2", "1", "a/b"):
        with pytest.raises(ValueError):
            positional.parse_shard(wrong)


def test_overlaps(spark):
    rows = spark.createDataFrame([("l", 0, 9, "a", 1), ("l", 5, 6, "b", 1), ("l", 10, 12, "c", 1), ("m", 0, 9, "d", 1)], manifest.CHUNKS)
    assert [tuple(r) for r in manifest.overlaps(rows).collect()] == [("l", "a", "b")]


def test_dense():
    rng = np.random.default_rng(0)
    image = rng.integers(0, 255, (64, 48, 3), dtype=np.uint8)
    assert D.cover_crop(image, 32, 40).shape == (40, 32, 3)
    p = D.pixels(image)
    assert p.dtype == np.float16 and p.shape == (3, 64, 48) and 0 <= p.min() and p.max() <= 1
    seg = D.class_map(rng.normal(size=(29, 16, 12)), 64, 48)
    assert seg.dtype == np.uint8 and seg.shape == (64, 48) and seg.max() < 29
    seg[:10] = 0
    d = D.depth_map(rng.normal(size=(16, 12)), seg)
    assert d[:10].max() == 0 and d.max() == 1
    n = D.normal_map(rng.normal(size=(3, 16, 12)), seg)
    assert np.allclose(np.linalg.norm(n[seg > 0].astype(np.float32), axis=1), 1, atol=5e-3) and not n[:10].any()
    assert D.point_map(np.ones((3, 16, 12)), 2.0, (1, 1, 2, 2), seg)[20, 20].tolist() == [0.5] * 3 or seg[20, 20] == 0
    assert D.alpha(np.full((4, 8, 8), 1.5), 64, 48).max() == 1
    assert not D.unit_keypoints(None, None, 10, 10).any()
    np.testing.assert_allclose(D.resize(np.ones((3, 4, 5)), 9, 7), 1)
    m = D.crop_matrix(np.array([50.0, 60.0]), np.array([288.0, 384.0]), (288, 384))
    np.testing.assert_allclose(m @ np.array([144, 192, 1]), [50, 60])
    at, score = D.decode_simcc(np.eye(4, 576)[:1] * 2, np.eye(4, 768)[:1], np.array([0.0, 0.0]), np.array([288.0, 384.0]))
    assert score.tolist() == [1.0] and at.tolist() == [[-144.0, -192.0]]
    grid = detection.decode_grid(np.zeros((8400, 6), dtype=np.float32))
    assert grid[0, :4].tolist() == [0, 0, 8, 8] and grid[-1, :4].tolist() == [608, 608, 32, 32]


class _Response:
    def __init__(self, code, headers=None):
        self.status_code, self.headers = code, headers or {}


def _http(code, headers=None):
    e = RuntimeError(f"status {code}")
    e.response = _Response(code, headers)
    return e


def test_retries():
    assert hub.is_rate_limited(_http(429)) and hub.is_rate_limited(RuntimeError("got 429")) and not hub.is_rate_limited(_http(500))
    assert [hub.retry_after(_http(429, {"Retry-After": x})) for x in ("30", "0", "soon")] == [30, 1, None]
    wrapped = RuntimeError("upload failed")
    wrapped.__cause__ = ConnectionError("x")
    for e in (ConnectionError(), TimeoutError(), OSError("x"), wrapped, RuntimeError("[Errno 104] reset")):
        assert hub.is_transient(e)
    assert not hub.is_transient(ValueError("bad"))
    waits, tries = [], iter([_http(429, {"Retry-After": "7"}), ConnectionError(), TimeoutError()])

    def call():
        for e in tries:
            raise e
        return "done"

    assert hub.with_retries(call, sleep=waits.append) == "done" and waits == [7, 20.0, 40.0]
    with pytest.raises(ValueError):
        hub.with_retries(lambda: (_ for _ in ()).throw(ValueError("no")), sleep=waits.append)


def test_stall(tmp_path):
    import time

    class Slow:
        def upload(self, local, path):
            time.sleep(1)

    with pytest.raises(TimeoutError):
        hub.upload(Slow(), "a", "b", stall=0.1)
