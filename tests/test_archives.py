"""Indexed archives, uploads by the tasks, and publishing to hubs named by URI."""

import json
import os
import tarfile

import numpy as np
import pytest

from prismarq.functions.tensor import encode_npy
from prismarq.plans import publish
from prismarq.sources import files, hub, tar
from prismarq.sources.hub import FolderHub


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def archives(spark, folder, n=500, **options):
    rows = [(f"{p // 250:05d}-{p // 250:05d}", p, f"sub/img{p:04d}", f, f"{p}{f}".encode() * (1 + p % 7)) for p in range(n) for f in ("a.npy", "b.txt")]
    tar.write_tars(spark.createDataFrame(rows, tar.WRITE), folder, **options)
    return rows


def fetched(log):
    return [x for name in os.listdir(log) for x in json.loads(files.read_bytes(f"{log}/{name}"))]


def test_one_key_reads_one_range(spark, tmp_path):
    rows = archives(spark, str(tmp_path / "t"), index=True)
    assert sorted(os.listdir(tmp_path / "t")) == ["00000-00000.tar", "00000-00000.tar.index", "00001-00001.tar", "00001-00001.tar.index"]
    all_rows = tar.read_tars(spark, str(tmp_path / "t")).collect()
    assert {(r["key"], r["member"], bytes(r["content"])) for r in all_rows} == {(r[2], r[3], r[4]) for r in rows} and len(all_rows) == len(rows)
    os.makedirs(tmp_path / "log")
    found = tar.read_tars(spark, str(tmp_path / "t"), log=str(tmp_path / "log")).where("key = 'sub/img0300' and member = 'b.txt'")
    assert [(r["shard"], r["pos"], bytes(r["content"])) for r in found.collect()] == [("00001-00001.tar", 50, b"300b.txt" * 7)]
    assert [x["length"] for x in fetched(tmp_path / "log")] == [56]  # the member alone, not its archive
    assert "PythonDataSource" in found._jdf.queryExecution().toString() or found.count() == 1


def test_filters(spark, tmp_path):
    rows = archives(spark, str(tmp_path / "t"), index=True)
    read = lambda **o: tar.read_tars(spark, str(tmp_path / "t"), **o)
    assert read().where("key in ('sub/img0001', 'sub/img0499', 'none')").count() == 4
    assert read().where("key like 'sub/img049%'").count() == 20
    assert read().where("shard = '00000-00000.tar' and pos >= 10 and pos < 13").count() == 6
    assert read().where("length(key) = 3 or pos = 0").count() == 4
    assert read().where("shard = 'none'").count() == 0
    parts = read(splitBytes=20_000)
    assert parts.rdd.getNumPartitions() > 2 and parts.count() == len(rows)
    assert parts.where("key = 'sub/img0300'").count() == 2
    os.remove(tmp_path / "t/00001-00001.tar.index")  # one without an index is streamed, with the same rows
    assert read().count() == len(rows) and read().where("key = 'sub/img0300'").count() == 2
    before = {tuple(r) for r in tar.read_places(spark, str(tmp_path / "t")).collect()}
    assert tar.index_tars(spark, str(tmp_path / "t")) == 1 and tar.index_tars(spark, str(tmp_path / "t")) == 0
    places = tar.read_places(spark, str(tmp_path / "t")).collect()
    assert {tuple(r) for r in places} == before and len(places) == len(rows)
    for r in places[:50]:
        with open(tmp_path / "t" / r["shard"], "rb") as f:
            f.seek(r["start"])
            assert f.read(r["length"]) == {(x[2], x[3]): x[4] for x in rows}[(r["key"], r["member"])]


def test_long_names_and_empty_members(spark, tmp_path):
    rows = [("00000-00001", i, "k" * (40 + 90 * i), "é" * 30 + ".txt", b"" if i else b"x" * 513) for i in range(3)]
    tar.write_tars(spark.createDataFrame(rows, tar.WRITE), str(tmp_path), index=True)
    got = {(r["key"], r["member"], bytes(r["content"])) for r in tar.read_tars(spark, str(tmp_path)).collect()}
    assert got == {(r[2], r[3], r[4]) for r in rows}
    with tarfile.open(tmp_path / "00000-00001.tar") as t:
        assert [m.offset_data for m in t] == [r["start"] for r in tar.read_places(spark, str(tmp_path)).orderBy("pos").collect()]


class Flaky(FolderHub):
    """Fails once per file with a passing error, by a mark in its folder; files named bad always fail."""

    def upload(self, local, path):
        if "bad" in path:
            raise ValueError(f"refused {path}")
        mark = f"{self.root}-marks/{path.replace('/', '_')}"
        if not files.exists(mark):
            files.write_bytes(mark, b"")
            raise ConnectionError("lost")
        super().upload(local, path)


def test_tasks_upload_with_retries(spark, tmp_path):
    for i in range(6):
        put(f"{tmp_path}/in/{i}", f"body {i}")
    put(f"{tmp_path}/manifest", "m")
    own = Flaky(f"file://{tmp_path}/hub")
    payload = [(f"file://{tmp_path}/in/{i}", f"layer/{i}.tar") for i in range(6)]
    assert hub.upload_all(spark, own, payload, [(f"{tmp_path}/manifest", "manifest.json")], wait=0.01) == 7
    assert own.list_files() == [*(f"layer/{i}.tar" for i in range(6)), "manifest.json"] and own.read("layer/3.tar") == b"body 3"


def test_a_failed_task_leaves_no_manifest(spark, tmp_path):
    put(f"{tmp_path}/in/a", "x")
    own = Flaky(f"{tmp_path}/hub")
    with pytest.raises(ValueError, match="refused layer/bad.tar"):
        hub.upload_all(spark, own, [(f"{tmp_path}/in/a", "layer/a.tar"), (f"{tmp_path}/in/a", "layer/bad.tar")], [(f"{tmp_path}/in/a", "manifest.json")], wait=0.01)
    assert own.list_files() == ["layer/a.tar"]


def test_publish_by_uri(spark, tmp_path):
    """Dataset, staging and hub are URIs; archives come with their indexes, and one image is read by range from the hub."""
    for i in range(7):
        meta = {"image_id": f"img{i}", "source_path": "x", "width": 8, "height": 8, "aspect_bucket": "8x8"}
        put(f"{tmp_path}/data/img{i}/metadata.json", json.dumps(meta))
        put(f"{tmp_path}/data/img{i}/caption.txt", f"caption {i}")
        put(f"{tmp_path}/data/img{i}/pose.npy", encode_npy(np.full((133, 3), i, dtype=np.float16)))
    own = FolderHub(f"file://{tmp_path}/hub")
    new = publish.publish(spark, f"file://{tmp_path}/data", own, "u/r", ["caption", "pose"], max_files=3, staging=f"file://{tmp_path}/stage", index=True)
    assert new["layers"]["pose"]["chunks"] == {"00000-00002": 3, "00003-00005": 3, "00006-00006": 1}
    assert [f for f in own.list_files() if f.startswith("pose")] == [f"pose/{x}.tar{s}" for x in ("00000-00002", "00003-00005", "00006-00006") for s in ("", ".index")]
    assert not os.listdir(tmp_path / "stage")
    os.makedirs(tmp_path / "log")
    one = tar.read_tars(spark, f"file://{tmp_path}/hub/pose", log=str(tmp_path / "log")).where("key = 'img4'").collect()
    assert [bytes(r["content"]) for r in one] == [encode_npy(np.full((133, 3), 4, dtype=np.float16))]
    assert len(fetched(tmp_path / "log")) == 1
    assert set(publish.reconcile(spark, own, "u/r", dry_run=True)["layers"]) == {"caption", "pose"}
