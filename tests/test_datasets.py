"""Commands over small datasets in temporary folders."""

import json
import os
import struct
import zlib

import numpy as np
import pytest

from prismarq.functions.tensor import decode_npy, encode_npy
from prismarq.operators import passes
from prismarq.plans import commands, publish
from prismarq.sources import images, tar
from prismarq.sources.hub import FolderHub
from prismarq.streaming import incremental


def png(w, h, colour=(128, 64, 32)) -> bytes:
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + bytes(colour) * w for _ in range(h))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


def decode(content):
    size = images.image_size(content)
    return None if size is None else np.full((size[1], size[0], 3), 100, dtype=np.uint8)


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def dataset(top, n, **tensors):
    for i in range(n):
        put(f"{top}/img{i:04d}/metadata.json", json.dumps({"image_id": f"img{i:04d}", "source_path": "x", "width": 512, "height": 512, "aspect_bucket": "512x512"}))
        put(f"{top}/img{i:04d}/caption.txt", f" caption {i}\n")
        for name, array in tensors.items():
            put(f"{top}/img{i:04d}/{name}.npy", encode_npy(array))


def test_scan(spark, tmp_path):
    put(f"{tmp_path}/img1.jpg", b"x")
    put(f"{tmp_path}/sub/img2.PNG", png(20, 30))
    put(f"{tmp_path}/readme.txt", b"x")
    found = images.scan_images(spark, str(tmp_path))
    assert sorted(r["image_id"] for r in found.collect()) == ["img1", "sub/img2"]
    sized = images.with_size(found.select("path", "image_id"))
    assert {(r["image_id"], r["width"], r["height"]) for r in sized.collect()} == {("img1", None, None), ("sub/img2", 20, 30)}
    put(f"{tmp_path}/list.txt", "img1.jpg\n\n  sub/img2.PNG  \nimg1.jpg\n")
    listed = images.scan_list(spark, f"{tmp_path}/list.txt", str(tmp_path))
    assert sorted(r["image_id"] for r in listed.collect()) == ["img1", "img1", "sub/img2"]


def test_image_sizes():
    assert images.image_size(png(7, 9)) == (7, 9)
    assert images.image_size(b"GIF89a" + struct.pack("<HH", 3, 4)) == (3, 4)
    assert images.image_size(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 5, 6) + b"0" * 9) == (6, 5)
    assert images.image_size(b"junk") is None and images.image_size(None) is None


def late_tiff(w, h, pixels):
    """A TIFF whose directory stands after ``pixels`` bytes of pixel data."""
    entries = [(256, 3, 1, w), (257, 4, 1, h), (258, 3, 1, 8)]
    return b"II*\0" + struct.pack("<I", 8 + pixels) + bytes(pixels) + struct.pack("<H", 3) + b"".join(struct.pack("<HHII", *x) for x in entries) + bytes(4)


def test_sizes_beyond_the_header(spark, tmp_path, capsys):
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(f"{root}/late.tif", late_tiff(70, 80, 200_000))
    put(f"{root}/cut.tif", late_tiff(300, 400, images.HEADER_BYTES - 8 - 2 - 20))  # the first bytes end within the height's entry
    segments = (b"\xff\xe1" + struct.pack(">H", 60_002) + bytes(60_000)) * 2
    put(f"{root}/exif.jpg", b"\xff\xd8" + segments + b"\xff\xc0\x00\x11\x08" + struct.pack(">HH", 50, 60) + b"0" * 9)
    put(f"{root}/bad.png", b"not an image" * 9000)
    done, errors = commands.process_all(spark, root, out, ["caption"], decode, {"caption": lambda image, n: "a"})
    assert [tuple(r) for r in errors.collect()] == [("bad", "metadata", "error", "unreadable image")]
    assert {(r["image_id"], r["outcome"]) for r in done.collect()} == {(i, "processed") for i in ("late", "cut", "exif")}
    sizes = {}
    for i in ("late", "cut", "exif"):
        with open(f"{out}/{i}/metadata.json") as f:
            made = json.load(f)
        sizes[i] = (made["width"], made["height"])
    assert sizes == {"late": (70, 80), "cut": (300, 400), "exif": (60, 50)}
    warned = [x for x in capsys.readouterr().err.splitlines() if "warning: cannot read dimensions" in x]
    assert len(warned) == 1 and warned[0].endswith("bad.png")


def test_process_resumes(spark, tmp_path):
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(f"{root}/a.png", png(200, 300))
    put(f"{root}/d/b.png", png(64, 64))
    put(f"{root}/bad.png", b"not an image")
    backends = {"caption": lambda image, n: "a\n picture", "t5": lambda text: (np.zeros((512, 1024)), np.ones(512)), "seg": lambda x: np.eye(28)[:, :, None] * np.ones(8), "depth": lambda x: np.arange(64.0).reshape(8, 8)}
    run = lambda: commands.process(spark, root, out, ["caption", "t5", "seg", "depth", "pixel", "nonsense"], decode, backends)
    first = {(r["image_id"], r["pass"]): r["outcome"] for r in run().collect()}
    assert first == {(i, p): "processed" for i in ("a", "d/b") for p in ("caption", "t5", "seg", "depth", "pixel")}
    with open(f"{out}/a/pixel.npy", "rb") as f:
        x = decode_npy(f.read())
    assert x.shape == (3, 1216, 832) and x.dtype == np.float16
    with open(f"{out}/a/t5_mask.npy", "rb") as f:
        assert decode_npy(f.read()).dtype == np.uint8
    assert {r["outcome"] for r in run().collect()} == {"skipped"}
    os.remove(f"{out}/a/seg.npy")
    os.remove(f"{out}/a/depth.npy")
    again = run()
    assert {(r["image_id"], r["pass"]) for r in again.where("outcome = 'processed'").collect()} == {("a", "seg"), ("a", "depth")}
    n = {r["artifact"]: r["n"] for r in commands.status(spark, out).collect()}
    assert n["metadata"] == 2 and n["pixel"] == 2 and n["pose"] == 0
    assert commands.verify(spark, out)[1]["issues"] == 0
    counts = {r["outcome"]: r["n"] for r in passes.counters(run()).collect()}
    assert counts == {"skipped": 10}


def test_dependencies(spark, tmp_path):
    put(f"{tmp_path}/in/a.png", png(64, 64))
    got = commands.process(spark, f"{tmp_path}/in", f"{tmp_path}/out", ["depth", "caption"], decode, {"caption": lambda i, n: 1 / 0}).collect()
    assert {(r["pass"], r["outcome"]) for r in got} == {("depth", "skipped_dependency"), ("caption", "error")}
    assert passes.levels(["t5", "caption", "depth", "seg"]) == [["caption", "seg"], ["t5", "depth"]]
    assert passes.resolve_passes("all") == list(passes.DEFAULT_PASSES) and passes.resolve_passes(" a, ,b") == ["a", "b"]


def test_verify_prints_every_issue(spark, tmp_path, monkeypatch, capsys):
    found = spark.range(1200).selectExpr("lpad(id, 5, '0') AS image_id", "'seg' AS artifact", "'dtype' AS kind", "'x' AS detail")
    monkeypatch.setattr(commands, "verify", lambda *_: (found, {"issues": 1200}))
    assert commands.main(["verify", str(tmp_path)]) == 1
    assert capsys.readouterr().out.splitlines() == [f"{i:05d}: seg: dtype: x" for i in range(1200)] + ["{'issues': 1200}"]


def test_verify_fix(spark, tmp_path):
    top = str(tmp_path)
    dataset(top, 2, dinov3_cls=np.zeros(1024, dtype=np.float32), seg=np.zeros((512, 512), dtype=np.uint8))
    put(f"{top}/img0001/pose.npy", b"not a valid npy file")
    put(f"{top}/img0001/caption.txt", " \n")
    put(f"{top}/broken/metadata.json", "{")
    found, counts = commands.verify(spark, top)
    kinds = sorted((r["image_id"], r["artifact"], r["kind"]) for r in found.collect())
    assert kinds == [("broken", "metadata", "corrupt"), ("img0000", "dinov3_cls", "dtype"), ("img0001", "caption", "empty"), ("img0001", "dinov3_cls", "dtype"), ("img0001", "pose", "corrupt")]
    assert counts["images"] == 3 and counts["issues"] == 5
    assert commands.verify(spark, top, fix=True)[1]["converted"] == 2
    assert not os.path.exists(f"{top}/img0001/pose.npy")
    assert {r["kind"] for r in commands.verify(spark, top)[0].collect()} == {"corrupt", "empty"}


def test_tar_round_trip(spark, tmp_path):
    rows = [(f"{p // 2:05d}-{p // 2 + 1:05d}", p, f"img{p}", f, bytearray(f"{p}{f}".encode())) for p in range(5) for f in ("b.npy", "a.npy")]
    tar.write_tars(spark.createDataFrame(rows, tar.WRITE), str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == ["00000-00001.tar", "00001-00002.tar", "00002-00003.tar"]
    got = tar.read_tars(spark, str(tmp_path)).collect()
    assert {(r["key"], r["member"], bytes(r["content"])) for r in got} == {(r[2], r[3], bytes(r[4])) for r in rows}
    assert [(r["pos"], r["member"]) for r in got if r["shard"] == "00000-00001.tar"] == [(0, "a.npy"), (0, "b.npy"), (1, "a.npy"), (1, "b.npy")]


def test_publish_and_reconcile(spark, tmp_path):
    data, hub = f"{tmp_path}/data", FolderHub(f"{tmp_path}/hub")
    os.makedirs(hub.root)
    dataset(data, 5, pose=np.zeros((133, 3), dtype=np.float16))
    os.remove(f"{data}/img0002/pose.npy")
    new = publish.publish(spark, data, hub, "u/r", ["caption", "pose"], max_files=2, staging=str(tmp_path))
    assert new["version"] == "0.0.1" and new["total_images"] == 5
    assert new["layers"]["pose"] == {"format": "npy_tar", "chunks": {"00000-00001": 2, "00003-00004": 2}, "count": 4}
    assert hub.list_files() == ["README.md", "data/00000-00004.parquet", "manifest.json", "pose/00000-00001.tar", "pose/00003-00004.tar"]
    table = spark.read.parquet(f"{hub.root}/data").collect()
    assert [r["caption"] for r in table] == [f"caption {i}" for i in range(5)]
    assert not [x for x in os.listdir(tmp_path) if x.startswith("publish-")]
    for name in os.listdir(f"{hub.root}/pose"):
        os.remove(f"{hub.root}/pose/{name}")
    dry = publish.reconcile(spark, hub, "u/r", dry_run=True)
    assert dry["version"] == "0.0.2" and set(dry["layers"]) == {"caption"} and publish.load_manifest(hub)["version"] == "0.0.1"
    publish.reconcile(spark, hub, "u/r")
    assert publish.load_manifest(hub)["layers"]["caption"]["count"] == 5
    with pytest.raises(publish.UnknownLayer):
        publish.publish(spark, data, hub, "u/r", ["nothing"])
    one = publish.publish(spark, data, hub, "u/r", ["seg"], limit=2, offset=1, staging=str(tmp_path))
    assert one["layers"]["seg"]["chunks"] == {"00001-00002": 0}


def test_staging_is_kept_after_failure(spark, tmp_path):
    dataset(f"{tmp_path}/data", 2)

    class Broken(FolderHub):
        def upload(self, local, path):
            raise ValueError("no")

    with pytest.raises(ValueError):
        publish.publish(spark, f"{tmp_path}/data", Broken(f"{tmp_path}/hub"), "u/r", ["caption"], staging=f"{tmp_path}/s")
    (left,) = os.listdir(f"{tmp_path}/s")
    made = os.path.getmtime(f"{tmp_path}/s/{left}/data/00000-00001.parquet")
    hub = FolderHub(f"{tmp_path}/hub")
    publish.publish(spark, f"{tmp_path}/data", hub, "u/r", ["caption"], staging=f"{tmp_path}/s")
    assert not os.listdir(f"{tmp_path}/s") and "data/00000-00001.parquet" in hub.list_files() and made


def test_migrate(spark, tmp_path):
    lines = [{"image_id": "a", "width": 5, "caption": "c", "t5_attention_mask": [1, 1, 0]}, {"image_path": "x/b.png"}, {"image_id": "a", "width": 6}]
    put(f"{tmp_path}/r.jsonl", "\n".join([json.dumps(x) for x in lines] + ["", "broken", "[]", "{}"]))
    put(f"{tmp_path}/derived/dinov3/a.npy", encode_npy(np.zeros(4)))
    put(f"{tmp_path}/derived/images/b.npy", encode_npy(np.zeros(4)))
    args = (spark, f"{tmp_path}/r.jsonl", f"{tmp_path}/derived", f"{tmp_path}/out")
    assert commands.migrate(*args, dry_run=True) == {"lines": 6, "migrated": 2, "errors": 3, "skipped": 1, "new": 2}
    commands.migrate(*args)
    assert sorted(os.listdir(f"{tmp_path}/out/a")) == ["caption.txt", "dinov3_cls.npy", "metadata.json", "t5_mask.npy"]
    assert sorted(os.listdir(f"{tmp_path}/out/b")) == ["metadata.json", "pixel.npy"]
    assert commands.migrate(*args)["new"] == 0


def test_tables_are_cleaned(spark):
    from prismarq.sources import shared

    shared.clean(spark)
    table = shared.write_table(spark.range(5))
    path = table.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(path) and shared.clean(spark) == 1 and not os.path.exists(path) and shared.clean(spark) == 0


def test_streams(spark, tmp_path):
    put(f"{tmp_path}/in/a.png", b"x")
    seen: list[list[str]] = []
    work = lambda batch, n: seen.append(sorted(r["image_id"] for r in batch.collect()))
    run = lambda: incremental.process_new(incremental.new_images(spark, f"{tmp_path}/in"), work, f"{tmp_path}/cp").awaitTermination()
    run()
    put(f"{tmp_path}/in/b.png", b"x")
    put(f"{tmp_path}/in/c.txt", b"x")
    run()
    assert [s for s in seen if s] == [["a"], ["b"]]
    upsert, table = incremental.upsert_chunks(f"{tmp_path}/chunks"), f"{tmp_path}/chunks"
    chunk = lambda n, *labels: spark.createDataFrame([("seg", 0, 9, x, n) for x in labels], "layer string, start bigint, end bigint, label string, n bigint")
    upsert(chunk(1, "a", "b"), 0)
    upsert(chunk(2, "b", "c"), 1)
    upsert(chunk(2, "b", "c"), 1)
    assert {(r["label"], r["n"]) for r in incremental.current_chunks(spark, table).collect()} == {("a", 1), ("b", 2), ("c", 2)}


def backends():
    return decode, {}


def test_commands(spark, tmp_path, capsys):
    put(f"{tmp_path}/in/a.png", png(64, 64))
    out = f"{tmp_path}/out"
    assert commands.main(["process", f"{tmp_path}/in", out, "--passes", "pixel", "--backends", "test_datasets:backends"]) == 0
    assert "'processed': 1" in capsys.readouterr().out
    assert commands.main(["status", out]) == 0 and commands.main(["verify", out]) == 0 and commands.main(["verify", f"{tmp_path}/none"]) == 2
    assert commands.main(["publish", out, "--hub", f"{tmp_path}/hub", "--repo", "u/r", "--layers", "nothing"]) == 2
    os.makedirs(f"{tmp_path}/hub")
    assert commands.main(["reconcile", "--hub", f"{tmp_path}/hub", "--repo", "u/r", "--dry-run"]) == 0
    assert commands.main(["migrate", f"{tmp_path}/no.jsonl", "x", "y"]) == 1
    with pytest.raises(SystemExit):
        commands.main(["nonsense"])


def test_models(tmp_path):
    from prismarq.sources import models

    sent = []
    captions = models.HttpCaptions("http://host/", "m", lambda image: b"jpeg", send=lambda url, body, t: sent.append((url, json.loads(body), t)) or b'{"response": "a cat"}')
    assert captions(None, 7) == "a cat"
    url, body, timeout = sent[0]
    assert url == "http://host/api/generate" and timeout == 120 and body["options"] == {"temperature": 0.7, "num_predict": 7} and body["images"] == ["anBlZw=="]
    fetched = []
    fetch = lambda name, path: fetched.append(name) or put(path, b"x")
    assert models.cached_file("a.bin", fetch, str(tmp_path)) == models.cached_file("a.bin", fetch, str(tmp_path)) and fetched == ["a.bin"]
    assert models.pick_device("cpu") == "cpu" and models.pick_device() in ("cpu", "cuda")
    assert models.config_name("matting", "5b", ["x_matting_1b.py", "x_seg_5b.py"]) == "x_matting_1b.py"
