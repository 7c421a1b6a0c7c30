"""Streams of dataset changes: deleted artifacts come back as work, repeated batches give the same rows; commands by URI."""

import json
import os
import shutil

import numpy as np

from prismarq.functions.tensor import encode_npy
from prismarq.plans import commands
from prismarq.streaming import datasets
from test_datasets import dataset, decode, png, put


def scans(spark, top, state, checkpoint, work):
    datasets.process_changes(datasets.changes(spark, top, state, 4), work, checkpoint).awaitTermination()


def test_deleted_artifacts_come_back(spark, tmp_path):
    top, state, cp = f"{tmp_path}/data", f"file://{tmp_path}/state", f"{tmp_path}/cp"
    dataset(top, 6)
    put(f"{top}/sub/deep/img/caption.txt", "x")
    put(f"{top}/sub/deep/img/other.bin", "x")
    seen = []
    work = lambda batch, n: seen.append(sorted(tuple(r) for r in batch.collect()))
    scans(spark, top, state, cp, work)
    assert seen.pop() == sorted([(f"img{i:04d}", a, "made") for i in range(6) for a in ("caption", "metadata")] + [("sub/deep/img", "caption", "made")])
    scans(spark, top, state, cp, work)
    assert not any(seen)  # nothing changed
    seen.clear()
    os.remove(f"{top}/img0003/caption.txt")
    shutil.rmtree(f"{top}/sub")
    put(f"{top}/img0001/pose.npy", "x")
    scans(spark, top, state, cp, work)
    assert seen == [[("img0001", "pose", "made"), ("img0003", "caption", "lost"), ("sub/deep/img", "caption", "lost")]]
    assert len([d for d in os.listdir(f"{tmp_path}/state") if d.isdigit()]) <= 2  # older states are dropped


def test_a_repeated_batch_gives_the_same_rows(spark, tmp_path):
    """Work that fails after a scan gets the same changes again, whatever happened to the dataset meanwhile."""
    top, state, cp = f"{tmp_path}/data", f"{tmp_path}/state", f"{tmp_path}/cp"
    dataset(top, 2)
    seen = []

    def fails(batch, n):
        seen.append(sorted(tuple(r) for r in batch.collect()))
        raise RuntimeError("no")

    try:
        scans(spark, top, state, cp, fails)
    except Exception:
        pass
    os.remove(f"{top}/img0000/caption.txt")
    scans(spark, top, state, cp, lambda batch, n: seen.append(sorted(tuple(r) for r in batch.collect())))
    assert len(seen) >= 2 and seen[0] == seen[1] and len(seen[0]) == 4
    seen.clear()
    scans(spark, top, state, cp, lambda batch, n: seen.append(sorted(tuple(r) for r in batch.collect())))
    assert [s for s in seen if s] == [[("img0000", "caption", "lost")]]


def test_only_that_image_is_redone(spark, tmp_path):
    """Delete an artifact between two runs: the stream names the image, and its pass runs again for it alone."""
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for i in range(4):
        put(f"{root}/i{i}.png", png(16, 16))
    calls = []
    run = lambda batch=None, n=0: commands.process(spark, root, out, ["pixel"], decode, {})
    run()
    ignore = lambda batch, n: None
    scans(spark, out, f"{tmp_path}/s", f"{tmp_path}/cp", ignore)
    os.remove(f"{out}/i2/pixel.npy")

    def work(batch, n):
        lost = datasets.redo(batch).collect()
        calls.extend((r["image_id"], r["artifacts"]) for r in lost)
        if lost:
            done = run()
            calls.extend(sorted(r["image_id"] for r in done.where("outcome = 'processed'").collect()))

    scans(spark, out, f"{tmp_path}/s", f"{tmp_path}/cp", work)
    assert calls == [("i2", ["pixel"]), "i2"] and os.path.exists(f"{out}/i2/pixel.npy")


def test_verify_and_migrate_by_uri(spark, tmp_path):
    top = f"file://{tmp_path}/data"
    dataset(f"{tmp_path}/data", 2, dinov3_cls=np.zeros(1024, dtype=np.float32))
    put(f"{tmp_path}/data/img0001/pose.npy", b"no array")
    assert commands.verify(spark, top, fix=True)[1] | {"images": 2} == {"images": 2, "bad_images": 2, "issues": 3, "converted": 2, "deleted": 1}
    assert commands.verify(spark, top)[1]["issues"] == 0
    put(f"{tmp_path}/old.jsonl", json.dumps({"image_id": "a", "caption": "c"}))
    put(f"{tmp_path}/derived/pose/a.npy", encode_npy(np.ones(3)))
    commands.migrate(spark, f"file://{tmp_path}/old.jsonl", f"file://{tmp_path}/derived", f"file://{tmp_path}/new")
    assert sorted(os.listdir(f"{tmp_path}/new/a")) == ["caption.txt", "metadata.json", "pose.npy"]
    assert os.path.samefile(f"{tmp_path}/new/a/pose.npy", f"{tmp_path}/derived/pose/a.npy")
