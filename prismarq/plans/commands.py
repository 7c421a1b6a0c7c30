"""Command line: process, status, verify, publish, reconcile, migrate."""

from __future__ import annotations

import argparse
import json
import sys
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismarq.functions import text as X
from prismarq.operators import catalog as C
from prismarq.operators import importer, passes, positional
from prismarq.operators import verify as R
from prismarq.operators.passes import write_artifact
from prismarq.sources import images as I
from prismarq.sources import npy
from prismarq.sources.files import delete, exists, link_or_copy, read_bytes
from prismarq.sources.hub import FolderHub
from prismarq.sources.models import plug_in
from prismarq.sources.shared import reach_workers, spread, write_table


def process_all(
    spark: SparkSession, root: str, output: str, names: Sequence[str], decode: Callable, backends: dict, shard: str | None = None, listing: str | None = None,
    counts: Counter | None = None, gpus: float = 0.0) -> tuple[DataFrame, DataFrame] | None:
    """Run passes over the images of ``root``; OUTCOME rows of passes and of unreadable images, or None without images.

    Metadata is made where it is missing; images whose size cannot be read have no passes and are named on stderr, as are
    files that share an image id with the first of them (``a.jpg`` beside ``a.png``).  ``counts`` gets the number of each outcome.
    """
    reach_workers(spark)
    found = I.scan_images(spark, root) if listing is None else I.scan_list(spark, listing, root)
    if shard:
        found = positional.shard(found.select("path", "image_id"), *positional.parse_shard(shard), X.components(F.col("path")))
    if found.isEmpty():
        return None
    once = write_table(found.groupBy("image_id").agg(F.min("path").alias("path"), F.max("path").alias("other")))
    for r in once.where("path <> other").toLocalIterator():
        print(f"warning: {r['other']} has the image id of {r['path']} and is left out", file=sys.stderr)
    sized = write_table(I.with_size(spread(once.select("path", "image_id"), passes.IMAGES_PER_TASK, "image_id")))
    old = I.scan_metadata(spark, output) if exists(output) else I.scan_metadata(spark, root).where("false")
    meta = write_table(I.ensure_metadata(sized, old))
    unread = sized.join(meta, "image_id", "left_anti")
    for r in unread.toLocalIterator():
        print(f"warning: cannot read dimensions for {r['path']}", file=sys.stderr)
        if counts is not None:
            counts["error"] += 1

    def keep(part):
        for pdf in part:
            for r in pdf.itertuples(index=False):
                write_artifact(f"{output.rstrip('/')}/{r.image_id}", "metadata", json.dumps(r._asdict(), indent=2, ensure_ascii=False))
            yield pdf[["image_id"]]

    spread(meta.where("made").drop("made"), passes.IMAGES_PER_TASK, "image_id").mapInPandas(keep, "image_id string").count()
    work = sized.select("image_id", "path").join(meta.select("image_id", "aspect_bucket"), "image_id")
    errors = unread.select("image_id", F.lit("metadata").alias("pass"), F.lit("error").alias("outcome"), F.lit("unreadable image").alias("message"))
    scan = lambda: I.artifacts_of(spread(meta.select("image_id"), passes.IMAGES_PER_TASK, "image_id"), output)
    return passes.run_passes(work, scan, names, decode, backends, output, counts, gpus), errors


def process(spark: SparkSession, root: str, output: str, names: Sequence[str], decode: Callable, backends: dict, shard: str | None = None, listing: str | None = None) -> DataFrame | None:
    """OUTCOME rows of the passes alone."""
    done = process_all(spark, root, output, names, decode, backends, shard, listing)
    return done and done[0]


def status(spark: SparkSession, dataset: str, names: Sequence[str] | None = None) -> DataFrame:
    """Completeness of every artifact of the catalogue."""
    found = I.scan_artifacts(spark, dataset)
    images = found.where("artifact = 'metadata'").select("image_id")
    return C.status(images, found, list(names or C.ARTIFACTS))


def verify(spark: SparkSession, dataset: str, fix: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """Issues, and counts of images, issues, converted and deleted files.

    With ``fix``, a wrong dtype is cast in place and a corrupt or misshapen file deleted, by the tasks that hold the rows.
    """
    reach_workers(spark)
    meta = I.scan_metadata(spark, dataset).withColumn("image_id", F.col("rel")).select("image_id", "ok", "aspect_bucket")
    headers = npy.scan_headers(spark, dataset)
    found = write_table(R.issues(headers, meta))
    counts = R.summary(meta, found).first().asDict() | {"converted": 0, "deleted": 0}
    if fix:
        wanted = {a: d for a, (_, d) in R.EXPECTED.items()}

        def repair(parts):
            for pdf in parts:
                done = []
                for r in pdf.itertuples(index=False):
                    folder = f"{dataset.rstrip('/')}/{r.image_id}"
                    path = f"{folder}/{C.ARTIFACTS[r.artifact]}"
                    if r.kind == "dtype":
                        value = passes.decode_npy(read_bytes(path))
                        write_artifact(folder, r.artifact, value.astype(np.dtype(wanted[r.artifact])))
                    else:
                        delete(path)
                    done.append("converted" if r.kind == "dtype" else "deleted")
                yield pdf.assign(done=done)[["done"]]

        # A file with several issues is deleted if one of them calls for it.
        worst = F.when(F.array_contains(F.collect_set("kind"), "shape") | F.array_contains(F.collect_set("kind"), "corrupt"), "shape").otherwise("dtype")
        work = found.where("artifact not in ('metadata', 'caption')").groupBy("image_id", "artifact").agg(worst.alias("kind"))
        counts |= {r["done"]: r["n"] for r in work.mapInPandas(repair, "done string").groupBy("done").agg(F.count(F.lit(1)).alias("n")).collect()}
    return found, counts


def migrate(spark: SparkSession, jsonl: str, derived: str, output: str, dry_run: bool = False) -> dict[str, int]:
    """Import old records: metadata, captions, masks, and files of the modality folders (linked, else copied)."""
    reach_workers(spark)
    lines = spark.read.text(jsonl).select("value").withColumn("line", F.monotonically_increasing_id())
    records = write_table(importer.parse_lines(lines))
    counts = importer.counters(records).first().asDict()
    have = I.scan_metadata(spark, output).select(F.col("rel").alias("image_id")) if exists(output) else spark.createDataFrame([], "image_id string")
    new = importer.new_records(records, have)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npy").load(derived).select("path")
    rel = I.relative(F.col("path"), derived)
    files = files.select(F.split_part(rel, F.lit("/"), F.lit(1)).alias("modality"), F.regexp_replace(F.regexp_replace(rel, "^[^/]*/", ""), r"\.npy$", "").alias("image_id"), "path")
    work = write_table(importer.attach_files(new, files))
    counts["new"] = work.count()
    if dry_run:
        return counts

    def place(parts):
        for pdf in parts:
            for r in pdf.itertuples(index=False):
                folder = f"{output.rstrip('/')}/{r.image_id}"
                for artifact, path in dict(r.files).items():
                    link_or_copy(path, f"{folder}/{C.ARTIFACTS[artifact]}")
                if r.caption:
                    write_artifact(folder, "caption", r.caption)
                if r.t5_attention_mask is not None:
                    write_artifact(folder, "t5_mask", np.array(r.t5_attention_mask, dtype=np.uint8))
                number = lambda v: None if v is None or v != v else int(v)
                meta = {"image_id": r.image_id, "source_path": r.image_path, "width": number(r.width), "height": number(r.height), "aspect_bucket": r.aspect_bucket}
                write_artifact(folder, "metadata", json.dumps(meta, indent=2, ensure_ascii=False))
            yield pdf[["image_id"]]

    work.mapInPandas(place, "image_id string").count()
    return counts


def main(argv: Sequence[str] | None = None) -> int:
    """Exit codes: 0 done, 1 nothing to do or issues found, 2 bad arguments."""
    from prismarq.plans import publish as P

    top = argparse.ArgumentParser(prog="prismarq")
    sub = top.add_subparsers(dest="command", required=True)
    for name in ("process", "status", "verify", "publish", "reconcile", "migrate"):
        p = sub.add_parser(name)
        if name == "process":
            p.add_argument("root")
            p.add_argument("output")
            p.add_argument("--passes", default="all")
            p.add_argument("--second", action="store_true", help="default passes of the second generation")
            p.add_argument("--shard", help="N/M")
            p.add_argument("--image-list")
            p.add_argument("--backends", required=True, help="module:factory that returns (decode, backends); decode gives the RGB array of a file's bytes, so it is where JPEG, WebP and TIFF come in")
            p.add_argument("--gpus", type=float, default=0.0, help="GPUs that each task of a pass holds, where the cluster has profiles")
        if name in ("status", "verify", "publish"):
            p.add_argument("dataset")
        if name == "verify":
            p.add_argument("--fix", action="store_true")
        if name in ("publish", "reconcile"):
            p.add_argument("--hub", required=True, help="folder that is the hub")
            p.add_argument("--repo", required=True)
            p.add_argument("--license", default="other")
            p.add_argument("--attribution", default="")
        if name == "publish":
            p.add_argument("--layers", default=",".join(C.LAYERS))
            for flag in ("--limit", "--max-tar-mb", "--max-files-per-tar"):
                p.add_argument(flag, type=int)
            p.add_argument("--offset", type=int, default=0)
        if name == "migrate":
            for arg in ("jsonl", "derived", "output"):
                p.add_argument(arg)
        if name in ("reconcile", "migrate"):
            p.add_argument("--dry-run", action="store_true")
    a = top.parse_args(argv)
    if a.command == "verify" and not exists(a.dataset):
        print(f"{a.dataset} is no folder", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("prismarq").getOrCreate()
    if a.command == "process":
        names = passes.resolve_passes(a.passes, passes.DEFAULT_PASSES_2 if a.second else passes.DEFAULT_PASSES)
        counts: Counter = Counter()
        if process_all(spark, a.root, a.output, names, *plug_in(a.backends), a.shard, a.image_list, counts, a.gpus) is None:
            print("no images", file=sys.stderr)
            return 1
        print(dict(counts))
        return 0
    if a.command == "status":
        rows = status(spark, a.dataset).collect()
        for r in rows:
            print(f"{r['artifact']:<16} {r['n']:>12,} / {r['total']:,} {r['pct']:6.1f}%")
        return 0 if rows and rows[0]["total"] else 1
    if a.command == "verify":
        found, counts = verify(spark, a.dataset, a.fix)
        for r in found.orderBy("image_id", "artifact", "kind", "detail").toLocalIterator():
            print(f"{r['image_id']}: {r['artifact']}: {r['kind']}: {r['detail']}")
        print(counts)
        return 1 if counts["issues"] else 0
    if a.command == "publish":
        try:
            new = P.publish(spark, a.dataset, FolderHub(a.hub), a.repo, passes.resolve_passes(a.layers, list(C.LAYERS)), a.limit, a.offset, a.max_tar_mb, a.max_files_per_tar, a.license, a.attribution)
        except P.UnknownLayer as wrong:
            print(wrong, file=sys.stderr)
            return 2
        except KeyboardInterrupt:
            return 130
        print(json.dumps(new, indent=2))
        return 0
    if a.command == "reconcile":
        print(json.dumps(P.reconcile(spark, FolderHub(a.hub), a.repo, a.license, a.attribution, a.dry_run), indent=2))
        return 0
    if not exists(a.jsonl):
        print(f"{a.jsonl} is missing", file=sys.stderr)
        return 1
    print(migrate(spark, a.jsonl, a.derived, a.output, a.dry_run))
    return 0


if __name__ == "__main__":
    sys.exit(main())
