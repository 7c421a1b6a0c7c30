"""Publishing pages of a dataset to a hub, and rebuilding its manifest from what it holds."""

from __future__ import annotations

import hashlib
import io
import json
import sys
import tarfile
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prismarq.functions import text as X
from prismarq.operators import catalog as C
from prismarq.operators import manifest as M
from prismarq.operators.positional import page as page_of
from prismarq.operators.positional import pack_greedy
from prismarq.sources import images as I
from prismarq.sources import files as S
from prismarq.sources import tar
from prismarq.sources.hub import FIRST_WAIT, Hub, upload_all, with_retries
from prismarq.sources.shared import shared_folder

MARKER = "staging.json"
MANIFEST, CARD = "manifest.json", "README.md"


class UnknownLayer(ValueError):
    """A layer that the catalogue does not have."""


def check_layers(names: Sequence[str]) -> None:
    wrong = [n for n in names if n not in C.LAYERS]
    if wrong:
        raise UnknownLayer(f"unknown layers: {', '.join(wrong)}; there are {', '.join(sorted(C.LAYERS))}")


def load_manifest(hub: Hub) -> dict:
    """The hub's manifest; an empty one if there is none or it can't be read."""
    try:
        found = json.loads(hub.read(MANIFEST))
        return M.EMPTY | found if isinstance(found, dict) else dict(M.EMPTY)
    except (OSError, ValueError):
        return dict(M.EMPTY)


def staging_folder(params: dict, top: str) -> str:
    """A folder that belongs to these parameters alone; what an earlier run with the same left there is kept."""
    text = json.dumps(params, sort_keys=True)
    folder = f"{top.rstrip('/')}/publish-{params['repo'].replace('/', '--')}-{hashlib.sha256(text.encode()).hexdigest()[:12]}"
    marker = f"{folder}/{MARKER}"
    if not S.exists(marker) or S.read_bytes(marker).decode() != text:
        S.delete_folder(folder)
        S.write_bytes(marker, text.encode())
    return folder


def staging_top(spark: SparkSession) -> str:
    """Where tasks and the driver can both stage files: beside the shared tables."""
    return shared_folder(spark).rpartition("/")[0]


def log_sizes(payload: Sequence[tuple[str, str]], sizes: dict[str, int]) -> int:
    """Name every file that goes up with its size, and their total, on stderr; the total in bytes."""
    for local, path in sorted(payload, key=lambda x: x[1]):
        print(f"  {path}  ({X.human_bytes(sizes[local])})", file=sys.stderr)
    total = sum(sizes[local] for local, _ in payload)
    print(f"  total: {X.human_bytes(total)}", file=sys.stderr)
    return total


def dataset_card(manifest: dict, repo: str, license_id: str, attribution: str) -> str:
    """Markdown card: front matter, totals, and one line per layer by name."""
    rows = "\n".join(f"| {name} | {x['format']} | {len(x['chunks'])} | {x['count']:,} |" for name, x in sorted(manifest["layers"].items()))
    return (
        f"---\nlicense: {license_id}\n---\n\n# {repo}\n\nVersion {manifest['version']}, {manifest['total_images']:,} images.\n\n"
        f"| Layer | Format | Chunks | Images |\n|---|---|---|---|\n{rows}\n\n## Attribution\n\n{attribution}\n"
    )


def split_layer(files: DataFrame, records: DataFrame, layer: str, most_bytes: int | None, most_files: int | None) -> DataFrame:
    """(image_id, pos, label): the archive of each image that has the whole layer, by size and count."""
    sizes = C.layer_bytes(files, {layer: C.LAYERS[layer]}).join(records.select("image_id", "pos"), "image_id")
    packed = pack_greedy(sizes, ["layer"], "pos", "bytes", most_bytes, most_files)
    span = Window.partitionBy("layer", "grp")
    label = X.range_label(F.min("pos").over(span), F.max("pos").over(span))
    return packed.withColumn("label", label).join(sizes.select("pos", "image_id"), "pos").select("image_id", "pos", "label")


def publish(
    spark: SparkSession, dataset: str, hub: Hub, repo: str, layers: Sequence[str], limit: int | None = None, offset: int = 0, max_tar_mb: int | None = None,
    max_files: int | None = None, license_id: str = "other", attribution: str = "", staging: str | None = None, stall: float = 300.0, wait: float = FIRST_WAIT, index: bool = False) -> dict:
    """Publish one page of images: payload first, then card and manifest. The new manifest, or the old one if the page is empty.

    Archives are staged in ``staging``, a folder or URI that driver and tasks reach, where a run that failed goes on;
    tasks upload them.  With ``index`` each archive has its index beside it.
    """
    check_layers(layers)
    meta = I.scan_metadata(spark, dataset).where("ok").withColumn("image_id", F.col("rel"))
    records = page_of(meta.drop("dir", "rel", "ok"), offset, limit, X.components(F.col("image_id")))
    n = records.count()
    manifest = load_manifest(hub)
    if n == 0:
        return manifest
    params = {"repo": repo, "offset": offset, "limit": limit, "layers": sorted(layers), "max_tar_mb": max_tar_mb, "max_files": max_files} | ({"index": True} if index else {})
    folder = staging_folder(params, staging or staging_top(spark))
    files = I.scan_artifacts(spark, dataset)
    files = files.join(records.select("image_id"), "image_id", "left_semi")
    page_label = f"{offset:05d}-{offset + n - 1:05d}"
    chunks, payload = [], []
    for layer in layers:
        if layer == "caption":
            out = f"{folder}/data/{page_label}.parquet"
            if not S.exists(out):
                _one_parquet(_captions(spark, dataset, records), out)
            chunks.append((layer, offset, offset + n - 1, page_label, spark.read.parquet(out).count()))
            payload.append((out, f"data/{page_label}.parquet"))
            continue
        where = f"{folder}/{layer}"
        labels = split_layer(files, records, layer, None if max_tar_mb is None else max_tar_mb * 1_000_000, max_files)
        if max_tar_mb is None and max_files is None:  # one archive for the page, even if nothing is complete
            labels = labels.withColumn("label", F.lit(page_label))
        counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per archive
        staged = S.list_files(where)
        missing = [x for x in counts if f"{x}.tar" not in staged]
        if missing:
            tar.write_tars(_members(spark, dataset, files, labels.where(F.col("label").isin(missing)), layer), where, len(missing), index)
        if not counts and max_tar_mb is None and max_files is None:
            S.write_bytes(f"{where}/{page_label}.tar", _empty_tar())
            counts = {page_label: 0}
        for label in sorted(counts):
            start, _, end = label.partition("-")
            chunks.append((layer, int(start), int(end), label, counts[label]))
            payload.append((f"{where}/{label}.tar", f"{layer}/{label}.tar"))
        payload += [(f"{where}/{name}", f"{layer}/{name}") for name in S.list_files(where) if name.endswith(".tar.index") and index]
    merged = M.merge(M.from_manifest(spark, manifest), spark.createDataFrame(chunks, M.CHUNKS))
    new = M.to_manifest(merged, M.bump(manifest["version"]), max(manifest["total_images"], offset + n), datetime.now(UTC).isoformat())
    documents = _documents(folder, new, repo, license_id, attribution)
    log_sizes(payload + documents, {f"{folder}/{k}": v for k, v in S.list_files(folder).items()})
    upload_all(spark, hub, payload, documents, stall, wait=wait)
    S.delete_folder(folder)  # only after everything went up: a failed run goes on from here
    return new


def _empty_tar() -> bytes:
    out = io.BytesIO()
    tarfile.open(fileobj=out, mode="w").close()
    return out.getvalue()


def _captions(spark: SparkSession, dataset: str, records: DataFrame) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "caption.txt").load(dataset)
    text = files.select(X.parent_dir(I.relative(F.col("path"), dataset)).alias("image_id"), X.strip(F.decode("content", "UTF-8")).alias("caption"))
    zero, empty = (lambda c: F.coalesce(c, F.lit(0))), (lambda c: F.coalesce(c, F.lit("")))
    rows = records.join(text, "image_id", "left").sort("pos")
    return rows.select("image_id", zero("width").alias("width"), zero("height").alias("height"), empty("aspect_bucket").alias("aspect_bucket"), empty("caption").alias("caption"))


def _one_parquet(df: DataFrame, path: str) -> None:
    """One Parquet file of exactly this name: a page of images is small."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}.dir")
    (part,) = [f for f in S.list_files(f"{path}.dir") if f.startswith("part-") and f.endswith(".parquet")]
    system, bare = S.locate(path)
    system.move(f"{bare}.dir/{part}", bare)
    S.delete_folder(f"{path}.dir")


def _members(spark: SparkSession, dataset: str, files: DataFrame, labels: DataFrame, layer: str) -> DataFrame:
    """Rows for the tar sink: the layer's files of labelled images with their bytes."""
    names = "{" + ",".join(C.ARTIFACTS[a] for a in C.LAYERS[layer]) + "}"
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(dataset)
    rows = content.select(X.parent_dir(I.relative(F.col("path"), dataset)).alias("image_id"), F.regexp_extract("path", "[^/]*$", 0).alias("file"), "content")
    return rows.join(labels, "image_id").select("label", "pos", "image_id", "file", "content")


def _documents(folder: str, manifest: dict, repo: str, license_id: str, attribution: str) -> list[tuple[str, str]]:
    """Write card and manifest; the manifest goes up last."""
    texts = {CARD: dataset_card(manifest, repo, license_id, attribution), MANIFEST: json.dumps(manifest, indent=2, ensure_ascii=False)}
    for name, text in texts.items():
        S.write_bytes(f"{folder}/{name}", text.encode())
    return [(f"{folder}/{name}", name) for name in texts]


def reconcile(spark: SparkSession, hub: Hub, repo: str, license_id: str = "other", attribution: str = "", dry_run: bool = False) -> dict:
    """The manifest that the hub's files call for; uploaded with its card unless ``dry_run``. Layers without files go."""
    listed = with_retries(hub.list_files)
    chunks = M.from_listing(spark.createDataFrame([(f,) for f in listed], "path string"))
    total = M.total_images(chunks).first()["total_images"]
    old = load_manifest(hub)
    new = M.to_manifest(chunks, M.bump(old["version"]), total, datetime.now(UTC).isoformat())
    if not dry_run:
        folder = shared_folder(spark)
        upload_all(spark, hub, [], _documents(folder, new, repo, license_id, attribution))
        S.delete_folder(folder)
    return new
