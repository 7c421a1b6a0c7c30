"""Enrichment passes: what is pending and ready, level by level, run over partitions.

A pass turns an image (or its caption) into artifacts with a backend, a callable
that the caller injects; models are loaded once per Python worker by whoever
makes the callable.  Passes of one level share one read and decode of the image.
Artifacts are written under a temporary name and renamed, so that existence means
complete and a task that runs twice does no harm.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import closing
from dataclasses import dataclass, field
from functools import partial
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from prismarq.functions import dense as D
from prismarq.functions.tensor import decode_npy, encode_npy
from prismarq.operators import catalog as C
from prismarq.operators.batching import Group, alone, batch_size
from prismarq.operators.progress import Progress
from prismarq.sources.files import read_bytes, write_bytes
from prismarq.sources.readahead import DEPTH, ahead

# Passes that run by default, in both generations of the catalogue.
DEFAULT_PASSES = ("caption", "dinov3", "t5", "pose", "seg", "depth", "normal")
DEFAULT_PASSES_2 = ("caption", "dinov3", "t5", "seg2", "pose2", "matting", "normal2", "pointmap")
OUTCOME = "image_id string, pass string, outcome string, message string"
MAX_TOKENS = 500
#: Images that a task works on.
IMAGES_PER_TASK = 200


def resolve_passes(text: str, default: Sequence[str] = DEFAULT_PASSES) -> list[str]:
    """``all`` or a list with commas; blanks dropped, unknown names kept (they make nothing)."""
    return list(default) if text.strip() == "all" else [p.strip() for p in text.split(",") if p.strip()]


@dataclass
class Inputs:
    """What a pass may look at: the decoded RGB image, its bucket crop, and artifacts made before."""

    image: np.ndarray | None
    bucket: tuple[int, int] | None
    folder: str
    crop_: np.ndarray | None = field(default=None, repr=False)

    @property
    def crop(self) -> np.ndarray:
        if self.crop_ is None:
            self.crop_ = D.cover_crop(self.image, *self.bucket)
        return self.crop_

    def tensor(self, artifact: str) -> np.ndarray:
        return decode_npy(read_bytes(f"{self.folder}/{C.ARTIFACTS[artifact]}"))

    def caption(self) -> str:
        return read_bytes(f"{self.folder}/{C.ARTIFACTS['caption']}").decode("utf-8").strip()


Backend = Callable[..., Any]


def _caption(x: Inputs, backend: Backend) -> dict[str, Any]:
    return {"caption": " ".join((backend(x.crop, MAX_TOKENS) or "").split())}


def _dinov3(x: Inputs, backend: Backend) -> dict[str, Any]:
    tokens = np.asarray(backend(x.crop))  # class token, four registers, patches
    return {"dinov3_cls": tokens[0].astype(np.float16), "dinov3_patches": tokens[5:].astype(np.float16)}


def _t5(x: Inputs, backend: Backend) -> dict[str, Any]:
    text = x.caption()
    if not text:
        raise ValueError("empty caption")
    hidden, mask = backend(text)
    return {"t5_hidden": np.asarray(hidden).astype(np.float16), "t5_mask": np.asarray(mask).astype(np.uint8)}


def _pose(x: Inputs, backend: Backend) -> dict[str, Any]:
    points, scores = backend(x.crop)
    return {"pose": D.unit_keypoints(points, scores, *x.bucket)}


def _pose2(x: Inputs, backend: Backend) -> dict[str, Any]:
    """Keypoints of every person in image pixels (``persons.PersonPose`` takes the whole image where it finds none)."""
    points, scores = backend(x.image)
    return {"pose2": np.concatenate([points, np.asarray(scores)[..., None]], axis=-1).astype(np.float32)}


def _size(x: Inputs) -> tuple[int, int]:
    return x.image.shape[0], x.image.shape[1]


#: pass -> function of (inputs, backend) that gives artifacts by name.
PASSES: dict[str, Callable[[Inputs, Backend], dict[str, Any]]] = {
    "caption": _caption,
    "dinov3": _dinov3,
    "t5": _t5,
    "pose": _pose,
    "seg": lambda x, b: {"seg": D.class_map(b(D.model_input(x.crop)), x.bucket[1], x.bucket[0])},
    "depth": lambda x, b: {"depth": D.depth_map(b(D.model_input(x.crop)), x.tensor("seg"))},
    "normal": lambda x, b: {"normal": D.normal_map(b(D.model_input(x.crop)), x.tensor("seg"))},
    "pixel": lambda x, b: {"pixel": D.pixels(x.crop)},
    "seg2": lambda x, b: {"seg2": D.class_map(b(x.image), *_size(x))},
    "pose2": _pose2,
    "matting": lambda x, b: {"matting": D.alpha(b(x.image), *_size(x))},
    "normal2": lambda x, b: {"normal2": D.normal_map_padded(*b(x.image), x.tensor("seg2"))},
    "pointmap": lambda x, b: {"pointmap": D.point_map(*b(x.image), x.tensor("seg2"))},
}


def levels(passes: Sequence[str]) -> list[list[str]]:
    """Passes by dependency: each level needs artifacts of earlier ones only."""
    makers = {a: p for p in passes for a in C.MAKES.get(p, ())}
    depth: dict[str, int] = {}

    def of(p: str) -> int:
        if p not in depth:
            depth[p] = 1 + max((of(makers[a]) for a in C.NEEDS.get(p, ()) if a in makers), default=-1)
        return depth[p]

    known = [p for p in passes if p in PASSES]
    return [[p for p in known if of(p) == d] for d in sorted({of(p) for p in known})]


def write_artifact(folder: str, artifact: str, value: Any) -> None:
    """Atomic write of text or of a tensor."""
    write_bytes(f"{folder}/{C.ARTIFACTS[artifact]}", value.encode("utf-8") if isinstance(value, str) else encode_npy(value))


def _runner(decode: Callable[[bytes], np.ndarray | None], backends: Mapping[str, Backend], output: str, depth: int = DEPTH, seen=None):
    """Function of a partition: images are read and decoded ahead, and grouped as large as the backends' batches are."""

    def fetch(r) -> np.ndarray:
        image = decode(read_bytes(r.path))
        if image is None:
            raise ValueError("unreadable image")
        return image

    def passes_of(r, image: np.ndarray | None, problem: Exception | None, wrap: Callable[[Backend | None], Backend | None]) -> list[tuple]:
        rows, x = [], None
        for name in r.todo:
            try:
                if problem is not None:
                    raise problem
                if x is None:
                    w, h = (int(v) for v in r.aspect_bucket.removeprefix("bucket_").split("x"))
                    x = Inputs(image, (w, h), f"{output.rstrip('/')}/{r.image_id}")
                backend = backends.get(name)
                for artifact, value in PASSES[name](x, backend and wrap(backend)).items():
                    write_artifact(x.folder, artifact, value)
                rows.append((r.image_id, name, "processed", None))
            except Exception as wrong:  # one image's failure is a row, not the end of the job
                rows.append((r.image_id, name, "error", f"{type(wrong).__name__}: {wrong}"))
        return rows

    def together(group: list[tuple]) -> pd.DataFrame:
        if len(group) == 1:
            rows = passes_of(*group[0], alone)
        else:
            rows = [row for own in Group().run([partial(passes_of, *g) for g in group]) for row in own]
        if seen is not None:
            seen.add(len(group))
        return pd.DataFrame(rows, columns=["image_id", "pass", "outcome", "message"])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def most(r) -> int:
            return max((batch_size(backends.get(name)) for name in r.todo), default=1)

        rows = (r for pdf in parts for r in pdf.itertuples(index=False))
        group, size = [], 1
        with closing(ahead(rows, fetch, depth)) as images:
            for r, image, problem in images:
                group.append((r, image, problem))
                size = max(size, most(r))
                if len(group) >= size:
                    yield together(group)
                    group, size = [], 1
        if group:
            yield together(group)

    return run


def plan_level(images: DataFrame, artifacts: DataFrame, names: Sequence[str]) -> DataFrame:
    """(image_id, todo, skipped, waiting): per image, passes to run, already complete, and not ready. One aggregation, one join."""
    has = artifacts.groupBy("image_id").agg(F.collect_set("artifact").alias("has"))
    rows = images.select("image_id").join(has, "image_id", "left").withColumn("has", F.coalesce("has", F.expr("cast(array() as array<string>)")))
    lists: dict[str, list] = {"todo": [], "skipped": [], "waiting": []}
    for p in names:
        made = F.size(F.array_except(F.lit(list(C.MAKES[p])), "has")) == 0
        able = F.size(F.array_except(F.lit(list(C.NEEDS.get(p, ()))).cast("array<string>"), "has")) == 0
        for key, when in (("todo", ~made & able), ("skipped", made), ("waiting", ~made & ~able)):
            lists[key].append(F.when(when, F.lit(p)))
    return rows.select("image_id", *[F.array_compact(F.array(*v)).alias(k) for k, v in lists.items()])


def gpu_profile(spark, gpus: float = 0.0):
    """A resource profile that gives each task of a level so many GPUs (parts of one, too), or None where that can't be had.

    Scans and joins keep the default profile, so they do not hold accelerators.  Local masters know no profiles; without
    dynamic allocation a profile needs executors that were started with GPUs.
    """
    if gpus <= 0 or spark.sparkContext.master.startswith("local"):
        return None
    from pyspark.resource import ExecutorResourceRequests, ResourceProfileBuilder, TaskResourceRequests

    asked = ResourceProfileBuilder().require(TaskResourceRequests().cpus(1).resource("gpu", gpus))
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        asked = asked.require(ExecutorResourceRequests().resource("gpu", max(1, math.ceil(gpus)), spark.conf.get("spark.executor.resource.gpu.discoveryScript", "")))
    elif int(spark.conf.get("spark.executor.resource.gpu.amount", "0")) < 1:
        return None
    return asked.build


def run_passes(
    images: DataFrame, scan: Callable[[], DataFrame], passes: Sequence[str], decode: Callable[[bytes], np.ndarray | None], backends: Mapping[str, Backend], output: str,
    counts: Counter | None = None, gpus: float = 0.0, report: Callable[[str], None] | None = None, every: int = 1000) -> DataFrame:
    """Run passes over ``images`` (image_id, path, aspect_bucket); OUTCOME rows of everything done, skipped or waiting.

    Plans hold paths alone; the task that runs an image's passes reads its bytes, once a level, ahead of the models.
    ``scan`` reads the artifacts that exist, anew for every level.  ``counts`` gets the number of each outcome from
    the jobs as they run, without reading their results again; ``report`` gets a line of progress every ``every`` images.
    """
    from prismarq.sources.shared import write_table

    spark, done = images.sparkSession, None
    profile = gpu_profile(spark, gpus)
    for names in levels(passes):
        planned, worked = Observation(), Observation()
        plan = plan_level(images, scan(), names)
        sizes = [F.coalesce(F.sum(F.size(c)), F.lit(0)).alias(o) for c, o in (("skipped", "skipped"), ("waiting", "skipped_dependency"))]
        plan = write_table(plan.observe(planned, *sizes, F.count_if(F.size("todo") > 0).alias("images")))
        work = images.join(plan.where(F.size("todo") > 0).select("image_id", "todo"), "image_id").select("image_id", "path", "aspect_bucket", "todo")
        work = work.repartition(max(1, math.ceil(planned.get["images"] / IMAGES_PER_TASK)), "image_id")
        with Progress(spark, planned.get["images"], ", ".join(names), report, every) as seen:
            ran = work.mapInPandas(_runner(decode, backends, output, seen=seen), OUTCOME, profile=profile)
            ran = write_table(ran.observe(worked, *[F.count_if(F.col("outcome") == o).alias(o) for o in ("processed", "error")]))
        if counts is not None:
            counts.update({o: n for o, n in (planned.get | worked.get).items() if n and o != "images"})
        idle = [plan.select("image_id", F.explode(c).alias("pass"), F.lit(o).alias("outcome"), F.lit(None).cast("string").alias("message")) for c, o in (("skipped", "skipped"), ("waiting", "skipped_dependency"))]
        level = ran.unionByName(idle[0]).unionByName(idle[1])
        done = level if done is None else done.unionByName(level)
    return done if done is not None else spark.createDataFrame([], OUTCOME)


def counters(outcomes: DataFrame) -> DataFrame:
    """(outcome, n)."""
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
