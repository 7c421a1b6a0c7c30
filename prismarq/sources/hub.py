"""Hubs that datasets are published to: the interface, a folder as a hub, retries and stall limits."""

from __future__ import annotations

import pickle
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Stalled
from typing import Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import SparkSession

from prismarq.functions.text import PASSING
from prismarq.sources import files

# Fixed values of the retry rule and of the stall limit.
ATTEMPTS, FIRST_WAIT, STALL = 5, 10.0, 300.0


class Hub(Protocol):
    """What publishing needs of a hub; it must be picklable, as tasks upload."""

    def list_files(self) -> list[str]: ...
    def read(self, path: str) -> bytes: ...
    def upload(self, local: str, path: str) -> None:
        """``local`` is a path or URI that any task can read."""


class FolderHub:
    """A folder on any file system that acts as a hub; uploads are renamed into place."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def list_files(self) -> list[str]:
        return sorted(f for f in files.list_files(self.root) if not f.endswith(".part"))

    def read(self, path: str) -> bytes:
        return files.read_bytes(f"{self.root}/{path}")

    def upload(self, local: str, path: str) -> None:
        files.copy(local, f"{self.root}/{path}")


def is_rate_limited(problem: BaseException) -> bool:
    """Status 429, or 429 in the message."""
    status = getattr(getattr(problem, "response", None), "status_code", None)
    return status == 429 or "429" in str(problem)


def is_transient(problem: BaseException) -> bool:
    """Network trouble: any OSError (time-outs and lost connections among them), by message, or by what caused it."""
    seen: set[int] = set()
    at: BaseException | None = problem
    while at is not None and id(at) not in seen:
        seen.add(id(at))
        if isinstance(at, OSError) or any(p in str(at).lower() for p in PASSING):
            return True
        at = at.__cause__ or at.__context__
    return False


def retry_after(problem: BaseException) -> int | None:
    """Seconds that the server asks to wait, at least 1."""
    headers = getattr(getattr(problem, "response", None), "headers", None) or {}
    try:
        return max(1, int(headers["Retry-After"]))
    except (KeyError, TypeError, ValueError):
        return None


def with_retries(call: Callable[[], object], attempts: int = ATTEMPTS, wait: float = FIRST_WAIT, sleep: Callable[[float], None] = time.sleep) -> object:
    """``call()``, tried again after passing errors with waits that double; a server's wish takes their place."""
    for n in range(1, attempts + 1):
        try:
            return call()
        except Exception as problem:
            limited = is_rate_limited(problem)
            if n == attempts or not (limited or is_transient(problem)):
                raise
            sleep((retry_after(problem) if limited else None) or wait)
            wait *= 2
    raise AssertionError("unreachable")


def upload(hub: Hub, local: str, path: str, stall: float = STALL) -> None:
    """Upload one file; TimeoutError if it takes longer than ``stall`` seconds."""
    pool = ThreadPoolExecutor(1)
    try:
        pool.submit(hub.upload, local, path).result(stall)
    except Stalled as late:
        raise TimeoutError(f"upload of {path} timed out after {stall:g} s") from late
    finally:
        pool.shutdown(wait=False)


def upload_all(spark: SparkSession, hub: Hub, payload: Sequence[tuple[str, str]], last: Sequence[tuple[str, str]] = (), stall: float = STALL, attempts: int = ATTEMPTS, wait: float = FIRST_WAIT) -> int:
    """Upload ``payload`` (file, path on the hub) from the tasks, and then, only if all of it is up, ``last`` in its order.

    Each task uploads its files with retries and reports on every one; a file that stays behind is raised here as
    the error that kept it, and nothing of ``last`` (card and manifest) is uploaded then.  A file that a repeated task
    uploads again takes the place of the same bytes.  Returns the number of files.
    """
    sealed = cloudpickle.dumps(hub)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = pickle.loads(sealed)
        for pdf in parts:
            kept = []
            for local, path in zip(pdf["local"], pdf["path"], strict=True):
                try:
                    with_retries(lambda local=local, path=path: upload(own, local, path, stall), attempts, wait)
                    kept.append(None)
                except Exception as problem:  # the report of one file, not the end of the job
                    try:
                        kept.append(cloudpickle.dumps(problem))
                    except Exception:
                        kept.append(cloudpickle.dumps(RuntimeError(f"{type(problem).__name__}: {problem}")))
            yield pdf.assign(problem=kept)[["path", "problem"]]

    if payload:
        rows = spark.createDataFrame(list(payload), "local string, path string").repartition(len(payload))
        reports = rows.mapInPandas(run, "path string, problem binary").where("problem is not null").orderBy("path").limit(1).collect()
        for _, problem in reports:
            raise pickle.loads(bytes(problem))
    for local, path in last:
        with_retries(lambda local=local, path=path: upload(hub, local, path, stall), attempts, wait)
    return len(payload) + len(last)
