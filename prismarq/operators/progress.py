"""Progress of a running job: how many rows its tasks have finished, and at what rate."""

from __future__ import annotations

import sys
import threading
import time
from collections.abc import Callable

from pyspark.sql import SparkSession


class Progress:
    """Counts rows while a job runs and reports each time that ``every`` more are done, and at the end.

    Tasks add to an accumulator, which reaches the driver as they end; a thread of the driver reads it.  A task that
    runs twice counts twice here, so results are counted by observations instead, and this is for eyes only.
    """

    def __init__(self, spark: SparkSession, total: int, what: str, report: Callable[[str], None] | None = None, every: int = 1000, wait: float = 0.2):
        self.total, self.what, self.every, self.wait = total, what, max(1, every), wait
        self.report = report or (lambda line: print(line, file=sys.stderr))
        self.seen = spark.sparkContext.accumulator(0)
        self.told, self.over = 0, threading.Event()

    def line(self) -> str:
        n, took = self.seen.value, max(1e-9, time.monotonic() - self.began)
        return f"{self.what}: {n:,} of {self.total:,} images, {n / took:.1f} a second"

    def _watch(self) -> None:
        while not self.over.wait(self.wait):
            if self.seen.value - self.told >= self.every:
                self.told = self.seen.value // self.every * self.every
                self.report(self.line())

    def __enter__(self):
        """The accumulator that tasks add to."""
        self.began = time.monotonic()
        self.thread = threading.Thread(target=self._watch, name="progress", daemon=True)
        self.thread.start()
        return self.seen

    def __exit__(self, *_) -> None:
        self.over.set()
        self.thread.join()
        if self.total:
            self.report(self.line())
