"""Datasets as streams of changes: what was made, and what was lost, since a scan that is in the checkpoint.

A folder watched by file names never hands out a file again that was deleted.  This source keeps, for each part
of the dataset, the artifacts that every image had at a scan, and streams the differences to
the next scan, so that a deleted artifact comes back as work.  Offsets are scans.  The top-level folders of the
dataset are dealt to parts by the hash of their names; a task lists the folders of its part, compares
them with the part's state, and writes the state and the changes of the new scan before it hands the changes on: a
batch that is repeated reads the changes that were written, and gives the same rows.

``work`` of ``process_changes`` gets one row per image and artifact; with ``redo`` the images that lack
something they had are work again, and only they.
"""

from __future__ import annotations

import json
import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from prismarq.operators.catalog import ARTIFACTS
from prismarq.sources.files import delete_folder, exists, list_files, locate, read_bytes, write_bytes
from prismarq.sources.shared import write_table

CHANGES = "image_id string, artifact string, change string"
#: Parts of a dataset's state when it is first scanned; they stay as they are.
PARTS = 64

_BY_FILE = {f: a for a, f in ARTIFACTS.items()}


@dataclass
class _Part(InputPartition):
    number: int
    start: int
    end: int


class _Changes(DataSourceStreamReader):
    def __init__(self, options):
        self.dataset, self.state = options["path"].rstrip("/"), options["state"].rstrip("/")
        self.wanted = int(options.get("parts", PARTS))

    def parts(self) -> int:
        """The number of parts, fixed by the first scan."""
        path = f"{self.state}/parts"
        if not exists(path):
            write_bytes(path, str(self.wanted).encode())
        return int(read_bytes(path))

    def initialOffset(self) -> dict:
        return {"scan": 0}

    def latestOffset(self) -> dict:
        return {"scan": time.time_ns()}

    def partitions(self, start: dict, end: dict):
        return [_Part(i, start["scan"], end["scan"]) for i in range(self.parts())]

    def _file(self, kind: str, scan: int, part: int) -> str:
        return f"{self.state}/{scan}/{kind}-{part}"

    def read(self, partition: _Part) -> Iterator[tuple]:
        done = self._file("changes", partition.end, partition.number)
        if not exists(done):  # else a repeated task or batch
            before = self._before(partition.start, partition.number)
            now = self._listed(partition.number)
            changes = []
            for image in sorted(before.keys() | now.keys()):
                old, new = set(before.get(image, ())), set(now.get(image, ()))
                changes += [(image, a, "made") for a in sorted(new - old)] + [(image, a, "lost") for a in sorted(old - new)]
            self._hold(self._file("state", partition.end, partition.number), {i: sorted(a) for i, a in now.items()})
            self._hold(done, changes)
        yield from (tuple(c) for c in self._held(done))

    def _scans(self) -> list[int]:
        """Scans that have left something, the newest first."""
        system, bare = locate(self.state)
        found = system.get_file_info(fs.FileSelector(bare, allow_not_found=True))
        return sorted((int(i.base_name) for i in found if i.type == fs.FileType.Directory and i.base_name.isdigit()), reverse=True)

    def _before(self, start: int, part: int) -> dict[str, list[str]]:
        """The part's newest state up to a scan; a scan whose rows nobody read has left none."""
        for scan in self._scans():
            if scan <= start and exists(path := self._file("state", scan, part)):
                return self._held(path)
        return {}

    @staticmethod
    def _hold(path: str, value) -> None:
        write_bytes(path, zlib.compress(json.dumps(value).encode()))

    @staticmethod
    def _held(path: str):
        return json.loads(zlib.decompress(read_bytes(path)))

    def _listed(self, part: int) -> dict[str, list[str]]:
        """Artifacts of the images below the part's top-level folders."""
        system, bare = locate(self.dataset)
        top = [i for i in system.get_file_info(fs.FileSelector(bare, allow_not_found=True)) if i.type == fs.FileType.Directory]
        out: dict[str, list[str]] = {}
        for folder in (i for i in top if zlib.crc32(i.base_name.encode()) % self.parts() == part):
            for path in list_files(f"{self.dataset}/{folder.base_name}"):
                image, _, file = f"{folder.base_name}/{path}".rpartition("/")
                if file in _BY_FILE:
                    out.setdefault(image, []).append(_BY_FILE[file])
        return out

    def commit(self, end: dict) -> None:
        """States of scans before ``end`` are needed no more, once every part has one for ``end``."""
        if all(exists(self._file("state", end["scan"], i)) for i in range(self.parts())):
            for scan in self._scans():
                if scan < end["scan"]:
                    delete_folder(f"{self.state}/{scan}")


class ChangesSource(DataSource):
    """Format ``dataset_changes``: options ``path``, ``state`` (a folder that driver and tasks reach), ``parts``."""

    @classmethod
    def name(cls) -> str:
        return "dataset_changes"

    def schema(self) -> str:
        return CHANGES

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Changes(self.options)


def changes(spark: SparkSession, dataset: str, state: str, parts: int = PARTS) -> DataFrame:
    """Stream of CHANGES of a dataset; each trigger is one scan."""
    spark.dataSource.register(ChangesSource)
    return spark.readStream.format("dataset_changes").option("state", state).option("parts", parts).load(dataset)


def process_changes(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """One scan: give its changes, as a written table, to ``work``, then stop. ``work`` must bear being given a scan twice."""
    return stream.writeStream.foreachBatch(lambda batch, n: work(write_table(batch), n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def redo(batch: DataFrame) -> DataFrame:
    """(image_id, artifacts): images of a batch that lost artifacts, and which; images that are gone altogether have lost their metadata, too."""
    return batch.where("change = 'lost'").groupBy("image_id").agg(F.sort_array(F.collect_set("artifact")).alias("artifacts"))
