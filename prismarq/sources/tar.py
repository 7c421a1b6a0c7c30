"""Tar archives as a Python data source: label-named archives written atomically, samples scanned or picked by key.

A write task gets rows (label, pos, image_id, file, content), sorted by label and
position, and streams one uncompressed archive per label to a ``.part`` name; the
commit renames them, so a task that fails or runs twice leaves no half archive
behind.  With ``index`` it also writes ``<label>.tar.index``, a Parquet file with the
place of every member in the archive.

A scan takes filters on shard, key, member and pos.  Archives that a filter on the shard rules out are
not opened; of an indexed archive only the byte ranges of the members that are asked for are read, and a large one is
shared out in several partitions.  Archives without an index are streamed from end to end.
``index_tars`` adds indexes to archives that others have written.
"""

from __future__ import annotations

import io
import json
import tarfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith,
    WriterCommitMessage,
)

from prismarq.sources.files import locate, write_bytes

READ = "shard string, pos bigint, key string, member string, content binary"
PLACES = "shard string, pos bigint, key string, member string, start bigint, length bigint"
WRITE = "label string, pos bigint, image_id string, file string, content binary"
#: Members of a row group of an index.
GROUP = 64
#: Archives of more bytes are shared out; neighbours are fetched together over gaps of ``GAP`` up to ``FETCH`` bytes.
SPLIT, GAP, FETCH = 64 << 20, 4096, 8 << 20

_INDEX = pa.schema([("pos", pa.int64()), ("key", pa.string()), ("member", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
_TESTS: dict[type, Callable] = {
    EqualTo: lambda v, x: v == x, In: lambda v, x: v in x, StringStartsWith: lambda v, x: v.startswith(x), IsNotNull: lambda v, x: True,
    LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x, GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x,
}


def _possible(kind: type, wanted, low, high) -> bool:
    """Whether a value between ``low`` and ``high`` can pass a filter."""
    if kind is EqualTo:
        return low <= wanted <= high
    if kind is In:
        return any(low <= x <= high for x in wanted)
    if kind is StringStartsWith:
        return low[: len(wanted)] <= wanted <= high[: len(wanted)]
    return {LessThan: lambda: low < wanted, LessThanOrEqual: lambda: low <= wanted, GreaterThan: lambda: high > wanted, GreaterThanOrEqual: lambda: high >= wanted}.get(kind, lambda: True)()


@dataclass
class Wanted:
    """Filters that a scan answers itself: (column, kind, value)."""

    tests: list[tuple[str, type, object]] = field(default_factory=list)

    def take(self, f: Filter) -> bool:
        """Take a filter over, if it is one of a known kind on one of the columns."""
        column = getattr(f, "attribute", ("",))[0]
        known = type(f) in _TESTS and column in ("shard", "pos", "key", "member") and len(f.attribute) == 1
        if known:
            self.tests.append((column, type(f), getattr(f, "value", None)))
        return known

    def passes(self, **values) -> bool:
        return all(_TESTS[kind](values[c], x) for c, kind, x in self.tests if c in values)

    def groups(self, meta: pq.FileMetaData) -> Iterator[int]:
        """Row groups of an index that may hold members asked for."""
        for g in range(meta.num_row_groups):
            stats = {n: meta.row_group(g).column(i).statistics for i, n in enumerate(_INDEX.names[:3])}
            if all(stats[c] is None or not stats[c].has_min_max or _possible(kind, x, stats[c].min, stats[c].max) for c, kind, x in self.tests if c in stats):
                yield g


@dataclass
class _Part(InputPartition):
    path: str
    indexed: bool
    groups: list[int] | None = None


def _files(folder: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    system, bare = locate(folder)
    return system, sorted((i for i in system.get_file_info(fs.FileSelector(bare)) if i.type == fs.FileType.File), key=lambda i: i.path)


def member_key(name: str) -> tuple[str, str]:
    """Key (folder) and file name of a member."""
    key, _, file = name.rpartition("/")
    return key, file


class _Reader(DataSourceReader):
    def __init__(self, options, places: bool):
        self.folder, self.places = options["path"], places
        self.split = int(options.get("splitbytes", SPLIT))
        self.log = options.get("log")
        self.wanted = Wanted()

    def pushFilters(self, filters):
        return [f for f in filters if not self.wanted.take(f)]

    def partitions(self):
        system, found = _files(self.folder)
        names, out = {i.path for i in found}, []
        for info in found:
            if not info.path.endswith(".tar") or not self.wanted.passes(shard=info.base_name):
                continue
            indexed = f"{info.path}.index" in names
            if not indexed or info.size <= self.split:
                out.append(_Part(info.path, indexed))
                continue
            meta = pq.read_metadata(f"{info.path}.index", filesystem=system)
            groups = list(self.wanted.groups(meta))
            step = max(1, -(-meta.num_row_groups // -(-info.size // self.split)))
            out += [_Part(info.path, True, groups[i : i + step]) for i in range(0, len(groups), step)]
        return out

    def read(self, partition) -> Iterator[tuple]:
        if partition is None:
            return
        system, _ = locate(self.folder)
        name = partition.path.rpartition("/")[2]
        if not partition.indexed:
            with system.open_input_stream(partition.path, compression=None) as stream:
                for pos, key, member, start, body in _walk(stream, "r|", not self.places):
                    if self.wanted.passes(shard=name, pos=pos, key=key, member=member):
                        yield (name, pos, key, member, start, body) if self.places else (name, pos, key, member, body)
            return
        index = pq.ParquetFile(f"{partition.path}.index", filesystem=system)
        fetched = []
        for g in self.wanted.groups(index.metadata) if partition.groups is None else partition.groups:
            rows = [r for r in zip(*(c.to_pylist() for c in index.read_row_group(g).columns), strict=True) if self.wanted.passes(pos=r[0], key=r[1], member=r[2])]
            if self.places:
                yield from ((name, *r) for r in rows)
                continue
            with system.open_input_file(partition.path) as f:
                for run in _runs(sorted(rows, key=lambda r: r[3])):
                    begin = run[0][3]
                    f.seek(begin)
                    data = f.read(run[-1][3] + run[-1][4] - begin)
                    fetched.append({"file": name, "start": begin, "length": len(data)})
                    yield from ((name, pos, key, member, data[at - begin : at - begin + n]) for pos, key, member, at, n in run)
        if self.log:
            write_bytes(f"{self.log}/{uuid.uuid4().hex}.json", json.dumps(fetched).encode())


def _walk(stream, mode: str, bodies: bool) -> Iterator[tuple[int, str, str, int, bytes | int]]:
    """(pos, key, member, start, body or length) of an archive's files; one member in memory at a time."""
    with tarfile.open(fileobj=stream, mode=mode) as tar:
        pos, last = -1, None
        for m in tar:
            if m.isfile():
                key, file = member_key(m.name)
                pos, last = pos + (key != last), key
                yield pos, key, file, m.offset_data, tar.extractfile(m).read() if bodies else m.size
                tar.members = []  # else headers pile up


def _runs(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Neighbours (..., start, length) that are fetched together."""
    run: list[tuple] = []
    for r in rows:
        if run and (r[3] > run[-1][3] + run[-1][4] + 512 + GAP or r[3] + r[4] - run[0][3] > FETCH):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


@dataclass
class _Done(WriterCommitMessage):
    files: list[tuple[str, str]]


class _Archive:
    """One archive as it is written, with the places of its members."""

    def __init__(self, system: fs.FileSystem, final: str, index: bool):
        self.system, self.final, self.part = system, final, f"{final}.{uuid.uuid4().hex}.part"
        self.stream = system.open_output_stream(self.part, compression=None)
        self.tar = tarfile.open(fileobj=self.stream, mode="w|")
        self.index, self.rows, self.pos, self.key = index, [], -1, None
        self.tables: list[pa.Table] = []

    def add(self, key: str, file: str, content: bytes) -> None:
        member = tarfile.TarInfo(f"{key}/{file}")
        member.size = len(content)
        self.tar.addfile(member, io.BytesIO(content))
        self.tar.members = []  # else headers pile up
        self.pos, self.key = self.pos + (key != self.key), key
        if self.index:
            self.rows.append((self.pos, key, file, self.tar.offset - -(-member.size // 512) * 512, member.size))
            if len(self.rows) == GROUP:
                self._keep()

    def _keep(self) -> None:
        self.tables.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), _INDEX, strict=True)], schema=_INDEX))
        self.rows = []

    def close(self) -> list[tuple[str, str]]:
        """(temporary, final) names; the index first, so that an archive that is there has its index."""
        self.tar.close()
        self.stream.close()
        if self.rows:
            self._keep()
        if self.index:
            pq.write_table(pa.concat_tables([_INDEX.empty_table(), *self.tables]), f"{self.part}.index", filesystem=self.system, row_group_size=GROUP)
        return [(f"{self.part}.index", f"{self.final}.index")] * self.index + [(self.part, self.final)]


class _Writer(DataSourceWriter):
    def __init__(self, options):
        self.folder, self.index = options["path"], options.get("index", "false").lower() == "true"

    def write(self, rows) -> _Done:
        system, folder = locate(self.folder)
        system.create_dir(folder, recursive=True)
        done, archive, label = [], None, None
        for r in rows:
            if archive is None or r["label"] != label:
                done += archive.close() if archive else []
                label = r["label"]
                archive = _Archive(system, f"{folder}/{label}.tar", self.index)
            archive.add(r["image_id"], r["file"], bytes(r["content"]))
        return _Done(done + (archive.close() if archive else []))

    def commit(self, messages) -> None:
        system, _ = locate(self.folder)
        for m in messages:
            for part, final in m.files if m else ():
                system.move(part, final)

    def abort(self, messages) -> None:
        system, _ = locate(self.folder)
        for m in messages:
            for part, _ in m.files if m else ():
                if system.get_file_info(part).type == fs.FileType.File:
                    system.delete_file(part)


class TarSource(DataSource):
    """Format ``tar``: options ``splitBytes``, ``log`` (a folder that is told which byte ranges were read), ``index`` for writing."""

    @classmethod
    def name(cls) -> str:
        return "tar"

    def schema(self) -> str:
        return PLACES if self.options.get("places", "false").lower() == "true" else READ

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, "start" in schema.fieldNames())

    def writer(self, schema, overwrite) -> DataSourceWriter:
        return _Writer(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TarSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_tars(spark: SparkSession, folder: str, **options) -> DataFrame:
    """READ rows of all archives of a folder; filters on shard, key, member and pos reach the archives."""
    register(spark)
    return spark.read.format("tar").options(**options).load(folder)


def read_places(spark: SparkSession, folder: str) -> DataFrame:
    """PLACES of all members, without their bytes."""
    return read_tars(spark, folder, places=True)


def write_tars(files: DataFrame, folder: str, labels: int | None = None, index: bool = False) -> None:
    """Write ``files`` (WRITE) as one archive per label, members in order of position and file name."""
    register(files.sparkSession)
    labels = labels or max(1, files.select("label").distinct().count())
    rows = files.select(*[c.split()[0] for c in WRITE.split(", ")]).repartition(labels, "label").sortWithinPartitions("label", "pos", "file")
    rows.write.format("tar").mode("append").option("index", str(index)).save(folder)


def index_tars(spark: SparkSession, folder: str) -> int:
    """Index the archives of ``folder`` that have none, from their headers alone; how many were indexed."""
    system, found = _files(folder)
    names = {i.path for i in found}
    bare = [(i.path,) for i in found if i.path.endswith(".tar") and f"{i.path}.index" not in names]
    if not bare:
        return 0

    def run(parts):
        own, _ = locate(folder)
        for batch in parts:
            for path in batch.column("path").to_pylist():
                with own.open_input_file(path) as f:
                    rows = list(_walk(f, "r:", False))
                table = pa.Table.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows) if rows else [()] * 5, _INDEX, strict=True)], schema=_INDEX)
                part = f"{path}.index.{uuid.uuid4().hex}.part"
                pq.write_table(table, part, filesystem=own, row_group_size=GROUP)
                own.move(part, f"{path}.index")
            yield batch

    return spark.createDataFrame(bare, "path string").repartition(len(bare), F.col("path")).mapInArrow(run, "path string").count()
