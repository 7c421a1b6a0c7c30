"""WARC archives with a two-level capture index.

``write_archives`` writes one record per page, each a gzip member of its own, into
files of the tasks; pages whose payload another page has too are written once, as
the response of the largest page id, and as revisits otherwise.  ``build_index``
sorts one line per record by its reversed-host URL key (``com,example,www)/path``)
into range files of compressed blocks, each with a sparse directory of the blocks'
first keys.  ``lookup`` finds the captures of URLs, or of URL prefixes, by binary
search: of the range file among the ranges' bounds, of the block in the file's
directory, of the line in the block; only these blocks are read.  ``read_records``
fetches the byte ranges of captures, neighbours together, and checks each payload
against its digest.

Pages are written once to a table that numbers its rows, so that repeated tasks see
the same numbers; no payload meets another one in a task but those of a shuffled
join on payload digests, where repeated payloads are too many to broadcast.  The
bounds of at most ``MOST_PARTS`` range files are all that the driver holds.

Defined cases: a null payload is empty and a payload like others; a null URL has the
empty key and no target; of equal payloads with one page id, the last row is the
response; rows without a page id come before all others and keep none; spaces and
control characters of a URL are escaped in records and keys; other columns are not read;
an empty table gives no files, an index without lines and no captures.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.llm.common import shared_folder, small, write_table
from prismarq.sources.files import locate, write_bytes

#: Bytes after which a task begins another archive.
FILE_BYTES = 1 << 30
#: Lines of an index block, of an index part, and the most parts.
BLOCK_LINES, PART_LINES, MOST_PARTS = 1000, 20_000, 10_000
#: Adjacent records are fetched together up to so many bytes.
FETCH_BYTES = 8 << 20
#: Equal payloads of fewer bytes are all responses.
LEAST_BYTES = 0
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CAPTURE = "key string, row bigint, url string, type string, digest string, file string, start bigint, length bigint"
_ARROW = pa.schema([(n, pa.int64() if k == "bigint" else pa.string()) for n, k in (c.strip().split() for c in _CAPTURE.split(","))])


def url_key(url: Column) -> Column:
    """Sort key: host labels reversed, port, ``)``, and the rest of the URL; a URL without ``://`` as it is, null as empty."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*", 0), r"^.*@", "")
    labels = F.array_join(F.reverse(F.split(F.lower(F.regexp_replace(host, r":[0-9]*$", "")), r"\.")), ",")
    key = F.concat(labels, F.regexp_extract(host, r":[0-9]+$", 0), F.lit(")"), F.regexp_replace(rest, r"^[^/?#]*", ""))
    return F.regexp_replace(F.coalesce(F.when(at > 0, key).otherwise(url), F.lit("")), r"[\x00-\x20\x7F]", "+")


def _field(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record(kind: str, identity: str, block: bytes, *fields: tuple[str, str | int | None]) -> bytes:
    """One record as a gzip member."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", identity), ("WARC-Date", DATE), *fields, ("Content-Length", len(block))]
    lines = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in head if v is not None) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(lines.encode() + block + b"\r\n\r\n") + squeeze.flush()


def digest_of(payload: bytes) -> str:
    """SHA-1 in base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _identity(folder: str, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{folder}/{row}')}>"


class _Files:
    """Files of one task, one after the other; names carry the attempt, so attempts never share one."""

    def __init__(self, folder: str, suffix: str):
        self.system, self.folder = locate(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.suffix, self.n, self.stream = suffix, 0, None
        self.stem = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"

    def write(self, data: bytes, most: int, head=lambda name: b"") -> tuple[str, int]:
        """(file, offset) at which ``data`` was written."""
        if self.stream is not None and self.at + len(data) > most:
            self.close()
        if self.stream is None:
            self.name, self.n = f"{self.stem}-{self.n:04d}.{self.suffix}", self.n + 1
            self.stream, first = self.system.open_output_stream(f"{self.folder}/{self.name}", compression=None), head(self.name)
            self.stream.write(first)
            self.at = len(first)
        at, self.at = self.at, self.at + len(data)
        self.stream.write(data)
        return self.name, at

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, page: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row of ``pages`` below ``folder``; one capture (key, row, url, type, digest, file, start, length) each."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    held = pages.select(F.col(page).cast("long").alias("page"), F.col(url).alias("url"), body.alias("body"), F.sha2(body, 256).alias("sha"), F.monotonically_increasing_id().alias("row"))
    held = write_table(held)
    same = held.where(F.octet_length("body") >= least_bytes).groupBy("sha").agg(F.count("*").alias("n"), F.max(F.struct("page", "row", "url")).alias("first"))
    same = write_table(same.where("n > 1").select("sha", "first"))
    rows = held.join(small(same), "sha", "left").select("page", "url", url_key(F.col("url")).alias("key"), "body", "row", F.when(F.col("first.row") != F.col("row"), F.col("first")).alias("first"))
    info = lambda name: _record("warcinfo", _identity(folder, -1), b"software: prismarq\r\nformat: WARC File Format 1.1\r\n", ("WARC-Filename", name), ("Content-Type", "application/warc-fields"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, "warc.gz")
        for batch in batches:
            out = []
            for number, url, key, body, row, first in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "key", "body", "row", "first")), strict=True):
                digest = digest_of(body)
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)
                fields = [("WARC-Target-URI", None if url is None else _field(url)), ("X-Page-ID", number), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
                if first is None:
                    kind, block = "response", http + body
                else:
                    kind, block = "revisit", http
                    target = None if first["url"] is None else _field(first["url"])
                    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _identity(folder, first["row"])), ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", DATE), ("X-Refers-To-Page-ID", first["page"])]
                data = _record(kind, _identity(folder, row), block, *fields)
                name, at = files.write(data, FILE_BYTES, info)
                out.append((key, row, url, kind, digest, name, at, len(data)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 8, _ARROW, strict=True)], schema=_ARROW)
        files.close()

    return write_table(rows.mapInArrow(write, _CAPTURE))


@dataclass(frozen=True)
class Index:
    """Sorted range files: ``parts`` holds (file, first key, last key) of each, in order; archives and index lie in ``folder``."""

    folder: str
    parts: list[tuple[str, str, str]]


def build_index(captures: DataFrame, folder: str) -> Index:
    """Sort ``captures`` by (key, row) into compressed blocks with sparse directories."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, lines, directory, bounds = _Files(folder, "cdxj"), [], [], []

        def flush() -> None:
            name, at = files.write(data := zlib.compress("\n".join(x for _, x in lines).encode(), 6), 1 << 62)
            directory.append({"key": lines[0][0], "start": at, "length": len(data), "lines": len(lines)})
            bounds[:] = [name, bounds[1] if bounds else lines[0][0], lines[-1][0]]
            lines.clear()

        for batch in batches:
            for c in batch.to_pylist():
                key, row = c.pop("key"), c.pop("row")
                lines.append((key, f"{key} {row} {json.dumps(c, ensure_ascii=False)}"))
                if len(lines) == BLOCK_LINES:
                    flush()
        if lines:
            flush()
        files.close()
        if bounds:
            write_bytes(f"{folder}/{bounds[0]}.directory", zlib.compress(json.dumps(directory, ensure_ascii=False).encode()))
        names = ["file", "first", "last"]
        yield pa.RecordBatch.from_arrays([pa.array([b] if bounds else [], pa.string()) for b in bounds or names], names)

    parts = max(1, min(MOST_PARTS, -(-captures.count() // PART_LINES)))
    ordered = captures.repartitionByRange(parts, "key", "row").sortWithinPartitions("key", "row")
    found = ordered.mapInArrow(write, "file string, first string, last string").collect()  # one row per part
    return Index(folder, sorted((tuple(r) for r in found), key=lambda r: (r[1].encode(), r[2].encode(), r[0])))


class _Part:
    """A range file in reach of binary search; holds its directory and the block read last."""

    def __init__(self, folder: str, name: str):
        system, bare = locate(f"{folder}/{name}")
        with system.open_input_file(f"{bare}.directory") as f:
            self.blocks = json.loads(zlib.decompress(f.read()))
        self.keys = [b["key"].encode() for b in self.blocks]
        self.file, self.held = system.open_input_file(bare), (-1, [], [])

    def block(self, k: int) -> tuple[list[bytes], list[str]]:
        if self.held[0] != k:
            self.file.seek(self.blocks[k]["start"])
            lines = zlib.decompress(self.file.read(self.blocks[k]["length"])).decode().split("\n")
            self.held = k, [x.partition(" ")[0].encode() for x in lines], lines
        return self.held[1], self.held[2]

    def search(self, begin: bytes, end: bytes) -> Iterator[str]:
        """Lines with begin <= key < end."""
        k = max(0, bisect.bisect_left(self.keys, begin) - 1)  # lines of the key may end the block before
        while k < len(self.keys) and self.keys[k] < end:
            keys, lines = self.block(k)
            yield from lines[bisect.bisect_left(keys, begin) : bisect.bisect_left(keys, end)]
            k += 1


def lookup(index: Index, urls: DataFrame, url: str = "url", prefix: bool = False) -> DataFrame:
    """Captures of the distinct values of ``urls``; with ``prefix``, of all URLs whose keys begin like theirs."""
    folder, parts = index.folder, index.parts
    firsts, lasts = [p[1].encode() for p in parts], [p[2].encode() for p in parts]

    def stop(key: bytes) -> bytes:
        return key + (b"\xff" if prefix else b"\x00")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, u in zip(batch.column("key").to_pylist(), batch.column("url").to_pylist(), strict=True):
                low, high = bisect.bisect_left(lasts, key.encode()), bisect.bisect_left(firsts, stop(key.encode()))
                out += [(p, key, u) for p in range(low, high)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 3, (pa.int32(), pa.string(), pa.string()), strict=True)], ["part", "key", "url"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, out = None, None, []

        def give() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 8, _ARROW, strict=True)], schema=_ARROW)
            out.clear()
            return made

        for batch in batches:
            for p, key, u in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "url")), strict=True):
                if p != at:
                    at, part = p, _Part(folder, parts[p][0])
                for line in part.search(key.encode(), stop(key.encode())):
                    found, row, rest = line.split(" ", 2)
                    c = json.loads(rest)
                    if prefix or c["url"] == u:
                        out.append((found, int(row), *(c[f.name] for f in _ARROW if f.name not in ("key", "row"))))
                        if len(out) >= 10_000:
                            yield give()
        yield give()

    asked = urls.select(url_key(F.col(url)).alias("key"), F.col(url).alias("url")).distinct()
    asked = asked.select("key", F.lit(None).cast("string").alias("url")).distinct() if prefix else asked
    placed = write_table(asked.mapInArrow(place, "part int, key string, url string"))
    tasks = max(1, min(MOST_PARTS, -(-placed.count() // PART_LINES)))
    return placed.repartitionByRange(tasks, "part", "key").sortWithinPartitions("part", "key").mapInArrow(search, _CAPTURE)


def _fields(lines: list[str]) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in lines if ": " in x)


def parse_record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record fields, HTTP fields and payload of one gzip member."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = _fields(head.decode().split("\r\n"))
    http, _, body = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, _fields(http.decode().split("\r\n")), body


def read_records(captures: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """(row, page_id, url, record_type, payload_bytes, payload_digest, refers_to[, payload]) of captures, from the archives.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, for a revisit too, whose own ``payload`` is null.
    """
    kinds = "row bigint, page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint" + ", payload binary" * payload
    names = [k.strip().split()[0] for k in kinds.split(",")]
    types = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k.strip().split()[1]] for k in kinds.split(",")]

    def of(row: int, url: str | None, member: bytes) -> tuple:
        fields, http, body = parse_record(member)
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (digest_of(body) != digest or len(body) != int(http["Content-Length"])):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
        number = lambda n: int(fields[n]) if n in fields else None
        return (row, number("X-Page-ID"), url, kind, int(http["Content-Length"]), digest, number("X-Refers-To-Page-ID"), *([body if kind == "response" else None] * payload))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = locate(folder)
        name, stream = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("row", "url", "file", "start", "length")), strict=True))
            i = 0
            while i < len(rows) or i == 0:
                j, out = i, []
                while j < len(rows) and rows[j][2] == rows[i][2] and (j == i or rows[j][3] == rows[j - 1][3] + rows[j - 1][4] and rows[j][3] + rows[j][4] - rows[i][3] <= FETCH_BYTES):
                    j += 1
                if j > i:
                    if rows[i][2] != name:
                        name, stream = rows[i][2], system.open_input_file(f"{top}/{rows[i][2]}")
                    begin = rows[i][3]
                    stream.seek(begin)
                    data = stream.read(rows[j - 1][3] + rows[j - 1][4] - begin)
                    out = [of(row, url, data[at - begin : at - begin + n]) for row, url, _, at, n in rows[i:j]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * len(names), types, strict=True)], names)
                i = max(j, i + 1)

    held = write_table(captures.select("row", "url", "file", "start", "length"))
    tasks = max(1, held.agg(F.sum("length")).first()[0] or 0) // (4 * FETCH_BYTES) + 1
    return held.repartitionByRange(tasks, "file", "start").sortWithinPartitions("file", "start").mapInArrow(read, kinds)


def op12_capture_index(spark, sf_dir: str) -> DataFrame:
    """Every ``pages`` row from the archives, found by its URL in the capture index."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = shared_folder(spark)
    index = build_index(write_archives(pages, folder), folder)
    found = read_records(lookup(index, pages.select("url")), folder, payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BITS = "('0x' || substr(hex, 5 * j + 1, 5))::BIGINT"
_CHARS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({_BITS}) >> {s}) & 31)::INT + 1, 1)" for s in (15, 10, 5, 0))
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
k AS (SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes, sha1(t) AS hex, max(page_id) OVER (PARTITION BY t) AS top,
  row_number() OVER (PARTITION BY t ORDER BY page_id DESC NULLS LAST) AS r FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda j: {_CHARS}), '') AS payload_digest,
  CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN r > 1 THEN top END AS refers_to FROM k"""
