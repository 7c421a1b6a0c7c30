"""What the operators of this subpackage share.

Word classes, tables in the shared folder, and a vectorised view of a batch of texts
(``Texts``, over Arrow memory without copies) that finds and hashes words without
Python loops, in pieces of about ``BATCH_BYTES`` whatever the length of a text.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.sources.shared import BROADCAST_ROWS, shared_folder, small, write_table  # noqa: F401

#: A word: a run of characters that are not ASCII white space (Java and RE2 syntax alike).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Texts are worked on in pieces of about so many bytes.
BATCH_BYTES = 1 << 20


def lower_ascii(col: Column) -> Column:
    """``col`` with A-Z lower-cased and every other character left alone."""
    return F.translate(col, UPPER, LOWER)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names like ``names`` that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def corpus_seed(df: DataFrame, column: str = "doc_id") -> int:
    """A seed that is the same whenever the table is, and that the author of one of its texts does not know: from all values of a column."""
    n, all_ = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(F.col(column).cast("string")))).first()
    return int.from_bytes(hashlib.blake2b(f"{n} {all_}".encode(), digest_size=8).digest(), "little") >> 1


def give_back() -> None:
    """Return a Python worker's freed memory to the system before the worker waits for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# --- vectorised hashing -----------------------------------------------------------------

_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        most = max(n, BATCH_BYTES + 4096)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(most, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[key] = np.cumprod(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Rolling:
    """Hashes of any slices of a sequence of 64-bit codes, from prefix sums modulo 2**64.

    Long slices of two alternating codes can be made to collide, so this only
    chooses places and candidates; it never decides that texts are equal.
    """

    def __init__(self, codes: np.ndarray):
        self.up, self.down = _powers(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * self.up[:-1], out=self.sums[1:])

    def slices(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix64((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))


_LEFT = np.uint64(0xD6E8FEB86659FD93)
_WORD_SEED = np.uint64(0xA0761D6478BD642F)
#: Longer words are hashed one by one with BLAKE2b.
_LONG_WORD = 512


def hash_slices(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int | None = None) -> np.ndarray:
    """64-bit hashes of byte slices: eight bytes at a time, each scrambled into the state, which begins with ``seed``, by a bijection."""
    begin, key = (_WORD_SEED, b"") if seed is None else (np.uint64(seed), seed.to_bytes(8, "little"))
    padded = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray(len(raw) + 1, dtype="<u8", buffer=padded, strides=(1,))
    left = stops - starts
    out = begin ^ left.astype(np.uint64)
    for i in np.flatnonzero(left > _LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : stops[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    rows = np.flatnonzero((left > 0) & (left <= _LONG_WORD))
    at, left = starts[rows], left[rows]
    while len(rows):
        part = eights[at]
        cut = left < 8
        part[cut] &= (np.uint64(1) << (left[cut] << 3).astype(np.uint64)) - np.uint64(1)
        out[rows] = mix64(out[rows] ^ part) + _LEFT
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return out


def join_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the sequences that ``a`` and ``b`` stand for, one after the other."""
    return mix64(a * _LEFT + b)


def code_windows(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all ``k`` consecutive codes, by doubling."""
    out, used, width, power = None, 0, 1, codes
    while True:
        if k & width:
            n = max(0, len(codes) - used - width + 1)
            out = power[:n] if out is None else join_codes(out[:n], power[used : used + n])
            used += width
        width *= 2
        if width > k:
            return out
        n = max(0, len(power) - width // 2)
        power = join_codes(power[:n], power[width // 2 : width // 2 + n])


class Texts:
    """Byte view of a batch of texts: ``data`` and the bounds of each text; null is empty."""

    def __init__(self, column):
        if isinstance(column, (list, tuple)):
            sizes = np.fromiter(map(len, column), dtype=np.int64, count=len(column))
            self.data = np.frombuffer(b"".join(column), dtype=np.uint8)
            self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            return
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if column.null_count:
            column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, offsets, data = column.buffers()
        n = len(column)
        kind = np.int64 if wide else np.int32
        held = np.frombuffer(offsets, dtype=kind, count=column.offset + n + 1) if offsets is not None and offsets.size else np.zeros(n + 1, dtype=kind)
        self.offsets = held[column.offset :].astype(np.int64)
        self.data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def __getitem__(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def groups(self, most: int = BATCH_BYTES) -> Iterator[Texts]:
        """Runs of texts of about ``most`` bytes together; a longer text is alone.  ``first`` numbers their first text."""
        at = 0
        while at < len(self):
            stop = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + most, side="right")) - 1)
            part = Texts.__new__(Texts)
            part.data, part.offsets, part.first = self.data, self.offsets[at : stop + 1], at
            yield part
            at = stop

    def pieces(self, most: int = BATCH_BYTES) -> Iterator[tuple[int, np.ndarray]]:
        """(place, bytes) of consecutive pieces that cut no word; longer than ``most`` only where one word is."""
        at, end = int(self.offsets[0]), int(self.offsets[-1])
        while at < end:
            stop = min(at + most, end)
            while stop < end:  # back to a space or a text's start, or on to the next
                spaces = np.flatnonzero(_SPACE[self.data[at:stop]])
                edge = int(self.offsets[np.searchsorted(self.offsets, stop, side="right") - 1])
                cut = max(at + int(spaces[-1]) + 1 if len(spaces) else at, edge)
                if cut > at:
                    stop = cut
                    break
                stop = min(stop + most, end)
            yield at, self.data[at:stop]
            at = stop

    def words(self, lower: bool = False, seed: int | None = None) -> Words:
        """Hashes and counts of the words of all texts; who does not know the ``seed`` can't make words that collide."""
        hashes, counts = [], np.zeros(len(self), dtype=np.int64)
        for at, raw in self.pieces():
            inside = ~_SPACE[raw]
            edges = self.offsets[np.searchsorted(self.offsets, at) : np.searchsorted(self.offsets, at + len(raw))] - at
            first = np.zeros(len(raw) + 1, dtype=bool)
            first[edges] = True
            begin = inside.copy()
            begin[1:] &= ~inside[:-1] | first[1:-1]
            starts = np.flatnonzero(begin)
            done = inside.copy()
            done[:-1] &= ~inside[1:] | first[1:-1]
            stops = np.flatnonzero(done) + 1
            hashes.append(hash_slices(_LOWER[raw] if lower else raw, starts, stops, seed))
            owner = np.searchsorted(self.offsets, starts + at, side="right") - 1
            counts += np.bincount(owner, minlength=len(self))
        return Words(np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), counts)


class Words:
    """Word hashes of several texts in a row: ``first[i]`` is where text ``i`` begins."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        self.hashes, self.counts = hashes, counts
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.owner = np.repeat(np.arange(len(counts)), counts)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the first words of all k-word windows within a text, and the windows' hashes."""
        at = np.arange(max(0, len(self.hashes) - k + 1))
        at = at[at + k <= self.first[1:][self.owner[at]]]
        return at, code_windows(self.hashes, k)[at] if len(at) else np.zeros(0, dtype=np.uint64)

    def whole(self, rows: np.ndarray) -> np.ndarray:
        """Hashes of the whole word sequences of texts ``rows``; for short ones."""
        out = mix64(self.counts[rows].astype(np.uint64) + _WORD_SEED)
        for i in range(int(self.counts[rows].max(initial=0))):
            more = np.flatnonzero(self.counts[rows] > i)
            out[more] = join_codes(out[more], self.hashes[self.first[rows[more]] + i])
        return out


def batches(texts: list[bytes], most: int = BATCH_BYTES):
    """Index ranges of ``texts`` that hold about ``most`` bytes each; a longer text is alone."""
    at, n = 0, 0
    for i, t in enumerate(texts):
        if i > at and n + len(t) > most:
            yield at, i
            at, n = i, 0
        n += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def as_bytes(column) -> list[bytes]:
    """UTF-8 of an Arrow or pandas column of strings; null becomes empty."""
    values = column.to_pylist() if hasattr(column, "to_pylist") else column
    return [b"" if not isinstance(v, str) else v.encode("utf-8", "surrogatepass") for v in values]
