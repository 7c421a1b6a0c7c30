"""Token-id files: an adaptive context-mixing range coder over independent blocks.

The chance of each id mixes three predictions.  Orders 1 and 2 remember, per hashed
context of the last one or two ids, the id that followed, with a trust; each lends
its id a weight that follows, for each order and trust, how often such predictions
have come true.  What the two leave is order 0: the ids' frequencies in the group
of blocks.  One or two steps of a carry-less range coder turn an id into bytes.

A block has at most ``BLOCK`` ids and starts with empty memories and fresh weights,
so blocks are independent but for the group's order-0 frequencies, which stand in
its head; ``LANES`` of them are coded side by side as NumPy vectors, which is what
makes a Python coder bearable.  Each block carries CRC-32 checksums of its bytes
and of its ids, the frequencies one of their own.

File (integers little-endian; one file per partition, in ascending doc_id order)::

    b"PRSMIDS2"
    group, repeated:   b"GRP1"  documents: u32  blocks: u32  ids in use: u32  log2 of the frequencies' sum: u32
        frequencies: bytes u32, CRC-32 u32, then zlib of the ids in use (each less the one before, u32) and of their frequencies (u32)
        documents: has id u8, doc_id i64, ids u32 (each)
        blocks: ids u32, bytes u32, CRC-32 of the bytes u32, CRC-32 of the ids as u32 u32 (each), then the bytes of all
    b"END1"  documents: u64  ids: u64

Texts are split at spaces and newlines before the tokenizers library encodes
them, each distinct word of some 24 MB of texts once, and not again while it is
known; only for tokenizers that drop white space (``drops_spaces``) is that the
encoding of the whole text, so others encode whole texts.  Words of letters share
their ids whatever their case and the signs behind them, as far as the tokenizer's
own normalizer and pre-tokenizer, asked about each letter, treat them so.  Files are written under a temporary name and renamed, and the
same rows give the same file, so a task that is run again does no harm.

Defined cases: null text is empty and gives the end id alone; null doc_ids come
first; rows of one doc_id are separate documents, in no stated order, and may be
spread over files; an empty table gives no file with documents and an empty
result; other columns of the input are not stored.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismarq.llm.common import shared_folder

BLOCK = 2048
LANES = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Bytes of known words, beyond which only those of late stay; bytes of texts whose distinct words are looked up together.
CACHED_BYTES = 32 << 20
POOL = 24 << 20
ROWS_PER_FILE = 6000

#: Contexts that orders 1 and 2 remember, each, per block; as a power of two.
_SLOTS = 256
#: Weights are parts of 2**16; none grows beyond _MOST, at a rate of 1 in 2**_RATE.
_WHOLE, _MOST, _RATE = 16, 63_488, 5
#: The coder's state: bits, a settled top word, and the least range to go on with.
_BITS, _TOP, _LEAST = 60, 44, 40
_MASK = np.int64((1 << _BITS) - 1)


@dataclass(frozen=True)
class Frequencies:
    """Order 0 of a group: the ids in use, ascending, and their frequencies, which add up to 2**``bits``."""

    ids: np.ndarray
    counts: np.ndarray
    bits: int

    @classmethod
    def of(cls, ids: np.ndarray) -> Frequencies:
        used, counts = np.unique(ids, return_counts=True)
        bits = max(16, int(max(1, len(used)) - 1).bit_length() + 3)
        room = (1 << bits) - len(used)
        scaled = 1 + counts * room // max(1, counts.sum())
        if len(used):
            scaled[np.argmax(scaled)] += (1 << bits) - scaled.sum()
        return cls(used.astype(np.int64), scaled.astype(np.int64), bits)

    @property
    def below(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts

    def pack(self) -> bytes:
        packed = zlib.compress(np.diff(self.ids, prepend=0).astype("<u4").tobytes() + self.counts.astype("<u4").tobytes(), 6)
        return struct.pack("<IIII", len(self.ids), self.bits, len(packed), zlib.crc32(packed)) + packed

    @classmethod
    def unpack(cls, take) -> Frequencies:
        n, bits, size, crc = struct.unpack("<IIII", take(16))
        packed = take(size)
        if zlib.crc32(packed) != crc:
            raise CorruptFile("frequencies have a wrong checksum")
        table = np.frombuffer(zlib.decompress(packed), dtype="<u4").astype(np.int64)
        return cls(np.cumsum(table[:n]), table[n:], bits)


class CorruptFile(ValueError):
    """A token-id file is damaged."""


class _Mixer:
    """The predictions of each lane for its next id: rows of order 1 and order 2.

    A context holds the id that followed it, as a code (number + 1), with a trust from 1 to 7
    (0: nothing yet); each order and trust has a weight.  Few calls on many lanes matter most,
    as a call costs as much as a thousand lanes.
    """

    def __init__(self, lanes: int, ids: int):
        kind = np.int32 if ids < 1 << 27 else np.int64
        self.held = np.zeros(2 * lanes * _SLOTS, dtype=kind)  # code * 8 + trust
        weights = np.full((2 * lanes, 8), 1 << _WHOLE - 2, dtype=np.int32)
        weights[:, 0] = 0
        self.weights = weights.reshape(-1)
        self.base, self.cells = np.arange(2 * lanes).reshape(2, lanes) * _SLOTS, np.arange(2 * lanes).reshape(2, lanes) * 8
        self.last, self.before = np.zeros(lanes, dtype=kind), np.zeros(lanes, dtype=kind)

    def start(self, k: int) -> None:
        """Mix the predictions for the next id of the first ``k`` lanes: order 2 has the weights below ``a``, order 1 those from there below ``b``."""
        near = self.last[:k] * 40_503  # may wrap, but the bits in use stay
        far = self.before[:k] * 51_787
        far ^= near
        near >>= 3
        far >>= 2
        slot = np.empty((2, k), dtype=np.int64)
        slot[0], slot[1] = near, far
        slot &= _SLOTS - 1
        slot += self.base[:, :k]
        self.slot, self.entry = slot, self.held.take(slot)
        self.trust = self.entry & 7
        self.cell = self.cells[:, :k] + self.trust
        self.said = self.entry >> 3
        self.weight = self.weights.take(self.cell)
        self.a = self.weight[1]
        rest = ((1 << _WHOLE) - self.a).view(np.uint32)
        rest *= self.weight[0].view(np.uint32)
        rest >>= _WHOLE
        self.b = rest.view(np.int32)
        self.b *= self.said[0] != self.said[1]
        self.b += self.a

    def learn(self, code: np.ndarray) -> None:
        k = len(code)
        right = self.said == code
        weight = right * np.int32(_MOST)
        weight -= self.weight
        weight >>= _RATE
        weight += self.weight
        self.weights[self.cell] = weight
        entry = np.where(self.trust > 2, self.entry - 2, (code << 3) | 1)
        np.copyto(entry, self.entry + (self.trust < 7), where=right)
        self.held[self.slot] = entry
        self.before[:k] = self.last[:k]
        np.subtract(code, 1, out=self.last[:k])


def _unsettled(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Lanes whose top word is settled, or whose range must be cut at a carry (which cuts it)."""
    top = low + width
    top ^= low
    settled = top < (1 << _TOP)
    go = np.flatnonzero(settled | (width < (1 << _LEAST)))
    cut = go[~settled[go]]
    if len(cut):
        width[cut] = -low[cut] & ((1 << _LEAST) - 1)
    return go


def _longest_first(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Order of blocks by falling size, and for each step how many still have ids."""
    order = np.argsort(-np.array(sizes, dtype=np.int64), kind="stable")
    sorted_ = np.array(sizes, dtype=np.int64)[order]
    longest = int(sorted_[0]) if len(sorted_) else 0
    return order, np.searchsorted(-sorted_, -np.arange(longest), side="left")


def encode_blocks(blocks: list[np.ndarray], table: Frequencies) -> list[bytes]:
    """Bytes of each block of ids that ``table`` knows; blocks are coded side by side."""
    order, active = _longest_first([len(b) for b in blocks])
    n, longest = len(blocks), len(active)
    mixer = _Mixer(n, len(table.ids))
    codes = np.zeros((longest, n), dtype=mixer.last.dtype)
    direct = np.zeros(0, dtype=codes.dtype)
    if len(table.ids) and table.ids[-1] < 1 << 20:  # a vocabulary's ids
        direct = np.zeros(int(table.ids[-1]) + 1, dtype=codes.dtype)
        direct[table.ids] = np.arange(1, len(table.ids) + 1)
    for x, i in enumerate(order):
        codes[: len(blocks[i]), x] = direct.take(blocks[i]) if len(direct) else np.searchsorted(table.ids, blocks[i]) + 1
    counts, below = np.append(0, table.counts), np.append(0, table.below)
    low, width = np.zeros(n, dtype=np.int64), np.full(n, _MASK, dtype=np.int64)
    room = longest * 3 + 8
    out, first = np.zeros(n * room, dtype=np.uint16), np.arange(n, dtype=np.int64) * room
    used = first.copy()
    for step, k in enumerate(active.tolist()):
        code = codes[step, :k]
        mixer.start(k)
        a, b = mixer.a, mixer.b
        one, two = mixer.said == code
        two &= a > 0
        one &= b > a
        neither = ~(one | two)
        begin = np.where(neither, b, np.where(two, 0, a))
        size = np.where(neither, 1 << _WHOLE, np.where(two, a, b)) - begin
        lo, wi = low[:k], width[:k]
        part = wi >> _WHOLE
        lo += part * begin
        part *= size
        inner = part >> table.bits
        lo += inner * below.take(code) * neither
        inner *= counts.take(code)
        np.copyto(part, inner, where=neither)
        wi[...] = part
        lo &= _MASK
        go = _unsettled(lo, wi)
        while len(go):
            some, at = lo.take(go), used.take(go)
            out[at] = some >> _TOP
            used[go] = at + 1
            some = some << 16 & _MASK
            wide = wi.take(go) << 16
            lo[go] = some
            again = _unsettled(some, wide)
            wi[go] = wide
            go = go[again]
        mixer.learn(code)
    result: list[bytes] = [b""] * n
    for x, i in enumerate(order):
        result[i] = out[first[x] : used[x]].astype(">u2").tobytes() + (int(low[x]) << 4).to_bytes(8, "big")
    return result


def decode_blocks(coded: list[bytes], sizes: list[int], table: Frequencies) -> list[np.ndarray]:
    """Ids of each block, given its bytes and number of ids."""
    order, active = _longest_first(sizes)
    n, longest = len(coded), len(active)
    data = np.zeros((n, max((len(c) for c in coded), default=0) // 2 + 8), dtype=np.uint16)
    for x, i in enumerate(order):
        words = np.frombuffer(coded[i], dtype=">u2")
        data[x, : len(words)] = words
    mixer = _Mixer(n, len(table.ids))
    counts, below = np.append(0, table.counts), np.append(0, table.below)
    place = np.repeat(np.arange(1, len(table.counts) + 1, dtype=mixer.last.dtype), table.counts)
    low, width = np.zeros(n, dtype=np.int64), np.full(n, _MASK, dtype=np.int64)
    # The state has 60 bits, three words and twelve bits of a fourth: the rest of that one is kept for the next shift.
    head = data[:, :4].astype(np.int64)
    code = head[:, 0] << 44 | head[:, 1] << 28 | head[:, 2] << 12 | head[:, 3] >> 4
    room = data.shape[1]
    used = np.arange(n, dtype=np.int64) * room + 3
    data = data.reshape(-1)
    data = np.append((data[:-1] & 15) << 12 | data[1:] >> 4, np.uint16(0))
    codes = np.zeros((longest, n), dtype=mixer.last.dtype)
    for step, k in enumerate(active.tolist()):
        mixer.start(k)
        a, b = mixer.a, mixer.b
        lo, wi, co = low[:k], width[:k], code[:k]
        part = wi >> _WHOLE
        above = co - lo
        above &= _MASK
        neither, two = above >= part * b, above < part * a
        begin = np.where(neither, b, np.where(two, 0, a))
        size = np.where(neither, 1 << _WHOLE, np.where(two, a, b)) - begin
        begin = part * begin
        lo += begin
        above -= begin
        part *= size
        inner = part >> table.bits
        deep = np.minimum(above // np.maximum(inner, 1), (1 << table.bits) - 1)
        number = np.where(neither, place.take(deep), np.where(two, mixer.said[1], mixer.said[0]))
        lo += inner * below.take(number) * neither
        inner *= counts.take(number)
        np.copyto(part, inner, where=neither)
        wi[...] = part
        lo &= _MASK
        go = _unsettled(lo, wi)
        while len(go):
            at = used.take(go)
            used[go] = at + 1
            co[go] = (co.take(go) << 16 & _MASK) | data.take(at)
            some = lo.take(go) << 16 & _MASK
            wide = wi.take(go) << 16
            lo[go] = some
            again = _unsettled(some, wide)
            wi[go] = wide
            go = go[again]
        mixer.learn(number)
        codes[step, :k] = number
    result: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * n
    ids = np.append(0, table.ids).astype(np.uint32)
    for x, i in enumerate(order):
        result[i] = ids.take(codes[: sizes[i], x])
    return result


# --- files ------------------------------------------------------------------------------


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def group_bytes(documents: list[tuple[int | None, np.ndarray]]) -> bytes:
    """One group of documents (doc_id, ids) as bytes."""
    ids = np.concatenate([d[1] for d in documents]) if documents else np.zeros(0, dtype=np.uint32)
    blocks = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
    table = Frequencies.of(ids)
    coded: list[bytes] = []
    for i in range(0, len(blocks), LANES):
        coded.extend(encode_blocks(blocks[i : i + LANES], table))
    head = [b"GRP1", struct.pack("<II", len(documents), len(blocks)), table.pack()]
    head += [struct.pack("<BqI", d is not None, d or 0, len(x)) for d, x in documents]
    head += [struct.pack("<IIII", len(b), len(c), zlib.crc32(c), _crc(b)) for b, c in zip(blocks, coded, strict=True)]
    return b"".join(head + coded)


def read_groups(stream, name: str = "file") -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """Groups of documents (doc_id, ids) of one open file, verified."""

    def take(n: int) -> bytes:
        b = stream.read(n)
        if len(b) != n:
            raise CorruptFile(f"{name} ends early")
        return b

    if take(8) != b"PRSMIDS2":
        raise CorruptFile(f"{name} is not a token-id file")
    n_docs = n_ids = 0
    while (kind := take(4)) == b"GRP1":
        docs, blocks = struct.unpack("<II", take(8))
        table = Frequencies.unpack(take)
        heads = [struct.unpack("<BqI", take(13)) for _ in range(docs)]
        sizes = [struct.unpack("<IIII", take(16)) for _ in range(blocks)]
        coded = [take(s[1]) for s in sizes]
        for i, (s, c) in enumerate(zip(sizes, coded, strict=True)):
            if zlib.crc32(c) != s[2]:
                raise CorruptFile(f"{name}: block {i} has a wrong checksum")
        found: list[np.ndarray] = []
        for i in range(0, blocks, LANES):
            found.extend(decode_blocks(coded[i : i + LANES], [s[0] for s in sizes[i : i + LANES]], table))
        for i, (s, b) in enumerate(zip(sizes, found, strict=True)):
            if _crc(b) != s[3]:
                raise CorruptFile(f"{name}: block {i} decodes to other ids")
        flat = np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)
        ends = np.cumsum([h[2] for h in heads])
        yield [(h[1] if h[0] else None, flat[e - h[2] : e]) for h, e in zip(heads, ends, strict=True)]
        n_docs, n_ids = n_docs + docs, n_ids + len(flat)
    if kind != b"END1" or struct.unpack("<QQ", take(16)) != (n_docs, n_ids):
        raise CorruptFile(f"{name} has no right end")


#: Normalizers that change each character by itself, or by its neighbours of the same word.
_LOCAL = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"}
#: Characters of every kind a pre-tokenizer may tell apart.
_KINDS = "aZ1'sé漢\u0301!_-<"


def _steps(part: dict | None, key: str) -> list[dict]:
    """The steps of a tokenizer's part, one or a sequence."""
    return [] if part is None else part[key] if part["type"] == "Sequence" else [part]


def drops_spaces(tokenizer) -> bool:
    """Whether no token of ``tokenizer`` spans or depends on a space or newline, by its normalizer, pre-tokenizer and added tokens."""
    parts = json.loads(tokenizer.to_str())
    for n in _steps(parts["normalizer"], "normalizers"):
        spaces = n["type"] == "Replace" and n["pattern"] in ({"Regex": r"\s+"}, {"Regex": r"\s"}) and n["content"] == " "
        if n["type"] not in _LOCAL and not spaces:
            return False
    if any(c in t["content"] for t in parts["added_tokens"] for c in " \n") or tokenizer.pre_tokenizer is None:
        return False
    cut = lambda text: [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    return all(cut(f"{a}{gap}{b}") == cut(a) + cut(b) for a in ("", *_KINDS) for b in ("", *_KINDS) for gap in (" ", "  "))


#: Letters that may be told by their code points: none of them composes with the letter before it.
_LETTERS = ((0x41, 0x1100), (0x1200, 0x2000), (0x3040, 0xA000), (0xAC00, 0xD7A4))
#: Characters that may end a word of letters without a say in its other ids.
_TAILS = ".,;:!?*$%&#"


def _made_of(chars: list[str]) -> str:
    """A regular expression of one or more of ``chars``, which ascend."""
    points = np.array([ord(c) for c in chars])
    first = np.flatnonzero(np.diff(points, prepend=-1) != 1)
    last = np.append(first[1:], len(points)) - 1
    return "^[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(points[first].tolist(), points[last].tolist(), strict=True)) + "]+$"


def _pick(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the items ``which``, one item after the other, and the number of each."""
    n = sizes.take(which)
    out, done = np.empty(int(n.sum()), dtype=values.dtype), 0
    for i in range(0, len(which), 1 << 17):
        some = n[i : i + (1 << 17)]
        at = np.repeat(starts.take(which[i : i + (1 << 17)]) - np.cumsum(some) + some, some)
        at += np.arange(len(at))
        out[done : done + len(at)] = values.take(at)
        done += len(at)
    return out, n


def _text_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts without nulls, and the place where each begins and the last ends."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int32)
    return np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]], (at - at[0]).astype(np.int64)


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.StringArray:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32, copy=False)), pa.py_buffer(data))


def _split(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The words between spaces and newlines, some of them empty, and the place of the last of each text."""
    data, offsets = _text_bytes(texts)
    gaps = (data == 32) | (data == 10)
    at = np.flatnonzero(gaps).astype(np.int32)
    before = np.searchsorted(at, offsets[1:])
    at -= np.arange(len(at), dtype=np.int32)
    stops = np.insert(at, np.append(0, before), np.append(0, offsets[1:] - before))
    np.logical_not(gaps, out=gaps)
    return _strings(data[gaps], stops), before + np.arange(len(before))


class WordEncoder:
    """Ids of whole texts, by way of their distinct words where the vocabulary allows it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.splits = drops_spaces(self.tokenizer)
        parts = json.loads(self.tokenizer.to_str())
        suffix = parts["model"].get("end_of_word_suffix")
        #: Ids that end a piece, where the vocabulary marks them.
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool) if suffix and self.splits else None
        #: Expressions for words of letters, and of those that the normalizer leaves as they are; what encodes the latter.
        self.letters = self.still = self.bare = None
        self.tails: dict[str, bool] = {}
        if self.ends is not None:
            for token, i in self.tokenizer.get_vocab().items():
                self.ends[i] = token.endswith(suffix)
            if {n["type"] for n in _steps(parts["normalizer"], "normalizers")} <= {"NFC", "Lowercase", "Replace"}:
                self._tell_letters(parts)
        #: Known words, where the ids of each begin, their number, and all ids.
        self.words = pa.array([""], pa.string())
        self.starts, self.sizes, self.ids = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<u4")

    def _cut(self, text: str) -> list[str]:
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _tell_letters(self, parts: dict) -> None:
        """Ask the normalizer and the pre-tokenizer which letters stay letters and join others."""
        from tokenizers import Tokenizer

        chars = [c for a, b in _LETTERS for c in map(chr, range(a, b)) if c.isalpha()]
        normal = self.tokenizer.normalizer.normalize_str(" ".join(chars)).split(" ") if self.tokenizer.normalizer else chars
        joins = len(self._cut(" ".join(f"a{n}a" for n in normal))) == len(chars)
        still = [c for c, n in zip(chars, normal, strict=True) if n == c and (joins or len(self._cut(f"a{c}a")) == 1)]
        if not still or any(n != c.lower() for c, n in zip(chars, normal, strict=True) if c.isascii()):
            return
        kept = set(still)
        self.letters, self.still = _made_of([c for c, n in zip(chars, normal, strict=True) if n in kept]), _made_of(still)
        # Words of still letters need no normalizer, and only the last step of the pre-tokenizer, which writes bytes as letters.
        last = _steps(parts["pre_tokenizer"], "pretokenizers")[-1]
        if last["type"] == "ByteLevel" and not last["use_regex"] and not last["add_prefix_space"]:
            spaces = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
            steps = {"type": "Sequence", "pretokenizers": [spaces, last]}
            self.bare = Tokenizer.from_str(json.dumps(parts | {"normalizer": None, "added_tokens": [], "pre_tokenizer": steps}))

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``texts``, one after the other, and the number of each."""
        each = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in each for i in x], dtype="<u4"), np.array([len(x) for x in each], dtype=np.int64)

    def _encode_joined(self, words: pa.StringArray, tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters: many in one text, cut where pieces end, if each word is one piece."""
        out = []
        for i in range(0, len(words), 2000):
            some = words.slice(i, 2000)
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), " ")[0].as_py()
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some) and stops[-1] == len(ids):
                out.append((ids, np.diff(stops, prepend=0)))
            else:  # each word ends a piece at least: some have more
                out.append(self._encode(some.to_pylist()))
        return np.concatenate([np.zeros(0, dtype="<u4"), *(x for x, _ in out)]), np.concatenate([np.zeros(0, dtype=np.int64), *(n for _, n in out)])

    def _encode_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The same for any words."""
        kind = np.zeros(len(words), dtype=np.int8)
        if self.ends is not None:
            kind[pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)] = 1
        if self.bare is not None:
            kind[pc.match_substring_regex(words, self.still).to_numpy(zero_copy_only=False)] = 2
        of = [words.filter(pa.array(kind == k)) for k in range(3)]
        coded = [self._encode(of[0].to_pylist()), self._encode_joined(of[1], self.tokenizer), self._encode_joined(of[2], self.bare)]
        ids, sizes = (np.concatenate(x) for x in zip(*coded, strict=True))
        place = np.argsort(np.argsort(kind, kind="stable"), kind="stable")
        return _pick(ids, np.cumsum(sizes) - sizes, sizes, place)

    def _know(self, words: pa.StringArray) -> np.ndarray:
        """The places of distinct ``words`` among the known, which they join."""
        found = pc.index_in(words, value_set=self.words)
        new = found.is_null().to_numpy(zero_copy_only=False)
        place = found.fill_null(0).to_numpy().astype(np.int64)
        if self.words.nbytes + self.ids.nbytes > CACHED_BYTES:  # those of late stay
            kept = place[~new]
            self.words = self.words.take(pa.array(kept))
            self.ids, self.sizes = _pick(self.ids, self.starts, self.sizes, kept)
            place[~new] = np.arange(len(kept))
        if new.any():
            fresh = words.filter(pa.array(new))
            ids, sizes = self._encode_words(fresh)
            place[new] = len(self.words) + np.arange(len(fresh))
            self.words = pa.concat_arrays([self.words, fresh])
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        self.starts = np.cumsum(self.sizes) - self.sizes
        return place

    def _may_follow(self, tail: str) -> bool:
        """Whether ``tail`` is cut from letters before it."""
        if tail not in self.tails:
            self.tails[tail] = len(tail) < 16 and all(self._cut(x + tail) == self._cut(x) + self._cut(tail) for x in "aéσ漢")
        return self.tails[tail]

    def _ids_of(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct ``words``, one after the other, and the number of each."""
        if self.letters is None:
            return _pick(self.ids, self.starts, self.sizes, self._know(words)) if len(words) else (self.ids[:0], self.sizes[:0])
        cores = pc.ascii_rtrim(words, characters=_TAILS)
        plain = pc.match_substring_regex(cores, self.letters).to_numpy(zero_copy_only=False)
        data, offsets = _text_bytes(words)
        size = np.diff(offsets) - np.diff(_text_bytes(cores)[1])
        size[~plain] = 0
        tails = _strings(_pick(data, offsets[1:] - size, size, np.arange(len(size)))[0], np.append(0, np.cumsum(size))).dictionary_encode()
        follows = np.array([self._may_follow(t) for t in tails.dictionary.to_pylist()], dtype=bool)
        which = tails.indices.to_numpy()
        plain &= follows[which]
        keys = pc.if_else(pa.array(plain), pc.ascii_lower(cores), words).dictionary_encode()
        ends, end_sizes = self._encode([t if f else "" for t, f in zip(tails.dictionary.to_pylist(), follows, strict=True)])
        core = self._know(keys.dictionary)[keys.indices.to_numpy()]
        ids, sizes = np.concatenate([self.ids, ends]), np.concatenate([self.sizes, end_sizes])
        both = np.stack([core, len(self.sizes) + which], axis=1).reshape(-1)
        got, n = _pick(ids, np.cumsum(sizes) - sizes, sizes, both)
        return got, n.reshape(-1, 2).sum(axis=1)

    def flat(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``texts``, each with ``end_id`` behind it, one after the other, and the number of each."""
        texts = texts.fill_null("")
        if not len(texts):
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        if not self.splits:
            ids, sizes = self._encode(texts.to_pylist())
            return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1
        words, last = _split(texts)
        coded = words.dictionary_encode()
        del words
        ids, sizes = self._ids_of(coded.dictionary)
        which = np.insert(coded.indices.to_numpy(), last + 1, len(sizes))
        del coded
        pa.default_memory_pool().release_unused()
        ids, sizes = np.append(ids, np.array(end_id, dtype="<u4")), np.append(sizes, 1)
        got, n = _pick(ids, np.cumsum(sizes) - sizes, sizes, which)
        return got, np.diff(np.cumsum(n)[last + 1 + np.arange(len(last))], prepend=0)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        ids, sizes = self.flat(pa.array(texts, pa.string()), 0)
        return [ids[e - n : e - 1] for e, n in zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The encoder of a vocabulary file, kept with its known words while the Python worker lives."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _open(folder: str):
    """File system and path of a folder given as URI or local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


def _writer(folder: str, vocabulary: str, end_id: int):
    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        encoder = encoder_of(vocabulary)
        system, path = _open(folder)
        name = f"part-{number:06d}.ids"
        n_docs = n_ids = held = 0
        documents: list[tuple[int | None, np.ndarray]] = []
        out = None
        partial = f"{path}/_{name}.{uuid.uuid4().hex}"
        for part in _pooled(parts):
            doc_ids, texts = (part.column(c).combine_chunks() for c in ("doc_id", "text"))
            ids, sizes = encoder.flat(texts.cast(pa.string()), end_id)
            for d, e, n in zip(doc_ids.to_pylist(), np.cumsum(sizes).tolist(), sizes.tolist(), strict=True):
                documents.append((d, ids[e - n : e]))
                held += n
                if held >= BLOCK * LANES:
                    out = out or _begin(system, partial)
                    out.write(group_bytes(documents))
                    n_docs, n_ids, held, documents = n_docs + len(documents), n_ids + held, 0, []
        if documents:
            out = out or _begin(system, partial)
            out.write(group_bytes(documents))
            n_docs, n_ids = n_docs + len(documents), n_ids + held
        if out is not None:
            out.write(b"END1" + struct.pack("<QQ", n_docs, n_ids))
            out.close()
            system.move(partial, f"{path}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "documents": [n_docs], "ids": [n_ids]})

    return write


def _pooled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of ``parts``, so many at a time that their texts have about ``POOL`` bytes."""
    pool, held = [], 0
    for part in parts:
        for i in range(0, part.num_rows, 256):
            pool.append(part.slice(i, 256))
            held += pc.sum(pc.binary_length(pool[-1].column("text"))).as_py() or 0
            if held >= POOL:
                table, pool, held = pa.Table.from_batches(pool), [], 0
                yield table
    if pool:
        yield pa.Table.from_batches(pool)


def _begin(system, path: str):
    out = system.open_output_stream(path)
    out.write(b"PRSMIDS2")
    return out


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, files: int | None = None) -> list[tuple[str, int, int]]:
    """Write the ids of ``docs`` (doc_id, text) into ``folder``; (file, documents, ids) of each file, in order.

    Files hold consecutive ranges of doc_id: part 0 the smallest.  One row per file comes back.
    """
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    files = files or max(1, -(-rows.count() // ROWS_PER_FILE))
    # Rows of one id, or of none, may be very many: their texts, and the place of equal rows, spread them.
    spread = rows.withColumn("t", F.xxhash64("text")).withColumn("p", F.monotonically_increasing_id())
    keys = [F.col("doc_id").asc_nulls_first(), "t", "p"]
    ordered = spread.repartitionByRange(files, *keys).sortWithinPartitions(*keys).drop("t", "p")
    done = ordered.mapInArrow(_writer(folder, vocabulary, end_id), "file string, documents long, ids long")
    return sorted((r["file"], r["documents"], r["ids"]) for r in done.collect())


def read_ids(spark: SparkSession, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """(doc_id, start, ids): documents of the files with the number of ids before each; ``ids`` are little-endian u32."""
    starts = np.cumsum([0, *(n for _, _, n in files)])[:-1]
    table = spark.createDataFrame([(f, int(s)) for (f, _, _), s in zip(files, starts, strict=True)], "file string, start long")

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _open(folder)
        for pdf in parts:
            for name, start in zip(pdf["file"], pdf["start"], strict=True):
                at = int(start)
                with system.open_input_stream(f"{path}/{name}") as stream:
                    for group in read_groups(stream, name):
                        sizes = np.array([len(x) for _, x in group], dtype=np.int64)
                        begin = at + np.cumsum(sizes) - sizes
                        at += int(sizes.sum())
                        yield pd.DataFrame({"doc_id": pd.array([d for d, _ in group], dtype="Int64"), "start": begin, "ids": [x.astype("<u4").tobytes() for _, x in group]})

    return table.repartition(max(1, len(files)), "file").mapInPandas(read, "doc_id long, start long, ids binary")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's ids, from the files."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    files = write_ids(docs, folder, vocabulary_path())
    found = read_ids(spark, folder, files)
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").cast("long").alias("ids_crc32"))
