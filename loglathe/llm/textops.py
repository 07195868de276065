"""Words, lines and their hashes for a whole Arrow column at once, in numpy.

A word is ``[^\\x20\\x09-\\x0D]+``.  Its hash is a polynomial over random values of its bytes, made from one running sum per
chunk, so no Python object is built per word.  Equal byte sequences have equal 64-bit hashes on every machine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 21
LONG_WORD = 1 << 16

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTES_LOWER = _BYTES[_LOWER]


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def fold(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each run ``values[start:end]``; runs may have any length, order counts."""
    up, down = _POWERS.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Texts:
    """The bytes of a column of texts, one behind the other; null texts are empty."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than texts

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    starts: np.ndarray  # byte positions
    ends: np.ndarray
    first: np.ndarray  # per text: number of its first word, and the end of the last text
    hashes: np.ndarray

    def of(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])


def texts_of(column: pa.Array) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else as it is."""
    return _LOWER[data]


def word_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of all words; a word never reaches into the next text."""
    inside = ~_SPACE[texts.data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = texts.offsets[:-1]
    edges = edges[edges < len(inside)]
    begin[edges] = inside[edges]
    edges = edges[edges > 0] - 1
    end[edges] = inside[edges]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """Hashes of byte spans in ascending order, chunk by chunk; very long spans are hashed one by one."""
    out = np.zeros(len(starts), np.uint64)
    table = _BYTES_LOWER if lower else _BYTES
    long = np.flatnonzero(ends - starts > LONG_WORD)
    at, short_ends = 0, ends.copy()
    short_ends[long] = starts[long]
    while at < len(starts):
        base = starts[at]
        to = int(np.searchsorted(starts, base + CHUNK, "left"))
        stop = int(short_ends[at:to].max())
        if stop > base:
            size = int(stop - base)
            up, down = _POWERS.get(size + 1)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(table[data[base:stop]] * up[:size], out=sums[1:])
            s = np.minimum(starts[at:to] - base, size)
            e = np.minimum(short_ends[at:to] - base, size)
            out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    out = mix(out + (ends - starts).astype(np.uint64))
    for i in long:
        piece = data[starts[i] : ends[i]]
        digest = hashlib.blake2b((_LOWER[piece] if lower else piece).tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, np.uint64)[0]
    return out


def words_of(texts: Texts, lower: bool = True) -> Words:
    starts, ends = word_spans(texts)
    first = np.searchsorted(starts, texts.offsets, "left")
    return Words(starts, ends, first, span_hashes(texts.data, starts, ends, lower))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _U(0xD6E8FEB86659FD93)
        out += hashes[k : k + n]
    return mix(out)


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its word windows; of fewer words the whole as one; of no words none."""
    windows = window_hashes(words.hashes, size)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        n = b - a
        if n >= size:
            yield np.unique(windows[a : b - size + 1])
        elif n:
            yield fold(words.hashes[a:b], np.array([0]), np.array([n]))
        else:
            yield np.zeros(0, np.uint64)


def line_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines between newlines, and per text the number of its first line."""
    newline = np.flatnonzero(texts.data == 10)
    owner = np.searchsorted(texts.offsets, newline, "right") - 1
    text_no = np.concatenate([np.arange(len(texts)), owner])
    starts = np.concatenate([texts.offsets[:-1], newline + 1])
    order = np.argsort(text_no * np.int64(1 << 40) + starts - texts.offsets[text_no], kind="stable")
    starts, text_no = starts[order], text_no[order]
    first = np.searchsorted(text_no, np.arange(len(texts) + 1), "left")
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = first[1:] - 1
    ends[last] = texts.offsets[1:]
    return starts, ends, first


def fingerprint(sorted_hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set of hashes."""
    with np.errstate(over="ignore"):
        one = np.sum(mix(sorted_hashes + _U(0x632BE59BD9B4E019)), dtype=np.uint64)
        two = np.sum(mix(sorted_hashes * _U(3) + _U(len(sorted_hashes))), dtype=np.uint64)
    return int(np.int64(one)), int(np.int64(two))
