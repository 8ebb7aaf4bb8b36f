"""Words of Arrow text columns as NumPy arrays, and the keys by which texts are joined.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. These bytes never occur inside a longer UTF-8 character, so the words are those
of the pattern ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Odd multipliers; any odd values do.
STEP = np.uint64(0x9E3779B97F4A7C15)
CHAIN = np.uint64(0xD6E8FEB86659FD93)
#: Steps of eight bytes that are taken for all spans together.
VECTOR_STEPS = 6
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def text_key(text: str | Column) -> list[Column]:
    """Two independent 64-bit hashes of a text (null: empty); together they stand for the text."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("second"), t).alias("k2")]


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values; another seed gives another one."""
    h = h + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and where each row begins, plus the end; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, text: str, most: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(batch)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def span_hashes(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: eight bytes a step for all spans, the rest of long ones by themselves."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), np.dtype("<u8"), padded, strides=(1,))
    h = lengths.astype(np.uint64) * STEP
    at, left, own = starts, lengths, None
    for _ in range(VECTOR_STEPS):
        if not len(at):
            return mixed(h)
        v = eight[at] & _KEEP[np.minimum(left, 8)]
        if own is None:
            h = (h ^ v) * STEP
            h ^= h >> np.uint64(32)
        else:
            x = (h[own] ^ v) * STEP
            h[own] = x ^ (x >> np.uint64(32))
        more = np.flatnonzero(left > 8)
        own = more if own is None else own[more]
        at, left = at[more] + 8, left[more] - 8
    if len(at):
        data = memoryview(buf)
        tails = [xxhash.xxh3_64_intdigest(data[a : a + n]) for a, n in zip(at.tolist(), left.tolist(), strict=True)]
        h[own] = mixed(h[own] ^ np.array(tails, np.uint64))
    return mixed(h)


@dataclass
class Words:
    """Words of several texts; those of text ``i`` are ``first[i]`` to ``first[i + 1]``."""

    buf: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.lengths)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(column: pa.Array, separator: np.ndarray = SEPARATOR) -> Words:
    buf, at = text_buffer(column)
    if not len(buf):
        none = np.zeros(0, np.int64)
        return Words(buf, none, none, np.zeros(len(at), np.int64))
    gap = separator[buf]
    begins, ends = ~gap, ~gap
    begins[1:] &= gap[:-1]
    ends[:-1] &= gap[1:]
    inner = at[(at > 0) & (at < len(buf))]
    begins[inner] = ~gap[inner]
    ends[inner - 1] = ~gap[inner - 1]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    return Words(buf, starts, lengths, np.searchsorted(starts, at))


def windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words inside one text, and the index of its first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size, power, acc, at = 1, CHAIN, h, None
    total, done, left = None, 0, k
    while left:
        if left & 1:
            part = acc[done : done + n]
            total = part.copy() if total is None else total * power + part
            done += size
        left >>= 1
        if left:
            acc = acc[:-size] * power + acc[size:]
            power, size = np.uint64(int(power) ** 2 % 2**64), size * 2
    room = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(n) + k <= room)
    return mixed(total[at]), at
