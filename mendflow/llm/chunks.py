"""Distinct chunks of text whose results a Python worker keeps, for tokenizers that split there anyway.

A chunk begins at a single space or a single line feed between two characters that aren't white
space (of Unicode, not of ASCII alone), or where a text begins. A byte-level pre-tokenizer always
splits there, so does a model none of whose pieces has a space or line feed after its first
character; the chunks of a text are then worked on one by one, and any that begin with white space
and end with none may be joined to one text, in any order. Results of frequent chunks are kept, those of rare ones forgotten.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np

from mendflow.llm import words

#: Chunks whose results a worker keeps at least half of when it forgets the rarest.
CACHE_CHUNKS = 1 << 19

_BLANK = words.SEPARATOR.copy()
_BLANK[0x1C:0x20] = True
#: First bytes of the white space characters beyond ASCII.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def blank_bytes(buf: np.ndarray) -> np.ndarray:
    """Which bytes are part of a white space character."""
    blank = _BLANK[buf]
    lead = np.flatnonzero(_LEADS[buf])
    if len(lead):
        padded = np.concatenate([buf, np.zeros(2, np.uint8)])
        a, b, c = padded[lead], padded[lead + 1], padded[lead + 2]
        two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        three = (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        three |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        three |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
        for step, found in ((0, two | three), (1, two | three), (2, three)):
            blank[lead[found] + step] = True
    return blank


def chunks_of(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the chunks, and the first chunk of each text."""
    cut = np.zeros(len(buf) + 1, bool)
    if len(buf) > 2:
        blank = blank_bytes(buf)
        solid = np.zeros(len(buf), bool)  # inside one text, between two bytes that aren't blank
        solid[1:-1] = ~blank[:-2] & ~blank[2:]
        solid[at[at < len(buf)]] = False
        solid[at[at > 0] - 1] = False
        cut[:-1] |= solid & ((buf == 0x20) | (buf == 0x0A))
    cut[at[:-1][np.diff(at) > 0]] = True
    starts = np.flatnonzero(cut[:-1])
    ends = np.append(starts[1:], len(buf))
    return starts, ends - starts, np.searchsorted(starts, at)


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices ``begin`` to ``begin + size`` of each span, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class ChunkCache:
    """Results of the chunks seen lately.

    ``learn`` takes the bytes of new chunks and returns arrays with a value for each, and pairs
    (sizes, values) of those with several.
    """

    def __init__(self, learn: Callable[[Sequence[bytes]], Mapping], limit: int = CACHE_CHUNKS):
        self.learn, self.limit = learn, limit
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.hits = np.zeros(0, np.int64)
        self.one: dict[str, np.ndarray] = {}
        self.flat: dict[str, np.ndarray] = {}
        self.begin: dict[str, np.ndarray] = {}
        self.size: dict[str, np.ndarray] = {}

    def _store(self, found: Mapping) -> None:
        for name, value in found.items():
            if not isinstance(value, tuple):
                self.one[name] = np.concatenate([self.one[name], value]) if name in self.one else value
                continue
            size, flat = value
            begin = np.cumsum(size) - size
            if name in self.flat:
                begin = begin + len(self.flat[name])
                size, flat = np.concatenate([self.size[name], size]), np.concatenate([self.flat[name], flat])
                begin = np.concatenate([self.begin[name], begin])
            self.begin[name], self.size[name], self.flat[name] = begin, size, flat

    def _forget_rare(self) -> None:
        most = np.partition(self.hits, -(self.limit // 2))[-(self.limit // 2)]
        stay = self.hits > most
        at = np.flatnonzero(self.hits == most)[: self.limit // 2 - int(stay.sum())]
        stay[at] = True
        for name in self.one:
            self.one[name] = self.one[name][stay]
        for name in self.flat:
            size = self.size[name][stay]
            self.flat[name] = self.flat[name][spread(self.begin[name][stay], size)]
            self.size[name], self.begin[name] = size, np.cumsum(size) - size
        kept = stay[self.slots]
        self.keys, self.slots = self.keys[kept], (np.cumsum(stay) - 1)[self.slots[kept]]
        self.hits = self.hits[stay] // 2

    def places(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Where the results of each of these chunks are; new ones are learnt."""
        if len(self.hits) > self.limit:
            self._forget_rare()
        hashes = words.span_hashes(buf, starts, lengths)
        keys, one, which, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        where = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = where < len(self.keys)
        known[inside] = self.keys[where[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        slot = np.zeros(len(keys), np.int64)
        slot[known] = self.slots[where[known]]
        if len(new):
            data = buf.tobytes()
            spans = zip(starts[one[new]].tolist(), lengths[one[new]].tolist(), strict=True)
            self._store(self.learn([data[s : s + n] for s, n in spans]))
            slot[new] = len(self.hits) + np.arange(len(new))
            self.keys = np.insert(self.keys, where[new], keys[new])
            self.slots = np.insert(self.slots, where[new], slot[new])
            self.hits = np.concatenate([self.hits, np.zeros(len(new), np.int64)])
        self.hits[slot] += counts
        return slot[which]

    def values(self, name: str, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many values each of these chunks has, and all of them."""
        size = self.size[name][places]
        return size, self.flat[name][spread(self.begin[name][places], size)]


def groups_of(chunks: Sequence[bytes], most: int) -> list[tuple[int, int]]:
    """Runs of chunks of about ``most`` bytes together that may be joined.

    A chunk that ends in white space, or begins a text without any, is a run of its own.
    """
    ends = np.cumsum([len(c) for c in chunks])
    alone = np.array([c[0] not in (0x20, 0x0A) or _ends_blank(c) for c in chunks], bool)
    cut = np.diff((ends - 1) // most) > 0
    cuts = [0, *(np.flatnonzero(cut | alone[1:] | alone[:-1]) + 1).tolist(), len(chunks)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def _ends_blank(chunk: bytes) -> bool:
    last = chunk[-1]
    return last < 0x21 or last > 0x7E and chunk.decode()[-1].isspace()


def counts_by_chunk(chunks: Sequence[bytes], token_bytes: np.ndarray) -> np.ndarray:
    """How many tokens each chunk has, from the byte lengths of the tokens of all chunks joined."""
    ends = np.cumsum(token_bytes)
    last = np.searchsorted(ends, np.cumsum([len(c) for c in chunks]))
    return np.diff(last, prepend=-1)
