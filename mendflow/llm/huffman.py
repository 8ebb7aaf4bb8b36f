"""Canonical length-limited Huffman codes over integer ids, vectorised over blocks.

Codes are at most ``LIMIT`` bits. Ids are coded most significant bit first into 32-bit big-endian
words. A checkpoint, the bit offset at which a block begins, lets each block of ``BLOCK`` ids be
decoded by itself: all blocks of a buffer advance together, one table lookup an id.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512
LIMIT = 20


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each id by package-merge: the shortest total with no code over ``limit`` bits.

    Ids that never occur get 0 bits and no code; a lone id gets 1 bit.
    """
    used = np.flatnonzero(counts)
    bits = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        bits[used] = 1
        return bits
    if n > 1 << limit:
        raise ValueError(f"{n} ids need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, kinds = leaves, []
    kinds.append(np.ones(n, bool))
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        level = both[at]
        kinds.append(at < n)
    take, lengths = 2 * n - 2, np.zeros(n, np.int64)
    for kind in reversed(kinds):
        own = int(kind[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    bits[order] = lengths
    return bits


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """Code of each id: ids ordered by length, then by value, count up."""
    codes = np.zeros(len(bits), np.uint64)
    code, last = 0, 0
    order = np.lexsort((np.arange(len(bits)), bits))
    lengths = bits[order]
    for length in range(1, int(bits.max(initial=0)) + 1):
        code <<= length - last
        last = length
        mine = order[np.searchsorted(lengths, length) : np.searchsorted(lengths, length, "right")]
        codes[mine] = code + np.arange(len(mine), dtype=np.uint64)
        code += len(mine)
    return codes


def encode(ids: np.ndarray, bits: np.ndarray, codes: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
    """The coded ids and the bit offset of each block."""
    length = bits[ids].astype(np.int64)
    end = np.cumsum(length)
    at = end - length
    if not len(ids):
        return b"", at
    word = at >> 5
    value = codes[ids] << (64 - (at & 31) - length).astype(np.uint64)
    out = np.zeros((int(end[-1]) >> 5) + 2, np.uint32)
    runs = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    both = np.bitwise_or.reduceat(value, runs)
    out[word[runs]] |= (both >> np.uint64(32)).astype(np.uint32)
    # A run's tail goes to the next word, which the next run may also begin.
    np.bitwise_or.at(out, word[runs] + 1, (both & np.uint64(0xFFFFFFFF)).astype(np.uint32))
    return out.astype(">u4").tobytes(), at[::block].copy()


def decoding_table(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for every prefix of the longest code's width."""
    width = int(bits.max(initial=1))
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    repeat = 1 << (width - bits[order].astype(np.int64))
    ids, lengths = np.repeat(order, repeat), np.repeat(bits[order], repeat)
    short = (1 << width) - len(ids)  # only a lone id leaves prefixes unused
    return np.pad(ids, (0, short)).astype(np.uint32), np.pad(lengths, (0, short), constant_values=1), width


def decode(data: bytes, checkpoints: np.ndarray, n: int, table: tuple, block: int = BLOCK) -> np.ndarray:
    """``n`` ids; the blocks are independent and advance together."""
    if n == 0:
        return np.zeros(0, np.uint32)
    ids, lengths, width = table
    words = np.concatenate([np.frombuffer(data, ">u4").astype(np.uint64), np.zeros(2, np.uint64)])
    at = checkpoints.astype(np.int64)
    last = len(words) - 2
    out = np.empty((block, len(at)), np.uint32)
    drop = np.uint64(64 - width)
    for i in range(min(block, n)):
        w = np.minimum(at >> 5, last)
        window = ((words[w] << np.uint64(32)) | words[w + 1]) << (at & 31).astype(np.uint64)
        prefix = window >> drop
        out[i] = ids[prefix]
        at += lengths[prefix]
    return out.T.reshape(-1)[:n] if n > block else out[:n, 0]
