"""Suffix arrays and common prefixes in numpy: refinement of unsorted groups, and common prefixes carried along a text.

All positions are those of one block of bytes of bounded size. The order is that of whole suffixes, since only then a
common prefix can be carried from one position to the next.
"""

from __future__ import annotations

import numpy as np

#: Bytes compared at a time.
WORD = 8


class Block:
    """A block of bytes that is read eight bytes at a time, with zeros behind its end."""

    def __init__(self, data: bytes, beyond: int):
        self.size = len(data)
        raw = np.frombuffer(data + bytes(beyond + 2 * WORD), np.uint8).astype(np.uint64)
        n = self.size + beyond + WORD
        words = np.zeros(n, np.uint64)
        for k in range(WORD):
            words = (words << np.uint64(8)) | raw[k : k + n]
        self.words = words


#: Bytes of the first sorting key; with the position it fits one 64-bit number.
FIRST = 5


def suffix_array(block: Block) -> np.ndarray:
    """Positions in the order of their suffixes. Groups that share their first h bytes are split by the group of the
    suffix h bytes further on, and only groups of more than one are looked at again; h doubles each time. A suffix that
    ends earlier comes first."""
    n = block.size
    bits = max(1, n.bit_length())
    if 3 * bits + 1 > 64:
        raise ValueError("a block of a suffix array has 2^21 bytes at most")
    bits_, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    key = np.sort((block.words[:n] >> np.uint64(8 * (WORD - FIRST)) << bits_) | np.arange(n, dtype=np.uint64))
    sa = (key & mask).astype(np.int64)
    key >>= bits_
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = head
    h = FIRST
    while h < 2 * n:
        open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(open_):
            break
        at, own = sa[open_], head[open_]
        ahead = at + h
        later = rank[np.minimum(ahead, n - 1)] + n
        ends = ahead >= n
        if ends.any():
            later[ends] = n - at[ends] - 1
        # Group, later group and position in one number: sorting it needs no indirection.
        key = (((own.astype(np.uint64) << np.uint64(bits + 1)) | later.astype(np.uint64)) << bits_) | at.astype(np.uint64)
        key.sort()
        at = (key & mask).astype(np.int64)
        key >>= bits_
        sa[open_] = at
        new[open_[1:]] |= key[1:] != key[:-1]
        own = np.maximum.accumulate(np.where(new[open_], open_, 0))
        head[open_] = own
        rank[at] = own
        h *= 2
    return sa


def common_prefixes(block: Block, order: np.ndarray, wanted: np.ndarray, starts: np.ndarray, lengths: np.ndarray, most: int) -> np.ndarray:
    """The bytes, up to ``most``, that each suffix of the order shares with the one before it.

    The order has the positions marked in ``wanted``: the first ``lengths`` of the texts that begin at ``starts``. One
    byte further on in a text the common prefix is shorter by one at most, so it is carried along, unless the other
    suffix has no next one in the order; the texts are walked side by side.
    """
    words = block.words
    place = np.empty(block.size, np.int64)
    place[order] = np.arange(len(order))
    before = np.full(block.size, -1, np.int64)
    before[order[1:]] = order[:-1]
    follows = np.append(wanted[1:], False)
    out = np.zeros(len(order), np.int64)
    by_length = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[by_length], lengths[by_length]
    alive = np.searchsorted(-lengths, -np.arange(1, int(lengths.max(initial=0)) + 1), "right")
    have, last = np.zeros(len(starts), np.int64), np.full(len(starts), -1, np.int64)
    for t, lanes in enumerate(alive.tolist()):
        i = starts[:lanes] + t
        j, h = before[i], np.maximum(have[:lanes] - 1, 0)
        h[(j < 0) | (last[:lanes] < 0) | ~follows[last[:lanes]]] = 0
        going = np.flatnonzero((j >= 0) & (h < most))
        while len(going):
            a, b = i[going] + h[going], j[going] + h[going]
            differ = words[a] ^ words[b]
            same = differ == 0
            rest = going[~same]
            h[rest] += 7 - np.searchsorted(_TOPS, differ[~same], "right")
            going = going[same]
            h[going] += WORD
            going = going[h[going] < most]
        have[:lanes] = np.minimum(h, most)
        last[:lanes] = j
        out[place[i]] = have[:lanes]
    return out


#: The least numbers of two bytes, three bytes, and so on.
_TOPS = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)


def search(block: Block, sa: np.ndarray, other: Block, at: np.ndarray, depth: int) -> np.ndarray:
    """For each string of ``depth`` bytes (a multiple of 8) at these places of another block, the place in the order of
    the first suffix of this block that is not less (the order's length if all are less)."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(sa), np.int64)
    while True:
        going = np.flatnonzero(low < high)
        if not len(going):
            return low
        middle = (low[going] + high[going]) // 2
        less = less_than(block, sa[middle], other, at[going], depth)
        low[going[less]] = middle[less] + 1
        high[going[~less]] = middle[~less]


def less_than(block: Block, a: np.ndarray, other: Block, b: np.ndarray, depth: int) -> np.ndarray:
    """Whether the strings of ``depth`` bytes at places a of one block come before those at places b of another."""
    out, going = np.zeros(len(a), bool), np.arange(len(a))
    for step in range(0, depth, WORD):
        x, y = block.words[a[going] + step], other.words[b[going] + step]
        out[going[x < y]] = True
        going = going[x == y]
        if not len(going):
            break
    return out


def equal(block: Block, a: np.ndarray, other: Block, b: np.ndarray, depth: int) -> np.ndarray:
    """Whether the strings of ``depth`` bytes at places a and b are the same."""
    out, going = np.zeros(len(a), bool), np.arange(len(a))
    for step in range(0, depth, WORD):
        going = going[block.words[a[going] + step] == other.words[b[going] + step]]
        if not len(going):
            return out
    out[going] = True
    return out
