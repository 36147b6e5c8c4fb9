"""Weighted acyclic automata over word n-grams, as arrays.

An n-gram is a path of ``order`` labels: word numbers from 1 on in byte order of the words, and zeros after its last
word. Its weight stands on its last arc. States are built from sorted paths, the deepest level first; states of a level
with the same arcs and weights are one state.
"""

from __future__ import annotations

import struct
from bisect import bisect_left

import numpy as np
import zstandard

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _signature(label: np.ndarray, value: np.ndarray) -> np.ndarray:
    x = (label.astype(np.uint64) + np.uint64(1)) * _MIX[0] ^ (value.astype(np.uint64) + np.uint64(7)) * _MIX[1]
    x ^= x >> np.uint64(31)
    return x * _MIX[2]


class Automaton:
    """Levels from the root down; each has the arcs of its states: where a state's arcs begin, labels and values (the
    next level's state, on the last level the weight)."""

    def __init__(self, words: list[bytes], levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.words, self.levels = words, levels

    @classmethod
    def from_sorted(cls, words: list[bytes], paths: np.ndarray, weights: np.ndarray) -> Automaton:
        """From distinct paths (a row each) in ascending order."""
        levels, value = [], weights.astype(np.int64)
        for depth in range(paths.shape[1] - 1, -1, -1):
            new = np.ones(len(paths), bool)
            new[1:] = (paths[1:, :depth] != paths[:-1, :depth]).any(axis=1) if depth else False
            first, label = np.flatnonzero(new), paths[:, depth].astype(np.int64)
            size = np.diff(np.append(first, len(paths)))
            mark = np.add.reduceat(_signature(label, value), first) if len(first) else np.zeros(0, np.uint64)
            mark ^= size.astype(np.uint64)
            _, kept, state = np.unique(mark, return_index=True, return_inverse=True)
            # States of one signature are compared; one that differs after all stays a state of its own.
            step = np.arange(len(paths)) - np.repeat(first, size)
            twin = np.repeat(first[kept][state], size) + np.minimum(step, np.repeat(size[kept][state], size) - 1)
            odd = np.add.reduceat(((label[twin] != label) | (value[twin] != value)).astype(np.int64), first) > 0 if len(first) else np.zeros(0, bool)
            odd |= size != size[kept][state]
            if odd.any():
                state[odd] = len(kept) + np.arange(odd.sum())
                kept = np.append(kept, np.flatnonzero(odd))
            offsets = np.append(0, np.cumsum(size[kept]))
            arcs = np.repeat(first[kept] - offsets[:-1], size[kept]) + np.arange(offsets[-1])
            levels.append((offsets, label[arcs], value[arcs]))
            paths, value = paths[first], state.astype(np.int64)
        return cls(words, levels[::-1])

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """(paths, weights) in ascending order."""
        state, back = np.zeros(1 if len(self.levels[0][0]) > 1 else 0, np.int64), []
        for offsets, label, value in self.levels:
            size = offsets[state + 1] - offsets[state]
            owner = np.repeat(np.arange(len(state)), size)
            arcs = np.repeat(offsets[state] - (np.cumsum(size) - size), size) + np.arange(len(owner))
            back = [column[owner] for column in back] + [label[arcs]]
            state = value[arcs]
        return np.stack(back, axis=1), state

    def compose(self, paths: np.ndarray) -> np.ndarray:
        """The weights of these paths (rows of this automaton's labels); 0 where there is no such path."""
        state, alive = np.zeros(len(paths), np.int64), np.ones(len(paths), bool)
        if len(self.levels[0][0]) < 2:
            return state
        for depth, (offsets, label, value) in enumerate(self.levels):
            keys = (np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) << 32) | label
            want = (state << 32) | paths[:, depth]
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            alive &= keys[at] == want
            state = np.where(alive, value[at], 0)
        return state

    def pack(self) -> bytes:
        parts = [b" ".join(self.words)]
        for offsets, label, value in self.levels:
            parts += [_narrow(np.diff(offsets)), _narrow(label), _narrow(value)]
        sizes = struct.pack(f"<{len(parts) + 1}I", len(parts), *map(len, parts))
        return zstandard.compress(sizes + b"".join(parts), 1)

    @classmethod
    def unpack(cls, data: bytes) -> Automaton:
        raw = zstandard.decompress(data)
        (n,) = struct.unpack_from("<I", raw)
        at, parts = 4 * n + 4, []
        for size in struct.unpack_from(f"<{n}I", raw, 4):
            parts.append(raw[at : at + size])
            at += size
        arrays = [_wide(p) for p in parts[1:]]
        levels = [(np.append(0, np.cumsum(a)), b, c) for a, b, c in zip(*[iter(arrays)] * 3)]
        return cls(parts[0].split(b" ") if parts[0] else [], levels)


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold the largest, each byte place in a run of its own."""
    width = next(w for w in (1, 2, 4, 8) if int(x.max(initial=0)) < 1 << 8 * w or w == 8)
    return bytes([width]) + np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def _wide(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def sum_paths(paths: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths in ascending order with the sums of their weights."""
    if not len(paths):
        return paths, weights
    bits = int(paths.max()).bit_length()
    key = paths[:, 0].astype(np.uint64)
    if bits * paths.shape[1] <= 64:
        for column in paths.T[1:]:
            key = (key << np.uint64(bits)) | column.astype(np.uint64)
        order = np.argsort(key, kind="stable")
    else:
        order = np.lexsort(paths.T[::-1])
    paths, weights = paths[order], weights[order]
    new = np.ones(len(paths), bool)
    new[1:] = (paths[1:] != paths[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return paths[first], np.add.reduceat(weights, first)


def first_not_below(words: list[bytes], paths: np.ndarray, bound: list[bytes]) -> int:
    """The place of the first of the ascending paths that is not less than a phrase."""
    low, high = 0, len(paths)
    for depth in range(paths.shape[1]):
        column = paths[low:high, depth]
        if depth == len(bound):
            return low
        want = bisect_left(words, bound[depth]) + 1
        start = low + int(np.searchsorted(column, want))
        if want > len(words) or words[want - 1] != bound[depth]:
            return start
        low, high = start, low + int(np.searchsorted(column, want, "right"))
    return low
