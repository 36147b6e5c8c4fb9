"""Removal of repeated passages: every byte that lies in a string of ``length`` bytes which starts anywhere else too.

Suffix arrays decide what is repeated. A corpus has far too many suffixes to meet each other, so the stretches of text
that can share a passage are brought together first. Of the ``length - gram + 1`` grams (runs of ``gram`` bytes) of a
string the one of the least hash, leftmost of equals, is its anchor: equal strings have equal anchors at the same place.
An anchor's stretch is what the strings with that anchor cover. Equal stretches are one stretch with a
multiplicity. What has a unique anchor is unique; where all stretches of an anchor are equal, all of it is repeated; the
others go to shards by their anchor.

Each shard is cut into pieces; a piece has a suffix array (Larsson-Sadakane refinement) and the common prefixes of
neighbours (Kasai's walk along the text). Strings of ``length`` common bytes that lie at the same distance from the
same anchor are repeated. Where the stretches of an anchor lie in several pieces, the strings of one are found in the
other's suffix array by binary search.

An anchor with more than ``most`` different stretches (the edge of a passage that very many documents share) isn't
gathered: each of its strings reaches half of the missing bytes to the left or to the right of the anchor, so every
stretch is halved into two, with the anchor grown to that side; halves that became equal are combined, and this is
repeated, at most until the anchor is the whole string and all stretches are equal.

Texts are UTF-8 bytes; matches never cross documents. NULL and empty texts, and those shorter than ``length``, lose
nothing. Repeated rows are different places, so texts of at least ``length`` bytes that occur twice vanish altogether.
Strings are judged on the input. What remains may begin or end inside a character, so it is binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import settle, slices
from .suffix_arrays import Block, common_prefixes, equal, search, suffix_array

LENGTH, GRAM = 400, 64

#: Different stretches of an anchor that one task may hold.
MOST = 4096

#: Bytes of stretches of a shard, and of a piece of it that has a suffix array of its own.
SHARD_BYTES, PIECE_BYTES = 4 << 20, (1 << 20) - (1 << 12)

#: Documents that are cut at a time, and bytes that are hashed side by side.
BATCH, HASHED = 64, 1 << 20

_SEEDED = np.random.default_rng(13)
_BYTES = _SEEDED.integers(0, 1 << 64, 256, np.uint64)
_LEFT, _RIGHT = (_SEEDED.integers(0, 1 << 64, 16, np.uint64) | np.uint64(1) for _ in range(2))
_PLACE = np.uint64(0xFFFFFFFF)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` (a power of two) bytes from each position on."""
    h, have, k = _BYTES[data], 1, 0
    while have < gram:
        h = h[:-have] * _LEFT[k] + h[have:] * _RIGHT[k] if len(h) > have else h[:0]
        h ^= h >> np.uint64(29)
        have, k = 2 * have, k + 1
    return h


def anchors(raws: list[bytes], length: int, gram: int, most: int = HASHED) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, anchor, hash, first, last) of the anchors of all strings of these texts, in ascending order: the strings
    with that anchor begin from ``first`` to ``last``. A text is worked in parts of ``most`` strings; the strings of an
    anchor may come in two rows where parts meet."""
    held, size = [], 0
    for t, raw in enumerate(raws):
        for start in range(0, len(raw) - length + 1, most):
            if size > most:
                yield from _anchors(held, length, gram)
                held, size = [], 0
            held.append((t, start, raw[start : start + most + length - 1]))
            size += len(held[-1][2])
    if held:
        yield from _anchors(held, length, gram)


def _anchors(parts: list[tuple[int, int, bytes]], length: int, gram: int) -> Iterator[tuple[int, int, int, int, int]]:
    texts, offsets, raws = zip(*parts)
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(raws), np.uint8)
    h = gram_hashes(data, gram)
    # Hash above, position below: the least of a window is its leftmost least hash.
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    have, window = 1, length - gram + 1
    while have < window and len(low):
        ahead = min(have, window - have)
        low = np.minimum(low[:-ahead], low[ahead:]) if len(low) > ahead else low[:0]
        have += ahead
    inside = np.zeros(len(low), bool)
    for start, end in zip((ends - sizes).tolist(), (ends - length + 1).tolist()):
        inside[start : max(start, end)] = True
    strings = np.flatnonzero(inside)
    at = (low[strings] & _PLACE).astype(np.int64)
    # Strings with the same anchor follow one another.
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    at, begin, end = at[first], strings[first], strings[last]
    owner = np.searchsorted(ends, at, "right")
    shift = np.array(offsets, np.int64)[owner] - (ends - sizes)[owner]
    return zip(np.array(texts)[owner].tolist(), (at + shift).tolist(), h[at].view(np.int64).tolist(), (begin + shift).tolist(), (end + shift).tolist())


def _text_key(raw: bytes) -> tuple[int, int]:
    both = xxhash.xxh3_128_intdigest(raw)
    return (both >> 64) - (1 << 63), (both & ((1 << 64) - 1)) - (1 << 63)


def _stretches(docs: DataFrame, text: str, length: int, gram: int) -> DataFrame:
    """(key, kind, t1, t2, at, left, n): the different stretches of each text; equal ones of a text are one row."""
    names = ["key", "kind", "t1", "t2", "at", "left", "n"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH):
            raws = [x for x in batch.column(0).to_pylist() if x and len(x) >= length]
            if not raws:
                continue
            found: dict[tuple[int, int, int], list] = {}
            for t, at, key, first, last in anchors(raws, length, gram):
                left, part = at - first, raws[t][first : last + length]
                kind = xxhash.xxh3_64_intdigest(part, left) - (1 << 63)
                row = found.get((t, key, kind))
                if row is None:
                    found[t, key, kind] = [[at], left, len(part)]
                else:
                    row[0].append(at)
            texts = [_text_key(x) for x in raws]
            rows = [(key, kind, *texts[t], *row) for (t, key, kind), row in found.items()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    rows = docs.select(F.col(text).cast("binary").alias("raw"))
    return rows.mapInArrow(run, "key long, kind long, t1 long, t2 long, at array<int>, left int, n int")


def _with_texts(docs: DataFrame, text: str) -> DataFrame:
    """(t1, t2, raw): texts with their hash; copies within a task are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches):
            rows = {}
            for raw in batch.column(0).to_pylist():
                if raw and (key := _text_key(raw)) not in seen:
                    seen.add(key)
                    rows[key] = raw
            if len(seen) > 1_000_000:
                seen.clear()
            if rows:
                t1, t2 = zip(*rows)
                yield pa.record_batch([pa.array(t1, pa.int64()), pa.array(t2, pa.int64()), pa.array(rows.values(), pa.binary())], ["t1", "t2", "raw"])

    return docs.select(F.col(text).cast("binary").alias("raw")).mapInArrow(run, "t1 long, t2 long, raw binary")


def _fetched(docs: DataFrame, text: str, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """Stretches (g, c, m, low, core_low, core_high, part) for wanted (key, kind, m, t1, t2, first, left, n), one row
    each. Places are relative to the anchor."""
    lists = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("key", "kind", "m", "first", "left", "n")).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH):
            rows = []
            for raw, wants in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in wants:
                    begin = w["first"] - w["left"]
                    rows.append((w["key"], w["kind"], w["m"], -w["left"], 0, gram, raw[begin : begin + w["n"]]))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _PART_TYPES)], _PART_NAMES)

    met = _with_texts(docs, text).join(lists, ["t1", "t2"]).select("raw", "w")
    return met.mapInArrow(run, _PART_SCHEMA).dropDuplicates(["g", "c"])


_PART_SCHEMA = "g long, c long, m long, low int, core_low int, core_high int, part binary"
_PART_NAMES = [x.split()[0] for x in _PART_SCHEMA.split(", ")]
_PART_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]


def _halved(hot: DataFrame, length: int) -> DataFrame:
    """(old_g, old_c and a stretch): both halves of every stretch, the anchor grown by half of the missing bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for g, c, m, low, core_low, core_high, part in zip(*(x.to_pylist() for x in batch.columns)):
                step = (length - (core_high - core_low) + 1) // 2
                for a, b in ((core_low - step, core_high), (core_low, core_high + step)):
                    first, last = max(low, b - length), min(low + len(part), a + length)
                    if first > a or last < b or last - first < length:
                        continue
                    own, core = part[first - low : last - low], part[a - low : b - low]
                    # The old group and the side are part of the new one: anchors of different places don't mix.
                    new_g = xxhash.xxh3_64_intdigest(core + g.to_bytes(8, "big", signed=True), (a - core_low) & 0xFFFF) - (1 << 63)
                    new_c = xxhash.xxh3_64_intdigest(own, (a - first) & 0xFFFF) - (1 << 63)
                    rows.append((g, c, new_g, new_c, m, first, a, b, own))
            if rows:
                types = [pa.int64(), pa.int64(), *_PART_TYPES]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["old_g", "old_c", *_PART_NAMES])

    return hot.mapInArrow(run, "old_g long, old_c long, " + _PART_SCHEMA)


class Piece:
    """Stretches (rows of a frame) with a suffix array; finds their repeated strings."""

    def __init__(self, rows: pd.DataFrame, length: int):
        self.length = length
        parts = rows["part"].tolist()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = np.cumsum(sizes) - sizes
        self.block = Block(b"".join(parts), length)
        n = self.block.size
        owner = np.repeat(np.arange(len(parts)), sizes)
        within = np.arange(n) - self.starts[owner]
        self.whole = within + length <= sizes[owner]
        # A string's group and its distance from the anchor: only equal ones of different stretches are compared.
        group = rows["group"].to_numpy(np.int64)
        self.slot = group[owner] * (4 * length) + within + rows["low"].to_numpy(np.int64)[owner] + 2 * length
        self.repeated = self.whole & (rows["m"].to_numpy(np.int64) > 1)[owner]
        sa = suffix_array(self.block)
        # The order of the strings alone; neighbours with a whole string in common are a run of equal ones.
        self.sa = at = sa[self.whole[sa]]
        prefixes = common_prefixes(self.block, at, self.whole, self.starts, np.maximum(sizes - length + 1, 0), length)
        self.run = np.cumsum(prefixes < length)
        self.sizes = sizes
        key = np.stack([self.run, self.slot[at]])
        order = np.lexsort(key[::-1])
        self.keys, self.at = key[:, order], at[order]
        new = np.ones(len(order), bool)
        new[1:] = (self.keys[:, 1:] != self.keys[:, :-1]).any(axis=0)
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(order)))
        self.repeated[self.at[np.repeat(many > 1, many)]] = True

    def meet(self, other: Piece, groups: np.ndarray) -> None:
        """Marks what this and another piece share within these groups."""
        span = 4 * self.length
        asked = np.flatnonzero(other.whole & np.isin(other.slot // span, groups))
        mine = np.flatnonzero(np.isin(self.keys[1] // span, groups))
        if not len(asked) or not len(mine):
            return
        place = search(self.block, self.sa, other.block, asked, self.length)
        ok = place < len(self.sa)
        asked, place = asked[ok], place[ok]
        ok = equal(self.block, self.sa[place], other.block, asked, self.length)
        asked, place = asked[ok], place[ok]
        ours = {}
        for run, slot, at in zip(self.keys[0, mine].tolist(), self.keys[1, mine].tolist(), self.at[mine].tolist()):
            ours.setdefault((run, slot), []).append(at)
        for run, at in zip(self.run[place].tolist(), asked.tolist()):
            if (got := ours.get((run, int(other.slot[at])))) is not None:
                other.repeated[at] = True
                self.repeated[got] = True

    def spans(self) -> list[tuple[list[int], list[int]]]:
        """Per stretch the covered bytes, as begins and ends relative to the stretch."""
        out = []
        for start, size in zip(self.starts.tolist(), self.sizes.tolist()):
            out.append(covered(np.flatnonzero(self.repeated[start : start + size]), self.length))
        return out


def covered(begins: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """The union of strings of ``length`` from these ascending places on: begins and ends of its runs."""
    if not len(begins):
        return [], []
    gap = np.flatnonzero(np.diff(begins) > length)
    return begins[np.append(0, gap + 1)].tolist(), (begins[np.append(gap, len(begins) - 1)] + length).tolist()


def _decide(rows: pd.DataFrame, length: int, piece_bytes: int) -> pd.DataFrame:
    """(g, c, begins, ends) of a shard's stretches with repeated strings, relative to their anchors."""
    rows = rows.sort_values(["g", "c"], ignore_index=True)
    rows["group"] = (rows["g"] != rows["g"].shift()).cumsum()
    number = (np.cumsum(rows["part"].map(len).to_numpy(np.int64)) - 1) // piece_bytes
    parts = [part for _, part in rows.groupby(number)]
    pieces = [Piece(part, length) for part in parts]
    for k, part in enumerate(parts):
        for j in range(k + 1, len(parts)):
            shared = np.intersect1d(part["group"].unique(), parts[j]["group"].unique())
            if not len(shared):
                break
            pieces[k].meet(pieces[j], shared)
    out = []
    for part, piece in zip(parts, pieces):
        for g, c, low, (begins, ends) in zip(part["g"], part["c"], part["low"], piece.spans()):
            if begins:
                out.append((g, c, [b + low for b in begins], [e + low for e in ends]))
    return pd.DataFrame(out, columns=["g", "c", "begins", "ends"])


_SPANS = "g long, c long, begins array<int>, ends array<int>"


def _solve(parts: DataFrame, length: int, most: int, piece_bytes: int) -> DataFrame:
    """(g, c, begins, ends) of settled, distinct stretches; several rows of one stretch add up."""
    kinds = parts.groupBy("g").agg(F.count("*").alias("kinds"), F.sum("m").alias("m"), F.sum(F.length("part")).alias("bytes"))
    hot = kinds.where(F.col("kinds") > most).select("g")
    total = kinds.agg(F.max("kinds").alias("kinds"), F.sum("bytes").alias("bytes")).first()
    if total["bytes"] is None:
        return parts.sparkSession.createDataFrame([], _SPANS)
    is_hot = total["kinds"] > most
    cold = parts.join(hot, "g", "left_anti") if is_hot else parts
    shards = max(1, -(-total["bytes"] // SHARD_BYTES))

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        return _decide(rows, length, piece_bytes)

    found = cold.groupBy(F.pmod(F.xxhash64("g"), F.lit(shards)).alias("shard")).applyInPandas(decide, _SPANS)
    if not is_hot:
        return found
    halves = settle(_halved(parts.join(hot, "g", "left_semi").select(*_PART_NAMES), length), "halves")
    whole = F.min(F.struct("low", "core_low", "core_high", "part")).alias("s")
    next_ = settle(halves.groupBy("g", "c").agg(F.sum("m").alias("m"), whole).select("g", "c", "m", "s.*"), "halved")
    # A half that nothing else shares is done with.
    shared = next_.groupBy("g").agg(F.sum("m").alias("m")).where("m > 1").select("g")
    next_ = settle(next_.join(shared, "g", "left_semi").select(*_PART_NAMES), "shared")
    below = _solve(next_, length, most, piece_bytes)
    up = below.join(halves.select("old_g", "old_c", "g", "c"), ["g", "c"])
    return found.unionByName(up.select(F.col("old_g").alias("g"), F.col("old_c").alias("c"), "begins", "ends"))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(t1, t2, begins, ends): rows of repeated spans of each text, known by its 128-bit hash; overlaps are left in."""
    if length % 8 or gram & (gram - 1) or not 0 < gram <= length:
        raise ValueError("length must be a multiple of 8, gram a power of two not above it")
    table = settle(_stretches(docs, text, length, gram), "stretches")
    # A key's stretches are all equal where the least and the greatest kind are.
    keys = table.groupBy("key").agg(F.sum(F.size("at")).alias("total"), F.min("kind").alias("a"), F.max("kind").alias("b"))
    # Settled, so that the join below has plain shuffles on both sides and a hot key can be split.
    keys = settle(keys.where("total > 1").select("key", (F.col("a") != F.col("b")).alias("mixed")), "keys")
    hits = settle(table.join(keys, "key"), "anchored")
    mixed = hits.where("mixed").groupBy("key", "kind").agg(
        F.sum(F.size("at")).alias("m"), F.min(F.struct("t1", "t2", F.get("at", F.lit(0)).alias("first"), "left", "n")).alias("r")
    )
    parts = settle(_fetched(docs, text, mixed.select("key", "kind", "m", "r.*"), length, gram), "parts")
    found = settle(_solve(parts, length, most, piece_bytes), "repeated")

    same = hits.where("not mixed").select("t1", "t2", "at", F.array(-F.col("left")).alias("begins"), F.array(F.col("n") - F.col("left")).alias("ends"))
    differ = hits.where("mixed").join(found.select(F.col("g").alias("key"), F.col("c").alias("kind"), "begins", "ends"), ["key", "kind"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = []
            for at, begins, ends in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                at = np.array(at)[:, None]
                lists.append(merged((at + np.array(begins)).ravel(), (at + np.array(ends)).ravel()))
            spans = [pa.array([x[k] for x in lists], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.record_batch([batch.column(0), batch.column(1), *spans], ["t1", "t2", "begins", "ends"])

    both = same.unionByName(differ.select("t1", "t2", "at", "begins", "ends"))
    return both.mapInArrow(spread, "t1 long, t2 long, begins array<int>, ends array<int>")


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """The union of spans: begins and ends of its runs, ascending; spans that touch are one."""
    if not len(begins):
        return [], []
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    cut = np.flatnonzero(begins[1:] > ends[:-1])
    return begins[np.append(0, cut + 1)].tolist(), ends[np.append(cut, len(ends) - 1)].tolist()


def remove_repeats(
    docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """All rows and columns of ``docs``, the text replaced by what is kept of it: ``kept`` (binary, NULL for a NULL text),
    ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` (of no bytes for a NULL text).

    Columns of ``docs`` with these names are replaced.
    """
    spans = repeated_spans(docs, text, length, gram, most, piece_bytes).distinct()
    spans = settle(spans.groupBy("t1", "t2").agg(F.collect_list(F.struct("begins", "ends")).alias("spans")), "spans")
    own = ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rest = [c for c in docs.columns if c != text and c not in own]
    rows = docs.select(F.struct(*rest, F.lit(0).alias("_")).alias("row"), F.col(text).cast("binary").alias("raw"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_text_key(x or b"") for x in batch.column(1).to_pylist()]
            t1, t2 = (pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, t1, t2], names=["row", "raw", "t1", "t2"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, n_bytes, removed, n_spans, sums = [], [], [], [], []
            for raw, lists in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                value, begins, ends = raw or b"", [], []
                for x in lists or ():
                    begins += x["begins"]
                    ends += x["ends"]
                begins, ends = merged(np.array(begins, np.int64), np.array(ends, np.int64))
                left = b"".join(value[a:b] for a, b in zip([0, *ends], [*begins, len(value)]))
                kept.append(None if raw is None else left)
                n_bytes.append(len(value))
                removed.append(len(value) - len(left))
                n_spans.append(len(begins))
                sums.append(hashlib.sha256(left).hexdigest())
            values = [pa.array(v, t) for v, t in zip((kept, n_bytes, removed, n_spans, sums), (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *values], names=["row", *own])

    fields = rows.schema.fields
    keyed = rows.mapInArrow(hashed, StructType([*fields]).add("t1", "long").add("t2", "long"))
    met = keyed.join(spans, ["t1", "t2"], "left").select("row", "raw", "spans")
    schema = StructType(fields[:1])
    for name, kind in zip(own, ("binary", "long", "long", "long", "string")):
        schema = schema.add(name, kind)
    return met.mapInArrow(cut, schema).select(*[F.col("row")[c].alias(c) for c in rest], *own)
