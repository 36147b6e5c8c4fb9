"""Benchmark decontamination with an FM-index per shard of documents.

Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. A benchmark item gives
its windows of consecutive words (one shorter window if it has fewer). Each task lays the words of its documents out
as one sequence and indexes it: suffix order, Burrows-Wheeler transform, wavelet tree for ranks, every 16th suffix
position. All windows are searched backwards at once; their occurrences are located from the sampled positions, and
the covered words of a document are merged into spans.

Words that no benchmark item has can be in no occurrence. They, and runs of benchmark words shorter than the shortest
window, are left out of the sequence; a separator stands for them. This loses nothing and keeps the index small.

Items are searched in blocks of a bounded number of words, so the table that tasks receive stays small however many
items there are. NULL and empty texts have no words and no hits, NULL and empty items no windows; repeated rows and
items each count; items with equal text are all reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_TABLE, ascii_lower_words, slices

#: Every so many positions of the sequence have their suffix row kept.
SAMPLE = 16
#: Words of a shard's sequence that one index holds.
SHARD_WORDS = 1 << 20


class WaveletTree:
    """Ranks of symbols in a sequence, bit by bit from the highest (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for b in reversed(range(bits)):
            bit = (symbols >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        low, high = np.zeros_like(end), end.copy()
        for level, b in enumerate(reversed(range(self.bits))):
            ones = self.ones[level]
            up = ((symbol >> b) & 1).astype(bool)
            low = np.where(up, self.zeros[level] + ones[low], low - ones[low])
            high = np.where(up, self.zeros[level] + ones[high], high - ones[high])
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the given places."""
        out = np.zeros_like(at)
        for level in range(self.bits):
            ones = self.ones[level]
            up = ones[at + 1] > ones[at]
            at = np.where(up, self.zeros[level] + ones[at], at - ones[at])
            out = (out << 1) | up
        return out


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length until all ranks differ. The last symbol must be unique."""
    n = len(sequence)
    order = np.argsort(sequence, kind="stable")
    rank = np.empty(n, np.int64)
    now = sequence[order]
    rank[order] = np.concatenate([[0], np.cumsum(now[1:] != now[:-1])])
    step = 1
    while n and rank[order[-1]] < n - 1:
        key = rank * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        now = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(now[1:] != now[:-1])])
        step *= 2
    return order


class FmIndex:
    """Backward search over a sequence of symbols from 1 on; 0 ends it."""

    def __init__(self, sequence: np.ndarray):
        text = np.concatenate([sequence, [0]]).astype(np.int64)
        order = suffix_order(text)
        bwt = text[order - 1]
        top = int(text.max()) + 1
        self.n = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top))]).astype(np.int64)
        self.tree = WaveletTree(bwt, max(1, int(top - 1).bit_length()))
        self.kept = order % SAMPLE == 0
        self.kept_rank = np.concatenate([[0], np.cumsum(self.kept)])
        self.samples = order[self.kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix rows [low, high) that begin with each pattern; patterns are right-aligned rows."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for j in range(patterns.shape[1]):
            symbol = patterns[:, patterns.shape[1] - 1 - j]
            use = (j < lengths) & (low < high)
            known = use & (symbol < len(self.before) - 1) & (symbol > 0)
            low[use & ~known] = high[use & ~known] = 0
            if known.any():
                s = symbol[known]
                low[known] = self.before[s] + self.tree.rank(s, low[known])
                high[known] = self.before[s] + self.tree.rank(s, high[known])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffix rows in the sequence, by steps back to sampled ones."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        left = np.flatnonzero(~self.kept[rows])
        while len(left):
            symbol = self.tree.access(rows[left])
            rows[left] = self.before[symbol] + self.tree.rank(symbol, rows[left])
            steps[left] += 1
            left = left[~self.kept[rows[left]]]
        return self.samples[self.kept_rank[rows]] + steps


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching [start, end) spans as one."""
    out: list[list[int]] = []
    for start, end in sorted(zip(starts.tolist(), ends.tolist())):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


class Phrases:
    """The windows of a block of benchmark items as symbol rows."""

    def __init__(self, items: list[tuple[object, bytes | None]], window: int):
        self.ids: list[str] = []
        found: dict[tuple[bytes, ...], list[int]] = {}
        for name, raw in items:
            words = ascii_lower_words(raw, ALNUM_TABLE)
            number = len(self.ids)
            self.ids.append(str(name))
            for i in range(max(1, len(words) - window + 1)) if words else ():
                owners = found.setdefault(tuple(words[i : i + window]), [])
                if not owners or owners[-1] != number:
                    owners.append(number)
        # The separator is 1, so the symbols of words begin with 2.
        self.symbols = {w: i + 2 for i, w in enumerate(sorted({w for p in found for w in p}))}
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.shortest = int(self.lengths.min()) if found else 0
        self.rows = np.zeros((len(found), window), np.int64)
        for k, p in enumerate(found):
            self.rows[k, window - len(p) :] = [self.symbols[w] for w in p]
        self.owners = list(found.values())


def find_phrases(texts: list[bytes | None], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
    """(number of words, merged spans of hit words, items) of each text of one shard."""
    parts, docs, firsts, counts, size = [], [], [], [], 0
    for d, raw in enumerate(texts):
        words = ascii_lower_words(raw, ALNUM_TABLE)
        counts.append(len(words))
        if not phrases.shortest or len(words) < phrases.shortest:
            continue
        ids = np.fromiter(map(phrases.symbols.get, words, _ones()), np.int64, len(words))
        gaps = np.concatenate([[-1], np.flatnonzero(ids == 1), [len(ids)]])
        long = np.flatnonzero(np.diff(gaps) > phrases.shortest)
        for start, end in zip((gaps[long] + 1).tolist(), gaps[long + 1].tolist()):
            parts += [ids[start:end], _SEPARATOR]
            docs.append(d)
            firsts.append((size, start))
            size += end - start + 1
    spans: dict[int, tuple[list, list, set]] = {}
    if parts:
        index = FmIndex(np.concatenate(parts))
        low, high = index.search(phrases.rows, phrases.lengths)
        hit = np.flatnonzero(high > low)
        if len(hit):
            many = (high - low)[hit]
            rows = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            pattern = np.repeat(hit, many)
            places = index.locate(rows)
            base = np.array(firsts, np.int64)
            run = np.searchsorted(base[:, 0], places, "right") - 1
            start = places - base[run, 0] + base[run, 1]
            end = start + phrases.lengths[pattern]
            for k, s, e, p in zip(run.tolist(), start.tolist(), end.tolist(), pattern.tolist()):
                got = spans.setdefault(docs[k], ([], [], set()))
                got[0].append(s)
                got[1].append(e)
                got[2].update(phrases.owners[p])
    out = []
    for d, n in enumerate(counts):
        starts, ends, items = spans.get(d, ((), (), set()))
        out.append((n, merge_spans(np.array(starts, np.int64), np.array(ends, np.int64)), items))
    return out


_SEPARATOR = np.array([1], np.int64)
_WORD = re.compile(rb"[^ ]+")


def _ones() -> Iterator[int]:
    while True:
        yield 1


def cut_spans(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans of words: from the first byte of a span's first word to the end of its last word."""
    places = [m.span() for m in _WORD.finditer(raw.translate(ALNUM_TABLE))]
    out, at = [], 0
    for start, end in spans:
        out.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, raw[at:]])


def decontaminate(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 10, block_bytes: int = 2_000_000, clean: bool = True,
) -> DataFrame:
    """All rows and columns of ``docs`` with n_words, spans (merged [start, end) spans of hit words), items (ids of the
    items that occur, as sorted strings) and clean (the text without the spans); with ``clean=False`` the text and its
    clean form are left out. Columns of ``docs`` that have one of these names are replaced. Items are searched in
    blocks of about ``block_bytes``; items with a NULL id are no items."""
    named = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).cast("binary").alias("raw"))
    named = named.where("name is not null")
    size = named.select(F.sum(F.length("raw")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_bytes))
    named = named.withColumn("block", F.pmod(F.xxhash64("name", "raw"), F.lit(blocks)))
    result = docs.drop("n_words", "spans", "items", "clean")
    found = None
    for block in range(blocks):
        rows = named.where(F.col("block") == block).select("name", "raw").collect()
        phrases = Phrases([(r["name"], None if r["raw"] is None else bytes(r["raw"])) for r in rows], window)
        source = result if found is None else found
        found = _search(source, phrases, text, first=found is None, last=block == blocks - 1, clean=clean)
    found = found.withColumn("items", F.array_sort(F.array_distinct("items")))
    return found.withColumn("clean", F.col("clean").cast("string")) if clean else found.drop("clean")


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_HITS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(_SPAN)),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("clean", T.BinaryType()),
]


def _search(docs: DataFrame, phrases: Phrases, text: str, first: bool, last: bool, clean: bool) -> DataFrame:
    """Adds one block's hits to those of the blocks before."""
    sent = docs.sparkSession.sparkContext.broadcast(phrases)
    keep = [c for c in docs.columns if c not in ("n_words", "spans", "items", "clean") and (clean or not last or c != text)]
    raw = F.col(text).cast("binary").alias("__raw")
    shape = T.StructType([*docs.select(*keep).schema.fields, *_HITS])
    hits = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def shard(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = sent.value
        texts = [t for b in batches for t in b.column(b.num_columns - 1).to_pylist()]
        found = iter(zip(texts, find_phrases(texts, phrases)))
        for b in batches:
            old_spans = [None] * b.num_rows if first else b.column("spans").to_pylist()
            old_items = [None] * b.num_rows if first else b.column("items").to_pylist()
            n, spans, names, cut = [], [], [], []
            for before, known, (value, (count, new, items)) in zip(old_spans, old_items, found):
                merged = new
                if before:
                    both = [*new, *((s["start"], s["end"]) for s in before)]
                    merged = merge_spans(np.array([s for s, _ in both], np.int64), np.array([e for _, e in both], np.int64))
                n.append(count)
                spans.append([{"start": s, "end": e} for s, e in merged])
                names.append([*(known or ()), *(phrases.ids[i] for i in items)])
                cut.append((cut_spans(value, merged) if merged else value) if clean and last else None)
            columns = [b.column(c) for c in keep] + [pa.array(n, pa.int64()), pa.array(spans, hits), pa.array(names, pa.list_(pa.string())), pa.array(cut, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "spans", "items", "clean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            held.append(batch)
            size += batch.nbytes
            if size > 8 * SHARD_WORDS:
                yield from shard(held)
                held, size = [], 0
        if held:
            yield from shard(held)

    return docs.withColumn("__raw", raw).mapInArrow(run, shape)


def contamination(docs: DataFrame, items: DataFrame, id: str = "doc_id", window: int = 10) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    found = decontaminate(docs.select(id, "text"), items, id=id, window=window, clean=False)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        F.col(id),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )

