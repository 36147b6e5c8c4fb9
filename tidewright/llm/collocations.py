"""Collocations of words, counted by weighted acyclic automata.

Texts are cut into pieces at punctuation and line ends, pieces into words. Each place of a word starts a path of up to
four words; the n-grams that begin there are the path's prefixes, so one automaton of paths counts all of them. A task
collects paths until its vocabulary or their number reaches a bound, sorts them, and builds the automata of that shard
from the sorted paths, one per language and prefix range. A range is a stretch of all paths in order; its bounds come
from a thinned sample of paths and only balance the work, so a frequent first word is cut wherever it is needed. Per
range the shards' automata are united and their weights summed word by word of the prefix; a prefix is followed only
if it is frequent, or if it is a prefix of one of the range's bounds, whose count the neighbour has a share of.

The frequent phrases' parts are looked up by composition: each range's phrases meet an automaton of the parts they
need, sent there once each, however many phrases share a part.

Words are runs without space and tab, A-Z lower-cased; pieces end at any of ``.,;:!?`` and line ends. NULL texts are
empty, NULL languages ``und``. Repeated rows count as often as they stand. Languages without a frequent phrase, and empty
tables, give no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .automata import Automaton, first_not_below, sum_paths
from .common import settle, slices

ORDER = 4
STOP = b"."
#: A-Z become a-z, tabs spaces, and everything that ends a piece a full stop.
PIECES = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 46 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))

#: A shard of a language ends at so many different words (path keys of four words then fit 64 bits) or paths.
SHARD_VOCABULARY, SHARD_PATHS = 60_000, 2_000_000

#: Paths of a range, and sampled paths that stand for them.
RANGE_PATHS, RANGE_SAMPLES = 1_000_000, 32

SCALE = 2_000_000


class _Numbers(dict):
    """Numbers of words in order of their first appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Shard:
    """The words of one language of a part of the texts."""

    def __init__(self):
        self.numbers, self.texts, self.size = _Numbers({STOP: 0}), [], 0

    def add(self, raw: bytes) -> None:
        words = raw.translate(PIECES).replace(STOP, b" . ").split(b" ")
        found = np.fromiter(map(self.numbers.__getitem__, filter(None, words)), np.int32)
        self.texts.append(found)
        self.size += len(found)

    def paths(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(words in byte order, distinct paths in order, their weights)."""
        words = sorted(self.numbers.keys() - {STOP})
        rank = np.zeros(len(self.numbers), np.int64)
        rank[[self.numbers[w] for w in words]] = np.arange(1, len(words) + 1)
        gap = np.zeros(ORDER, np.int32)
        numbers = np.concatenate([x for t in self.texts for x in (t, gap)] or [gap])
        flow = rank[numbers]
        steps = [flow[: len(flow) - ORDER + 1]]
        for k in range(1, ORDER):
            steps.append(np.where(steps[-1] > 0, flow[k : len(flow) - ORDER + 1 + k], 0))
        real = steps[0] > 0
        paths = np.stack([s[real] for s in steps], axis=1)
        return words, *sum_paths(paths, np.ones(len(paths), np.int64))


def _section(words: list[bytes], paths: np.ndarray, weights: np.ndarray) -> bytes:
    """The packed automaton of some of a shard's paths, with the words that they use."""
    used = np.unique(paths)
    used = used[used > 0]
    own = np.searchsorted(used, paths) + 1
    own[paths == 0] = 0
    return Automaton.from_sorted([words[k - 1] for k in used], own, weights).pack()


class Ranges:
    """Bounds between prefix ranges: (lang, words) in order. Range k begins at bound k - 1."""

    def __init__(self, bounds: list[tuple[str, list[bytes]]]):
        self.bounds = bounds

    def of_language(self, lang: str) -> tuple[int, list[list[bytes]]]:
        """(the range where a language begins, the bounds inside it)."""
        start = bisect_right(self.bounds, (lang, []))
        inside = []
        for other, words in self.bounds[start:]:
            if other != lang:
                break
            inside.append(words)
        return start, inside

    def edges(self, k: int, lang: str) -> set[tuple[bytes, ...]]:
        """Prefixes of the bounds of a range: their paths may lie in neighbours, too."""
        near = [self.bounds[i][1] for i in (k - 1, k) if 0 <= i < len(self.bounds) and self.bounds[i][0] == lang]
        return {tuple(words[:n]) for words in near for n in range(1, len(words) + 1)}


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("raw")
    )


def find_ranges(docs: DataFrame, text: str, lang: str, range_paths: int = RANGE_PATHS) -> Ranges:
    """Bounds about ``range_paths`` paths apart. One bound is kept for that many words of text (some five megabytes),
    so what the driver and the tasks hold of them is a few millionths of the texts."""
    part = 16 if range_paths >= 1 << 16 else 1
    stride = max(1, range_paths // (RANGE_SAMPLES * part))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skip = stride // 2
        for batch in slices(batches):
            found = []
            for own, raw in zip(*(c.to_pylist() for c in batch.columns)):
                words = [w for w in raw.translate(PIECES).replace(STOP, b" . ").split(b" ") if w]
                while skip < len(words):
                    path = words[skip : skip + ORDER]
                    path = path[: path.index(STOP)] if STOP in path else path
                    if path:
                        found.append((own, b" ".join(path)))
                    skip += stride
                skip -= len(words)
            if found:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.binary()))], ["lang", "path"])

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = RANGE_SAMPLES // 2
        for batch in batches:
            keep = np.arange((-seen) % RANGE_SAMPLES, batch.num_rows, RANGE_SAMPLES)
            seen += batch.num_rows
            yield batch.take(pa.array(keep))

    rows = _rows(docs, text, lang)
    if part > 1:
        rows = rows.where(F.rand(12) < 1 / part)
    # A sorted array of words, since a phrase with a shorter word sorts before one with a longer.
    sample = rows.mapInArrow(pick, "lang string, path binary").select("lang", F.split(F.col("path").cast("string"), " ").alias("path"))
    ordered = sample.orderBy("lang", "path").mapInArrow(thin, "lang string, path array<string>").collect()
    bounds = sorted({(r["lang"], tuple(w.encode() for w in r["path"])) for r in ordered})
    return Ranges([(own, list(words)) for own, words in bounds])


def _sections(docs: DataFrame, text: str, lang: str, ranges: Ranges, most_words: int, most_paths: int) -> DataFrame:
    """(range, lang, data): automata of all shards, cut at the bounds of ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Shard] = defaultdict(Shard)

        def out(own: str) -> Iterator[pa.RecordBatch]:
            words, paths, weights = held.pop(own).paths()
            start, inside = ranges.of_language(own)
            cuts = [0, *(first_not_below(words, paths, b) for b in inside), len(paths)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    data = _section(words, paths[a:b], weights[a:b])
                    yield pa.record_batch([pa.array([start + k], pa.int32()), pa.array([own]), pa.array([data], pa.binary())], ["range", "lang", "data"])

        for batch in slices(batches):
            for own, raw in zip(*(c.to_pylist() for c in batch.columns)):
                shard = held[own]
                shard.add(raw)
                if len(shard.numbers) > most_words or shard.size > most_paths:
                    yield from out(own)
            # Many languages together are bounded, too.
            while sum(s.size for s in held.values()) > 2 * most_paths:
                yield from out(max(held, key=lambda k: held[k].size))
        for own in list(held):
            yield from out(own)

    return _rows(docs, text, lang).mapInArrow(run, "range int, lang string, data binary")


def united(sections: list[bytes], least: int, edges: set[tuple[bytes, ...]]) -> tuple[int, list[tuple[tuple[bytes, ...], int]]]:
    """(all paths' weight, phrases with counts) of several automata: phrases of ``least`` occurrences or more, and the
    edges as far as they occur."""
    automata = [Automaton.unpack(s) for s in sections]
    words = sorted(set().union(*(a.words for a in automata)))
    number = {w: k for k, w in enumerate(words, 1)}
    columns, weights = [], []
    for a in automata:
        rank = np.array([0, *(number[w] for w in a.words)], np.int32)
        paths, weight = a.paths()
        columns.append(rank[paths])
        weights.append(weight)
    paths, weights = np.concatenate(columns), np.concatenate(weights)
    del automata, columns
    total = int(weights.sum())
    found, phrases, known, state = [], [()], {(): 0}, np.zeros(len(paths), np.int64)
    for depth in range(ORDER):
        real = paths[:, depth] > 0
        paths, weights, state = paths[real], weights[real], state[real]
        if not len(paths):
            break
        key = (state << 32) | paths[:, depth]
        order = np.argsort(key, kind="stable")
        key, paths, weights = key[order], paths[order], weights[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        counts = np.add.reduceat(weights, first)
        key, keep = key[first], counts >= least
        for edge in edges:
            if len(edge) == depth + 1 and edge[:-1] in known and edge[-1] in number:
                want = (known[edge[:-1]] << 32) | number[edge[-1]]
                at = int(np.searchsorted(key, want))
                if at < len(key) and key[at] == want:
                    keep[at] = True
        phrases = [(*phrases[k >> 32], words[(k & 0xFFFFFFFF) - 1]) for k in key[keep].tolist()]
        known = {p: k for k, p in enumerate(phrases)}
        found += zip(phrases, counts[keep].tolist())
        size = np.diff(np.append(first, len(paths)))
        rows = np.repeat(keep, size)
        state = np.repeat(np.cumsum(keep) - 1, size)[rows]
        paths, weights = paths[rows], weights[rows]
    return total, found


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, range_paths: int = RANGE_PATHS,
    most_words: int = SHARD_VOCABULARY, most_paths: int = SHARD_PATHS,
) -> DataFrame:
    """(lang, phrase, f, range): phrases of one to four words with their counts, and the number of all words of a
    language under the NULL phrase. ``range`` is the prefix range that a phrase belongs to."""
    ranges = find_ranges(docs, text, lang, range_paths)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out, k = [], int(rows["range"].iat[0])
        for own, part in rows.groupby("lang"):
            total, found = united(part["data"].tolist(), least, ranges.edges(k, own))
            out.append((own, None, total, k))
            out += [(own, b" ".join(p).decode(), f, k) for p, f in found]
        return pd.DataFrame(out, columns=["lang", "phrase", "f", "range"])

    sections = _sections(docs, text, lang, ranges, most_words, most_paths)
    found = sections.groupBy("range").applyInPandas(run, "lang string, phrase string, f long, range int")
    found = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), F.min("range").alias("range"))
    return found.where(F.col("phrase").isNull() | (F.col("f") >= least))


def _parts(n: int) -> list[tuple[int, int]]:
    """(begin, length) of the parts that a phrase of n words needs: what stands before and after a cut, and phrases
    inside it."""
    return [(i, k) for k in range(1, n) for i in range(n - k + 1) if i == 0 or i + k == n or k >= 2]


def composed(phrases: list[list[bytes]], counts: list[int], parts: list[tuple[list[bytes], int]], share: int) -> list[tuple]:
    """Per phrase (l, r, score of the lowest-scoring cut, numbers (begin, length) of the phrases inside that it
    stands for): the counts of all parts come from the automaton of parts, by composition with the phrases."""
    words = sorted({w for p, _ in parts for w in p})
    number = {w: k for k, w in enumerate(words, 1)}
    pad = lambda p: [number.get(w, len(words) + 1) for w in p] + [0] * (ORDER - len(p))
    paths = np.array([pad(p) for p, _ in parts], np.int64).reshape(-1, ORDER)
    order = np.lexsort(paths.T[::-1])
    transducer = Automaton.from_sorted(words, paths[order], np.array([f for _, f in parts], np.int64)[order])
    out: list[tuple] = [()] * len(phrases)
    for n in range(2, ORDER + 1):
        at = [k for k, p in enumerate(phrases) if len(p) == n]
        if not at:
            continue
        spots = _parts(n)
        asked = np.array([pad(phrases[k][i : i + m]) for k in at for i, m in spots], np.int64).reshape(-1, ORDER)
        weight = transducer.compose(asked).reshape(len(at), len(spots))
        place = {s: j for j, s in enumerate(spots)}
        for k, row in zip(at, weight.tolist()):
            a, best = counts[k], None
            for cut in range(1, n):
                left, right = row[place[0, cut]], row[place[cut, n - cut]]
                score = SCALE * a // (left + right)
                if best is None or score < best[2]:
                    best = (left, right, score)
            inside = [(i, m) for i, m in spots if m >= 2 and 100 * a >= share * row[place[i, m]]]
            out[k] = (*best, inside)
    return out


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, share: int = 80, top: int = 2000, range_paths: int = RANGE_PATHS,
    most_words: int = SHARD_VOCABULARY, most_paths: int = SHARD_PATHS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` phrases of two to four words.

    A phrase is dropped if a longer frequent one that holds it has ``share`` hundredths of its occurrences or more.
    """
    found = settle(frequent_phrases(docs, text, lang, least, range_paths, most_words, most_paths), "phrases")
    totals = found.where("phrase is null").select("lang", F.col("f").alias("n"))
    known = found.where("phrase is not null").select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    chosen = found.where(F.size(words) >= 2).select("range", "lang", "phrase", F.col("f").alias("a"))
    spots = {n: F.array(*[F.array_join(F.slice(words, i + 1, k), " ") for i, k in _parts(n)]) for n in range(2, ORDER + 1)}
    needed = F.when(F.size(words) == 2, spots[2]).when(F.size(words) == 3, spots[3]).otherwise(spots[4])
    needed = chosen.select("range", "lang", F.explode(needed).alias("phrase")).distinct()
    parts = needed.join(known, ["lang", "phrase"]).select(F.col("range").alias("asker"), F.col("lang").alias("own"), F.col("phrase").alias("part"), "f")

    def run(rows: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        out, lists = [], dict(tuple(parts.groupby("own")))
        for own, part in rows.groupby("lang"):
            phrases = [p.encode().split(b" ") for p in part["phrase"]]
            counts, have = part["a"].tolist(), lists[own]
            held = list(zip([p.encode().split(b" ") for p in have["part"]], have["f"].tolist()))
            for p, text, a, (left, right, score, inside) in zip(phrases, part["phrase"], counts, composed(phrases, counts, held, share)):
                out.append((own, text, a, left, right, score, [b" ".join(p[i : i + m]).decode() for i, m in inside]))
        return pd.DataFrame(out, columns=["lang", "phrase", "a", "l", "r", "score", "stands_for"])

    schema = "lang string, phrase string, a long, l long, r long, score long, stands_for array<string>"
    rated = settle(chosen.groupBy("range").cogroup(parts.groupBy("asker")).applyInPandas(run, schema), "rated")
    gone = rated.select("lang", F.explode("stands_for").alias("phrase")).distinct()
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    left = rated.drop("stands_for").join(gone, ["lang", "phrase"], "left_anti")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
