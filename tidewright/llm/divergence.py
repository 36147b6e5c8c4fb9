"""How far the sources of a language diverge in their vocabulary, by products of one-hot count levels.

Within a language, every (source, number of occurrences) is a level, and a term has exactly one level per source: a row
of ones and zeros. The product of that matrix's transpose with the matrix holds the joint table of every pair of
sources: how many terms have count a in one and count b in the other. A level has one price per source, its smoothed
share of the source's occurrences, so a pair's divergence is the joint table summed over the differences of prices;
no pair of sources is ever met term by term.

The terms of a language are cut into blocks of about ``block_terms`` and its sources into blocks of about
``block_sources``; each (term block, source block, source block) is a matrix product of its own, made in panels of
bounded width. Entries are counts of at most the terms of a block, so single precision holds them exactly; prices are
whole numbers from unbounded integers, sums are 64-bit. The blocks' figures add up.

A term is a run of ASCII letters and other characters beyond ASCII, A-Z lower-cased. NULL text, lang and source are read
as ''. Each row is a document, repeated rows included. A language without kept terms has divergence 0 between its
sources; an empty table gives no rows. Only the columns named are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, slices

#: Shares are counted in units of one part in SCALE; SMOOTH occurrences are added to every term.
SCALE = 1_000_000_000
SMOOTH = 5

#: ASCII letters and everything beyond ASCII make terms; A-Z become a-z.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))

FLUSH = 200_000
PANEL = 2048


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, d): occurrences of a term and the documents that have it."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def out() -> Iterator[pa.RecordBatch]:
            for (own_lang, own_source), (n, d) in held.items():
                terms = list(n)
                yield pa.record_batch(
                    [
                        pa.array([own_lang] * len(terms), pa.string()), pa.array([own_source] * len(terms), pa.string()),
                        pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                        pa.array([d[t] for t in terms], pa.int64()),
                    ],
                    names,
                )
            held.clear()

        size = 0
        for batch in slices(batches):
            for own_lang, own_source, raw in zip(*(c.to_pylist() for c in batch.columns)):
                n, d = held[own_lang, own_source]
                words, before = raw.translate(LETTERS).split(), len(n)
                n.update(words)
                d.update(set(words))
                size += len(n) - before
            if size > FLUSH:
                yield from out()
                size = 0
        yield from out()

    names = ["lang", "source", "term", "n", "d"]
    rows = docs.select(_filled(lang).alias("lang"), _filled(source).alias("source"), _filled(text).cast("binary").alias("raw"))
    rows = rows.mapInArrow(gather, "lang string, source string, term string, n long, d long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def price(count: int, total: int, terms: int) -> int:
    """The smoothed share of a term, exact at any size."""
    return 1 + SCALE * (count + SMOOTH) // (total + SMOOTH * terms)


def _price(count: str, total: str, terms: str) -> Column:
    """The same in Spark: 128-bit whole numbers, since the product may pass 64 bits."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    up = F.lit(SCALE).cast("decimal(10,0)") * (wide(count) + F.lit(SMOOTH).cast("decimal(1,0)"))
    down = wide(total) + F.lit(SMOOTH).cast("decimal(1,0)") * wide(terms)
    return (1 + F.call_function("div", up, down)).cast("long")


class Levels:
    """The one-hot level matrix of a block of terms and one of sources; columns are (source, level) with their prices."""

    def __init__(self, rows: pd.DataFrame, terms: np.ndarray):
        self.sources, place = np.unique(rows["source"].to_numpy(object), return_inverse=True)
        counts = np.zeros((len(terms), len(self.sources)), np.int64)
        real = rows["term"].notna().to_numpy()
        at = np.searchsorted(terms, rows["term"].to_numpy(object)[real]) if real.any() else []
        counts[at, place[real]] = rows["n"].to_numpy(np.int64)[real]
        owner, prices, column = [], [], np.zeros(counts.shape, np.int64)
        first = np.unique(place, return_index=True)[1]
        for s, at in enumerate(first):
            total, kept = int(rows["total"].iat[at]), int(rows["kinds"].iat[at])
            levels, level = np.unique(counts[:, s], return_inverse=True)
            column[:, s] = level + len(owner)
            owner += [s] * len(levels)
            prices += [price(int(c), total, kept) for c in levels]
        self.owner, self.prices, self.column = np.array(owner, np.int64), np.array(prices, np.int64), column
        self.unused = np.array([price(0, int(rows["total"].iat[at]), int(rows["kinds"].iat[at])) if rows["kinds"].iat[at] else 0 for at in first], np.int64)

    def panels(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(one-hot columns, their sources, their prices) of at most PANEL columns at a time."""
        for low in range(0, len(self.owner), PANEL):
            high = min(low + PANEL, len(self.owner))
            ones = np.zeros((len(self.column), high - low), np.float32)
            row, col = np.nonzero((self.column >= low) & (self.column < high))
            ones[row, self.column[row, col] - low] = 1
            yield ones, self.owner[low:high], self.prices[low:high]


def joint_divergence(a: Levels, b: Levels, unused: int = 0) -> np.ndarray:
    """Per pair of sources: the joint tables of their levels, each entry priced by the difference of the levels.
    ``unused`` terms have no occurrence in either block; they are all in the levels of count 0."""
    out = unused * np.abs(a.unused[:, None] - b.unused[None, :])
    for left, own, price_a in a.panels():
        for right, other, price_b in b.panels():
            joint = (left.T @ right).astype(np.int64)
            priced = joint * np.abs(price_a[:, None] - price_b[None, :])
            rows, cols = (np.flatnonzero(np.diff(x, prepend=-1)) for x in (own, other))
            priced = np.add.reduceat(np.add.reduceat(priced, rows, axis=0), cols, axis=1)
            out[np.ix_(own[rows], other[cols])] += priced
    return out


def _pairs(group: pd.DataFrame) -> pd.DataFrame:
    terms = np.unique(group["term"].dropna().to_numpy(object))
    low, high = int(group["low"].iat[0]), int(group["high"].iat[0])
    a = Levels(group[group["own"] == low], terms)
    b = a if low == high else Levels(group[group["own"] == high], terms)
    value = joint_divergence(a, b, int(group["size"].max()) - len(terms))
    i, j = (x.ravel() for x in np.indices(value.shape))
    found = [(a.sources[i], b.sources[j], value.ravel())]
    if low != high:
        found.append((b.sources[j], a.sources[i], value.ravel()))
    lang, source, item, value = group["lang"].iat[0], *(np.concatenate(x) for x in zip(*found))
    apart = source != item
    return pd.DataFrame({"lang": lang, "source": source[apart], "item": item[apart], "value": value[apart]})


def divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30, most_terms: int = 50,
    block_terms: int = 512, block_sources: int = 64,
) -> DataFrame:
    """(lang, source, part, item, value, rank): per source the divergence from every other source of its language (part
    ``pair``), and the terms it uses more than its language does (part ``term``, at most ``most_terms``)."""
    counts = settle(term_counts(docs, text, lang, source), "terms")
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("d").alias("d")).where(F.col("d") >= min_docs)
    kept = settle(counts.join(whole.drop("d"), ["lang", "term"]).select("lang", "source", "term", "n", "whole"), "kept")

    # One row per language, and one per group; groups without terms are there too.
    langs = kept.select("lang", "term", "whole").distinct().groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("whole").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(_filled(lang).alias("lang"), _filled(source).alias("source")).distinct()
    sizes = groups.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block_sources)).cast("int").alias("source_blocks"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = settle(
        groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang")
        .select("lang", "source", zero("total"), zero("kinds"), zero("lang_total"), "source_blocks")
        .withColumn("term_blocks", F.greatest(F.lit(1), F.ceil(F.col("kinds") / block_terms)).cast("int")), "groups",
    )

    # Every group stands once in each of its blocks without a term, so that a block knows all its sources and how many
    # terms it has, also those that none of them uses.
    rows = kept.select("lang", "source", "term", "n").join(groups, ["lang", "source"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int"))
    bare = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)))
    number = kept.select("lang", "term").distinct().join(groups.groupBy("lang").agg(F.max("term_blocks").alias("term_blocks")), "lang")
    number = number.groupBy("lang", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("block")).agg(F.count("*").alias("size"))
    bare = bare.join(number, ["lang", "block"], "left").withColumns({"term": F.lit(None).cast("string"), "n": F.lit(0).cast("long"), "size": F.coalesce("size", F.lit(0))})
    rows = rows.withColumn("size", F.lit(0).cast("long"))
    dealt = rows.unionByName(bare).withColumn("own", F.pmod(F.xxhash64("source"), F.col("source_blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("source_blocks") - 1)))
    dealt = dealt.select("lang", "block", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "source", "term", "n", "total", "kinds", "size")
    found = dealt.groupBy("lang", "block", "low", "high").applyInPandas(_pairs, "lang string, source string, item string, value long")
    pairs = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    priced = kept.join(groups, ["lang", "source"]).withColumns({"p": _price("n", "total", "kinds"), "q": _price("whole", "lang_total", "kinds")})
    priced = priced.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = priced.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most_terms)
    return pairs.unionByName(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
