"""Packing into optimal length buckets.

Documents longer than ``limit`` tokens are cut into pieces of ``limit`` tokens and a rest, so all lengths are at most
``limit`` and the global histogram of lengths has at most ``limit`` rows. Dynamic programming over it chooses the
bucket boundaries (padded lengths) with the least padding in total. Inside a bucket, rows are numbered without gaps
and dealt to batches of ``budget`` padded tokens, so only a bucket's last batch can be short.

The numbering counts rows per slice of a hash first and adds offsets, so a bucket with most of the rows is spread
over many tasks. Rows with a NULL length or none count as length ``least`` (1: the end token), repeated rows are rows
of their own, and an empty table gives no batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, slices
from .pretokens import pretokenizer


def token_lengths(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens): tokens of each whole text with one end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokenizer(tokenizer)
        for batch in slices(batches):
            sizes = encoder.lengths(batch.column(1).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array([n + 1 for n in sizes], pa.int64())], [id, "n_tokens"])

    slim = docs.select(F.col(id), F.col(text).alias("text"))
    return slim.mapInArrow(run, slim.select(id).schema.add("n_tokens", "long"))


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most ``buckets`` ascending padded lengths with the least padding; each is a length that occurs."""
    sort = np.argsort(lengths)
    lengths, counts = np.asarray(lengths, np.int64)[sort], np.asarray(counts, np.int64)[sort]
    n = len(lengths)
    if not n:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    # cost[j] of lengths 0..j-1 in the buckets so far; a bucket over lengths i..j-1 pads to lengths[j-1].
    cost = np.concatenate([[0.0], lengths * rows[1:] - tokens[1:]])
    choice = [np.zeros(n + 1, np.int64)]
    for _ in range(min(buckets, n) - 1):
        new, pick = np.zeros(n + 1), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            total = cost[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            pick[j] = int(np.argmin(total))
            new[j] = total[pick[j]]
        cost, choice = new, [*choice, pick]
    out, j = [], n
    for pick in reversed(choice):
        if j:
            out.append(int(lengths[j - 1]))
            j = int(pick[j])
    return out[::-1]


def pack(
    rows: DataFrame, id: str = "doc_id", length: str = "n_tokens", limit: int = 2048, buckets: int = 16, budget: int = 65_536,
    least: int = 1, rows_per_slice: int = 20_000,
) -> DataFrame:
    """(id, piece, start, length, padded, batch, slot): every piece of every row, its bucket's padded length, its
    batch (numbered within the bucket) and its place in the batch."""
    if budget < limit:
        raise ValueError("a batch must hold a piece of the largest length")
    n = F.greatest(F.coalesce(F.col(length).cast("long"), F.lit(0)), F.lit(least).cast("long"))
    cut = rows.select(F.col(id), n.alias("n")).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / limit))))
    pieces = cut.select(
        F.col(id),
        F.col("piece").cast("int").alias("piece"),
        (F.col("piece") * limit).alias("start"),
        F.least(F.lit(limit).cast("long"), F.col("n") - F.col("piece") * limit).cast("int").alias("length"),
    )
    pieces = settle(pieces, "pieces")
    histogram = pieces.groupBy("length").count().toPandas()  # at most ``limit`` rows
    edges = optimal_boundaries(histogram["length"].to_numpy(), histogram["count"].to_numpy(), buckets)
    if not edges:
        return pieces.withColumns({"padded": F.lit(0), "batch": F.lit(0).cast("long"), "slot": F.lit(0)})
    padded = F.array_min(F.filter(F.lit(edges), lambda e: e >= F.col("length")))
    spread = -(-int(histogram["count"].sum()) // rows_per_slice)
    mixed = F.pmod(F.xxhash64(F.col(id), "piece", "length"), F.lit(max(16, spread))).cast("int")
    placed = pieces.withColumns({"padded": padded, "slice": mixed})
    sizes = placed.groupBy("padded", "slice").count()
    before = Window.partitionBy("padded").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    own = Window.partitionBy("padded", "slice").orderBy(id, "piece", "start")
    numbered = placed.withColumn("row", F.row_number().over(own) - 1).join(offsets, ["padded", "slice"])
    at, room = F.col("offset") + F.col("row"), F.floor(F.lit(budget) / F.col("padded"))
    return numbered.select(
        F.col(id), "piece", "start", "length", "padded", F.floor(at / room).alias("batch"), F.pmod(at, room).cast("int").alias("slot")
    )
