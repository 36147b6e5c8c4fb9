"""Token counts: pieces are counted once per distinct pre-token and joined to per-document frequencies.

The counts of the most frequent pre-tokens travel to the tasks as a table of at most ``hot`` entries, so a pre-token
that makes up a third of a corpus is added up where its documents are. The other pre-tokens are met by a shuffled
join. Both ways give the same sums; no ids are kept. NULL and empty texts have 0 tokens, repeated rows and NULL ids
are counted row by row, columns beyond the id and the text are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, slices
from .pretokens import pretokenizer

#: Distinct pre-tokens that a task holds before it passes them on.
FLUSH = 300_000


def pretoken_table(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(piece, n, n_tokens): each distinct pre-token of all texts, its frequency and the number of its tokens."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = pretokenizer(tokenizer).split, Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch({"piece": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                seen.update(split(value))
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
        yield out()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokenizer(tokenizer)
        for batch in slices(batches, 8192):
            ids = encoder.ids(batch.column(0).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([len(i) for i in ids], pa.int32())], ["piece", "n", "n_tokens"])

    pieces = docs.select(F.col(text).alias("text")).mapInArrow(gather, "piece string, n long")
    return pieces.groupBy("piece").agg(F.sum("n").alias("n")).mapInArrow(count, "piece string, n long, n_tokens int")


def _frequent(table: DataFrame, most: int) -> DataFrame:
    """The pre-tokens above the frequency that at most ``most`` of them have. The frequency comes from a histogram of
    a few hundred steps (each 12 % wide), so no task sends more than its share of the table to the driver."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 6).cast("int")
    taken, least = 0, None
    for row in sorted(table.where("n > 1").groupBy(step.alias("step")).count().collect(), reverse=True):
        taken += row["count"]
        if taken > most:
            break
        least = row["step"]
    return table.where(F.lit(False) if least is None else (F.col("n") > 1) & (step >= least)).select("piece", "n_tokens")


def token_counts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", hot: int = 1 << 17) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row of ``docs``, as the tokenizer's library counts its whole text."""
    spark = docs.sparkSession
    table = settle(pretoken_table(docs, tokenizer, text), "pretokens")
    known = spark.sparkContext.broadcast({r.piece: r.n_tokens for r in _frequent(table, hot).collect()})

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, table = pretokenizer(tokenizer).split, known.value
        for batch in slices(batches):
            rows = []
            for key, doc, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rest, base = [], 0
                for piece, n in Counter(split(value)).items():
                    got = table.get(piece)
                    if got is None:
                        rest.append((piece, n))
                    else:
                        base += got * n
                size = len(value.encode()) if value else 0
                # A document without rare pre-tokens has one row, under a key that no pre-token has.
                for piece, n in rest or [(f"\n{key}", 0)]:
                    rows.append((key, doc, size, base, piece, n))
                    base = 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=shape)

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    shape = pa.schema(list(zip(["row", "doc", "n_bytes", "base", "piece", "n"], types)))
    frequencies = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("doc"), F.col(text).alias("text")
    ).mapInArrow(per_document, "row long, doc long, n_bytes long, base long, piece string, n long")
    missing = F.raise_error(F.concat(F.lit("pre-token without a count: "), F.col("piece"))).cast("long")
    tokens = F.when(F.col("n") == 0, F.lit(0)).when(F.col("n_tokens").isNull(), missing).otherwise(F.col("n") * F.col("n_tokens"))
    return (
        frequencies.join(table.select("piece", "n_tokens"), "piece", "left")
        .groupBy("row")
        .agg(F.first("doc").alias(id), F.max("n_bytes").alias("n_bytes"), F.sum(F.col("base") + tokens).alias("n_tokens"))
        .drop("row")
    )
