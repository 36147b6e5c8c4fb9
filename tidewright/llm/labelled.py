"""Labelled rows: documents met with their labels, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Settled labels of at most so many rows (some 24 MB) are sent to every task, by a count; more of them meet the texts by
#: a shuffle of both sides.
BROADCAST_ROWS = 2_000_000


def remainder(id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor; the fold of a row. NULL ids have no fold."""
    return F.crc32(id.cast("string").cast("binary")) % divisor


def training_labels(labels: DataFrame, label: str, divisor: int, held_out: int, id: str = "doc_id") -> DataFrame:
    """(doc, label) of the rows that may be learnt from: one per id, the larger of differing labels, no NULLs."""
    rows = labels.select(F.col(id).cast("long").alias("doc"), F.col(label).cast("int").alias("label")).dropna()
    return rows.where(remainder(F.col("doc"), divisor) != held_out).groupBy("doc").agg(F.max("label").alias("label"))


def sampled(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` labels, the same ones every time, whatever the order of rows.

    ``labels`` is settled. A share of them, by hash, is about half as many again as are wanted; only these are ordered.
    """
    share = min(1.0, 1.5 * most / max(1, labels.count()))
    near = labels.where(F.pmod(F.xxhash64("doc"), F.lit(1 << 20)) < F.lit(max(1, int(share * (1 << 20)))))
    return near.orderBy(F.xxhash64("doc"), "doc").limit(most)


def with_labels(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, label, raw): labelled documents with their whole texts in UTF-8."""
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).cast("binary").alias("raw"))
    side = F.broadcast(labels) if labels.count() <= BROADCAST_ROWS else labels
    return rows.join(side, "doc").select("doc", "label", "raw")
