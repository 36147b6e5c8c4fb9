"""Line deduplication by distinct-site spread, in built-in functions only.

Every line (trimmed) is known by a 128-bit hash. Per line hash a HyperLogLog sketch of its sites is merged by
aggregation. A line whose estimate lies clearly above ``min_sites`` is boilerplate; where the estimate is near the
threshold, the distinct sites are counted exactly; below it the line stays. Of a boilerplate line the first occurrence
(smallest id, then place) stays and every other one is removed.

A site is the document's source. A line of more than ``passage_words`` words doesn't recur by chance, so each document
counts as a site of its own for it. Lines of fewer than ``min_words`` words and blank lines always stay.

NULL sources are one site, NULL texts stay NULL, empty texts stay empty. Repeated rows (equal id and text) are one
document and are treated alike; rows with equal ids and different texts, or NULL ids, are told apart by their texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

LG_K = 10


def _lines(docs: DataFrame, id: str, text: str, site: str, min_words: int, passage_words: int) -> DataFrame:
    rows = docs.select(
        F.col(id).alias("doc"), F.xxhash64(text).alias("th"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"),
    )
    rows = rows.withColumn("line", F.trim("line")).withColumn("words", F.regexp_count("line", F.lit(r"[^ \t]+")))
    own = F.concat(F.lit("doc:"), F.coalesce(F.col("doc").cast("string"), F.lit("")), F.lit(":"), F.col("th").cast("string"))
    return rows.where((F.col("words") >= min_words) & (F.col("line") != "")).select(
        "doc", "th", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
        F.when(F.col("words") > passage_words, own).otherwise(F.concat(F.lit("site:"), F.col("site"))).alias("site"),
    )


def boilerplate_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(h1, h2, first): line hashes that at least ``min_sites`` distinct sites have, and their first occurrence."""
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", LG_K).alias("sketch"), F.count("*").alias("n"), F.min(F.struct("doc", "th", "pos")).alias("first")
    )
    # A line that occurs less often than the threshold can't reach it.
    spread = spread.where(F.col("n") >= min_sites).select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("sites"))
    spread = settle(spread, "spread")
    band = 1 + math.ceil(4 * 1.04 / math.sqrt(1 << LG_K) * min_sites)
    sure = spread.where(F.col("sites") > min_sites + band).select("h1", "h2", "first")
    near = spread.where((F.col("sites") >= min_sites - band) & (F.col("sites") <= min_sites + band)).select("h1", "h2", "first")
    # Occurrences are combined to sites before they meet by line, so a line costs a row per site, however often it
    # stands there. An inner join on the unique hashes: a semi join would be moved below the combination.
    pairs = lines.select("h1", "h2", "site").distinct().join(near.select("h1", "h2"), ["h1", "h2"])
    exact = pairs.groupBy("h1", "h2").count().where(F.col("count") >= min_sites)
    return sure.unionByName(near.join(exact, ["h1", "h2"], "left_semi"))


def dedup_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = 2, min_words: int = 3,
    passage_words: int = 50,
) -> DataFrame:
    """All rows and columns of ``docs`` with removed boilerplate lines, and (n_lines, n_removed); columns of these
    names are replaced."""
    lines = settle(_lines(docs, id, text, site, min_words, passage_words), "lines")
    # A table of its own: Spark knows its size, and both sides of the join are exchanged, so it can split a hot line.
    spread = settle(boilerplate_lines(lines, min_sites), "boilerplate")
    met = lines.join(spread, ["h1", "h2"]).where(~F.struct("doc", "th", "pos").eqNullSafe(F.col("first")))
    removed = met.groupBy("doc", "th").agg(F.collect_set("pos").alias("gone")).select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), "gone")
    rest = docs.drop("n_lines", "n_removed")
    keyed = rest.withColumn("_key", F.xxhash64(text))
    found = keyed.join(removed, F.col(id).eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_th")), "left")
    found = found.withColumn("_all", F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
    columns: list[Column] = []
    for name in rest.columns:
        if name == text:
            kept = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("gone"))
            cut = F.array_join(F.transform(kept, lambda i: F.get(F.col("_all"), i)), "\n")
            columns.append(F.when(F.col("gone").isNull(), F.col(text)).otherwise(cut).alias(text))
        else:
            columns.append(F.col(name))
    n_lines = F.when(F.coalesce(F.col(text), F.lit("")) == "", F.lit(0)).otherwise(F.size("_all")).cast("long")
    n_removed = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    return found.select(*columns, n_lines.alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(n_removed).cast("long").alias("n_removed"))
