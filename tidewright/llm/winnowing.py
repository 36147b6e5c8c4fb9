"""Document fingerprints by winnowing, in built-in functions only.

A text's k-grams of words get rolling polynomial hashes modulo a prime; of every window of ``window`` consecutive
k-grams the least hash is chosen, the rightmost of equal ones. The chosen hashes with their positions are the
fingerprint: two texts that share ``k + window - 1`` words in a row share a fingerprint entry, and no match shorter
than k words can make one. A hash and its position travel as one number, hash first and position counted down, so the
least number of a window is the rightmost least hash, and window minima come from doubling.

Words are runs without white space, lower case. A text of fewer than k words has one k-gram of all its words, a text
without words (empty or NULL) no entries. Equal texts have equal fingerprints; the likeness of two fingerprints is the
Jaccard index of their distinct hashes, 1 for two empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_bounds, bucket_of

PRIME = (1 << 31) - 1
BASE = 1_000_003
POSITION_BITS = 30


def _joined(left: str, right: str, ahead: int, shift: int) -> Column:
    """Hashes of runs, each followed by the run that begins ``ahead`` words later (NULL beyond the end)."""
    return F.transform(left, lambda x, i: (x * shift + F.get(F.col(right), i + ahead)) % PRIME)


def _lesser(column: str, ahead: int) -> Column:
    """Each element or the one that many places ahead, whichever is less."""
    return F.transform(column, lambda x, i: F.least(x, F.get(F.col(column), i + ahead)))


def _with_gram_hashes(df: DataFrame, words: str, out: str, k: int) -> DataFrame:
    """Polynomial hash of every k words, from hashes of shorter runs (each step is a column of its own, so that
    nothing is computed twice)."""
    df = df.withColumn("_h1", F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME))))
    have = 1
    for step in bin(k)[3:]:
        df = df.withColumn(f"_h{2 * have}", _joined(f"_h{have}", f"_h{have}", have, pow(BASE, have, PRIME)))
        have *= 2
        if step == "1":
            df = df.withColumn(f"_h{have + 1}", _joined(f"_h{have}", "_h1", have, BASE))
            have += 1
    n = F.size(words)
    one = F.array(F.pmod(F.xxhash64(F.array_join(words, " ")), F.lit(PRIME)))
    df = df.withColumn(out, F.when(n >= k, F.slice(f"_h{k}", F.lit(1), F.greatest(n - k + 1, F.lit(0)))).when(n > 0, one).otherwise(F.slice("_h1", 1, 0)))
    return df.drop(*[c for c in df.columns if c.startswith("_h")])


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = 5, window: int = 8) -> DataFrame:
    """Adds an array of numbers (hash and position, see ``entries``): the winnowed k-grams in order of position."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), "")
    df = _with_gram_hashes(df.withColumn("_words", words), "_words", "_grams", k).drop("_words")
    last = (1 << POSITION_BITS) - 1
    df = df.withColumn("_m1", F.transform("_grams", lambda h, i: F.shiftleft(h, POSITION_BITS) + (last - i))).drop("_grams")
    have, name = 1, "_m1"
    while have < window:
        ahead = min(have, window - have)
        df = df.withColumn(f"_m{have + ahead}", _lesser(name, ahead))
        have += ahead
        name = f"_m{have}"
    # Only whole windows choose, or the single shorter one.
    whole = F.slice(name, F.lit(1), F.greatest(F.size(name) - window + 1, F.lit(1)))
    df = df.withColumn(out, F.array_distinct(whole))
    return df.drop(*[c for c in df.columns if c.startswith("_m")])


def entries(fingerprint: Column) -> Column:
    """The fingerprint as an array of (hash, position)."""
    last = (1 << POSITION_BITS) - 1
    return F.transform(
        fingerprint,
        lambda x: F.struct(F.shiftright(x, POSITION_BITS).alias("hash"), (last - x.bitwiseAND(F.lit(last))).cast("int").alias("position")),
    )


def hashes(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, POSITION_BITS)))


def digest(fingerprint: Column) -> Column:
    """32 hex digits that stand for the whole fingerprint."""
    parts = [F.lpad(F.hex(F.xxhash64(F.lit(seed), fingerprint)), 16, "0") for seed in (1, 2)]
    return F.lower(F.concat(*parts))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / F.greatest(either, F.lit(1)))


def fingerprints(docs: DataFrame, text: str = "text", k: int = 5, window: int = 8, out: str = "fingerprint") -> DataFrame:
    """All rows and columns of ``docs`` with the fingerprint as (hash, position) entries; a column of that name is
    replaced."""
    found = with_fingerprint(docs.drop(out).withColumn("_text", F.col(text)), "_text", out, k, window)
    return found.drop("_text").withColumn(out, entries(F.col(out)))


def with_next(docs: DataFrame, id: str, text: str, rows_per_bucket: int = 256) -> tuple[DataFrame, Window, Column]:
    """Rows (id, text, next_text), the window that orders them, and what tells rows from helpers.

    The next document is the one that follows in order of id (NULL first), then text; after the last comes the first.
    Rows are cut into buckets in id order, and each bucket gets a copy of what follows it, so no task orders the
    whole table and the texts are shuffled once.
    """
    bounds = bucket_bounds(docs, id, rows_per_bucket)
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    low = rows.agg(F.min("doc").alias("low"), F.max(F.col("doc").isNull()).alias("null")).first()
    first = F.col("doc").isNull() if low["null"] else F.col("doc") == low["low"]
    home = bucket_of(F.col("doc"), bounds)
    place = lambda bucket, wrap, real: F.struct(bucket.alias("bucket"), F.lit(wrap).alias("wrap"), F.lit(real).alias("real"))
    copies = [F.array(place(home, 0, True))]
    if bounds:
        starts = F.coalesce(F.get(F.lit(bounds), home - 1) == F.col("doc"), F.lit(False))
        copies.append(F.when(starts, F.array(place(home - 1, 0, False))).otherwise(F.slice(copies[0], 1, 0)))
    copies.append(F.when(first, F.array(place(F.lit(len(bounds)), 1, False))).otherwise(F.slice(copies[0], 1, 0)))
    spread = rows.withColumn("at", F.explode(F.concat(*copies))).select("doc", "text", "at.bucket", "at.wrap", "at.real")
    order = Window.partitionBy("bucket").orderBy("wrap", F.asc_nulls_first("doc"), "text")
    return spread.withColumn("next_text", F.lead("text").over(order)), order, F.col("real")


def fingerprint_edits(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, window: int = 8) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text has its last half of code points replaced by the first as many (or all) of the next document.
    """
    rows, order, real = with_next(docs, id, text)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce(F.col("next_text"), F.lit("")), F.lit(1), half))
    rows = rows.withColumn("edited", edited).drop("next_text")
    rows = with_fingerprint(rows, "text", "own", k, window)
    rows = rows.withColumn("own_hashes", hashes(F.col("own")))
    rows = rows.withColumn("next_hashes", F.lead("own_hashes").over(order)).where(real)
    rows = with_fingerprint(rows, "edited", "other", k, window)
    rows = rows.withColumn("other_hashes", hashes(F.col("other")))
    return rows.select(
        F.col("doc").alias(id),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digest(F.col("own")).alias("fingerprint"),
        digest(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own_hashes"), F.col("other_hashes")).alias("near_edited"),
        likeness(F.col("own_hashes"), F.col("next_hashes")).alias("near_next"),
    )
