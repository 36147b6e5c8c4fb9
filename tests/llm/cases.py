"""Small tables with every awkward row: NULLs, empty and very long texts, ties, repeats, clashing columns."""

from pathlib import Path

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"

AWKWARD = [
    (1, "Plain words of a plain text, and some more plain words after them."),
    (2, None),
    (3, ""),
    (4, "   \n\t  "),
    (5, "one"),
    (6, "two words"),
    (7, "Plain words of a plain text, and some more plain words after them."),
    (7, "Plain words of a plain text, and some more plain words after them."),
    (None, "a text without an id, long enough to be cut into several shingles"),
    (8, "long " * 30_000),
    (9, "x" * 200_000),
    (10, "ÀÉÎ ǅ ﬁ Σίσυφος ΣΑΣ İstanbul é ẛ̣ Ω Å 漢字   nbsp em\x1cfs\x85nel 👩‍👩‍👧 ½ Ⅷ ٣"),
    (11, "tail <|endoftext|>and<|startoftext|> <|ENDOFTEXT|> it's they'll 'S 12ab3 ###a!!b"),
    (12, "line one of two\n\nline one of two\nlast line here"),
]


def awkward(spark, extra=True):
    rows = [(d, t, "x", 1.5, 7) for d, t in AWKWARD]
    # Columns with names that operators use themselves.
    df = spark.createDataFrame(rows, "doc_id long, text string, score string, n double, key int")
    return df if extra else df.select("doc_id", "text")


def empty(spark):
    return awkward(spark).limit(0)


def documents(folder=SF):
    return pq.read_table(Path(folder) / "documents.parquet").to_pandas()


def load(spark, name, folder=SF):
    return spark.read.parquet(f"{folder}/{name}.parquet")
