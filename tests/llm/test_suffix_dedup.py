"""Repeated passages and suffix arrays against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidewright.llm import QUERIES
from tidewright.llm.suffix_arrays import Block, common_prefixes, equal, search, suffix_array
from tidewright.llm.suffix_dedup import anchors, merged, remove_repeats

from .cases import AWKWARD, SF, awkward, documents, empty


def brute(docs, length):
    raws = [(t or "").encode() for _, t in docs]
    seen = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for (doc, _), raw in zip(docs, raws):
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = list(documents()[["doc_id", "text"]].itertuples(index=False, name=None))
    got = rows(QUERIES["op13_suffix_dedup"](spark, SF))
    assert got == brute(docs, 400) and any(r[2] for r in got)


def test_query_gives_what_remains(spark, tmp_path):
    random.seed(5)
    words = lambda n, k: " ".join("".join(random.choices("abcdefgh", k=k)) for _ in range(n))
    long, short = words(60, 7), words(60, 4)
    assert len(short) < 400 <= len(long)
    # The first byte of these characters is the same: it goes with the passage, the last byte stays.
    docs = [(1, "Zoë " + words(30, 5) + "1" + long + "é" + words(9, 5)), (2, words(20, 6) + "2" + long + "è"), (3, "3" + short + "3"), (4, "4" + short + "4")]
    docs += [(5, words(200, 5)), (6, None), (7, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_suffix_dedup"](spark, str(tmp_path))
    assert rows(got) == brute(docs, 400)
    text = {r.doc_id: r.text for r in got.collect()}
    for doc, before in docs[:2]:
        head, tail = before.split(long)
        assert text[doc] == head + (tail.encode()[1:]).decode(errors="replace") and "\ufffd" in text[doc]
    assert all(text[doc] == before for doc, before in docs[2:])


def passages(n=150, seed=3):
    """Few letters, shared passages, edited copies, runs, and one passage that a third of all texts hold."""
    random.seed(seed)
    letters = "abé"
    word = lambda k: "".join(random.choices(letters, k=k))
    shared, hot = [word(random.randint(20, 90)) for _ in range(6)], word(47)
    docs = []
    for i in range(n):
        parts = [word(random.randint(0, 60))]
        if i % 3 == 0:
            parts += [hot, word(random.randint(0, 30))]
        if i % 4 == 0:
            parts += [random.choice(shared), word(9)]
        if i % 10 == 0:
            parts.append("ab" * random.randint(5, 60))
        docs.append((i, "".join(parts)))
    for i in range(20):
        text = list(docs[i][1])
        if text:
            text[random.randrange(len(text))] = "z"
        docs.append((1000 + i, "".join(text)))
    return docs + docs[:5]


@pytest.mark.parametrize("most,piece", [(1024, 1 << 20), (1024, 700), (7, 1 << 20), (3, 500), (1, 1 << 20)])
def test_passages_equal_brute_force(spark, most, piece):
    docs = passages()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(remove_repeats(df, length=32, gram=8, most=most, piece_bytes=piece)) == brute(docs, 32)


def test_awkward(spark):
    want = brute(AWKWARD, 400)
    df = awkward(spark).withColumnRenamed("n", "n_bytes")
    got = remove_repeats(df)
    assert rows(got) == want
    found = got.collect()
    assert set(got.columns) == {"doc_id", "score", "key", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"}
    assert {r.doc_id: r.kept for r in found}[2] is None and all(r.key == 7 for r in found)
    assert rows(remove_repeats(empty(spark))) == []
    short = [(d, t) for d, t in AWKWARD if t is None or len(t) < 100]
    assert rows(remove_repeats(spark.createDataFrame(short, "doc_id long, text string"))) == brute(short, 400)


def test_anchors_do_not_depend_on_parts():
    random.seed(1)
    raws = ["".join(random.choices("abc", k=n)).encode() for n in (10, 400, 33, 32)]

    def of_strings(most):
        rows = list(anchors(raws, 32, 8, most))
        return {(t, i): (at, key) for t, at, key, first, last in rows for i in range(first, last + 1)}

    want = of_strings(1 << 20)
    # Every string has one anchor, which lies in it.
    assert set(want) == {(t, i) for t, raw in enumerate(raws) for i in range(len(raw) - 31)}
    assert all(i <= at <= i + 24 for (_, i), (at, _) in want.items())
    for most in (1, 7, 100):
        assert of_strings(most) == want


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for letters, size in ((1, 50), (2, 300), (5, 1000), (200, 400)):
        parts = [bytes(rng.integers(0, letters, size).astype(np.uint8)) for _ in range(3)]
        data, depth = b"".join(parts), 24
        block = Block(data, depth)
        sa = suffix_array(block)
        assert sa.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        cut = [(data + bytes(200))[i : i + 24] for i in sa]
        lengths = np.full(3, size)
        for short in (0, 30):  # all positions, and those before the last ones of each text
            wanted = np.tile(np.arange(size) < size - short, 3)
            order = sa[wanted[sa]]
            some = [(data + bytes(200))[i : i + 24] for i in order]
            lcp = common_prefixes(block, order, wanted, np.cumsum(lengths) - lengths, lengths - short, depth)
            for k in range(1, len(order)):
                a, b = some[k - 1], some[k]
                assert lcp[k] == next((i for i in range(24) if a[i] != b[i]), 24)
        other = Block(data[::-1], depth)
        at = np.arange(0, len(data) - depth, 7)
        place = search(block, sa, other, at, depth)
        for q, p in zip(at, place):
            s = data[::-1][q : q + 24]
            assert p == sum(c < s for c in cut)
        ok = place < len(sa)
        assert equal(block, sa[place[ok]], other, at[ok], depth).tolist() == [cut[p] == data[::-1][q : q + 24] for q, p in zip(at[ok], place[ok])]


def test_merged():
    assert merged(np.array([5, 0, 2, 20]), np.array([8, 2, 5, 21])) == ([0, 20], [8, 21])
    assert merged(np.array([]), np.array([])) == ([], [])
