"""Figures of op1 and op4 against plain Python over whole tables."""

import bisect
import math

import pytest
import xxhash

from tidewright.llm import QUERIES
from tidewright.llm.quality_gam import figures, fit_quality

from .cases import SF, documents, load

PRIME, BASE = (1 << 31) - 1, 1_000_003


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_hashes(text, k=5, window=8):
    """The distinct hashes of the k-grams that are chosen as the rightmost least of their windows."""
    words = text.lower().split()
    h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) % PRIME for w in words]
    grams = [sum(x * pow(BASE, k - 1 - j, PRIME) for j, x in enumerate(h[i : i + k])) % PRIME for i in range(len(h) - k + 1)]
    if words and len(words) < k:
        grams = [signed(xxhash.xxh64_intdigest(" ".join(words).encode(), 42)) % PRIME]
    places = set()
    for i in range(max(1, len(grams) - window + 1)) if grams else ():
        part = grams[i : i + window]
        places.add(i + max(j for j, x in enumerate(part) if x == min(part)))
    return {grams[p] for p in places}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_of_every_document(spark):
    docs = documents()[["doc_id", "text"]].fillna("").sort_values("doc_id")
    rows = list(docs.itertuples(index=False, name=None))
    got = {r.doc_id: r for r in QUERIES["op4_winnowing"](spark, SF).collect()}
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        own, edited = brute_hashes(text), brute_hashes(text[: len(text) - half] + after[:half])
        assert got[doc].near_edited == pytest.approx(jaccard(own, edited), abs=1e-12)
        assert got[doc].near_next == pytest.approx(jaccard(own, brute_hashes(after)), abs=1e-12)


def test_margin_of_every_document(spark):
    """The scores of the query are the sums of its tables' entries, looked up one by one."""
    docs, labels = load(spark, "documents"), load(spark, "labels")
    model = fit_quality(docs, labels)
    got = {r.doc_id: r for r in QUERIES["op1_quality_gam"](spark, SF).collect()}
    for doc, text in documents()[["doc_id", "text"]].itertuples(index=False, name=None):
        x = figures([None if text is None else text.encode()])[0]
        at = [bisect.bisect_right(list(edges), v) for edges, v in zip(model.edges, x)]
        margin = model.base + sum(float(t[k]) for t, k in zip(model.tables, at))
        margin += sum(float(t[ci[at[i]]][cj[at[j]]]) for i, j, ci, cj, t in model.pairs)
        assert got[doc].score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, margin)))), abs=1e-9)
        assert got[doc].predicted == int(got[doc].score >= 0.7)
