"""Decontamination and near-duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from tidewright.llm import QUERIES
from tidewright.llm.components import components
from tidewright.llm.decontaminate import FmIndex, contamination, decontaminate, merge_spans
from tidewright.llm.simhash import fuzzy_keys, near_duplicates, search_keys, simhash_components

from .cases import AWKWARD, SF, awkward, documents, empty, load

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(1)
    for size in (1, 2, 50, 400):
        text = rng.integers(1, 5, size)
        index = FmIndex(text)
        patterns = [tuple(rng.integers(1, 6, n)) for n in rng.integers(1, 5, 60)]
        rows = np.zeros((len(patterns), 4), np.int64)
        for k, p in enumerate(patterns):
            rows[k, 4 - len(p) :] = p
        low, high = index.search(rows, np.array([len(p) for p in patterns]))
        for p, a, b in zip(patterns, low, high):
            want = [i for i in range(size - len(p) + 1) if tuple(text[i : i + len(p)]) == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_spans_merge():
    assert merge_spans(np.array([5, 0, 3, 9]), np.array([8, 2, 5, 10])) == [(0, 2), (3, 8), (9, 10)]


def brute_hits(docs, items, width=10):
    windows = {}
    for name, text in items:
        words = WORD.findall(lower(text))
        for i in range(max(1, len(words) - width + 1)) if words and name is not None else ():
            windows.setdefault(tuple(words[i : i + width]), set()).add(str(name))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, names = WORD.findall(lower(text)), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (got := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    names |= got
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def test_query_contamination(spark):
    items = [tuple(r) for r in load(spark, "benchmark").select("item_id", "text").collect()]
    docs = list(documents()[["doc_id", "text"]].itertuples(index=False, name=None))
    got = sorted(map(tuple, QUERIES["op9_decontamination_fm"](spark, SF).collect()), key=repr)
    assert got == brute_hits(docs, items) and any(r[5] for r in got)


ITEMS = [
    ("a", "plain words of a plain text and some more plain words after them"),
    ("b", "long long LONG long long long long long long long long"),
    ("c", "two words"),
    ("d", None),
    ("e", "!!"),
    ("e2", "two words"),
    (None, "line one of two"),
    ("f", "Σίσυφος"),
]


@pytest.mark.parametrize("block", [40, 2_000_000])
def test_awkward_contamination(spark, block):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = awkward(spark)
    got = sorted(map(tuple, contamination(docs, items).collect()), key=repr)
    assert got == brute_hits(AWKWARD, ITEMS)
    full = decontaminate(docs.withColumn("spans", docs.key), items, block_bytes=block).collect()
    assert sorted(((r.doc_id, r.n_words, r.key) for r in full), key=repr) == sorted(((r[0], r[1], 7) for r in got), key=repr)
    clean = {r.doc_id: r.clean for r in full}
    assert clean[6] == "" and clean[8] == " " and clean[2] is None and clean[5] == "one"
    assert clean[1] == "."
    assert contamination(empty(spark), items).collect() == []
    assert not any(r.contaminated for r in contamination(docs, items.limit(0)).collect())


def test_fuzzy_keys_meet_at_one_bit():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 23, 3000)
    y = x ^ (1 << rng.integers(0, 23, 3000))
    for a, b in zip(fuzzy_keys(x), fuzzy_keys(y)):
        assert {*a.tolist()} & {*b.tolist()} - {-1}
    assert {int((r >= 0).sum()) for r in fuzzy_keys(x)} == {1, 6}


def test_keys_meet_up_to_three_bits():
    rng = np.random.default_rng(4)
    for bits in (1, 2, 3):
        for _ in range(400):
            x = rng.integers(0, 1 << 64, dtype=np.uint64)
            y = x
            for b in rng.choice(64, bits, replace=False):
                y ^= np.uint64(1) << np.uint64(b)
            a, b = ({*search_keys(np.array([v], np.uint64))[0].tolist()} for v in (x, y))
            assert a & b


def brute_components(docs):
    prints = []
    for _, text in docs:
        words = SPACED.findall(lower(text))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        counts = [0] * 64
        for s in shingles:
            h = xxhash.xxh64_intdigest(s.encode(), 42)
            for b in range(64):
                counts[b] += h >> b & 1
        prints.append(sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles)))
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(docs, prints))), key=repr)


def test_query_simhash(spark):
    docs = list(documents()[["doc_id", "text"]].itertuples(index=False, name=None))
    got = sorted(map(tuple, QUERIES["op10_simhash_golay"](spark, SF).collect()), key=repr)
    assert got == brute_components(docs)


def near_copies(n=120):
    random.seed(6)
    base = [f"w{random.randint(0, 500)}" for _ in range(400)]
    docs = []
    for i in range(n):
        words = list(base)
        for _ in range(random.randint(0, 3)):
            words[random.randrange(len(words))] = f"z{random.randint(0, 9)}"
        docs.append((1000 - i, " ".join(words)))
    return docs


def test_awkward_simhash(spark):
    docs = [*AWKWARD, *near_copies()]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, print int")
    got = sorted(map(tuple, simhash_components(df).collect()), key=repr)
    assert got == brute_components(docs)
    assert simhash_components(empty(spark)).collect() == []


def test_blocks_lose_no_link(spark, monkeypatch):
    import tidewright.llm.simhash as simhash

    docs = spark.createDataFrame(near_copies(), "doc_id long, text string")
    whole = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    plain = simhash.links
    monkeypatch.setattr(simhash, "links", lambda classes, max_bits: plain(classes, max_bits, block=7))
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == whole


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (120, 101)]
    random.seed(1)
    random.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(1, 51)}, **{i: 100 for i in range(101, 140)}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
