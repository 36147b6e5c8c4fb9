"""Collocations and their automata against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewright.llm.automata import Automaton, first_not_below, sum_paths
from tidewright.llm.collocations import collocations, find_ranges, frequent_phrases

from .cases import AWKWARD, empty


def brute(docs, least=30, share=80, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts[lang].update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        chosen, rows = [p for p, a in f.items() if len(p) > 1 and a >= least], []
        gone = {p[i : i + m] for p in chosen for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * f[p] >= share * f[p[i : i + m]]}
        for p in chosen:
            if p not in gone:
                score, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts(n=300):
    random.seed(9)
    words = ["the", "of", "New", "york", "city", "é", "漢字", "x\x1cy", "\x00", "a-b", "ou"] + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(random.randint(0, 30)):
            parts += random.choice([["New", "York", "city"], ["of", "the"], random.choices(words, k=3), ["the"], ["in", "the", "long", "run"]])
            parts += random.choice([[], [], [","], ["!\n"], ["."]])
        rows.append((random.choice([" ", "  ", "\t"]).join(parts), random.choice(["en", "en", "en", None, "", "de"])))
    return rows + [(t, "en") for _, t in AWKWARD] + rows[:9] + [(None, "xx"), ("", "yy")]


@pytest.mark.parametrize("range_paths,most_words,most_paths", [(4_000_000, 60_000, 2_000_000), (800, 60_000, 3000), (64, 20, 200)])
def test_equals_brute_force(spark, range_paths, most_words, most_paths):
    docs = texts()
    df = spark.createDataFrame([(t, l, 1, "z", 2.0) for t, l in docs], "text string, lang string, n int, phrase string, f double").repartition(3)
    got = collocations(df, range_paths=range_paths, most_words=most_words, most_paths=most_paths)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(docs)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_bounds_only_balance(spark):
    df = spark.createDataFrame(texts(), "text string, lang string")
    assert find_ranges(df, "text", "lang").bounds == []
    cut = find_ranges(df, "text", "lang", 200).bounds
    assert len(cut) > 10 and cut == sorted(cut)
    counts = [sorted((r.lang, r.phrase or "", r.f) for r in frequent_phrases(df, least=5, range_paths=n).collect()) for n in (200, 1 << 20)]
    assert counts[0] == counts[1]


def test_few_rows_and_lowest_top(spark):
    assert collocations(empty(spark).withColumnRenamed("score", "lang")).collect() == []
    docs = texts(60)
    df = spark.createDataFrame(docs, "text string, lang string")
    assert sorted(map(tuple, collocations(df, least=3, top=5).collect())) == brute(docs, 3, top=5)
    assert collocations(df, least=10**6).collect() == []


def test_automata_keep_paths_and_weights():
    rng = np.random.default_rng(2)
    for letters, n in ((1, 5), (3, 400), (40, 3000), (70_000, 500)):
        paths = rng.integers(1, letters + 1, (n, 4))
        for k, end in enumerate(rng.integers(1, 5, n)):
            paths[k, end:] = 0
        paths, weights = sum_paths(paths, rng.integers(1, 4, n))
        assert [tuple(p) for p in paths] == sorted({tuple(p) for p in paths})
        words = [f"{k:06}".encode() for k in range(letters)]
        automaton = Automaton.from_sorted(words, paths, weights)
        again = Automaton.unpack(automaton.pack())
        for a in (automaton, again):
            got = a.paths()
            assert a.words == words and (got[0] == paths).all() and (got[1] == weights).all()
        assert (automaton.compose(paths) == weights).all()
        assert not automaton.compose(paths + (paths[:, :1] * 0 + [[letters, 0, 0, 0]])).any()
        for bound in ([words[0]], [b"zzz"], [words[-1], b"0000005"], [b""]):
            number = [tuple(words[w - 1] for w in p if w) for p in paths]
            assert first_not_below(words, paths, bound) == sum(p < tuple(bound) for p in number)
    # States with the same arcs are one.
    paths = np.array([[a, b, 7, 8] for a in range(1, 6) for b in range(1, 6)])
    small = Automaton.from_sorted([], paths, np.ones(25, np.int64))
    assert [len(level[1]) for level in small.levels] == [5, 5, 1, 1]
    none = Automaton.from_sorted([], np.zeros((0, 4), np.int64), np.zeros(0, np.int64))
    assert none.paths()[0].shape == (0, 4) and none.compose(paths).tolist() == [0] * 25
