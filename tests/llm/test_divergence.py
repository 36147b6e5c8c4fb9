"""Source divergence against brute force on awkward tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewright.llm.divergence import Levels, divergence, joint_divergence, price

from .cases import AWKWARD, empty

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(docs, least=30, most=50):
    """docs: (text, lang, source)"""
    groups, langs, seen = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        words = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups[lang or "", source or ""].update(words)
        langs[lang or ""].update(words)
        seen[lang or ""].update(set(words))
    out = []
    for (lang, source), own in groups.items():
        kept = sorted(t for t, d in seen[lang].items() if d >= least)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[t] for t in kept) + 5 * len(kept)) for t in kept}
        p, q = share(own), share(langs[lang])
        pairs = []
        for (lang2, item), other in groups.items():
            if lang2 == lang and item != source:
                r = share(other)
                pairs.append((-sum(abs(p[t] - r[t]) for t in kept), item.encode(), item))
        terms = [(q[t] - p[t], t.encode(), t) for t in kept if own[t] > 0 and p[t] > q[t]]
        for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
            out += [(lang, source, part, item, -v, k) for k, (v, _, item) in enumerate(rows, 1)]
    return sorted(out)


def docs_of(n=160):
    random.seed(5)
    words = [f"{a}{b}" for a in "abcdeéß漢" for b in "xyzuvw"]
    rows = []
    for i in range(n):
        lang = random.choice(["en", "en", "de", None, ""])
        source = random.choice(["s0"] * 4 + ["s1", "s2", None, "", "é", "z" * 40])
        text = " ".join(random.choices(words[: random.randint(3, 40)], k=random.randint(0, 60)))
        rows.append((text.upper() if i % 7 == 0 else text.replace(" ", "1", 3), lang, source))
    rows += [(t, "en", "s9") for _, t in AWKWARD] + [(None, "xx", "a"), ("", "xx", "b"), ("rare words", "xx", None)]
    return rows + rows[:20]


@pytest.mark.parametrize("least,terms,sources", [(30, 512, 64), (3, 4, 2), (10**6, 512, 64)])
def test_equals_brute_force(spark, least, terms, sources):
    rows = docs_of()
    df = spark.createDataFrame([(t, l, s, 1, "x", 2.0) for t, l, s in rows], "text string, lang string, source string, n int, term string, value double")
    got = divergence(df, min_docs=least, block_terms=terms, block_sources=sources)
    assert sorted(map(tuple, got.collect())) == brute(rows, least)


def test_empty_table(spark):
    df = empty(spark).selectExpr("text", "score AS lang", "score AS source")
    assert divergence(df).collect() == []


def test_panels_and_prices_are_exact(monkeypatch):
    import pandas as pd

    import tidewright.llm.divergence as module

    monkeypatch.setattr(module, "PANEL", 7)
    rng, terms = np.random.default_rng(3), np.array([f"t{k:03}" for k in range(90)], object)
    rows = pd.DataFrame([(f"s{s}", t, int(rng.integers(0, 10**14)) if s else int(rng.integers(0, 4))) for s in range(5) for t in terms], columns=["source", "term", "n"])
    rows = rows[(rows["n"] > 0)].assign(kinds=90)
    rows["total"] = rows.groupby("source")["n"].transform("sum")
    levels = Levels(rows, terms)
    got = joint_divergence(levels, levels)
    counts = rows.set_index(["source", "term"])["n"].to_dict()
    total = rows.groupby("source")["n"].sum()
    for i in range(5):
        for j in range(5):
            share = [[price(counts.get((f"s{s}", t), 0), int(total[f"s{s}"]), 90) for t in terms] for s in (i, j)]
            assert got[i, j] == sum(abs(a - b) for a, b in zip(*share))
