"""Winnowing, line spread and license scans against brute force and SQL."""

import hashlib
import re

import pytest
from tests.compare import compare, oracle_connection

from tidewright.llm import ORACLES, QUERIES
from tidewright.llm.license_scan import PHRASES, license_labels, rules, scan_licenses
from tidewright.llm.line_dedup import dedup_lines
from tidewright.llm.winnowing import fingerprint_edits, fingerprints

from .cases import AWKWARD, SF, awkward, documents, empty, load


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    verdict, detail = compare(spark, oracle_connection(SF), name, QUERIES[name], ORACLES[name], SF)
    assert verdict == "EXACT", detail


def brute_prints(grams, window):
    """Chosen (hash, position) of every window, the rightmost of the least."""
    if not grams:
        return []
    chosen = set()
    for i in range(max(1, len(grams) - window + 1)):
        part = grams[i : i + window]
        least = min(part)
        chosen.add(i + max(j for j, h in enumerate(part) if h == least))
    return [(grams[i], i) for i in sorted(chosen)]


@pytest.mark.parametrize("k,window", [(5, 8), (1, 1), (3, 5), (4, 2), (6, 7)])
def test_windows_choose_the_rightmost_least(spark, k, window):
    docs = spark.createDataFrame([(1, "a b a b a b c a b a b a b a b c d e f a b"), (2, "a b"), (3, " "), (4, None)], "doc_id long, text string")
    every = {r.doc_id: [e.hash for e in r.fingerprint] for r in fingerprints(docs, k=k, window=1).collect()}
    got = {r.doc_id: [tuple(e) for e in r.fingerprint] for r in fingerprints(docs, k=k, window=window).collect()}
    n = {1: max(1, 22 - k), 2: max(1, 3 - k), 3: 0, 4: 0}
    words = ["a b a b a b c a b a b a b a b c d e f a b".split(), ["a", "b"]]
    for doc, text in zip((1, 2), words):
        assert len(every[doc]) == n[doc]
        grams = [tuple(text[i : i + k]) for i in range(max(1, len(text) - k + 1))]
        assert len(set(zip(grams, every[doc]))) == len(set(grams)) == len(set(every[doc]))
    for doc in every:
        assert got[doc] == brute_prints(every[doc], window)


def test_shared_passages_share_entries(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = spark.createDataFrame([(i, " ".join(f"x{i}{j}" for j in range(i)) + f" {passage} " + " ".join(f"y{i}{j}" for j in range(20))) for i in range(9)], "doc_id long, text string")
    found = [{e.hash for e in r.fingerprint} for r in fingerprints(docs).collect()]
    assert all(a & b for a in found for b in found)


def edits(rows):
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        yield doc, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()


@pytest.mark.parametrize("awk", [True, False])
def test_edits(spark, awk, monkeypatch):
    import tidewright.llm.winnowing as winnowing

    if awk:
        plain = winnowing.bucket_bounds
        monkeypatch.setattr(winnowing, "bucket_bounds", lambda df, key, n: plain(df, key, 2))
        rows, docs = AWKWARD, fingerprint_edits(awkward(spark))
    else:
        rows, docs = list(documents()[["doc_id", "text"]].itertuples(index=False, name=None)), QUERIES["op4_winnowing"](spark, SF)
    got = docs.collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(edits(rows), key=repr)
    prints = {}
    texts = dict(rows)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault((texts[r.doc_id] or ""), set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert fingerprint_edits(empty(spark)).collect() == []


def test_likeness(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text), (2, text), (3, "quite another text of a few more words than five")]
    got = {r.doc_id: r for r in fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].near_next == 1.0 and got[2].near_next == 0.0 and got[1].fingerprint == got[2].fingerprint
    assert 0.2 < got[1].near_edited < 0.8


def brute_lines(rows, min_sites=2):
    docs = list(dict.fromkeys((d, t, s) for d, t, s in rows if t is not None))
    sites, first = {}, {}
    for d, t, s in docs:
        for pos, line in enumerate(t.split("\n")):
            line = line.strip(" ")
            n = len([w for w in line.replace("\t", " ").split(" ") if w])
            if n >= 3:
                sites.setdefault(line, set()).add((d, t) if n > 50 else ("s", s or ""))
                first.setdefault(line, []).append((d, t, pos))
    gone = set()
    for line, where in sites.items():
        if len(where) >= min_sites:
            keep = min(first[line], key=lambda x: (x[0] is not None, x[0] or 0))
            gone |= {x for x in first[line] if x != keep}
    out = []
    for d, t, _ in rows:
        kept = None if t is None else "\n".join(x for pos, x in enumerate(t.split("\n")) if (d, t, pos) not in gone)
        out.append((d, kept))
    return sorted(out, key=repr)


def test_lines(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(d, t, "s") for d, t in AWKWARD] + [
        (20, f"a common line here\nown line of twenty\n{passage}", "a"),
        (21, f"  a common line here \nown line of 21\n{passage}\n", "a"),
        (22, "a common line here\na common line here\nsame site only line", "b"),
        (23, "same site only line\nshort one", "b"),
        (24, "short one\nno source line", None),
        (25, "no source line\nno source line", None),
        (26, "no source line", "c"),
    ]
    df = spark.createDataFrame([(d, t, s, 1, 2) for d, t, s in rows], "doc_id long, text string, source string, n_lines int, h1 int")
    got = dedup_lines(df)
    assert got.columns == ["doc_id", "text", "source", "h1", "n_lines", "n_removed"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute_lines(rows)
    assert dedup_lines(df.limit(0)).collect() == []


@pytest.mark.parametrize("min_sites", [3, 12, 40])
def test_spread_near_and_far_from_the_threshold(spark, min_sites):
    rows = [(1000 * k + i, f"line number {k} of all", f"s{i}") for k in range(1, 60, 3) for i in range(k)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r.doc_id, r.text) for r in dedup_lines(df, min_sites=min_sites).collect()), key=repr)
    assert got == brute_lines(rows, min_sites)


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_licenses(text):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    places = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    found = []
    for n, (label, priority, keyword, pattern) in enumerate(rules()):
        if keyword in words:
            found += [(m.start(), m.end(), priority, n, label) for m in re.finditer(pattern, " ".join(words))]
    kept = set()
    for x in found:
        inside = [y for y in found if y != x and y[0] <= x[0] and y[1] >= x[1] and y[2] >= x[2]]
        if not any((y[0], y[1]) != (x[0], x[1]) or (-y[2], y[3]) < (-x[2], x[3]) for y in inside):
            kept.add(x[4])
    starts, base = [i for i, _ in places], {label for _, label in places}
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | kept))
    )


LICENSE_TEXTS = [
    "Licensed under the Apache License, Version 2.0. Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3 or any later version.",
    "SPDX-License-Identifier: GPL-3.0-or-later\nCopyright (c) 2020 X. All rights reserved.",
    "CC BY-NC 4.0, CC-BY and cc by sa; CCBY, acc by, cc, by. gnu GENERAL public\nlicense",
    "GNU Lesser General Public License v2.1; BSD-style license; Creative Commons Attribution ShareAlike 4.0 International",
    "mit license " * 400,
    "mit licenses summit license KIT LICENSE MİT LICENSE",
    "The Unlicense: free and unencumbered software released into the public domain.",
]


def test_licenses(spark):
    rows = [*AWKWARD, *((100 + i, t) for i, t in enumerate(LICENSE_TEXTS))]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_words int, detections string")
    got = license_labels(df).collect()
    assert sorted(((r.doc_id, *r[1:7]) for r in got), key=repr) == sorted(((d, *brute_licenses(t)) for d, t in rows), key=repr)
    by_doc = {r.doc_id: r for r in got}
    assert by_doc[100].labels == "apache,apache-2.0,mit" and by_doc[101].labels == "gpl,gpl-3.0"
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got)
    assert license_labels(empty(spark)).collect() == []
    assert scan_licenses(df).columns == ["doc_id", "text", "n_words", "places", "detections"]


def test_query_licenses(spark):
    got = {r.doc_id: tuple(r[1:7]) for r in QUERIES["op7_license_rules"](spark, SF).collect()}
    assert got == {d: brute_licenses(t) for d, t in documents()[["doc_id", "text"]].itertuples(index=False)}
    assert any(labels for *_, labels in got.values())


def test_rules_are_sound():
    table = rules()
    assert len(table) > 200
    for label, priority, keyword, pattern in table:
        assert re.compile(pattern) and priority in (1, 2, 3) and keyword == keyword.lower() and label
