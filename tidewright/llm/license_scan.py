"""License detection by ordered signature rules, in built-in functions only.

Texts are read as words (letters, digits and what lies beyond ASCII, A-Z in lower case) with single spaces between.
A text without any of the rules' keywords is done after one look. For the others, every rule whose keyword is among
the text's words is matched; its detections are intervals. Rules have a priority: identifiers (3) before notices (2)
before bare names (1). A detection inside another one of equal or higher priority is suppressed (of two equal intervals the
one of higher priority, then of the earlier rule, stays); detections that merely overlap all stay.

Four phrases are always reported by their places, and their labels stay whatever the rules say. NULL and empty texts
have no words, places or labels and score 0. Repeated rows get equal results. The number of detections of a text is
bounded by its length; they are listed and resolved in ordered passes whose arrays grow by chunks, so the work on a text
full of notices grows with their number.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, keyword and name of each license as it reads in normalised words. More special names stand first.
NAMES = (
    ("gpl-3.0", "gnu", r"gnu general public licen[cs]e(?: (?:version|v) 3(?: 0)?| v3(?: 0)?)"),
    ("gpl-2.0", "gnu", r"gnu general public licen[cs]e(?: (?:version|v) 2(?: 0)?| v2(?: 0)?)"),
    ("gpl-1.0", "gnu", r"gnu general public licen[cs]e(?: (?:version|v) 1(?: 0)?| v1(?: 0)?)"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl (?:version |v )?3(?: 0)?"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl (?:version |v )?2(?: 0)?"),
    ("gpl-3.0", "gplv3", r"(?:gnu )?gplv3"),
    ("gpl-2.0", "gplv2", r"(?:gnu )?gplv2"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: (?:version|v) 3(?: 0)?| v3(?: 0)?)"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: (?:version|v) 2 1| v2 1)"),
    ("lgpl-2.0", "library", r"(?:gnu )?library general public licen[cs]e(?: (?:version|v) 2(?: 0)?| v2)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: (?:version |v )?[23](?: [01])?)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[cs]e(?: (?:version|v) 3(?: 0)?| v3(?: 0)?)?"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl(?: (?:version |v )?3(?: 0)?)?"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[cs]e(?: (?:version|v) 1 [123])?"),
    ("gpl", "gnu", r"gnu general public licen[cs]e"),
    ("gpl", "gpl", r"gnu gpl"),
    ("apache-2.0", "apache", r"apache licen[cs]e(?: (?:version|v))? 2(?: 0)?"),
    ("apache-1.1", "apache", r"apache software licen[cs]e(?: (?:version|v))? 1 1"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e"),
    ("apache-2.0", "apache", r"apache 2(?: 0)? licen[cs]e"),
    ("mit", "mit", r"mit licen[cs]e"),
    ("mit", "expat", r"expat licen[cs]e"),
    ("mit-0", "mit", r"mit no attribution(?: licen[cs]e)?"),
    ("x11", "x11", r"x11 licen[cs]e"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("bsd-4-clause", "bsd", r"(?:4|four) clause bsd licen[cs]e"),
    ("bsd-3-clause", "bsd", r"(?:3|three) clause bsd licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:2|two) clause bsd licen[cs]e"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised) bsd licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd) bsd licen[cs]e"),
    ("bsd-0-clause", "bsd", r"(?:0|zero) clause bsd(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: (?:version|v))? 2(?: 0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: (?:version|v))? 1 1"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("mpl", "mpl", r"mpl (?:version |v )?[12] [01]"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: (?:version|v))? 2(?: 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?: (?:version|v))? 1(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("cddl", "cddl", r"cddl(?: (?:version |v )?1 [01])?"),
    ("cddl", "distribution", r"common development and distribution licen[cs]e"),
    ("cpl-1.0", "common", r"common public licen[cs]e"),
    ("eupl", "eupl", r"eupl(?: (?:version |v )?1 [012])?"),
    ("eupl", "union", r"european union public licen[cs]e"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: (?:version|v))? 2(?: 0)?"),
    ("artistic", "artistic", r"artistic licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e(?: (?:version|v)? ?1 0)?"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e"),
    ("psf", "python", r"python software foundation licen[cs]e"),
    ("php", "php", r"php licen[cs]e(?: (?:version |v )?3(?: 01)?)?"),
    ("ruby", "ruby", r"ruby licen[cs]e"),
    ("ofl-1.1", "sil", r"sil open font licen[cs]e"),
    ("ofl-1.1", "font", r"open font licen[cs]e"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("odbl", "database", r"open (?:data commons open )?database licen[cs]e"),
    ("odc-by", "commons", r"open data commons attribution licen[cs]e"),
    ("pddl", "commons", r"open data commons public domain dedication(?: and licen[cs]e)?"),
    ("upl-1.0", "universal", r"universal permissive licen[cs]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e"),
    ("afl-3.0", "academic", r"academic free licen[cs]e"),
    ("osl-3.0", "open", r"open software licen[cs]e"),
    ("qpl", "q", r"q public licen[cs]e"),
    ("vim", "vim", r"vim licen[cs]e"),
    ("beerware", "beer", r"beer ware licen[cs]e"),
    ("beerware", "beerware", r"beerware licen[cs]e"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("bsl-1.1", "business", r"business source licen[cs]e"),
    ("sspl", "sspl", r"sspl"),
    ("sspl", "server", r"server side public licen[cs]e"),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "creative", r"creative commons zero"),
)

#: Conditions and versions of the Creative Commons licenses.
CC_TERMS = ("by nc sa", "by nc nd", "by nc", "by sa", "by nd", "by")
CC_WORDS = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?derivati(?:ve)?s?(?: works)?"}

#: Statements that name no license.
STATEMENTS = (
    ("all-rights-reserved", 2, "reserved", r"all rights (?:are )?reserved"),
    ("copyright", 1, "copyright", r"copyright (?:c )?(?:19|20)\d\d"),
    ("public-domain", 2, "domain", r"(?:released|placed|dedicated|is|are) (?:in|into|to) the public domain"),
    ("proprietary", 2, "proprietary", r"proprietary and confidential"),
    ("proprietary", 2, "proprietary", r"proprietary licen[cs]e"),
    ("commercial", 2, "commercial", r"commercial licen[cs]e"),
    ("no-warranty", 1, "warranty", r"without warranty of any kind"),
    ("no-warranty", 1, "warranties", r"without warranties or conditions of any kind"),
    ("mit", 2, "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 2, "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 2, "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("gpl", 2, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("zlib", 2, "warranty", r"this software is provided as is without any express or implied warranty"),
    ("bsl-1.0", 2, "permission", r"permission is hereby granted free of charge to any person or organization"),
    ("unlicense", 2, "unencumbered", r"free and unencumbered software released into the public domain"),
)

#: What introduces a license in a notice.
NOTICE = (
    r"(?:(?:is |are |was |be )?(?:dual )?(?:re)?licen[cs]ed|(?:is |are )?released|(?:is |are )?distributed|(?:is |are )?"
    r"(?:made )?available|published|provided|covered) (?:under|by|with|subject to)(?: the)?(?: terms of)?(?: the)?"
)

CONFIDENCE = {3: 1.0, 2: 0.95, 1: 0.8}


def _spdx(label: str) -> str:
    """A short identifier as it reads in normalised words, with what may follow it."""
    return label.replace("-", " ").replace(".", " ") + r"(?: (?:only|or later))?"


def rules() -> list[tuple[str, int, str, str]]:
    """(label, priority, keyword, pattern) of every rule, in order: each name as identifier, notice and bare name."""
    out: list[tuple[str, int, str, str]] = []
    labels = dict.fromkeys(label for label, *_ in NAMES)
    out += [(label, 3, "spdx", rf"spdx licen[cs]e identifier {_spdx(label)}") for label in labels]
    creative = []
    for terms in CC_TERMS:
        label = "cc-" + terms.replace(" ", "-")
        spelt = " ".join(CC_WORDS[t] for t in terms.split())
        for version in (r" 1 0", r" 2 0", r" 2 5", r" 3 0", r" 4 0", ""):
            suffix = version.strip().replace(" ", ".")
            creative.append((f"{label}-{suffix}" if suffix else label, "cc", rf"(?:creative commons )?cc {terms}{version}"))
        creative.append((label, "creative", rf"creative commons {spelt}(?: \d \d)?(?: international| unported| generic)?"))
    out += [(label, 3, "spdx", rf"spdx licen[cs]e identifier {pattern}") for label, _, pattern in creative]
    for label, keyword, name in (*NAMES, *creative):
        out.append((label, 2, keyword, rf"{NOTICE} {name}(?: licen[cs]e)?(?: or (?:\(?at your option\)? )?any later version)?"))
        out.append((label, 1, keyword, name))
    out += [(label, priority, keyword, pattern) for label, priority, keyword, pattern in STATEMENTS]
    return [(label, priority, keyword, rf"(?<![^ ]){pattern}(?![^ ])") for label, priority, keyword, pattern in out]


#: A run of these is a word, before A-Z are lowered.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _gate(table: list[tuple[str, int, str, str]]) -> str:
    """One pattern for all keywords, grouped by first letter."""
    words = sorted({k for _, _, k, _ in table} | {w for p in PHRASES for w in (p.split()[0],)})
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[0], []).append(w[1:])
    return r"(?i)(?<![a-z0-9])(?:" + "|".join(f"{h}(?:{'|'.join(tails)})" for h, tails in sorted(heads.items())) + r")(?![a-z0-9])"


def _places(words: Column) -> Column:
    """(start, label) of every place of a fixed phrase, in order of the phrases."""

    def starts(phrase: str, label: str) -> Column:
        parts = phrase.split()
        hits = F.filter(F.transform(words, lambda w, i: F.when(w == parts[0], i)), lambda i: i.isNotNull())
        for ahead, part in enumerate(parts[1:], 1):
            hits = F.filter(hits, _follows(words, ahead, part))
        return F.transform(hits, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    return F.flatten(F.array(*[starts(p, label) for p, label in PHRASES.items()]))


def _follows(words: Column, ahead: int, part: str):
    return lambda i: F.coalesce(F.get(words, i + ahead) == part, F.lit(False))


def _detections(text: Column, table: Column, words: Column) -> Column:
    """Intervals of all rules whose keyword is among the words, ordered by start, then longest and strongest first."""
    chosen = F.filter(table, lambda r: F.array_contains(words, r["keyword"]))

    def intervals(rule: Column) -> Column:
        found = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
        gaps = F.transform(F.split(text, rule["pattern"], -1), lambda g: F.length(g))
        # The gap before each match goes with it: an expression inside the step would be computed again for every match.
        met = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("match")), lambda z: z["match"].isNotNull())
        nothing = F.struct(F.lit(0).alias("at"), *_chunks(_interval(rule, F.lit(0), F.lit(0))))

        def step(acc: Column, z: Column) -> Column:
            start = acc["at"] + z["gap"]
            end = start + F.length(z["match"])
            return F.struct(end.alias("at"), *_appended(acc, _interval(rule, start, end)))

        return F.aggregate(met, nothing, step, _whole)

    return F.array_sort(F.flatten(F.transform(chosen, intervals)))


#: Elements of a chunk of a growing array: appending copies a chunk and the list of chunks, not all that came before.
CHUNK = 256


def _chunks(like: Column) -> list[Column]:
    """The fields of an empty growing array of such elements."""
    none = F.slice(F.array(like), 1, 0)
    return [F.slice(F.array(none), 1, 0).alias("done"), none.alias("open")]


def _appended(acc: Column, x: Column) -> list[Column]:
    full = F.size(acc["open"]) >= CHUNK
    done = F.when(full, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
    return [done.alias("done"), F.when(full, F.array(x)).otherwise(F.concat(acc["open"], F.array(x))).alias("open")]


def _whole(acc: Column) -> Column:
    return F.flatten(F.concat(acc["done"], F.array(acc["open"])))


def _interval(rule: Column, start: Column, end: Column) -> Column:
    return F.struct(
        start.alias("start"), (-end).alias("last"), (-rule["priority"]).alias("weight"), rule["number"].alias("rule"), rule["label"].alias("label")
    )


def _resolved(sorted_intervals: Column) -> Column:
    """Intervals that no earlier one of equal or higher priority contains; one ordered pass."""
    none = F.lit(0)
    like = F.struct(none.alias("start"), none.alias("end"), none.alias("priority"), F.lit("").alias("label"))
    start = F.struct(F.lit(-1).alias("p1"), F.lit(-1).alias("p2"), F.lit(-1).alias("p3"), *_chunks(like))

    def step(acc: Column, x: Column) -> Column:
        end, priority = -x["last"], -x["weight"]
        reach = F.when(priority == 1, F.greatest(acc["p1"], acc["p2"], acc["p3"])).when(priority == 2, F.greatest(acc["p2"], acc["p3"])).otherwise(acc["p3"])
        further = [F.when(priority == p, F.greatest(acc[f"p{p}"], end)).otherwise(acc[f"p{p}"]).alias(f"p{p}") for p in (1, 2, 3)]
        held = [acc["done"], acc["open"]]
        grown = [F.when(reach >= end, old).otherwise(new).alias(name) for old, new, name in zip(held, _appended(acc, _public(x)), ("done", "open"))]
        return F.struct(*further, *grown)

    return F.aggregate(sorted_intervals, start, step, _whole)


def _public(x: Column) -> Column:
    return F.struct(x["start"].alias("start"), (-x["last"]).alias("end"), (-x["weight"]).alias("priority"), x["label"].alias("label"))


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with n_words, places (start word and label of the fixed phrases) and
    detections (start, end in the normalised words' text, priority, label); columns of these names are replaced."""
    table = rules()
    # One constant, which Spark folds into an array: hundreds of nested literals would take seconds to plan.
    listed = [{"number": n, "label": label, "priority": p, "keyword": k, "pattern": x} for n, (label, p, k, x) in enumerate(table)]
    literal = F.from_json(F.lit(json.dumps(listed)), "array<struct<number int, label string, priority int, keyword string, pattern string>>")
    rest = docs.drop("n_words", "places", "detections")
    raw = F.coalesce(F.col(text), F.lit(""))
    word = F.lit(WORD)
    seen = raw.rlike(_gate(table))
    found = rest.withColumn("n_words", F.regexp_count(raw, word).cast("long"))
    words = F.regexp_extract_all(F.translate(F.when(seen, raw).otherwise(""), UPPER, LOWER), word, F.lit(0))
    found = found.withColumn("_words", words).withColumn("_joined", F.array_join("_words", " "))
    found = found.withColumn("places", _places(F.col("_words")))
    distinct = F.array_distinct("_words")
    found = found.withColumn("_keys", F.array_intersect(distinct, F.lit(sorted({k for _, _, k, _ in table}))))
    found = found.withColumn("_sorted", _detections(F.col("_joined"), literal, F.col("_keys")))
    return found.withColumn("detections", _resolved(F.col("_sorted"))).drop("_words", "_joined", "_keys", "_sorted")


def license_labels(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    found = scan_licenses(docs.select(F.col(id), F.col(text)), text)
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    own = F.transform("detections", lambda d: d["label"])
    sure = reduce(
        lambda otherwise, p: F.when(F.exists("detections", lambda d: d["priority"] == p), F.lit(CONFIDENCE[p])).otherwise(otherwise),
        (1, 2, 3),
        F.when(F.size("places") > 0, F.lit(0.6)).otherwise(F.lit(0.0)),
    )
    return found.select(
        F.col(id),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        sure.alias("score"),
    )
