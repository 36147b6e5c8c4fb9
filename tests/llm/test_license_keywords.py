"""Each license rule's keyword is a word of whatever its pattern accepts."""

import re
from itertools import product
from re import _constants as c
from re import _parser

from tidewright.llm.license_scan import license_labels, rules


def spellings(parsed):
    """All texts of a pattern of literals, small sets, options and branches; one digit stands for all."""
    parts = []
    for op, arg in parsed:
        if op is c.LITERAL:
            parts.append([chr(arg)])
        elif op is c.IN:
            parts.append(["0" if o is c.CATEGORY else chr(a if o is c.LITERAL else a[0]) for o, a in arg])
        elif op is c.MAX_REPEAT:
            low, high, inner = arg
            assert (low, high) == (0, 1)
            parts.append(["", *spellings(inner)])
        elif op is c.SUBPATTERN:
            parts.append(spellings(arg[-1]))
        elif op is c.BRANCH:
            parts.append([s for branch in arg[1] for s in spellings(branch)])
        else:
            assert op is c.ASSERT_NOT
    return ["".join(p) for p in product(*parts)]


def test_keywords_are_words_of_every_spelling():
    for label, priority, keyword, pattern in rules():
        # What introduces and follows a name has no part in the keyword; names are tried as bare names.
        if pattern.count("(?:(?:is |are |was |be )") == 0:
            for text in spellings(_parser.parse(pattern)):
                assert re.fullmatch(pattern, text) and keyword in text.split(), (label, text)


def test_beerware_is_found(spark):
    texts = ["Beerware License", "licensed under the Beerware license", "the beer ware licence", "beer license", "beerware"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_labels(df).collect()}
    assert got == {0: ("beerware", 0.8), 1: ("beerware", 0.95), 2: ("beerware", 0.8), 3: ("", 0.0), 4: ("", 0.0)}


def test_work_grows_with_the_matches(spark):
    """A text of many notices costs about as much for each as one of fewer, and planning is quick."""
    import time

    start = time.time()
    found = {n: license_labels(spark.createDataFrame([(1, "mit license " * n)], "doc_id long, text string")) for n in (2, 5_000, 20_000)}
    seconds = {}
    for n, df in found.items():
        before = time.time()
        row = df.first()
        seconds[n] = time.time() - before
        assert (row.n_base, row.n_words, row.last_word, row.labels) == (n, 2 * n, 2 * n - 2, "mit")
    assert time.time() - start < 90 and seconds[20_000] < 10 * seconds[5_000] + 5
    print(seconds)
