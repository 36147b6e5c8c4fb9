"""Pre-tokens of a public word-BPE tokenizer and their exact encoding by its library.

The tokenizer composes (NFC), turns white space into single spaces, lower-cases, then splits with a pattern that
never crosses a space. A match of that pattern is encoded alike wherever it stands, and so is a maximal run without
white space. Texts of Latin characters are cut into matches, others into runs, and a text's ids are the ids of its
pre-tokens in order. Special strings (added tokens) are found in the raw text first, as the library does.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np

#: Texts of these characters need no composition, and Python's lower() and white space agree with the library's.
_PLAIN = re.compile("[^\x00-\x1b\x20-ɏ]")


def _plain_class(category: str) -> str:
    """Characters of a Unicode category that lower-cased texts of the plain range can have, for a regular expression."""
    found = {c for code in range(0x250) for c in chr(code).lower() if unicodedata.category(c)[0] == category}
    return "".join(map(re.escape, sorted(found)))


#: The tokenizer's pattern for plain texts; the contractions are its fixed values.
_MATCHES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[{0}]+|[{1}]|[^\\s{0}{1}]+".format(_plain_class("L"), _plain_class("N"))
)
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Pretokenizer:
    """Pre-tokens of texts, and ids of pre-tokens. One instance per worker process and tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self._normalizer = whole.normalizer
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"] and not t["normalized"]}
        if len(self.special) != len(spec["added_tokens"]):
            raise ValueError("only special tokens that are matched in the raw text are supported")
        self._specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._model = Tokenizer(whole.model)
        self._model.pre_tokenizer = whole.pre_tokenizer
        splits = [p["pattern"].get("Regex") for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
        self._cut_plain = splits == [_PATTERN]
        self._ids: dict[str, bytes] = {}
        self._sizes: dict[str, int] = {}
        size = max([whole.get_vocab_size(with_added_tokens=True), *[i + 1 for i in self.special.values()]])
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")

    def _runs(self, text: str) -> list[str]:
        if _PLAIN.search(text) is None:
            return _MATCHES.findall(text.lower()) if self._cut_plain else text.lower().split()
        return [x for x in self._normalizer.normalize_str(text).split(" ") if x]

    def split(self, text: str | None) -> list[str]:
        """The pre-tokens of a text in order; a special string is one of its own, marked by a space before it."""
        if not text:
            return []
        if self._specials is None or "<" not in text:
            return self._runs(text)
        out: list[str] = []
        for part in self._specials.split(text):
            if part in self.special:
                out.append(f" {part}")
            elif part:
                out += self._runs(part)
        return out

    def ids(self, pretokens: list[str]) -> list[list[int]]:
        """The library's ids of each pre-token."""
        plain = [p for p in pretokens if p[0] != " "]
        found = iter(self._model.encode_batch(plain, add_special_tokens=False))
        return [[self.special[p[1:]]] if p[0] == " " else next(found).ids for p in pretokens]

    def _missing(self, runs: list[list[str]], cache: dict, most: int) -> list[str]:
        """Pre-tokens that a cache of at most ``most`` entries lacks; a full cache is emptied first."""
        wanted = set().union(*runs)
        fresh = [p for p in wanted if p not in cache]
        if len(cache) + len(fresh) > most:
            cache.clear()
            return list(wanted)
        return fresh

    def encode(self, texts: list[str | None], most: int = 400_000) -> list[bytes]:
        """Each text's ids as little-endian bytes of ``dtype``; a bounded cache keeps the ids of pre-tokens."""
        runs = [self.split(t) for t in texts]
        fresh = self._missing(runs, self._ids, most)
        ids = self.ids(fresh)
        data, end, width = np.fromiter(chain.from_iterable(ids), self.dtype).tobytes(), 0, self.dtype.itemsize
        for p, own in zip(fresh, ids):
            start, end = end, end + width * len(own)
            self._ids[p] = data[start:end]
        get = self._ids.__getitem__
        return [b"".join(map(get, r)) for r in runs]

    def lengths(self, texts: list[str | None], most: int = 400_000) -> list[int]:
        """The number of ids of each text; a bounded cache keeps those of pre-tokens."""
        runs = [self.split(t) for t in texts]
        fresh = self._missing(runs, self._sizes, most)
        self._sizes.update(zip(fresh, map(len, self.ids(fresh))))
        get = self._sizes.__getitem__
        return [sum(map(get, r)) for r in runs]


@lru_cache(maxsize=4)
def pretokenizer(path: str) -> Pretokenizer:
    return Pretokenizer(path)
