"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins, learnt by cyclic boosting: in turn every feature fits a
shallow tree (a few leaves over its bins) to what the others leave, at a small rate. The pairs that explain most of
the rest get tables over both features' coarse bins. A score is the constant plus one table entry per feature and
pair, so scoring is a few vectorised additions, and every part of it can be read.

The model is fitted on at most ``sample_rows`` labelled rows outside the held-out fold, chosen by a hash of the id.
Inputs are figures of the text alone. NULL and empty texts have the figures of a text without words; repeated rows
get equal scores; without labels of both classes every score is the share of label 1 (0 if there are none).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, slices
from .labelled import remainder, sampled, training_labels, with_labels

FEATURES = (
    "log_words", "word_bytes", "symbols", "digits", "capitals", "beyond_ascii", "distinct", "top_word", "repeats",
    "words_per_line", "line_copies", "closed_lines", "short_words", "long_words", "stops", "symbol_words",
)

_SYMBOLS = np.isin(np.arange(256), list(b"#$%&*+/<=>@[\\]^_`{|}~"))
_DIGITS = np.isin(np.arange(256), list(b"0123456789"))
_CAPITALS = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_HIGH = np.arange(256) >= 128
_STOPS = np.isin(np.arange(256), list(b".!?"))
_CLASSES = np.stack([_SYMBOLS, _DIGITS, _CAPITALS, _HIGH, _STOPS]).astype(np.float64)
_CLOSED = (b".", b"!", b"?", b'"', b":")


def text_figures(raw: bytes | None) -> list[float]:
    """The features of one text, in the order of FEATURES."""
    raw = raw or b""
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    classes = (_CLASSES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)) / size
    if not n:
        return [0.0, 0.0, *classes[:4], *([0.0] * 10)]
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    marked = sum(k for w, k in counts.items() if not w.isalnum() and w[-1] < 128 and _SYMBOLS[w[-1]])
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        *classes[:4],
        len(counts) / n ** 0.7,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(x.rstrip().endswith(_CLOSED) for x in lines) / len(lines),
        float((lengths <= 3).mean()),
        float((lengths > 14).mean()),
        float(classes[4] * size / n),
        marked / n,
    ]


def figures(texts: list[bytes | None]) -> np.ndarray:
    return np.array([text_figures(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def _tree(weight: np.ndarray, slope: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Values per bin of a tree with up to ``leaves`` leaves over ordered bins, by best-first splits."""
    cw, cs = np.concatenate([[0.0], np.cumsum(weight)]), np.concatenate([[0.0], np.cumsum(slope)])
    value = lambda a, b: (cs[b] - cs[a]) / (cw[b] - cw[a] + 1.0)

    def best(a: int, b: int) -> tuple[float, int]:
        cut = np.arange(a + 1, b)
        if not len(cut):
            return 0.0, a
        lw, ls, rw, rs = cw[cut] - cw[a], cs[cut] - cs[a], cw[b] - cw[cut], cs[b] - cs[cut]
        gain = ls**2 / (lw + 1) + rs**2 / (rw + 1) - (cs[b] - cs[a]) ** 2 / (cw[b] - cw[a] + 1)
        gain[(lw < least) | (rw < least)] = 0
        k = int(np.argmax(gain))
        return float(gain[k]), int(cut[k])

    parts = [(0, len(weight), *best(0, len(weight)))]
    while len(parts) < leaves:
        k = max(range(len(parts)), key=lambda i: parts[i][2])
        a, b, gain, cut = parts[k]
        if gain <= 0:
            break
        parts[k : k + 1] = [(a, cut, *best(a, cut)), (cut, b, *best(cut, b))]
    out = np.zeros(len(weight))
    for a, b, *_ in parts:
        out[a:b] = value(a, b)
    return out


class GamModel:
    """Additive lookup tables for single features and pairs."""

    def __init__(self, base: float):
        self.base, self.edges, self.tables, self.pairs = base, [], [], []

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not self.edges:
            return np.full(len(x), self.base)
        at = self.bins(x)
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[at[:, j]]
        for i, j, ci, cj, table in self.pairs:
            total += table[ci[at[:, i]], cj[at[:, j]]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_gam(
    x: np.ndarray, y: np.ndarray, bins: int = 64, rounds: int = 300, rate: float = 0.08, leaves: int = 3, pairs: int = 6,
    coarse: int = 8, pair_rounds: int = 100, least: float = 2.0,
) -> GamModel:
    """Cyclic boosting with the logistic loss; Newton leaf values."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 1e-3
    model = GamModel(float(np.log(share / (1 - share))) if len(y) else -30.0)
    if not len(y) or y.min() == y.max():
        model.base = 30.0 if len(y) and y.max() > 0 else -30.0
        return model
    for j in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])))
    at = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    margin = np.full(len(y), model.base)
    for _ in range(rounds):
        for j, size in enumerate(sizes):
            p = 1 / (1 + np.exp(-margin))
            step = rate * _tree(np.bincount(at[:, j], p * (1 - p), size), np.bincount(at[:, j], y - p, size), leaves, least)
            model.tables[j] += step
            margin += step[at[:, j]]
    cuts = [np.minimum(np.arange(s) * coarse // s, coarse - 1) for s in sizes]
    p = 1 / (1 + np.exp(-margin))
    gains = []
    for i, j in combinations(range(len(sizes)), 2):
        cell = cuts[i][at[:, i]] * coarse + cuts[j][at[:, j]]
        w, s = np.bincount(cell, p * (1 - p), coarse * coarse), np.bincount(cell, y - p, coarse * coarse)
        gains.append((float((s**2 / (w + 5)).sum()), i, j))
    chosen = sorted(gains, reverse=True)[:pairs]
    model.pairs = [(i, j, cuts[i], cuts[j], np.zeros((coarse, coarse))) for _, i, j in chosen]
    cells = [cuts[i][at[:, i]] * coarse + cuts[j][at[:, j]] for _, i, j in chosen]
    for _ in range(pair_rounds):
        for (_, _, _, _, table), cell in zip(model.pairs, cells):
            p = 1 / (1 + np.exp(-margin))
            w, s = np.bincount(cell, p * (1 - p), coarse * coarse), np.bincount(cell, y - p, coarse * coarse)
            step = rate * np.where(w >= least, s / (w + 5.0), 0.0)
            table += step.reshape(coarse, coarse)
            margin += step[cell]
    return model


def fit_quality(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = 20_000
) -> GamModel:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = figures(batch.column(2).to_pylist())
            yield pa.record_batch([batch.column(1), *map(pa.array, x.T)], ["label", *FEATURES])

    usable = settle(training_labels(labels, label, 4, 2, id), "labels")
    schema = "label int, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = with_labels(docs, settle(sampled(usable, sample_rows), "sample"), id, text).mapInArrow(run, schema).toPandas()
    rows = rows.sort_values([*FEATURES, "label"])
    return fit_gam(rows[list(FEATURES)].to_numpy(), (rows["label"] > 0).to_numpy(float))


def score_quality(docs: DataFrame, model: GamModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.record_batch([batch.column(0), pa.array(sent.value.score(figures(batch.column(1).to_pylist())))], [id, "score"])

    slim = docs.select(F.col(id), F.col(text).cast("binary").alias("raw"))
    return slim.mapInArrow(run, slim.select(id).schema.add("score", "double"))


def quality(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    found = score_quality(docs, fit_quality(docs, labels, id, text), id, text)
    fold = F.coalesce(remainder(F.col(id), 4) == 2, F.lit(False))
    return found.select(id, fold.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
