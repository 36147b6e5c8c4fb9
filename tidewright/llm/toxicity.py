"""Toxicity by class-conditional Kneser-Ney models of the spelling of words.

The words (letters and digits, lower case) of labelled documents are counted per class; their byte n-grams, with word
boundaries, are the counts of two interpolated Kneser-Ney models. The higher orders are class-conditional. Orders up
to ``shared`` are continuation counts that both classes share, so an expression that neither class knows well gets
nearly the same likelihood from both. A word's log ratio is the difference of the two log-likelihoods, where the
ordinary one is not less than the shared backoff's: what is merely rare in ordinary texts isn't toxic for that. A
document is compared by the ratio normalised by its length and by its most telling words, which a logistic link turns
into a score. The link is fitted on a bounded sample of the learning rows, each half of them scored by the models of the
other half, so that it sees words as new as those of later documents.

All learning rows are counted. The tables of the models are built in the tasks, from n-grams grouped by the last two
bytes of their context, and written to the shared folder; a worker opens them once. There is one table of n-grams, not of
occurrences, so it grows as slowly as the spelling of new words does.

NULL and empty texts, and texts without words, have no evidence and get the score of the link for zero features.
Repeated rows get equal scores; without labels of both classes every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_TABLE, ascii_lower_words, settle, slices
from .kneser_ney import KneserNey, cut_words
from .kneser_ney import layout as _layout
from .kneser_tables import COUNTS, opened_model, write_tables
from .labelled import remainder, sampled, training_labels, with_labels

NAMES = ("mean", "top_1", "top_2", "top_3", "next_5", "log_words")
FLUSH = 300_000


def half_of(id: str) -> Column:
    """0 or 1 by a hash of the id."""
    return F.pmod(F.xxhash64(F.lit("half"), id), F.lit(2)).cast("int")


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, ordinary, toxic, ordinary_a, toxic_a): how often each word stands in either class, in all labelled rows
    and in one half of them."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in range(4)]

        def out() -> pa.RecordBatch:
            words = list(set().union(*seen))
            a0, a1, b0, b1 = (np.array([c.get(w, 0) for w in words], np.int64) for c in seen)
            return pa.record_batch([pa.array(words, pa.binary()), *map(pa.array, (a0 + b0, a1 + b1, a0, a1))], ["word", *COUNTS])

        for batch in slices(batches):
            for label, half, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                seen[2 * half + (1 if label else 0)].update(ascii_lower_words(raw, ALNUM_TABLE))
            if sum(map(len, seen)) > FLUSH:
                yield out()
                for c in seen:
                    c.clear()
        yield out()

    rows = labelled.select("label", half_of("doc").alias("half"), "raw")
    rows = rows.mapInArrow(gather, "word binary, " + ", ".join(f"{c} long" for c in COUNTS))
    return rows.groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS])


def gram_counts(words: DataFrame, order: int) -> DataFrame:
    """(gram and the same counts) of the byte n-grams of counted words."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 50_000):
            words = batch.column(0).to_pylist()
            parts, many = cut_words(words)
            grams, number, _ = _layout(parts, order)
            kinds, place = np.unique(grams, return_inverse=True)
            counts = [np.bincount(place, np.repeat(np.asarray(batch.column(k)), many)[number], len(kinds)).astype(np.int64) for k in range(1, 5)]
            yield pa.record_batch([pa.array(kinds), *map(pa.array, counts)], ["gram", *COUNTS])

    rows = words.mapInArrow(gather, "gram long, " + ", ".join(f"{c} long" for c in COUNTS))
    return rows.groupBy("gram").agg(*[F.sum(c).alias(c) for c in COUNTS])


class Evidence:
    """Features of texts under a model; keeps the ratios of words in a bounded table."""

    def __init__(self, model: KneserNey, most: int = 100_000):
        self.model, self.most, self.known = model, most, {}

    def features(self, texts: list[bytes | None]) -> np.ndarray:
        """Per text: ratio per byte of the whole text, the three largest ratios of its words, the mean of the next
        five, and the length, since a longer text has more words that look telling by chance."""
        words = [ascii_lower_words(t, ALNUM_TABLE) for t in texts]
        fresh = list(set().union(*words) - self.known.keys()) if words else []
        if len(self.known) + len(fresh) > self.most:
            self.known = {}
            fresh = list(set().union(*words))
        for start in range(0, len(fresh), 20_000):
            part = fresh[start : start + 20_000]
            self.known.update(zip(part, self._long(part).tolist()))
        out = np.zeros((len(texts), len(NAMES)))
        get = self.known.__getitem__
        for row, w in zip(out, words):
            if w:
                r = np.fromiter(map(get, w), np.float64, len(w))
                row[0] = r.sum() / (sum(map(len, w)) + len(w))
                top = np.clip(np.sort(np.partition(r, -8)[-8:] if len(r) > 8 else r)[::-1], 0, 12)
                row[1 : 1 + min(3, len(top))] = top[:3]
                row[4] = top[3:].sum() / 5
                row[5] = np.log1p(len(w))
        return out

    def _long(self, words: list[bytes]) -> np.ndarray:
        """Ratios of words; a longer word has the largest ratio of its parts."""
        parts, many = cut_words(words)
        return np.maximum.reduceat(self.model.words(parts), np.cumsum(many) - many) if len(words) else np.zeros(0)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with the constant last, means, scales) by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.diag([1.0] * x.shape[1] + [0.0]) * len(x) / 1000
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + penalty @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w)), slope)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


class ToxicityModel:
    """Where the tables lie, and the link; this is all that goes to the tasks."""

    def __init__(self, tables: str, shared: int, link: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.tables, self.shared, self.link = tables, shared, link

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        w, mean, scale = self.link
        z = np.column_stack([(evidence(self.tables, 0, self.shared).features(texts) - mean) / scale, np.ones(len(texts))]) @ w
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


#: The models that this process has opened, by their place.
_OPEN: dict[tuple[str, int], Evidence] = {}


def evidence(tables: str, model: int, shared: int) -> Evidence:
    """The evidence of one of the models below a folder. Models of other folders are let go, and so are those of the
    halves once the whole is asked for."""
    if (tables, model) not in _OPEN:
        for other in [k for k in _OPEN if k[0] != tables or (k[1] == 0) != (model == 0)]:
            del _OPEN[other]
        _OPEN[tables, model] = Evidence(opened_model(tables, model, shared))
    return _OPEN[tables, model]


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", order: int = 6,
    shared: int = 4, sample_rows: int = 20_000,
) -> ToxicityModel | None:
    """Learn from all labelled rows outside the held-out fold; the link from ``sample_rows`` of them."""
    usable = settle(training_labels(labels, label, 5, 0, id), "labels")
    words = settle(word_counts(with_labels(docs, usable, id, text)), "words")
    grams = settle(gram_counts(words, order), "grams")
    tables = write_tables(grams, order, shared)
    if tables is None:
        return None

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            half, texts = np.asarray(batch.column(1)), batch.column(2).to_pylist()
            # Each half is scored by the models of the other one: 1 for half 0, 2 for half 1.
            x = np.where((half == 0)[:, None], *(evidence(tables, k, shared).features(texts) for k in (1, 2)))
            yield pa.record_batch([batch.column(0), *map(pa.array, x.T)], ["label", *NAMES])

    sample = settle(sampled(usable, sample_rows), "sample")
    sample = with_labels(docs, sample, id, text).select("label", half_of("doc").alias("half"), "raw")
    names = list(NAMES)
    learnt = sample.mapInArrow(features, "label int, " + ", ".join(f"{c} double" for c in names)).toPandas().sort_values([*names, "label"])
    if learnt["label"].nunique() < 2:
        return None
    link = fit_logistic(learnt[names].to_numpy(), (learnt["label"] > 0).to_numpy(float))
    return ToxicityModel(tables, shared, link)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, text: str = "text", score: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with a score column (replaced if it is there)."""
    rest = docs.drop(score)
    if model is None:
        return rest.withColumn(score, F.lit(0.0))
    names = rest.columns
    if text not in names:
        raise ValueError(f"no column {text}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = model.score(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values)], names=[*names, score])

    return rest.withColumn("__raw", F.col(text).cast("binary")).mapInArrow(run, rest.schema.add(score, "double"))


def toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    model = fit_toxicity(docs, labels, id, text)
    slim = docs.select(F.col(id), F.col(text).cast("binary").alias("raw"))
    found = score_toxicity(slim, model, "raw")
    fold = F.coalesce(remainder(F.col(id), 5) == 0, F.lit(False))
    return found.select(id, fold.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
