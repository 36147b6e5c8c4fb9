"""Quality and toxicity: held-out accuracy, folds, awkward rows."""

import zlib

import numpy as np
import pytest

from tidewright.llm import QUERIES
from tidewright.llm.quality_gam import FEATURES, figures, fit_gam, quality
from tidewright.llm.toxicity import KneserNey, _layout, fit_toxicity, score_toxicity, toxicity

from .cases import AWKWARD, awkward, empty, load

BIGGER = "/root/testdata/sf0.01"


def fold(doc, n):
    return zlib.crc32(str(doc).encode()) % n


@pytest.mark.parametrize("name,label,n,held,least", [("op1_quality_gam", "quality", 4, 2, 0.93), ("op6_toxicity_kn", "toxic", 5, 0, 0.93)])
def test_held_out_accuracy(spark, name, label, n, held, least):
    rows = QUERIES[name](spark, BIGGER).collect()
    labels = {r.doc_id: r[label] for r in load(spark, "labels", BIGGER).collect()}
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (fold(r.doc_id, n) == held) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= (0.7 if label == "quality" else 0.5))
    met = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in met]) >= least


def test_held_out_labels_are_not_read(spark):
    docs, labels = load(spark, "documents"), load(spark, "labels")
    other = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id AS string)) % 4 = 2, 1 - quality, quality) AS quality",
        "if(crc32(cast(doc_id AS string)) % 5 = 0, 1 - toxic, toxic) AS toxic",
    )
    for fn in (quality, toxicity):
        assert sorted(fn(docs, labels).collect()) == sorted(fn(docs, other).collect())


@pytest.mark.parametrize("fn", [quality, toxicity])
def test_awkward_rows(spark, fn):
    labels = spark.createDataFrame([(1, 1, 1), (5, 0, 0), (6, 1, 0), (6, 0, 0), (7, 0, 1), (None, 1, 1), (99, 1, 1), (10, None, None)], "doc_id long, quality int, toxic int")
    rows = fn(awkward(spark), labels).collect()
    assert sorted(((r.doc_id) for r in rows), key=repr) == sorted((d for d, _ in AWKWARD), key=repr)
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert len({r.score for r in rows if r.doc_id in (1, 7)}) == 1
    assert fn(empty(spark), labels).collect() == []
    assert len(fn(awkward(spark), labels.limit(0)).collect()) == len(AWKWARD)


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (3000, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = fit_gam(x, y, rounds=40, pairs=3, pair_rounds=200)
    assert ((model.score(x) > 0.5) == y).mean() > 0.9
    assert (0, 1) in [(i, j) for i, j, *_ in model.pairs]
    by_hand = model.base + sum(t[model.bins(x[:1])[0, j]] for j, t in enumerate(model.tables))
    by_hand += sum(t[ci[model.bins(x[:1])[0, i]], cj[model.bins(x[:1])[0, j]]] for i, j, ci, cj, t in model.pairs)
    assert np.isclose(model.margin(x[:1])[0], by_hand)


def test_figures_are_finite():
    values = figures([None if t is None else t.encode() for _, t in AWKWARD])
    assert values.shape == (len(AWKWARD), len(FEATURES)) and np.isfinite(values).all()


def test_models_are_distributions():
    words = [b"stupid", b"the", b"then", b"that", b"stun"]
    grams, number, _ = _layout(words, 4)
    kinds, at = np.unique(grams, return_inverse=True)
    counts = np.stack([np.bincount(at, np.array([0, 9, 5, 4, 2])[number]), np.bincount(at, np.array([6, 2, 1, 1, 0])[number])], axis=1)
    model = KneserNey(kinds, counts, 4)
    for context in (b"   ", b" th", b"stu", b"zzz"):
        base = int.from_bytes(context, "big") << 8
        p = np.full((256, 2), 1 / 256)
        grams = base + np.arange(256)
        for n, (table, own, contexts, weight) in zip(range(1, 5), reversed(model.levels)):
            g = grams & ((1 << 8 * n) - 1)
            k = np.minimum(np.searchsorted(contexts, g >> 8), len(contexts) - 1)
            p = np.where((contexts[k] == g >> 8)[:, None], weight[k], 1.0) * p
            k = np.minimum(np.searchsorted(table, g), len(table) - 1)
            p += np.where((table[k] == g)[:, None], own[k], 0.0)
        assert np.allclose(p.sum(axis=0), 1)
    assert model.words([b"stupid"])[0] > 2 and model.words([b"qqq"])[0] < 0


def test_score_keeps_columns(spark):
    docs, labels = load(spark, "documents"), load(spark, "labels")
    scored = score_toxicity(docs.withColumn("score", docs.doc_id), fit_toxicity(docs, labels))
    assert scored.columns == [*docs.columns, "score"] and scored.count() == docs.count()


def test_tables_give_the_model_of_all_counts(spark):
    """The tables built in groups are those of one model over all counts, for the whole and for both halves."""
    from tidewright.llm.common import settle
    from tidewright.llm.kneser_tables import COUNTS, opened_model, write_tables
    from tidewright.llm.labelled import training_labels, with_labels
    from tidewright.llm.toxicity import gram_counts, word_counts

    docs, labels = load(spark, "documents"), load(spark, "labels")
    grams = settle(gram_counts(word_counts(with_labels(docs, training_labels(labels, "toxic", 5, 0))), 6), "grams")
    folder, rows = write_tables(grams, 6, 4), grams.toPandas()
    keys, counts = rows["gram"].to_numpy(np.int64), rows[list(COUNTS)].to_numpy(np.int64)
    for k, part in enumerate((counts[:, :2], counts[:, :2] - counts[:, 2:], counts[:, 2:])):
        seen = part.sum(axis=1) > 0
        whole, spread = KneserNey(keys[seen], part[seen], 6, 4), opened_model(folder, k, 4)
        assert (whole.known == spread.known).all() and np.allclose(whole.ratio, spread.ratio, rtol=0, atol=1e-12)
        words = [b"stupid", b"zzqx", b"the", "\u00e9t\u00e9".encode(), b"x" * 64]
        assert np.allclose(whole.words(words), spread.words(words), rtol=0, atol=1e-12)


def brute_likelihood(counts, word, order, shared):
    """Interpolated Kneser-Ney by dictionaries: (ordinary, toxic, shared backoff) log-likelihoods of a word's bytes.

    ``counts`` has the counts of whole words in both classes."""
    tables = [{} for _ in range(order + 1)]
    for w, pair in counts.items():
        padded = b" " * (order - 1) + w + b" "
        for i in range(len(w) + 1):
            gram = padded[i : i + order]
            old = tables[order].get(gram, (0, 0))
            tables[order][gram] = (old[0] + pair[0], old[1] + pair[1])
    for n in range(order, 1, -1):
        for gram, value in tables[n].items():
            start = gram[:2] == b"  "
            add = value if start else tuple(int(v > 0) for v in value)
            old = tables[n - 1].get(gram[1:], (0, 0))
            tables[n - 1][gram[1:]] = (old[0] + add[0], old[1] + add[1])

    def chance(c, context, byte):
        p = backoff = 1 / 256
        for n in range(1, order + 1):
            ctx = context[len(context) - n + 1 :] if n > 1 else b""
            use = (lambda v: sum(v)) if n <= shared else (lambda v: v[c])
            row = {g[-1:]: use(v) for g, v in tables[n].items() if g[:-1] == ctx and use(v) > 0}
            total = sum(row.values())
            if total:
                p = max(row.get(byte, 0) - 0.75, 0) / total + min(0.75 * len(row) / total, 1.0) * p
            if n == shared:
                backoff = p
        return p, backoff

    padded, out = b" " * (order - 1) + word + b" ", np.zeros(3)
    for i in range(len(word) + 1):
        context, byte = padded[i : i + order - 1], padded[i + order - 1 : i + order]
        (a, backoff), (b, _) = chance(0, context, byte), chance(1, context, byte)
        out += np.log([max(a, backoff), b, backoff])
    return out


def test_likelihoods_by_dictionaries():
    counts = {b"stupid": (0, 6), b"the": (9, 2), b"then": (5, 1), b"that": (4, 1), b"stun": (2, 0), b"a": (3, 3)}
    words = list(counts)
    grams, number, _ = _layout(words, 4)
    kinds, at = np.unique(grams, return_inverse=True)
    table = np.stack([np.bincount(at, np.array([counts[w][c] for w in words])[number]) for c in (0, 1)], axis=1)
    model = KneserNey(kinds, table, 4, 2)
    for word in (b"stupid", b"then", b"stand", b"a", b"zz", b"th"):
        ordinary, toxic, _ = brute_likelihood(counts, word, 4, 2)
        assert np.isclose(model.words([word])[0], toxic - ordinary)


def test_models_keep_columns_and_empty_tables(spark):
    docs, labels = load(spark, "documents"), load(spark, "labels")
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(awkward(spark), model)
    assert sorted(scored.columns) == sorted(awkward(spark).columns) and scored.count() == len(AWKWARD)
    assert score_toxicity(empty(spark), model).collect() == []
    assert fit_toxicity(docs, labels.where("toxic = 0")) is None
    assert fit_toxicity(empty(spark), labels) is None
