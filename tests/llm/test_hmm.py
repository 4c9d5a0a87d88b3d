import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from subscope.llm import common, hmm

from . import edge

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + [None]


def base_scores(rows, modulus=10):
    """Held out, n_tokens, n_known, N and base score by the plain formula."""
    learned = lambda i: i is not None and zlib.crc32(str(i).encode()) % modulus != 0
    c = Counter(t for i, text in rows if learned(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        out.append((str(i), i is not None and not learned(i), len(own), sum(c[t] > 0 for t in own), n, base))
    return sorted(out)


def compare(out, rows):
    found = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out)
    wanted = base_scores(rows)
    assert [x[:5] for x in found] == [x[:5] for x in wanted]
    assert np.allclose([x[5] for x in found], [x[5] for x in wanted], rtol=1e-9)


@pytest.mark.parametrize("head", [400_000, 30, 0])
def test_base_scores_equal_the_formula(spark, head):
    rows = [(r.doc_id, r.text) for r in common.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = hmm.language_scores(df, rounds=1, head_words=head).collect()
    compare(out, rows)
    assert all(np.isfinite(r.score) and r.score < 0 for r in out)


def test_edge_cases(spark):
    out = hmm.language_scores(edge.frame(spark), rounds=1).collect()
    assert edge.ids_of(out) == edge.ALL_IDS
    compare(out, edge.texts())
    assert hmm.language_scores(edge.empty(spark), rounds=1).collect() == []
    nobody = [(None, "a b"), (None, None)]
    compare(hmm.language_scores(edge.frame(spark, nobody), rounds=1).collect(), nobody)


def some_model(k=3, c=5, seed=0):
    rng = np.random.default_rng(seed)
    rows = lambda *s: rng.dirichlet(np.ones(s[-1]), size=s[:-1])
    return hmm.Hmm(rows(k), rows(k, k), rows(k, c))


def naive(model, sequence):
    """Probability and expected counts by all state paths."""
    k = len(model.start)
    total, starts, moves, emits = 0.0, np.zeros(k), np.zeros((k, k)), np.zeros_like(model.emit)
    for path in itertools.product(range(k), repeat=len(sequence)):
        p = model.start[path[0]] * model.emit[path[0], sequence[0]]
        for a, b, x in zip(path, path[1:], sequence[1:]):
            p *= model.move[a, b] * model.emit[b, x]
        total += p
        starts[path[0]] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
        for s, x in zip(path, sequence):
            emits[s, x] += p
    return total, np.concatenate((starts, moves.ravel(), emits.ravel())) / total


@pytest.mark.parametrize("width", [1, 2, 3, 64])
def test_chunks_give_all_paths(width):
    model = some_model()
    rng = np.random.default_rng(1)
    sequences = [rng.integers(0, 5, size=n) for n in (1, 4, 7, 2, 6)]
    first = np.concatenate(([0], np.cumsum([len(s) for s in sequences])))
    chunks = hmm.Chunks(model, np.concatenate(sequences), first, width)
    wanted = [naive(model, s) for s in sequences]
    assert np.allclose(chunks.forward(), [math.log(w[0]) for w in wanted])
    assert np.allclose(chunks.expected(), sum(w[1] for w in wanted))


def test_long_texts_do_not_underflow():
    model = some_model(2, 4)
    classes = np.random.default_rng(2).integers(0, 4, size=50_000)
    chunks = hmm.Chunks(model, classes, np.array([0, 50_000]))
    vector, total = model.start.copy(), 0.0
    for t, x in enumerate(classes):
        vector = (vector if t == 0 else vector @ model.move) * model.emit[:, x]
        total += math.log(vector.sum())
        vector /= vector.sum()
    assert np.isclose(chunks.forward()[0], total)
    assert np.isclose(chunks.expected()[-8:].sum(), 50_000)


def test_rounds_raise_the_likelihood(spark):
    docs = common.id_and_text(common.table(spark, "/root/testdata/sf0.01", "documents"))
    corpus = hmm.summary(common.checkpointed(hmm.word_counts(docs), "counts"))
    model = hmm.Hmm.initial(corpus.class_total)
    counts = common.checkpointed(hmm.word_counts(docs), "counts")
    totals = []
    for _ in range(3):
        totals.append(hmm.scores(docs, counts, corpus, model).agg({"score": "sum"}).first()[0])
        model = hmm.baum_welch(docs, corpus, model)
        assert np.isclose(model.start.sum(), 1) and np.allclose(model.move.sum(1), 1) and np.allclose(model.emit.sum(1), 1)
    assert totals[0] < totals[1] < totals[2]


def test_model_beats_word_counts_on_held_out_rows(spark):
    rows = [r for r in hmm.op10_hmm(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_words_of_a_class_share_its_probability(spark):
    """All known words and the unknown one of each class sum to one."""
    docs = common.id_and_text(common.table(spark, "/root/testdata/sf0.001", "documents"))
    counts = hmm.word_counts(docs)
    corpus = hmm.summary(counts, head_words=100)
    table = counts.toPandas()
    classes = corpus.classes(table["token"].to_numpy().view(np.uint64))
    mass = np.bincount(classes, table["n"] + hmm.SMOOTHING, minlength=hmm.N_CLASSES) + hmm.SMOOTHING
    assert np.allclose(mass / 10 ** corpus.class_cost(), 1.0)
    assert corpus.total == table["n"].sum() and corpus.distinct == len(table)
