import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from subscope.llm import common, quality_model, quality_rules

from . import edge

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def check_rows(rows, texts):
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert found == Counter((i, *brute_counts(t)) for i, t in texts)


def test_counts_equal_brute_force(spark):
    docs = common.table(spark, SF, "documents").limit(400)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    check_rows(quality_rules.rule_statistics(spark.createDataFrame(texts, "doc_id long, text string")).collect(), texts)
    odd = [*edge.texts(), (30, "a b c a b c a"), (31, "x\ny\nx\n x\nx"), (32, "#*$%&|<> # a"), (33, "a b c d a b c")]
    check_rows(quality_rules.rule_statistics(edge.frame(spark, odd)).collect(), odd)


def test_forest_keeps_good_and_rejects_odd_rows():
    rng = np.random.default_rng(0)
    good = rng.normal(0.5, 0.05, size=(2000, 4)).astype(np.float32)
    odd = good[:100].copy()
    odd[:, 2] += 3
    forest = quality_rules.grow(good[:1000])
    rows = np.concatenate((good[1000:], odd))
    flags = np.arange(len(rows)) < 1000
    quality_rules.calibrated(forest, rows, flags)
    verdict = forest.score(rows) < forest.threshold
    assert verdict[flags].mean() > 0.99 and not verdict[~flags].any()
    # Short paths mean high scores, whatever the order of the rows.
    assert forest.score(odd).min() > np.median(forest.score(good))
    assert np.allclose(forest.score(rows[::-1]), forest.score(rows)[::-1])
    quality_rules.calibrated(forest, good[1000:], np.ones(1000, dtype=bool))
    assert (forest.score(odd) < forest.threshold).all()


def test_path_of_one_tree():
    forest = quality_rules.IsolationForest(
        np.array([0, -1, -1]), np.array([1.0, 0, 0], dtype=np.float32), np.array([1, 0, 0]), np.array([0, 1.0, 3.0]), np.array([0]), 2.0
    )
    assert np.allclose(forest.score(np.array([[0.0], [1.0]], dtype=np.float32)), [2**-0.5, 2**-1.5])


def test_rules_on_labelled_rows(spark):
    labels = common.table(spark, SF, "labels")
    rows = quality_rules.op7_quality_rules(spark, SF).join(labels, "doc_id").collect()
    passed = [r for r in rows if not r.base_failed]
    good, bad = [r for r in passed if r.quality == 1], [r for r in passed if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.7 * len(bad)
    for r in rows:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (r.kept and failed)


def test_rules_edge_cases(spark):
    out = quality_rules.quality_rules(edge.frame(spark), edge.labels(spark)).collect()
    assert edge.ids_of(out) == edge.ALL_IDS
    assert all(r.kept == (not r.base_failed) and r.score is None for r in out)
    mixed = edge.labels(spark, [(10, 1, 0), (11, 1, 0), (11, 1, 0), (7, 1, 0), (8, 0, 1), (None, 1, 0), (9, None, 0), (5, 1, 0), (5, 0, 0)])
    assert edge.ids_of(quality_rules.quality_rules(edge.frame(spark), mixed).collect()) == edge.ALL_IDS
    assert quality_rules.quality_rules(edge.empty(spark), edge.labels(spark)).collect() == []
    kept = quality_rules.kept_documents(edge.frame(spark), edge.labels(spark))
    assert kept.columns == edge.frame(spark).columns
    # Ten long texts repeat themselves but for a number, so the base rules reject them too.
    assert sorted(x.doc_id for x in kept.collect()) == sorted(r.doc_id for r in out if r.kept)


def test_classifier_on_held_out_rows(spark):
    labels = common.table(spark, "/root/testdata/sf0.1", "labels")
    rows = quality_model.op6_quality_model(spark, "/root/testdata/sf0.1").join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_do_not_enter_scores(spark):
    docs, labels = (common.table(spark, SF, t) for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality", "toxic")
    a, b = (quality_model.quality_scores(docs, x).orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def test_updates_follow_the_published_rule():
    learner = quality_model.Ftrl(3, alpha=0.5, beta=1.0, l1=0.1, l2=1.0)
    z, n, w = np.zeros(3), np.zeros(3), np.zeros(3)
    rng = np.random.default_rng(3)
    for _ in range(50):
        x, y = rng.normal(size=3), int(rng.integers(2))
        for i in range(3):
            w[i] = 0.0 if abs(z[i]) <= 0.1 else -(z[i] - np.sign(z[i]) * 0.1) / ((1.0 + n[i] ** 0.5) / 0.5 + 1.0)
        p = 1 / (1 + np.exp(-w @ x))
        for i in range(3):
            g = (p - y) * x[i]
            s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5
            z[i], n[i] = z[i] + g - s * w[i], n[i] + g * g
        learner.learn(np.arange(3), x, y)
    assert np.allclose(learner.z, z) and np.allclose(learner.n, n)


def test_features_do_not_depend_on_the_batch():
    texts = ["One two two", "", None, "Ber Ber Ber!", "é È 12"]
    whole = quality_model.features(pa.array(texts))
    for d, text in enumerate(texts):
        one = quality_model.features(pa.array([text], pa.string()))
        own = slice(whole.first[d], whole.first[d + 1])
        assert one.index.tolist() == whole.index[own].tolist() and np.allclose(one.value, whole.value[own])
        assert whole.words[d] == len(WORD.findall(text or ""))


def test_classifier_edge_cases(spark):
    out = quality_model.quality_scores(edge.frame(spark), edge.labels(spark)).collect()
    assert edge.ids_of(out) == edge.ALL_IDS and all(r.score == 0.5 for r in out)
    assert not any(r.held_out for r in out if r.doc_id is None)
    some = edge.labels(spark, [(7, 1, 0), (7, 1, 0), (9, 0, 0), (None, 0, 0), (2, None, 1), (4, 5, 0)])
    assert len(quality_model.quality_scores(edge.frame(spark), some).collect()) == len(edge.texts())
    assert quality_model.quality_scores(edge.empty(spark), edge.labels(spark)).collect() == []


def test_every_labelled_row_counts(spark, monkeypatch):
    """More labelled rows than the trees can hold: all are drawn from, all calibrate."""
    monkeypatch.setattr(quality_rules, "TREES", 20)
    monkeypatch.setattr(quality_rules, "TREE_ROWS", 16)
    rng = np.random.default_rng(2)
    n = 12_000
    shares = rng.normal(0.5, 0.05, size=(n, 8)).astype(np.float32)
    bad = np.arange(n) % 10 == 0
    shares[bad, 3] += 3
    rows = [(i, 100, 500, 0, 0, 0, [float(v) for v in x]) for i, x in enumerate(shares)]
    stats = spark.createDataFrame(rows, quality_rules.SCHEMA).repartition(4)
    labels = spark.createDataFrame([(i, int(not b)) for i, b in enumerate(bad)], "doc_id long, quality int")
    grown = {}
    real = quality_rules.grow
    monkeypatch.setattr(quality_rules, "grow", lambda x: grown.setdefault("forest", real(x)))
    counted = []
    keep = common.checkpointed
    monkeypatch.setattr(common, "checkpointed", lambda df, name: counted.append((name, keep(df, name))) or counted[-1][1])
    forest = quality_rules.fit(stats, labels)
    rest = dict(counted)["calibration"].toPandas()
    assert dict(counted)["labelled-statistics"].count() == n and len(rest) > n // 2
    expected = quality_rules.calibrated(real(shares[~bad][:100]), shares[:10], ~bad[:10])
    expected.score = lambda x: x
    scores, good = rest["score"].to_numpy(), rest["good"].to_numpy()
    assert quality_rules.calibrated(expected, scores, good).threshold == forest.threshold < 1
    kept = quality_rules.judged(stats, forest).join(labels, "doc_id").where("kept").toPandas()
    assert (kept["quality"] == 1).sum() >= 0.99 * (~bad).sum()
