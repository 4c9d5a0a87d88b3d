import numpy as np
import pytest

from subscope.llm import common, mixing

from . import edge


def table(spark, posteriors, tokens):
    rows = [(i, int(n), [float(x) for x in p]) for i, (p, n) in enumerate(zip(posteriors, tokens))]
    return spark.createDataFrame(rows, mixing.MEMBERS).repartition(3)


def fitted(spark, posteriors, tokens, targets, rounds=30):
    df = table(spark, posteriors, tokens)
    steps = mixing.fit_rates(df, np.array(targets, dtype=float), rounds=rounds)
    rates = {r.doc_id: r.rate for r in df.select("doc_id", mixing.rate_of(steps).alias("rate")).collect()}
    return np.array([rates[i] for i in range(len(tokens))])


def test_expected_totals_meet_reachable_targets(spark):
    rng = np.random.default_rng(0)
    posteriors, tokens = rng.dirichlet([0.3] * 3, size=300), rng.integers(1, 200, size=300)
    held = (posteriors * tokens[:, None]).sum(0)
    for factors in ([1, 1, 1], [1, 0.3, 0.6], [2.0, 1.0, 0.1]):
        targets = held * factors
        rates = fitted(spark, posteriors, tokens, targets)
        assert (rates >= 0).all()
        assert np.abs((rates * tokens) @ posteriors - targets).max() < 5e-3 * targets.sum()


def test_unreachable_targets_are_met_in_least_squares(spark):
    """No small change of any rate that keeps it nonnegative lowers the weighted squares."""
    rng = np.random.default_rng(1)
    posteriors, tokens = rng.dirichlet([2.0] * 2, size=40), rng.integers(1, 20, size=40)
    moments = (posteriors * tokens[:, None]).T @ posteriors
    targets = np.array([0.0, 400.0])
    rates = fitted(spark, posteriors, tokens, targets, rounds=80)
    slope = posteriors @ np.linalg.inv(moments) @ ((rates * tokens) @ posteriors - targets)
    assert np.abs(np.where(rates > 1e-9, slope, np.minimum(slope, 0))).max() < 5e-2


def test_targets_in_reach(spark):
    df = table(spark, [[1, 0, 0], [0, 1, 0], [0, 0, 1]], [800, 150, 1])
    assert np.allclose(mixing.reachable(df, np.array([0.8, 0.1, 0.1])), [800, 100, 1])


def least_squares(posteriors, tokens, targets, most, rounds=20_000):
    """Plain projected gradient steps in numpy, to convergence."""
    moments = (posteriors * tokens[:, None]).T @ posteriors
    inverse, rates = np.linalg.inv(moments), np.ones(len(tokens))
    for _ in range(rounds):
        rates = np.clip(rates - posteriors @ (inverse @ ((rates * tokens) @ posteriors - targets)), 0, most)
    return (rates * tokens) @ posteriors


@pytest.mark.parametrize("factors, most", [([1, 0.3, 0.6], 64), ([1, 40, 0.1], 3), ([0.2, 1, 90], 8)])
def test_totals_equal_those_of_a_plain_solver(spark, factors, most):
    rng = np.random.default_rng(3)
    posteriors, tokens = rng.dirichlet([0.3] * 3, size=60), rng.integers(1, 90, size=60)
    targets = (posteriors * tokens[:, None]).sum(0) * factors
    df = table(spark, posteriors, tokens)
    steps = mixing.fit_rates(df, targets, rounds=80, most=most)
    rows = df.withColumn("rate", mixing.rate_of(steps, most=most)).toPandas()
    assert rows.rate.between(0, most).all()
    totals = np.stack(rows.posterior).T @ (rows.rate * rows.n_tokens).to_numpy()
    assert np.abs(totals - least_squares(posteriors, tokens, targets, most)).max() < 1e-2 * targets.sum()


def test_a_domain_of_one_document_is_repeated_so_many_times_only(spark, monkeypatch):
    posteriors = np.where(np.eye(4, dtype=bool)[[0] * 999 + [2]], 0.997, 0.001)
    members = table(spark, posteriors, [100] * 1000)
    monkeypatch.setattr(mixing, "fit", lambda *args: None)
    monkeypatch.setattr(mixing, "memberships", lambda *args: members)
    rows = mixing.mixed(None, None, {(1, 0): 0.5, (0, 0): 0.5}, most=20)
    found = rows.toPandas()
    assert found.rate.max() <= 20 and found.copies.max() == 20
    report = {(r["quality"], r["toxic"]): r for r in mixing.achieved(rows, {(1, 0): 0.5, (0, 0): 0.5})}
    assert report[0, 0]["gap"] > 0.1 and abs(sum(r["achieved"] for r in report.values()) - 1) < 1e-9
    with pytest.raises(ValueError):
        mixing.mixed(None, None, most=0.5)


def mixed_shares(spark, monkeypatch, held, column, **options):
    """The domains' shares of tokens when each document counts as often as ``column`` says."""
    rng = np.random.default_rng(2)
    posteriors = np.where(np.eye(4, dtype=bool)[rng.choice(4, size=20_000, p=held)], 0.997, 0.001)
    members = table(spark, posteriors, rng.integers(50, 150, size=len(posteriors)))
    monkeypatch.setattr(mixing, "fit", lambda *args: None)
    monkeypatch.setattr(mixing, "memberships", lambda *args: members)
    rows = mixing.mixed(None, None, **options).toPandas()
    totals = np.stack(rows.posterior).T @ (rows[column] * rows.n_tokens).to_numpy()
    return totals / totals.sum()


def test_copies_meet_targets_where_a_domain_is_hot(spark, monkeypatch):
    shares = mixed_shares(spark, monkeypatch, [0.60, 0.05, 0.33, 0.02], "copies")
    assert np.allclose(shares, [mixing.TARGETS[d] for d in mixing.DOMAINS], atol=5e-3)


def test_scarce_domains_are_repeated_to_their_share(spark, monkeypatch, caplog):
    caplog.set_level("INFO", logger=mixing.__name__)
    shares = mixed_shares(spark, monkeypatch, [0.983, 0.003, 0.010, 0.004], "copies")
    assert np.allclose(shares, [mixing.TARGETS[d] for d in mixing.DOMAINS], atol=5e-3)
    logged = [r.args for r in caplog.records]
    assert [x[:2] for x in logged] == list(mixing.DOMAINS)
    assert np.allclose([x[3] for x in logged], shares)


def test_domains_without_documents_cannot_be_filled(spark):
    df = table(spark, [[0.999, 0.001, 0], [0.99, 0.01, 0], [0, 0, 1]], [800, 150, 1])
    assert np.allclose(mixing.full_targets(df, np.array([0.8, 0.1, 0.1])), [947.7, 2.3, 118.4625])


def test_drawn_copies_lose_no_small_rate(spark):
    df = spark.range(20_000).selectExpr("id", "2.3D as a", "0.04D as b", "0.97D as c", "1.0000001D as d")
    from pyspark.sql import functions as F

    out = df.select(*(mixing.drawn(F.col(c), F.xxhash64("id")).alias(c) for c in "abcd")).agg(*(F.avg(c) for c in "abcd")).first()
    assert np.allclose(list(out)[:3], [2.3, 0.04, 0.97], atol=0.01) and out[3] == 1.0


def test_labelled_rows(spark):
    rows = mixing.op3_mixing(spark, "/root/testdata/sf0.1").join(common.table(spark, "/root/testdata/sf0.1", "labels"), "doc_id", "left").toPandas()
    good = rows[(rows.quality == 1) & (rows.toxic == 0)]
    toxic = rows[rows.toxic == 1]
    assert (good.copies == 1).mean() > 0.99 and (toxic.copies == 0).mean() > 0.7
    names = [c for c in rows if c.startswith("p_quality")]
    assert np.allclose(rows[names].sum(axis=1), 1)
    totals = (rows[names].to_numpy() * (rows.rate * rows.n_tokens).to_numpy()[:, None]).sum(axis=0)
    assert np.allclose(totals / totals.sum(), [mixing.TARGETS[d] for d in mixing.DOMAINS], atol=2e-3)


@pytest.mark.parametrize("labels", [(), [(7, 1, 0), (10, 0, 1), (None, 1, 0), (9, None, 0), (12, 1, None), (7, 1, 0), (4, 1, 0), (4, 0, 0)]])
def test_edge_cases(spark, labels):
    marks = edge.labels(spark, labels)
    out = mixing.mixed(edge.frame(spark), marks).collect()
    assert edge.ids_of(out) == edge.ALL_IDS
    assert all(np.isfinite(r.rate) and r.rate >= 0 and r.copies >= 0 for r in out)
    assert [r.n_tokens for r in out if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    taken = mixing.taken(edge.frame(spark), marks)
    assert taken.columns == edge.frame(spark).columns
    assert edge.ids_of(taken.collect()) == edge.ids_of([r for r in out for _ in range(r.copies)])
    assert mixing.mixed(edge.empty(spark), marks).collect() == []
    assert mixing.taken(edge.empty(spark), marks).collect() == []
