"""Mixing documents to target weights of domains they belong to in part.

A domain is a pair of labels (quality, toxic). Classifiers learned from the labelled table
give every document a posterior over the domains. A rate says how often a document is
taken; the expected tokens of a domain are the sum of rate, tokens and posterior over all
documents. Projected gradient descent fits nonnegative rates, starting from one, so that
these sums match the targets in least squares. A step needs one sum per domain over all
documents, and a document's rate follows from the steps so far, which are a few numbers,
so no state per document is kept or written between rounds.

The squares are weighted by the inverse of the domains' second moments, in the metric of
tokens, which makes a step of length one safe and makes rates depend on posteriors only.

Defined cases: a NULL text is empty, has no tokens and the posterior of an empty text; NULL
ids are returned as NULL and get a rate like any other; repeated rows count one by one;
without labels all domains are equally likely; contradictory labels are not learned from;
a domain with fewer tokens than its share is repeated to fill it, each document ``most``
times at most, unless ``repeats`` is False; what is then still missing is the gap that
``achieved`` returns; a share above every document's posterior cannot be met by any rates, so such a
domain keeps the tokens it holds; an empty table gives no rows. Extra columns are ignored.
What was asked and what the copies give is logged per domain.
"""

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import plain
from . import common
from .quality_model import BITS, Ftrl, features, sigmoid
from .words import mix

log = logging.getLogger(__name__)

# Share of the tokens each domain is to have: (quality, toxic).
TARGETS = {(1, 0): 0.96, (1, 1): 0.02, (0, 0): 0.02, (0, 1): 0.0}
DOMAINS = tuple(TARGETS)
SAMPLE_ROWS = 8000  # labelled rows learned from at most
EPOCHS = 4
SHARPNESS = 6.0  # feature values are scaled by this, so that single words can decide
ALPHA = 1.0
ROUNDS = 25
TOLERANCE = 1e-5
NOISE = 1e-6  # rates so near to a whole number differ from it by rounding errors only
MOST = 64.0  # most copies of a document; a domain that would need more keeps a gap, which is reported


def _domain_labels(labels: DataFrame) -> DataFrame:
    """doc_id and the number of the domain."""
    domain = F.lit(None).cast("int")
    for i, (quality, toxic) in enumerate(DOMAINS):
        domain = F.when((plain("quality") == quality) & (plain("toxic") == toxic), i).otherwise(domain)
    return labels.select(plain("doc_id").alias("doc_id"), domain.alias("domain"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, bits: int = BITS) -> np.ndarray:
    """A row of weights per domain against all others, from a bounded labelled sample."""
    sample = common.labelled_sample(docs, _domain_labels(labels), "domain", rows, values=range(len(DOMAINS)))

    def run(batches):
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                x = features(piece.column("text"), bits)
                first = pa.array(x.first.astype(np.int32))
                lists = [pa.ListArray.from_arrays(first, pa.array(c)) for c in (x.index.astype(np.int32), x.value.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("label"), *lists], names=["doc_id", "label", "index", "value"])

    table = sample.mapInArrow(run, "doc_id long, label int, index array<int>, value array<float>").toArrow()
    ids = table.column("doc_id").to_numpy().astype(np.uint64)
    label = table.column("label").to_numpy()
    index, value = (table.column(c).combine_chunks() for c in ("index", "value"))
    first = np.asarray(index.offsets)
    index, value = np.asarray(index.values), SHARPNESS * np.asarray(value.values).astype(np.float64)
    learners = [Ftrl(1 << bits, alpha=ALPHA) for _ in DOMAINS]
    for _ in range(EPOCHS):
        for i in np.lexsort((ids, mix(ids))):
            own = slice(first[i], first[i + 1])
            for d, learner in enumerate(learners):
                learner.learn(index[own], value[own], int(label[i] == d))
    return np.stack([x.weights().astype(np.float32) for x in learners])


MEMBERS = "doc_id long, n_tokens long, posterior array<double>"


def _posteriors(weights: np.ndarray):
    """The work on a piece: words and posterior over the domains of each whole text."""
    bits = int(weights.shape[1]).bit_length() - 1

    def work(piece: pa.RecordBatch) -> dict:
        x = features(piece.column("text"), bits)
        scores = []
        for own in weights:
            sums = np.concatenate(([0.0], np.cumsum(SHARPNESS * x.value * own[x.index])))
            scores.append(sigmoid(sums[x.first[1:]] - sums[x.first[:-1]]))
        posterior = np.stack(scores, axis=1)
        posterior /= posterior.sum(axis=1, keepdims=True)
        n, k = posterior.shape
        offsets = pa.array(np.arange(0, (n + 1) * k, k, dtype=np.int32))
        return {"doc_id": piece.column("doc_id"), "n_tokens": x.words, "posterior": pa.ListArray.from_arrays(offsets, pa.array(posterior.ravel()))}

    return work


def memberships(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, words and posterior over the domains of each whole text."""
    return common.by_pieces(common.id_and_text(docs), _posteriors(weights), MEMBERS)


def _fold(steps: list[np.ndarray], posterior: str, result: str, most: float) -> Column:
    """What a document is at after some steps: its rate, or the point ahead of it."""
    if not steps:
        return F.lit(1.0)
    # Steps are data of one expression, whose size does not grow with their number.
    listed = F.array(*(F.array(*(F.lit(float(x)) for x in step)) for step in steps))
    own, domains = plain(posterior), range(len(steps[0]) - 1)
    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))

    def move(state: Column, step: Column) -> Column:
        drop = sum((own[k] * step[k] for k in domains), F.lit(0.0))
        rate = F.least(F.lit(float(most)), F.greatest(F.lit(0.0), state["ahead"] - drop))
        ahead = rate + step[len(domains)] * (rate - state["rate"])
        return F.struct(rate.alias("rate"), ahead.alias("ahead"))

    return F.aggregate(listed, start, move, lambda state: state[result])


def rate_of(steps: list[np.ndarray], posterior: str = "posterior", most: float = MOST) -> Column:
    """The rate after some steps: each moves against a gradient, then back between zero and
    ``most``.

    A step is its move per domain and the momentum that the next one starts with.
    """
    return _fold(steps, posterior, "rate", most)


def fit_rates(members: DataFrame, targets: np.ndarray, rounds: int = ROUNDS, most: float = MOST) -> list[np.ndarray]:
    """Steps whose rates of at most ``most`` bring the expected tokens per domain to ``targets``."""
    k = len(targets)
    p = [F.col("posterior")[i] for i in range(k)]
    moments = members.agg(*(F.sum(F.col("n_tokens") * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k))).first()
    metric = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            metric[i, j] = metric[j, i] = moments[f"m{i}_{j}"] or 0.0
    inverse = np.linalg.pinv(metric, rcond=1e-9)
    steps: list[np.ndarray] = []
    pace = 1.0
    for _ in range(rounds):
        point = members.select("n_tokens", "posterior", _fold(steps, "posterior", "ahead", most).alias("at"))
        sums = point.agg(*(F.sum(F.col("at") * F.col("n_tokens") * p[i]).alias(f"t{i}") for i in range(k))).first()
        missing = np.array([sums[f"t{i}"] or 0.0 for i in range(k)]) - targets
        if np.abs(missing).max() <= TOLERANCE * max(targets.sum(), 1.0):
            break
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        steps.append(np.append(inverse @ missing, (pace - 1) / faster))
        pace = faster
    return steps


def held_tokens(members: DataFrame, k: int) -> np.ndarray:
    """Expected tokens of each domain, and the largest posterior of a document, as two rows."""
    p = [F.col("posterior")[i] for i in range(k)]
    row = members.agg(*(F.sum(F.col("n_tokens") * x) for x in p), *(F.max(F.when(F.col("n_tokens") > 0, x)) for x in p)).first()
    return np.array([x or 0.0 for x in row], dtype=np.float64).reshape(2, k)


def full_targets(members: DataFrame, shares: np.ndarray) -> np.ndarray:
    """Target tokens in these proportions; the domain with the largest share sets the total.

    A mixture's share of a domain is a mean of posteriors, so one above the largest of them
    is out of reach of any rates: only there the target is what the domain holds.
    """
    held, most = held_tokens(members, len(shares))
    largest = int(shares.argmax())
    targets = shares * held[largest] / shares[largest]
    return np.where((most < shares) & (np.arange(len(shares)) != largest), np.minimum(targets, held), targets)


def reachable(members: DataFrame, shares: np.ndarray) -> np.ndarray:
    """Target tokens in these proportions without repeating a domain.

    The domain with the largest share is taken whole and sets the total; a domain that
    holds less than its share of it is taken whole as well.
    """
    held = held_tokens(members, len(shares))[0]
    largest = int(shares.argmax())
    return np.minimum(shares * held[largest] / shares[largest], held)


def drawn(rate: Column, row_hash: Column) -> Column:
    """A whole number with the rate as its mean: the fraction is drawn by a hash of the row."""
    near = F.round(rate)
    share = F.pmod(row_hash, F.lit(1 << 20)) / float(1 << 20)
    return F.when(F.abs(rate - near) <= NOISE, near).otherwise(F.floor(rate) + (share < rate - F.floor(rate)).cast("int")).cast("long")


def _copies(steps: list[np.ndarray], names: dict[str, str], most: float) -> Column:
    return drawn(rate_of(steps, names["posterior"], most), F.xxhash64(plain(names["doc_id"]), plain(names["n_tokens"])))


OWN_NAMES = {name: name for name in ("doc_id", "n_tokens", "posterior")}


def _steps(members: DataFrame, targets: dict[tuple[int, int], float], repeats: bool, most: float) -> list[np.ndarray]:
    if most < 1:
        raise ValueError("a document may be taken once at least")
    shares = np.array([targets.get(d, 0.0) for d in DOMAINS], dtype=np.float64)
    shares /= shares.sum()
    steps = fit_rates(members, (full_targets if repeats else reachable)(members, shares), most=most)
    got = members.withColumn("copies", _copies(steps, OWN_NAMES, most))
    for r in achieved(got, targets):
        log.info("quality %d, toxic %d: share asked %.4f, achieved %.4f (%.0f tokens)", r["quality"], r["toxic"], r["asked"], r["achieved"], r["tokens"])
    return steps


def achieved(rows: DataFrame, targets: dict[tuple[int, int], float] = TARGETS) -> list[dict]:
    """Per domain of a result of mixed(): the share of tokens asked and achieved by the
    copies, the gap between them and the tokens. One row of sums comes to the driver."""
    shares = np.array([targets.get(d, 0.0) for d in DOMAINS], dtype=np.float64)
    shares /= shares.sum()
    tokens = held_tokens(rows.withColumn("n_tokens", F.col("n_tokens") * F.col("copies")), len(shares))[0]
    total = max(tokens.sum(), 1.0)
    return [
        {"quality": d[0], "toxic": d[1], "asked": float(a), "achieved": float(t / total), "gap": float(a - t / total), "tokens": float(t)}
        for d, a, t in zip(DOMAINS, shares, tokens)
    ]


def mixed(
    docs: DataFrame, labels: DataFrame, targets: dict[tuple[int, int], float] = TARGETS, repeats: bool = True, most: float = MOST
) -> DataFrame:
    """doc_id, n_tokens, posterior, rate and copies of each document."""
    members = common.checkpointed(memberships(docs, fit(docs, labels)), "memberships")
    steps = _steps(members, targets, repeats, most)
    return members.withColumn("rate", rate_of(steps, most=most)).withColumn("copies", _copies(steps, OWN_NAMES, most))


def taken(
    docs: DataFrame, labels: DataFrame, targets: dict[tuple[int, int], float] = TARGETS, repeats: bool = True, most: float = MOST
) -> DataFrame:
    """The documents as often as their rates say, with all their columns.

    Rates are fitted on the table of memberships and applied where the texts are, so no
    text is shuffled. A row gives at most ``most`` rows, so a task's output is bounded.
    """
    weights = fit(docs, labels)
    members = common.checkpointed(memberships(docs, weights), "memberships")
    steps = _steps(members, targets, repeats, most)
    rows, names = common.appended(docs, _posteriors(weights), MEMBERS)
    number = common.fresh_names(rows, ["number"])[0]
    # explode leaves out rows with no copies.
    many = rows.withColumn(number, F.explode(F.array_repeat(F.lit(0), _copies(steps, names, most).cast("int"))))
    return many.select(*map(plain, docs.columns))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    names = [F.col("posterior")[i].alias(f"p_quality{q}_toxic{t}") for i, (q, t) in enumerate(DOMAINS)]
    return out.select("doc_id", "n_tokens", *names, "rate", "copies")
