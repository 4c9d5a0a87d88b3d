"""A hidden Markov language model of texts, trained and scored over the whole corpus.

Tokens are lower-cased words and one end per text. Word counts of the training rows are a
distributed table. A token's class is its own for the most frequent words and a hash class
otherwise; states emit classes, and a class its words by their counts, so the probability
of a text is the forward recursion over classes times the shares of words in classes, and
sums to one over all texts of known and unknown words.

Baum-Welch counts are summed over all training rows: each task adds up its own and emits
one row per parameter. Texts are cut into chunks whose transfer matrices are computed side
by side; a scan over a text's chunks then gives the exact forward and backward values at
their borders, however long the text is.

Counts of the most frequent words (a fixed number) are sent to the tasks; all other words
are joined to the count table, one row per text and distinct word.

Defined cases: a NULL text is empty and has one token, its end; NULL ids are neither held
out nor learned from, and are scored; repeated rows are counted and scored one by one; an
empty table gives no rows; without training rows all words are unknown. Extra columns are
ignored.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .words import mix, words_of

HELD_OUT_MODULUS = 10
SMOOTHING = 0.1  # fixed value of the base score, also used within classes
STATES = 4
OWN_CLASSES = 767  # most frequent words with a class of their own
HASH_CLASSES = 256
HEAD_WORDS = 400_000  # words whose counts are sent to the tasks, at most
ROUNDS = 3
CHUNK = 64
PIECE_BYTES = 8 << 20

END = np.uint64(0x5E6D0F7A3C91B245)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each with its end; and where each text starts."""
    batch = words_of(column)
    n = len(batch.offsets) - 1
    out = np.empty(len(batch.hashes) + n, dtype=np.uint64)
    out[np.arange(len(batch.hashes)) + batch.doc] = batch.hashes
    first = batch.first + np.arange(n + 1)
    out[first[1:] - 1] = END
    return out, first


def _sums(place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values per place, as doubles even where there are none."""
    return np.bincount(place, values, minlength=n).astype(np.float64)


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """token (a 64-bit hash) and n over all texts of doc_id, text rows."""

    def work(piece: pa.RecordBatch) -> dict:
        tokens, _ = tokens_of(piece.column("text"))
        token, n = np.unique(_signed(tokens), return_counts=True)
        return {"token": token, "n": n.astype(np.int64)}

    def run(batches):
        for batch in batches:
            for piece in common.pieces(batch, "text", PIECE_BYTES):
                out = work(piece)
                yield pa.RecordBatch.from_arrays([pa.array(out["token"]), pa.array(out["n"])], names=["token", "n"])

    return docs.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Corpus:
    """What all tasks need of the counts; its size is bounded by parameters."""

    total: int
    distinct: int
    own: np.ndarray  # hashes of the words with a class, sorted
    own_class: np.ndarray
    head: np.ndarray  # hashes of frequent words, sorted
    head_count: np.ndarray
    class_total: np.ndarray
    class_distinct: np.ndarray

    def classes(self, tokens: np.ndarray) -> np.ndarray:
        """Class of each token: 0 is the end, then frequent words, then hash classes."""
        hashed = 1 + OWN_CLASSES + (mix(tokens) % np.uint64(HASH_CLASSES)).astype(np.int64)
        hashed[tokens == END] = 0
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, tokens), len(self.own) - 1)
            found = self.own[at] == tokens
            hashed[found] = self.own_class[at[found]]
        return hashed.astype(np.int32)

    def class_cost(self) -> np.ndarray:
        """Per class: log10 of the denominator of a word's share in it."""
        return np.log10(self.class_total + SMOOTHING * (self.class_distinct + 1))


N_CLASSES = 1 + OWN_CLASSES + HASH_CLASSES


def summary(counts: DataFrame, head_words: int = HEAD_WORDS) -> Corpus:
    """Totals, the frequent words and class totals of a count table.

    The head is all words that occur at least so often that no more than ``head_words``
    do; how often that is comes from the number of words per count, by powers of a ratio.
    """
    level = F.floor(F.log2("n") * 4)
    steps = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"), F.sum("n").alias("n"))
    rows = sorted(steps.collect(), key=lambda r: -r["level"])
    total, distinct = sum(r["n"] for r in rows), sum(r["words"] for r in rows)
    least, held = None, 0
    for row in rows:
        if held + row["words"] > head_words:
            break
        held, least = held + row["words"], row["least"]
    if least is None:
        head, head_count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    else:
        table = counts.where(F.col("n") >= least).toArrow()
        head = table.column("token").to_numpy().astype(np.int64).view(np.uint64)
        head_count = table.column("n").to_numpy().astype(np.int64)
        order = np.argsort(head)
        head, head_count = head[order], head_count[order]
    words = head != END
    best = np.lexsort((head[words], -head_count[words]))[:OWN_CLASSES]
    own = head[words][best]
    order = np.argsort(own)
    corpus = Corpus(total, distinct, own[order], (1 + order).astype(np.int64), head, head_count, None, None)
    # Class totals cover all words: the head here, the others where their counts are.
    class_total, class_distinct = np.zeros(N_CLASSES), np.zeros(N_CLASSES)
    classes = corpus.classes(head)
    class_total += np.bincount(classes, head_count, minlength=N_CLASSES)
    class_distinct += np.bincount(classes, minlength=N_CLASSES)
    rest = counts if least is None else counts.where(F.col("n") < least)

    def run(batches):
        for batch in batches:
            token = batch.column("token").to_numpy().view(np.uint64)
            n = batch.column("n").to_numpy()
            own = corpus.classes(token)
            sums, each = _sums(own, n, N_CLASSES), np.bincount(own, minlength=N_CLASSES)
            at = np.flatnonzero(each)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at]), pa.array(each[at])], names=["class", "n", "words"])

    sums = rest.mapInArrow(run, "class long, n double, words long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    for row in sums.collect():
        class_total[row["class"]] += row["n"]
        class_distinct[row["class"]] += row["words"]
    corpus.class_total, corpus.class_distinct = class_total, class_distinct
    return corpus


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states by classes

    @classmethod
    def initial(cls, class_total: np.ndarray, states: int = STATES, seed: int = 11) -> "Hmm":
        """Class frequencies, disturbed per state so that the states can part."""
        random = np.random.default_rng(seed)
        base = class_total + 1.0
        emit = base * random.uniform(0.4, 1.6, size=(states, len(base)))
        move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))

    @classmethod
    def from_counts(cls, counts: np.ndarray, class_total: np.ndarray, states: int) -> "Hmm":
        """Parameters from expected counts, smoothed so that nothing is impossible."""
        k, c = states, len(class_total)
        start = counts[:k] + 1.0
        move = counts[k : k + k * k].reshape(k, k) + 1.0
        prior = (class_total + 1.0) / (class_total + 1.0).sum()
        emit = counts[k + k * k :].reshape(k, c) + 10.0 * prior
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


class Chunks:
    """Class sequences cut into chunks, longest first, with their transfer matrices."""

    def __init__(self, model: Hmm, classes: np.ndarray, first: np.ndarray, width: int = CHUNK):
        self.model, self.classes = model, classes
        lengths = np.diff(first)
        per_text = -(-lengths // width)
        self.texts = len(lengths)
        text = np.repeat(np.arange(self.texts), per_text)
        number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        start = first[text] + number * width
        size = np.minimum(width, first[text + 1] - start)
        # Chunks of one text are found by its first chunk and their number.
        self.place = np.argsort(-size, kind="stable")
        self.at = np.empty_like(self.place)
        self.at[self.place] = np.arange(len(self.place))
        self.base = np.cumsum(per_text) - per_text
        self.per_text = per_text
        self.start, self.size = start[self.place], size[self.place]
        self.opening = (number == 0)[self.place]
        # active[t]: how many chunks have more than t tokens.
        self.active = np.searchsorted(-self.size, -np.arange(width), side="left")
        self._transfer()

    def emitted(self, t: int, n: int) -> np.ndarray:
        return self.model.emit.T[self.classes[self.start[:n] + t]]

    def _transfer(self) -> None:
        k = len(self.model.start)
        n = len(self.start)
        m = np.where(self.opening[:, None, None], np.eye(k), self.model.move)
        log = np.zeros(n)
        for t, n_t in enumerate(self.active):
            if not n_t:
                break
            part = m[:n_t] if t == 0 else (m[:n_t].reshape(-1, k) @ self.model.move).reshape(-1, k, k)
            part = part * self.emitted(t, n_t)[:, None, :]
            if t % 8 == 7 or t == len(self.active) - 1:
                top = part.max(axis=(1, 2))
                part /= top[:, None, None]
                log[:n_t] += np.log(top)
            m[:n_t] = part
        self.matrix, self.log = m, log

    def forward(self) -> np.ndarray:
        """Natural log probability of each text; keeps the vectors that enter the chunks."""
        k = len(self.model.start)
        self.enter = np.empty((len(self.start), k))
        vector = np.tile(self.model.start, (self.texts, 1))
        total = np.zeros(self.texts)
        order = np.argsort(-self.per_text, kind="stable")
        most = int(self.per_text.max()) if self.texts else 0
        counts = np.searchsorted(-self.per_text[order], -np.arange(most), side="left")
        self.scan = (order, counts)
        for j in range(most):
            texts = order[: counts[j]]
            chunk = self.at[self.base[texts] + j]
            self.enter[chunk] = vector[texts]
            moved = np.einsum("ni,nij->nj", vector[texts], self.matrix[chunk])
            size = moved.sum(axis=1)
            vector[texts] = moved / size[:, None]
            total[texts] += np.log(size) + self.log[chunk]
        return total

    def expected(self) -> np.ndarray:
        """Baum-Welch counts of all texts: starts, moves, emissions, in one vector."""
        model, k = self.model, len(self.model.start)
        self.forward()
        order, counts = self.scan
        leave = np.empty((len(self.start), k))
        vector = np.ones((self.texts, k))
        for j in range(len(counts) - 1, -1, -1):
            texts = order[: counts[j]]
            chunk = self.at[self.base[texts] + j]
            leave[chunk] = vector[texts]
            moved = np.einsum("nij,nj->ni", self.matrix[chunk], vector[texts])
            vector[texts] = moved / moved.sum(axis=1, keepdims=True)
        alphas, alpha = [], self.enter
        for t, n_t in enumerate(self.active):
            if not n_t:
                break
            step = alpha[:n_t] @ model.move
            if t == 0:
                step[self.opening] = alpha[self.opening]
            alpha = step * self.emitted(t, n_t)
            alpha /= alpha.sum(axis=1, keepdims=True)
            alphas.append(alpha)
        starts, moves = np.zeros(k), np.zeros((k, k))
        emits = np.zeros((k, model.emit.shape[1]))
        beta = leave
        for t in range(len(alphas) - 1, -1, -1):
            n_t = self.active[t]
            gamma = alphas[t] * beta[:n_t]
            gamma /= gamma.sum(axis=1, keepdims=True)
            classes = self.classes[self.start[:n_t] + t]
            for s in range(k):
                emits[s] += np.bincount(classes, gamma[:, s], minlength=emits.shape[1])
            weight = self.emitted(t, n_t) * beta[:n_t]
            if t:
                before, own = alphas[t - 1][:n_t], weight
            else:
                starts += gamma[self.opening].sum(axis=0)
                before, own = self.enter[~self.opening], weight[~self.opening]
            share = own / np.einsum("ni,ni->n", before @ model.move, own)[:, None]
            moves += model.move * (before.T @ share)
            back = weight @ model.move.T
            back /= back.sum(axis=1, keepdims=True)
            beta = beta.copy() if t == len(alphas) - 1 else beta
            beta[:n_t] = back
        return np.concatenate((starts, moves.ravel(), emits.ravel()))


def baum_welch(docs: DataFrame, corpus: Corpus, model: Hmm) -> Hmm:
    """One round over all rows: each task sums its counts, Spark sums those of the tasks."""
    k = len(model.start)
    shared = docs.sparkSession.sparkContext.broadcast((corpus.own, corpus.own_class, model))

    def run(batches):
        own, own_class, current = shared.value
        lookup = Corpus(0, 0, own, own_class, None, None, None, None)
        total = None
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                tokens, first = tokens_of(piece.column("text"))
                counts = Chunks(current, lookup.classes(tokens), first).expected()
                total = counts if total is None else total + counts
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    sums = docs.mapInArrow(run, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(k + k * k + k * N_CLASSES)
    for row in sums:
        counts[row["at"]] = row["n"]
    return Hmm.from_counts(counts, corpus.class_total, k)


PARTS = (
    "row long, doc_id long, n_tokens long, n_known long, logs double, score double, token long, n long"
)


def _parts(docs: DataFrame, corpus: Corpus, model: Hmm) -> DataFrame:
    """A row per text with what the head gives, and rows of texts' other words.

    Rows of a text have token NULL; those of its other words have token and n. ``row``
    numbers the texts; the frame must be written once, so that both kinds agree on it.
    """
    shared = docs.sparkSession.sparkContext.broadcast((corpus, model))

    def run(batches):
        known, current = shared.value
        cost = known.class_cost()
        logs_of_head = np.log10(known.head_count + SMOOTHING)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                tokens, first = tokens_of(piece.column("text"))
                n, doc = len(first) - 1, np.repeat(np.arange(len(first) - 1), np.diff(first))
                classes = known.classes(tokens)
                log = Chunks(current, classes, first).forward() / np.log(10)
                at = np.minimum(np.searchsorted(known.head, tokens), max(len(known.head) - 1, 0))
                found = known.head[at] == tokens if len(known.head) else np.zeros(len(tokens), dtype=bool)
                logs = _sums(doc[found], logs_of_head[at[found]], n)
                score = log - _sums(doc, cost[classes], n)
                rows = row + np.arange(n)
                row += n
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows), piece.column("doc_id"), pa.array(np.diff(first).astype(np.int64)),
                        pa.array(np.bincount(doc[found], minlength=n)), pa.array(logs), pa.array(score), none, none,
                    ],
                    names=NAMES,
                )
                rest, owner = tokens[~found], doc[~found]
                if not len(rest):
                    continue
                order = np.lexsort((rest, owner))
                rest, owner = rest[order], owner[order]
                head = np.flatnonzero(np.concatenate(([True], (rest[1:] != rest[:-1]) | (owner[1:] != owner[:-1]))))
                times = np.diff(np.concatenate((head, [len(rest)])))
                m = len(head)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[owner[head]]), *(pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())),
                        pa.array(_signed(rest[head])), pa.array(times.astype(np.int64)),
                    ],
                    names=NAMES,
                )

    return docs.mapInArrow(run, PARTS)


NAMES = ["row", "doc_id", "n_tokens", "n_known", "logs", "score", "token", "n"]


def scores(docs: DataFrame, counts: DataFrame, corpus: Corpus, model: Hmm) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of each text."""
    parts = common.checkpointed(_parts(docs, corpus, model), "token-parts")
    rest = parts.where("token is not null").select("row", "token", "n")
    known = counts.select("token", F.col("n").alias("c"))
    count = F.coalesce("c", F.lit(0))
    joined = rest.join(known, "token", "left").select(
        "row",
        (F.col("n") * F.log10(count + F.lit(SMOOTHING))).alias("more_logs"),
        F.when(count > 0, F.col("n")).otherwise(0).alias("more_known"),
    )
    more = joined.groupBy("row").agg(F.sum("more_logs").alias("more_logs"), F.sum("more_known").alias("more_known"))
    texts = parts.where("token is null").drop("token", "n").join(more, "row", "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    cost = float(np.log10(corpus.total + SMOOTHING * (corpus.distinct + 1)))
    return texts.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (logs - F.col("n_tokens") * cost).alias("base_score"),
        (logs + F.col("score")).alias("score"),
    )


def language_scores(docs: DataFrame, modulus: int = HELD_OUT_MODULUS, rounds: int = ROUNDS, states: int = STATES, head_words: int = HEAD_WORDS) -> DataFrame:
    """Learn from the rows outside fold 0 of ``modulus`` and score every row."""
    texts = common.id_and_text(docs)
    fold = common.crc_remainder(modulus)
    learned = texts.where(fold != 0)
    counts = common.checkpointed(word_counts(learned), "word-counts")
    corpus = summary(counts, head_words)
    model = Hmm.initial(corpus.class_total, states)
    for _ in range(rounds):
        model = baum_welch(learned, corpus, model)
    out = scores(texts, counts, corpus, model)
    held = F.coalesce(fold == 0, F.lit(False))
    return out.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known",
        F.lit(corpus.total).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(common.table(spark, sf_dir, "documents"))
