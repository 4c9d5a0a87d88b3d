"""Quality classifier: logistic regression on hashed word n-grams, learned by FTRL.

Words and pairs of words are hashed to a fixed number of weights. The weights are learned
by follow-the-regularised-leader updates, one example after the other, on a bounded sample
of labelled documents; L1 keeps most of them at zero. A score is the sparse dot product of
a document's n-gram shares with the weights, through the logistic function.

Words are counted as they are and by their shape (upper, lower and mixed case, digits,
marks at their end), by whether they repeat, and the text by its size, so that texts of
unseen words are scored too.

Defined cases: NULL and empty texts have the bias as their only feature; NULL ids are never
held out, never learned from, and scored; repeated rows are scored one by one; contradictory
labels are not learned from; without labels every score is the prior 0.5; an empty table
gives no rows. Extra columns are ignored; only the text enters a score.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .words import WordBatch, mix, span_hashes, words_of

BITS = 18
SAMPLE_ROWS = 12_000  # labelled rows learned from at most
HELD_OUT_MODULUS = 5
THRESHOLD = 0.3
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 1.0
TWIN, AGAIN, SIZE = 1, 2, 1000  # names of features that are not words
FEATURE_SCALE = 4.0  # a document's n-gram shares are divided by their norm, then scaled

SCORES = "doc_id long, score double"

# One letter stands for each kind of byte; the shape of a word is its run of kinds.
_KIND = np.full(256, ord("a"), dtype=np.uint8)
_KIND[ord("A") : ord("Z") + 1] = ord("A")
_KIND[ord("0") : ord("9") + 1] = ord("9")
for _c in range(0x21, 0x7F):
    if not chr(_c).isalnum():
        _KIND[_c] = _c


def _shapes(piece_words: WordBatch) -> np.ndarray:
    """A hash of each word's shape: its bytes by kind, equal neighbours once."""
    kinds = _KIND[piece_words.raw]
    change = np.ones(len(kinds), dtype=bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change[piece_words.starts] = True
    kept = np.concatenate(([0], np.cumsum(change)))
    return span_hashes(kinds[change], kept[piece_words.starts], kept[piece_words.ends])


def _named(number: int, times: int) -> np.ndarray:
    return np.full(int(times), mix(np.array([number], dtype=np.uint64))[0])


def _seen_before(batch: WordBatch) -> np.ndarray:
    """Words that an equal word of their text precedes."""
    order = np.lexsort((np.arange(len(batch.hashes)), batch.hashes, batch.doc))
    out = np.zeros(len(order), dtype=bool)
    h, d = batch.hashes[order], batch.doc[order]
    out[order[1:]] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    return out


@dataclass
class Sparse:
    """Feature numbers and values of a batch; ``first[d]:first[d + 1]`` belong to text d,
    which has ``words[d]`` words."""

    index: np.ndarray
    value: np.ndarray
    first: np.ndarray
    words: np.ndarray


def features(column: pa.Array, bits: int = BITS) -> Sparse:
    """Hashed words, word pairs and shapes of each text, as normed square-rooted counts."""
    cased = words_of(column, lower=False, hashed=False)
    lower = words_of(column, lower=True)
    n = len(lower.offsets) - 1
    shape = _shapes(cased)
    one = lower.hashes
    same = lower.doc[1:] == lower.doc[:-1]
    two = mix(one[:-1] * np.uint64(3) + one[1:] * np.uint64(0x9FB21C651E98DF25))[same]
    # A pair of equal words is also counted as such, whatever the word; likewise each word
    # that was in the text before.
    twin = same & (one[:-1] == one[1:])
    again = _seen_before(lower)
    hashes = np.concatenate((one, two, mix(shape + np.uint64(17)), _named(TWIN, twin.sum()), _named(AGAIN, again.sum())))
    doc = np.concatenate((lower.doc, lower.doc[:-1][same], lower.doc, lower.doc[:-1][twin], lower.doc[again]))
    # Number 0 is the bias; the others are spread over the rest.
    number = 1 + (hashes >> np.uint64(64 - bits)).astype(np.int64) % ((1 << bits) - 1)
    keys, counts = np.unique(doc.astype(np.int64) << bits | number, return_counts=True)
    # The bias, and the size of the text in powers of two, are features of their own.
    size = np.frexp(lower.counts)[1].astype(np.uint64)
    size = 1 + (mix(size + np.uint64(SIZE)) >> np.uint64(64 - bits)).astype(np.int64) % ((1 << bits) - 1)
    texts = np.arange(n, dtype=np.int64) << bits
    plain_ = np.zeros(n, dtype=counts.dtype)
    keys = np.concatenate((keys, texts, texts | size))
    counts = np.concatenate((counts, plain_, plain_))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    doc, index = keys >> bits, keys & ((1 << bits) - 1)
    value = np.sqrt(counts.astype(np.float64))
    norm = np.sqrt(np.bincount(doc, value * value, minlength=n))
    value = value * FEATURE_SCALE / np.maximum(norm, 1e-9)[doc]
    value[counts == 0] = 1.0
    return Sparse(index, value, np.searchsorted(doc, np.arange(n + 1)), lower.counts.astype(np.int64))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """Follow-the-regularised-leader updates with a learning rate per weight."""

    def __init__(self, size: int, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, index=slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        gradient = (sigmoid(w @ value) - label) * value
        squared = gradient * gradient
        rate = (np.sqrt(self.n[index] + squared) - np.sqrt(self.n[index])) / self.alpha
        self.z[index] += gradient - rate * w
        self.n[index] += squared


def fit(docs: DataFrame, labels: DataFrame, keep=None, rows: int = SAMPLE_ROWS, bits: int = BITS) -> np.ndarray:
    """Weights learned from at most ``rows`` labelled documents that ``keep`` admits.

    Features are hashed where the texts are; numbers and single-precision values of the
    bounded sample come to the driver, and are learned in the order of a hash of the id.
    """
    sample = common.labelled_sample(docs, labels, "quality", rows, keep)

    def run(batches):
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                x = features(piece.column("text"), bits)
                first = pa.array(x.first.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("label"),
                        pa.ListArray.from_arrays(first, pa.array(x.index.astype(np.int32))),
                        pa.ListArray.from_arrays(first, pa.array(x.value.astype(np.float32))),
                    ],
                    names=["doc_id", "label", "index", "value"],
                )

    rows_ = sample.mapInArrow(run, "doc_id long, label int, index array<int>, value array<float>")
    table = rows_.toArrow()
    learner = Ftrl(1 << bits)
    ids = table.column("doc_id").to_numpy().astype(np.uint64)
    order = np.lexsort((ids, mix(ids)))
    label = table.column("label").to_numpy()
    index, value = (table.column(c).combine_chunks() for c in ("index", "value"))
    first = np.asarray(index.offsets)
    index, value = np.asarray(index.values), np.asarray(value.values).astype(np.float64)
    for _ in range(EPOCHS):
        for i in order:
            own = slice(first[i], first[i + 1])
            learner.learn(index[own], value[own], int(label[i]))
    return learner.weights().astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the probability of label 1. The weights are broadcast: a fixed size."""
    bits = int(len(weights)).bit_length() - 1

    def work(piece: pa.RecordBatch) -> dict:
        x = features(piece.column("text"), bits)
        products = np.concatenate(([0.0], np.cumsum(x.value * weights[x.index])))
        return {"doc_id": piece.column("doc_id"), "score": sigmoid(products[x.first[1:]] - products[x.first[:-1]])}

    return common.by_pieces(common.id_and_text(docs, id_col, text_col), work, SCORES)


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = HELD_OUT_MODULUS) -> DataFrame:
    """Learn on the rows outside the fold 0 of ``modulus`` and score every row."""
    weights = fit(docs, labels, common.crc_remainder(modulus) != 0)
    held = F.coalesce(common.crc_remainder(modulus) == 0, F.lit(False))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    scored = score(docs, weights).withColumns({"held_out": held, "predicted": predicted})
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
