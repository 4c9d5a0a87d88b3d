"""Quality rules: counts over whole texts, judged by an isolation forest.

Base rules reject short texts and texts that mostly repeat themselves. The method is an
isolation forest: random splits over rule statistics, each tree grown on a few rows that it
draws from labelled good documents. A document that few splits isolate is unlike them. The
threshold on the score is calibrated on all other labelled rows, so that nearly all good
ones stay.

Defined cases: a NULL or empty text has no words and fails the base rules; a NULL id is
returned as NULL; repeated rows are judged one by one; an empty table gives no rows; without
labelled rows of quality 1 only the base rules decide. Extra columns are ignored.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import plain
from ..sources.local import local_frame
from . import common
from .words import WHITE, WordBatch, span_hashes, spans_of, text_bytes, windows, words_of

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

TREES = 200
TREE_ROWS = 256
MARGIN = 0.5  # how far cuts reach beyond the range of a node's rows, in ranges
LEAST_RANGE = 0.2  # a narrower range, or a constant, counts as so wide
MAX_GOOD_LOSS = 0.002  # share of good calibration rows that the forest may reject

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, features array<float>"
)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?;:\"'()[]{}=+_~^/\\@-")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_HEAD = np.ones(256, dtype=bool)  # first bytes of code points
_HEAD[0x80:0xC0] = False
_LINE_FEED = ord("\n")


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _found_before(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: does an equal one of its document precede it, is there any other."""
    order = np.lexsort((np.arange(len(value)), value, doc))
    d, v = doc[order], value[order]
    same = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    again = np.zeros(len(value), dtype=bool)
    several = np.zeros(len(value), dtype=bool)
    again[order[1:]] = same
    several[order[1:]] = same
    several[order[:-1]] |= same
    return again, several


def _duplicate_lines(batch: WordBatch) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(batch.offsets) - 1
    raw, offsets = batch.raw, batch.offsets
    breaks = np.flatnonzero(raw == _LINE_FEED)
    starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    starts = starts[starts < len(raw)]
    ends = np.concatenate((starts[1:], [len(raw)])) if len(starts) else starts
    # The line feed itself belongs to no line.
    ends = np.where((ends > starts) & (raw[np.maximum(ends - 1, 0)] == _LINE_FEED), ends - 1, ends)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    total = np.concatenate(([0], np.cumsum(~WHITE[raw], dtype=np.int64)))
    wordy = total[ends] > total[starts]
    starts, ends, doc = starts[wordy], ends[wordy], doc[wordy]
    again, _ = _found_before(doc, span_hashes(raw, starts, ends))
    return np.bincount(doc[again], minlength=n)


def _repeated_words(batch: WordBatch, width: int = 3) -> np.ndarray:
    """Words inside windows that occur at least twice in their text."""
    n = len(batch.offsets) - 1
    hashes, at = windows(batch, width)
    _, several = _found_before(batch.doc[at], hashes)
    covered = np.zeros(len(batch.starts), dtype=bool)
    for k in range(width):
        covered[at[several] + k] = True
    return np.bincount(batch.doc[covered], minlength=n)


def statistics(piece: pa.RecordBatch) -> dict:
    """The counts of each text of a batch and the shares the forest looks at."""
    batch = words_of(piece.column("text"), lower=False)
    raw, offsets = batch.raw, batch.offsets
    n = len(offsets) - 1
    inside = ~WHITE[raw]
    words = batch.counts.astype(np.int64)
    chars = _sums(inside & _HEAD[raw], offsets)
    symbols = _sums(_SYMBOL[raw], offsets)
    upper = _sums(_UPPER[raw], offsets)
    marks = _sums(_MARK[raw], offsets)
    digits = _sums(_DIGIT[raw], offsets)
    lines = _duplicate_lines(batch)
    repeated = _repeated_words(batch)
    breaks = _sums(raw == _LINE_FEED, offsets) + 1
    _, several = _found_before(batch.doc, batch.hashes)
    unique = np.bincount(batch.doc[~several], minlength=n)
    some, some_chars = np.maximum(words, 1), np.maximum(chars, 1)
    features = np.stack(
        [
            chars / some,
            symbols / some,
            upper / some_chars,
            marks / some_chars,
            digits / some_chars,
            np.minimum(lines / breaks, 1.0),
            repeated / some,
            unique / some,
        ],
        axis=1,
    ).astype(np.float32)
    width = features.shape[1]
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.array(features.ravel())
    )
    return {
        "doc_id": piece.column("doc_id"),
        "n_words": words,
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": lines.astype(np.int64),
        "n_repeat_words": repeated.astype(np.int64),
        "features": lists,
    }


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the five counts and the array of shares."""
    return common.by_pieces(common.id_and_text(docs, id_col, text_col), statistics, SCHEMA)


def base_failed():
    """The base rules, on the counts."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def _path_scale(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


@dataclass
class IsolationForest:
    """Trees as arrays: split feature (-1: leaf), split value, left child, path length.

    The right child follows the left one. ``threshold`` is on the score of ``score``.
    """

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    length: np.ndarray
    roots: np.ndarray
    scale: float
    threshold: float = 1.0

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path length over its expectation."""
        total = np.zeros(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            open_rows = np.arange(len(rows))
            while len(open_rows):
                at = node[open_rows]
                inner = self.feature[at] >= 0
                open_rows, at = open_rows[inner], at[inner]
                right = rows[open_rows, self.feature[at]] >= self.value[at]
                node[open_rows] = self.left[at] + right
            total += self.length[node]
        return np.exp2(-total / len(self.roots) / self.scale)


def grow(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> IsolationForest:
    """Random splits of random subsets of ``rows``, a bounded sample."""
    random = np.random.default_rng(seed)
    take = min(tree_rows, len(rows))
    limit = int(np.ceil(np.log2(max(take, 2)))) + 4
    feature, value, left, length, roots = [], [], [], [], []

    def add() -> int:
        for column, empty in ((feature, -1), (value, 0.0), (left, 0), (length, 0.0)):
            column.append(empty)
        return len(feature) - 1

    for _ in range(trees):
        root = add()
        roots.append(root)
        todo = [(root, random.choice(len(rows), take, replace=False), 0)]
        while todo:
            node, own, depth = todo.pop()
            if depth >= limit or len(own) <= 1:
                length[node] = depth + _path_scale(len(own))
                continue
            column = int(random.integers(rows.shape[1]))
            values = rows[own, column]
            low, high = values.min(), values.max()
            # Cuts outside the range isolate values that no good row has.
            margin = MARGIN * max(high - low, LEAST_RANGE)
            cut = random.uniform(low - margin, high + margin)
            right = values >= cut
            feature[node], value[node] = column, cut
            left[node] = add()
            add()
            todo.append((left[node], own[~right], depth + 1))
            todo.append((left[node] + 1, own[right], depth + 1))
    return IsolationForest(
        np.array(feature), np.array(value, dtype=np.float32), np.array(left), np.array(length), np.array(roots), _path_scale(take)
    )


def calibrated(forest: IsolationForest, rows: np.ndarray, good: np.ndarray, loss: float = MAX_GOOD_LOSS) -> IsolationForest:
    """Set the threshold from labelled rows.

    Among thresholds that reject at most ``loss`` of the good rows, the one that rejects the
    most bad rows, half way to the next lower score; without bad rows, beyond every score.
    """
    scores = forest.score(rows)
    good_scores = np.sort(scores[good])
    bad_scores = scores[~good]
    lost = int(loss * len(good_scores))
    floor = good_scores[len(good_scores) - 1 - lost] if len(good_scores) else 1.0
    above = bad_scores[bad_scores > floor]
    forest.threshold = float((floor + above.min()) / 2) if len(above) else np.inf
    return forest


def _scored(rows: DataFrame, forest: IsolationForest, names: list[str]) -> DataFrame:
    """The named columns and the score of the features."""
    kinds = dict(rows.dtypes)

    def run(batches):
        for batch in batches:
            shares = np.asarray(batch.column("features").flatten()).reshape(len(batch), -1)
            score = forest.score(shares) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(score)], names=[*names, "score"])

    schema = ", ".join(f"{n} {kinds[n]}" for n in names)
    return rows.select(*names, "features").mapInArrow(run, f"{schema}, score double")


def labelled_statistics(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, features, good of all documents with an unambiguous label that pass the base
    rules; one row per id."""
    known = common.known_labels(labels, "quality")
    rows = stats.where(~base_failed()).select("doc_id", "features").groupBy("doc_id").agg(F.min("features").alias("features"))
    return rows.join(known, "doc_id").select("doc_id", "features", (F.col("label") == 1).alias("good"))


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``number``: how many good ones there are up to the row, by id. Ids are
    dealt out by range; only a count per range reaches the driver."""
    # The numbers of the ranges hold once they are written.
    dealt = common.checkpointed(rows.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "labelled-statistics")
    before, seen = [], 0
    for part, n in dealt.groupBy("part").agg(F.count_if("good")).sort("part").collect():
        before.append((part, seen))
        seen += n
    up_to = F.sum(F.col("good").cast("long")).over(W.partitionBy("part").orderBy("doc_id"))
    return dealt.withColumn("within", up_to).join(local_frame(rows.sparkSession, before, "part int, seen long"), "part").select(
        "doc_id", "features", "good", (F.col("seen") + F.col("within")).alias("number")
    )


def fit(stats: DataFrame, labels: DataFrame, loss: float = MAX_GOOD_LOSS) -> IsolationForest | None:
    """A forest from the statistics of all labelled documents; None without good ones.

    Every second good row is one that trees draw their rows from; as many as all trees can
    hold come to the driver, those with the smallest hashes. All other labelled rows
    calibrate the threshold, as :func:`calibrated` does, where they are. Rows that fail the
    base rules take no part.
    """
    rows = _numbered(labelled_statistics(stats, labels))
    grows = F.col("good") & (F.col("number") % 2 == 1)
    pool = rows.where(grows).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TREES * TREE_ROWS).select("doc_id", "features").toPandas()
    pool = pool.sort_values("doc_id")
    if len(pool) < 2:
        return None
    forest = grow(np.array(pool["features"].tolist(), dtype=np.float32))
    rest = common.checkpointed(_scored(rows.where(~grows), forest, ["good"]), "calibration")
    lost = int(loss * rest.where("good").count())
    floor = rest.where("good").orderBy(F.desc("score")).limit(lost + 1).agg(F.min("score")).first()[0]
    floor = 1.0 if floor is None else floor
    above = rest.where(~F.col("good") & (F.col("score") > floor)).agg(F.min("score")).first()[0]
    forest.threshold = np.inf if above is None else float((floor + above) / 2)
    return forest


def judged(stats: DataFrame, forest: IsolationForest | None) -> DataFrame:
    """Add base_failed, score (NULL without a forest) and kept to the statistics."""
    stats = stats.withColumn("base_failed", base_failed())
    if forest is None:
        return stats.withColumns({"score": F.lit(None).cast("double"), "kept": ~F.col("base_failed")}).drop("features")
    names = [c for c in stats.columns if c != "features"]
    return _scored(stats, forest, names).withColumn("kept", ~F.col("base_failed") & (F.col("score") < forest.threshold))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: counts, base verdict, score and final verdict."""
    stats = common.checkpointed(rule_statistics(docs), "rule-statistics")
    return judged(stats, fit(stats, labels))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that base rules and forest keep, with all their columns."""
    forest = fit(rule_statistics(docs), labels)

    def verdict(piece: pa.RecordBatch) -> dict:
        found = statistics(piece)
        words = np.asarray(found["n_words"])
        kept = (words >= MIN_WORDS) & (100 * np.asarray(found["n_repeat_words"]) <= MAX_REPEATED_PERCENT * words)
        if forest is not None:
            features = np.asarray(found["features"].flatten()).reshape(len(words), -1)
            kept &= forest.score(features) < forest.threshold
        return {"kept": kept}

    judged_docs, names = common.appended(docs, verdict, "kept boolean")
    return judged_docs.where(plain(names["kept"])).drop(names["kept"])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "score")
