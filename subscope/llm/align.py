"""Alignment of two tokenizers' tokens of the same text, by divide and conquer.

Both tokenizers cut the same bytes. Where tokens of both end at one offset, the text falls
into groups; tokens of a group have no other common end inside it. The common ends are
found by divide and conquer: in an interval of first-tokenizer tokens the end nearest to
the middle that is also an end of the second one is located by bisection, and both halves
are worked on in the same way; an interval without such an end is a group. All intervals of
a batch of texts are worked on side by side, one level of the recursion after the other,
and the search leaves the middle in steps that double, so that a level is a few array
operations and a long interval without a common end is looked at about once.

Two tokens whose bytes overlap are linked. The ends of both tokenizers together cut a text
into parts, and each part is one link. How often a pair of ids is linked in the corpus is
counted by Spark over the texts' distinct pairs. Counts of the most frequent pairs (a fixed
number) are sent to the tasks; all others are joined, one row per text and distinct pair.

Defined cases: texts that are NULL, empty, or whose tokens do not give their bytes back
have no tokens; strings of special tokens are plain text; NULL ids are returned as NULL;
rows that repeat are texts of their own and counted each; an empty table gives no rows.
Extra columns are ignored.
"""

import hashlib
import json
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common
from .bpe import _byte_alphabet, vocabulary_path

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
HEAD_PAIRS = 400_000  # pairs whose counts are sent to the tasks, at most

# Fixed value: how the byte-level vocabulary splits texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that all Unicode tables agree on. Texts with others, and texts with very long
# words, go to the slower of two encoders of the same vocabulary.
AGREED = re.compile("[\x00-ɏ‐-‧‰-›€]*")
LONG_WORD = re.compile(r"\S{2000}|\s{2000}")


class ByteLevel:
    """Byte-level BPE as the tokenizers library encodes it, special tokens being plain text.

    Most texts are encoded from the same vocabulary by ranks, which is several times faster.
    """

    def __init__(self, file: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        alphabet = _byte_alphabet()
        data = json.loads(file)
        special = {t["content"] for t in data["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in name): i for name, i in data["model"]["vocab"].items() if name not in special}
        self.size = max(data["model"]["vocab"].values()) + 1
        self.lengths = np.zeros(self.size, dtype=np.int64)
        for name, i in ranks.items():
            self.lengths[i] = len(name)
        self.fast = tiktoken.Encoding("byte level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_str(file.decode("utf-8"))
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()

    def encode(self, text: str) -> np.ndarray:
        if AGREED.fullmatch(text) and not LONG_WORD.search(text):
            return np.array(self.fast.encode_ordinary(text), dtype=np.int64)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int64)


class Pieces:
    """BPE of pieces with byte fallback as the sentencepiece library encodes it."""

    def __init__(self, file: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        self.size = self.model.get_piece_size()
        self.bytes = [self._bytes(i) for i in range(self.size)]
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode("utf-8")

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


@dataclass
class Pair:
    """Both tokenizers. The files' bytes travel, so no executor needs their paths."""

    first_file: bytes
    second_file: bytes
    made: tuple[ByteLevel, Pieces] | None = field(default=None, compare=False)

    @classmethod
    def read(cls, first: str, second: str) -> "Pair":
        with open(first, "rb") as a, open(second, "rb") as b:
            return cls(a.read(), b.read())

    def __getstate__(self):
        return self.first_file, self.second_file

    def __setstate__(self, state):
        self.first_file, self.second_file = state
        self.made = None

    def tokenizers(self) -> tuple[ByteLevel, Pieces]:
        if self.made is None:
            self.made = ByteLevel(self.first_file), Pieces(self.second_file)
        return self.made


def common_ends(ends: np.ndarray, others: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of the sorted ``ends`` are in the sorted ``others``, by divide and conquer.

    ``low`` and ``high``: first and last place of intervals of ``ends``; the last of an
    interval is known to be common.
    """
    found = np.zeros(len(ends), dtype=bool)
    found[high] = True
    low, high = low[high > low], high[high > low]
    while len(low):
        middle = (low + high - 1) >> 1
        cut = np.where(_among(ends[middle], others), middle, -1)
        rest = np.flatnonzero(cut < 0)
        cut[rest] = _nearest(ends, others, low[rest], high[rest], middle[rest])
        hit = cut >= 0
        found[cut[hit]] = True
        # Both halves of each interval, in order, so that values are looked up in order.
        low = np.stack((low[hit], cut[hit] + 1), axis=1).ravel()
        high = np.stack((cut[hit], high[hit]), axis=1).ravel()
        low, high = low[high > low], high[high > low]
    return found


def _among(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    return others[np.minimum(np.searchsorted(others, values), len(others) - 1)] == values


def _nearest(ends: np.ndarray, others: np.ndarray, low: np.ndarray, high: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Per interval the place nearest to its middle whose end is common, or -1: places at
    distances from 1, from 2, from 4 and so on, on both sides."""
    cut = np.full(len(low), -1, dtype=np.int64)
    open_, reach = np.flatnonzero((middle > low) | (middle < high - 1)), 1
    while len(open_):
        at = middle[open_]
        left, right = np.maximum(at - 2 * reach + 1, low[open_]), at + reach
        n_left = np.maximum(at - reach - left + 1, 0)
        counts = n_left + np.maximum(np.minimum(at + 2 * reach - 1, high[open_] - 1) - right + 1, 0)
        owner = np.repeat(np.arange(len(open_)), counts)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = np.where(step < n_left[owner], left[owner] + step, right[owner] + step - n_left[owner])
        hit = _among(ends[place], others)
        owner, place = owner[hit], place[hit]
        far = np.abs(place - at[owner])
        least = np.full(len(open_), 2 * reach)
        np.minimum.at(least, owner, far)
        nearest = far == least[owner]
        cut[open_[owner[nearest]]] = place[nearest]
        reach *= 2
        more = cut[open_] < 0
        more &= (at - reach >= low[open_]) | (at + reach <= high[open_] - 1)
        open_ = open_[more]
    return cut


@dataclass
class Aligned:
    """Tokens and groups of a batch of texts, one text after the other."""

    a: np.ndarray  # ids
    b: np.ndarray
    a_first: np.ndarray  # per text, and one more: its first token
    b_first: np.ndarray
    a_cut: np.ndarray  # is the token the last of its group?
    b_cut: np.ndarray
    a_end: np.ndarray  # byte offsets in the batch
    b_end: np.ndarray

    def groups(self) -> np.ndarray:
        """Groups of each text."""
        return np.diff(np.concatenate(([0], np.cumsum(self.a_cut)))[self.a_first])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of each link, in order of the text: places in ``a`` and in ``b``."""
        ends = np.concatenate((self.a_end, self.b_end[~self.b_cut]))
        ends.sort(kind="stable")
        return np.searchsorted(self.a_end, ends), np.searchsorted(self.b_end, ends)


def align(texts: list[str | None], pair: Pair) -> Aligned:
    first, second = pair.tokenizers()
    a_ids, b_ids = [], []
    for text in texts:
        a, b = [], []
        if text:
            b = second.encode(text)
            if b"".join([second.bytes[i] for i in b]) == b" " + text.encode("utf-8"):
                a = first.encode(" " + text)
            else:
                b = []
        a_ids.append(np.asarray(a, dtype=np.int64))
        b_ids.append(np.asarray(b, dtype=np.int64))
    a_first = np.concatenate(([0], np.cumsum([len(x) for x in a_ids]))).astype(np.int64)
    b_first = np.concatenate(([0], np.cumsum([len(x) for x in b_ids]))).astype(np.int64)
    a = np.concatenate(a_ids) if a_ids else np.zeros(0, np.int64)
    b = np.concatenate(b_ids) if b_ids else np.zeros(0, np.int64)
    a_end, b_end = np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b])
    some = np.diff(a_first) > 0
    a_cut = common_ends(a_end, b_end, a_first[:-1][some], a_first[1:][some] - 1)
    b_cut = np.zeros(len(b), dtype=bool)
    b_cut[np.searchsorted(b_end, a_end[a_cut])] = True
    return Aligned(a, b, a_first, b_first, a_cut, b_cut, a_end, b_end)


class Shown:
    """The groups of texts as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, first: ByteLevel, second: Pieces):
        self.start = 2 * first.size
        names = [b"%d%c" % (i, c) for i in range(first.size) for c in b",|"]
        names += [b"%d%c" % (i, c) for i in range(second.size) for c in b",;"]
        self.names = np.array(names, dtype=object)

    def texts(self, found: Aligned) -> list[bytes]:
        # A group's first tokens come after the second ones of all groups before it.
        a_group = np.cumsum(found.a_cut) - found.a_cut
        b_group = np.cumsum(found.b_cut) - found.b_cut
        b_before = np.concatenate(([0], np.flatnonzero(found.b_cut) + 1))
        a_up_to = np.flatnonzero(found.a_cut) + 1
        order = np.empty(len(found.a) + len(found.b), dtype=np.int64)
        order[np.arange(len(found.a)) + b_before[a_group]] = 2 * found.a + found.a_cut
        order[np.arange(len(found.b)) + a_up_to[b_group]] = self.start + 2 * found.b + found.b_cut
        at = (found.a_first + found.b_first).tolist()
        return [b"".join(self.names[order[s:e]].tolist())[:-1] for s, e in zip(at[:-1], at[1:])]


def _lists(values: pa.Array, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), values)


def _files(first: str | None, second: str | None) -> Pair:
    return Pair.read(first or vocabulary_path(BYTE_BPE), second or vocabulary_path(PIECE_BPE))


GROUPS = "doc_id long, a array<int>, b array<int>, a_cuts array<int>, b_cuts array<int>"


def aligned(docs: DataFrame, first: str | None = None, second: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, both lists of ids, and per group how many ids of each list end with it."""
    shared = docs.sparkSession.sparkContext.broadcast(_files(first, second))

    def work(piece: pa.RecordBatch) -> dict:
        found = align(piece.column("text").to_pylist(), shared.value)
        out = {"doc_id": piece.column("doc_id")}
        for name, ids, cut, starts in (("a", found.a, found.a_cut, found.a_first), ("b", found.b, found.b_cut, found.b_first)):
            out[name] = _lists(pa.array(ids, pa.int32()), starts)
            at = np.flatnonzero(cut)
            text = np.searchsorted(starts, at, side="right") - 1
            out[f"{name}_cuts"] = _lists(pa.array(at + 1 - starts[text], pa.int32()), np.searchsorted(at, starts))
        return out

    return common.by_pieces(common.id_and_text(docs, id_col, text_col), work, GROUPS)


LINK = "struct<a:int,b:int,n:int>"
LINKED = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<{LINK}>"


def linked(docs: DataFrame, pair: Pair) -> DataFrame:
    """doc_id, numbers of ids, groups and links, the digest of the groups, and how often
    each distinct pair of ids is linked in the text."""
    shared = docs.sparkSession.sparkContext.broadcast(pair)
    fields = StructType.fromDDL(LINKED).fieldNames()

    def run(batches):
        both = shared.value.tokenizers()
        shown = Shown(*both)
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                found = align(piece.column("text").to_pylist(), shared.value)
                x, y = found.links()
                text = np.searchsorted(found.a_first, x, side="right") - 1
                size = both[1].size
                key, n = np.unique((text * both[0].size + found.a[x]) * size + found.b[y], return_counts=True)
                text, ids = np.divmod(key, both[0].size * size)
                parts = [pa.array(v.astype(np.int32)) for v in (*np.divmod(ids, size), n)]
                links = pa.StructArray.from_arrays(parts, names=["a", "b", "n"])
                groups = found.groups()
                n_a, n_b = np.diff(found.a_first), np.diff(found.b_first)
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in shown.texts(found)]
                columns = [
                    piece.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(groups), pa.array(n_a + n_b - groups),
                    pa.array(digests, pa.string()), _lists(links, np.searchsorted(text, np.arange(len(piece) + 1))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=fields)

    return docs.mapInArrow(run, LINKED)


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, n of all linked pairs, and whether n is the most that b has with any a."""
    counts = links.select(F.explode("links").alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.n").alias("n"))
    counts = common.checkpointed(counts, "pair-counts")
    most = counts.groupBy(F.col("b").alias("_b")).agg(F.max("n").alias("most"))
    named = counts.join(most, F.col("b") == F.col("_b")).select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    return common.checkpointed(named, "pairs")


def frequent(pairs: DataFrame, most: int = HEAD_PAIRS) -> DataFrame:
    """All pairs that occur at least so often that no more than ``most`` do."""
    level = F.floor(F.log2("n") * 4)
    steps = pairs.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least"))
    held, least = 0, None
    for row in sorted(steps.collect(), key=lambda r: -r["level"]):  # levels: a few hundred
        held += row["pairs"]
        if held > most:
            break
        least = row["least"]
    return pairs.where(F.lit(False) if least is None else F.col("n") >= least)


COUNTED = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest array<{LINK}>"


def with_counts(links: DataFrame, pairs: DataFrame, size: int, most: int = HEAD_PAIRS) -> DataFrame:
    """The texts with n_best, their links whose pair is the best of its second id, and
    count_sum, the counts of their links' pairs. ``size``: ids of the second tokenizer."""
    head = frequent(pairs, most).toArrow()
    key = head.column("a").to_numpy().astype(np.int64) * size + head.column("b").to_numpy()
    order = np.argsort(key)
    head = (key[order], head.column("n").to_numpy()[order], head.column("best").to_numpy(zero_copy_only=False)[order])
    shared = links.sparkSession.sparkContext.broadcast(head)
    fields = StructType.fromDDL(COUNTED).fieldNames()

    def run(batches):
        keys, counts, best = shared.value
        for batch in batches:
            lists = batch.column("links")
            flat = lists.flatten()
            first = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            a, b, n = (flat.field(i).to_numpy().astype(np.int64) for i in range(3))
            known = np.zeros(len(a), dtype=bool)
            at = np.zeros(len(a), dtype=np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, a * size + b), len(keys) - 1)
                known = keys[at] == a * size + b
            sums = []
            for values in (best, counts):
                each = np.where(known, n * values[at], 0) if len(keys) else np.zeros(len(n), dtype=np.int64)
                total = np.concatenate(([0], np.cumsum(each)))
                sums.append(pa.array((total[first[1:]] - total[first[:-1]]).astype(np.int64)))
            unknown = np.concatenate(([0], np.cumsum(~known)))[first]
            rest = _lists(flat.filter(pa.array(~known)), unknown)
            columns = [*(batch.column(c) for c in fields[:-3]), *sums, rest]
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    table = links.mapInArrow(run, COUNTED).withColumn("row", F.monotonically_increasing_id())
    table = common.checkpointed(table, "counted-texts")
    others = table.where(F.size("rest") > 0).select("row", F.explode("rest").alias("p")).select("row", "p.a", "p.b", F.col("p.n").alias("times"))
    added = others.join(pairs, ["a", "b"]).groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more")
    )
    out = table.join(added, F.col("row") == F.col("_row"), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        *fields[:5],
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", zero)).alias("count_sum"),
        "groups_sha256",
    )


def alignment_counts(docs: DataFrame, first: str | None = None, second: str | None = None, id_col: str = "doc_id", text_col: str = "text", head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """One row per text: how its tokens of both kinds align, and how usual its links are."""
    pair = _files(first, second)
    # The texts are encoded once; the second pass reads the links of the first.
    links = common.checkpointed(linked(common.id_and_text(docs, id_col, text_col), pair), "token-links")
    return with_counts(links, pair_counts(links), pair.tokenizers()[1].size, head_pairs)


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(common.table(spark, sf_dir, "documents"))
