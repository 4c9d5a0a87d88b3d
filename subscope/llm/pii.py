"""Personal data in whole texts: fixed patterns, and a semi-Markov random field.

The patterns give the base spans of four kinds. The method looks at islands, runs of words
with a digit or an at sign, and cuts each into segments: single pieces outside, or spans of
a bounded number of pieces of one kind. Whole-span features (shape, digit counts, check sum,
neighbours) score a segment, pair weights its neighbours, and dynamic programming picks
the best boundaries and kinds together. All other words are outside by definition, so
islands are independent and decoding is linear in the text. The weights maximise the
conditional likelihood of islands that the patterns labelled, in a bounded sample.

What the method finds and no base span overlaps is added: a phone number and a card number
that stand side by side, for example, which the patterns run together and drop.

Defined cases: a NULL text is empty; NULL ids are returned as NULL; repeated rows are
searched one by one; an empty table gives no rows; without labelled islands nothing is
added. Extra columns are ignored.
"""

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EMAIL_SHAPE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PIECE = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
HOT = re.compile(r"[0-9@]\S*")

LONGEST = 14  # pieces of an entity
SAMPLE_ROWS = 3000  # documents with islands that the weights are learned from
SAMPLE_PIECES = 200  # pieces of an island learned from, at most
SAMPLE_ALIKE = 60  # islands learned from that are equal but for letters and digits
SAMPLE_ISLANDS = 8  # islands learned from per document, those with the smallest hashes
EPOCHS, RATE, DECAY = 4, 0.3, 1e-4
BLOCK = 512  # pieces whose spans are scored at a time


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def emails(text: str) -> list[tuple[int, int]]:
    """An address ends its local part at an at sign, so those are looked at in order; a
    match starts as far left as the local part's characters go after the last match."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        else:
            # What stands before this sign cannot be part of a later local part.
            end = at + 1
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> tuple[list[list[tuple[int, int]]], list[tuple[int, int]]]:
    """Base spans by kind, and the matches that failed their digit count by being too long."""
    mails = emails(text)
    ips, cards, phones, long = [], [], [], []
    if _HAS_DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-20:]) <= 255 for p in m.group().split(".")):
                ips.append(m.span())
        for m in CARD.finditer(text):
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
            elif len(digits) > 19:
                long.append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                count = len(_digits(m.group()))
                if 9 <= count <= 15:
                    phones.append(m.span())
                elif count > 15:
                    long.append(m.span())
    return [mails, ips, cards, phones], long


_HAS_DIGIT = re.compile(r"[0-9]")


def islands(text: str) -> list[tuple[int, int]]:
    """Runs of words with a digit or an at sign, one space apart."""
    out = []
    end = 0
    for m in HOT.finditer(text):
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        if out and start == end + 1 and text[end] == " ":
            out[-1] = (out[-1][0], m.end())
        else:
            out.append((start, m.end()))
        end = m.end()
    return out


class Island:
    """The pieces of an island and counts that span features are read from."""

    CLASSES = ("digit", "letter", ".", "@", " ", "-", "(", ")", "+", "other")

    def __init__(self, text: str, start: int, end: int):
        self.text = text
        found = list(PIECE.finditer(text, start, end))
        self.begin = np.array([m.start() for m in found])
        self.end = np.array([m.end() for m in found])
        n = len(found)
        self.kind = np.empty(n, dtype=np.int8)
        digits, over = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i, m in enumerate(found):
            s = m.group()
            if "0" <= s[0] <= "9":
                self.kind[i], digits[i] = 0, len(s)
                over[i] = len(s) > 3 or int(s) > 255
            elif s[0].isascii() and s[0].isalpha():
                self.kind[i] = 1
            else:
                self.kind[i] = self.CLASSES.index(s) if s in self.CLASSES[2:9] else 9
        one = np.zeros((n, len(self.CLASSES)), np.int64)
        one[np.arange(n), self.kind] = 1
        self.counts = np.concatenate((np.zeros((1, one.shape[1]), np.int64), np.cumsum(one, axis=0)))
        self.digits = np.concatenate(([0], np.cumsum(digits)))
        self.over = np.concatenate(([0], np.cumsum(over)))
        edge = text[start - 1 : start] if start else ""
        joined = np.isin(self.kind, (0, 1)) | np.isin(self.kind, (2, 5, 8))
        self.left_joined = np.concatenate(([bool(edge) and not edge.isspace()], joined[:-1]))[:n]
        self.right_joined = np.concatenate((np.isin(self.kind[1:], (0, 1)), [False]))[:n]

    def __len__(self) -> int:
        return len(self.kind)

    def features(self, low: int, high: int) -> np.ndarray:
        """Features of all spans that end with piece ``low`` to ``high - 1``, by length.

        Row ``e - low``, column ``l - 1`` is the span of ``l`` pieces that ends with ``e``.
        """
        last = np.arange(low, high)[:, None]
        first = last - np.arange(LONGEST)[None, :]
        real = first >= 0
        first = np.maximum(first, 0)
        c = self.counts[last + 1] - self.counts[first]
        digits = self.digits[last + 1] - self.digits[first]
        over = self.over[last + 1] - self.over[first]
        numbers, letters, dots, ats, spaces, dashes, opens, closes, plus, other = np.moveaxis(c, -1, 0)
        length = last - first + 1
        head, tail = self.kind[first], np.broadcast_to(self.kind[last], first.shape)
        only_card = (letters + dots + ats + opens + closes + plus + other == 0) & (numbers > 0)
        only_phone = (letters + ats + other == 0) & (plus == 1) & (head == 8) & (tail == 0)
        ip = (numbers == 4) & (dots == 3) & (length == 7) & (head == 0) & (tail == 0)
        fits_ip = ip & (over == 0)
        card_count, phone_count = (digits >= 13) & (digits <= 19), (digits >= 9) & (digits <= 15)
        edged = ~self.left_joined[first] & ~self.right_joined[last]
        checked = np.zeros(first.shape, dtype=bool)
        for e, l in np.argwhere(only_card & card_count & (head == 0) & (tail == 0) & real):
            checked[e, l] = luhn(_digits(self.text[self.begin[first[e, l]] : self.end[low + e]]))
        mail = np.zeros(first.shape, dtype=bool)
        for e, l in np.argwhere((ats == 1) & (spaces + opens + closes == 0) & real):
            shown = self.text[self.begin[first[e, l]] : self.end[low + e]]
            mail[e, l] = EMAIL_SHAPE.fullmatch(shown) is not None
        listed = [
            np.ones(first.shape, dtype=bool),
            head == 0, head == 1, head == 8, head >= 2, tail == 0, tail == 1, tail >= 2,
            ats == 0, ats == 1, ats > 1, letters == 0, other > 0, spaces == 0, opens == closes,
            ip, fits_ip, over > 0, only_card, only_phone, card_count, phone_count,
            digits == 16, digits > 19, digits < 9, digits == 0, checked, mail, edged,
            checked & edged, mail & edged, fits_ip & edged, only_phone & phone_count,
            only_phone & phone_count & edged, only_card & card_count & ~checked,
            length == 1, length <= 4, length >= 10, self.left_joined[first],
            np.broadcast_to(self.right_joined[last], first.shape),
        ]
        out = np.stack(listed, axis=-1).astype(np.float32)
        out[~real] = 0
        return out


N_FEATURES = Island("1", 0, 1).features(0, 1).shape[-1]


@dataclass
class SpanField:
    """Weights of span features by kind, and of neighbouring segments' kinds."""

    weights: np.ndarray
    pairs: np.ndarray

    @classmethod
    def empty(cls) -> "SpanField":
        return cls(np.zeros((len(KINDS), N_FEATURES)), np.zeros((OUTSIDE + 1, OUTSIDE + 1)))

    def spans(self, island: Island) -> list[tuple[int, int, int]]:
        """The best segmentation's entities: first piece, piece after the last, kind."""
        n = len(island)
        kinds = OUTSIDE + 1
        best = np.full((n + 1, kinds), -np.inf)
        best[0, OUTSIDE] = 0.0
        came = np.zeros((n + 1, kinds, 2), dtype=np.int32)
        enter = best.copy()  # best score up to a border, given the kind that starts there
        choice = np.zeros((n + 1, kinds), dtype=np.int32)
        enter[0], choice[0] = self.pairs[OUTSIDE], OUTSIDE
        for low in range(0, n, BLOCK):
            high = min(n, low + BLOCK)
            scores = island.features(low, high) @ self.weights.T
            for e in range(low, high):
                reach = min(LONGEST, e + 1)
                starts = e - np.arange(reach)
                total = scores[e - low, :reach] + enter[starts, :OUTSIDE]
                pick = total.argmax(axis=0)
                best[e + 1, :OUTSIDE] = total[pick, np.arange(OUTSIDE)]
                came[e + 1, :OUTSIDE, 0] = starts[pick]
                best[e + 1, OUTSIDE] = enter[e, OUTSIDE]
                came[e + 1, OUTSIDE, 0] = e
                step = best[e + 1][:, None] + self.pairs
                choice[e + 1] = step.argmax(axis=0)
                enter[e + 1] = step.max(axis=0)
        out, at, kind = [], n, int(best[n].argmax()) if n else OUTSIDE
        while at:
            start = int(came[at, kind, 0])
            if kind != OUTSIDE:
                out.append((start, at, kind))
            kind, at = int(choice[start, kind]), start
        return out[::-1]

    def gradient(self, island: Island, truth: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Observed minus expected counts of one island: the likelihood's slope."""
        n = len(island)
        phi = island.features(0, n).astype(np.float64)
        scores = phi @ self.weights.T
        kinds = OUTSIDE + 1
        forward = np.full((n + 1, kinds), -np.inf)
        enter = np.full((n + 1, kinds), -np.inf)
        enter[0] = self.pairs[OUTSIDE]
        for e in range(n):
            reach = min(LONGEST, e + 1)
            starts = e - np.arange(reach)
            forward[e + 1, :OUTSIDE] = _log_sum(scores[e, :reach] + enter[starts, :OUTSIDE], 0)
            forward[e + 1, OUTSIDE] = enter[e, OUTSIDE]
            enter[e + 1] = _log_sum(forward[e + 1][:, None] + self.pairs, 0)
        total = _log_sum(forward[n], 0)
        backward = np.full((n + 1, kinds), -np.inf)  # after a segment of a kind ends here
        backward[n] = 0.0
        start_at = np.full((n + 1, kinds), -np.inf)  # a segment of a kind starts here
        for s in range(n - 1, -1, -1):
            reach = min(LONGEST, n - s)
            ends = s + np.arange(reach)
            start_at[s, :OUTSIDE] = _log_sum(scores[ends, np.arange(reach)] + backward[ends + 1, :OUTSIDE], 0)
            start_at[s, OUTSIDE] = backward[s + 1, OUTSIDE]
            backward[s] = _log_sum(self.pairs + start_at[s][None, :], 1)
        weights, pairs = np.zeros_like(self.weights), np.zeros_like(self.pairs)
        for e in range(n):
            reach = min(LONGEST, e + 1)
            starts = e - np.arange(reach)
            share = np.exp(scores[e, :reach] + enter[starts, :OUTSIDE] + backward[e + 1, :OUTSIDE] - total)
            weights -= share.T @ phi[e, :reach]
        for s in range(n):
            before = forward[s] if s else np.where(np.arange(kinds) == OUTSIDE, 0.0, -np.inf)
            pairs -= np.exp(before[:, None] + self.pairs + start_at[s][None, :] - total)
        at, kind = 0, OUTSIDE
        for first, end, own in [*truth, (n, n, -1)]:
            while at < first:
                pairs[kind, OUTSIDE] += 1
                kind, at = OUTSIDE, at + 1
            if own >= 0:
                weights[own] += phi[end - 1, end - first - 1]
                pairs[kind, own] += 1
                kind, at = own, end
        return weights, pairs


def _log_sum(x: np.ndarray, axis: int):
    top = np.max(x, axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def labelled_islands(text: str) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """Islands whose labels are certain: start, end and the entities as pieces.

    Left out are islands with overlapping base spans, with one that pieces cannot express,
    or with a match that was dropped for being too long, which may hold entities.
    """
    out = []
    by_kind, long = base_spans(text)
    spans = sorted((s, e, k) for k, own in enumerate(by_kind) for s, e in own)
    some = sorted(islands(text), key=lambda x: (zlib.crc32(text[x[0] : x[1]].encode()), x))[:SAMPLE_ISLANDS]
    for start, end in sorted(some):
        own = [x for x in spans if x[0] < end and start < x[1]]
        if any(a[1] > b[0] for a, b in zip(own, own[1:])) or any(s < end and start < e for s, e in long):
            continue
        found = list(PIECE.finditer(text, start, end))
        heads, tails = {m.start(): i for i, m in enumerate(found)}, {m.end(): i + 1 for i, m in enumerate(found)}
        if len(found) > SAMPLE_PIECES or any(s not in heads or e not in tails or tails[e] - heads[s] > LONGEST for s, e, _ in own):
            continue
        out.append((start, end, [(heads[s], tails[e], k) for s, e, k in own]))
    return out


def train(rows: list[tuple[str, list[tuple[int, int, int]]]]) -> SpanField | None:
    """Stochastic gradient ascent over islands, each given with its neighbours and labels."""
    if not any(truth for _, truth in rows):
        return None
    field = SpanField.empty()
    random = np.random.default_rng(5)
    ready = [(Island(text, 1, len(text) - 1), truth) for text, truth in rows]
    step = 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(ready)):
            step += 1
            rate = RATE / (1 + step / (2 * len(ready)))
            weights, pairs = field.gradient(*ready[i])
            field.weights += rate * (weights - DECAY * field.weights)
            field.pairs += rate * (pairs - DECAY * field.pairs)
    return field


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> SpanField | None:
    """Weights from islands of at most ``rows`` documents, the smallest by a hash of the id,
    one row of each; and of these the bounded numbers of islands named above."""
    texts = common.id_and_text(docs)
    ids = texts.where(F.col("text").rlike("[0-9@]") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches):
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                for start, end, truth in labelled_islands(text):
                    # One character on both sides, as the features look at neighbours.
                    left, right = text[start - 1 : start] or " ", text[end : end + 1] or " "
                    out.append((doc, start, left + text[start:end] + right, [x for t in truth for x in t]))
            columns = zip(*out) if out else ([], [], [], [])
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["doc_id", "start", "island", "truth"]
            )

    sample = common.one_per_id(texts.join(F.broadcast(chosen), "doc_id"), "doc_id").mapInArrow(run, "doc_id long, start long, island string, truth array<int>")
    found = sorted((r.doc_id, r.start, r.island, r.truth) for r in sample.collect())
    # Islands of a shape that many share teach little; a few of each are enough.
    kept, seen = [], {}
    for _, _, island, truth in found:
        shape = re.sub("[a-z]+", "a", re.sub("[0-9]", "9", island))
        seen[shape] = seen.get(shape, 0) + 1
        if seen[shape] <= SAMPLE_ALIKE:
            kept.append((island, [tuple(truth[i : i + 3]) for i in range(0, len(truth), 3)]))
    return train(kept)


def added_spans(text: str, by_kind: list[list[tuple[int, int]]], field: SpanField | None) -> list[list[tuple[int, int]]]:
    """Entities of the field that no base span overlaps, by kind."""
    out = [[] for _ in KINDS]
    if field is None:
        return out
    base = sorted(x for own in by_kind for x in own)
    starts = np.array([s for s, _ in base], dtype=np.int64)
    ends = np.maximum.accumulate(np.array([e for _, e in base], dtype=np.int64)) if base else starts
    for start, end in islands(text):
        island = Island(text, start, end)
        for first, after, kind in field.spans(island):
            s, e = int(island.begin[first]), int(island.end[after - 1])
            before = int(np.searchsorted(starts, e))
            if not before or ends[before - 1] <= s:
                out[kind].append((s, e))
    return out


def _shown(by_kind) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, own in enumerate(by_kind) for s, e in sorted(own))


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string, n_added long"
)


def personal_data(docs: DataFrame, field: SpanField | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans of each whole text. The field is sent to the tasks: a fixed size."""

    def work(piece: pa.RecordBatch) -> dict:
        counts, base, spans, added = [], [], [], []
        for text in piece.column("text").to_pylist():
            if not text or not HOT.search(text):
                by_kind = more = [[], [], [], []]
            else:
                by_kind, _ = base_spans(text)
                more = added_spans(text, by_kind, field)
            counts.append([len(x) for x in by_kind])
            base.append(hashlib.sha256(_shown(by_kind).encode()).hexdigest())
            spans.append(_shown([a + b for a, b in zip(by_kind, more)]))
            added.append(sum(map(len, more)))
        counts = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS))
        return {
            "doc_id": piece.column("doc_id"),
            **{f"n_{k}": counts[:, i] for i, k in enumerate(KINDS)},
            "base_sha256": pa.array(base, pa.string()),
            "spans": pa.array(spans, pa.string()),
            "n_added": np.array(added, dtype=np.int64),
        }

    return common.by_pieces(common.id_and_text(docs, id_col, text_col), work, SCHEMA)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return personal_data(docs, fit(docs))
