"""Byte-pair encoding of whole texts by a depth-first walk over a trie of their words.

A prefix of a word ends, in its own encoding, with exactly one token, and the encoding of
the rest before that token is the encoding of a shorter prefix. So one (last token, start)
pair per trie node describes the encodings of all prefixes, and words that share a prefix
share the work on it. The distinct words of a piece, sorted, are the trie in depth-first
order: the walk keeps one stack of states and goes back to the common prefix of neighbours.
A step tries only the lengths of tokens that end in the prefix's last bytes.

A token may follow another if encoding the two together gives back the two; this is read
off the merges along their touching sides and remembered per pair.

Defined cases: NULL texts are empty; an empty text has no ids; the special tokens' strings
in a text become their ids, as in the library; NULL ids are returned as NULL; repeated rows
are encoded one by one; an empty table gives no rows. Extra columns are ignored.
"""

import hashlib
import json
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from . import common

WORD_END = "</w>"
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 150_000  # of a generation; a task remembers two, and what it meets again moves on
PIECE_BYTES = 4 << 20
NEVER = 1 << 60
ONE = (1,)

SCHEMA = "doc_id long, n_tokens long, ids array<int>"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def sizes_by_end(table: dict[bytes, int]) -> dict[bytes, tuple[int, ...]]:
    """Lengths, longest first, of the tokens that end in three bytes, or in two where no token
    of three bytes or more ends in the last three. Ends without a key only have a token of
    one byte."""
    sizes: dict[bytes, set[int]] = {}
    for body in table:
        if len(body) > 1:
            sizes.setdefault(body[-3:], {1}).add(len(body))
    for end, found in sizes.items():
        if len(end) == 3 and end[1:] in table:
            found.add(2)
    return {end: tuple(sorted(found, reverse=True)) for end, found in sizes.items()}


@dataclass
class Vocabulary:
    """A word-end BPE vocabulary; read on the driver, of a fixed size."""

    names: list[str]
    plain: dict[bytes, int]
    final: dict[bytes, int]
    parts: dict[int, tuple[int, int, int]]  # token: left part, right part, rank
    ranks: dict[tuple[int, int], int]
    special: dict[str, int]
    pattern: str
    plain_sizes: dict[bytes, tuple[int, ...]]  # of sizes_by_end
    final_sizes: dict[bytes, tuple[int, ...]]
    fits: dict[int, bool] = field(default_factory=dict)  # remembered by follows()

    @classmethod
    def read(cls, path: str) -> "Vocabulary":
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        if model["end_of_word_suffix"] != WORD_END or data["decoder"] is not None:
            raise ValueError("a word-end vocabulary without a decoder is expected")
        pattern = next(p["pattern"]["Regex"] for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        alphabet = _byte_alphabet()
        names = [""] * (max([*model["vocab"].values(), *(t["id"] for t in data["added_tokens"])]) + 1)
        plain, final, ids = {}, {}, model["vocab"]
        for name, token in ids.items():
            names[token] = name
            body, table = (name[: -len(WORD_END)], final) if name.endswith(WORD_END) and name != WORD_END else (name, plain)
            table[bytes(alphabet[c] for c in body)] = token
        parts, ranks = {}, {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = (ids[left], ids[right])
            ranks.setdefault(pair, rank)
            parts.setdefault(ids[left + right], (*pair, rank))
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        for content, token in special.items():
            names[token] = content
        return cls(names, plain, final, parts, ranks, special, pattern, sizes_by_end(plain), sizes_by_end(final))

    def follows(self, left: int, right: int) -> bool:
        """Does encoding the two tokens' bytes together give the two tokens back?

        The rightmost piece of ``left`` shrinks as its merges are undone, the leftmost of
        ``right`` likewise. The border falls if two pieces that exist at the same time merge
        before either is used up; of equal merges the left one comes first.
        """
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            known = True
            a, a_used = left, NEVER
            while known:
                b, b_used = right, NEVER
                while True:
                    rank = self.ranks.get((a, b))
                    if rank is not None and rank < a_used and rank <= b_used:
                        known = False
                        break
                    if b not in self.parts:
                        break
                    b, _, b_used = self.parts[b]
                if a not in self.parts:
                    break
                _, a, a_used = self.parts[a]
            if len(self.fits) > 300_000:
                self.fits.clear()
            self.fits[key] = known
        return known

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words, each prefix worked on once."""
        fits, follows = self.fits, self.follows
        inside, closing = (self.plain, self.plain_sizes), (self.final, self.final_sizes)
        out = {}
        coded = sorted((w.encode("utf-8"), w) for w in words)
        last, begin = [-1], [0]  # per depth: last token of the prefix and where it starts
        before = b""
        for code, word in coded:
            end = len(code) - 1
            depth, most = 0, min(end, len(before) - 1)
            if most > 0 and code[:most] == before[:most]:
                depth = most
            else:
                while depth < most and code[depth] == before[depth]:
                    depth += 1
            del last[depth + 1 :], begin[depth + 1 :]
            for at in range(depth + 1, end + 2):
                table, sizes = inside if at <= end else closing
                three, two = (at - 3, at - 2) if at > 2 else (0, 0)
                for size in sizes.get(code[three:at]) or sizes.get(code[two:at]) or ONE:
                    start = at - size
                    if start <= 0:
                        token = None if start else table.get(code[:at])
                        if token is not None:
                            break
                        continue
                    token = table.get(code[start:at])
                    if token is not None:
                        fit = fits.get(last[start] << 32 | token)
                        if follows(last[start], token) if fit is None else fit:
                            break
                else:
                    raise ValueError(f"no token ends {code[:at]!r}")
                if at <= end:
                    last.append(token)
                    begin.append(start)
            ids = [token]
            while start:
                ids.append(last[start])
                start = begin[start]
            out[word] = tuple(reversed(ids))
            before = code
        return out


class Encoder:
    """Encodes and decodes texts with one vocabulary, remembering words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.word = regex.compile(vocabulary.pattern)
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")
        self.known: dict[str, tuple[tuple[int, ...], str, str]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str, str]] = {}

    def split(self, text: str) -> list[str]:
        """Words of a text after the vocabulary's normalisation; special tokens as they are."""
        if "<|" not in text:
            return self.word.findall(normalised(text))
        out = []
        for part in self.special.split(text):
            out.extend([part] if part in self.vocabulary.special else self.word.findall(normalised(part)))
        return out

    def learn(self, texts: list[list[str]]) -> None:
        """Make every word known, the new ones by one walk over their trie."""
        distinct = set().union(*texts)
        new = [w for w in distinct if w not in self.known]
        again = {w: self.older[w] for w in new if w in self.older}
        if len(self.known) + len(new) > CACHED_WORDS:
            again |= {w: self.known[w] for w in distinct if w in self.known}
            self.older, self.known = self.known, {}
        self.known |= again
        names, special = self.vocabulary.names, self.vocabulary.special
        coded = self.vocabulary.encode_words([w for w in new if w not in again and w not in special])
        coded |= {w: (special[w],) for w in new if w in special}
        for word, ids in coded.items():
            self.known[word] = (ids, " ".join(map(str, ids)), " ".join([names[i] for i in ids]))


def normalised(text: str) -> str:
    """Composed form in lower case. Each code point is lowered by itself, so a final sigma
    is an ordinary one. White space separates words in the pattern as it is."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def _texts(piece: pa.RecordBatch) -> list[str]:
    return [t or "" for t in piece.column("text").to_pylist()]


def _run(docs: DataFrame, path: str, work, schema: str, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.read(path))

    def run(batches):
        # Of the task, not of the worker, which may go on to other work.
        encoder = Encoder(shared.value)
        for batch in batches:
            for piece in common.pieces(batch, "text", PIECE_BYTES):
                words = [encoder.split(t) for t in _texts(piece)]
                encoder.learn(words)
                yield work(encoder, piece, words)

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def _ids(encoder: Encoder, piece: pa.RecordBatch, words: list[list[str]]) -> pa.RecordBatch:
    known = encoder.known
    ids = [[i for w in text for i in known[w][0]] for text in words]
    counts = pa.array([len(x) for x in ids], pa.int64())
    return pa.RecordBatch.from_arrays(
        [piece.column("doc_id"), counts, pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "n_tokens", "ids"]
    )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def _digests(encoder: Encoder, piece: pa.RecordBatch, words: list[list[str]]) -> pa.RecordBatch:
    known = encoder.known
    counts, ids, decoded = [], [], []
    for text in words:
        entries = [known[w] for w in text]
        joined = " ".join([e[1] for e in entries])
        counts.append(joined.count(" ") + 1 if joined else 0)
        ids.append(_sha(joined))
        decoded.append(_sha(" ".join([e[2] for e in entries])))
    return pa.RecordBatch.from_arrays(
        [piece.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, number of ids and the ids of each whole text."""
    return _run(docs, path or vocabulary_path(), _ids, SCHEMA, id_col, text_col)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the decoded text of each row of ids: token strings joined by a space.

    Ids outside the vocabulary are left out, as in the library; NULL ids give an empty text.
    """
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.read(path or vocabulary_path()).names)

    def run(batches):
        for batch in batches:
            names = shared.value
            texts = [
                " ".join([names[i] for i in ids or () if i is not None and 0 <= i < len(names)])
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, number of ids, and SHA-256 of the ids and of their decoded text.

    Decoding goes word by word like encoding: a word's ids are decoded once and the pieces
    are joined, which is what ``decode`` gives for the whole list.
    """
    return _run(docs, path or vocabulary_path(), _digests, DIGESTS, id_col, text_col)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents"))
