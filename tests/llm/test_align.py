"""Alignment against the libraries and a plain version over sets of byte offsets."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from subscope.llm import align, common

from . import edge

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def library():
    first = Tokenizer.from_file(align.vocabulary_path(align.BYTE_BPE))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=align.vocabulary_path(align.PIECE_BPE))


def token_bytes(library, text):
    """Both tokenizers' (id, bytes) of a text, or nothing."""
    if not text:
        return [], []
    first, second = library
    alphabet = align._byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = b" " + text.encode()
    return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == whole else ([], [])


def spans(tokens):
    out, at = [], 0
    for i, body in tokens:
        out.append((i, at, at + len(body)))
        at += len(body)
    return out


def plain_result(library, rows):
    texts = []
    for doc_id, text in rows:
        a, b = map(spans, token_bytes(library, text))
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, at = [], [0, 0]
        for cut in cuts:
            sides = []
            for k, side in enumerate((a, b)):
                start = at[k]
                while at[k] < len(side) and side[at[k]][2] <= cut:
                    at[k] += 1
                sides.append(",".join(str(i) for i, *_ in side[start : at[k]]))
            groups.append("|".join(sides))
        links, j = [], 0
        for i, s, e in a:
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        texts.append((doc_id, len(a), len(b), groups, links))
    counts = Counter(p for t in texts for p in t[4])
    best = {}
    for (_, i), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for doc_id, n_a, n_b, groups, links in texts:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        good = sum(counts[p] == best[p[1]] for p in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), good, sum(counts[p] for p in links), digest))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_against_the_libraries(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in common.table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert result(align.op12_align(spark, sf)) == plain_result(library, rows)


ODD = [
    (30, "<|endoftext|> <s> </s> <unk> <0x0A> ▁ here"), (31, "▁"), (32, " lead and trail  "), (33, "tab\tand\r\n\n lines \n"),
    (34, "it's we'll I'D 'tis don't 12345 ３４"), (35, "שלום عالم ไทย 한국어 ﬁ ﷺ é ​ ﻿"), (36, "日本語" * 3000),
    (37, "😀" * 500), (38, "\x00\x01\x1c\x1d\x85\xa0x"), (39, "a" * 5000 + " " * 5000 + "b"), (40, "x y" * 5000), (None, "no id"),
]


@pytest.mark.parametrize("head", [0, 40, align.HEAD_PAIRS])
def test_odd_texts_and_heads_of_any_size(spark, library, head):
    rows = [*edge.texts(), *ODD]
    got = align.alignment_counts(edge.frame(spark, rows), head_pairs=head)
    assert result(got) == plain_result(library, rows)


def test_empty_table(spark):
    assert result(align.alignment_counts(edge.empty(spark))) == []


def test_lists_and_cuts(spark, library):
    rows = [(1, "The quick brown fox"), (2, ""), (3, None), (4, "ÀÉ ß 日本")]
    for r in align.aligned(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        a, b = token_bytes(library, dict(rows)[r["doc_id"]])
        assert r["a"] == [i for i, _ in a] and r["b"] == [i for i, _ in b]
        ends = [[sum(len(x) for _, x in side[:n]) for n in cuts] for side, cuts in ((a, r["a_cuts"]), (b, r["b_cuts"]))]
        assert ends[0] == ends[1] == sorted({e for *_, e in spans(a)} & {e for *_, e in spans(b)})


def test_fast_encoder_on_all_agreed_characters(library):
    """Every character that the fast encoder is trusted with, beside others."""
    made = align.ByteLevel(open(align.vocabulary_path(align.BYTE_BPE), "rb").read())
    agreed = [chr(c) for c in range(0x2100) if align.AGREED.fullmatch(chr(c))]
    assert len(agreed) > 600
    rng = random.Random(5)
    for c in agreed:
        text = f" a{c}b 1{c}{c} 2 {c} {c}'s\n{c}\n .{c}!" + "".join(rng.choices(agreed, k=20))
        assert made.encode(text).tolist() == library[0].encode(text, add_special_tokens=False).ids


@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=60)), min_size=1, max_size=5))
def test_common_ends(texts):
    """Random cuts of equal lengths; the texts' ends are common."""
    ends, others, first = [], [], [0]
    base = 0
    for x, y in texts:
        size = max(sum(x), sum(y))
        for out, cuts in ((ends, x), (others, y)):
            own = (base + np.cumsum(cuts)).tolist()
            out.extend(own if own[-1] == base + size else [*own, base + size])
        base += size
        first.append(len(ends))
    ends, others, first = (np.array(v, dtype=np.int64) for v in (ends, others, first))
    got = align.common_ends(ends, others, first[:-1], first[1:] - 1)
    assert np.array_equal(got, np.isin(ends, others))


@pytest.mark.parametrize("common_at", ["none", "first", "last", "both"])
def test_long_stretch_without_common_end(common_at):
    n = 400_000
    ends = np.arange(1, n + 1, dtype=np.int64) * 2
    inner = ends[:-1] - 1
    if common_at in ("first", "both"):
        inner = np.concatenate((ends[:1000], inner[1000:]))
    if common_at in ("last", "both"):
        inner = np.concatenate((inner[:-1000], ends[-1001:-1]))
    others = np.append(inner, ends[-1])
    started = time.perf_counter()
    got = align.common_ends(ends, others, np.array([0]), np.array([n - 1]))
    assert time.perf_counter() - started < 5
    assert np.array_equal(got, np.isin(ends, others))
