"""Merkle trees and proofs against a plain version that builds one tree after the other."""

import hashlib
import random
import zlib

import pytest

from subscope.llm import merkle

from . import edge


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shown(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grown(leaves):
    """All levels of a tree, from the leaves to one node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + 2])) for i in range(0, len(low), 2)])
    return levels


def way(levels, pos):
    """Per level: the sibling of the node above ``pos``, or none, and the node's place."""
    return [(level[p ^ 1] if (p := pos >> k) ^ 1 < len(level) else None, p) for k, level in enumerate(levels[:-1])]


def plain_result(rows):
    """Rows of doc_id, source, lang, n_chars, text, to what the query returns for them."""
    groups = {}
    for r in rows:
        leaf = sha("".join(map(shown, r)))
        changed = leaf
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
            changed = sha("".join(map(shown, (*r[:3], r[3] + 1, r[4]))))
        groups.setdefault(r[2], []).append((r[0], leaf, changed))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, bytes.fromhex(x[1])))
        trees[g] = grown([leaf for _, leaf, _ in groups[g]])
    top = grown([trees[g][-1][0] for g in order])
    root, out = top[-1][0], []
    for rank, g in enumerate(order):
        for pos, (doc_id, leaf, changed) in enumerate(groups[g]):
            node, seen = changed, ""
            for sibling, p in [*way(trees[g], pos), *way(top, rank)]:
                pair = [node] if sibling is None else [sibling, node] if p & 1 else [node, sibling]
                node, seen = sha("".join(pair)), seen + (sibling or "")
            out.append((doc_id, leaf, trees[g][-1][0], root, sha(seen), node, node == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def result(spark, rows, monkeypatch, run_levels=merkle.RUN_LEVELS, frame=None):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3) if frame is None else frame
    monkeypatch.setattr(merkle.common, "table", lambda *_: frame)
    real = merkle.proofs
    monkeypatch.setattr(merkle, "proofs", lambda docs, **more: real(docs, run_levels=run_levels, **more))
    found = merkle.op11_merkle(spark, "").select(*COLUMNS).collect()
    monkeypatch.undo()
    return sorted(map(tuple, found), key=repr)


@pytest.mark.parametrize("run_levels", [1, 2, 12])
def test_trees_of_many_widths(spark, monkeypatch, run_levels):
    rng, rows = random.Random(run_levels), []
    for lang, n in {None: 1, "": 2, "de": 3, "en": 150, "fr": 33, "ß": 16, "\uffff": 7, "😀": 1}.items():
        for i in rng.sample(range(10_000), n):
            rows.append((i, rng.choice(["s", None, "ä"]), lang, rng.choice([None, 5, 10**12]), rng.choice(["", "x ß", None, "long " * 99])))
    assert result(spark, rows, monkeypatch, run_levels) == plain_result(rows)


def test_one_group_and_one_row(spark, monkeypatch):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(9)]
    assert result(spark, rows, monkeypatch) == plain_result(rows)
    (only,) = result(spark, rows[:1], monkeypatch)
    assert only[1] == only[2] == only[3] and only[4] == sha("")


def test_edge_cases(spark, monkeypatch):
    """Missing ids, repeated ids and rows, empty and very long texts, other columns."""
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in edge.frame(spark).collect()]
    assert result(spark, rows, monkeypatch, frame=edge.frame(spark)) == plain_result(rows)
    assert result(spark, [], monkeypatch, frame=edge.empty(spark)) == []


def test_greatest_number_and_hidden_change(spark, monkeypatch):
    """A raised greatest number is hashed as it is; only changed rows fail to verify."""
    hit = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 0)
    rows = [(hit, "s", "en", 2**63 - 1, "a"), (hit + 1000, "s", "en", None, "b")]
    found = result(spark, rows, monkeypatch)
    assert found == plain_result(rows)
    assert {r[0]: r[6] for r in found}[hit] is False


def test_many_equal_rows_are_spread(spark):
    """Rows that are equal in all take places next to each other, in several partitions."""
    frame = spark.range(0, 4000, 1, 8).selectExpr("1L as doc_id", "'en' as grp", "cast('x' as binary) as leaf")
    rows, places = merkle.in_order(frame, "grp", ["doc_id", "leaf"])
    out = merkle.placed(rows, places, "grp")
    assert sorted(r["pos"] for r in out.collect()) == list(range(4000))
    assert {r["width"] for r in places.collect()} == {4000}


def test_query_against_itself_at_two_layouts(spark):
    docs = merkle.common.table(spark, "/root/testdata/sf0.001", "documents")
    first = merkle.verified(merkle.proofs(docs)).collect()
    second = merkle.verified(merkle.proofs(docs.repartition(7, "text"))).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, second)) and all(r["verified"] for r in first)
