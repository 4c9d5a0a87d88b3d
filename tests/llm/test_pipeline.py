import re

import pytest

import corpus_pipeline
from subscope.llm import common, jaccard

from . import edge
from .test_bpe import expected, library  # noqa: F401
from .test_jaccard import brute
from .test_quality import brute_counts
from .test_secrets import brute as secrets_in

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = common.table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(common.checkpointed(stage(spark, out[-1], SF), "stage"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(tables):
    assert all(t.columns == tables[0].columns for t in tables[1:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "BPE encoding and decoding",
    ]


def test_rejected_documents_go(spark, tables):
    before, after = rows(tables[0]), rows(tables[1])
    for i, r in before.items():
        n, _, _, _, repeated = brute_counts(r.text)
        if n < 50 or 100 * repeated > 50 * n:
            assert i not in after
    assert all(after[i] == before[i] for i in after)
    good = {r.doc_id for r in common.table(spark, SF, "labels").collect() if r.quality == 1}
    passing = [i for i in good if i in before and brute_counts(before[i].text)[0] >= 50]
    assert sum(i in after for i in passing) >= 0.95 * len(passing)


def test_one_document_of_each_group_stays(tables):
    before = [(i, r.text) for i, r in rows(tables[1]).items()]
    assert sorted(rows(tables[2])) == sorted({c for _, _, c in brute(before, jaccard.Rule())})


def test_secrets_are_masked(tables):
    before, after = rows(tables[2]), rows(tables[3])
    assert set(before) == set(after)
    for i, r in after.items():
        if secrets_in(before[i].text):
            assert "[SECRET]" in r.text and not [x for x in secrets_in(r.text) if x[3] != "assign"]
            assert r.n_chars == len(r.text)
        elif "[SECRET]" not in r.text:
            assert r == before[i]


def test_mixing_keeps_whole_rows(tables):
    before = {tuple(r) for r in tables[3].collect()}
    assert all(tuple(r) in before for r in tables[4].collect())


def test_encoding(tables, library):  # noqa: F811
    texts = {i: r.text for i, r in rows(tables[4]).items()}
    out = tables[5].collect()
    assert len(out) == tables[4].count()
    for r in out:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, texts[r.doc_id])


def test_run_applies_all_stages(spark, tables):
    out = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, tables[-1].collect()))


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_and_empty_tables(spark, number):
    stage = corpus_pipeline.STAGES[number][1]
    assert stage(spark, edge.empty(spark), SF).collect() == []
    out = stage(spark, edge.frame(spark), SF)
    if number < 4:
        assert out.columns == edge.frame(spark).columns
        assert re.match(r"struct<", out.schema.simpleString())
    assert len(out.collect()) <= len(edge.texts())
