import hashlib
import itertools
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from subscope.llm import common, pii

from . import edge

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def brute(text):
    text = text or ""
    return [
        [m.span() for m in EMAIL.finditer(text)],
        [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))],
        [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15],
    ]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.-_ +(é", max_size=40))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text)[0] == brute(text)


def test_base_spans_of_chosen_texts():
    for text in (
        "mail a.b@c.d_e@f.g and x@y", "1.2.3.4.5 256.1.1.1 001.002.003.004 1.2.3", "4111 1111 1111 1111 and 4111111111111112",
        "+1 (706) 555-3138 4644348398010899", "call +49 30 901820 now", "@@a@b.c", "9" * 5000, "." * 100, "+" * 50,
        "1." * 3000, "a" * 20000, "٣٣٣.1.1.1.1",
    ):
        assert pii.base_spans(text)[0] == brute(text), text


def trained(spark):
    return pii.fit(common.table(spark, "/root/testdata/sf0.01", "documents"))


def test_field_separates_runs_that_the_patterns_drop(spark):
    field = trained(spark)
    text = "so +1 (706) 555-3138 4644348398010899 end"
    base, _ = pii.base_spans(text)
    assert base == [[], [], [], []]
    card, phone = pii.added_spans(text, base, field)[2:]
    assert [text[s:e] for s, e in card] == ["4644348398010899"]
    assert [text[s:e] for s, e in phone] == ["+1 (706) 555-3138"]
    assert pii.added_spans("In 2024 about 1500 people, 3.5 percent, bought 12 units at 9:30.", base, field) == base


def test_field_finds_what_it_learned_from(spark):
    field = trained(spark)
    hit = total = extra = 0
    for row in common.table(spark, "/root/testdata/sf0.1", "documents").limit(3000).collect():
        base = {(s, e, k) for k, own in enumerate(pii.base_spans(row.text)[0]) for s, e in own}
        found = {(s, e, k) for k, own in enumerate(pii.added_spans(row.text, [[]] * 4, field)) for s, e in own}
        hit, total, extra = hit + len(base & found), total + len(base), extra + len(found - base)
    assert total > 50 and hit >= 0.98 * total and extra <= 0.05 * total


def segmentations(n):
    """All ways to cut n pieces into single outside pieces and entities."""
    if n == 0:
        yield []
        return
    for length in range(1, min(n, pii.LONGEST) + 1):
        for rest in segmentations(n - length):
            shifted = [(a + length, b + length, k) for a, b, k in rest]
            for kind in range(pii.OUTSIDE):
                yield [(0, length, kind), *shifted]
            if length == 1:
                yield [(0, 1, pii.OUTSIDE), *shifted]


def total_of(field, phi, segments):
    total, before = 0.0, pii.OUTSIDE
    for a, b, k in segments:
        total += field.pairs[before, k]
        if k != pii.OUTSIDE:
            total += float(phi[b - 1, b - a - 1] @ field.weights[k])
        before = k
    return total


def some_field(seed):
    rng = np.random.default_rng(seed)
    field = pii.SpanField.empty()
    field.weights += rng.normal(size=field.weights.shape) * 0.3
    field.pairs += rng.normal(size=field.pairs.shape) * 0.3
    return field


def test_decoding_is_the_best_of_all_segmentations():
    for seed, text in itertools.product(range(4), ("+1(2", "a@b.", "1.2.", "12-")):
        field, island = some_field(seed), pii.Island(text, 0, len(text))
        phi = island.features(0, len(island))
        best = max(segmentations(len(island)), key=lambda s: total_of(field, phi, s))
        found = field.spans(island)
        assert found == [s for s in best if s[2] != pii.OUTSIDE]


def test_gradient_is_the_slope_of_the_likelihood():
    field, text = some_field(1), "1.2 a"
    island, truth = pii.Island(text, 0, len(text)), [(0, 3, 1)]
    phi, ways = island.features(0, len(island)), list(segmentations(len(island)))

    def likelihood():
        scores = [total_of(field, phi, s) for s in ways]
        full = [(0, 3, 1), *((i, i + 1, pii.OUTSIDE) for i in range(3, len(island)))]
        return total_of(field, phi, full) - np.log(np.sum(np.exp(scores)))

    weights, pairs = field.gradient(island, truth)
    for table, slope, place in ((field.weights, weights, (1, 2)), (field.weights, weights, (0, 0)), (field.pairs, pairs, (4, 1)), (field.pairs, pairs, (4, 4))):
        old = table[place]
        table[place] = old + 1e-5
        high = likelihood()
        table[place] = old - 1e-5
        low = likelihood()
        table[place] = old
        assert abs((high - low) / 2e-5 - slope[place]) < 1e-4


def test_blocks_do_not_change_the_decoding(monkeypatch):
    field, text = some_field(2), "+1 (22) 333-4444 a.b@c.de 1.2.3.4 " * 4
    whole = field.spans(pii.Island(text, 0, len(text)))
    monkeypatch.setattr(pii, "BLOCK", 5)
    assert field.spans(pii.Island(text, 0, len(text))) == whole


def test_edge_cases(spark):
    rows = [*edge.texts(), (20, "mail me: a@b.co"), (20, "mail me: a@b.co"), (21, "1" * 50_000 + " 1.1.1.1")]
    out = pii.personal_data(edge.frame(spark, rows), some_field(0)).collect()
    assert len(out) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    for r in out:
        if r.doc_id in (1, 2, 3, 4):
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) == (0, 0, 0, 0, empty, "")
        if r.doc_id == 20:
            assert r.n_email == 1 and r.base_sha256 == hashlib.sha256(b"email:9:15").hexdigest()
    assert pii.personal_data(edge.empty(spark), None).collect() == []
    assert pii.fit(edge.empty(spark)) is None
    assert pii.fit(edge.frame(spark)) is None
