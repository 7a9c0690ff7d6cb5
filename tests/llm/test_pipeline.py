"""The pipeline over a whole small table: each stage against a plain version of it, on the stage's own input."""

from collections import defaultdict

import corpus_pipeline
import pytest
from lectern.llm import common, pii

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def passed(spark):
    """What goes into each stage, and what comes out of the last, as run() chains them."""
    docs, out = common.table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = common.written(stage(spark, docs, SF), "test-stage")
    return [*out, docs]


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_stages(spark, passed):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "decontamination", "personal data", "mixing"]
    assert all(df.columns == passed[0].columns for df in passed[:-1])
    # Nothing but masking changes a row.
    before = {r.doc_id: r for r in passed[0].collect()}
    assert all(r == before[r.doc_id] for df in passed[1:4] for r in df.collect())


def test_quality(passed):
    # 200 documents have too few labels for a certificate, so the base rule decides; test_edges has certified levels.
    assert ids(passed[1]) == sorted(r.doc_id for r in passed[0].collect() if not brute.quality(r.text)[-1])
    assert 0 < passed[1].count() < passed[0].count()


def test_near_duplicates(passed):
    rows = [(r.doc_id, brute.fingerprint(r.text)) for r in passed[1].collect()]
    assert ids(passed[2]) == sorted(set(brute.components(rows))) and len(ids(passed[2])) < len(rows)


def test_decontamination(spark, passed):
    items = [(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()]
    assert ids(passed[3]) == sorted(r.doc_id for r in passed[2].collect() if not brute.contamination(r.text, items)[-1])
    assert len(ids(passed[3])) < len(ids(passed[2]))


def test_masking(passed):
    before, after = ({r.doc_id: r for r in df.collect()} for df in passed[3:5])
    assert before.keys() == after.keys()
    changed = 0
    for d, r in before.items():
        base = brute.pii(r.text)
        assert base == [x[:3] for x in pii.spans_of(r.text) if x[3]]
        text = r.text
        if len(base) == len(pii.spans_of(r.text)):
            spans = sorted((a, b, k) for k, a, b in base)
            assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
            for a, b, k in reversed(spans):
                text = text[:a] + f"[{k.upper()}]" + text[b:]
            assert after[d].text == text and after[d].n_chars == len(text)
        changed += after[d].text != r.text
        assert not brute.pii(after[d].text)
    assert changed


def test_mixing(spark, passed):
    docs = {r.doc_id: r for r in passed[4].collect()}
    by = defaultdict(int)
    for r in docs.values():
        by[r.source] += len(brute.WORD.findall(r.text))
    order = sorted(by)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, level = set(), 0.0
    while len(capped) < len(order):
        level = (sum(by.values()) - sum(3 * by[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and weight[s] * level > 3 * by[s]}
        if not more:
            break
        capped |= more
    taken, largest = defaultdict(int), defaultdict(int)
    for r in docs.values():
        largest[r.source] = max(largest[r.source], len(brute.WORD.findall(r.text)))
    for r in passed[5].collect():
        assert r[: len(docs[r.doc_id])] == tuple(docs[r.doc_id]) and 1 <= r.copies <= 3 and r.taken == r.copies * r.size == r.copies * len(brute.WORD.findall(r.text))
        taken[r.source] += r.taken
    assert all(abs(taken[s] - (3 * by[s] if s in capped else weight[s] * level)) <= largest[s] for s in order)
    assert sorted(map(tuple, passed[5].collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
