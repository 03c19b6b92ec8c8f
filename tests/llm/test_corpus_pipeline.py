"""Each stage of the pipeline against a brute-force version, on what its predecessor kept."""

from __future__ import annotations

from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shelfline.llm import kneser_ney, rules
from shelfline.llm.common import stored
from tests.conftest import SF_DIR
from tests.llm import test_chunks, test_packing, test_rules, test_simhash


@pytest.fixture(scope="module")
def steps(spark):
    """The input of each stage and the result of the last."""
    out = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_DIR), "step"))
    return out


def test_stages_keep_columns_and_rows_of_documents(steps):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
    for before, after in zip(steps[:3], steps[1:4]):
        assert after.columns == before.columns == steps[0].columns
        assert not Counter(map(tuple, after.collect())) - Counter(map(tuple, before.collect()))
        assert after.count() < before.count()
    assert steps[4].columns == steps[0].columns


def test_quality_stages(spark, steps):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    seen = kneser_ney.perplexities(steps[0], labels).collect()
    assert {r.doc_id for r in seen if r.kept} == {r.doc_id for r in steps[1].collect()}
    judged = {r.doc_id: r for r in rules.judge(steps[1]).collect()}
    prior, rates = rules.fit(sorted(Counter(tuple(r[n] for n in rules.RULES) for r in judged.values()).items()))
    expected = set()
    for r in steps[1].collect():
        row = judged[r.doc_id]
        failed = test_rules.brute(r.text)[-1]
        if not failed and rules.posterior([row[n] for n in rules.RULES], prior, rates) >= rules.KEEP:
            expected.add(r.doc_id)
    assert {r.doc_id for r in steps[2].collect()} == expected


def test_near_duplicates_stage(steps):
    rows = [(r.doc_id, test_simhash.brute_fingerprint(r.text)) for r in steps[2].collect()]
    first = {d for (d, _), c in zip(rows, test_simhash.brute_components(rows)) if d == c}
    assert len(first) < len(rows)
    assert {r.doc_id for r in steps[3].collect()} == first


def test_substring_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[3].collect()]
    expected = {d: left for (d, _), (gone, left) in zip(rows, test_chunks.brute(rows)) if not gone or left.strip()}
    got = {r.doc_id: r for r in steps[4].collect()}
    assert {d: r.text for d, r in got.items()} == expected
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_packing_stage(steps):
    library = Tokenizer.from_file(test_packing.VOCABULARY)
    pieces = steps[5].collect()
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in steps[4].collect()}
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
        assert p.doc_tokens == want[p.doc_id]
    assert got == want


def test_rows_of_all_kinds(spark):
    text = "the quick brown fox jumps over the lazy dog and then it runs to the river and is not seen again for a while by the man "
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (None, text * 2, "xx", None, 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, fp int, row int"
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema)
    for given in (docs, docs.limit(0)):
        left = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stored(stage(spark, left, SF_DIR), "step")
            assert left.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, left, SF_DIR).count()
