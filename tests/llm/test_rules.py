"""Operator 5: counts against a brute-force version, EM against planted accuracies, verdicts against labels."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from shelfline.llm import rules
from tests.conftest import SF_DIR

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


ODD = [
    None, "", " \t\n", "one", "é ß \x1c x\x0by", "#*$%&|<>" * 3, "a b c d e f g h " * 40, "x\nx\n\n x\nx\r\nx\r",
    "w " * 30_000, "a" * 100_000, " ".join(map(str, range(50))) + " " + " ".join(map(str, range(20, 45))),
]


def test_counts_of_odd_texts(spark):
    rng = random.Random(5)
    made = [" ".join(rng.choice("ab") for _ in range(rng.randrange(40))) + rng.choice(["", "\n", " "]) for _ in range(200)]
    rows = [(i, t, 7, "clash") for i, t in enumerate(ODD + made)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, kept string")
    got = {r.doc_id: r for r in rules.judge(docs).collect()}
    for i, text, *_ in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text), text
        assert not (r.base_failed and r.kept)


def test_keep_good_agrees_with_judge_and_passes_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(300)
    docs = docs.unionByName(docs.limit(5)).selectExpr("*", "1 AS n_words", "'x' AS _m", "2 AS length")
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns
    expected = Counter(r.doc_id for r in rules.judge(docs).filter("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == expected
    assert rules.keep_good(docs.limit(0)).count() == 0 and rules.judge(docs.limit(0)).count() == 0


def test_em_finds_planted_accuracies():
    rng = random.Random(1)
    planted = [(0.97, 0.8), (0.95, 0.7), (0.9, 0.6), (0.8, 0.9), (0.98, 0.75), (0.9, 0.7), (0.85, 0.85), (0.7, 0.6)]
    patterns = Counter()
    for _ in range(40_000):
        good = rng.random() < 0.85
        vote = lambda a: rng.random() < (a[0] if good else 1 - a[1])
        patterns[tuple(0 if rng.random() < 0.2 else 1 if vote(a) else -1 for a in planted)] += 1
    prior, rates = rules.fit(sorted(patterns.items()))
    assert prior == pytest.approx(0.85, abs=0.02)
    for (good, bad), (a, b) in zip(rates, planted):
        assert good == pytest.approx([0.2, 0.8 * a, 0.8 * (1 - a)], abs=0.03)
        assert bad == pytest.approx([0.2, 0.8 * (1 - b), 0.8 * b], abs=0.03)


def test_verdicts_follow_the_labels(spark):
    judged = rules.query(spark, SF_DIR).filter("not base_failed").join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id")
    found = {(r.quality, r.kept): r.n for r in judged.groupBy("quality", "kept").count().withColumnRenamed("count", "n").collect()}
    good, bad = found[1, True] + found.get((1, False), 0), found[0, False] + found.get((0, True), 0)
    assert found[1, True] >= 0.98 * good
    assert found[0, False] >= 0.7 * bad


def test_no_python_in_the_plan(spark):
    plan = rules.query(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
