"""Operator 7: counts and base scores exactly, scores against a plain version, gains on held-out text."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfline.llm import brown
from shelfline.llm.common import stored
from tests.conftest import SF_DIR

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens_of(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lower), ""]


def held(doc: int | None) -> bool:
    return doc is None or zlib.crc32(str(doc).encode()) % 5 == 1


def check_base(rows: list[tuple], got: list) -> None:
    counts = Counter(w for d, t in rows if not held(d) for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for d, t in rows:
        words = tokens_of(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        expected.append((str(d), held(d), len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(expected)


def test_query_over_all_documents(spark):
    got = brown.query(spark, SF_DIR).collect()
    check_base([(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()], got)
    out = [r for r in got if r.held_out]
    tokens = sum(r.n_tokens for r in out)
    assert (sum(r.score for r in out) - sum(r.base_score for r in out)) / tokens > 0.29
    assert all(r.score < 0 for r in got)


def plain_classes(texts: list[list[str]], counts: Counter, top: list[bytes], pairs: np.ndarray, of: np.ndarray) -> dict[str, int]:
    """Every word's class by the exchange step, from lists and dictionaries."""
    fixed = {w.decode(): int(k) for w, k in zip(top, of)} | {"": brown.END}
    kind_of = [*([brown.END] if texts else []), *(fixed.get(w, brown.CLASSES) for ws in texts for w in ws)]
    stream = [w for ws in texts for w in ws]
    near: dict[str, list[int]] = {w: [0] * (2 * brown.KINDS) for w in counts}
    for i, w in enumerate(stream):
        near[w][kind_of[i]] += 1
        if i + 1 < len(stream):
            near[w][brown.KINDS + kind_of[i + 2]] += 1
    sums = [[0] * (2 * brown.KINDS) for _ in range(brown.CLASSES)]
    for i, a in enumerate(of):
        for j, b in enumerate(of):
            if b < brown.CLASSES:
                sums[b][a] += int(pairs[i, j])
            if a < brown.CLASSES:
                sums[a][brown.KINDS + b] += int(pairs[i, j])
    for _ in range(brown.EXCHANGES):
        weights = []
        for one in sums:
            halves = [one[: brown.KINDS], one[brown.KINDS :]]
            weights.append([round(math.log2((n + 0.5) / sum(k + 0.5 for k in h)) * 2**20) for h in halves for n in h])
        best, sums = {}, [[0] * (2 * brown.KINDS) for _ in range(brown.CLASSES)]
        for w, row in near.items():
            cells = [(j, n) for j, n in enumerate(row) if n]
            totals = [sum(n * weight[j] for j, n in cells) for weight in weights]
            best[w] = totals.index(max(totals))
            if w and counts[w] > 1:
                for j, n in cells:
                    sums[best[w]][j] += n
    return {w: brown.END if w == "" else brown.UNKNOWN if counts[w] <= 1 else k for w, k in best.items()}


def test_packed_counts_come_back():
    rng = np.random.default_rng(3)
    sums = rng.integers(0, 3, (50, brown.SIDES)) * rng.integers(0, 1 << 40, (50, brown.SIDES))
    sums[7] = 0
    row, column = np.nonzero(sums)
    near = brown.packed(row, column, sums[row, column], 50)
    assert (brown.unpacked(near, np.arange(50), 50) == sums).all()
    assert (brown.unpacked(near, np.arange(50) // 2, 25) == sums.reshape(25, 2, -1).sum(axis=1)).all()


def test_scores_do_not_depend_on_how_the_input_is_dealt(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id < 300").repartition(1)
    found = []
    for parts in (1, 8, 32):
        dealt = docs if parts == 1 else docs.repartition(parts, "doc_id")
        found.append({(r.doc_id, round(r.score, 9)) for r in brown.scores(dealt).collect()})
    assert found[0] == found[1] == found[2]


def test_scores_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    blocks = stored(brown.tokenised(docs), "blocks")
    top = brown.most_frequent(blocks, 50)
    pairs = brown.bigrams(blocks, top)
    rows = [(r.doc_id, tokens_of(r.text)) for r in docs.collect()]
    counts = Counter(w for d, ws in rows if not held(d) for w in ws)
    number = {w.encode(): i for i, w in enumerate(w for w, _ in sorted(counts.items(), key=lambda p: (-p[1], p[0].encode())) if w)}
    assert top == list(number)[:50]
    assert pairs.sum() == sum(counts.values())
    of = brown.exchange(pairs)
    kind = plain_classes([ws for d, ws in rows if not held(d)], counts, list(number)[:50], pairs, of)
    moves, size = Counter(), Counter()

    def walk(words):
        state = (brown.END, False)
        for w in words:
            k = kind.get(w, brown.UNKNOWN)  # a word of held-out texts only
            yield state, k
            state = (state[0], True) if k == brown.UNKNOWN else (k, False)

    for d, words in rows:
        if not held(d):
            for state, k in walk(words):
                moves[state, k] += 1
                moves[state] += 1
                size[k] += 1
    once = sum(c == 1 for w, c in counts.items() if w)

    def score(words):
        total = 0.0
        for w, (state, k) in zip(words, walk(words)):
            total += math.log10((moves[state, k] + 0.5) / (moves[state] + 0.5 * brown.KINDS))
            if k == brown.UNKNOWN:
                total += math.log10((counts[w] + 0.5) / (once + 0.5 * (once + 1)))
            elif k != brown.END:
                total += math.log10(counts[w] / size[k])
        return total

    words = stored(brown.neighbours(blocks, top, of), "words")
    assert {bytes(r.word).decode(): r.c for r in words.collect()} == counts
    marked = stored(brown.marked(blocks, brown.known(blocks, brown.classed(words, pairs, of))), "marked")
    model = brown.Model.of(brown.transitions(marked), sum(counts.values()), len(counts))
    got = {r.doc_id: model.score(r.classes, r.own) for r in marked.collect()}
    assert got == {d: pytest.approx(score(ws)) for d, ws in rows}


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(1)
    planted = rng.integers(0, 3, 40)
    chances = np.array([[0.05, 0.9, 0.05], [0.05, 0.05, 0.9], [0.9, 0.05, 0.05]])
    pairs = np.zeros((42, 42), np.int64)
    pairs[:40, :40] = rng.poisson(30 * chances[planted][:, planted])
    found = brown.exchange(pairs, 3)[:40]
    assert any((np.array(p)[found] == planted).all() for p in itertools.permutations(range(3)))


def test_nulls_repeats_long_texts_clashing_columns_and_no_rows(spark):
    rows = [(1, None), (2, ""), (3, "The the THE é É\x1c x"), (3, "The the THE é É\x1c x"), (None, "the end"), (4, "to be or " * 20_000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, n_tokens int, block string")
    check_base(rows, brown.scores(docs).collect())
    none = brown.scores(docs.limit(0))
    assert none.count() == 0
    untaught = docs.filter("doc_id IS NULL")
    (row,) = brown.scores(untaught).collect()
    assert (row.n_known, row.train_tokens, row.base_score) == (0, 0, 0.0) and row.score <= 0


def test_word_numbers_are_laid_out_to_compress():
    rng = np.random.default_rng(7)
    for tokens in (rng.integers(0, 60_000, 100_000), np.array([0, 255, 256, (1 << 31) - 1]), np.zeros(0, int)):
        assert brown.numbers(brown.planes(tokens)).tolist() == tokens.tolist()
    tokens = rng.integers(0, 60_000, 100_000).astype(np.int32)
    assert 1.8 * len(pa.compress(brown.planes(tokens), "lz4")) < len(pa.compress(tokens.tobytes(), "lz4"))


def test_facts_go_to_their_blocks_as_plain_numbers(spark):
    docs = spark.createDataFrame([(i, "a b c a b " * (i + 1)) for i in range(9)], "doc_id bigint, text string")
    blocks = stored(brown.tokenised(docs), "blocks")
    facts = spark.createDataFrame([], "block bigint, place int, c bigint, class int")
    plan = brown.marked(blocks, facts)._jdf.queryExecution().analyzed().toString()
    assert "collect_list(place" in plan and "collect_list(struct" not in plan
