"""Operator 3: every id in exactly one piece, gapless sequences, little padding; ids against the tokenizers library."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfline.llm import packing, tokens
from tests.conftest import SF_DIR

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)


def test_ids_are_the_library_s():
    rng = random.Random(3)
    signs = [" ", "  ", "a", "bc", "\n", "\t", "　", "\x1c", "'s", "1", ".", "é", "<|endoftext|>", "\0", "\x85", "🦙"]
    made = ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(2000)]
    made += ["", "x" * 50_000, " " * 50_000]
    codec = tokens.codec(VOCABULARY)
    for text, ids in zip(made, codec.encode_batch(made)):
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text


def check(pieces: list, expected: dict[int, list[list[int]]], window: int) -> int:
    """Pieces against the ids of each document (doc_id: the ids of its rows); returns the number of sequences."""
    filled, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        filled[p.sequence_id].append((p.offset, p.length))
        parts[p.doc_id].append((p.start, ids, p.doc_tokens))
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    for doc, rows in expected.items():
        assert sum(len(ids) for _, ids, _ in parts[doc]) == sum(map(len, rows))
        if len(rows) == 1:
            assert sum((ids for _, ids, _ in sorted(parts[doc])), []) == rows[0]
    assert set(parts) == set(expected) and sorted(filled) == list(range(len(filled)))
    return len(filled)


def test_query_over_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = packing.packed(docs, VOCABULARY).collect()
    expected = {r.doc_id: [LIBRARY.encode(r.text, add_special_tokens=False).ids + [1]] for r in docs.collect()}
    n = check(pieces, expected, 2048)
    assert n == -(-sum(len(i) for (i,) in expected.values()) // 2048)
    whole = sum(p.length == p.doc_tokens for p in pieces if p.doc_tokens < 2048)
    assert whole >= 0.5 * sum(len(i) < 2048 for (i,) in expected.values())
    crc = packing.query(spark, SF_DIR).selectExpr("sum(ids_crc32) s", "sum(length) n").first()
    assert crc.n == sum(len(i) for (i,) in expected.values())


def test_nulls_repeats_long_texts_clashing_columns_and_no_rows(spark):
    rows = [(i, "ab " * 11, 0, "x") for i in range(30)] + [(40, None, 0, ""), (41, "", 0, ""), (42, "q w " * 5000, 0, "")]
    rows += [(50, "same text", 0, "")] * 3 + [(None, "no id", 0, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length int, ids string").repartition(5)
    expected = defaultdict(list)
    for i, t, *_ in rows:
        expected[i].append(LIBRARY.encode(t or "", add_special_tokens=False).ids + [1])
    pieces = packing.packed(docs, VOCABULARY, window=64)
    n = check(pieces.collect(), expected, 64)
    total = sum(len(x) for xs in expected.values() for x in xs)
    assert n == -(-total // 64)
    made = packing.sequences(pieces, 64, pad_id=7).collect()
    assert {len(s.ids) for s in made[:-1]} == {256} and sum(s.n_tokens for s in made) == total
    assert packing.packed(docs.limit(0), VOCABULARY).count() == 0


@pytest.mark.parametrize("shape", ["even", "one length", "random"])
def test_plan_uses_every_piece_once(shape):
    rng = np.random.default_rng(2)
    histogram = np.zeros(64, np.int64)
    histogram[1:] = {"even": 50, "one length": 0, "random": rng.integers(0, 90, 63)}[shape]
    histogram[45] += 1000 * (shape == "one length")
    made = packing.plan(histogram, 10, 64)
    filled = defaultdict(int)
    for length in range(1, 64):
        for rank in range(histogram[length]):
            for _, n, sequence, _ in made.places(length, rank):
                filled[sequence] += n
    assert sorted(filled) == list(range(10, made.sequences))
    assert all(filled[s] == 64 for s in list(filled) if s < made.sequences - 1)


def test_least_squares_reaches_the_best_fit():
    combos = [((1, 1), (7, 1)), ((2, 1), (6, 1)), ((4, 2),), ((1, 2), (6, 1)), ((2, 4),)]
    histogram = np.array([0, 9, 14, 0, 6, 0, 8, 5])
    x = packing.least_squares(histogram, combos, 500)
    a = np.zeros((8, len(combos)))
    for j, combo in enumerate(combos):
        for length, n in combo:
            a[length, j] += n
    slope = a.T @ (a @ x - histogram)
    assert (x >= 0).all() and (slope > -1e-2).all() and np.abs(slope * x).max() < 5e-2
