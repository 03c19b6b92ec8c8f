"""Operator 10: chunks and copies against a brute-force version, passages planted in random text."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from shelfline.llm import chunks
from tests.conftest import SF_DIR


def brute_cuts(data: bytes) -> list[int]:
    out, last = [], 0
    for i in range(len(data)):
        rolled = 0
        for k in range(min(chunks.REACH, i + 1)):
            rolled += int(chunks.GEAR[data[i - k]]) << k
        ends = (rolled % 2**32) >> (chunks.REACH - 1) & ((1 << chunks.BITS) - 1) == 0
        if ends or i + 1 - last == chunks.LONGEST or i + 1 == len(data):
            out.append(i + 1)
            last = i + 1
    return out


def brute(rows: list[tuple[int | None, str | None]]) -> list[tuple[list, str | None]]:
    """Removed spans and what is left of each row, rows taken in order of doc_id.

    A chunk that stood earlier joins the one before it only if it stood behind the same one there.
    """
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, pairs, out = set(), set(), {}
    for i in order:
        data = (rows[i][1] or "").encode()
        spans, at, behind = [], 0, b""
        for end in brute_cuts(data):
            digest = xxhash.xxh3_128_digest(data[at:end])
            if digest in seen:
                spans.append((at, end, (behind, digest) in pairs))
            seen.add(digest)
            pairs.add((behind, digest))
            at, behind = end, digest
        gone = chunks.removed(data, spans)
        left, at = b"", 0
        for a, b in gone:
            left, at = left + data[at:a], b
        out[i] = (gone, None if rows[i][1] is None else (left + data[at:]).decode())
    return [out[i] for i in range(len(rows))]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("aeioubcdfgé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_cuts_and_their_resistance_to_shifts():
    rng = random.Random(1)
    for data in (b"", b"a", b"a" * 5000, words(rng, 600).encode(), bytes(rng.randrange(256) for _ in range(3000))):
        assert chunks.cuts(data).tolist() == brute_cuts(data)
    data = words(rng, 2000).encode()
    whole = {data[a:b] for a, b in zip([0, *chunks.cuts(data)], chunks.cuts(data))}
    moved = data[:5000] + b"inserted" + data[5000:]
    ends = chunks.cuts(moved)
    assert sum(moved[a:b] not in whole for a, b in zip([0, *ends], ends)) <= 3


def test_removed_spans_are_whole_words():
    data = b"one two three four five six"
    assert chunks.removed(data, [(2, 9), (9, 15)], 5) == [(4, 14)]
    assert chunks.removed(data, [(0, 27)], 5) == [(0, 27)]
    assert chunks.removed(data, [(2, 9)], 50) == []
    assert chunks.removed(b"x" * 300, [(10, 290)], 80) == []


def test_planted_passages(spark):
    rng = random.Random(2)
    passages = [words(rng, rng.randrange(51, 120)) for _ in range(60)]
    rows = []
    for i in range(240):
        rows.append((i, f"{words(rng, rng.randrange(5, 80))}\n{passages[i % 60]}\n{words(rng, rng.randrange(5, 80))}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    left = {r.doc_id: r.text for r in chunks.deduplicated(docs).collect()}
    for i, text in rows:
        if i < 60:
            assert left[i] == text
        else:
            head, passage, tail = text.split("\n")
            assert head[: len(head) * 9 // 10] in left[i] and tail[len(tail) // 4 :] in left[i]
            assert passage not in left[i] and len(left[i]) < len(text) - 0.3 * len(passage)


def test_rows_of_all_kinds_against_brute_force(spark):
    rng = random.Random(3)
    same = words(rng, 90)
    rows = [(4, same), (2, f"before {same} after"), (4, same), (7, None), (8, ""), (None, same), (9, "ab " * 40_000)]
    rows += [(20 + i, words(rng, 60)) for i in range(5)]
    docs = spark.createDataFrame([(d, t, 3, "x") for d, t in rows], "doc_id bigint, text string, row int, spans string")
    docs = docs.coalesce(1)
    got = chunks.deduplicated(docs)
    assert got.columns == [*docs.columns, "removed"]
    found = sorted((str(r.doc_id), [tuple(s) for s in r.removed], str(r.text)) for r in got.collect())
    assert found == sorted((str(d), gone, str(left)) for (d, _), (gone, left) in zip(rows, brute(rows)))
    kept = chunks.drop_repeats(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["2", "4", "7", "8", "9", *map(str, range(20, 25))])
    assert chunks.drop_repeats(docs.limit(0)).count() == 0
    named = chunks.deduplicated(docs.withColumnRenamed("spans", "removed"))
    assert named.columns == ["doc_id", "text", "row", "removed"]
    assert sorted([tuple(s) for s in r.removed] for r in named.collect()) == sorted(gone for _, gone, _ in found)


def test_query_over_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("length(text) < 20000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: ([tuple(s) for s in r.removed], r.text) for r in chunks.deduplicated(docs).collect()}
    assert got == {d: found for (d, _), found in zip(rows, brute(rows))}
    assert chunks.query(spark, SF_DIR).count() == 1000


def test_snippets_of_unrelated_documents_are_no_passage(spark):
    rng = random.Random(5)
    sources = [words(rng, 200).replace("é", "e") for _ in range(30)]
    parts = []
    for text in sources:
        data = text.encode()
        ends = chunks.cuts(data).tolist()
        parts.append(next(data[a:b] for a, b in zip(ends, ends[1:]) if 24 <= b - a <= 60).decode())
    salad, passage = "".join(parts), sources[3][200:700]
    rows = [*enumerate(sources), (50, salad), (51, f"{salad[:70]} {passage}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    left = {r.doc_id: r.text for r in chunks.deduplicated(docs).collect()}
    assert left[50] == salad
    assert salad[:60] in left[51] and len(left[51]) < len(rows[-1][1]) - 300


def test_batches_whose_rows_are_in_no_order(spark):
    """Many small files, which a task reads in the order of their sizes."""
    rng = random.Random(6)
    shared = [words(rng, 60) for _ in range(5)]
    rows = [(i, f"{words(rng, rng.randrange(1, 200))} {shared[i % 5]}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(60)
    got = {r.doc_id: ([tuple(s) for s in r.removed], r.text) for r in chunks.deduplicated(docs).collect()}
    assert got == {d: found for (d, _), found in zip(rows, brute(rows))}


def test_a_copied_chunk_takes_one_number(spark):
    docs = spark.createDataFrame([(i, 10 + i, "some words that stand in every text, " * 9 + f"and {i}") for i in range(5)], "row long, doc long, text string")
    found = chunks.copies(chunks.chunked(docs))
    assert dict(found.dtypes)["copied"] == "array<int>"
    texts = {r.row: r.text.encode() for r in docs.collect()}
    for r in found.collect():
        ends = [0, *chunks.cuts(texts[r.row]).tolist()]
        spans = chunks.copied_spans(texts[r.row], np.array(r.copied))
        assert [(a, b) for a, b, _ in spans] == [(ends[n], ends[n + 1]) for n in sorted(n if n >= 0 else ~n for n in r.copied)]
        assert sum(joined for *_, joined in spans) == sum(n >= 0 for n in r.copied) > 0
