"""Operator 4: counts of written files against the sentencepiece library, blocks of any size against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from shelfline.llm import separators
from shelfline.llm.common import scratch
from tests.conftest import SF_DIR

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def brute(ids: list[int]) -> list[tuple[int, int, int, bool]]:
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == 2:
            out.append((len(out), start, i - start, True))
            start = i + 1
    return out + ([(len(out), start, len(ids) - start, False)] if start < len(ids) else [])


@pytest.mark.parametrize("size", [1, 3, 64])
def test_blocks_of_any_size(spark, size):
    rng = random.Random(size)
    files = {f"f{i}": [rng.choice((2, 5, 7, 514, 512, 2 << 8)) for _ in range(rng.randrange(1, 90))] for i in range(12)}
    files |= {"only": [2], "open": [5] * 40, "all": [2] * 9}
    rows = []
    for name, ids in files.items():
        rows += [(name, b, np.array(ids[b * size : (b + 1) * size], "<u2").tobytes()) for b in range(-(-len(ids) // size))]
    rng.shuffle(rows)
    got = separators.documents(separators.scan(spark.createDataFrame(rows, "file string, block int, data binary")))
    expected = Counter((name, *d) for name, ids in files.items() for d in brute(ids))
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_files_with_nulls_empty_and_long_texts(spark):
    rows = [(1, None), (2, ""), (3, "to be " * 30_000), (4, "or not"), (4, "or not"), (5, "</s>")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2)
    path = scratch(spark, "tokens")
    separators.write_token_files(docs, path, MODEL, docs_per_file=3)
    blocks = separators.read_blocks(spark, path, 1000)
    got = separators.documents(separators.scan(blocks)).collect()
    assert all(r.closed for r in got)
    assert Counter(r.n_tokens for r in got) == Counter(len(LIBRARY.encode(t or "")) for _, t in rows)
    none = scratch(spark, "tokens")
    separators.write_token_files(docs.limit(0), none, MODEL)
    assert separators.documents(separators.scan(separators.read_blocks(spark, none))).count() == 0


def test_torn_file_stops(spark):
    torn = spark.createDataFrame([("f", 0, bytearray(3))], "file string, block int, data binary")
    with pytest.raises(Exception, match="ends inside an id"):
        separators.scan(torn).collect()


def test_query_over_all_documents(spark):
    got = separators.query(spark, SF_DIR).collect()
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert Counter(r.n_tokens for r in got) == Counter(len(i) for i in LIBRARY.encode(texts))
    by_file = {}
    for r in sorted(got, key=lambda r: (r.file, r.doc_index)):
        assert (r.doc_index, r.start) == by_file.get(r.file, (0, 0))
        by_file[r.file] = (r.doc_index + 1, r.start + r.n_tokens + 1)
