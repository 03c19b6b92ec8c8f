"""Operator 9 against brute force: fingerprints bit by bit, links and components pair by pair."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from shelfline.llm import simhash
from tests.conftest import SF_DIR

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_fingerprint(text: str | None, size: int = 3) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows: list[tuple[int | None, int]], radius: int = 2) -> list[int | None]:
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    known = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        known[root[i]] += [doc] if doc is not None else []
    return [min(known[root[i]], default=None) for i in range(len(rows))]


def test_fingerprints():
    odd = ["", " \n", "One", "one two", "A b C d", "É é\x1cx\x0by z", "w " * 3000, "İ I ı" * 5]
    for text in odd:
        assert simhash.fingerprint(text) == brute_fingerprint(text).to_bytes(8, "big")
    assert simhash.fingerprint(odd[-2], 3, 256)[:8] == simhash.fingerprint(odd[-2])


def test_trees_find_all_within_the_radius():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**64, (20, 4), np.uint64)
    values = np.repeat(centres, 15, axis=0)
    for row in values:
        for bit in rng.integers(0, 256, rng.integers(0, 60)):
            row[bit // 64] ^= np.uint64(1 << int(bit % 64))
    shard = np.sort(rng.integers(0, 4, len(values)))
    trees = simhash.BkTrees(values, shard)
    roots = trees.roots[np.cumsum(np.r_[False, shard[1:] != shard[:-1]])]
    for radius in (0, 10, 50):
        got = set(zip(*(x.tolist() for x in trees.within(values, roots, radius))))
        near = np.bitwise_count(values[:, None] ^ values[None]).sum(axis=2) <= radius
        assert got == set(zip(*(x.tolist() for x in np.nonzero(near & (shard[:, None] == shard[None])))))


def test_components_with_chains_hot_shards_and_split_blocks(spark):
    rng = random.Random(4)
    values, at = {0}, rng.getrandbits(64)
    for _ in range(150):  # a chain in which neighbours link
        values.add(at)
        at ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    hot = rng.getrandbits(64)
    values |= {hot ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)} | {rng.getrandbits(64) for _ in range(200)}
    rows = list(enumerate(sorted(values, key=lambda v: v * 7919 % 10007)))
    firsts = spark.createDataFrame([(v.to_bytes(8, "big"), i) for i, v in rows], "fp binary, first bigint")
    expected = brute_components(rows)
    for block in (1024, 8):
        edges = simhash.links(firsts, simhash.bands(2), 2, block)
        assert edges.count() < 40 * len(rows)
        roots = {bytes(r.node): bytes(r.root) for r in simhash.components(edges).collect()}
        least = defaultdict(list)
        for i, v in rows:
            least[roots.get(v.to_bytes(8, "big"), v.to_bytes(8, "big"))].append(i)
        assert [min(least[roots.get(v.to_bytes(8, "big"), v.to_bytes(8, "big"))]) for _, v in rows] == expected


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(5, None), (3, ""), (9, "a b c d e f"), (9, "a b c d e f"), (None, "A b c D e f"), (None, "other words here x y")]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id bigint, text string, fp string, component_id int")
    marked = [(d, brute_fingerprint(t)) for d, t in rows]
    expected = sorted((d or -1, f"{f:016x}", c or -1) for (d, f), c in zip(marked, brute_components(marked)))
    got = simhash.groups(docs).collect()
    assert sorted((r.doc_id or -1, bytes(r.fp).hex(), r.component_id or -1) for r in got) == expected
    assert simhash.groups(docs.limit(0)).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 9]
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_stage_keeps_the_first_of_each_group(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    first = {d for (d, _), c in zip(rows, brute_components(rows)) if d == c}
    assert len(first) < len(rows)
    assert sorted(r.doc_id for r in simhash.keep_first(docs).collect()) == sorted(first)


def test_query_over_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(spark, SF_DIR).collect()}
    assert got == {d: (f"{f:016x}", c) for (d, f), c in zip(rows, brute_components(rows))}
