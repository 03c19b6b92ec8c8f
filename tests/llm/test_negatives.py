"""Operator 12 against brute force and SQL: windows, ties, hot labels, exact sums, rows that take no part."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from shelfline.llm import negatives as ng
from tests.conftest import SF_DIR
from tests.parity import differences, oracle_connection

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows: list[tuple[int, list[float], int]], anchors: set[int], positives: int = 5, negatives: int = 10) -> set[tuple]:
    vectors = {i: ([math.floor(256 * x) for x in v], label) for i, v, label in rows}
    out = set()
    for anchor in anchors & set(vectors):
        mine, label = vectors[anchor]
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i, of == label) for i, (v, of) in vectors.items() if i != anchor)
        for fallen, positive, _ in [s for s in scored if s[2]][:positives]:
            inside = [(i, -f) for f, i, same in scored if not same and -30 * fallen <= -100 * f <= -90 * fallen]
            out |= {(anchor, positive, k, i, -fallen, s) for k, (i, s) in enumerate(inside[:negatives], 1)}
    return out


def mine(spark, rows, every: int = 10, **sizes) -> set[tuple]:
    valid = ng.valid(spark.createDataFrame(rows, SCHEMA))
    found = ng.hard_negatives(valid, valid.filter(F.col("vec_id") % every == 0), **sizes).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


@given(st.lists(st.tuples(*[st.integers(-(1 << 63) + 1, (1 << 63) - 1)] * 2, st.booleans(), st.integers(-(1 << 63) + 1, (1 << 63) - 1)), min_size=2))
def test_keys_sort_as_the_stream_needs_them(keys):
    assert [ng.unpacked(ng.packed(*k)) for k in keys] == keys
    assert sorted(keys, key=lambda k: ng.packed(*k)) == sorted(keys, key=lambda k: (k[0], -k[1], k[2], k[3]))


@pytest.mark.parametrize("seed, labels, spread", [(1, 3, 1.0), (2, 1, 1.0), (3, 2, 0.02), (4, 200, 1.0)])
def test_against_brute_force(spark, seed, labels, spread):
    """Few labels, one label, many ties (small vectors have few scores), and labels with a row or two."""
    rng = np.random.default_rng(seed)
    data = rng.normal(0.3, spread, size=(240, 4))
    data[100:140] = data[7]  # copies
    rows = [(int(i) - 20, v.tolist(), int(rng.integers(labels))) for i, v in enumerate(data)]
    assert mine(spark, rows, shard=50, block=7) == brute(rows, {i for i, _, _ in rows if i % 10 == 0})


def test_windows_of_positive_zero_and_negative_scores():
    assert [ng.window(s) for s in (100, 7, 0)] == [(30, 90), (3, 6), (0, 0)]
    low, high = ng.window(-10)
    assert low > high
    keys = [(1, 0, True, 2), (1, 0, False, 9), (1, -5, False, 3), (1, -3, True, 4), (2, 0, True, 1)]
    ordered = sorted(ng.packed(*k) for k in keys)
    assert list(ng.mined(ordered, 10)) == [(1, 9, 1, 2, 0, 0)]


def test_components_that_doubles_cannot_sum(spark):
    rows = [(0, [4e6, 3e6], 1), (1, [4e6, 1e6], 1), (2, [3e6 + 1 / 256, 4e5], 0), (3, [2e6, 4e5], 0), (4, [0.0, 0.0], 0)]
    assert len(brute(rows, {0})) == 2
    assert mine(spark, rows) == brute(rows, {0})
    # Beyond 64 bits, scores are held at the ends of their range: both are the greatest, and none is in its window.
    assert mine(spark, [(0, [1e300], 1), (1, [1.7e308], 1), (2, [1e300], 0)]) == set()


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.5], 2), (3, [0.4, 0.5], 3)]
    bad = [
        (10, [1.0, 1.0], None), (11, None, 2), (12, [0.5, nan], 2), (13, [0.5, inf], 2), (14, [0.5, None], 2),
        (None, [0.5, 0.5], 2), (15, [0.5], 2), (16, [], 2),
    ]
    expected = brute(good, {0})
    assert len(expected) == 2 and mine(spark, good + bad) == expected
    # Repeated rows count once; of rows that share an id the least does.
    assert mine(spark, good * 3 + [(3, [0.4, 0.5], 4)]) == expected


def test_few_rows_and_none(spark):
    assert mine(spark, []) == set()
    assert mine(spark, [(0, [1.0], 1)]) == set()
    assert mine(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == set()
    assert mine(spark, [(0, [1.0], 1), (1, [0.5], 2)]) == set()
    assert mine(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == {(0, 1, 1, 2, 0, 0)}


def test_other_columns_are_not_read(spark, tmp_path):
    rows = [(i, [1.0 + i % 5, 1.0], i % 3) for i in range(300)]
    plain = spark.createDataFrame(rows, SCHEMA)
    names = ["score", "shard", "rows", "anchors", "positives", "negative", "rank", "v", "block", "row", "anchor_id"]
    plain.withColumns({n: F.lit("x") for n in names}).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = ng.query(spark, str(tmp_path))
    assert found.schema.simpleString() == f"struct<{ng.MINED.replace(', ', ',').replace(' ', ':')}>"
    relabelled = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert {tuple(r) for r in found.collect()} == brute(relabelled, {0, 100, 200})


def test_query_against_sql(spark):
    assert differences(ng.query(spark, SF_DIR), oracle_connection(SF_DIR), ng.ORACLE) == []


def test_what_leaves_the_tasks_does_not_grow_with_the_shards(spark):
    """200 shards of 10 rows: an anchor's first rows leave a task once, not once for each shard."""
    rng = np.random.default_rng(5)
    rows = ng.valid(spark.createDataFrame([(i, rng.normal(size=4).tolist(), 1) for i in range(2000)], SCHEMA)).localCheckpoint()
    anchors = rows.filter("vec_id % 50 = 0")
    groups = 2 * spark.sparkContext.defaultParallelism
    left = ng.met(rows, anchors, ng.first_of_label, 5, 10, 8)
    assert left.rdd.getNumPartitions() <= groups < 200
    assert 40 * 5 <= left.count() <= 40 * 5 * groups


@pytest.mark.parametrize("scale", [1.0, 100.0, 1e4, 1e6])
def test_whole_numbers_of_every_width(spark, scale):
    """Vectors of two, four and eight bytes, scores of floats, doubles and integers; also an array of floats."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in np.float32(v * scale)], int(rng.integers(3))) for i, v in enumerate(rng.normal(0.3, 1, size=(120, 3)))]
    expected = brute(rows, {i for i in range(0, 120, 10)})
    assert expected and mine(spark, rows, shard=30, block=5) == expected
    odd = [(200, [1.0, None, 1.0], 1), (201, [1.0, float("nan"), 1.0], 1), (202, [float("-inf"), 1.0, 1.0], 1), (203, [None] * 3, 1)]
    floats = spark.createDataFrame(rows + odd, SCHEMA.replace("double", "float"))
    valid = ng.valid(floats)
    assert valid.schema["v"].dataType.simpleString() == "array<float>"
    assert {tuple(r) for r in ng.hard_negatives(valid, valid.filter("vec_id % 10 = 0")).collect()} == expected


def test_the_best_of_many_tiles_is_that_of_a_sort():
    """Ties go to the smaller id, whatever number of tiles the rows come in and whether places, scores and rows fit one number."""
    rng = np.random.default_rng(7)
    for factor in (1, 1 << 45):
        found = rng.integers(-20, 20, size=(9, 1000)) * factor
        low, high = np.array([[3, -5]] * 9) * factor, np.array([[8, 15]] * 9) * factor
        best = ng.Best(low, high, 4)
        for part in ng.tiles(1000, 300):
            best.look(found[:, part], np.arange(1000)[part], lambda at, row: row % 7 == 0)
        expected = set()
        for i, (a, b) in ((i, w) for i in range(9) for w in zip(low[i], high[i])):
            inside = [(-found[i, j], j) for j in range(1000) if a <= found[i, j] <= b and j % 7]
            expected |= {(i, -s, j) for s, j in sorted(inside)[:4]}
        assert set(zip(*(x.tolist() for x in best.found()))) == expected
