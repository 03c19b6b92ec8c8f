"""Operator 6 against brute force: recall, exact scores and order, the footrule itself."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from shelfline.llm import permutations as pm
from tests.conftest import SF_DIR


def brute(ids: np.ndarray, data: np.ndarray, query: int, most: int) -> list[tuple[int, float]]:
    scores = [(float((x * data[ids == query][0]).sum()), i) for i, x in zip(ids.tolist(), data) if i != query]
    return [(i, s) for s, i in sorted(scores, key=lambda p: (-p[0], p[1]))[:most]]


def rows_of(found) -> dict[int, list[tuple[int, float]]]:
    out: dict[int, list] = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_footrule():
    rng = np.random.default_rng(1)
    seen = np.array([rng.permutation(20)[:6] for _ in range(50)])
    files = pm.InvertedFiles(seen, 20)
    places = np.full((50, 20), 6)
    np.put_along_axis(places, seen, np.arange(6)[None], 1)
    for i in range(50):
        assert files.footrule(seen[i]).tolist() == np.abs(places - places[i]).sum(axis=1).tolist()


def test_all_candidates_is_exact_for_vectors_of_any_length(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(300, 5)) * rng.uniform(0.1, 4, (300, 1))
    data[100:110] = data[50]  # ties
    ids = np.arange(300)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, data)], "vec_id bigint, v array<double>")
    found = pm.search(frame, frame.filter("vec_id % 20 = 0"), 7, pivots=16, prefix=8, candidates=1.0, shard=64)
    got = rows_of(found)
    assert sorted(got) == list(range(0, 300, 20))
    for query, rows in got.items():
        expected = brute(ids, data, query, 7)
        assert [i for i, _ in rows] == [i for i, _ in expected]
        np.testing.assert_allclose([s for _, s in rows], [s for _, s in expected], rtol=1e-14)


def test_recall_with_unequal_lengths(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(4000, 32)) * rng.uniform(0.5, 1.5, (4000, 1))
    ids = np.arange(4000)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, data)], "vec_id bigint, v array<double>")
    got = rows_of(pm.search(frame, frame.filter("vec_id % 200 = 0")))
    hits = sum(len({i for i, _ in rows} & {i for i, _ in brute(ids, data, q, 20)}) for q, rows in got.items())
    assert len(got) == 20 and hits >= 0.9 * 400


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, [None, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 1.0]), (9, [2.0, 5.0]), (20, [1.0, 1.0]), (40, None),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, v string, shard int")
    vectors = pm.valid(frame)
    assert sorted(r.vec_id for r in vectors.collect()) == [0, 1, 9, 20]
    got = rows_of(pm.search(vectors, vectors.filter("vec_id % 20 = 0")))
    assert got == {0: [(1, 2.0), (9, 2.0), (20, 1.0)], 20: [(9, 7.0), (1, 2.0), (0, 1.0)]}
    for none in (pm.valid(frame.limit(0)), vectors.filter("vec_id > 99")):
        assert pm.search(none, none).count() == 0


def test_query_over_all_embeddings(spark):
    got = rows_of(pm.query(spark, SF_DIR))
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas()
    ids, data = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), float)
    assert sorted(got) == sorted(i for i in ids.tolist() if i % 20 == 0)
    hits = 0
    for query, rows in got.items():
        expected = dict(brute(ids, data, query, len(ids)))
        assert len(rows) == 20 and all(abs(expected[i] - s) < 1e-12 for i, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        hits += len({i for i, _ in rows} & set(list(expected)[:20]))
    assert hits >= 0.95 * 20 * len(got)


def test_many_copies_of_one_vector_give_the_smallest_ids(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(3000, 8))
    copies = np.sort(rng.permutation(3000)[:1000])
    data[copies] = data[copies[0]] * 3
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id bigint, v array<double>")
    asked = [int(copies[3]), int(copies[-1])]
    for order in ("vec_id", "-vec_id"):
        rows = frame.orderBy(F.expr(order)).coalesce(3)
        got = rows_of(pm.search(rows, frame.filter(F.col("vec_id").isin(asked))))
        for q in asked:
            assert got[q] == brute(np.arange(3000), data, q, 20)
