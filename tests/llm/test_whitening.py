"""Whitening against covariances of Python integers."""

import numpy as np
import pytest

from incidentlens.llm import queries, whitening
import brute

SCHEMA = "vec_id long, embedding array<double>"


def compared(found, rows):
    keys, deviations, expected, explained = brute.whitening(rows)
    place = {k: i for i, k in enumerate(keys)}
    values = np.zeros_like(expected)
    for r in found:
        i = place[r["vec_id"]]
        assert (r["n"], r["deviation"]) == (len(keys), deviations[i])
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
        values[i, r["component"] - 1] = r["whitened"]
    assert len(found) == expected.size
    signs = np.sign((values * expected).sum(axis=0))
    assert np.abs(values * signs - expected).max() < 1e-9


@pytest.mark.parametrize("rows_a_block", [64, 100, 4096])
def test_given_vectors(spark, small, rows_a_block, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", rows_a_block)
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compared(queries.op13_whitening(spark, small).collect(), rows)


def test_vectors_that_do_not_count(spark):
    good = [(i, [float(i % 5), i * 0.37, -float(i * i % 11)]) for i in range(40)]
    bad = [
        (100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]),
        (104, [1.0, float("inf"), 1.0]), (105, [1.0, 1.0, float("-inf")]), (106, [1.0, 2.0]), (107, [1e300, 0.0, 0.0]),
    ]
    docs = spark.createDataFrame(good + bad, SCHEMA).selectExpr("*", "1 AS vector", "2 AS n", "3 AS whitened")
    compared(whitening.by_component(docs).collect(), good)


def test_repeated_rows_and_missing_keys(spark):
    rows = [(None, [1.0, 2.0]), (7, [0.0, 1.0]), (7, [0.0, 1.0]), (8, [5.0, -3.0])]
    found = whitening.by_component(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in found) == [(0, 1), (0, 2), (7, 1), (7, 1), (7, 2), (7, 2), (8, 1), (8, 2)]
    assert {r["n"] for r in found} == {4}


def test_no_rows_one_row_and_no_variance(spark):
    assert whitening.by_component(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.by_component(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []
    for rows in ([(1, [2.0, 3.0])], [(i, [2.0, 3.0]) for i in range(5)]):
        found = whitening.by_component(spark.createDataFrame(rows, SCHEMA)).collect()
        assert len(found) == 2 * len(rows)
        assert {(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in found} == {(None, 0.0, 0, None)}


def test_entries_of_very_different_size(spark):
    rows = [(i, [1e9 * (i % 7) + i, 0.25 * (i % 3), -1e5 * i]) for i in range(50)]
    keys, deviations, _, _ = brute.whitening(rows)
    found = whitening.by_component(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["vec_id"], r["deviation"]) for r in found} == {
        (k, d if d < 2**63 else None) for k, d in zip(keys, deviations, strict=True)
    }


@pytest.mark.parametrize("spread", [1, 2, 1000, 2**31, 2**45])
def test_bit_planes_give_exact_products(spread):
    chance = np.random.default_rng(5)
    for rows in (1, 63, 64, 65, 300):
        x = chance.integers(-spread, spread, (rows, 5)) + 100_000
        moments = whitening.Moments()
        moments.add(x[: rows // 2 + 1])
        if rows > 1:
            moments.add(x[rows // 2 + 1 :])
        exact = x.astype(object)
        products = exact.T @ exact
        assert moments.sums == exact.sum(axis=0).tolist() and moments.count == rows
        assert moments.products == [[products[i, j] for j in range(i, 5)] for i in range(5)]
