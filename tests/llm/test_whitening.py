"""Operator 13 against numpy's whole-table covariance."""

import numpy as np
import pytest

from tests.conftest import SF01
from landfall.llm import whitening
from landfall.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, n long"


def plain(rows):
    """(x by row, n, sums, eigenvalues falling, eigenvectors) of usable rows, by numpy."""
    good = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    distinct = np.array(sorted({tuple(x) for _, x in good}), dtype=np.int64)
    n, s = len(distinct), distinct.sum(axis=0)
    c = (distinct * n - s).astype(float) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    return good, n, s, e[::-1], q[:, ::-1]


def check(df, rows, column="embedding"):
    good, n, s, e, q = plain(rows)
    k = min(16, len(s))
    got = df.collect()
    assert len(got) == len(good) * k
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    whites = []
    for i, x in good:
        mine = sorted((r for r in by[i]), key=lambda r: r["component"])[:k]
        assert [r["component"] for r in mine] == list(range(1, k + 1))
        assert {r["n"] for r in mine} == {n}
        assert {r["deviation"] for r in mine} == {int(sum((n * v - int(t)) ** 2 for v, t in zip(x, s)))}
        for r in mine:
            assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-8, abs=1e-12)
            assert r["identity_error"] < 1e-8
        whites.append([r["whitened"] for r in mine])
    want = (np.array([x for _, x in good]) * n - s) / n @ q[:, :k] / np.sqrt(e[:k])
    got = np.array(whites, dtype=float)
    clear = [j for j in range(k) if e[j] > 1e-9 * e.sum() and all(abs(e[j] - e[i]) > 1e-6 * e[0] for i in range(len(e)) if i != j)]
    assert clear
    for j in clear:
        sign = np.sign(got[:, j] @ want[:, j])
        assert np.abs(got[:, j] * sign - want[:, j]).max() < 1e-5
    return got


def test_whole_table(spark):
    df = table(spark, SF01, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    check(whitening.op13(spark, SF01), rows)


def test_unusable_and_repeated_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(40, 5)))]
    rows += [(100, rows[0][1]), (101, rows[0][1])]
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [float("nan")] + [0.0] * 4),
           (204, [float("inf")] + [0.0] * 4), (205, [1.0, 2.0]), (206, [3e38] + [0.0] * 4)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows + bad], SCHEMA)  # a column of the result's name
    model = whitening.fit(df)
    assert model.n == 40
    # the plain version rounds to floats as the column does
    rows = [(r["vec_id"], r["embedding"]) for r in df.where("vec_id < 200").collect()]
    check(whitening.transform(df, model), rows)


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (2, [2.0, 2.0], 0)], SCHEMA)
    out = whitening.transform(df, whitening.fit(df)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in out) == [(False, 1)] * 4 + [(False, 2)] * 2 + [(True, 0)] * 2


def test_few_vectors(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)
    out = whitening.transform(one, whitening.fit(one)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in out] == [(1, 0, None, None)] * 4
    two = spark.createDataFrame([(1, [1.0, 2.0, 0.5], 0), (2, [3.0, 2.0, 0.5], 0)], SCHEMA)
    out = {(r["vec_id"], r["component"]): r for r in whitening.transform(two, whitening.fit(two)).collect()}
    assert abs(abs(out[1, 1]["whitened"]) - 1) < 1e-12 and out[1, 1]["whitened"] == -out[2, 1]["whitened"]
    assert out[1, 2]["whitened"] is None and out[1, 1]["explained"] == pytest.approx(1.0)


def test_empty(spark):
    for rows in ([], [(1, None, 0)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert whitening.transform(df, whitening.fit(df)).collect() == []


def test_rank_one_updates_and_merge():
    """Updates and merges give the scatter matrix, with deflation by zeros, equal values and few ranks."""
    rng = np.random.default_rng(0)
    for rows in (np.floor(64 * rng.normal(size=(150, 12)) * rng.random(12)), np.floor(9 * rng.normal(size=(90, 2)) @ rng.normal(size=(2, 12))),
                 np.repeat(np.floor(20 * rng.normal(size=(4, 12))), 15, axis=0), np.zeros((5, 12)), np.eye(12) * 3):
        parts = [whitening.Spectrum.empty(12) for _ in range(3)]
        for i, v in enumerate(rows):
            parts[i % 2].add(v)  # the third has none
        for p in parts[1:]:
            parts[0].merge(p)
        s, c = parts[0], rows - rows.mean(axis=0)
        size = max(1.0, np.abs(c.T @ c).max())
        assert s.n == len(rows) and np.abs(s.mean - rows.mean(axis=0)).max() < 1e-12
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - c.T @ c).max() < 1e-12 * size
        assert np.abs(s.vectors.T @ s.vectors - np.eye(12)).max() < 1e-12


def test_tree_of_spectra(spark, monkeypatch):
    """Many tasks and several levels of merges give the same whitening."""
    monkeypatch.setattr(whitening, "ROWS", 20)
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    df = table(spark, SF01, "embeddings").limit(300)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(16)
    check(whitening.transform(df, whitening.fit(df)), rows)
