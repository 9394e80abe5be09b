"""Whitening against a dense eigendecomposition."""
import duckdb
import numpy as np
import pytest

from tessera.llm import whitening as W

from .conftest import SF

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, _x string, _row string"


def dense(vectors):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    c = x - sums / n
    values, turn = np.linalg.eigh(c.T @ c / n)
    k = min(8, len(values))
    values, turn = values[::-1], turn[:, ::-1][:, :k]
    with np.errstate(divide="ignore", invalid="ignore"):
        w = np.where(values[:k] > 1e-9 * values.sum(), c @ turn / np.sqrt(np.abs(values[:k])), 0.0)
    return x, w, values, [sum(int(v) ** 2 for v in n * r.astype(object) - sums.astype(object)) for r in x]


def apply(df):
    x, width = W.whole_numbers(df, "embedding", ["vec_id"])
    x = W.stored(x)
    found = W.fit(x, width)
    return W.whiten(x, width, found), found


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    _, w, values, deviation = dense([v for _, v in rows])
    got = W.query(spark, SF).orderBy("vec_id", "component").toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and len(got) == 8 * len(rows)
    mine = got["whitened"].to_numpy().reshape(len(rows), 8)
    assert np.abs(mine * np.sign((mine * w).sum(axis=0)) - w).max() < 1e-9
    assert got["deviation"].tolist()[::8] == deviation and set(got["n"]) == {len(rows)}
    assert np.abs(got["explained"].to_numpy()[:8] / (values[:8] / values.sum()) - 1).max() < 1e-9
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-8


def test_odd_rows(spark):
    some = np.random.default_rng(3).standard_normal((40, 5)).tolist()
    sound = [(k % 30 if k else None, v, 0, 1, "a", "b") for k, v in enumerate(some)] + [(5, some[0], 0, 1, "a", "b")] * 10
    odd = [(90, None, 0, 1, "a", "b"), (91, [], 0, 1, "a", "b"), (92, [1.0, None, 0.0, 0.0, 0.0], 0, 1, "a", "b"), (93, [float("nan")] * 5, 0, 1, "a", "b"),
           (94, [float("-inf")] + [0.0] * 4, 0, 1, "a", "b"), (95, [1.0, 2.0], 0, 1, "a", "b")]
    rows, found = apply(spark.createDataFrame(sound + odd, SCHEMA).repartition(4))
    got = rows.collect()
    assert len(got) == len(sound) and found.n == len(sound) and len(found.values) == 5
    _, w, values, _ = dense([np.float32(r[1]) for r in sound])
    assert np.allclose(sorted(np.abs([r._whitened[0] for r in got])), sorted(np.abs(w[:, 0])), atol=1e-9)
    assert np.allclose(found.values, values, rtol=1e-12) and W.identity_error(rows, found) < 1e-10


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [2.0, 3.0])], [(k, [1.0, 2.0, 3.0]) for k in range(5)]])
def test_without_variance(spark, rows):
    whitened, found = apply(spark.createDataFrame([(*r, 0, 1, "a", "b") for r in rows], SCHEMA))
    got = whitened.collect()
    assert len(got) == sum(v is not None for _, v in rows) and all(set(r._whitened) == {0.0} and r._deviation == 0 for r in got)
    assert W.identity_error(whitened, found) == 0.0


def test_rank_below_components(spark):
    some = np.random.default_rng(1).standard_normal((50, 2)) @ np.random.default_rng(2).standard_normal((2, 12)) * 0 + np.arange(50)[:, None] * np.eye(12)[:1]
    whitened, found = apply(spark.createDataFrame([(k, v.tolist(), 0, 1, "a", "b") for k, v in enumerate(some)], SCHEMA))
    assert (found.values > 0).tolist() == [True] + [False] * 7
    assert W.identity_error(whitened, found) < 1e-10


def test_close_spectrum_is_certified():
    some = np.random.default_rng(9).standard_normal((64, 64))
    turn = np.linalg.qr(some)[0]
    values = np.concatenate([np.linspace(1.05, 1.01, 9), np.linspace(1.0, 0.5, 55)])
    matrix = turn * values @ turn.T
    vectors, found, residuals, passes = W.leading(lambda q: matrix @ q, 64, 8)
    assert np.abs(np.abs((vectors * turn[:, :8]).sum(axis=0)) - 1).max() < 1e-12 and residuals.max() < 1e-12


def test_large_deviations_stay_exact():
    x = np.array([[0, 2 ** 40], [2 ** 40, 0], [7, 9]], np.int64)
    assert W._deviations(x, 3, x.sum(axis=0)) == [sum((3 * int(v) - int(s)) ** 2 for v, s in zip(r, x.sum(axis=0))) for r in x]
