"""Components and whitened vectors against numpy's own decomposition."""

import math

import numpy as np
import pytest
from sitelace.llm import queries, whitening

EMB = "vec_id bigint, embedding array<float>, label int"


def brute(vectors):
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return x, n, s, c, e[::-1], u[:, ::-1]


def test_op11_equals_numpy(spark, sf):
    r = np.random.default_rng(4)
    good = (r.standard_normal((300, 12)) * np.linspace(3, 0.5, 12)).astype(np.float32).tolist()
    rows = [(i, v, 1) for i, v in enumerate(good)]
    bad = [(900, None, 1), (901, [None, *good[0][1:]], 1), (902, [math.nan, *good[0][1:]], 1), (903, [math.inf, *good[0][1:]], 1), (904, [], 1), (905, [1.0] * 5, 1)]
    again = [(7, good[7], 1), (None, good[8], None)]  # repeated rows and null ids count
    got = queries.op11_whitening(spark, sf(embeddings=(rows + bad + again, EMB))).toPandas()
    fitted = [*good, good[7], good[8]]
    x, n, s, c, e, u = brute(fitted)
    assert len(got) == 302 * 12 and set(got["n"]) == {302} and not set(got["vec_id"].dropna()) & {900, 901, 902, 903, 904, 905}
    mine = got[got["vec_id"] == 3].sort_values("component")
    z = c @ u / np.sqrt(e)
    sign = np.sign(mine["whitened"].to_numpy() * z[3])
    for i in (0, 55, 299):
        one = got[got["vec_id"] == i].sort_values("component")
        assert np.abs(one["whitened"].to_numpy() * sign - z[i]).max() < 1e-9
        assert set(one["deviation"]) == {int(((n * x[i] - s) ** 2).sum())}
        assert np.abs(one["explained"].to_numpy() - e / e.sum()).max() < 1e-12
    assert got["identity_error"].max() < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(i, [1.0, 2.0], 1) for i in range(5)], [(1, [], 1)]])
def test_without_spread_there_are_no_components(spark, sf, rows):
    assert queries.op11_whitening(spark, sf(embeddings=(rows, EMB))).count() == 0


def test_constant_and_dependent_dimensions_are_left_out(spark, sf):
    r = np.random.default_rng(5).integers(-9, 9, (80, 3))
    rows = [(i, [float(a), float(b), 3.0, float(a + b)], 1) for i, (a, b, _) in enumerate(r)]
    got = queries.op11_whitening(spark, sf(embeddings=(rows, EMB))).toPandas()
    assert got["component"].max() == 2 and got["identity_error"].max() < 1e-6


@pytest.mark.parametrize(("size", "spread"), [(240, lambda k: 1 / np.arange(1, k + 1)), (64, lambda k: 1 + np.arange(k)[::-1] / 100), (90, lambda k: np.repeat([3.0, 2.0, 1.0], k // 3)), (5, lambda k: np.zeros(k))])
def test_lobpcg_certifies_its_components(size, spread):
    r = np.random.default_rng(size)
    q = np.linalg.qr(r.standard_normal((size, size)))[0]
    values = spread(size)
    a = (q * values) @ q.T
    e, u, residuals = whitening.lobpcg(lambda b: a @ b, size, min(20, size))
    assert np.abs(e - np.sort(values)[::-1][: len(e)]).max() < 1e-12
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12
    assert values.max() == 0 or (residuals <= 1e-13).all() and np.linalg.norm(a @ u - u * e) < 1e-12


def test_products_are_made_of_blocks_and_clashing_columns_stay(spark):
    r = np.random.default_rng(6)
    rows = [(i, r.standard_normal(6).tolist(), "mine") for i in range(50)]
    df = spark.createDataFrame(rows, "id int, v array<double>, Whitened string").repartition(7)
    model = whitening.fit(df, "v", 3, whitening.FixedPoint(1 << 20, 0))
    assert model.components.shape == (6, 3) and model.passes >= 2 and (model.residuals < 1e-12).all()
    out = whitening.whiten(df, "v", model).collect()
    assert {r["Whitened"] for r in out} == {"mine"} and len(out[0]["whitened_"]) == 3
