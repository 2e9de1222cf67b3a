from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedpulse.llm import queries, whitening
from tests.conftest import SMALL
from tests.llm.conftest import CLASHING


def spread(values, seed=0):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [[5, 4, 3, 2, 1], [5, 5, 5, 2, 1, 1], [1e6, 1e6 * (1 - 1e-9), 10, 1e-3], [3.0] * 6, [1, 1 + 1e-12, 2], [0, 0, 7], [4.0]]
    + [[2.0**-i for i in range(40)], [1.0] * 20 + [1 + 1e-10] * 20 + list(range(2, 26))],
)
def test_eigenvectors(values):
    a = spread(values)
    e, x = whitening.eigen(a)
    size = max(np.abs(values))
    assert np.abs(e - np.sort(values)[::-1]).max() <= 1e-14 * size
    assert np.abs(x.T @ x - np.eye(len(values))).max() <= 1e-14
    assert np.abs(a @ x - x * e).max() <= 1e-14 * size


def test_refinement_beats_single_precision():
    a = spread(np.linspace(1, 2, 50))
    start = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(float)
    want = np.linalg.eigh(a)[1][:, ::-1]
    off = lambda x: np.abs(np.abs((x * want).sum(axis=0)) - 1).max()
    single = np.abs(np.abs(start) - np.abs(want)).max()
    refined = np.abs(np.abs(whitening.eigen(a)[1]) - np.abs(want)).max()
    assert single > 1e-7 and refined < 1e-12 and off(whitening.eigen(a)[1]) < 1e-14
    assert whitening.eigen(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]


def plain(vectors):
    """Integer vectors, the fit list's n, sums and covariance, the last in exact fractions rounded once."""
    x = np.floor(64 * np.asarray(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = (n * fit - sums).astype(object)
    v = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in y.T @ y])
    return x, n, sums, v


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    x, n, sums, v = plain([r.embedding for r in rows])
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    got = queries.op12_embedding_whitening(spark, SMALL).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 16 * len(rows) and (got.n == n).all()
    assert got.component.tolist() == list(range(1, 17)) * len(rows)
    assert got.deviation.tolist()[::16] == ((n * x - sums) ** 2).sum(axis=1).tolist()
    want = ((x - sums / n) @ q[:, :16]) / np.sqrt(e[:16])
    white = got.whitened.to_numpy().reshape(-1, 16)
    sign = np.sign((want * white).sum(axis=0))
    assert np.abs(white * sign - want).max() < 1e-9
    assert np.allclose(got.explained.to_numpy().reshape(-1, 16), e[:16] / np.trace(v), rtol=1e-10)
    fit = np.unique(np.column_stack([x, white]), axis=0)[:, -16:]
    off = np.cov(fit.T, bias=True) - np.eye(16)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] == pytest.approx(np.abs(off).max(), abs=1e-12)
    assert got.identity_error.iloc[0] < 1e-10


NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(8)
    good = [(i, rng.normal(size=4).astype(np.float32).tolist(), 1) for i in range(30)]
    bad = [(100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [NAN] * 4, 1), (103, [INF, 0.0, 0.0, 0.0], None)]
    more = [(0, good[0][1], 2), (31, [0.0] * 4, None), (None, good[3][1], 1)]
    return spark.createDataFrame(good + bad + more, "vec_id long, embedding array<float>, label int")


def test_messy_tables(odd, spark):
    got = whitening.whitened(odd).toPandas()
    assert sorted(got.vec_id.dropna().astype(int).unique()) == list(range(30)) + [31]
    assert len(got) == 33 * 4 and (got.n == 31).all() and got.identity_error.max() < 1e-10
    vectors = [r.embedding for r in odd.collect() if r.embedding and np.isfinite(np.array(r.embedding, dtype=float)).all()]
    x, n, sums, v = plain(vectors)
    assert sorted(got[got.component == 1].deviation) == sorted(((n * x - sums) ** 2).sum(axis=1))
    extra = odd.select("*", *[F.lit("x").alias(c) for c in (*CLASHING, "key", "x", "v") if c != "label"])
    assert whitening.whitened(extra.withColumn("component", F.lit(1))).count() == len(got)
    assert whitening.whitened(odd.limit(0)).collect() == []
    assert whitening.whitened(odd.where("vec_id >= 100")).columns == got.columns.tolist()
    assert whitening.whitened(odd.where("vec_id >= 100")).collect() == []


def test_nothing_varies(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    rows = whitening.whitened(one).collect()
    assert len(rows) == 4
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(1, 0, None, None, None)}


def test_fewer_vectors_than_dimensions(spark):
    rows = [(i, [float(i == j) for j in range(6)]) for i in range(3)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got if r.whitened is not None} == {1, 2}
    assert {r.component for r in got} == set(range(1, 7))
    assert all(r.identity_error < 1e-10 for r in got)


def test_short_and_large_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0]), (3, [1.0, 0.0]), (4, []), (5, [1e300, -1e300]), (6, [3.0, 1.0])]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    first = {r.vec_id: r for r in got if r.component == 1}
    assert len(got) == 12 and first[1].n == 5  # vectors 2 and 3 are one
    assert first[5].deviation is None and first[1].deviation is None
    assert first[2].whitened == first[3].whitened
