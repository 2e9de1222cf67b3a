import numpy as np
import pytest

from feedpulse.llm import embedding_dedup, neighbours

INF, NAN = float("inf"), float("nan")
SCHEMA = "vec_id long, embedding array<float>, label int"
UNUSABLE = [(900, None, 1), (901, [0.0] * 8, 1), (902, [1.0, None] + [0.0] * 6, 1), (903, [NAN] * 8, 1), (904, [INF] + [0.0] * 7, 1)]


def clustered(n=400, width=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((25, width))
    x = centres[rng.integers(0, 25, n)] + 0.12 * rng.standard_normal((n, width))
    x[50:90] = x[50]  # one common vector
    x[90:95] = 3 * x[50]
    return x.astype(np.float32), rng.integers(0, 3, n)


@pytest.fixture(scope="module")
def table(spark):
    x, label = clustered()
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    return spark.createDataFrame([*rows, *UNUSABLE, (905, x[0].tolist(), None)], SCHEMA), x, label


@pytest.mark.parametrize("settings", [{}, {"CELL_TARGET": 4, "PART": 16}])
def test_near_duplicates_like_brute_force(table, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(embedding_dedup, name, value)
    df, x, label = table
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        new = np.array([min(root[i], *root[near[i]], root[i]) for i in range(len(x))])
        if (new == root).all():
            break
        root = new
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert len(got) == df.count()
    assert near.sum() > 500
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum(), root[i], root[i] == i)
    for i in range(900, 906):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)


def test_lower_recall_finds_most(table):
    df, _, _ = table
    whole = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df).collect()}
    part = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df, recall=0.95).collect()}
    assert all(part[i] <= whole[i] for i in whole) and sum(part.values()) >= 0.9 * sum(whole.values())


def exact(x, ids, asked, k):
    scores = x.astype(float) @ x[ids.index(asked)].astype(float)
    order = sorted((j for j in range(len(ids)) if ids[j] != asked), key=lambda j: (-round(scores[j], 9), ids[j]))
    return [(ids[j], scores[j]) for j in order[:k]]


@pytest.mark.parametrize("settings", [{}, {"CELL": 40, "LEAF": 8, "QUERIES": 5}])
def test_neighbours_like_brute_force(table, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(neighbours, name, value)
    df, x, _ = table
    ids = list(range(len(x)))
    rows = neighbours.nearest(df.where("vec_id < 905"), df.where("vec_id % 10 = 0"), k=10).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], []).append(r)
    assert set(found) == {i for i in ids if i % 10 == 0}
    hits = 0
    for asked, own in found.items():
        own.sort(key=lambda r: r["rank"])
        want = exact(x, ids, asked, 10)
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(-r["score"], r["vec_id"]) for r in own] == sorted((-r["score"], r["vec_id"]) for r in own)
        for r in own:
            assert r["score"] == pytest.approx(float(x[asked].astype(float) @ x[r["vec_id"]].astype(float)), abs=1e-9)
        hits += len({r["vec_id"] for r in own} & {i for i, _ in want})
    assert hits / (10 * len(found)) >= 0.9


def test_ties_go_to_the_smaller_id(table):
    df, x, _ = table
    rows = neighbours.nearest(df.where("vec_id between 50 and 89"), df.where("vec_id = 60"), k=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in rows] == [50, 51, 52, 53, 54]


def test_few_rows_and_none(spark, table):
    df, _, _ = table
    three = df.where("vec_id < 3")
    rows = neighbours.nearest(three, three.where("vec_id = 0"), k=20).collect()
    assert sorted(r["vec_id"] for r in rows) == [1, 2]
    for none in (df.limit(0), df.where("vec_id between 900 and 904")):
        assert neighbours.nearest(none, none).collect() == []
        assert embedding_dedup.near_duplicates(none).count() == none.count()
    odd = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0], 1), (2, [2.0], None)], SCHEMA)
    more = odd.selectExpr("*", "'x' AS node", "1 AS vector", "2 AS cell")
    got = embedding_dedup.near_duplicates(more).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in got) == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2)]
    assert [(r["query_id"], r["vec_id"]) for r in neighbours.nearest(more, more.where("vec_id = 2")).collect()] == [(2, 1), (2, 1)]
