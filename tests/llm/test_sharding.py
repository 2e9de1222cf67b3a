import duckdb
import pytest

from feedpulse.llm import sharding
from tests.conftest import SMALL


@pytest.mark.parametrize("limit", [200, 1_000, 50_000])
def test_shards_fit(make_docs, limit):
    docs = make_docs(*[(i, "é" * (1 + i * 37 % 90)) for i in range(500)], (1_000, "x" * 2_000))
    rows = sharding.shards(docs, limit).collect()
    assert len(rows) == 501
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    for shard, own in by_shard.items():
        total = sum(r["bytes"] for r in own)
        assert total <= limit or len(own) == 1
        assert {(r["shard_bytes"], r["shard_docs"], r["depth"]) for r in own} == {(total, len(own), len(shard))}
        # No shard lies within another, and none is split without need.
        assert not any(other != shard and other.startswith(shard) for other in by_shard)
        if shard:
            parent = [r for s, o in by_shard.items() if s.startswith(shard[:-1]) for r in o]
            assert sum(r["bytes"] for r in parent) > limit and len(parent) > 1


def test_equal_rows_are_split_too(make_docs):
    docs = make_docs(*[(7, "abcd")] * 300, (None, "abcd"), (None, "abcd"), (1, None), (2, ""))
    rows = sharding.shards(docs, 100).collect()
    assert len(rows) == 304
    assert max(r["shard_bytes"] for r in rows) <= 100


def test_oracle(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    for limit in (1 << 20, 30_000):
        rows = sharding.shards(docs, limit)
        result = con.execute(sharding.oracle(limit))
        names = [d[0] for d in result.description]
        assert sorted(map(tuple, rows.select(*names).collect())) == sorted(result.fetchall())


def test_only_spark_functions(make_docs):
    plan = sharding.shards(make_docs((1, "a")), 10)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_tables(messy, clashing, tmp_path, spark):
    assert sharding.shards(messy.limit(0), 10).collect() == []
    rows = sharding.shards(clashing, 100)
    assert rows.count() == clashing.count()
    sharding.write_shards(messy, str(tmp_path / "shards"), 100)
    back = spark.read.option("basePath", str(tmp_path / "shards")).parquet(str(tmp_path / "shards"))
    assert back.count() == messy.count()
