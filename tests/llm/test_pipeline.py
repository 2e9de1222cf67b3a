import ast
from pathlib import Path

import public_tokenizers
import pytest

import __spark_entry__ as registered
import corpus_pipeline
from feedpulse.llm import queries, simhash, stages
from feedpulse.llm import toxicity as tox
from tests.conftest import SMALL
from tests.llm.test_mixing import plan, tokens
from tests.llm.test_pii import pii
from tests.llm.test_simhash import groups, plain_fingerprint

ROOT = Path(__file__).resolve().parents[2]


def test_registered():
    names = [n for n in registered.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in registered.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "pii", "mixing", "byte_bpe"]


def test_nothing_else_imports_the_subpackage():
    for file in [*ROOT.glob("feedpulse/**/*.py"), *ROOT.glob("oracle/*.py"), *ROOT.glob("*.py")]:
        inside = "llm" in file.parts or file.name in ("__spark_entry__.py", "corpus_pipeline.py")
        if not inside:
            assert "feedpulse.llm" not in file.read_text()
    tree = ast.parse((ROOT / "corpus_pipeline.py").read_text())
    assert not any(isinstance(node, ast.Try) for node in ast.walk(tree))


@pytest.fixture(scope="module")
def piped(spark):
    """The rows after each stage."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    out.append(docs.collect())
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        from feedpulse.sources.scratch import stored

        docs = stored(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns[: len(columns)] == columns
        out.append(docs.collect())
    return out


def test_toxicity_stage(spark, piped):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    toxic = {r["doc_id"] for r in tox.toxicity(docs, labels).collect() if r["predicted"]}
    assert toxic and {r["doc_id"] for r in piped[1]} == {r["doc_id"] for r in piped[0]} - toxic


def test_dedup_stage_like_brute_force(piped):
    rows = sorted(piped[1], key=lambda r: r["doc_id"])
    ids = [r["doc_id"] for r in rows]
    found = groups([plain_fingerprint(r["text"]) for r in rows], ids)
    assert {r["doc_id"] for r in piped[2]} == set(found)
    assert len(piped[2]) == len(set(found)) < len(rows)


def test_pii_stage_like_one_by_one(piped):
    before = {r["doc_id"]: r["text"] for r in piped[2]}
    assert {r["doc_id"] for r in piped[3]} == set(before)
    changed = 0
    for r in piped[3]:
        text, n = pii.replaced(before[r["doc_id"]], stages.DEMONSTRATION_KEY, {})
        assert r["text"] == text and r["n_chars"] == len(text)
        changed += n > 0
        for m in pii.mentions(before[r["doc_id"]]):
            assert before[r["doc_id"]][m.start : m.end] not in r["text"]
    assert changed


def test_mixing_stage_like_brute_force(piped):
    _, times, _ = plan(piped[3], max_repeats=stages.MAX_REPEATS)
    assert {r["doc_id"] for r in piped[4]} == {r["doc_id"] for r in piped[3]}
    for source, want in times.items():
        whole = sum(tokens(r["text"]) for r in piped[3] if r["source"] == source)
        got = sum(tokens(r["text"]) for r in piped[4] if r["source"] == source)
        longest = max(tokens(r["text"]) for r in piped[3] if r["source"] == source)
        assert want * whole - longest <= got <= want * whole * (1 + 1e-6)


def test_bpe_stage(piped):
    from feedpulse.llm import bpe

    tool = bpe.merger(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    assert len(piped[5]) == len(piped[4])
    for r in piped[5]:
        assert b"".join(bytes(tool.bytes[tool.start[i] : tool.start[i] + tool.length[i]]) for i in r["ids"]).decode() == r["text"]


def test_run_gives_the_last_stage(spark, piped):
    rows = corpus_pipeline.run(spark, SMALL)
    assert sorted(r["doc_id"] for r in rows.select("doc_id").collect()) == sorted(r["doc_id"] for r in piped[5])


def test_simhash_query_like_brute_force(spark):
    rows = queries.queries()["op1_simhash_near_dedup"](spark, SMALL).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    values = [plain_fingerprint(r["text"]) for r in docs]
    assert [r["fingerprint"] for r in rows] == [f"{v:016x}" for v in values]
    assert [r["component_id"] for r in rows] == groups(values, [r["doc_id"] for r in docs])
    assert simhash.CELL


def test_surrogate_key_of_the_session(spark):
    assert stages.surrogate_key(spark) == stages.DEMONSTRATION_KEY
    spark.conf.set(stages.KEY_SETTING, "own secret")
    try:
        assert stages.surrogate_key(spark) == b"own secret"
    finally:
        spark.conf.unset(stages.KEY_SETTING)
