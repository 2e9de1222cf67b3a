import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from feedpulse.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tool():
    return bpe.merger(bpe.read_ranks(PATH))


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(tool, reference, texts):
    ids, counts, starts = tool.encode([t.encode() for t in texts])
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        want = reference.encode_ordinary(text)
        assert ids[at : at + n].tolist() == want
        sizes = [len(reference.decode_single_token_bytes(i)) for i in want]
        assert starts[at : at + n].tolist() == [sum(sizes[:i]) for i in range(n)]
        at += n
    assert tool.decode(ids, counts) == [t.encode() for t in texts]


PIECES = ["'s", "'re", "'ll", "'", " ", "  ", "\n", "\t", "a", "Z", "é", "中", "1", "²", "!", "...", " ", "\x1c", "😀", "the", "<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), max_size=6))
def test_like_the_library(tool, reference, texts):
    same(tool, reference, texts)


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_any_characters(tool, reference, text):
    same(tool, reference, [text])


def test_long_runs_and_blocks(tool, reference):
    rng = random.Random(2)
    same(tool, reference, ["a" * 3_000, " " * 2_000 + "x", "ab" * 700, "".join(rng.choices(PIECES, k=5_000)), ""])


def test_classes_of_all_code_points(tool, reference):
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(f"a{chr(p)}1{chr(p)}!{chr(p)} " for p in points[i : i + 64]) for i in range(0, len(points), 64 * 23)]
    same(tool, reference, texts)


def test_cache_that_is_full(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 3)
    small = bpe.Merger(bpe.read_ranks(PATH))
    for _ in range(3):
        same(small, reference, ["one two three four five", "two three nine ten", "one one seven"])
    assert len(small.numbers) == 3


def test_tables(spark, messy, clashing, reference):
    encoded = bpe.encode(clashing, PATH)
    rows = bpe.decode(encoded, PATH).select("doc_id", "text", "n_tokens", "ids", "token_starts", "decoded").collect()
    assert len(rows) == clashing.count()
    for r in rows:
        text = r["text"] or ""
        assert r["ids"] == reference.encode_ordinary(text)
        assert r["n_tokens"] == len(r["ids"]) == len(r["token_starts"])
        assert bytes(r["decoded"]).decode() == text
    digests = bpe.digests(messy, PATH).select("text", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    for r in digests:
        ids = reference.encode_ordinary(r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.digests(messy.limit(0), PATH).collect() == []
