import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from feedpulse.llm import simhash
from feedpulse.llm.components import components, forest


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, ids, distance=4):
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for x, i in zip(label, ids, strict=True):
        least[x] = min(least.get(x, i), i)
    return [least[x] for x in label]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ABab é \t\n\x0b1'", max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_long_text_is_hashed_whole(monkeypatch):
    text = " ".join(random.Random(1).choices(["aa", "bb", "cc", "dd", "ee"], k=3_000))
    monkeypatch.setattr(simhash, "AT_ONCE", 700)
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_golay_code_is_perfect():
    _, count, patterns, weights = simhash.error_patterns(3)
    assert (count == 1).all() and len(patterns) == 2048 and weights.max() == 3


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=4), st.sampled_from([1, 2]))
def test_close_fingerprints_meet_at_an_anchor(value, flips, together):
    other = value
    for bit in flips:
        other ^= 1 << bit
    pair = np.array([value, other], dtype=np.uint64).view(np.int64)
    row, anchor, home = simhash.anchors(pair, 4, 3, together)
    homes = set(anchor[(row == 0) & home].tolist())
    assert homes & set(anchor[row == 1].tolist())


def chain(rng, n):
    """Fingerprints of which many are near each other, with ids."""
    values = []
    for _ in range(n // 6):
        x = rng.getrandbits(64)
        for _ in range(6):
            values.append(x)
            for bit in rng.sample(range(64), rng.choice([0, 1, 3, 4, 5, 8])):
                x ^= 1 << bit
    return values


def test_components_like_brute_force(spark):
    rng = random.Random(7)
    values = [*chain(rng, 300), 0, 0, 2**64 - 1]
    ids = rng.sample(range(10_000), len(values))
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame(list(zip(ids, signed, strict=True)), "doc_id long, fingerprint long")
    want = dict(zip(ids, groups(values, ids), strict=True))
    for settings_ in ({}, {"together": 2}, {"cell": 8}):
        got = simhash.near_duplicates(df, "doc_id", **settings_).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert len(got) == len(ids)


def test_one_huge_group_in_small_cells(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    values = sorted({base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)})
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fingerprint long")
    assert {r[0] for r in simhash.near_duplicates(df, "doc_id", cell=64).select("component_id").collect()} == {0}


def test_messy_rows(messy, clashing):
    rows = simhash.simhash_groups(messy).collect()
    assert len(rows) == messy.count()
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    # Null, empty and blank texts, linked with each other; the smallest id names them.
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {2}
    assert [r["component_id"] for r in rows if r["doc_id"] == 1] == [1, 1]
    kept = simhash.first_of_each_group(clashing)
    assert kept.columns == clashing.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 5, None, 6, 7], key=str)


def test_empty_table(make_docs):
    assert simhash.simhash_groups(make_docs().limit(0)).collect() == []
    assert simhash.first_of_each_group(make_docs()).collect() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1_000, 1_300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(1_000, 1_300)}}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=30))
def test_forest(edges):
    label = list(range(15))
    for _ in range(15):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    a, b = (np.array(x, dtype=np.int64) for x in (zip(*edges, strict=True) if edges else ((), ())))
    assert forest(a, b, 15).tolist() == label
