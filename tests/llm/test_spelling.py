import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedpulse.llm import queries, spelling
from tests.conftest import SMALL

UPPER = {i: i + 32 for i in range(65, 91)}


def plain_words(rows, shortest=7, least=2, drop=31):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= least}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words, factor=10):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and v != w and one_apart(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-words[v], v))
            if words[best] >= factor * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def by_deletion(words):
    """Candidates by their deletions, for many words; still checked one by one."""
    at = {}
    for w in words:
        for i in range(len(w)):
            at.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    return at


def test_query(spark):
    """The query on the whole table; near words found by an independent way."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    words = plain_words([(r.doc_id, r.text) for r in docs.collect()])
    at = by_deletion(words)
    got = queries.op11_spelling_variants(spark, SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = set()
    near = {w: set() for w in words}
    for (_, short), group in at.items():
        for w in group:
            near[w].update(v for v in group if v != w)
            if short in words:
                near[w].add(short)
                near[short].add(w)
    assert all(one_apart(w, v) for w in near for v in near[w])
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-words[v], v))
            if words[best] >= 10 * words[w]:
                form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        want.add((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    assert found(got) == want
    assert len(form) > 50


@pytest.mark.parametrize("run", [1, 2, 7, 20_000])
def test_few_letters(spark, monkeypatch, run):
    """Words of two letters: repeated letters, many near words, every kind of cut between runs."""
    monkeypatch.setattr(spelling, "RUN", run)
    rng = np.random.default_rng(run)
    vocabulary = ["".join(rng.choice(list("ab"), rng.integers(2, 6))) for _ in range(60)]
    texts = [(i, " ".join(rng.choice(vocabulary, 40, p=rng.dirichlet(np.full(60, 0.2))))) for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = spelling.variants(docs, shortest=2, least=1, factor=3, drop=13)
    words = plain_words(texts, 2, 1, 13)
    assert found(got) == plain_variants(words, 3)


@pytest.mark.parametrize("run", [1, 3])
def test_node_numbers(spark, monkeypatch, run):
    """Two beginnings have one number if and only if they are equal."""
    monkeypatch.setattr(spelling, "RUN", run)
    words = ["a", "ab", "abc", "abcd", "abd", "b", "ba", "bab", "babab", "é", "éa", "zz", "zzz" * 50]
    known = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    for key in (F.col("word"), F.reverse("word")):
        rows = spelling.numbered(known, key, len(words), "t").collect()
        backwards, number = "reverse" in str(key), {}
        for r in rows:
            w = r.word[::-1] if backwards else r.word
            assert len(r.nodes) == len(w) + 1
            for i, node in enumerate(r.nodes):
                assert number.setdefault(w[:i], node) == node
        assert len(set(number.values())) == len(number)
        order = sorted(rows, key=lambda r: r.id)
        keys = [r.word[::-1] if backwards else r.word for r in order]
        assert keys == sorted(keys)


def test_chains_ties_and_factors(spark):
    counts = {"colours": 1000, "colour": 1, "colourx": 10, "colouxx": 1, "abcdefgh": 20, "abcdefgi": 20, "abcdefgx": 2}
    text = " ".join(f"{w} " * n for w, n in counts.items())
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r.word: r for r in spelling.variants(docs, shortest=6, least=1, drop=1 << 40).collect()}
    assert (got["colouxx"].form, got["colouxx"].root) == ("colourx", "colours")
    assert got["colour"].form == "colours" and got["colour"].n_near == 2
    assert got["abcdefgx"].form == "abcdefgh" and got["abcdefgh"].form is None
    assert got["colours"].root == "colours" and got["colours"].n_near == 2


def test_messy_tables(messy, clashing, spark):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert plain_words(rows, 3)
    got = found(spelling.variants(messy, shortest=3))
    assert got == plain_variants(plain_words(rows, 3))
    assert found(spelling.variants(clashing, shortest=3)) == got
    assert spelling.variants(messy.limit(0)).collect() == []
    assert spelling.variants(messy).collect() == []  # no word of seven letters


def test_a_very_long_word(spark):
    long = "ab" * 3_000
    docs = spark.createDataFrame([(1, f"{long} {long}x {long} {long} {long[1:]}")], "doc_id long, text string")
    got = found(spelling.variants(docs, least=1, factor=3, drop=1 << 40))
    assert got == {(long, None, long, 3, 2, None), (long + "x", long, long, 1, 1, 3), (long[1:], long, long, 1, 1, 3)}


def test_letters(spark):
    docs = spark.createDataFrame([(1, "ÀÉÎabcd×÷ ÀÉÎABCD àéîabcd ÿÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿÿ")], "doc_id long, text string")
    words = {r.word: r.n for r in spelling.words(docs, least=1, drop=1 << 40).collect()}
    assert words == {"ÀÉÎabcd×÷": 1, "ÀÉÎabcd": 1, "àéîabcd": 1, "ÿÿÿÿÿÿÿÿ": 2}
