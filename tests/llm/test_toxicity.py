import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedpulse.llm import toxicity as tox

WORDS = "river stone cloud table window garden letter music paper silver orange yellow".split()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


TERMS, STEMS = ["moron", "scum", "clowns"], ["lowei", "vequ"]


@settings(max_examples=400, deadline=None)
@given(
    st.sampled_from(TERMS + STEMS)
    .flatmap(lambda t: st.tuples(st.just(t), st.integers(0, len(t)), st.sampled_from(["", "x", "o"]), st.integers(0, 2)))
    .flatmap(lambda x: st.tuples(st.just(x[0][: x[1]] + x[2] + x[0][x[1] + x[3] :]), st.sampled_from(["", "a", "ing"])))
)
def test_matches_like_brute_force(parts):
    word = "".join(parts)
    hit = tox.Matcher(TERMS, STEMS).match(word)
    best = []
    for i, term in enumerate(TERMS):
        edits = distance(word, term)
        if edits == 0 or edits == 1 and len(term) >= tox.FUZZY_FROM:
            best.append((edits, i))
    for i, stem in enumerate(STEMS, len(TERMS)):
        edits = min(distance(word[:n], stem) for n in range(len(word) + 1))
        if edits == 0 or edits == 1 and len(stem) >= tox.FUZZY_FROM:
            best.append((edits, i))
    assert (hit[1] if hit else None) == (min(best)[0] if best else None)
    if hit:
        assert (hit[1], hit[0]) in best


def training(n=600, seed=5):
    """Texts of ordinary words; a tenth toxic, with terms in many contexts, half of them in copies."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(WORDS, k=60)
        bad = i % 10 == 3
        if bad:
            for term in rng.choices(["moron", "scumbag", *("lowei" + s for s in ("chen", "schaft", "ig", "um", "tum"))], k=4):
                words.insert(rng.randrange(len(words)), term)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rare = " ".join(["qwrt", "zxcv", *WORDS])
    for i in range(n, n + 40):  # copies of a toxic text prove nothing about its rare words
        docs.append((i, f"moron {rare} scumbag moron"))
        labels.append((i, 1, 1))
    return docs, labels


@pytest.fixture(scope="module")
def learned(spark, make_docs):
    docs, labels = training()
    frame = make_docs(*docs)
    return frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, labels


def test_learns_terms_and_stems(learned):
    frame, labels, _, _ = learned
    scorer = tox.learn(frame, labels)
    assert {"moron", "scumbag"} <= set(scorer.words)
    assert "lowei" in scorer.stems
    assert not {"qwrt", "zxcv"} & {*scorer.words, *scorer.stems}
    score = lambda text: float(scorer.score(__import__("numpy").array([scorer.features(text.encode())]))[0])
    assert score("you morron and you scumbagg of the river") >= 0.5  # misspelled
    assert score("the river and the table") < 0.5
    plain, quoted = "such a moron came", 'he said "moron" to us'
    assert scorer.features(quoted.encode())[1] > 0 == scorer.features(quoted.encode())[0]
    assert scorer.features(plain.encode())[0] > 0 == scorer.features(plain.encode())[1]


def test_held_out_accuracy(learned):
    frame, labels, _, label_rows = learned
    truth = {i: t for i, _, t in label_rows}
    rows = tox.toxicity(frame, labels).collect()
    assert len(rows) == len(label_rows)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_held_out_labels_are_not_used(spark, learned):
    frame, _, _, label_rows = learned
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in label_rows]
    other = spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")
    own = spark.createDataFrame(label_rows, "doc_id long, quality int, toxic int")
    a, b = tox.learn(frame, own), tox.learn(frame, other)
    assert (a.words, a.stems, a.weights) == (b.words, b.stems, b.weights) and (a.model == b.model).all()


def test_tables(spark, messy, clashing, learned):
    _, labels, _, _ = learned
    rows = tox.toxicity(messy, labels).collect()
    assert len(rows) == messy.count() and {r["predicted"] for r in rows} == {0}
    none = labels.limit(0)
    assert {r["predicted"] for r in tox.toxicity(messy, none).collect()} == {0}
    assert tox.toxicity(messy.limit(0), labels).collect() == []
    kept = tox.without_toxic(clashing, none)
    assert kept.columns == clashing.columns and kept.count() == clashing.count()
    nulls = spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    assert tox.toxicity(messy, nulls).count() == messy.count()


def test_a_match_weighs_less_in_a_long_text():
    scorer = tox.Scorer({"blargh": 5.0}, set(), np.zeros(tox.FEATURES + 1))
    short, long = (scorer.features(b"blargh " + b"calm " * n) for n in (20, 2000))
    assert short[:5] == long[:5] and short[5] > long[5] > 0
    quoted = scorer.features(b'"blargh" ' + b"calm " * 20)
    assert quoted[4] == quoted[5] == 0
    assert scorer.features(b"") == [0.0] * tox.FEATURES


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("he said 'you are a fool' and left", ["'you are a fool'"]),
        ("the dogs' bowl isn't 'here", []),
        ("it's 5\" wide and \"that is it\"", ['"that is it"']),
        ("« a b » c »d e« „f g“ “h i” ‚j‘", ["« a b »", "»d e«", "„f g“", "“h i”", "‚j‘"]),
        ('"a\n\nb" c "d\ne"', ['"d\ne"']),
        ('x "' + "word " * 200 + 'end" y', ['"' + "word " * 200 + 'end"']),
        ("l'homme 'qu'il' a", ["'qu'il'"]),
        ("", []),
    ],
)
def test_quotations(text, want):
    assert [text[a:b] for a, b in tox.quotations(text)] == want


def test_quotations_of_any_length_are_told_from_abuse():
    scorer = tox.Scorer({"nastyword": 3.0}, set(), np.zeros(tox.FEATURES + 1))
    filler = "and so on " * 60
    for opening, closing in (('"', '"'), ("'", "'"), ("“", "”"), ("«", "»")):
        for quoted in (f"{opening}you nastyword {filler}{closing}", f"{opening}you\nnastyword you{closing}"):
            features = scorer.features(f"Here they {quoted} it ends".encode())
            assert features[0] == 0 and features[1] > 0
    assert scorer.features(b'"and then \n\n you nastyword" she')[0] > 0


def test_terms_are_not_capped_and_shortened_all():
    found = {f"{a}{b}{c}word": (5, 1.0) for a in "abcdefghijklmnop" for b in "abcdefghijklmno" for c in "abcdefghijkl"}
    assert len(found) > 2_000 and tox.shortened(found) == {t: 1.0 for t in found}
    stems = {"nast*": (10, 1.0), "nasty*": (10, 2.0), "nastyword": (9, 3.0), "nastier": (2, 1.0), "calm*": (4, 1.0)}
    assert tox.shortened(stems) == {"calm*": 1.0, "nastyword": 3.0}


def test_one_row_for_each_labelled_id(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('text ', id % 7) AS text")
    docs = docs.unionByName(spark.range(5_000).selectExpr("1L AS doc_id", "concat('copy ', id) AS text"))
    labels = spark.range(40).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    rows = tox.labelled_sample(docs, labels, 20).collect()
    assert len(rows) == 20
    everything = tox.labelled_sample(docs, labels).collect()
    assert len(everything) == labels.where(~tox.held_out(tox.F.col("doc_id"))).count()
