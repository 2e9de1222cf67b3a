import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from feedpulse.llm import unigram
from feedpulse.llm.unigram import SPACE


def library(vocabulary):
    pieces = [("<unk>", 0.0), *vocabulary, *((f"<0x{i:02X}>", 0.0) for i in range(256))]
    return Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))


def number(tokenizer, text):
    return len(tokenizer.encode(SPACE + text.replace(" ", SPACE)).ids) if text else 0


@pytest.fixture(scope="module")
def real():
    vocabulary = unigram.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return unigram.Counter(tuple(vocabulary)), library(vocabulary)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="ab theringTH▁\n\té中😀', .012", max_size=60))
def test_like_the_library(real, text):
    counter, tokenizer = real
    assert counter.count(text)[0] == number(tokenizer, text)


# Scores with many ties, and pieces that go on beyond a space mark.
TIES = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), (SPACE, -1.0), (SPACE + "a", -2.0), ("bb", -1.0)]


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="ab xé", max_size=25), crossing=st.booleans())
def test_ties(text, crossing):
    vocabulary = [*TIES, ("b" + SPACE + "b", -2.0)] if crossing else TIES
    counter = unigram.Counter(tuple(vocabulary))
    assert (counter.cut is None) == crossing
    assert counter.count(text)[0] == number(library(vocabulary), text)


def test_tables(messy, clashing):
    vocabulary = tuple(TIES)
    rows = unigram.token_counts(clashing, TIES).collect()
    assert len(rows) == clashing.count()
    for r in rows:
        assert (r["n_tokens"], r["best_score"]) == unigram.Counter(vocabulary).count(r["text"] or "")
    assert unigram.token_counts(messy.limit(0), TIES).collect() == []
