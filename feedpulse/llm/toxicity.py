"""Toxicity scores from a learned lexicon that is matched with misspellings.

Learning reads labelled rows only: at most ``SAMPLE`` of them, the first by a
hash of their id. A term is a word, or the stem that a family of words starts
with. It enters the lexicon if it stands in several different contexts of toxic
texts and hardly in others; contexts, not texts, are counted, so that copies of
one text prove nothing. The lexicon becomes a trie. It is intersected with the
automaton of all strings within one edit; the product's states are built as
texts need them, and most words leave it after two or three letters.

Matches count by their context: within quotation marks, or soon after a word of
reporting, they are quotation, otherwise abuse. A logistic model over a few sums
of weights, the matches' number and their rate gives the score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedpulse.llm.arrow import added, as_bytes, clear_of, slices
from feedpulse.sources.scratch import stored

SAMPLE = 20_000
FOLDS = 5
#: A term's length from which one edit is let pass.
FUZZY_FROM = 5
STEMS = range(4, 9)
LEAST_CONTEXTS, LEAST_TEXTS, LEAST_RATIO = 4, 3, 10.0
#: Least G statistic of a term; among 100,000 terms, chance reaches it with about one in ten.
LEAST_G = 24.0
#: Toxic support of a term for each clean text that has it.
PURITY = 9
#: Words around a match that make up its window, and words before it searched for reporting.
WINDOW, BEFORE = 25, 4
#: Sums and counts that the model weighs, and words added to a text's length in a rate.
FEATURES, ADDED_WORDS = 6, 50
WORD = re.compile(r"\w+")
#: Words that introduce what somebody else said.
REPORTING = set(
    "said says wrote writes called quoted quote sagte schrieb nannte zitat dit écrit appelé citation"
    " dijo escribió llamó cita".split()
)
#: Quotation marks and what closes them. Straight ones and single ones also occur as other signs.
CLOSED_BY = {
    '"': '"', "'": "'", "“": "”", "„": "“”", "‟": "”", "«": "»", "»": "«", "‘": "’", "‚": "‘’", "‹": "›", "›": "‹",
}
AMBIGUOUS = set("\"'‘’")
MARK = re.compile("[\"'“”„‟«»‘’‚‹›]|\n[^\\S\n]*\n")
KNOWN_WORDS = 50_000


def words_of(text: bytes) -> list[str]:
    return WORD.findall(text.decode("utf-8", "replace").lower())


def quotations(text: str) -> list[tuple[int, int]]:
    """Where quotations stand, however long; one that is not closed ends at a blank line and does not count.

    A straight or single mark opens before a word and not after a letter, and closes
    not after a space and not before a letter, so apostrophes and inches are neither.
    """
    out: list[tuple[int, int]] = []
    closers, start = "", 0
    for found in MARK.finditer(text):
        at, mark = found.start(), found.group()
        if mark[0] == "\n":
            closers = ""
            continue
        before, after = text[at - 1 : at] if at else "", text[at + 1 : at + 2]
        sure = mark not in AMBIGUOUS
        if closers:
            if mark in closers and (sure or not (before.isspace() or after.isalnum())):
                out.append((start, at + 1))
                closers = ""
        elif mark in CLOSED_BY and (sure or not (before.isalnum() or not after or after.isspace())):
            closers, start = CLOSED_BY[mark], at
    return out


class Matcher:
    """The lexicon's trie intersected with Levenshtein automata of one edit."""

    def __init__(self, words: list[str], stems: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.word_at: dict[int, int] = {}
        self.stem_at: dict[int, int] = {}
        self.fuzzy: list[bool] = [False]
        self.terms = [*words, *stems]
        for number, term in enumerate(self.terms):
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.fuzzy.append(False)
                node = self.children[node][letter]
            (self.word_at if number < len(words) else self.stem_at)[node] = number
        # Edits are let pass only on the way to a term that is long enough.
        for term in self.terms:
            if len(term) >= FUZZY_FROM:
                node = 0
                self.fuzzy[0] = True
                for letter in term:
                    node = self.children[node][letter]
                    self.fuzzy[node] = True
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple[int, int] | None] = []
        self.stems: list[tuple[int, int] | None] = []
        self.start = self._state(self._closed({(0, 0)}))
        self.found: dict[str, tuple[int, int] | None] = {}

    def _closed(self, items: set[tuple[int, int]]) -> frozenset:
        """With the nodes reached by leaving out a letter of the term."""
        out = set(items)
        for node, edits in items:
            if not edits:
                out.update((child, 1) for child in self.children[node].values() if self.fuzzy[child])
        return frozenset(out)

    def _state(self, items: frozenset) -> int:
        if items not in self.numbers:
            self.numbers[items] = len(self.states)
            self.states.append(items)
            self.moves.append({})
            self.ends.append(self._accepted(items, self.word_at))
            self.stems.append(self._accepted(items, self.stem_at))
        return self.numbers[items]

    def _accepted(self, items: frozenset, at: dict[int, int]) -> tuple[int, int] | None:
        hits = [
            (edits, at[node]) for node, edits in items
            if node in at and (not edits or len(self.terms[at[node]]) >= FUZZY_FROM)
        ]
        return (lambda best: (best[1], best[0]))(min(hits)) if hits else None

    def _move(self, state: int, letter: str) -> int:
        items = set()
        for node, edits in self.states[state]:
            if letter in self.children[node]:
                items.add((self.children[node][letter], edits))
            if not edits and self.fuzzy[node]:
                items.add((node, 1))  # a letter too many
                items.update((c, 1) for x, c in self.children[node].items() if x != letter and self.fuzzy[c])
        self.moves[state][letter] = to = self._state(self._closed(items)) if items else -1
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """The term a word is or starts with, and the edits between; the fewest, then the first."""
        state, best = self.start, None
        for letter in word:
            to = self.moves[state].get(letter)
            state = self._move(state, letter) if to is None else to
            if state < 0:
                return best
            hit = self.stems[state]
            if hit and (best is None or hit[1] < best[1]):
                best = hit
        hit = self.ends[state]
        return hit if hit and (best is None or hit[1] <= best[1]) else best

    def of_words(self, words: list[str]) -> list[tuple[int, int] | None]:
        found, match, out = self.found, self.match, []
        if len(found) > KNOWN_WORDS:
            found.clear()
        for word in words:
            try:
                out.append(found[word])
            except KeyError:
                found[word] = hit = match(word)
                out.append(hit)
        return out


@lru_cache(maxsize=2)
def matcher(words: tuple[str, ...], stems: tuple[str, ...]) -> Matcher:
    return Matcher(list(words), list(stems))


# Learning


def held_out(doc_id: Column) -> Column:
    """A null id counts as an empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(raw, toxic): at most ``sample`` rows, one for each of as many labelled ids outside the held-out fold; stored.

    Of several texts of an id, the first by a hash counts.
    """
    chosen = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select("doc_id", as_bytes("text").alias("raw"))
    # Texts are shuffled only for ids that have several.
    rows = docs.select("doc_id").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
    ids = stored(rows.agg(F.count("*").alias("rows")), "labelled-ids")
    own = lambda which: texts.join(F.broadcast(ids.where(which).select("doc_id", "toxic")), "doc_id")
    first = F.min_by("raw", F.struct(F.xxhash64("raw"), F.col("raw"))).alias("raw")
    several = own("rows > 1").groupBy("doc_id", "toxic").agg(first).select("raw", "toxic")
    return stored(own("rows = 1").select("raw", "toxic").unionByName(several), "labelled")


def _terms(words: list[str]) -> Iterator[str]:
    """Words as they are, stems with a star."""
    for word in words:
        if len(word) > 2:
            yield word
        for size in STEMS:
            if len(word) <= size:
                break
            yield word[:size] + "*"


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, support, clean): different toxic texts, or contexts in them if fewer; clean texts."""

    def toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "raw", 1 << 17):
                rows = []
                for text in part.column("raw").to_pylist():
                    words = words_of(text)
                    whole = xxhash.xxh64_intdigest(text) >> 1
                    around = ["", *words, ""]
                    for i, word in enumerate(words):
                        context = xxhash.xxh64_intdigest(f"{around[i]} {around[i + 2]}") >> 1
                        rows += [(term, context, whole) for term in _terms([word])]
                rows = list(dict.fromkeys(rows))
                term, context, whole = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term, pa.string()), pa.array(context, pa.int64()), pa.array(whole, pa.int64())],
                    names=["term", "context", "whole"],
                )

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "raw"):
                counts: Counter[str] = Counter()
                for text in part.column("raw").to_pylist():
                    counts.update(set(_terms(list(set(words_of(text))))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                    names=["term", "n"],
                )

    raw = sample.where("toxic = 1").select("raw").mapInArrow(toxic, "term string, context long, whole long")
    contexts = raw.groupBy("term", "context").agg(F.min("whole").alias("whole")).groupBy("term")
    texts = raw.select("term", "whole").distinct().groupBy("term").agg(F.count("*").alias("texts"))
    counted = contexts.agg(F.count("*").alias("contexts")).where(F.col("contexts") >= LEAST_CONTEXTS)
    counted = counted.join(texts.where(F.col("texts") >= LEAST_TEXTS), "term")
    counted = counted.select("term", F.least("contexts", "texts").alias("support"))
    others = sample.where("toxic = 0").select("raw").mapInArrow(clean, "term string, n long")
    return counted.join(others.groupBy("term").agg(F.sum("n").alias("clean")), "term", "left").na.fill(0)


def shortened(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Words and stems without those that say the same as another one.

    ``found`` has support and weight. Of stems and words one of which starts the
    other, the shortest that counts decides; a longer one takes its place if it
    has nearly as much support, and all that are longer still go.
    """
    out: dict[str, float] = {}
    by_text = sorted(found, key=lambda t: (len(t.rstrip("*")), t))
    in_order = sorted(found, key=lambda t: (t.rstrip("*"), t))
    bare_in_order = [t.rstrip("*") for t in in_order]
    taken: set[str] = set()
    for term in by_text:
        bare = term.rstrip("*")
        if any(bare[:n] in taken for n in range(1, len(bare) + 1)):
            continue
        if not term.endswith("*"):
            out[term] = found[term][1]
            continue
        longer, at = [], bisect_left(bare_in_order, bare)
        while at < len(in_order) and bare_in_order[at].startswith(bare):
            if in_order[at] != term and found[in_order[at]][0] >= 0.9 * found[term][0]:
                longer.append(in_order[at])
            at += 1
        best = max(longer, key=lambda t: (len(t.rstrip("*")), not t.endswith("*")), default=term)
        out[best] = found[best][1]
        taken.add(bare)
    return out


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms (stems with a star) and their weights. The sample's bound is theirs too."""
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(1, 0) + 1, n.get(0, 0) + 1
    weight = F.log((F.col("support") + 0.5) / bad) - F.log((F.col("clean") + 0.5) / good)
    share, both = F.lit(bad / (bad + good)), F.col("support") + F.col("clean")
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    g = 2 * (part(F.col("support"), both * share) + part(F.col("clean"), both * (1 - share)))
    rows = (
        term_counts(sample)
        .withColumn("weight", weight)
        .where(g >= LEAST_G)
        .where(F.col("weight") >= math.log(LEAST_RATIO))
        .where(F.col("support") >= PURITY * F.col("clean"))
        .orderBy(F.desc("support"), "term")
        .collect()
    )
    return shortened({r["term"]: (r["support"], r["weight"]) for r in rows})


class Scorer:
    """What is learned; small, and sent to the executors as it is."""

    def __init__(self, lexicon: dict[str, float], harmless: set[str], model: np.ndarray) -> None:
        self.words = tuple(t for t in lexicon if not t.endswith("*"))
        self.stems = tuple(t[:-1] for t in lexicon if t.endswith("*"))
        self.weights = [*(lexicon[t] for t in self.words), *(lexicon[t + "*"] for t in self.stems)]
        self.harmless, self.model = harmless, model

    def hits(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(place, term, edits) of the words that match and are not known as harmless."""
        found = matcher(self.words, self.stems).of_words(words)
        return [
            (i, hit[0], hit[1]) for i, hit in enumerate(found) if hit and not (hit[1] and words[i] in self.harmless)
        ]

    def features(self, text: bytes) -> list[float]:
        """Sums of weights (of different terms as abuse, as quotation, the densest window, spelled wrongly), matches, rate.

        Chance matches grow in number with a text's length; the rate of matches as abuse tells them apart.
        """
        string = text.decode("utf-8", "replace").lower()
        words = WORD.findall(string)
        hits = self.hits(words)
        if not hits:
            return [0.0] * FEATURES
        places = [m.start() for m in WORD.finditer(string)]
        quotes = quotations(string)
        abuse, quotation, wrong = {}, {}, {}
        open_hits = []
        at = 0
        for i, term, edits in hits:
            while at < len(quotes) and quotes[at][1] <= places[i]:
                at += 1
            quoted = at < len(quotes) and quotes[at][0] <= places[i]
            quoted = quoted or any(w in REPORTING for w in words[max(0, i - BEFORE) : i])
            weight = self.weights[term] * (0.6 if edits else 1.0)
            side = quotation if quoted else abuse
            side[term] = max(side.get(term, 0.0), weight)
            if edits:
                wrong[term] = weight
            if not quoted:
                open_hits.append((i, weight))
        densest = start = 0
        total = 0.0
        for i, weight in open_hits:
            total += weight
            while open_hits[start][0] < i - WINDOW:
                total -= open_hits[start][1]
                start += 1
            densest = max(densest, total)
        rate = 1000 * len(open_hits) / (len(words) + ADDED_WORDS)
        sums = [sum(abuse.values()), sum(quotation.values()), densest, sum(wrong.values()), len(open_hits), rate]
        return [math.log1p(x) for x in sums]

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features @ self.model[:-1] + self.model[-1])))


def harmless_words(sample: DataFrame, scorer: Scorer) -> set[str]:
    """Words an edit away from a term that clean texts of the sample use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, toxic = [], []
            for text, label in zip(batch.column("raw").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                all_words = words_of(text)
                near = {all_words[i] for i, _, edits in scorer.hits(all_words) if edits}
                words += near
                toxic += [label] * len(near)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(toxic, pa.int64())], names=["word", "toxic"]
            )

    counts = sample.mapInArrow(run, "word string, toxic long").groupBy("word")
    counts = counts.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    return {r["word"] for r in counts.where("bad < 0.8 * n").select("word").collect()}


def fitted(features: np.ndarray, toxic: np.ndarray, steps: int = 50, ridge: float = 0.05) -> np.ndarray:
    """A logistic regression by Newton's method; weights and, last, the intercept."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Learn from the labelled documents outside the held-out fold; nothing but texts and labels is used.

    Without any toxic label all texts get a low score.
    """
    rows = labelled_sample(docs, labels, sample)
    lexicon = learn_lexicon(rows)
    flat = np.zeros(FEATURES + 1)
    flat[-1] = -3.0
    scorer = Scorer(lexicon, set(), flat)
    if not lexicon:
        return scorer
    scorer.harmless = harmless_words(rows, scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [scorer.features(t) for t in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.list_(pa.float64())), batch.column("toxic")], names=["features", "toxic"]
            )

    kept = rows.mapInArrow(run, "features array<double>, toxic int").collect()
    features = np.array([r["features"] for r in kept])
    scorer.model = fitted(features, np.array([r["toxic"] for r in kept], dtype=float))
    return scorer


# Scoring


def scored(docs: DataFrame, scorer: Scorer, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; empty and null texts have that of a text without matches."""
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def make(texts: list[bytes]) -> list[pa.Array]:
        features = np.array([sent.value.features(t) for t in texts]).reshape(len(texts), FEATURES)
        return [pa.array(sent.value.score(features))]

    return added(docs, text, f"`{name}` double", make)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Repeated rows get the same score, other columns are left out, an empty table
    gives an empty result. Texts count whole, however long; a worker holds one and its
    words. Of several labels of an id, toxic counts.
    """
    rows = scored(docs.select("doc_id", "text"), learn(docs, labels, sample))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with their columns as they were.

    Null and empty texts score alike, repeated rows stay or go together, an empty table stays empty.
    """
    name = clear_of(docs, "score")
    return scored(docs, learn(docs, labels, sample), name=name).where(f"`{name}` < 0.5").select(
        *[f"`{c}`" for c in docs.columns]
    )
