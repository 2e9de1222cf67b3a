"""Grouping spelling variants with a dictionary of trie-node pairs.

The words are a trie forwards and a trie backwards; every node has a number. A
word and a place in it give an integer pair: the node of what comes before and the
node of what comes after. Two words that share the pair around a skipped character differ
in that character only; a word that has, without skipping, the pair another has
around a skipped character lacks just that character. So equal pairs are exact
neighbours, with nothing left to verify, and at most one word for each letter of
the alphabet shares a pair, however many words there are.

Nodes are numbered in runs of the sorted words. A word's nodes are those of the word
before as far as the two agree; only the nodes that lie across the cut between two
runs need to be known beforehand, and they follow from the runs' first and last words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedpulse.llm.arrow import as_bytes, slices
from feedpulse.sources.scratch import stored

SHORTEST, LEAST, FACTOR, DROP = 7, 2, 10, 31
RUN, KEPT, PLACE = 20_000, 200_000, 40


# Words


def spelled(doc_id: bytes, run: str, drop: int = DROP) -> str:
    """``run`` as the document spells it: where ``drop`` divides its checksum, a character short."""
    h = zlib.crc32(doc_id + b":" + run.encode())
    if h % drop:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, drop: int = DROP) -> DataFrame:
    """(word, n): the words of whole texts with at least ``shortest`` letters that occur ``least`` times.

    Runs of Latin letters, A-Z lower-cased, as ``spelled``. Repeated rows count each; a null
    text has no words, a null doc_id is the empty string in the checksum. Other columns
    are not looked at. Occurrences are added up in each task before they are shuffled.
    """
    runs = re.compile("[A-Za-z\\u00c0-\\u00ff]{%d,}" % shortest).findall  # shorter runs give no word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
            )
            seen.clear()
            return out

        for batch in batches:
            for part in slices(batch, "raw_text"):
                for doc, text in zip(part.column("doc").to_pylist(), part.column("raw_text"), strict=True):
                    found = Counter(runs(text.as_py().lower().decode("utf-8", "replace")))
                    for word, n in found.items():
                        own = spelled(doc, word, drop)
                        if len(own) >= shortest:
                            seen[own] += n
                if len(seen) >= KEPT:
                    yield counted()
        yield counted()

    raw = docs.select(as_bytes(F.col("doc_id").cast("string").cast("binary")).alias("doc"), as_bytes("text").alias("raw_text"))
    found = raw.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# Trie nodes


def agreed(a: str, b: str) -> int:
    """How many first characters two words have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def crossing(bounds: list[tuple[int, str, str]]) -> dict[int, tuple[list[int], list[int]]]:
    """For each run: the numbers of its first word's nodes shared with the run before, and its last word's with the run after.

    ``bounds`` has (run, first word, last word) in order. A node across several cuts is named by the first one.
    """
    out, before = {}, []
    for i, (run, first, last) in enumerate(bounds):
        shared = agreed(last, bounds[i + 1][1]) + 1 if i + 1 < len(bounds) else 0
        # Odd numbers, by cut and depth; those that already cross the cut before keep their number.
        kept = min(len(before), agreed(first, last) + 1, shared)
        after = before[:kept] + [(i << PLACE | depth) << 1 | 1 for depth in range(kept, shared)]
        out[run] = before, after
        before = after
    return out


def trie_nodes(sorted_words: list[str], run: int, before: list[int], after: list[int]) -> Iterator[list[int]]:
    """The node numbers of each word's beginnings, from the empty one to the word itself."""
    nodes, previous, made, last = list(before), None, 0, sorted_words[-1]
    for word in sorted_words:
        same = len(nodes) - 1 if previous is None else agreed(previous, word)
        del nodes[same + 1 :]
        to_come = agreed(word, last) + 1 if len(after) > len(nodes) else 0
        for depth in range(len(nodes), len(word) + 1):
            if depth < min(to_come, len(after)):
                nodes.append(after[depth])
            else:
                nodes.append((run << PLACE | made) << 1)
                made += 1
        yield list(nodes)
        previous = word


def numbered(known: DataFrame, key: Column, n_words: int, name: str) -> DataFrame:
    """(word, n, id, nodes): the trie nodes of the words as ``key`` spells them.

    ``known`` is a stored table. ``id`` rises with ``key``. The driver gets the first and
    last word of each run of about ``RUN`` words.
    """
    ordered = known.select("word", "n", key.alias("key")).repartitionByRange(n_words // RUN + 1, "key")
    ordered = stored(ordered.withColumn("run", F.spark_partition_id().cast("long")), name)
    ends = ordered.groupBy("run").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("run")
    sent = known.sparkSession.sparkContext.broadcast(crossing([tuple(r) for r in ends.collect()]))

    def number(group: pa.Table) -> pa.Table:
        group = group.sort_by("key")
        run = group.column("run")[0].as_py()
        nodes = pa.array(trie_nodes(group.column("key").to_pylist(), run, *sent.value[run]), pa.list_(pa.int64()))
        ids = pa.array((run << PLACE) + np.arange(group.num_rows))
        return pa.table({"word": group.column("word"), "n": group.column("n"), "id": ids, "nodes": nodes})

    return ordered.groupBy("run").applyInArrow(number, "word string, n long, id long, nodes array<long>")


# Neighbours


def neighbours(tries: DataFrame) -> DataFrame:
    """(id, n_near, near_n, near_id): how many words are near each that has any, and the most frequent, first one.

    ``tries`` has id, n, and the nodes ``front`` and ``back`` of both tries.
    """
    length = F.size("front") - 1
    front = lambda i: F.get("front", i)
    back = lambda characters: F.get("back", characters)

    def pair(i: Column, after: Column, skips: Column, lacks: Column) -> Column:
        return F.struct(front(i).alias("p"), back(after).alias("s"), skips.alias("skips"), lacks.alias("lacks"))

    no = F.lit(False)
    # Skipping either of two equal letters gives one word; only the first counts as a deletion. The letters
    # at i - 1 and i are equal if and only if skipping them leaves the same word, which the word tells.
    repeated = lambda i: (i > 0) & (F.substr("word", i, F.lit(1)) == F.substr("word", i + 1, F.lit(1)))
    skipping = F.transform(
        F.sequence(F.lit(0), length - 1), lambda i: pair(i, length - 1 - i, F.lit(True), ~F.coalesce(repeated(i), no))
    )
    whole = F.transform(F.sequence(F.lit(0), length), lambda i: pair(i, length - i, no, no))
    pairs = tries.select("id", "n", F.inline(F.concat(skipping, whole)))

    member = F.struct((-F.col("n")).alias("least"), "id", "skips", "lacks")
    groups = pairs.groupBy("p", "s").agg(F.sort_array(F.collect_list(member)).alias("all")).where(F.size("all") > 1)
    # Every word with the pair skipped is near the others; the one that has it whole is near those that lack a letter.
    near = lambda of, other: (
        (of["id"] != other["id"])
        & F.when(of["skips"] & other["skips"], F.lit(True)).otherwise(of["lacks"] | other["lacks"])
    )
    each = groups.select(
        F.explode(
            F.transform(
                "all",
                lambda of: F.struct(of["id"].alias("id"), F.filter("all", lambda other: near(of, other)).alias("others")),
            )
        ).alias("x")
    ).select(
        F.col("x.id").alias("id"),
        F.size("x.others").alias("c"),
        F.get("x.others", F.lit(0)).alias("top"),
    )
    first = F.min(F.struct(F.col("top.least").alias("least"), F.col("top.id").alias("id"))).alias("first")
    found = each.where("c > 0").groupBy("id").agg(F.sum("c").alias("n_near"), first)
    return found.select("id", "n_near", (-F.col("first.least")).alias("near_n"), F.col("first.id").alias("near_id"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for every word with a form, by jumping; a form is ``FACTOR`` times as frequent, so chains are short."""
    current = stored(forms.select("id", F.col("form_id").alias("root")), "roots")
    while True:
        step = current.select(F.col("id").alias("root"), F.col("root").alias("further"))
        moved = current.join(step, "root", "left").select(
            "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        current = stored(moved, "roots")
        if current.where("moved").isEmpty():
            return current.select("id", "root")
        current = current.select("id", "root")


def variants(
    docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, factor: int = FACTOR, drop: int = DROP
) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of ``docs``.

    A word's form is the most frequent of the words one insertion, deletion or
    replacement away (of equally frequent ones the first in code-point order), if it is ``factor``
    times as frequent; its root is where the forms end. Words without near words have
    n_near 0, no form, and themselves as root. No documents, no rows.
    """
    known = stored(words(docs, shortest, least, drop), "words")
    n_words = known.count()
    front = numbered(known, F.col("word"), n_words, "forwards")
    back = numbered(known, F.reverse("word"), n_words, "backwards")
    tries = stored(
        front.withColumnRenamed("nodes", "front").join(back.select("word", F.col("nodes").alias("back")), "word"),
        "tries",
    )
    near = neighbours(tries)
    judged = stored(tries.select("id", "word", "n").join(near, "id", "left"), "near")
    has_form = F.col("near_n") >= factor * F.col("n")
    forms = judged.where(has_form).select("id", F.col("near_id").alias("form_id"), F.col("near_n").alias("form_n"))
    spelling = lambda of, name: judged.select(F.col("id").alias(of), F.col("word").alias(name))
    named = (
        forms.join(roots(forms), "id")
        .join(spelling("form_id", "form"), "form_id")
        .join(spelling("root", "root_word"), "root")
        .select("id", "form", "form_n", F.col("root_word").alias("root"))
    )
    return judged.join(named, "id", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
