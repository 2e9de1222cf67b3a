"""Near-duplicates by SimHash, found with the anchor points of a covering code.

A fingerprint's 64 bits fall into three blocks of 21, 21 and 22 bits, each read
as a word of the binary Golay code's space of 23 bits (missing bits are 0). The
code is perfect: every word has one codeword, its anchor, within 3 bits. Of two
fingerprints that differ in at most 4 bits, some block differs in at most 1, so
there the one lies within 3 + 1 bits of the other's anchor. Each fingerprint is
therefore sent to its own anchor as resident, and as visitor to all codewords
within 4 bits, 5.3 on average; each anchor compares its residents with its
visitors on all 64 bits. With ``together=2``, anchors are made of two blocks:
more copies and far fewer comparisons, for very large tables.

Equal fingerprints are one node, so exact copies cost nothing more. Anchors with
many residents or visitors are dealt in cells of bounded size, and a cell hands
on a spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedpulse.llm.arrow import added, clear_of
from feedpulse.llm.cells import cells
from feedpulse.llm.components import components, forest
from feedpulse.sources.scratch import stored

SEED = 42
AT_ONCE = 65_536
#: The Golay code's length, covering radius and generator polynomial.
LENGTH, RADIUS, GENERATOR = 23, 3, 0b110001110101
CELL = 4_096


# Fingerprints


@cache
def _spread() -> np.ndarray:
    """For each byte, its 8 bits in 8 bytes."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.uint64).reshape(-1)


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The SimHash of a text's word shingles; 0 without words. Words are cut at ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words))
    starts, ends = starts[: len(words) - span + 1], ends[span - 1 :]
    counts, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), AT_ONCE):
        part = zip(starts[at : at + AT_ONCE].tolist(), ends[at : at + AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in part], dtype="<u8")
        lanes = _spread()[hashes.view(np.uint8).reshape(-1, 8)]
        # At most 255 rows are added up in a byte.
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts += np.ascontiguousarray(sums).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of every whole text as a signed long; null counts as empty."""

    def make(texts: list[bytes]) -> list[pa.Array]:
        values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return [pa.array(values.view(np.int64))]

    return added(docs, text, f"`{name}` long", make)


# Anchors


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, LENGTH - 13, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@cache
def _syndromes() -> np.ndarray:
    """The remainder of each byte at each of the three byte places of a word."""
    single = [_remainder(1 << b) if b < LENGTH else 0 for b in range(24)]
    table = np.zeros((3, 256), dtype=np.int64)
    for place in range(3):
        for bit in range(8):
            table[place, (np.arange(256) >> bit & 1) == 1] ^= single[8 * place + bit]
    return table


def syndrome(words: np.ndarray) -> np.ndarray:
    t = _syndromes()
    return t[0, words & 255] ^ t[1, words >> 8 & 255] ^ t[2, words >> 16]


@cache
def error_patterns(weight: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Patterns of up to ``weight`` bits by syndrome, lightest first: where they start, how many, they, their weights."""
    found = [
        (sum(1 << b for b in bits), w) for w in range(weight + 1) for bits in combinations(range(LENGTH), w)
    ]
    patterns, weights = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
    of = syndrome(patterns)
    order = np.lexsort((patterns, weights, of))
    count = np.bincount(of, minlength=2048)
    return np.cumsum(count) - count, count, patterns[order], weights[order]


def block_words(values: np.ndarray, blocks: int) -> list[np.ndarray]:
    """The fingerprints' bits in ``blocks`` nearly equal runs."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    v = values.view(np.uint64)
    return [
        (v >> np.uint64(a) & np.uint64((1 << (b - a)) - 1)).astype(np.int64)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]


def anchors(values: np.ndarray, distance: int, blocks: int, together: int):
    """(row, anchor, resident) for every anchor that a fingerprint is sent to."""
    words, slack = block_words(values, blocks), distance * together // blocks
    start, count, pattern, weight = error_patterns(RADIUS + slack)
    out = []
    for number, combination in enumerate(combinations(range(blocks), together)):
        row, anchor = np.arange(len(values)), np.full(len(values), number, dtype=np.int64)
        used, home = np.zeros(len(values), dtype=np.int64), np.ones(len(values), dtype=bool)
        for block in combination:
            word = words[block][row]
            s = syndrome(word)
            n = count[s]
            again = np.repeat(np.arange(len(row)), n)
            ends = np.cumsum(n)
            place = np.arange(len(again)) - np.repeat(ends - n, n) + np.repeat(start[s], n)
            spent = used[again] + np.maximum(weight[place] - RADIUS, 0)
            ok = spent <= slack
            again, place = again[ok], place[ok]
            used, row = spent[ok], row[again]
            home = home[again] & (weight[place] <= RADIUS)
            anchor = anchor[again] << LENGTH | (word[again] ^ pattern[place])
        out.append((row, anchor, home))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def visits(nodes: DataFrame, distance: int, blocks: int, together: int) -> DataFrame:
    """(anchor, resident, node): ``nodes`` has the distinct fingerprints as ``node``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            row, anchor, home = anchors(values, distance, blocks, together)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(home), pa.array(values[row])], names=["anchor", "resident", "node"]
            )

    return nodes.select("node").mapInArrow(run, "anchor long, resident boolean, node long")


def cell_links(resident: np.ndarray, visitor: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a cell's links."""
    nodes, at = np.unique(np.concatenate([resident, visitor]), return_inverse=True)
    resident, visitor = resident.view(np.uint64), visitor.view(np.uint64)
    a, b = at[: len(resident)], at[len(resident) :]
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    rows = max(1, (1 << 20) // max(1, len(visitor)))
    for i in range(0, len(resident), rows):
        near = np.bitwise_count(resident[i : i + rows, None] ^ visitor[None, :]) <= distance
        x, y = np.nonzero(near)
        keep = a[i + x] != b[y]
        left.append(a[i + x][keep])
        right.append(b[y][keep])
    label = forest(np.concatenate(left), np.concatenate(right), len(nodes))
    hung = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[hung], nodes[label[hung]]


def links(nodes: DataFrame, distance: int, blocks: int, together: int, cell: int) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints linked by chains of close pairs."""

    def compare(table: pa.Table) -> pa.Table:
        home = table.column("resident").to_numpy()
        node = table.column("node").to_numpy()
        a, b = cell_links(node[home], node[~home], distance)
        return pa.table({"a": a, "b": b})

    found = cells(visits(nodes, distance, blocks, together), ["anchor"], "node", cell)
    return found.groupBy("anchor", "r", "v").applyInArrow(compare, "a long, b long")


# Groups


def near_duplicates(
    fingerprinted: DataFrame,
    key: str,
    distance: int = 4,
    blocks: int = 3,
    together: int = 1,
    cell: int = CELL,
    name: str = "fingerprint",
    into: str = "component_id",
) -> DataFrame:
    """``fingerprinted`` with ``into``, the smallest key that its row is linked with over any chain.

    ``fingerprinted`` should be a stored table: it is read several times. Rows
    whose key is null are linked like others but name no component; a component
    without any key has a null id.
    """
    fp = F.col(f"`{name}`")
    nodes = stored(fingerprinted.groupBy(fp.alias("node")).agg(F.min(f"`{key}`").alias("least")), "nodes")
    roots = components(links(nodes, distance, blocks, together, cell))
    rooted = nodes.join(roots, "node", "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("of_root"))
    named = rooted.join(least, "root").select("node", "of_root")
    node, of_root = clear_of(fingerprinted, "node"), clear_of(fingerprinted, "of_root")
    named = named.select(F.col("node").alias(node), F.col("of_root").alias(of_root))
    kept = [c for c in fingerprinted.columns if c.lower() != into.lower()]
    joined = fingerprinted.join(named, fp == F.col(f"`{node}`"))
    return joined.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{of_root}`").alias(into))


def hex_digits(value: str):
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def simhash_groups(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    Empty and null texts have fingerprint zero and are linked with each other.
    Repeated rows and repeated ids come back row by row; an empty table gives an
    empty result; other columns are left out.
    """
    marked = stored(fingerprints(docs.select("doc_id", "text"), shingle).drop("text"), "fingerprints")
    return near_duplicates(marked, "doc_id", distance).select(
        "doc_id", hex_digits("fingerprint").alias("fingerprint"), "component_id"
    )


def first_of_each_group(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The row of each group of near-duplicates that has the smallest doc_id, the first one of several.

    The rows are numbered in a stored copy, so that repeated ids and null ids
    (last) leave one row too.
    """
    number, fp, group = (clear_of(docs, x) for x in ("row_number", "fingerprint", "group"))
    marked = fingerprints(docs.withColumn(number, F.monotonically_increasing_id()), shingle, name=fp)
    whole = stored(marked, "fingerprinted")
    grouped = near_duplicates(whole.select("doc_id", number, fp), number, distance, name=fp, into=group)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(number).alias("n")))
    kept = grouped.groupBy(group).agg(first.alias("first")).select(F.col("first.n").alias(number))
    return whole.join(kept, number, "left_semi").select(*[f"`{c}`" for c in docs.columns])
