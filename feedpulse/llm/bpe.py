"""Byte-level BPE encoding and decoding.

Texts are cut without a regular expression. Every code point gets a class from
an array; with its neighbours it becomes a symbol of a small automaton. The
automaton's transition functions compose associatively, so its state at every
position comes from a blocked scan over function numbers, with whole numpy
arrays. A token of the pre-tokenisation starts where the automaton says so. The
slices are then merged by rank: known ones come from a cache, the rest of a
batch are merged together, step by step, in arrays.

Null texts count as empty, and an empty text has no ids. Bytes that aren't
UTF-8 are read as U+FFFD. Repeated rows are encoded each for itself. Columns
that clash with the new ones give way to them.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache, cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from feedpulse.llm.arrow import added, clear_of, ragged

# Classes of code points.
LETTER, NUMBER, SPACE, OTHER, END = range(5)
END_POINT = 0x110000
#: White space as Unicode's property White_Space has it.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
#: What an apostrophe may be followed by to be cut off with it.
SHORT_ENDINGS, LONG_ENDINGS = ["s", "t", "m", "d"], ["re", "ve", "ll"]

# Symbols. WHITE is followed by more white space or the end; LONE and JOINING are the
# last of their run, and JOINING is the plain space that the next token takes along.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_WHITE, S_LONE, S_JOINING, S_END = range(9)
# States: what the last character belongs to. FRESH: the next one starts a token.
FRESH, IN_WHITE, JOIN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_MORE, TWO_MORE = range(8)

INFINITE = np.int32(2**31 - 1)
BLOCK = 64
CACHED = 150_000
LONGEST_IN_ARRAYS = 48


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether the character starts a token."""
    if symbol == S_LETTER and state in (ONE_MORE, TWO_MORE):
        return (FRESH if state == ONE_MORE else ONE_MORE), False
    for mine, inside in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHERS)):
        if symbol == mine:
            return inside, state not in (JOIN, inside)
    if symbol in (S_SHORT, S_LONG):
        if state in (JOIN, IN_OTHERS):
            return IN_OTHERS, False
        return (ONE_MORE if symbol == S_SHORT else TWO_MORE), True
    if symbol == S_WHITE:
        return IN_WHITE, state != IN_WHITE
    return (JOIN if symbol == S_JOINING else FRESH), True


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that symbols compose to: their composition, their values; token starts.

    Functions are numbered; the first are those of the symbols.
    """
    states, symbols = range(8), range(9)
    functions = [tuple(step(s, a)[0] for s in states) for a in symbols]
    numbers = {}
    order = []
    for f in functions:
        if f not in numbers:
            numbers[f] = len(order)
            order.append(f)
    for f in order:
        for g in functions:
            both = tuple(g[s] for s in f)
            if both not in numbers:
                numbers[both] = len(order)
                order.append(both)
    compose = np.array([[numbers[tuple(g[s] for s in f)] for g in order] for f in order])
    of_symbol = np.array([numbers[f] for f in functions], dtype=np.int16)
    starts = np.array([[step(s, a)[1] for a in symbols] for s in states])
    return compose.astype(np.int16), np.array(order, dtype=np.int8), starts, of_symbol


def states_before(functions: np.ndarray, state: int = FRESH) -> np.ndarray:
    """The state before each position, by a blocked scan of composed functions."""
    compose, values, _, _ = automaton()
    n = len(functions)
    if n <= BLOCK:
        out = np.empty(n, dtype=np.int8)
        for i, f in enumerate(functions.tolist()):
            out[i] = state
            state = int(values[f, state])
        return out
    rows = -(-n // BLOCK)
    padded = np.zeros(rows * BLOCK, dtype=np.int16)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    prefix = np.empty_like(columns)
    prefix[0] = columns[0]
    for j in range(1, BLOCK):
        prefix[j] = compose[prefix[j - 1], columns[j]]
    entry = states_before(prefix[-1], state)
    after = values[prefix, entry[None, :]]
    before = np.empty((BLOCK, rows), dtype=np.int8)
    before[0] = entry
    before[1:] = after[:-1]
    return np.ascontiguousarray(before.T).reshape(-1)[:n]


@cache
def classes() -> np.ndarray:
    table = np.full(END_POINT + 1, OTHER, dtype=np.int8)
    for point in range(END_POINT):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LN":
            table[point] = LETTER if kind == "L" else NUMBER
    table[WHITE_SPACE] = SPACE
    table[END_POINT] = END
    return table


def token_starts(points: np.ndarray) -> np.ndarray:
    """Whether a token starts at each code point; texts end with ``END_POINT``."""
    kind = classes()[points]
    following = np.append(kind[1:], END).astype(np.int8)
    symbol = np.array([S_LETTER, S_NUMBER, S_WHITE, S_OTHER, S_END], dtype=np.int8)[kind]
    last_white = np.flatnonzero((kind == SPACE) & (following != SPACE) & (following != END))
    symbol[last_white] = np.where(points[last_white] == 0x20, S_JOINING, S_LONE)
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        beyond = np.concatenate([points, np.full(2, END_POINT, points.dtype)])
        one, two = beyond[quotes + 1], beyond[quotes + 2]
        symbol[quotes[np.isin(one, [ord(x) for x in SHORT_ENDINGS])]] = S_SHORT
        for ending in LONG_ENDINGS:
            symbol[quotes[(one == ord(ending[0])) & (two == ord(ending[1]))]] = S_LONG
    _, _, starts, of_symbol = automaton()
    return starts[states_before(of_symbol[symbol]), symbol]


class Vocabulary:
    """A vocabulary file's byte strings; a token's id is its rank."""

    def __init__(self, ranks_file: bytes) -> None:
        pairs = [line.split() for line in ranks_file.splitlines() if line]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = [b""] * (max(self.ids.values()) + 1)
        for token, rank in self.ids.items():
            tokens[rank] = token
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.text = [str(i) for i in range(len(tokens))]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text, of which there are ``counts`` ids."""
        lengths = self.length[ids]
        data = self.bytes[ragged(self.start[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


class Numbers(dict):
    """Numbers words in the order they come; only the first ``CACHED`` are kept beyond a batch."""

    def __init__(self) -> None:
        self.new: dict[bytes, int] = {}
        self.base = 0

    def __missing__(self, word: bytes) -> int:
        return self.new.setdefault(word, self.base + len(self.new))

    def settle(self) -> int:
        """Keep what may be kept of the batch's new words; how many that are."""
        kept = 0
        for word, number in self.new.items():
            if number >= CACHED:
                break
            self[word] = number
            kept += 1
        self.base += kept
        self.new = {}
        return kept


class Merger(Vocabulary):
    """Merges byte slices by rank."""

    def __init__(self, ranks_file: bytes) -> None:
        super().__init__(ranks_file)
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int32)
        self._fill_table()
        self.numbers = Numbers()
        self.known_ids = np.empty(0, dtype=np.int32)
        self.known_counts = np.empty(0, dtype=np.int64)

    def pairs(self) -> Iterator[tuple[int, int, int]]:
        """All pairs of ids that make up a token, with its id."""
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    yield left, right, rank

    @cached_property
    def pair(self) -> dict[int, int]:
        """The same by key, for the rare long words."""
        return {left << 32 | right: rank for left, right, rank in self.pairs()}

    def _fill_table(self) -> None:
        """An open-addressed table of all pairs that merge."""
        found = np.array(list(self.pairs()), dtype=np.int64)
        keys, ranks = found[:, 0] << 32 | found[:, 1], found[:, 2].astype(np.int32)
        self.bits = max(10, int(np.ceil(np.log2(3 * len(keys)))))
        self.table_keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.table_ranks = np.full(1 << self.bits, INFINITE, dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.table_keys[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.table_keys[slot[placed]] = keys[placed]
            self.table_ranks[slot[placed]] = ranks[placed]
            rest = np.ones(len(keys), dtype=bool)
            rest[placed] = False
            keys, ranks = keys[rest], ranks[rest]
            slot = (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair merges to, or ``INFINITE``."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(len(keys), INFINITE, dtype=np.int32)
        at, slot = np.arange(len(keys)), self._slot(keys)
        while len(at):
            there = self.table_keys[slot]
            hit = there == keys[at]
            out[at[hit]] = self.table_ranks[slot[hit]]
            more = ~hit & (there != -1)
            at, slot = at[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out

    def merge_all(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of every word; the leftmost pair of the lowest rank merges first."""
        out = [np.empty(0, dtype=np.int32)] * len(words)
        sizes = np.array([len(w) for w in words])
        low = 0
        for high in (6, 10, 16, 26, LONGEST_IN_ARRAYS):
            chosen = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in range(0, len(chosen), 20_000):
                self._merge_arrays(words, chosen[part : part + 20_000], high, out)
            low = high
        for i in np.flatnonzero(sizes > LONGEST_IN_ARRAYS).tolist():
            out[i] = self.merge_long(words[i])
        return out

    def _merge_arrays(self, words, chosen, width, out) -> None:
        rows = len(chosen)
        flat = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in chosen), dtype=np.uint8)
        tokens = self.single[flat].reshape(rows, width)
        count = np.array([len(words[i]) for i in chosen])
        ranks = np.full((rows, width), INFINITE, dtype=np.int32)
        real = np.arange(width - 1)[None, :] < count[:, None] - 1
        at = np.nonzero(real)
        ranks[at] = self.rank(tokens[at], tokens[at[0], at[1] + 1])
        where, column = np.arange(rows), np.arange(width)[None, :]
        while True:
            place = ranks.argmin(axis=1)
            best = ranks[np.arange(len(place)), place]
            going = best != INFINITE
            if not going.all():
                for r in np.flatnonzero(~going).tolist():
                    out[chosen[where[r]]] = tokens[r, : count[r]].copy()
                if not going.any():
                    return
                tokens, ranks, count = tokens[going], ranks[going], count[going]
                where, place, best = where[going], place[going], best[going]
            row = np.arange(len(place))
            tokens[row, place] = best
            after = np.minimum(column + (column > place[:, None]), width - 1)
            tokens = np.take_along_axis(tokens, after, axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(column + (column >= place[:, None]), width - 1), axis=1)
            count -= 1
            ranks[row, place] = INFINITE
            for shift in (0, -1):
                p = place + shift
                ok = np.flatnonzero((p >= 0) & (p < count - 1))
                ranks[row[ok], p[ok]] = self.rank(tokens[row[ok], p[ok]], tokens[row[ok], p[ok] + 1])

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same for one long word, with a heap."""
        ids = self.single[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (rank := self.pair.get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], j, ids[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            rank, i, left, j, right = heapq.heappop(heap)
            if ids[i] != left or after[i] != j or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([x for x in ids if x >= 0], dtype=np.int32)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, how many of them each text has, and the byte at which each id starts."""
        if not texts:
            none = np.empty(0, dtype=np.int64)
            return none, none, none
        strings = [t.decode("utf-8", "replace") for t in texts]
        points = np.frombuffer("\0".join([*strings, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
        ends = np.cumsum([len(s) + 1 for s in strings]) - 1
        points[ends] = END_POINT
        starts = np.flatnonzero(token_starts(points))
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        width[ends] = 0
        offset = np.concatenate([[0], np.cumsum(width)])
        buffer = "".join(strings).encode("utf-8", "surrogatepass")
        cuts = np.append(offset[starts], len(buffer))
        pieces = (buffer[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        number = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(starts))
        # A text's end makes an empty piece.
        merged = self.merge_all(list(self.numbers.new))
        of_new = np.array([len(m) for m in merged], dtype=np.int64)
        kept = self.numbers.settle()
        known_counts = np.concatenate([self.known_counts, of_new])
        known_ids = np.concatenate([self.known_ids, *merged])
        self.known_counts = known_counts[: len(self.known_counts) + kept]
        self.known_ids = known_ids[: int(self.known_counts.sum())]
        per_piece = known_counts[number]
        ids = known_ids[ragged((np.cumsum(known_counts) - known_counts)[number], per_piece)]
        text_of = np.searchsorted(ends, starts)
        counts = np.bincount(text_of, weights=per_piece, minlength=len(texts)).astype(np.int64)
        lengths = self.length[ids]
        text_base = np.repeat(np.concatenate([[0], offset[ends]])[:-1], counts)
        return ids, counts, np.cumsum(lengths) - lengths - text_base


@lru_cache(maxsize=2)
def merger(ranks_file: bytes) -> Merger:
    """One per worker and vocabulary, so that its cache serves all tasks."""
    return Merger(ranks_file)


@lru_cache(maxsize=2)
def vocabulary(ranks_file: bytes) -> Vocabulary:
    return Vocabulary(ranks_file)


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _from_texts(docs: DataFrame, ranks_path: str, text: str, new: str, make) -> DataFrame:
    """``docs`` with columns that ``make`` gets from a merger's output for about a megabyte of texts.

    The vocabulary file, of bounded size, goes to the executors as a broadcast.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def arrays(texts: list[bytes]) -> list[pa.Array]:
        tool = merger(ranks.value)
        return make(tool, *tool.encode(texts))

    return added(docs, text, new, arrays)


def encode(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and ``token_starts``, the byte of the text each id starts at.

    Null and empty texts have no ids. Repeated rows come back row by row, an empty table empty.
    """
    return _from_texts(
        docs,
        ranks_path,
        text,
        "n_tokens long, ids array<int>, token_starts array<int>",
        lambda _, ids, counts, starts: [pa.array(counts), _lists(ids, counts), _lists(starts, counts)],
    )


def digests(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and the SHA-256 of the ids and of the bytes they decode to.

    In one pass, so that the ids need not leave the worker. Null texts count as empty, repeated rows come
    back row by row, an empty table empty.
    """

    def make(tool: Merger, ids: np.ndarray, counts: np.ndarray, _: np.ndarray) -> list[pa.Array]:
        decimals = [tool.text[i] for i in ids.tolist()]
        ends = np.concatenate([[0], np.cumsum(counts)]).tolist()
        spans = zip(ends[:-1], ends[1:], strict=True)
        of_ids = [hashlib.sha256(" ".join(decimals[a:b]).encode()).hexdigest() for a, b in spans]
        of_bytes = [hashlib.sha256(x).hexdigest() for x in tool.decode(ids, counts)]
        return [pa.array(counts), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]

    new = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _from_texts(docs, ranks_path, text, new, make)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids``; null ids count as none."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = [c for c in encoded.columns if c.lower() != "decoded"]
    own = clear_of(encoded, "own_ids")
    source = encoded.select(
        *[F.col(f"`{c}`") for c in kept], F.coalesce("ids", F.array().cast("array<int>")).alias(own)
    )
    schema = StructType([*source.schema.fields[:-1], StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = part.column(own)
                texts = words.decode(ids.flatten().to_numpy(), np.diff(ids.offsets.to_numpy()))
                arrays = [*part.columns[:-1], pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return source.mapInArrow(run, schema)
