"""Packing documents into sequences of fixed length with few of them left unfilled.

Documents are tokenised; longer ones are cut into full pieces and a first, shorter
one. What remains is a cutting-stock problem on the histogram of lengths, which has
no more classes than a sequence has tokens, however many documents there are:

- The configuration linear program (how often to use each way of filling a
  sequence) is solved by multiplicative weights: a length that is covered more than
  others gets cheaper. Pricing is an unbounded knapsack by dynamic programming,
  which yields the best filling around every length at once; all those near the
  best are used in a phase. The prices also bound the optimum from below.
- Usage is rounded by its cumulated sum, within the counts. What is left over is
  filled largest length first, the gap as full as a subset of the lengths allows.

Which piece goes where is arithmetic: the pieces of a length are numbered, and a
filling takes a run of the numbers. No group of pieces meets in a task.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedpulse.llm.arrow import as_bytes, clear_of, slices
from feedpulse.sources.scratch import stored

CAPACITY, END_ID = 1024, 2
#: Fixed value: the public pattern by which byte-level tokenizers cut a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT, LONGEST_KEPT = 400_000, 64
SAFE = re.compile(r"(?<=\S)(?= \S)").split
#: The linear program: phases at most, the cover a phase adds at most, how prices fall with it, and
#: the fillings that count as dear; shares of its usage that are tried in rounding.
PHASES, STEP, RATE, NEAR, SHARES = 2_000, 0.1, 3.0, 0.01, (1.0, 0.9, 0.7, 0.5, 0.3)


# Tokens


class Odd(Exception):
    """White space beside white space."""


class Kept(dict):
    """Values by text, computed when missing; of two generations, the older one goes. Long texts are not kept."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make, self.older = make, {}

    def __missing__(self, text: str) -> bytes:
        value = self.older.get(text)
        if value is None:
            value = self.make(text)
        if len(text) <= LONGEST_KEPT:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[text] = value
        return value


class Encoder:
    """Ids of texts by the ``tokenizers`` library, which sees each different word once.

    A byte-level tokenizer starts a word at a space or line feed between two other
    characters, and a line feed there is a word. A text without runs of white space can
    therefore be cut at all of them, any text at a space between other characters.
    """

    def __init__(self, path: str) -> None:
        import regex  # noqa: PLC0415
        from tokenizers import Tokenizer  # noqa: PLC0415

        self.tool = Tokenizer.from_file(path)
        self.merge = self.tool.model.tokenize
        self.words = regex.compile(PATTERN).findall
        # The library writes a visible Latin-1 byte as its character, the others as 256 and on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in seen]
        self.table = {b: b for b in seen} | {b: 256 + n for n, b in enumerate(rest)}
        self.space = chr(self.table[ord(" ")])
        self.word = Kept(self.merged)
        self.first, self.later = Kept(self.chunk), Kept(lambda text: self.chunk(text, " "))
        # The tokenizer takes these strings out before it looks for words.
        self.special = [t.content for t in self.tool.get_added_tokens_decoder().values()]
        self.feed = self.word["\n"]

    def whole(self, text: str) -> bytes:
        return np.array(self.tool.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def merged(self, word: str) -> bytes:
        """The ids of one match of the pattern."""
        if word.isascii() and word.isprintable():
            shown = word.replace(" ", self.space)
        else:
            shown = word.encode().decode("latin-1").translate(self.table)
        tokens = self.merge(shown)
        return array("I", [t.id for t in tokens]).tobytes()

    def chunk(self, text: str, lead: str = "") -> bytes:
        """The ids of what stands between two spaces or line feeds, after ``lead``."""
        low = text.isascii() or max(text) < "\u0500"  # Latin, Greek and Cyrillic
        if low and text.isalpha():  # one word, kept where the chunk is
            return self.merged(lead + text)
        if not text or text[0].isspace() or text[-1].isspace():
            raise Odd
        if low and text[:-1].isalpha():  # a word and a mark
            return (self.later if lead else self.first)[text[:-1]] + self.word[text[-1]]
        return b"".join(map(self.word.__getitem__, self.words(lead + text)))

    def ids(self, text: str) -> bytes:
        """What the tokenizer gives for the whole text, without special tokens."""
        if any(special in text for special in self.special):
            return self.whole(text)
        first, later, out = self.first.__getitem__, self.later.__getitem__, []
        try:
            for line in text.split("\n"):
                head, *rest = line.split(" ")
                out.append(b"".join([first(head), *map(later, rest)]))
        except Odd:
            return b"".join([b"".join(map(self.word.__getitem__, self.words(t))) for t in SAFE(text)])
        return self.feed.join(out)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker."""
    return Encoder(path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones after a first that may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] * bool(n) + [(at, capacity) for at in range(first, n, capacity)]


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text"
) -> DataFrame:
    """``docs`` without its text and with piece, start, length and ids: a row for each piece.

    ``tokenizer`` is the path of a byte-level BPE file of the ``tokenizers`` library,
    at the same place on all machines. A document is its ids without special
    tokens, then ``end_id``; ``ids`` holds a piece's as little-endian 32-bit integers. Null
    and empty texts are the end alone. Repeated rows are packed each for itself. Columns
    named like new ones give way. Texts of any length are encoded in short chunks.
    """
    new = StructType.fromDDL("piece int, start long, length long, ids binary")
    raw = clear_of(docs, "raw_text")
    names = {f.name for f in new} | {text.lower()}
    kept = [c for c in docs.columns if c.lower() not in names]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], as_bytes(f"`{text}`").alias(raw))
    schema = StructType(source.schema.fields[:-1] + new.fields)
    end = np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, raw):
                rows, found = [], []
                for row, value in enumerate(part.column(raw)):
                    ids = tool.ids(value.as_py().decode("utf-8", "replace")) + end
                    for number, (start, n) in enumerate(cuts(len(ids) // 4, capacity)):
                        rows.append(row)
                        found.append((number, start, n, ids[4 * start : 4 * (start + n)]))
                at = pa.array(rows, pa.int64())
                columns = [part.column(c).take(at) for c in kept]
                fields = zip(*found, strict=True)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                columns += [pa.array(x, t) for x, t in zip(fields, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


# Fillings of a sequence: (lengths, how often each)

Filling = tuple[np.ndarray, np.ndarray]


def knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The dearest load of each capacity, and a length of that load (0: leave a token empty).

    ``prices`` is by length, 0 for lengths that are not to be used.
    """
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        values = prices[1 : room + 1] + best[room - 1 :: -1] if room > 1 else prices[1:2] + best[:1]
        at = int(values.argmax())
        if values[at] > best[room - 1]:
            best[room], last[room] = values[at], at + 1
        else:
            best[room] = best[room - 1]
    return best, last


def loads(first: np.ndarray, last: np.ndarray, capacity: int) -> np.ndarray:
    """A row for each length in ``first``: how often each length is in the dearest filling around it."""
    use = np.zeros((len(first), capacity + 1), dtype=np.int32)
    at = np.arange(len(first))
    use[at, first] = 1
    room = capacity - first
    while at.size:
        taken = last[room]
        np.add.at(use, (at[taken > 0], taken[taken > 0]), 1)
        room = room - np.maximum(taken, 1)
        at, room = at[room > 0], room[room > 0]
    return use


def linear_program(
    counts: np.ndarray, capacity: int, phases: int = PHASES
) -> tuple[list[Filling], np.ndarray, float]:
    """Fillings, how often to use each (a fraction) to cover ``counts``, and a lower bound for that.

    Multiplicative weights: a length's price falls with its cover, which a phase raises
    by up to ``STEP``; all fillings within ``NEAR`` of the dearest one share it, each in
    proportion to what its rarest length allows. Ends when the tokens covered
    are as many as there are; lengths that fit any gap are covered more, others less.
    """
    lengths = np.flatnonzero(counts)
    at = np.zeros(capacity + 1, dtype=np.int64)
    at[lengths] = np.arange(len(lengths))
    b = counts[lengths].astype(float)
    size = float((b * lengths).sum()) / capacity
    bound, cover, done = size, np.zeros(len(lengths)), 0.0
    mark = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, capacity + 1)
    marks, usage, spans, columns, often = [], [], [], [], []
    for _ in range(phases):
        if done >= 1 or not len(lengths):
            break
        # The start prices are the lengths themselves, the right ones if nothing need stay empty.
        prices = np.zeros(capacity + 1)
        prices[lengths] = lengths * np.exp(-RATE * (cover - done))
        best, last = knapsack(prices, capacity)
        bound = max(bound, float((b * prices[lengths]).sum() / best[capacity]))
        around = prices[lengths] + best[capacity - lengths]
        chosen = loads(lengths[around >= (1 - NEAR) * best[capacity]], last, capacity)
        row, column = np.nonzero(chosen)
        times = chosen[row, column].astype(np.int64)
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        share = np.minimum.reduceat(counts[column] / times, starts)
        gain = np.bincount(at[column], share[row] * times, len(lengths)) / b
        step = STEP / gain.max()
        cover += step * gain
        done = float((cover * b * lengths).sum()) / capacity / size
        marks.append(np.add.reduceat(mark[column] * times, starts))
        usage.append(share * step)
        spans.append(np.diff(starts, append=len(row)))
        columns.append(column)
        often.append(times)
    if not marks:
        return [], np.zeros(0), bound
    # A filling found again is told by the sum of its lengths' marks.
    _, first, same = np.unique(np.concatenate(marks), return_index=True, return_inverse=True)
    ends = np.cumsum(np.concatenate(spans))
    starts = np.concatenate([[0], ends[:-1]])
    column, times = np.concatenate(columns), np.concatenate(often)
    found = [(column[starts[i] : ends[i]], times[starts[i] : ends[i]]) for i in first]
    return found, np.bincount(same, np.concatenate(usage)), bound


def rounded(
    counts: np.ndarray, found: list[Filling], usage: np.ndarray
) -> tuple[list[tuple[Filling, int]], np.ndarray]:
    """Whole numbers of fillings within the counts, most used first, and what is left of the counts.

    A fraction that is not used carries over to the next filling.
    """
    left, out, carried = counts.copy(), [], 0.0
    for i in np.argsort(-usage, kind="stable"):
        lengths, times = found[i]
        carried += usage[i]
        whole = int(carried + 1e-9)
        carried -= whole
        uses = min(whole, int((left[lengths] // times).min()))
        if uses > 0:
            left[lengths] -= uses * times
            out.append(((lengths, times), uses))
    return out, left


def filled(left: np.ndarray, capacity: int) -> list[tuple[Filling, int]]:
    """Fillings for exactly what is left: the largest length, then the fullest load of others there are."""
    left, out = left.copy(), []
    while left.any():
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        lengths, times = np.unique([largest, *fullest(left, capacity - largest)], return_counts=True)
        left[largest] += 1
        uses = int((left[lengths] // times).min())
        left[lengths] -= uses * times
        out.append(((lengths, times), uses))
    return out


def fullest(left: np.ndarray, room: int) -> list[int]:
    """Lengths, none oftener than ``left`` has it, whose sum comes closest to ``room`` from below; long ones first."""
    sums, seen, within = 1, [], (1 << (room + 1)) - 1  # bit s: there are lengths with the sum s
    for length in np.flatnonzero(left[: room + 1])[::-1].tolist():
        for _ in range(min(int(left[length]), room // length)):
            more = sums | sums << length & within
            if more == sums:
                break
            seen.append((length, sums))
            sums = more
        if sums >> room & 1:
            break
    at, out = sums.bit_length() - 1, []
    for length, before in reversed(seen):
        if not before >> at & 1:
            out.append(length)
            at -= length
    return out


def fillings(counts: np.ndarray, capacity: int) -> tuple[list[tuple[Filling, int]], float]:
    """Fillings that hold exactly ``counts``, with their uses, and a lower bound on the number of sequences.

    The program's usage is rounded in several ways, all of it or a share, with or
    without fillings that leave a gap, and the one that ends with the fewest sequences is taken.
    """
    found, usage, bound = linear_program(counts, capacity)
    gap = np.array([capacity - int(lengths @ times) for lengths, times in found])
    best = None
    for share in SHARES:
        for used in (usage, np.where(gap == 0, usage, 0)):
            whole, left = rounded(counts, found, used * share)
            whole += filled(left, capacity)
            n = sum(uses for _, uses in whole)
            if best is None or n < best[0]:
                best = n, whole
    return best[1], bound


# Sequences


def lots(whole: list[tuple[Filling, int]], capacity: int) -> dict[int, np.ndarray]:
    """For each length, what its numbered pieces go to, as rows in order of the number.

    (first number, how many in a sequence, first sequence, first offset)
    """
    rows, taken, sequence = {}, np.zeros(capacity + 1, dtype=np.int64), 0
    for (lengths, times), uses in whole:
        offset = 0
        for length, often in zip(lengths[::-1].tolist(), times[::-1].tolist(), strict=True):
            rows.setdefault(length, []).append((int(taken[length]), often, sequence, offset))
            taken[length] += often * uses
            offset += length * often
        sequence += uses
    return {length: np.array(x, dtype=np.int64) for length, x in rows.items()}


def packed(cut: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset`` for pieces of 1 to ``capacity`` tokens.

    Sequences are gapless from offset 0, and as few as the method above finds. Columns
    named like the new ones give way. ``cut`` is stored once, with each piece's
    number among those of its length in its task; an empty table gives an empty
    result. The driver gets the counts by length, ``capacity`` numbers at most.
    """
    spark = cut.sparkSession
    kept = [c for c in cut.columns if c.lower() not in ("sequence_id", "offset")]
    cut = cut.select(*[f"`{c}`" for c in kept])
    task, rank, before, n, t = (clear_of(cut, c) for c in ("task", "rank", "before", "of_length", "of_task"))
    numbered_schema = StructType([*cut.schema, StructField(task, LongType()), StructField(rank, LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            sizes = batch.column(length).to_numpy()
            order = np.argsort(sizes, kind="stable")
            starts = np.flatnonzero(np.diff(sizes[order], prepend=-1))
            run = np.diff(starts, append=len(order))
            ranks = np.empty(len(order), dtype=np.int64)
            ranks[order] = np.arange(len(order)) - np.repeat(starts, run) + seen[sizes[order]]
            seen += np.bincount(sizes, minlength=capacity + 1)
            tasks = np.full(len(order), own, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tasks), pa.array(ranks)], names=numbered_schema.names
            )

    whole = stored(cut.mapInArrow(number, numbered_schema), "pieces")
    # A row for each task and length; a common length has a row for each task.
    by_task = whole.groupBy(F.col(f"`{length}`").alias(n), F.col(task).alias(t)).agg(F.count("*").alias("c"))
    earlier = Window.partitionBy(n).orderBy(t).rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.select(n, t, F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias(before))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for size, c in by_task.groupBy(n).agg(F.sum("c")).collect():
        counts[size] = c
    full, counts[capacity] = int(counts[capacity]), 0
    used, _ = fillings(counts, capacity)
    used.append(((np.array([capacity]), np.array([1])), full))
    sent = spark.sparkContext.broadcast(lots(used, capacity))
    schema = StructType([*cut.schema, *StructType.fromDDL("sequence_id long, `offset` long")])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(length).to_numpy()
            ranks = batch.column(rank).to_numpy() + batch.column(before).to_numpy()
            sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                table = sent.value[size]
                lot = table[np.searchsorted(table[:, 0], ranks[at], side="right") - 1]
                turn, slot = np.divmod(ranks[at] - lot[:, 0], lot[:, 1])
                sequence[at] = lot[:, 2] + turn
                offset[at] = lot[:, 3] + slot * size
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], names=schema.names
            )

    same = (F.col(f"`{length}`") == F.col(n)) & (F.col(task) == F.col(t))
    placed = whole.join(starts, same).select(*[f"`{c}`" for c in kept], rank, before)
    return placed.mapInArrow(place, schema)
