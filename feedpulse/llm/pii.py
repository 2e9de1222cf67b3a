"""Personal data replaced by surrogates.

Patterns find the entities. Each gets a surrogate of its type, made from a keyed
hash: letters for letters, digits for digits, the same punctuation, valid check
digits where the original had them, names of the same gender and script. An
entity has one surrogate wherever and however it is written; a word of a name has
one as given and as family name and with any title, also where the name is
mentioned again without one in the same text. Two entities never share one: the different entities of the whole table are counted by
surrogate, and all but one of those that meet, or that hit a real entity, are
hashed again until none do, later from wider spaces, so that no number of entities
fills them. What was hashed again goes along as a broadcast up to
a checked number, else through a join.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from ipaddress import IPv6Address
from unicodedata import decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedpulse.llm.arrow import as_bytes, clear_of, slices
from feedpulse.sources.scratch import stored

ROUNDS = 50
#: Attempts in the usual space of surrogates, and attempts until it is widened once more.
USUAL, WIDENED = 6, 2
#: Fewest digits of a phone number with its country code.
PHONE_DIGITS = 7
BROADCAST_ENTITIES = 100_000

#: Titles by the gender they tell ("" for none).
TITLES = {
    "m": ["Mr", "Mr.", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr.", "Don", "господин", "г-н"],
    "f": ["Mrs", "Mrs.", "Ms", "Ms.", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra.", "госпожа", "г-жа"],
    "": ["Dr", "Dr.", "Prof.", "Professor", "доктор"],
}
#: What surrogate names are put together from, by script.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ja jo ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до за зе ка ко ла ле ло ма ме мо на не но па пе по ра ре ро са се со та те то фа фе ха хо".split(),
}
ENDINGS = {
    ("latin", "m"): ["rik", "ton", "nus", "ward"],
    ("latin", "f"): ["ria", "lina", "netta", "ssa"],
    ("latin", ""): ["son", "mer", "ley", "man"],
    ("cyrillic", "m"): ["слав", "мир", "тон"],
    ("cyrillic", "f"): ["рина", "лина", "ния"],
    ("cyrillic", ""): ["енко", "ук", "ич"],
}
TITLE_OF = {title: gender for gender, titles in TITLES.items() for title in titles}
TITLE_PATTERN = "|".join(sorted((re.escape(t) for t in TITLE_OF), key=len, reverse=True))
NAME_WORD = r"(?:[^\W\d_a-zß-öø-ÿа-я][^\W\d_]+(?:-[^\W\d_]+)?|[A-ZА-Я]\.)"

KEY_WORDS = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"

PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<secret>(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
    rf"|\b{KEY_WORDS}\b\"?\s*[:=]\s*(?:\"[^\"\s]{{6,}}\"|'[^'\s]{{6,}}'|[^\s\"',;]{{6,}}))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip6>(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:]|\.\d))"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))"
    r"|(?P<card>(?<![\w-])(?:\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\w-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\w)"
    # National numbers: French pairs, German area and number, American with dots.
    r"|(?<![\w+.,/-])(?:0[1-9](?:[ .-]?\d{2}){4}|\(0[1-9]\d{1,3}\) ?\d{3,4}(?:[ -]?\d{1,4}){1,2}"
    r"|0[1-9]\d{1,3}[ /-]\d{3,4}(?:[ -]?\d{1,4}){1,2}|\d{3}\.\d{3}\.\d{4})(?![\w/-]|[.,]\d))"
    rf"|(?P<person>(?<!\w)(?:{TITLE_PATTERN}) (?:{NAME_WORD})(?: {NAME_WORD}){{0,2}})"
)
DIGIT_OR_AT = re.compile(r"[\d@]")
SECRET_KEY = re.compile(KEY_WORDS)
CAPITALISED = re.compile(r"(?<!\w)[^\W\d_a-zß-öø-ÿа-я][^\W\d_]+(?:-[^\W\d_]+)*(?!\w)")
SECRET_VALUE = re.compile(r"[:=]\s*[\"']?([^\s\"']+)")


@dataclass(frozen=True)
class Mention:
    """A place in a text: from ``start`` to ``end`` stands ``kind`` ``entity`` (its form for comparison)."""

    start: int
    end: int
    kind: str
    entity: str


def may_mention(text: str) -> bool:
    """Whether a text has anything that ``PATTERN`` cannot do without."""
    return bool(
        DIGIT_OR_AT.search(text)
        or any(t in text for t in TITLE_OF)
        or "AKIA" in text
        or "ASIA" in text
        or ((":" in text or "=" in text) and SECRET_KEY.search(text))
    )


def mentions(text: str) -> list[Mention]:
    """All entities of a text in order; a name gives one for each of its words."""
    if not may_mention(text):
        return []
    found, at = [], 0
    while m := PATTERN.search(text, at):
        kind, value, at = m.lastgroup, m.group(), m.end()
        if kind == "person":
            found += _name_words(value, m.start())
            continue
        start, end = m.span()
        if kind == "secret" and (inner := SECRET_VALUE.search(value)):
            start, end = m.start() + inner.start(1), m.start() + inner.end(1)
            if masked(text[start:end]):
                continue
        elif kind == "card" and not 13 <= sum(c.isdigit() for c in value) <= 19:
            continue
        elif kind == "phone" and sum(c.isdigit() for c in value) < PHONE_DIGITS:
            at = start + 1
            continue
        elif kind == "ip6":
            kind = "ip"
            try:
                IPv6Address(text[start:end])
            except ValueError:
                at = start + 1
                continue
        found.append(Mention(start, end, kind, canonical(kind, text[start:end])))
    return _with_later_names(text, found)


def is_name(kind: str) -> bool:
    return kind == "family" or kind.startswith("given_")


def rank(kind: str) -> int:
    """Which kind a word of a name is, if it has several: given and of a gender first, family last."""
    return 2 if kind in ("given_m", "given_f") else 1 if kind == "given_" else 0


def _with_later_names(text: str, found: list[Mention]) -> list[Mention]:
    """``found`` with the other mentions of its names' words, a word of one kind throughout."""
    counts = Counter((m.entity, m.kind) for m in found if is_name(m.kind))
    if not counts:
        return found
    kinds: dict[str, str] = {}
    for entity, kind in sorted(counts, key=lambda x: (rank(x[1]), counts[x], x[1])):
        kinds[entity] = kind
    out, at = [], 0
    for m in [*found, Mention(len(text), len(text), "", "")]:
        for word in CAPITALISED.finditer(text, at, m.start):
            whole = word.group().casefold()
            parts = [word] if whole in kinds else re.compile(r"[^-]+").finditer(text, *word.span())
            for part in parts:
                entity = part.group().casefold()
                if entity in kinds:
                    out.append(Mention(*part.span(), kinds[entity], entity))
        out.append(Mention(m.start, m.end, kinds[m.entity], m.entity) if is_name(m.kind) else m)
        at = m.end
    return out[:-1]


def replaceable(value: str) -> bool:
    """Whether a value has a letter or digit, for which another one can stand."""
    return any(c.isdigit() or c.isalpha() for c in value)


def masked(value: str) -> bool:
    """Whether a secret was made unreadable already, as by stars: one or two different marks throughout."""
    return not replaceable(value) and len(set(value)) <= 2


def _name_words(value: str, start: int) -> list[Mention]:
    title = max((t for t in TITLE_OF if value.startswith(t + " ")), key=len)
    words = [(w.start() + len(title), w.group()) for w in re.finditer(r"\S+", value[len(title) :])]
    words = [(at, w) for at, w in words if not w.endswith(".")]
    out = []
    for i, (at, word) in enumerate(words):
        given = f"given_{TITLE_OF[title]}" if i < len(words) - 1 else "family"
        out.append(Mention(start + at, start + at + len(word), given, word.casefold()))
    return out


def canonical(kind: str, value: str) -> str:
    """The form in which two ways of writing an entity are equal."""
    if kind in ("phone", "card", "ssn"):
        return "".join(str(decimal(c)) for c in value if c.isdigit())
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "ip" and ":" in value:
        return str(IPv6Address(value))
    return value.casefold() if kind == "email" else value


class Stream:
    """Keyed pseudo-random numbers for one entity."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int) -> None:
        self.seed = hashlib.blake2b(f"{kind}\0{attempt}\0{entity}".encode("utf-8", "surrogatepass"), key=key[:64]).digest()
        self.pool = int.from_bytes(self.seed, "big")
        self.round = 0

    def pick(self, n: int) -> int:
        if self.pool < 1 << 64:
            self.round += 1
            more = hashlib.blake2b(self.seed + self.round.to_bytes(4, "big")).digest()
            self.pool = int.from_bytes(more, "big")
        self.pool, out = divmod(self.pool, n)
        return out

    def of(self, items):
        return items[self.pick(len(items))]


LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
#: What secrets of marks alone are drawn from.
MARKS = "!#$%&()*+-./:<=>?@[]^_{|}~"
LETTERS_OF = {
    "cyrillic": ("абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    "latin": (LOWER, UPPER),
}


def script_of(word: str) -> str:
    return "cyrillic" if any("\u0400" <= c <= "\u04ff" for c in word) else "latin"


def _like(stream: Stream, value: str, hexadecimal: bool = False) -> str:
    """A character of the same class for each character, punctuation as it is."""
    if hexadecimal and re.fullmatch(r"[0-9a-f]+", value):
        return "".join(stream.of(HEX) for _ in value)
    out = []
    for c in value:
        if c.isdigit():
            out.append(stream.of(DIGITS))
        elif c.isalpha():
            lower, upper = LETTERS_OF[script_of(c)]
            out.append(stream.of(upper if c.isupper() else lower))
        else:
            out.append(c)
    return "".join(out)


def luhn_sum(digits: str) -> int:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled)


def widened(attempt: int) -> int:
    """How often the space of surrogates has been widened at an attempt."""
    return max(0, attempt - USUAL + WIDENED) // WIDENED


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The surrogate for an entity's comparable form, of the same kind and shape.

    A space of surrogates may be full; later attempts get characters more, one every few attempts.
    """
    s = Stream(key, kind, entity, attempt)
    more = widened(attempt)
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        labels = domain.split(".")
        return f"{_like(s, local + more * 'x')}@{'.'.join([*(_like(s, x) for x in labels[:-1]), labels[-1]])}"
    if kind == "ip" and ":" in entity:
        # The first group tells what an address is for.
        groups = IPv6Address(entity).exploded.split(":")
        made = [f"{1 + s.pick(0xFFFF):04x}" if more or int(g, 16) else g for g in groups[1:]]
        return str(IPv6Address(":".join([groups[0], *made])))
    if kind == "ip":
        octets = entity.split(".")
        if more > 1:
            return str(IPv6Address((0xFD << 120) + s.pick(1 << 120)))
        kept = 0 if more else 1 if octets[0] in ("10", "127") else 2 if octets[:2] == ["192", "168"] else 0
        return ".".join([*octets[:kept], *(str(1 + s.pick(254)) for _ in octets[kept:])])
    if kind == "card":
        digits = entity[0] + _like(s, entity[1:] + more * "0")
        if luhn_sum(entity) % 10 == 0:
            digits = digits[:-1] + str(-luhn_sum(digits[:-1] + "0") % 10)
        return digits
    if kind == "phone":
        # The first digit (of the country code, or of the area) stays.
        return entity[0] + _like(s, entity[1:] + more * "0")
    if kind == "ssn":
        return "9" + _like(s, entity[1:] + more * "0")
    if kind == "iban":
        body = _like(s, entity[4:] + more * "0")
        number = "".join(str(int(c, 36)) for c in body + entity[:2] + "00")
        return f"{entity[:2]}{98 - int(number) % 97:02d}{body}"
    if kind == "secret":
        if not replaceable(entity):
            return "".join(s.of(MARKS) for _ in entity + more * "!")
        kept = 4 if entity[:4] in ("AKIA", "ASIA") else 0
        return entity[:kept] + _like(s, entity[kept:], hexadecimal=not kept) + _like(s, more * "0")
    script, gender = script_of(entity), kind.removeprefix("given_") if kind != "family" else ""
    middle = "".join(s.of(SYLLABLES[script]) for _ in range(2 + s.pick(2) + more))
    return middle + s.of(ENDINGS[script, gender])


def written(kind: str, original: str, made: str) -> str:
    """A surrogate in the way in which the original was written."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(made)
        return "".join([*(next(digits) if c.isdigit() else c for c in original), *digits])
    if kind == "iban":
        letters = iter(made)
        return "".join([*(c if c == " " else next(letters) for c in original), *letters])
    if kind == "email":
        return "".join(m.upper() if o.isupper() else m for o, m in zip(original, made, strict=True)) if len(original) == len(made) else made
    if is_name(kind):
        return made.upper() if original.isupper() and len(original) > 1 else made.capitalize()
    return made


def replaced(text: str, key: bytes, attempts: dict[tuple[str, str], tuple[str, int]]) -> tuple[str, int]:
    """The text with its surrogates, and how many there are; ``attempts`` has the kind and attempt of some entities."""
    found = mentions(text)
    if not found:
        return text, 0
    parts, at = [], 0
    for m in found:
        kind, attempt = attempts.get((m.kind, m.entity), (m.kind, 0))
        made = surrogate(key, kind, m.entity, attempt)
        parts += [text[at : m.start], written(m.kind, text[m.start : m.end], made)]
        at = m.end
    return "".join([*parts, text[at:]]), len(found)


def _decoded(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def entities(docs: DataFrame, text: str, number: str | None = None) -> DataFrame:
    """(kind, entity), of every mention; with the rows' ``number`` if one is named."""
    raw = clear_of(docs, "raw")
    source = docs.select(*[f"`{c}`" for c in [number] if c], as_bytes(f"`{text}`").alias(raw))
    numbered = "row long, " if number else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, raw):
                rows, kinds, values = [], [], []
                numbers = part.column(0).to_pylist() if number else range(part.num_rows)
                for row, value in zip(numbers, part.column(raw).to_pylist(), strict=True):
                    for m in mentions(_decoded(value)):
                        rows.append(row)
                        kinds.append(m.kind)
                        values.append(m.entity)
                arrays = [pa.array(kinds, pa.string()), pa.array(values, pa.string())]
                names = ["kind", "entity"]
                if number:
                    arrays, names = [pa.array(rows, pa.int64()), *arrays], ["row", *names]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, numbered + "kind string, entity string")


def _with_surrogates(rows: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, attempt) with ``made``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("kind", "entity", "attempt")]
            made = [surrogate(key, *row) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], names=["kind", "entity", "attempt", "made"]
            )

    return rows.select("kind", "entity", "attempt").mapInArrow(
        run, "kind string, entity string, attempt int, made string"
    )


def space(kind: str):
    """What entities share as the space of their surrogates: the kind, one for all names."""
    name = (F.col(kind) == "family") | F.col(kind).startswith("given_")
    return F.when(name, "name").otherwise(F.col(kind)).alias("space")


def one_kind_each(known: DataFrame) -> DataFrame:
    """(kind, entity, as): the kind that an entity has throughout the table, by the mentions ``n`` of each kind."""
    ranks = F.when(F.col("kind").isin("given_m", "given_f"), 2).when(F.col("kind") == "given_", 1).otherwise(0)
    best = F.max(F.struct(ranks.alias("rank"), "n", "kind"))["kind"].alias("as")
    grouped = known.groupBy(space("kind"), "entity").agg(F.collect_set("kind").alias("kinds"), best)
    return grouped.select(F.explode("kinds").alias("kind"), "entity", "as")


def attempts(known: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, attempt, made) for the different entities, no two of a kind with the same surrogate
    and none with a real entity of the kind as its surrogate; all names count as one kind."""
    real = known.select(space("kind"), F.col("entity").alias("made"))
    settled = None
    pending = known.withColumn("attempt", F.lit(0))
    for _ in range(ROUNDS):
        tried = stored(_with_surrogates(pending, key).withColumn("space", space("kind")), "surrogates")
        first = tried.groupBy("space", "made").agg(F.min("entity").alias("entity"))
        first = first.join(real, ["space", "made"], "left_anti")
        if settled is not None:
            first = first.join(settled.select("space", "made"), ["space", "made"], "left_anti")
        good = stored(tried.join(first.select("space", "entity"), ["space", "entity"], "left_semi"), "settled")
        settled = good if settled is None else settled.unionByName(good)
        left = tried.join(good.select("space", "entity"), ["space", "entity"], "left_anti")
        pending = stored(left.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), "pending")
        if pending.isEmpty():
            return settled.drop("space")
    raise RuntimeError("too few surrogates of some kind for the entities; use another key or wider names")


def with_surrogates(
    docs: DataFrame, key: bytes, text: str = "text", counted: str | None = "n_entities", bound: int = BROADCAST_ENTITIES
) -> DataFrame:
    """``docs`` with ``text`` rewritten, and the number of replaced entities as ``counted`` (None: without).

    Null texts stay null and empty ones empty. Texts without entities come back
    as they were. Repeated rows get the same text. Other columns are kept; one
    with the name of ``counted`` gives way. An empty table gives an empty result.
    """
    known = entities(docs, text).groupBy("kind", "entity").agg(F.count("*").alias("n"))
    known = stored(one_kind_each(known), "entities")
    tried = attempts(known.select(F.col("as").alias("kind"), "entity").distinct(), key).where("attempt > 0")
    tried = tried.select(F.col("kind").alias("as"), "entity", "attempt")
    again = known.join(tried, ["as", "entity"], "left").fillna(0, "attempt").where("attempt > 0 OR as <> kind")
    again = stored(again.select("kind", "entity", "as", "attempt"), "again")
    redo = clear_of(docs, "redo")
    kind = "array<struct<kind:string,entity:string,as:string,attempt:int>>"
    if again.count() <= bound:
        sent = {(r["kind"], r["entity"]): (r["as"], r["attempt"]) for r in again.collect()}
        marked = docs.withColumn(redo, F.lit(None).cast(kind))
    else:
        sent, number = {}, clear_of(docs, "row")
        whole = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
        of_row = (
            entities(whole, text, number)
            .join(again, ["kind", "entity"])
            .groupBy(F.col("row").alias(number))
            .agg(F.collect_set(F.struct("kind", "entity", "as", "attempt")).alias(redo))
        )
        marked = whole.join(of_row, number, "left").drop(number)
    kept = [c for c in docs.columns if counted is None or c.lower() != counted.lower()]
    raw = clear_of(docs, "raw")
    source = marked.select(*[f"`{c}`" for c in kept], F.col(f"`{text}`").cast("binary").alias(raw), f"`{redo}`")
    schema = docs.select(*[f"`{c}`" for c in kept]).schema
    if counted is not None:
        schema = schema.add(counted, "long")
    shared = docs.sparkSession.sparkContext.broadcast(sent)
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, raw):
                texts, counts = [], []
                for value, own in zip(part.column(raw).to_pylist(), part.column(redo).to_pylist(), strict=True):
                    if value is None:
                        texts.append(None)
                        counts.append(0)
                        continue
                    mine = {(x["kind"], x["entity"]): (x["as"], x["attempt"]) for x in own} if own else shared.value
                    new, n = replaced(_decoded(value), key, mine)
                    texts.append(new if n else value)
                    counts.append(n)
                columns = list(part.columns[: len(kept)])
                columns[place] = pa.array([t.encode() if isinstance(t, str) else t for t in texts], pa.binary()).cast(pa.string())
                if counted is not None:
                    columns.append(pa.array(counts, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)
