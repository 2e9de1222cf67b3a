"""Main text of web pages by wrappers that are inferred from the pages of a host.

A page is read as a stream of structural tags and text slots. Repetitions in it
become groups, so that pages of one template but different length have one
form. The different forms of a host, counted over all its pages, are aligned one
after the other: what only one of two has becomes optional, what repeats becomes
a repeated group, differing texts are slots. The result, a regular expression
without alternatives, is the host's wrapper. Each of its slots has a path of
elements; the host's main region is the outermost element that holds an article by its
name or role, or else the one that gathers most of the text that isn't links,
summed over all pages of the host.

Text is then taken from that region of each page, block by block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedpulse.llm.arrow import added, as_bytes, clear_of, slices
from feedpulse.sources.scratch import stored

BROADCAST_HOSTS = 10_000
#: Longest group of tokens that is looked for as a repetition token by token; longer ones by element.
PERIOD = 40
#: Most elements next to each other in a repeated group that is found by element.
TOGETHER = 8
#: Forms or wrappers of a host that are aligned in one group, on average.
GROUP = 32

# Element names of HTML by their part in a page.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr img"
    " math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace"
    " msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
CLOSED_BY = {
    "p": set(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
        " header hgroup hr main menu nav ol p pre section table ul".split()
    ),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option"},
}
LEFT_OUT = set(
    "head nav footer aside form script style noscript template iframe svg annotation annotation-xml button select option textarea"
    " input dialog menu title object embed canvas audio video noembed noframes xmp".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words of class and id names that mark what isn't part of an article.
MARKED_OUT = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent"
    " notice notices gdpr comment comments disqus sidebar nav navbar navigation menu breadcrumb breadcrumbs footer"
    " share sharing social related recommended newsletter subscribe subscription popup modal overlay paywall"
    " pagination pager widget toolbar".split()
)
#: Words that, beside those, say nothing of what an element is about.
STRUCTURE = set(
    "area article bar block bottom box btn button buttons card cards col column container content entry fixed form"
    " global group header icon icons inline inner item items left link links list main outer page panel post posts"
    " primary right row secondary section sidebar signup site slot sticky story text title top unit wrap wrapper".split()
)
#: Those whose id marks a section; other ids of sections are often made from words of their headings.
SECTIONS_OUT = {"comments", "disqus", "sidebar", "navbar", "breadcrumb", "breadcrumbs", "pagination", "pager"}
ROLES_OUT = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog"}
MAIN_NAMES = ("article", "main")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<close>[A-Za-z][^\s>/]*)[^>]*(?:>|\Z)"
    # Attributes as a browser reads them: a quote opens a value right after "=" only, elsewhere it is a letter.
    r"|<(?P<open>[A-Za-z][^\s>/]*)(?P<attributes>(?>[\s/]+|[^\s/>=]+(?>\s*=\s*"
    r"(?>\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*)?)?|=)*+)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>\"'][^\s>]*))?)?")
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*\Z").search
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _words(token: str) -> set[str]:
    return {w.lower() for w in NAME_PART.findall(token)}


def _marks(token: str) -> bool:
    """Whether a whole class or id says that an element isn't part of an article: no word of it is about anything else."""
    words = _words(token)
    return bool(words & MARKED_OUT) and words <= MARKED_OUT | STRUCTURE


def _id_marks(name: str, token: str) -> bool:
    """The same for an id; those of headings and paragraphs mark nothing, of sections only what is no subject."""
    if name == "p" or name in HEADINGS:
        return False
    return _marks(token) and (name != "section" or bool(_words(token) & SECTIONS_OUT))


class Element:
    """An open element: its name, its name in paths, and what it and those around it say of text within."""

    __slots__ = (
        "article", "block", "header", "here", "hidden", "link", "main", "match", "name", "outer", "path", "raw", "titled",
    )

    def __init__(self, name: str, attributes: str, parent: Element | None) -> None:
        given = {
            m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)
        } if attributes.strip() else {}
        marked = any(_marks(token) for token in given.get("class", "").split())
        marked = marked or (bool(given.get("id")) and _id_marks(name, given["id"]))
        role = given.get("role", "").lower()
        kind = next((c for c in re.split(r"[\s\d]+", given.get("class", "")) if c), "")
        kind = kind or ("role-" + role if role else "")
        self.name = name
        self.path = f"{name}.{kind}" if kind else name
        within = parent is not None and parent.main
        # A header within an article holds its title.
        own = (
            name in LEFT_OUT
            or (name == "header" and not within)
            or role in ROLES_OUT
            or (name not in (*MAIN_NAMES, "html", "body") and marked)
            or "hidden" in given
            or given.get("aria-hidden") == "true"
            or "display:none" in given.get("style", "").replace(" ", "").lower()
        )
        # Handed down, so that no text looks through all elements around it.
        of = lambda flag: parent is not None and getattr(parent, flag)
        self.hidden = own or of("hidden")
        self.main = within or name in MAIN_NAMES or self.path.endswith("role-main")
        self.article = name == "article" or of("article")
        self.header = name == "header" or of("header")
        self.link = name == "a" or of("link")
        self.titled = name == "p" or name in HEADINGS or of("titled")
        self.raw = name in RAW or of("raw")
        self.block = name if name not in INLINE else (parent.block if parent is not None else "")
        self.match = 0
        # The innermost element here that isn't inline, and the one around that.
        self.here = self if name not in INLINE else (parent.here if parent is not None else None)
        self.outer = parent.here if parent is not None else None

    def place(self) -> str:
        """The path from the page's outermost element; inline elements aren't part of paths."""
        out, at = [], self.here
        while at is not None:
            out.append(at.path)
            at = at.outer
        return "/".join(reversed(out))


OUTSIDE = Element("span", "", None)


def parsed(page: str) -> Iterator[tuple[str, list[Element], str]]:
    """("open" or "close", elements, name) and ("text", elements, raw text) in page order.

    Elements are those open after an opening, before a closing. Missing end tags
    are supplied; end tags of nothing are passed over; unclosed comments and raw
    elements go to the end.
    """
    stack: list[Element] = []
    opened: Counter[str] = Counter()
    at, n = 0, len(page)

    def push(name: str, attributes: str) -> None:
        stack.append(Element(name, attributes, stack[-1] if stack else None))
        opened[name] += 1

    def pop() -> str:
        name = stack.pop().name
        opened[name] -= 1
        return name

    while at < n:
        m = TOKEN.search(page, at)
        end = m.start() if m else n
        if end > at:
            yield "text", stack, page[at:end]
        if not m:
            return
        at = m.end()
        if m["open"]:
            name = m["open"].lower()
            while stack and name in CLOSED_BY.get(stack[-1].block, ()):
                while stack:
                    yield "close", stack, stack[-1].name
                    if pop() not in INLINE:
                        break
            push(name, m["attributes"])
            yield "open", stack, name
            if name in VOID or SELF_CLOSED(m["attributes"]):
                yield "close", stack, name
                pop()
            elif name in RAW:
                close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                end = close.start() if close else n
                if end > at:
                    yield "text", stack, page[at:end]
                yield "close", stack, name
                pop()
                at = close.end() if close else n
        elif m["close"]:
            name = m["close"].lower()
            if opened[name]:
                while stack:
                    yield "close", stack, stack[-1].name
                    if pop() == name:
                        break
            elif name == "br":
                push(name, "")
                yield "open", stack, name
                yield "close", stack, name
                pop()


# Wrappers: lists of tokens; a token is a tag, "#" for a text slot, or (sign, tokens).


def form(page: str) -> list[str]:
    """A page's structural tags and text slots."""
    out: list[str] = []
    for kind, stack, value in parsed(page):
        if kind == "text":
            if not (stack and stack[-1].raw) and value.strip() and (not out or out[-1] != "#"):
                out.append("#")
        elif value not in INLINE and value not in ("br", "wbr"):
            out.append(f"<{stack[-1].path}>" if kind == "open" else f"</{value}>")
    return out


def repeated(tokens: list) -> list:
    """With repetitions of a group, next to each other, as one repeated group; shortest groups first."""
    for period in range(1, PERIOD + 1):
        if 2 * period > len(tokens):
            break
        tokens = _folded(tokens, period)
    while periods := _periods(tokens):
        tokens = _folded(tokens, min(periods))
    return tokens


def _folded(tokens: list, period: int) -> list:
    """With repetitions of groups of ``period`` tokens as one repeated group."""
    out, i = [], 0
    while i < len(tokens):
        group = tokens[i : i + period]
        n = 1
        while len(group) == period and tokens[i + n * period : i + (n + 1) * period] == group:
            n += 1
        if n > 1 and balanced(group):
            out.append(group[0] if period == 1 and group[0][0] == "+" else ("+", tuple(group)))
            i += n * period
        # One more of a group found just before belongs to it.
        elif out and isinstance(out[-1], tuple) and out[-1] == ("+", tuple(group)) and len(group) == period:
            i += period
        else:
            out.append(tokens[i])
            i += 1
    return out


def _periods(tokens: list) -> set[int]:
    """Lengths of one or a few elements that stand next to equal ones, as they may once groups in them are folded."""
    found: set[int] = set()
    levels: list[list[int]] = [[]]
    for i, token in enumerate(tokens):
        if isinstance(token, tuple) or token == "#":
            continue
        if not token.startswith("</"):
            levels[-1].append(i)
            levels.append([])
        elif len(levels) > 1:
            levels.pop()
            starts = levels[-1]
            for k in range(1, min(TOGETHER, len(starts) // 2) + 1):
                a, b = starts[-2 * k], starts[-k]
                if b - a == i + 1 - b and tokens[a:b] == tokens[b : i + 1]:
                    found.add(b - a)
    return found


def balanced(tokens: list) -> bool:
    """Whether a group closes what it opens, and nothing else."""
    depth = 0
    for t in flat(tokens):
        if t.startswith("</"):
            depth -= 1
        elif t.startswith("<"):
            depth += 1
        if depth < 0:
            return False
    return depth == 0


def flat(tokens) -> Iterator[str]:
    for t in tokens:
        if isinstance(t, tuple):
            yield from flat(t[1])
        else:
            yield t


def bare(token):
    """A token as it is compared: a group once is the group repeated or optional."""
    return token[1] if isinstance(token, tuple) else (token,)


def aligned(a: list, b: list) -> list:
    """The wrapper of both: common tokens as they are, what only one has as optional groups.

    A group that repeats in one and stands once in the other is the same group.
    """
    a, b = once_grouped(a, b), once_grouped(b, a)
    match = SequenceMatcher(None, [bare(t) for t in a], [bare(t) for t in b], autojunk=False)
    out: list = []
    for kind, i, j, k, l in match.get_opcodes():
        if kind == "equal":
            for x, y in zip(a[i:j], b[k:l], strict=True):
                signs = "".join(t[0] for t in (x, y) if isinstance(t, tuple))
                sign = "*" if "*" in signs or {*signs} >= {"+", "?"} else signs[:1]
                out.append((sign, bare(x)) if sign else x)
        else:
            for part in (a[i:j], b[k:l]):
                out += _optional_parts(part)
    return repeated([t for x in out for t in (x[1] if isinstance(x, tuple) and not x[0] else (x,))])


def once_grouped(tokens: list, other: list) -> list:
    """``tokens`` with the groups of ``other`` that stand there once marked as groups without a sign."""
    groups = sorted({t[1] for t in other if isinstance(t, tuple) and len(t[1]) > 1}, key=lambda g: (-len(g), str(g)))
    out, i = [], 0
    while i < len(tokens):
        group = next((g for g in groups if tuple(tokens[i : i + len(g)]) == g), None)
        out.append(("", group) if group else tokens[i])
        i += len(group) if group else 1
    return out


def _optional_parts(tokens: list) -> list:
    """Groups that need not be there: as long as what they open is closed again, else token by token."""
    plain = [t for t in tokens if not isinstance(t, tuple)]
    if len(plain) == len(tokens) and tokens and balanced(tokens):
        return [("?", tuple(tokens))]
    signs = {"+": "*", "*": "*"}
    return [(signs.get(t[0], "?"), t[1]) if isinstance(t, tuple) else ("?", (t,)) for t in tokens]


def as_text(tokens) -> str:
    return "".join(f"({as_text(t[1])}){t[0]}" if isinstance(t, tuple) else t for t in tokens)


WRITTEN = re.compile(r"<[^>]*>|#|\(|\)[+?*]")


def from_text(written: str) -> list:
    """The tokens of a wrapper in the form ``as_text`` gives it."""
    levels: list[list] = [[]]
    for token in WRITTEN.findall(written):
        if token == "(":
            levels.append([])
        elif token[0] == ")":
            group = levels.pop()
            levels[-1].append((token[1], tuple(group)))
        else:
            levels[-1].append(token)
    return levels[0]


def wrapper_of(forms: list[tuple[str, int]]) -> str:
    """The wrapper of written forms, the most frequent first."""
    out: list | None = None
    for written, _ in sorted(forms, key=lambda f: (-f[1], f[0])):
        tokens = from_text(written)
        out = tokens if out is None else aligned(out, tokens)
    return as_text(out or [])


# Regions


def region_mass(page: str) -> dict[str, int]:
    """For each path outside what is left out, its text's length, that of links counted against it."""
    mass: dict[str, int] = {}
    for kind, stack, value in parsed(page):
        around = stack[-1] if stack else OUTSIDE
        if kind == "text" and value.strip() and not around.hidden:
            path, size = around.place(), len(value.strip())
            mass[path] = mass.get(path, 0) + (-size if around.link else size)
    return mass


def named_region(wrapper: str) -> str:
    """The path of the outermost element that holds an article by its name or role; empty if there is none."""
    stack: list[str] = []
    regions: dict[str, str] = {}
    for token in flat(from_text(wrapper)):
        if token.startswith("</"):
            if token[2:-1] in (s.split(".")[0] for s in stack):
                while stack.pop().split(".")[0] != token[2:-1]:
                    pass
        elif token.startswith("<"):
            stack.append(token[1:-1])
            name = stack[-1].split(".")[0]
            kind = name if name in MAIN_NAMES else stack[-1].rpartition(".")[2]
            regions.setdefault(kind, "/".join(stack))
            if name in VOID:
                stack.pop()
    for kind in (*MAIN_NAMES, "role-main"):
        if kind in regions:
            return regions[kind]
    return ""


def main_region(wrapper: str, mass: dict[str, int]) -> str:
    """The path of the element to take text from; empty for the whole page."""
    if region := named_region(wrapper):
        return region
    total = sum(v for v in mass.values() if v > 0)
    sums: dict[str, int] = {}
    for path, size in mass.items():
        parts = path.split("/")
        for i in range(1, len(parts) + 1):
            key = "/".join(parts[:i])
            sums[key] = sums.get(key, 0) + size
    best = [p for p, size in sums.items() if size >= 0.7 * total and p.split("/")[-1].split(".")[0] not in ("p", "li", *HEADINGS)]
    return max(best, key=lambda p: (p.count("/"), p), default="")


def extracted(page: str, region: str) -> str:
    """The text of a page's main region.

    Articles by name come first, whatever the host's region is; a page that has neither
    gives all text that isn't left out.
    """
    wanted = region.split("/") if region else []
    whole: list[list[str]] = [[]]
    inside: list[list[str]] = [[]]
    named: list[list[str]] = [[]]
    for kind, stack, value in parsed(page):
        if kind != "text":
            if kind == "open" and wanted:
                # How much of the region's path has been gone, -1 off it; inline elements aren't part of paths.
                own, gone = stack[-1], stack[-2].match if len(stack) > 1 else 0
                if own.name not in INLINE and 0 <= gone < len(wanted):
                    gone = gone + 1 if own.path == wanted[gone] else -1
                own.match = gone
            if value not in INLINE:
                for blocks in (whole, inside, named):
                    if blocks[-1]:
                        blocks.append([])
            continue
        around = stack[-1] if stack else OUTSIDE
        if around.hidden:
            continue
        # Links in an article's header lead elsewhere, unless they stand in its title or standfirst.
        if around.header and around.link and not around.titled:
            continue
        text = html.unescape(value)
        whole[-1].append(text)
        if around.article:
            named[-1].append(text)
        if wanted and around.match == len(wanted):
            inside[-1].append(text)
    for blocks in (named, inside, whole):
        lines = [" ".join("".join(b).split()) for b in blocks]
        text = "\n".join(x for x in lines if x)
        if text:
            return text
    return ""


# On tables


def host(url: str):
    """The host of a URL, without user and port; empty if there is none."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.lower(found)


def _decoded(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def forms(pages: DataFrame, page: str, of: str) -> DataFrame:
    """(host, form, path, n): pages of each form, and with a null form the text mass of each path."""
    raw = clear_of(pages, "raw")
    source = pages.select(F.col(of).alias("host"), as_bytes(f"`{page}`").alias(raw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, raw):
                counts: dict[tuple[str, str | None, str | None], int] = {}
                for own, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    text = _decoded(value)
                    keys = [((own, as_text(repeated(form(text))), None), 1)]
                    keys += [((own, None, path), n) for path, n in region_mass(text).items()]
                    for key, n in keys:
                        counts[key] = counts.get(key, 0) + n
                rows = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.string()) for i in range(3)]
                    + [pa.array(np.fromiter(counts.values(), np.int64, len(rows)))],
                    names=["host", "form", "path", "n"],
                )

    found = source.mapInArrow(run, "host string, form string, path string, n long")
    return found.groupBy("host", "form", "path").agg(F.sum("n").alias("n"))


def wrappers(pages: DataFrame, page: str = "html", url: str = "url") -> DataFrame:
    """(host, wrapper, region, n_forms) for every host; a page without a URL belongs to the host ''.

    A host's forms are aligned in groups of about ``GROUP``, then the groups' wrappers,
    until there is one.
    """
    of = clear_of(pages, "host")
    counted = stored(forms(pages.withColumn(of, host(f"`{url}`")), page, of), "forms")

    level = counted.where("form IS NOT NULL").select("host", "form", "n", F.lit(1).cast("long").alias("forms"))
    groups = 0
    while groups != 1:
        most = level.groupBy("host").count().agg(F.max("count")).first()[0] or 1
        groups = -(-most // GROUP)
        level = stored(merged(level, groups), "merged")
    found = level.join(massive_regions(counted.where("path IS NOT NULL").select("host", "path", "n")), "host", "left")

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, wrapper, massive, n = (batch.column(c) for c in ("host", "form", "region", "forms"))
            region = [named_region(w) or m or "" for w, m in zip(wrapper.to_pylist(), massive.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [host, wrapper, pa.array(region, pa.string()), n], names=["host", "wrapper", "region", "n_forms"]
            )

    schema = "host string, wrapper string, region string, n_forms long"
    return stored(found.select("host", "form", "region", "forms").mapInArrow(regions, schema), "wrappers")


def merged(level: DataFrame, groups: int) -> DataFrame:
    """(host, form, n, forms): the wrappers of a host's forms in ``groups`` parts, and how many forms each stands for."""

    def part(table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("form").to_pylist(), table.column("n").to_pylist(), strict=True))
        forms = sum(table.column("forms").to_pylist())
        return pa.table(
            {"host": table.column("host")[:1], "form": [wrapper_of(rows)], "n": [sum(n for _, n in rows)], "forms": [forms]}
        )

    salted = level.withColumn("salt", F.pmod(F.xxhash64("form"), F.lit(groups)))
    return salted.groupBy("host", "salt").applyInArrow(part, "host string, form string, n long, forms long")


def massive_regions(mass: DataFrame) -> DataFrame:
    """(host, region): the innermost element with most of a host's text, from the ``n`` of each path, as in ``main_region``."""
    total = mass.groupBy("host").agg(F.sum(F.when(F.col("n") > 0, F.col("n")).otherwise(0)).alias("total"))
    parts = "split(path, '/', -1)"
    above = f"explode(transform(sequence(1, size({parts})), i -> array_join(slice({parts}, 1, i), '/')))"
    sums = mass.selectExpr("host", f"{above} AS prefix", "n").groupBy("host", "prefix").agg(F.sum("n").alias("size"))
    last = F.split_part(F.element_at(F.split("prefix", "/"), -1), F.lit("."), F.lit(1))
    best = sums.join(total, "host").where((F.col("size") >= F.lit(0.7) * F.col("total")) & ~last.isin("p", "li", *HEADINGS))
    depth = F.size(F.split("prefix", "/"))
    return best.groupBy("host").agg(F.max(F.struct(depth.alias("depth"), "prefix"))["prefix"].alias("region"))


def main_text(pages: DataFrame, page: str = "html", url: str = "url") -> DataFrame:
    """``pages`` without the page itself, with ``text`` and ``n_chars`` (code points).

    A null or empty page has the text ''. A page without a usable URL goes with
    the others of that kind. Repeated rows get the same text. Clashing columns
    give way to the new ones; an empty table gives an empty result.
    """
    regions = wrappers(pages, page, url).select("host", "region")
    if regions.count() <= BROADCAST_HOSTS:
        regions = F.broadcast(regions)
    own, region = clear_of(pages, "page_host"), clear_of(pages, "page_region")
    regions = regions.withColumnsRenamed({"host": own, "region": region})
    joined = pages.withColumn(own, host(f"`{url}`")).join(regions, own, "left")
    # The region goes before the page, in one column, and both come out of it as the text.
    packed = clear_of(joined, "packed")
    text = F.concat(
        F.encode(F.concat(F.coalesce(F.col(region), F.lit("")), F.lit("\n")), "utf-8"), as_bytes(f"`{page}`")
    )
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars") and c != page]
    source = joined.select(*[f"`{c}`" for c in kept], text.alias(packed))

    def make(values: list[bytes]) -> list[pa.Array]:
        found = []
        for value in values:
            where, _, page = value.partition(b"\n")
            found.append(extracted(_decoded(page), where.decode()))
        return [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]

    return added(source, packed, "text string, n_chars long", make).drop(packed)
