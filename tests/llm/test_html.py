import html as references
import re
import time

import pytest

from feedpulse.llm import html
from feedpulse.llm.html import aligned, as_text, extracted, form, from_text, main_region, region_mass, repeated, wrapper_of
from tests.conftest import SMALL


def written(page):
    return as_text(repeated(form(page)))


def test_form_and_repetitions():
    page = "<ul><li>a<li>b</li><li>c</ul><p>x<p>y <b>z</b><script>var t='</p>'</script>"
    assert written(page) == "<ul>(<li>#</li>)+</ul>(<p>#</p>)+<script></script>" or written(page).startswith("<ul>(<li>#</li>)+</ul>")
    assert from_text(written(page)) == repeated(form(page))


def test_wrapper_has_optional_and_repeated_groups():
    one = "<div><h1>t</h1><p>a</p></div>"
    many = "<div><h1>t</h1><p>a</p><p>b</p><table>x</table></div>"
    wrapper = wrapper_of([(written(one), 5), (written(many), 3)])
    assert wrapper == "<div><h1>#</h1>(<p>#</p>)+(<table>#</table>)?</div>"
    # It is a regular expression that its pages match.
    pattern = re.compile(wrapper.replace(".", r"\."))
    for page in (one, many):
        assert pattern.fullmatch("".join(form(page)))


def test_alignment_is_idempotent():
    tokens = repeated(form("<div><p>a</p><p>b</p><ul><li>x</ul></div>"))
    assert aligned(tokens, tokens) == tokens


def test_region_without_names_is_where_the_text_is():
    pages = [
        f"<body><div class=top><a href=1>Home</a></div><div class=text><h2>T{i}</h2>" + "<p>many words here</p>" * i + "</div></body>"
        for i in range(1, 5)
    ]
    mass = {}
    for page in pages:
        for path, n in region_mass(page).items():
            mass[path] = mass.get(path, 0) + n
    region = main_region(wrapper_of([(written(p), 1) for p in pages]), mass)
    assert region == "body/div.text"
    assert extracted(pages[1], region) == "T2\nmany words here\nmany words here"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        ("<article><h1>A&nbsp;b</h1><p>x<b>y</b>\n z<br>w<p>&lt;q&gt; &copy</article><footer>f</footer>", "A b\nxy z\nw\n<q> ©"),
        ("<article><p>a</p><div class='ad'>buy</div><aside>s</aside><form>f</form><p>b</p></article>", "a\nb"),
        ("<article><p>a</p><section id='comments'><p>first!</p></section></article>", "a"),
        ("<main><header><a>x</a><h1>T</h1></header><p>a</p></main><div class='cookie-notice'>c</div>", "T\na"),
        ("<nav>n</nav><article><p>a<!-- <p>no</p> --> b</p><script>if (a < b) '</article>'</script></article>", "a b"),
        ("<article><p>one</p><p>  </p><p>two</p></article>", "one\ntwo"),
        ("<article><p>open <b>never closed<p>next</article>", "open never closed\nnext"),
        ("<article><P CLASS=x>Upper</P></ARTICLE>", "Upper"),
        ("<article><p>cut off <a href='", "cut off"),
    ],
)
def test_extracted(page, text):
    assert extracted(page, "") == text


def plain(page):
    """The blocks of the test pages' articles by splitting."""
    article = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
    parts = re.split(r"</?(?:p|h1|br)\b[^>]*>", article)
    blocks = [" ".join(references.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(b for b in blocks if b)


def test_all_test_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = html.main_text(pages).collect()
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    assert {r["page_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_wrappers_of_the_test_hosts(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = html.wrappers(pages).collect()
    hosts = {re.match(r"\w+://([^/]+)", r["url"])[1] for r in pages.collect()}
    assert {r["host"] for r in rows} == hosts
    assert {r["region"] for r in rows} == {"html/body/article"}


def test_tables(spark, monkeypatch):
    page = "<article><p>a</p></article>"
    rows = [(1, "http://u:p@H.example:80/x", page), (1, "http://u:p@H.example:80/x", page), (2, None, page), (None, "nonsense", None), (3, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clashing = pages.selectExpr("*", "'x' AS text", "'y' AS host", "'z' AS region", "'w' AS raw", "'v' AS packed")
    for bound in (10_000, 0):
        monkeypatch.setattr(html, "BROADCAST_HOSTS", bound)
        got = html.main_text(clashing)
        assert sorted(got.columns) == sorted(["page_id", "url", "host", "region", "raw", "packed", "text", "n_chars"])
        assert sorted(r["text"] for r in got.collect()) == ["", "", "a", "a", "a"]
    assert {r["host"] for r in html.wrappers(pages).collect()} == {"h.example", ""}
    assert html.main_text(pages.limit(0)).collect() == []


@pytest.mark.parametrize(
    "part",
    [
        "<h2 id='related-work'>kept</h2>",
        "<h2 id='comments'>kept</h2>",
        "<section id='social-effects'><p>kept</p></section>",
        "<section id='advertising'><p>kept</p></section>",
        "<p id='advertising-revenue'>kept</p>",
        "<p id='notice'>kept</p>",
        "<div class='notice-period'><p>kept</p></div>",
        "<section id='comments-on-the-law'>kept</section>",
        "<p><math><semantics><mi>ke</mi><mrow><mo>pt</mo></mrow><annotation>tex</annotation></semantics></math></p>",
        "<header><p>kept</p><a>link</a></header>",
        "<header><div class='standfirst'>kept</div></header>",
    ],
)
def test_article_text_is_kept(part):
    assert extracted(f"<article><p>a</p>{part}<p>b</p></article>", "").splitlines() == ["a", "kept", "b"]


@pytest.mark.parametrize("name", ["ad", "related-posts", "shareButtons", "cookie-notice", "site-footer", "post-comments", "x ad-slot"])
def test_marked_parts_are_left_out(name):
    assert extracted(f"<article><p>a</p><div class='{name}'>out</div><p>b</p></article>", "") == "a\nb"


def test_long_repetitions():
    card = "<div>" + "".join(f"<{t}>x</{t}>" for t in ("h2", "p", "ul", "table", "dl", "pre", "figure") * 3) + "</div>"
    two, five = (written(f"<main>{card * n}</main>") for n in (2, 5))
    assert two == five
    pairs = [written("<main>" + ("<h2>t</h2>" + card) * n + "</main>") for n in (2, 7)]
    assert pairs[0] == pairs[1] and from_text(pairs[0]) == repeated(form("<main>" + ("<h2>t</h2>" + card) * 2 + "</main>"))


def test_groups_of_a_host_with_many_forms(spark):
    """One host with 600 forms: no group takes many of them, and the region is that of plain sums."""
    names = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}" for i in range(600)]
    texts = [f"<body><div class=top><a href=1>Home</a></div><div class=text><h2>T</h2><div class={n}><p>many words</p></div></div></body>" for n in names]
    pages = spark.createDataFrame([(i, "http://one.example/x", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    level = spark.createDataFrame([("h", written(t), 1, 1) for t in texts], "host string, form string, n long, forms long")
    sizes = [r["forms"] for r in html.merged(level, -(-600 // html.GROUP)).collect()]
    assert sum(sizes) == 600 and max(sizes) < 3 * html.GROUP
    row = html.wrappers(pages).collect()[0]
    assert row["n_forms"] == 600 and row["region"] == "body/div.text"
    mass = {}
    for t in texts:
        for path, n in region_mass(t).items():
            mass[path] = mass.get(path, 0) + n
    assert main_region("", mass) == row["region"]
    rows = html.main_text(pages.limit(5)).collect()
    assert {r["text"] for r in rows} == {"T\nmany words"}


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><p title=it's>Hello we don't stop</p><p>x</p></article>", "Hello we don't stop\nx"),
        ('<article><p>a</p><img alt=5"><p>b "q" c</p></article>', 'a\nb "q" c'),
        ("<article><p class=\"a>b\" x='y>z'>t</p><a href=/x/>link</a> more</article>", "t\nlink more"),
        ('<article><p "foo>a</p><p a=>b</p><p = >c</p><p a = "1"b=2>d</p></article>', "a\nb\nc\nd"),
        ('<article>a<p b="x>y', "a"),
        ("<article>a<br/>b<div class='x'/>c</div></article>", "a\nb\nc"),
    ],
)
def test_attributes_as_a_browser_reads_them(page, want):
    assert html.extracted(page, "") == want


def seconds(page):
    start = time.process_time()
    html.extracted(page, "div")
    html.form(page)
    return time.process_time() - start


@pytest.mark.parametrize("tag", ["<b>", "<div>", "<p a='", "<a b", "<p a=\" "])
def test_time_grows_with_the_page(tag):
    text = (tag + "w ") * 3_000
    seconds(text)
    assert seconds(text * 8) < 30 * max(seconds(text), 0.02)
