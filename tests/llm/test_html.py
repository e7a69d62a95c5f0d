"""HTML extraction: blocks, alignment, and differencing of neighbours."""

import random

import numpy as np
import pytest

from tidegauge.llm import html_extract
from tidegauge.llm.html_blocks import blocks_of, lines_of

SCHEMA = "page_id long, url string, html string"


def text_of(page: str | None) -> str:
    blocks = blocks_of(page)
    if any(block.main for block in blocks):
        blocks = [block for block in blocks if block.main]
    return "\n".join(block.text for block in blocks)


CASES = {
    "<p>a  <b>b</b>\n c</p><p>d": "a b c\nd",
    "<article><h1>T</h1><p>x &amp; y&nbsp;z &lt;b&gt; &#233;</article><footer>f</footer>": "T\nx & y z <b> é",
    "<body class='has-sidebar'><div class=sidebar>s</div><p>a</p></body>": "a",
    "<nav><ul><li>m</ul></nav><header>h</header><main><header><h1>T</h1>by me</header><p>a<form>f</form></main>": "T\na",
    "<div class='cookie-notice'>c<div>d</div></div><p>a</p>": "a",
    "<p>a<span class=ad>b<span>c</span>d</span>e</p>": "ae",
    "<script>var t='</p>';if(a<b){}</script><p>a<!-- <p>b --></p><style>p{}</style>": "a",
    "<article><p>a</p><section id='comments'><article><p>c</p></article></section></article>": "a",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "a\nb\nc\nd",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc",
    "<p>1 < 2 and 3<4</p>": "1 < 2 and 3<4",
    "<p title='a>b'>x</p><p class=\"y": "x",
    "<p hidden>h</p><div style='display: none'>n</div><div aria-hidden=true>x</div><p>a": "a",
    "<p>a<br>b<br/>c": "a b c",
    "<head><title>t</title><meta charset=utf-8><p>a": "a",
    "<!doctype html>plain &copy": "plain ©",
    "<article>a</article></div></p></article><article>b": "a\nb",
    "<div class='layout sidebar-right'><article><p>a</article><div class=sidebar>s</div></div>": "a",
    "<div id=page class='site comments-open'><article>a</article><div id=comments><article>c</article></div></div>": "a",
    "<div class=related-posts><article>t</article></div><main>a</main>": "a",
    "<main>a</main><div class=related-posts><article>t</article></div>": "a",
    "<div class=social-history><p>a</p><div class=menu>m</div></div>": "a",
    "<p>a</p><div class=social-history><p>b</p></div>": "a",
    "<div class=sidebar><article>s</article></div>": "",
    "<": "<",
    "": "",
}


@pytest.mark.parametrize("page", CASES)
def test_blocks(page):
    assert text_of(page) == CASES[page]


def test_long_and_broken_pages_take_linear_time():
    assert text_of("<div>" * 30000 + "x") == "x"
    assert text_of("<p>" * 30000 + "x" + "</div>" * 30000) == "x"
    assert text_of('<a href="' * 20000) == ""
    assert len(text_of("<p>" + "word " * 200000)) == 999999


def plain_length(a: list, b: list) -> int:
    table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    return int(table[-1, -1])


def test_alignment_is_longest():
    chance = random.Random(1)
    for _ in range(500):
        a, b = ([chance.randint(0, 5) for _ in range(chance.randint(0, 16))] for _ in range(2))
        x, y = html_extract.common_lines(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))
        assert [a[i] for i in x] == [b[j] for j in y]
        assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()
        assert len(x) == plain_length(a, b)


def bare(i: int, *own: str) -> str:
    lines = ["Welcome", "to the site", *own, "Contact", "the office", "Imprint", f"Page {i}"]
    return "".join(f"<div>{line}</div>" for line in lines)


def test_neighbours_lose_what_they_share(spark):
    rows = [
        (1, "http://h/a/1", bare(1, "own one is its own line", "more of one is here", "still one has a third")),
        (2, "http://h/a/2", bare(2, "own two is its own line", "more of two is here", "still two has a third")),
        (3, "http://h/b/1", bare(3, "own three is its own line", "more of three is here", "still three has a third")),
        (4, "http://other/a/1", bare(4, "own four")),
        (5, None, bare(5, "own five")),
        (6, "http://h/a/3", None),
        (7, "http://h/q", "<article><p>Welcome to the site</p><p>own</p><p><a href=x>Contact the office</a></p></article>"),
        (8, "http://h/r", "<article><p>Welcome to the site</p><p>new</p><p><a href=y>Contact the office</a></p></article>"),
    ]
    rows.append(rows[0])
    got = sorted((row.page_id, row.text, row.n_chars) for row in html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect())
    texts = {page: text for page, text, _ in got}
    assert texts[1] == "own one is its own line\nmore of one is here\nstill one has a third\nPage 1" and [page for page, _, _ in got].count(1) == 2
    assert texts[2] == "own two is its own line\nmore of two is here\nstill two has a third\nPage 2"
    assert texts[3] == "own three is its own line\nmore of three is here\nstill three has a third\nPage 3"
    assert texts[4].startswith("Welcome") and texts[5].startswith("Welcome")
    assert texts[6] == ""
    assert texts[7] == "Welcome to the site\nown\nContact the office"  # more than half is shared: copies
    assert all(len(text) == n for _, text, n in got)


def test_links_inside_articles(spark):
    page = "<article><p>{0} one has some text</p><p>{0} two has some more</p><p>{0} three as well</p><p>Quoted by both</p><p><a href=x>Back to the list</a></p></article>"
    rows = [(i, f"https://h/p/{i}", page.format(name)) for i, name in enumerate(("a", "b", "c"))]
    for row in html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect():
        assert "Quoted by both" in row.text and "Back to" not in row.text and row.n_shared == 1


def test_marked_lines_are_lines():
    lines = lines_of("<nav>m<a href=x>n</a></nav><p>a<span class=ad>b<span>c</span>d</span>e</p><form>f<br>g</form><script>s</script>")
    assert [(line.text, line.marked) for line in lines] == [("mn", True), ("ae", False), ("bcd", True), ("f g", True)]
    assert [(line.text, line.marked) for line in lines_of("<nav><a>m</a></nav>")] == [("m", True)]


def test_differencing_aligns_menus_and_footers(spark):
    """What articles stand in is compared too, and tells of lines that another page does not mark."""
    site = "<nav><ul><li>Home<li>News</ul></nav><article><p>{0} has a text of its own</p><p>Home</p></article><div>{0} extra</div><footer>Imprint</footer>"
    rows = [(i, f"https://h/p/{i}", site.format(name)) for i, name in enumerate(("a", "b"))]
    rows += [
        (2, "https://h/p/2", "<div>Home</div><div>News</div><div>c has a text of its own</div><div>Imprint</div>"),
        (3, "https://other/p/3", site.format("d")),
        (4, "https://h/p/1/copy", site.format("b")),
    ]
    got = {row.page_id: (row.text, row.n_lines, row.n_shared) for row in html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == ("a has a text of its own\nHome", 2, 3)
    assert got[2] == ("c has a text of its own", 4, 3)
    assert got[3] == ("d has a text of its own\nHome", 2, 0)
    assert got[1][:2] == got[4][:2] == ("b has a text of its own\nHome", 2)  # copies lose no text


def test_a_page_of_the_site_only_is_no_neighbour(spark):
    body = "<div>Top</div><div>{0} is a long line of its own</div><div>Imprint</div>"
    rows = [(0, "http://h/0", body.format("a")), (1, "http://h/1", "<nav>Top</nav><footer>Imprint</footer>"), (2, "http://h/2", body.format("c"))]
    got = {row.page_id: (row.text, row.n_shared) for row in html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: ("a is a long line of its own", 2), 1: ("", 0), 2: ("c is a long line of its own", 2)}


def test_pages_of_the_given_table(spark, medium):
    """Every article there is its h1 and its paragraphs."""
    pages = spark.read.parquet(f"{medium}/pages.parquet").repartition(7)
    rows = {row.page_id: row for row in html_extract.extract(pages).collect()}
    assert len(rows) == pages.count()
    for page in pages.collect():
        assert rows[page.page_id].text == text_of(page.html)
        assert rows[page.page_id].n_chars == len(rows[page.page_id].text)


def test_pairs_do_not_depend_on_ranges(spark):
    rows = [(i, f"http://h/{i // 7}/{i:04}", bare(i, *(f"own {i} {k} own" for k in range(4)))) for i in range(300)]
    pages = spark.createDataFrame(rows, SCHEMA)
    many = sorted(map(tuple, html_extract.extract(pages.repartition(9)).collect()))
    assert all(row[2] == "\n".join([*(f"own {row[0]} {k} own" for k in range(4)), f"Page {row[0]}"]) for row in many)


def test_empty(spark):
    assert html_extract.extract(spark.createDataFrame([], SCHEMA)).collect() == []
