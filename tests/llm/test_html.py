import html
import re

import pytest

import __spark_entry__ as contract
from derrick.llm import html_blocks
from derrick.llm.html_blocks import main_text

LONG = "This paragraph is long enough to count as the text of an article on its own."

CASES = [
    (None, ""),
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<nav>menu</nav>", ""),
    ("<p>a<", "a<"),
    (f"<div id='header'><a href=/>Home</a></div><div class='content'><h1>Title &amp; more</h1><p>{LONG}<p>Short.</div><footer>c</footer>", f"Title & more\n{LONG}\nShort."),
    (f"<article><header><h1>T</h1></header><p>{LONG}</p><aside>no</aside><p>End.</p></article><div class='comments'><p>{LONG}</p></div>", f"T\n{LONG}\nEnd."),
    (f"<div class='with-sidebar'><p>{LONG}</p></div><div class='sidebar'><p>{LONG}</p></div>", LONG),
    (f"<body><p>{LONG}<br>more&nbsp;&eacute;&#8212;</p><script>var a='<p>x</p>'</script><style>p{{}}</style><form>name<input></form></body>", f"{LONG} more é—"),
    (f"<div class='cookieBanner'>{LONG}</div><p>{LONG} Two.</p><ul class=menu><li><a>x</a></ul>", f"{LONG} Two."),
    ("<article><p>tiny</p></article>", "tiny"),
    (f"<main><article class='post'><p>{LONG}</p></article><article class='comment'><p>{LONG} Me too.</p></article></main>", LONG),
    (f"<div>a &amp;<b>amp;</b> {LONG}</div>", f"a &amp; {LONG}"),
    (f"<div class='entry-header'><h1>Head</h1></div><div id='main'><p>{LONG}</p><p>{LONG}</p><p>x</p></div>", f"{LONG}\n{LONG}\nx"),
    (f"<article><div class='entry-header'><h1>Head</h1></div><p>{LONG}</p></article>", f"Head\n{LONG}"),
    (f"<table><tr><td>{LONG}<td>b</table>", f"{LONG}\nb"),
    (f"<!-- <p>no</p> --><p>{LONG}</p><noscript>turn on</noscript>", LONG),
]


LINKED = [
    (f"<article><h1><a href=/>Title</a></h1><p>{LONG}</p><p><a href=/b>Go on reading</a></p></article>", f"Title\n{LONG}\nGo on reading"),
    (f"<article><p>{LONG}</p><ul>{''.join(f'<li><a href=/{k}>Reference {k}</a></li>' for k in range(4))}</ul><p>End.</p></article>", f"{LONG}\nReference 0\nReference 1\nReference 2\nReference 3\nEnd."),
    ("<main><p><a href=/>only links</a></p></main>", "only links"),
    (f"<html><head><meta charset=utf-8><title>t</title><body><p>{LONG}</p></body></html>", LONG),
    (f"<head><title>t</title><p>{LONG}</p>", LONG),
    (f"<head><title>t</title><script>var a</script></head><p>{LONG}</p>", LONG),
]


@pytest.mark.parametrize("page,text", LINKED)
def test_links_of_an_article_and_an_open_head(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page,text", CASES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_regions_find_surge_and_dive():
    import numpy as np

    assert html_blocks.regions(np.array([0, 9, 0, 0, 5, 0, 0, 0, 7, 0])) == [(1, 5), (8, 9)]
    assert html_blocks.regions(np.array([], np.int64)) == []


def test_every_page_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.page_id: r for r in contract.queries()["op9_html_extraction"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
        assert rows[page.page_id].text == "\n".join(b for b in blocks if b)
        assert rows[page.page_id].n_chars == len(rows[page.page_id].text)


def test_edge_rows(spark):
    rows = [(1, "u", None, 1), (1, "u", None, 1), (None, None, "", 2), (3, "v", "<p>" + "word " * 50_000, 3), (4, "w", "<" * 20_000, 4), (5, "x", "<p>" * 5_000 + "end", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = html_blocks.extracted(df).collect()
    assert len(found) == 6 and {r.page_id: r.n_chars for r in found if r.page_id in (1, 3, 5)} == {1: 0, 3: 249_999, 5: 3}
    assert html_blocks.extracted(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article><p title="5" tall">First para.</p><p>Second para</p><p class="x">Third para</p></article>', "First para.\nSecond para\nThird para"),
        ("<article><div data-x=it's>First</div><p>don't lose Second</p><p>Third</p></article>", "First\ndon't lose Second\nThird"),
        ('<article><p title="a > b" class = "x">One</p><p a=\'"\' b="\'">Two</p><p =x /y>Three</p><br/><p data-x=a/b>Four</p></article>', "One\nTwo\nThree\nFour"),
        ('<article><p>One</p><p title="never closed>Two</p><p>Three</p></article>', "One\nTwo\nThree"),
        ("<article><p>One</p><p title=>Two</p><p title = >Three</p></article><p class", "One\nTwo\nThree"),
    ],
)
def test_quotes_in_tags(page, text):
    """A quote opens a value only behind an equals sign; one that is never closed hides nothing."""
    assert main_text(page) == text


def test_broken_tags_take_linear_time():
    for page in ("<p " + "a='" * 50_000, "<p " + "= " * 100_000, '<p x="' * 30_000, "<a b" * 50_000, "<p " + "x = " * 60_000):
        main_text(page)
