import html
import re

import pytest

from tests.llm.conftest import LONG, ODD_TEXTS, bag
from tidemark.llm.html import blocks, extract_text, main_text

LONG_TEXT = "This is the story of a ship that was lost in the ice for most of a year, and of the people who went to look for it."
OTHER_TEXT = "The second part of it is about the harbour, and about what was found there by the men when they came back in the spring."


def article_lines(page):
    """What the given pages hold between the tags of their article, found by their fixed form."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    inner = re.sub(r"</?(p|h1)>", "\n", inner)
    lines = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", line)).split()) for line in inner.split("\n"))
    return "\n".join(line for line in lines if line)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    expected = [(r.page_id, r.url, article_lines(r.html), len(article_lines(r.html))) for r in pages.collect()]
    assert bag(found.collect()) == bag(expected)


def test_given_pages_without_what_names_their_parts(spark):
    """Menus, adverts and footers as mere divs: stop words, links and neighbours alone."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    right = 0
    for r in rows:
        bare = re.sub(r"(?<=<)(/?)(article|nav|footer)(?=>)", r"\1div", r.html).replace(' class="ad"', "")
        right += main_text(bare) == article_lines(r.html)
    assert right >= 0.75 * len(rows)  # a long advert without a mark reads like a paragraph


PARTS = {
    "nav": "<nav><ul><li><a href='/a'>The start</a></li><li><a href='/b'>of the end</a></li></ul></nav>",
    "header": f"<header><b>The Daily</b><p>{OTHER_TEXT}</p></header>",
    "footer": f"<footer>&copy; 2024 <p>{OTHER_TEXT}</p></footer>",
    "aside": f"<aside><h3>Also</h3><p>{OTHER_TEXT}</p></aside>",
    "sidebar": f"<div class='page-sidebar left'><div><p>{OTHER_TEXT}</p></div></div>",
    "notice": f"<div id=cookie-notice><p>{OTHER_TEXT}</p></div>",
    "alert": f"<section role='alert'><p>{OTHER_TEXT}</p></section>",
    "advert": f'<p class="advert">{OTHER_TEXT}</p>',
    "form": f"<form action=/s><label>Find</label><input name=q><p>{OTHER_TEXT}</p><button>Go</button></form>",
    "script": f"<script>if (a < b) document.write('<p>{OTHER_TEXT}</p>');</script>",
    "style": "<style>p > a { color: red }</style>",
    "noscript": f"<noscript><p>{OTHER_TEXT}</p></noscript>",
    "comment": f"<!-- <p>{OTHER_TEXT}</p> -->",
    "comments": f"<section id='comments'><article class='comment'><h4>Ann</h4><p>{OTHER_TEXT}</p></article></section>",
    "hidden": f"<div hidden><p>{OTHER_TEXT}</p></div>",
    "none": f"<div style='color: red; display: none'><p>{OTHER_TEXT}</p></div>",
    "links": "<div><a href=/x>More of the same in the archive</a> <a href=/y>and all of it by the year</a></div>",
}


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("inside", [False, True])
@pytest.mark.parametrize("frame", ["article", "main", 'div class="post-content"', "div"])
def test_parts_beside_the_text(part, inside, frame):
    body = f"<h1>Lost</h1><p>{LONG_TEXT}</p><p>Then.</p>{{}}<p>{OTHER_TEXT[::-1][:20]}</p><p>{LONG_TEXT.upper()}</p>"
    noise = PARTS[part]
    page = f"<{frame}>{body.format(noise if inside else '')}</{frame.split()[0]}>"
    page = f"<html><head><title>Lost - The Daily</title></head><body>{'' if inside else noise}{page}{'' if inside else noise}</body></html>"
    assert main_text(page) == "\n".join(["Lost", LONG_TEXT, "Then.", OTHER_TEXT[::-1][:20].strip(), LONG_TEXT.upper()])


def test_short_articles_and_pages_without_any_sign():
    assert main_text("<nav><a href=/>Home</a></nav><article><h1>One</h1><p>Two.</article><footer>Three</footer>") == "One\nTwo."
    assert main_text("<body><p>One</p><p>Two</p></body>") == "One\nTwo"
    assert main_text("just text, no tags &amp; 1 < 2") == "just text, no tags & 1 < 2"
    assert main_text("<p><a href=/>Home</a></p>") == ""


def test_open_blocks_go_with_their_neighbours():
    page = f"<div><p>Buy <a href=/>the things that you want and more of it</a></p><p>Now</p></div><div><h2>Head</h2><p>{LONG_TEXT}</p><p>End.</p></div><div><p>© us</p><p>Tail</p></div>"
    assert main_text(page) == f"Head\n{LONG_TEXT}\nEnd."


def test_white_space_references_and_breaks():
    page = "<article><p> a&nbsp;&nbsp;b\n\t c<br>d &lt;p&gt; &#x41;&amp;amp; <b>e</b>f<br><br>g<hr>h<p>i<p>j</article>"
    assert main_text(page) == "a b c d <p> A&amp; ef\ng\nh\ni\nj"


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p>a <b>b <i>c</p><p>d</b></p>", "a b c\nd"),
        ("<article><p>a</div></section><p>b</article></article>", "a\nb"),
        ("<article><p title='x > y' data-a=\"</p>\">a</p>", "a"),
        ("<article><p>it's 5 o'clock <span class=x'>now</span> isn't it</p>", "it's 5 o'clock now isn't it"),
        ("<article><p>a<!-- never closed <p>b", "a"),
        ("<article><p>a</p><script>never closed <p>b", "a"),
        ("<article><p>a < b <3 </ c> d", "a < b <3 d"),
        ("<article><p>a<p", "a"),
        ("<form id=page><main><p>a</p></main></form>", "a"),
        ("<article><ul><li>a<li class=ad>b<li>c</ul>", "a\nc"),
        ("<body class='has-sidebar ads'><article class='post comments-open'><header><h1>a</h1><p>by me</p></header><p>b</p></article>", "a\nb"),
        ("<ARTICLE><P>a</P><SCRIPT>x</SCRIPT ><Nav>b</NAV></ARTICLE>", "a"),
    ],
)
def test_broken_markup(page, text):
    assert main_text(page) == text


def test_nothing_is_looked_for_twice_in_long_pages():
    for piece in ("<!--", "<script", "<select>", "<div>", "</div>", "<", "<p class='", "&", "<a href=\"", "<![CDATA[", "</"):
        main_text("<article><p>a</p>" + piece * 60_000)
    assert len(blocks("<p>" + "a </b>" * 200_000)) == 1


def test_odd_rows(spark):
    rows = [(i, None if i % 3 else "u", t, "x", 5) for i, t in enumerate([*ODD_TEXTS, "<p>a</p>", "<p>a</p>"])] + [(None, None, "<p>b</p>", None, None)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(3)
    found = extract_text(df).collect()
    assert bag(found) == bag((i, u, main_text(h or ""), len(main_text(h or ""))) for i, u, h, *_ in rows)
    assert main_text(LONG) == LONG and extract_text(df.limit(0)).count() == 0
