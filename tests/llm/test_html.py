import html as library
import re

import pytest
from conftest_paths import SF01
from helpers import long_text

from cartwheel.llm.html import attributes, blocks, extract_text, main_text, op4_html_extraction

PROSE = "This is the story of a town that was on the edge of the sea, and of the people who had lived in it for as long as they could say."
PAGE = f"""<!DOCTYPE html><html><head><title>Title &amp; more</title><style>p{{}}</style><script>if (a < b) x("<p>no</p>")</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice">We use cookies, and that is all there is to it for you and for us in the end of the day.</div>
<main><article><h2>A heading</h2><p>{PROSE} {PROSE}<p>Short.</p><!-- <p>hidden</p> --><div class="ad">Buy this now, it is the best of the best.</div>
<p>Fish &amp; chips&nbsp;cost &#163;5 &lt;only&gt; <b>to</b>day<br>here</p><form><p>{PROSE} {PROSE}</p><input></form>
<div id="comments"><p>{PROSE} {PROSE}</p></div><p>The end.</p></article>
<aside>{PROSE} {PROSE}</aside></main><footer>&copy; All of it</footer></body></html>"""


def test_page():
    assert main_text(PAGE) == f"A heading {PROSE} {PROSE} Short. Fish & chips cost £5 <only> today here The end."


def test_pages_without_an_article():
    page = f"<body><div>Menu</div><ul><li><a href=x>one link</a></ul><div><h1>News</h1><p>{PROSE} {PROSE}</p><p>Yes.</p></div><div>Tail</div></body>"
    assert main_text(page) == f"News {PROSE} {PROSE} Yes."
    assert main_text("<p>the only words") == "the only words"
    assert main_text("plain of text") == "plain of text"


def test_broken_pages():
    for page in [None, "", "<", "<p", "<<<>>>", "<p>&am", "</div></p>", "<!--", "<script>x", "a<b", "<p a='>x</p>", "<a href=>the<a>of", "\0<p>\0"]:
        main_text(page)
    for cut in range(0, len(PAGE), 7):
        main_text(PAGE[:cut])
    assert main_text(f"<article><p>{PROSE} {PROSE}</p><p>cut &am") == f"{PROSE} {PROSE} cut &am"
    deep = "<div>" * 5000 + f"<p>{PROSE} {PROSE}"
    assert main_text(deep) == f"{PROSE} {PROSE}"
    assert main_text(f"<p>{long_text(1, 50_000)} the of and") == f"{long_text(1, 50_000)} the of and"


def test_attributes_and_blocks():
    assert attributes(" href='a&amp;b' HREF=c data-x checked class=\"q r\"") == {"href": "a&b", "data-x": "", "checked": "", "class": "q r"}
    assert [b.text for b in blocks("a<p>b<br>c</p>d")] == ["a", "b", "c", "d"]
    assert blocks("<p><a href=x>all link</a></p>")[0].links == 8


def test_marks_around_the_page():
    """Names and forms around the text of a page do not make it furniture; those beside it do."""
    body = f"<h1>News</h1><p>{PROSE} {PROSE}</p><p>{PROSE} {PROSE}</p>"
    text = f"News {PROSE} {PROSE} {PROSE} {PROSE}"
    beside = f'<div class="sidebar"><p>{PROSE} {PROSE}</p></div><div id="comments"><p>{PROSE} {PROSE}</p></div>'
    for around in ['<div class="content has-sidebar">', '<div class="layout no-sidebar">', '<div class="site search-results">', "<form action=x>",
                   '<div role="form">', '<div id="page" class="with-nav"><form><div class="social">', '<div class="comments-open">']:
        for inner in (f"<main>{body}</main>", f"<article>{body}</article>", body):
            assert main_text(f"<body>{around}{inner}") == text, (around, inner)
            if "comments" not in around:
                assert main_text(f"<body><nav>Menu</nav>{around}{inner}{beside}<footer>{PROSE} {PROSE}") == text, (around, inner)


def test_marks_beside_the_page_still_count():
    long = f"<p>{PROSE} {PROSE}</p>" * 5
    post = f"<p>{PROSE} {PROSE}</p>"
    for name in ("comments", "related", "sidebar"):
        assert main_text(f'<article>{post}</article><div class="{name}">{long}</div>') == f"{PROSE} {PROSE}"
        assert main_text(f'<div class="no-sidebar"><main>{post}</main></div><div class="{name}">{long}</div>') == f"{PROSE} {PROSE}"
    assert main_text(f'<div>{post}</div><div id="comments">{long}</div>') == f"{PROSE} {PROSE}"
    assert main_text(f'<article><p>Short of it.</p><div class="ad">{long}</div></article>') == "Short of it."
    assert main_text(f"<article>{post}</article><aside>{long}</aside><form hidden>{long}</form>") == f"{PROSE} {PROSE}"
    assert main_text("<div class=nav>" * 3000 + post) == f"{PROSE} {PROSE}"


def test_frame(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    got = extract_text(df).collect()
    assert [len(r.main_text) > 0 for r in got] == [True, True, False, False] and got[0].n_chars == "x"
    assert extract_text(df.where("false")).collect() == []
    with pytest.raises(ValueError):
        extract_text(extract_text(df))


def test_query_against_the_article_element(spark):
    """In the given pages the text is what the article element holds."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    rows = op4_html_extraction(spark, SF01).collect()
    assert len(rows) == len(pages)
    wrong = 0
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S).group(1)
        inner = re.sub(r"<[^>]*\Z", "", inner)
        want = " ".join(library.unescape(re.sub(r"</?(?:p|br|h1)[^>]*>", " ", inner).replace("<b>", "")).split())
        wrong += r.text != want
        assert r.n_chars == len(r.text)
    assert wrong == 0


def test_text_that_no_stop_word_list_fits():
    around = ("<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class=sidebar>More, more. And more.</div>", "<footer>All rights. Reserved.</footer>")
    russian = "Город стоял на берегу моря, и люди жили в нём давно. Каждое утро рыбаки выходили в море и возвращались вечером."
    for body, want in [
            (f"<div><h2>Новости</h2><p>{russian} {russian}</p><p>{russian}</p></div>", f"Новости {russian} {russian} {russian}"),
            (f"<div><p>{'町は海の近くにあった。人々は長い間そこに住んでいた。' * 8}</p></div>", "町は海の近くにあった。人々は長い間そこに住んでいた。" * 8),
            ("<div><p>" + "Ship arrives Tuesday. Crew tired. Captain sleeps. " * 6 + "</p></div>", ("Ship arrives Tuesday. Crew tired. Captain sleeps. " * 6).strip()),
            ("<div class=post-content><p>Quick update.</p><p>Server moved</p></div>", "Quick update. Server moved"),
            ("<pre>def f(x):\n  return x\n</pre>", "def f(x): return x"),
            ("<table><tr><td>Alpha</td><td>12</td></tr><tr><td>Beta</td><td>13</td></tr></table>", "Alpha 12 Beta 13")]:
        assert main_text(f"<body>{around[0]}{body}{around[1]}") == want
