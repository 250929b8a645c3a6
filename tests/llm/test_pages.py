import random
from itertools import product

import duckdb
import pytest

from waybill.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header class="site"><a href="/">Logo</a> Site</header><nav><ul><li><a>Home</a><li><a>About</a></ul></nav><div class="cookie-notice">We use cookies. Accept?</div>
<div id="content"><h1>Title &amp; more</h1><p>First <b>para with <a href=x>a link</a> in it, and words enough.<p>Second&nbsp;one &#233; &lt;b&gt;
 on two lines, long enough to count.<div class="adSlot">Buy now, cheap!</div><blockquote>Quoted prose, indeed.</blockquote><form><input>Your mail: <button>Go</button></form>
<ul><li>Point one of the list.</li><li>Point two of the list.</ul><!-- <p>not shown</p> --><section id="comments"><h2>Comments</h2><p>Great article, I loved every bit of it, thanks!</p></section></div>
<aside><h3>Related</h3><p>Another story about things, long enough.</p></aside><footer>&copy; 2024</footer>"""
TEXT = ["Title & more", "First para with a link in it, and words enough.", "Second one é <b> on two lines, long enough to count.", "Quoted prose, indeed.", "Point one of the list.", "Point two of the list."]


def test_main_text():
    assert pages.content(PAGE, pages.PLAIN) == TEXT


@pytest.mark.parametrize("page, text", [("", []), ("<p>", []), ("just text, with as many words in it as prose may have.", ["just text, with as many words in it as prose may have."]), ("<article><p>One. Two.</article><nav>x", ["One. Two."]), ("<article><header><h1>Head line</h1></header><p>Body text.</p><p class=notice>Sign up</p><p>More text.</p></article>", ["Head line", "Body text.", "More text."]), ("<main><p>a<br>b</p></p></div>c</main><footer>f</footer>", ["a b", "c"]), ("<article><p>a < b & c</p><script>x", ["a < b & c"])])
def test_broken_markup(page, text):
    assert pages.content(page, pages.PLAIN) == text


def test_cut_is_minimal():
    r = random.Random(1)
    for _ in range(150):
        n = r.randrange(1, 9)
        scores = [r.choice([-3, -1.5, 0, 1, 2.5]) for _ in range(n)]
        edges = [(a, b, r.choice([0.3, 1.0, 2.0])) for a in range(n) for b in range(a + 1, n) if r.random() < 0.4]
        cost = lambda side: sum(s for s, x in zip(scores, side, strict=True) if s > 0 and not x) - sum(s for s, x in zip(scores, side, strict=True) if s < 0 and x) + sum(c for a, b, c in edges if side[a] != side[b])  # noqa: B023, E731
        assert cost(pages.minimum_cut(scores, edges)) == pytest.approx(min(map(cost, product([False, True], repeat=n))))


def test_rows(spark):
    rows = [(1, "u", PAGE, "c"), (2, None, None, "c"), (None, "v", "", "c"), (1, "u", PAGE, "c"), (3, "w", "<p>" + "word " * 50000, "c")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [tuple(r) for r in pages.extracted(docs, pages.learn(docs)).collect()]
    text = "\n\n".join(TEXT)
    assert got[:4] == [(1, "u", text, len(text)), (2, None, "", 0), (None, "v", "", 0), (1, "u", text, len(text))] and got[4][3] == 249999
    assert pages.extracted(docs.limit(0), pages.learn(docs.limit(0))).count() == 0


def test_generated_pages(spark):
    import html
    import re

    docs = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in pages.extracted(docs, pages.learn(docs)).collect()}
    for i, page in duckdb.sql("select page_id, html from '/root/testdata/sf0.001/pages.parquet'").fetchall():
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner))
        assert got[i] == "\n\n".join(filter(None, parts))
