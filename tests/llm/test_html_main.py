"""Main text against pages that are put together here, so the article is known; marks that are broken, long, empty."""

import html
import random

import pytest
from lexmill.llm import html_main

WORDS = "wind river stone house light winter garden letter market bridge silver morning paper window".split()


def sentence(rng, n=12):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def article(rng):
    return ["Of " + sentence(rng, 4), *(sentence(rng, rng.randint(12, 60)) for _ in range(rng.randint(1, 8)))]


def blocks(parts, rng):
    """Title and paragraphs with inline marks, unclosed elements, references, and white space of all kinds."""
    out = [f"<h1>{html.escape(parts[0])}</h1>"]
    for p in parts[1:]:
        w = html.escape(p).split(" ")
        w[1] = f"<b>{w[1]}</b>"
        w[2] = f'<a href="/x">{w[2]}</a>'
        out.append(f"<p>{rng.choice([' ', chr(10), '&#32;'])}" + rng.choice(["\n ", "  ", "&nbsp; "]).join(w) + rng.choice(["</p>", "", "<br></p>"]))
    return "".join(out)


SITES = {
    "a.example": '<body><header><a href="/">Site</a></header><nav><ul><li><a href="/1">One</a></ul></nav><div class="ad">Buy now, buy cheap.</div><article>{}</article><footer>&copy; all</footer></body>',
    "b.example": '<body><div id="top-menu"><a href=/>Home</a></div><div class="wrap-7"><div class="text c3">{}</div><div class="x9">Buy our goods while they last</div></div><div id="comments"><p>First! A reader says a lot of things here.</p></div></body>',
    "c.example": '<body><main><section class="part">{}</section><aside><p>Read also this long and winding text about other things.</p></aside></main><div role="dialog"><p>We use cookies</p></div>',
    "d.example": '<body><table><tr><td class=side-bar>Links<td class="body">{}</table><div class="footer-links">imprint</div>',
    "e.example": '<BODY><form><p>Search<input></form><DIV CLASS="post has-comments"><div class="entry-header">By a writer</div>{}<div class="share">Share</div><section class="comment-list"><article class="comment"><p>Well said, sir.</p></article></section></DIV></BODY>',
}
OWN = {"e.example": "By a writer "}


def pages():
    rng, out = random.Random(4), []
    for host, site in SITES.items():
        for k in range(12):
            parts = article(rng) if k else ["Tiny", "One."]  # a page whose article is shorter than what stands around it
            head = '<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><article>"</script></head><!-- <p>no</p> -->'
            body = site.format(blocks(parts, rng) if k else f"<h1>{parts[0]}</h1><p>{parts[1]}")
            out.append((len(out), f"https://{host.upper() if k % 2 else host}/p/{k}", head + body, OWN.get(host, "") + " ".join(parts)))
    return out


def test_extraction(spark):
    rows = pages()
    d = spark.createDataFrame([(i, u, h, "t", 3) for i, u, h, _ in rows], "page_id long, url string, html string, text string, host_path int")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in html_main.op12(d).collect()}
    for i, u, _, want in rows:
        assert got[i] == (u, want, len(want)), u
    votes = {r.host: (r.path, r.votes, r.n_pages) for r in html_main.winning_paths(d).collect()}
    assert votes["b.example"][0] == "body>div.wrap-#>div.c#.text" and votes["b.example"][2] == 12 and votes["a.example"][0] == "body>article"
    shuffled = html_main.SMALL_BYTES
    try:
        html_main.SMALL_BYTES = 0  # winners joined by a shuffle
        assert {r.page_id: (r.url, r.text, r.n_chars) for r in html_main.op12(d).collect()} == got
    finally:
        html_main.SMALL_BYTES = shuffled


ODD = [
    (None, ""), ("", ""), ("plain  text\n only", "plain text only"), ("<p>a &amp b &lt;c&gt; &am", "a & b <c> &am"), ("<nav>menu</nav>", ""), ("<p>1 < 2 and <3</p>", "1 < 2 and <3"),
    ("<p>one<p>two<li>three<li>four", "one two three four"), ("<p class=\"a>b\" title='<p>'>in</p>", "in"), ("<p>cut <a href=\"x", "cut"), ("<!-- open", ""), ("<script>open", ""),
    ("<p>x</p><script>var a = '<p>no</p>';</script><p>y<style>z</style>w</p>", "x y w"), ("a<b>b</b>c<div>d</div>e", "abc d e"), ("<p> 　 x&nbsp;y\t</p>", "x y"),
    ("<p>&#x41;&#66;&eacute;&hellip;</p>", "ABé…"), ("<p hidden>no</p><p style='display: none'>no</p><p>yes <span class='ad'>no</span>yes</p>", "yes yes"),
    ("<article>" * 3000 + "deep" + "</article>" * 3000, "deep"), ("<p>" + "long text " * 100_000, ("long text " * 100_000).strip()), ("<div>" * 5000 + "<p>x", "x"),
]


def test_odd_pages(spark):
    d = spark.createDataFrame([(None if i == 2 else min(i, 9), None if i % 2 else "no url", h) for i, (h, _) in enumerate(ODD)], "page_id long, url string, html string")
    got = html_main.op12(d).collect()
    assert [r.text for r in got] == [w for _, w in ODD] and [r.page_id for r in got] == [r.page_id for r in d.collect()]
    assert html_main.op12(d.limit(0)).collect() == []


@pytest.mark.parametrize("n", [3, 2000])
def test_quotes_and_brackets_take_linear_time(n):
    import time

    began = time.time()
    html_main.main_text("<p a='\"" * n + "<" * n + "<!-" * n + "</" * n + "&" * n, None)
    assert time.time() - began < 5


def test_tables_of_the_data_folder(spark):
    import os
    import re

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no data")
    d = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in html_main.op12(d).collect()}
    for r in d.collect():
        inner = re.search("<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        assert got[r.page_id] == " ".join(html.unescape(re.sub(r"<(/?(p|h1|li|ul|div))\b[^>]*>|<br>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
