"""Web pages as odd as the generator's cuts make them, against the SQL of their queries."""

import duckdb
import pytest
from lexmill.plans.catalogue import ORACLES, QUERIES
from lexmill.sources.xml_nodes import parse_html

_PAGE = '<!DOCTYPE html><html><head><title>{0}</title><script>var t="&quot &amp;";</script></head><body><nav><ul><li><a href="/x">{1}</a></li><li><a href="/y">y</a></li></ul></nav><article><h1>{0}</h1><p>{2}</p></article><footer>&copy; h &middot; f</footer></body></html>'
_PAGES = [
    ("token = &quot", "Are", "<b>token = &quot;9c44&quot; whole<br>"),  # as page 16468 of the check tool's large table
    *((f"a&amp;&amp;{cut}", "n", f"b{cut}") for cut in ("&", "&a", "&am", "&amp", "&q", "&quo", "&quot", "&copy", "&middot", "&#39", "&quotx;", "&nosuch;", "&ampx")),
    ("one two", "n ", "in <b> bold </b>text<i> and</i> more"),
    ("a\u00a0 b\u3000c", "n\t", "\u3000x\u00a0\n y\u2003"),
    ("目錄 of all", "n", "text"),
]


@pytest.mark.parametrize("name", ["render_markdown", "html_text"])
def test_pages_equal_sql(spark, tmp_path, name):
    pages = list(enumerate(_PAGE.format(*p) for p in _PAGES))
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    sql = duck.sql(ORACLES[name])
    got = QUERIES[name](spark, str(tmp_path)).select(*sql.columns).collect()
    assert sorted(map(tuple, got)) == sorted(sql.fetchall())


def test_text_behind_scripts_stays(spark, tmp_path):
    spark.createDataFrame([(1, "<p>a<script>no</script> b<style>no</style>c</p><script>no</script>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert [r.markdown for r in QUERIES["render_markdown"](spark, str(tmp_path)).collect()] == ["a bc"]


def test_references_by_their_ends():
    page = '<p t="?a=1&copy=2&amp;b" u="&lt;">&lt;&#233;&hellip; &lt &#233 &hellip &amp &amp;quot; \ufdd00\ufdd1<br>&</p><script>a &&quot; b</script>'
    p, script = parse_html(page)
    assert p.attrib == {"t": "?a=1&copy=2&b", "u": "<"}
    assert (p.text, p[0].tail) == ("<é… &lt &#233 &hellip & &quot; \ufdd00\ufdd1", "&")
    assert script.text == "a &&quot; b"
