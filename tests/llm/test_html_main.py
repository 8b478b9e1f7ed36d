import html
import re

import pytest

from recsift.llm import html_main, queries
from tests.llm.brute import SF, table

P = "A first paragraph, with commas, and enough words to be counted as text of the page. "


def plain(page):
    """The article of the test tables' pages, by pattern: their template is known."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(x for x in parts if x)


def test_query_finds_every_article(spark):
    got = {r.page_id: r for r in queries.QUERIES["op6_html_main"](spark, SF).collect()}
    pages = table("pages", "page_id, url, html")
    assert len(got) == len(pages)
    for i, url, h in pages:
        assert (got[i].text, got[i].url, got[i].n_chars) == (plain(h), url, len(plain(h)))


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""), ("<script>x</script>", ""), ("just text &lt;b&gt; &am &amp", "just text <b> &am &"),
    (f"<body><nav><a href=x>menu</a></nav><div><p>{P}<p>{P}</div><div class='comments'><p>{P}</div><aside>{P}</aside></body>", f"{P.strip()}\n{P.strip()}"),
    (f"<div id=main><h2>Title</h2><p>{P}</p><ul><li>one<li>two</ul><pre>  x\n y</pre></div><footer>f</footer>", f"Title\n{P.strip()}\none\ntwo\nx y"),
    (f"<article><header><h1>T</h1></header><p>{P}</p><form>f</form><div class=ad>buy</div></article><div class='cookie-notice'>{P * 4}</div>", f"T\n{P.strip()}"),
    (f"<table><tr><td><a href=x>{P}</a><td>{P}{P}</table>", (P * 2).strip()),
    (f"<article><p>a<b>b</p>c<br>d <!-- no --><style>s</style></article>", "ab\nc d"),
    (f"<body><nav>menu</nav><div class='content no-sidebar'><h1>T</h1><p>{P}</p></div></body>", f"T\n{P.strip()}"),
    (f"<body><div class='post-header'><h1>T</h1><p>{P}</p><p>{P}</p></div><footer>f</footer></body>", f"T\n{P.strip()}\n{P.strip()}"),
    ("<body><div>" + f"<div><p>{P * 3}</p></div>" * 10 + "<div><p>The end.</p></div></div></body>", "\n".join([(P * 3).strip()] * 10 + ["The end."])),
    (f"<article><p>{P}</p><section class='related-work'><p>{P}</p></section><div class='social-policy'><p>{P}</p></div></article>", "\n".join([P.strip()] * 3)),
    (f"<body><div><p>{P}</p></div><div class='left-sidebar'>{P}</div><div class='siteFooter'>{P}</div><div><a href=x>{P}</a></div></body>", P.strip()),
    ("<div>" * 3000 + P + "</div>" * 3000, P.strip()),
])
def test_pages(page, text):
    assert html_main.main_text(page) == text


def test_time_grows_with_the_page_alone():
    import time
    deep = "<body>" + f"<div><p>{P}</p>" * 20_000 + "</div>" * 20_000
    began = time.perf_counter()
    assert html_main.main_text(deep).count("\n") > 10 and time.perf_counter() - began < 20


def test_edge_rows(spark):
    rows = [(None, None, None, "x"), (1, "u", "", "x"), (1, "u", f"<p>{P * 20_000}", "x"), (1, "u", "<p>é&nbsp;è", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_main.extract(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 3, len((P * 20_000).strip())]
    assert html_main.extract(df.limit(0)).collect() == []
