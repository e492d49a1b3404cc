from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dimflow.llm import html

SCHEMA = "page_id long, url string, html string"


def blocks(source):
    return [text for text, _ in html.Page(source).blocks]


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a &amp; b&nbsp;c<p>d &lt;e&gt;", ["a & b c", "d <e>"]),
        ("<nav>x</nav><article><h1>T</h1><p><b>one<br>two</p></article><footer>f</footer>", ["T", "one two"]),
        ("<p>out</p><main><p>in</p><div class='post-comments'><p>no</p></div></main>", ["in"]),
        ("<article><p>a</p><aside>no</aside><form><p>no</p></form><p>b</p><p hidden>no</p></article>", ["a", "b"]),
        ("<style>p{}</style><script>var t='</p>';</script><p>x</p><!-- <p>no</p> -->", ["x"]),
        ("<article><ul><li>one<li>two</ul>3 < 4 and 5 > 4</article>", ["one", "two", "3 < 4 and 5 > 4"]),
        ("<article><a title='a>b' href=x>link</a> text", ["link text"]),
        ("<p>open <b>bold<p>next</b> still", ["open bold", "next still"]),
        ("</div></p>stray", ["stray"]),
        ("<article><p>no end<script>x", ["no end"]),
        ("a<b", ["a<b"]),
    ],
)
def test_blocks(source, expected):
    assert blocks(source) == expected


@pytest.mark.parametrize("source", ["<" * 100_000, "<a " * 50_000, "<div>" * 20_000 + "x", "<p>" * 50_000, "<!--" * 50_000, "</p>" * 50_000])
def test_odd_pages_take_linear_time(source):
    html.Page(source)


def pages(n, body):
    return [(i, f"http://www.a.example/{i}", f"<title>t{i}</title><body>{body(i)}</body>") for i in range(n)]


def test_what_a_site_repeats_is_removed(spark):
    rows = pages(6, lambda i: f"<div><p>Read our <i>terms</i></p></div><section><p>text {i}</p><p>same</p></section><div>All rights</div>")
    rows += [(50, "http://b.example/", "<body><div>All rights</div><p>alone</p></body>")]
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i: f"text {i}" for i in range(6)} | {50: "All rights\nalone"}


def test_running_text_of_articles_and_copies_of_a_page_stay(spark):
    rows = pages(6, lambda i: f"<article><p>common passage</p><p>text {i}</p><div><p>promoted</p></div></article>")
    rows += [(100 + i, f"http://c.example/{i}", "<title>one</title><div><p>a copy</p></div>") for i in range(8)]
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i: f"common passage\ntext {i}" for i in range(6)} | {100 + i: "a copy" for i in range(8)}


def test_missing_values_repeated_rows_and_clashing_columns(spark):
    rows = [(1, None, None), (2, "http://x/", ""), (3, None, "<p>x"), (3, None, "<p>x"), (None, "y", "<p>y")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit("clash")).withColumn("subtree", F.lit(1))
    found = html.extract(df)
    assert found.columns == ["page_id", "url", "subtree", "text"]
    assert sorted((r["page_id"] or 0, r["text"]) for r in found.collect()) == [(0, "y"), (1, ""), (2, ""), (3, "x"), (3, "x")]
    assert html.extract(df.filter("page_id > 99")).count() == 0


def test_host(spark):
    urls = ["https://www.A.com:80/x", "http://u:p@b.org", "//c.net?q", "nothing", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(html.host(F.col("u"))).collect()] == ["a.com", "b.org", "c.net", "", ""]


def extracted(spark, rows):
    return {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_pages_are_told_by_content_not_by_title(spark):
    menu = "<div><p>Home Products</p></div>"
    rows = [(i, f"http://a.example/{i}", f"{menu}<section>text {i}</section>") for i in range(5)]
    rows += [(10 + i, f"http://b.example/{i}", f"<title>Site</title>{menu}<section>text {i}</section>") for i in range(5)]
    rows += [(20 + i, f"http://c.example/{i}", f"<title>t{i}</title><div><section>one article</section></div>") for i in range(5)]
    expected = {i: f"text {i}" for i in range(5)} | {10 + i: f"text {i}" for i in range(5)} | {20 + i: "one article" for i in range(5)}
    assert extracted(spark, rows) == expected


def test_a_section_of_a_large_host_is_template_from_a_fixed_number_of_pages(spark):
    aside = "<div><p>In this section</p></div>"
    rows = [(i, f"http://a.example/{i}", f"{aside if i < 12 else ''}<section>text {i}</section>") for i in range(1000)]
    assert extracted(spark, rows) == {i: f"text {i}" for i in range(1000)}


def test_marks_and_teasers_do_not_take_the_main_text(spark):
    rows = [(0, "http://a.example/0", "<div>long body</div><article>teaser</article>")]
    names = ("layout has-sidebar", "content no-sidebar", "open-comments", "right-side", "sidebar")
    rows += [(1 + i, f"http://a.example/{i}", f'<div class="{n}"><article>text {i}</article></div>') for i, n in enumerate(names)]
    rows += [(6 + i, f"http://a.example/x{i}", f'<div class="{n}"><p>plain {i}</p></div>') for i, n in enumerate(names)]
    rows += [(20, "http://b.example/", '<article><div class="entry-header"><h1>Head</h1></div><p class="header">lead</p>body</article>')]
    rows += [(21, "http://c.example/", '<form><div class="ad">buy</div><main>text</main></form><footer>no</footer>')]
    found = extracted(spark, rows)
    assert found[0] == "long body\nteaser" and found[20] == "Head\nlead\nbody" and found[21] == "text"
    assert [found[1 + i] for i in range(10)] == [f"text {i}" for i in range(5)] + [f"plain {i}" for i in range(5)]
