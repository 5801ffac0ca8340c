"""Markup cases: ragged rows, broken tags, nesting, links, sections, selectors."""

import pytest
from pyspark.sql import functions as F

from millrace.sources.html import (
    anchors,
    detail_sections,
    next_page_link,
    select_first,
    select_items,
    table_headers,
    table_records,
)
from millrace.sources.lists import follow, item_parts, table_parts


def one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column).first()[0]


def records(spark, html, **kw):
    got = one(spark, html, table_records(F.col("html"), **kw))
    return [(r["row_no"], r["cells"], r["details_link"]) for r in got] if got is not None else None


def test_table(spark):
    html = """<div><table><tr><th> A </th><th>B<br>b</th></tr>
      <tr><td>1</td><td> x <i>y</i> </td></tr>
      <tr><td>short</td></tr>
      <tr><td>2</td><td><a href='/no'> Anmälan </a><a href='/d?x=1&amp;y=2'>Anmälan</a></td></tr></table>
      <table><tr><th>Z</th></tr><tr><td>9</td></tr></table>"""
    assert records(spark, html) == [
        (0, {"A": "1", "Bb": "xy"}, None),
        (1, {"A": "2", "Bb": "AnmälanAnmälan"}, "/d?x=1&y=2"),
    ]


def test_table_without_end_tags_and_none(spark):
    html = "<table><tr><th>A<th>B</tr><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4"
    # An unclosed title encloses the next one, so the first title's text is both.
    assert records(spark, html) == [(0, {"AB": "1", "B": "2"}, None), (1, {"AB": "3", "B": "4"}, None)]
    assert records(spark, "<p>no table") == []
    assert records(spark, "") == []
    assert records(spark, None) is None
    assert one(spark, "<table><tr><th>A</th></tr></table>", table_headers(F.col("html"))) == ["A"]
    assert one(spark, "<p>", table_headers(F.col("html"))) is None


def test_text_leaves_out_scripts_and_comments(spark):
    html = "<table><tr><th>A</th></tr><tr><td>a<!-- c --> b<script>var x='</td>';</script><style>p{}</style>&lt;</td></tr></table>"
    assert records(spark, html) == [(0, {"A": "ab<"}, None)]


def test_link_needs_the_exact_text(spark):
    html = "<table><tr><th>A</th></tr><tr><td><a href=/x><b>Mer</b></a><a>Info</a><a href=/y>Info</a></td></tr></table>"
    assert records(spark, html, link_label="Mer")[0][2] == "/x"
    assert records(spark, html, link_label="Info")[0][2] is None  # the first such anchor has no address


@pytest.mark.parametrize(
    "html, page, want",
    [
        ('<ul class="pagination"><a href="p?n=3">3</a></ul>', 2, "https://h/r/p?n=3"),
        ('<ul class="x pagination y"><a href="/q">Nästa</a></ul>', 2, "https://h/q"),
        ('<ul class="pagination"><a href="/q">4</a></ul>', 2, None),
        ('<ul class="paginations"><a href="/q">3</a></ul>', 2, None),
        ('<a href="/q">3</a>', 2, None),
    ],
)
def test_next_page(spark, html, page, want):
    df = spark.createDataFrame([(html, page)], "html string, page int")
    assert df.select(next_page_link(F.col("html"), F.col("page"), "https://h/r/")).first()[0] == want


def test_sections(spark):
    html = """<div class="detail-section"><h3> One </h3>
        <div class="row"><div class="label">k</div><div class="value">v1</div></div>
        <div class="row"><div class="label">k</div><div class="value">v2</div></div>
        <div class="row"><div class="label">lonely</div></div></div>
      <div class="detail-section"><div class="row">no title</div></div>
      <div class="detail-section big"><h3>Two</h3></div>"""
    assert one(spark, html, detail_sections(F.col("html"))) == {"One": {"k": "v2"}, "Two": {}}


def test_selectors(spark):
    html = """<table class='t'><tr><td><div class='item'><h3 class='a'>N1</h3><p><b>x</b></p></div></td></tr></table>
      <div class='item'><h3 class='a'>N2</h3><meta itemprop='d' content='2024'></div>"""
    fields = {"name": ".//h3[@class='a']/text()", "date": ".//meta[@itemprop='d']/@content", "p": "./p"}
    got = one(spark, html, select_items(F.col("html"), "//div[@class='item']", fields))
    assert got == [{"name": "N1", "date": None, "p": "x"}, {"name": "N2", "date": "2024", "p": None}]
    inside = one(spark, html, select_items(F.col("html"), ".//div", fields, "//table[@class='t']"))
    assert [r["name"] for r in inside] == ["N1"]
    assert one(spark, html, select_first(F.col("html"), "//h3[@class='a']/text()")) == "N1"
    with pytest.raises(ValueError):
        select_first(F.col("html"), "//a[contains(@x, 'y')]")


def test_a_selected_string_keeps_its_references_as_written(spark):
    html = "<head><title>a &quot;b&quot; &amp;amp; c&amp</title><p title='x&lt;y'>"
    assert one(spark, html, select_first(F.col("html"), "//head/title/text()")) == 'a "b" &amp; c&'
    assert one(spark, html, select_first(F.col("html"), "//head/title/text()", decode=False)) == "a &quot;b&quot; &amp;amp; c&amp"
    assert one(spark, html, select_first(F.col("html"), "//p/@title", decode=False)) == "x&lt;y"


def test_titles_equal_their_sql(spark, folder):
    import duckdb

    from contract import ORACLE, QUERIES

    titles = [
        "a &amp;amp; b", "cut off &amp", "&quot;quoted&quot; &#39;x&#39; &eacute;", "\u00a0 &nbsp;wide\u3000 ", "\ttab\n", "", "a < b",
        "R&D &amp; Co", "a<!-- n -->b",
    ]
    pages = [f"<!DOCTYPE html><html><head><title>{t}</title></head><body><h1>x</h1></body></html>" for t in titles]
    pages += ["<html><body>no title</body>", "<title>no head</title><p>x", "", None]
    rows = [(i, f"/{i}", html) for i, html in enumerate(pages)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    got = [tuple(r) for r in QUERIES["html_titles"](spark, folder).collect()]
    assert sorted(got) == sorted(con.sql(ORACLE["html_titles"]).fetchall())


def test_anchors(spark):
    got = one(spark, "<a href='/a?b&amp;c'>x <b>y</b></a><a name=q>no</a><a href>z</a>", anchors(F.col("html")))
    assert [tuple(r) for r in got] == [("/a?b&c", "xy"), ("", "z")]


def test_other_columns_do_not_pass_through_python(spark):
    df = spark.createDataFrame([(1, "wide", "<a href=x>y</a>")], "id int, other string, html string")
    plan = df.select("id", "other", anchors(F.col("html")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan


# --- lists over several pages -------------------------------------------------------------------------------


def listing(spark, rows):
    """``(feed, page, url, records, next)`` as landed pages."""
    made = [
        (feed, page, url, "<table><tr><th>K</th></tr>" + "".join(f"<tr><td>{url}{i}</td></tr>" for i in range(records)) + "</table>"
         + (f"<ul class=pagination><li><a href='{onward}'>Nästa</a></ul>" if onward else ""))
        for feed, page, url, records, onward in rows
    ]
    return spark.createDataFrame(made, "feed string, page long, url string, html string")


def places(frame, **options):
    found = follow(frame, table_parts(F.col("html"), F.col("url"), F.col("page"), base_url=""), F.col("page") == 1, **options)
    return sorted((r["feed"], r["place"], r["url"], len(r["records"])) for r in found.collect())


def test_lists_are_followed_by_their_links(spark):
    long = [("l", 1 if i == 1 else 50, f"p{i}", 1, f"p{i + 1}") for i in range(1, 100)]
    frame = listing(spark, [
        *long, ("a", 1, "a1", 2, "a9"), ("a", 9, "a9", 1, "a5"), ("a", 5, "a5", 0, "a6"), ("a", 6, "a6", 3, None),  # ends without records
        ("b", 1, "b1", 1, "b2"), ("b", 2, "b2", 1, "b3"), ("b", 3, "b3", 1, "b2"),  # a ring
        ("c", 1, "c1", 1, "gone"), ("d", 1, "d1", 0, "d2"), ("d", 2, "d2", 1, None), ("e", 2, "e2", 1, None),  # not landed; empty; no first page
        ("f", 1, "a1", 1, "a9"), ("g", 1, None, 1, "x"), (None, 1, "n1", 1, "n2"), (None, 2, "n2", 1, None),
    ])
    got = places(frame.filter("feed IS NOT NULL"))
    assert [g[:3] for g in got if g[0] != "l"] == [
        ("a", 1, "a1"), ("a", 2, "a9"), ("b", 1, "b1"), ("b", 2, "b2"), ("b", 3, "b3"), ("c", 1, "c1"), ("f", 1, "a1"),
    ]
    assert [g for g in got if g[0] == "l"] == [("l", i, f"p{i}", 1) for i in range(1, 100)]
    assert [r["url"] for r in follow(
        frame.filter("feed IS NULL"), table_parts(F.col("html"), F.col("url"), F.col("page"), ""), F.col("page") == 1).sort("place").collect()
    ] == ["n1", "n2"]
    assert places(frame.filter("feed = 'l'"), max_pages=3) == [("l", i, f"p{i}", 1) for i in (1, 2, 3)]
    assert places(frame.limit(0)) == []


def test_a_page_landed_twice_counts_once(spark):
    frame = listing(spark, [("a", 1, "u1", 1, "u2"), ("a", 2, "u2", 1, "u3"), ("a", 2, "u2", 2, "u4"), ("a", 3, "u3", 1, None), ("a", 3, "u4", 1, None)])
    frame = frame.withColumn("visit", F.length("html"))
    assert places(frame, sequence="visit") == [("a", 1, "u1", 1), ("a", 2, "u2", 2), ("a", 3, "u4", 1)]


def test_lists_parse_markup_once_and_without_it_in_joins(spark):
    frame = listing(spark, [("a", 1, "u1", 1, "u2"), ("a", 2, "u2", 1, None)])
    listed = follow(frame, table_parts(F.col("html"), F.col("url"), F.col("page"), ""), F.col("page") == 1)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "html" not in listed.columns
    declared = item_parts(F.col("html"), F.col("url"), "//tr/td", {"v": "./text()"}, "//ul/li/a/@href", base_url="")
    rows = follow(frame, declared, F.col("page") == 1).select("place", F.inline(F.transform("records", lambda r: F.struct(r["v"].alias("v")))))
    assert sorted(map(tuple, rows.collect())) == [(1, "u10"), (2, "u20")]
