"""The page table: intervals, implied end tags, text nodes, scripts; time; selectors; the bucketed store."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import vitrine as v
from vitrine.functions import elements as E
from vitrine.functions import page_parser as P


def parsed(html):
    return P.parse(pa.array([html])).to_pylist()[0]


def texts(html):
    return [t["text"] for t in parsed(html)["texts"]]


def within(html, tag):
    """Texts inside each element of a name."""
    page = parsed(html)
    return ["|".join(t["text"] for t in page["texts"] if e["inner"] <= t["at"] < e["end"]) for e in page["elements"] if e["tag"] == tag]


@pytest.mark.parametrize("html, tag, want", [
    ("<ul><li>a<li>b<ul><li>c<li>d</ul>e<li>f</ul>g", "li", ["a", "b|c|d|e", "c", "d", "f"]),
    ("<p>a<p>b<b>c</b><div>d</div>e", "p", ["a", "b|c"]),
    ("<p>a<span>b<p>c</span>d", "p", ["a|b", "c|d"]),
    ("<table><tr><td>1<td>2<tr><td>3<table><tr><td>4</table>5</table>6", "td", ["1", "2", "3|4|5", "4"]),
    ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "dd", ["b", "d"]),
    ("<select><option>a<option>b</select>", "option", ["a", "b"]),
    ("<div>a</section>b</div>c", "div", ["a|b"]),
    ("<div>a<table><tr><td>b</div>c</td></tr></table>d</div>e", "div", ["a|b|c|d"]),
    ("<button><p>a<button><p>b</button>c</button>d", "p", ["a|b|c", "b"]),
    ("<div>a<br>b<img src=x>c<div>d", "div", ["a|b|c|d", "d"]),
    ("<DIV>a<Div>b</DIV>c</div>d", "div", ["a|b|c", "b"]),
    ("<p>a", "p", ["a"]),
])
def test_intervals_and_implied_end_tags(html, tag, want):
    assert within(html, tag) == want


def test_intervals_nest_or_lie_apart():
    rnd = random.Random(4)
    parts = ["<div>", "</div>", "<p>", "</p>", "<li>", "</li>", "<ul>", "</ul>", "<td>", "<tr>", "<table>", "</table>", "<b>", "</b>", "x", " ", "<br>",
             "<!-- <p> -->", "<script>if(a<b)</script>", "<", ">", "&amp;", "<option>", "<button>", "</button>", "</td>", "<a href='>'>"]
    for _ in range(3000):
        page = parsed("".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))))
        open_ = []
        for e in page["elements"]:
            assert e["start"] < e["inner"] <= e["end"]
            while open_ and open_[-1] <= e["start"]:
                open_.pop()
            assert e["depth"] == len(open_) and (not open_ or e["end"] <= open_[-1])
            if e["end"] > e["inner"] or e["tag"] not in P.VOID:
                open_.append(e["end"])


def test_attributes():
    got = parsed("""<a HREF="/x?a=1&amp;b=2" class='c d' data-x=y disabled title = "5 > 4 <b>" href=second empty="">""")["elements"][0]["attributes"]
    assert dict(got) == {"href": "/x?a=1&b=2", "class": "c d", "data-x": "y", "disabled": "", "title": "5 > 4 <b>", "empty": ""}
    assert parsed('<a title="5" tall">lnk</a> mid')["elements"][0]["attributes"][0] == ("title", "5")


def test_texts_and_scripts():
    html = ("<p>\n a &nbsp;</p>&nbsp;<b>x<!-- y -->z</b><style>s</style><script>var a='<p>';</script><template><p>t</p></template>"
            "<script type='application/ld+json'> {\"a\": \"</p>\"} </script><script type=module>m</script><script type='text/x'>q")
    page = parsed(html)
    assert [t["text"] for t in page["texts"]] == ["a", "x", "z"]
    assert [(s["type"], s["text"]) for s in page["scripts"]] == [("application/ld+json", ' {"a": "</p>"} ')]  # the last one never ends
    assert texts("a < b <c") == ["a < b", "<c"] or texts("a < b <c") == ["a < b <c"]
    assert parsed(None) == parsed("") == {"elements": [], "texts": [], "scripts": []}


def test_batches_are_cut_without_loss(monkeypatch):
    pages = [f"<p id=a{i}>{i}" * (i % 5) for i in range(50)]
    whole = P.parse(pa.array(pages)).to_pylist()
    monkeypatch.setattr(P, "SLICE", 20)
    assert P.parse(pa.array(pages)).to_pylist() == whole == [parsed(p) for p in pages]


@pytest.mark.parametrize("html", [
    "<div>x" * 50_000 + "</section>" * 50_000, "<div>" * 30_000 + "<p>" * 30_000 + "</p>" * 30_000, "<a b=" * 100_000, '<a title="' * 100_000,
    "<!--" * 100_000, "<script>" * 100_000, "<a x='>'" * 60_000, "<p><button>" * 30_000 + "<p>" * 30_000, "<!x" * 100_000, "<li>" * 100_000,
])
def test_time_is_linear(html):
    start = time.time()
    parsed(html)
    assert time.time() - start < 12


def test_selectors_over_elements(spark):
    html = ('<ul><li class="price">10,90 €<li class="x price y">99,90 €</ul><h1 class="t">n<b>m</b></h1><meta property="og:title" content="A &amp; B">'
            '<ol class="crumbs"><li>a<li><b>c</b> d</ol><i class="swatch size"></i><i class="swatch"></i>')
    page = spark.createDataFrame([(html,)], "html string").select(E.page_table(F.col("html")).alias("page"))
    col, price = F.col("page"), E.any_of(E.tag(E.word("class", "price")))
    got = page.select(
        E.zone_text(col, price), E.count(col, price), E.joined_text(col, E.any_of(E.tag(name="h1"))), E.meta(col, "og:title"),
        E.list_texts(col, E.any_of(E.tag(E.has("class", "crumb"), name="ol")), "li"),
        E.count(col, E.any_of(E.tag(E.has("class", "swatch"), E.lacks("class", "size")))),
        E.zone_text(col, E.any_of(E.tag(E.equals("class", "none")))), E.all_text(col)).first()
    assert tuple(got) == ("10,90 €", 2, "nm", "A & B", ["a", "cd"], 1, None, "10,90 € 99,90 € n m a c d")
    assert page._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_page_store_is_joined_bucket_by_bucket(spark):
    rows = [(f"https://s/{i}" + ("?q" if i % 3 == 0 else ""), f"<p>{i}") for i in range(40)] + [("https://s/1?x", "<p>copy")]
    pages = spark.createDataFrame(rows, "url string, html string")
    links = spark.createDataFrame([(f"https://s/{i}", i) for i in range(0, 60, 2)] + [("https://s/1", 1)], "url string, pos int")
    store = v.bucket_pages(pages, "test_pages_store", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        found = v.linked_pages(store, links).select("url", "html")
        want = v.linked_pages(pages, links)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].split("\n")
        scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "html" in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
        at = depth(plan[scan])
        for line in reversed(plan[:scan]):
            if depth(line) < at:
                at = depth(line)
                assert "Exchange" not in line, line
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    mine = v.attach_pages(links, store).select("url", "pos", "html")
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, v.attach_pages(links, pages).select("url", "pos", "html").collect()))
    assert v.frontier(links, store).count() == v.frontier(links, pages).count() == 10
    spark.sql("DROP TABLE test_pages_store")
