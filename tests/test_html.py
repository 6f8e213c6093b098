from pyspark.sql import functions as F

import vitrine as v
from vitrine.functions import html as H
from vitrine.functions import jsonld as J
from vitrine.functions.once import let, nonblank
from vitrine.functions.text import markup

PRICE = H.any_of(H.tag(H.word("class", "price")), H.tag(H.has("class", "price-box")))


def test_element_follows_nesting(value):
    html = "<div><DIV class='a price'><div>1</div><div>2<div>3</div></div></DIV><div>4</div></div>"
    assert value(html, lambda s: H.zone_text(s, PRICE)) == "1 2 3"


def test_element_absent_unclosed_and_empty(value):
    assert value("<p class='prices'>1</p>", lambda s: H.zone_text(s, PRICE)) is None
    assert value("<p class=price>1 <b>2</b>", lambda s: H.zone_text(s, PRICE)) == "1 2"
    assert value('<meta class="price"><p>1</p>', lambda s: H.zone_text(s, PRICE)) == ""


def test_first_in_page_order_whatever_the_branch(value):
    assert value('<i class="my-price-box">a</i><i class="price">b</i>', lambda s: H.zone_text(s, PRICE)) == "a"


def test_attribute_forms(value):
    read = lambda s: H.attribute(s, "href")
    assert value('<a href="/x?a=1&amp;b=2" class="c">', read) == "/x?a=1&b=2"
    assert value("<a class='c' href = '/it\"s'>", read) == '/it"s'
    assert value("<a href=/x/y>", read) == "/x/y"
    assert value('<a data-href="/n">', read) == ""
    assert value('<a href="">', read) == ""


def test_swatch_counting(value):
    swatch = (H.has("class", "swatch"), H.lacks("class", "size"))
    count = lambda s: H.count_tags(s, H.any_of(H.tag(*swatch)))
    assert value('<i class="swatch"></i><i class="swatch size"></i><b class="x-swatch-y">', count) == 2
    others = H.any_of(H.tag(name="li", except_all=swatch))
    assert value('<li><li class="swatch"><li class="swatch-size"><LI>', lambda s: H.count_tags(s, others)) == 3


def test_elements_of_two_zones(value):
    zone = H.any_of(H.tag(H.has("data-attr", "color")))
    html = '<div data-attr="color"><b>1</b></div><b>2</b><div data-attr="color"><b>3</b></div>'
    texts = value(html, lambda s: F.transform(H.elements(s, zone), v.visible_text))
    assert texts == ["1", "3"]


def test_list_texts_without_closing_tags(value):
    zone = H.any_of(H.tag(H.has("class", "crumb"), name="ol"))
    assert value('<ol class="crumbs"><li>a<li><b>c</b> d</ol><li>e', lambda s: H.list_texts(s, zone, "li")) == ["a", "cd"]


def test_meta(value):
    html = "<meta content='A &amp; B | C' property=\"og:title\"><meta property='og:title' content='second'>"
    assert value(html, lambda s: H.meta(s, "og:title")) == "A & B | C"


def ld(*blocks):
    return "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks)


def test_blocks_skip_broken_and_flatten_lists(spark):
    html = ld('{"@type":"A"}', "", " { broken", '[{"@type":"B"}, 7, "s", [1]]', '{"@type":"C"} trailing', "3", ' {"n": 1} ')
    pages = spark.createDataFrame([("u", html)], "url string, html string")
    rows = v.json_ld_blocks(pages).orderBy("block_no").collect()
    assert [(r.block_no, r.type) for r in rows] == [(0, "A"), (1, "B"), (2, None)]
    rows = v.json_ld_blocks(pages, flatten_lists=False).orderBy("block_no").collect()
    assert [r.type for r in rows] == ["A", None]


def test_pick_block(spark):
    html = ld('{"@type":"P","n":1}', '{"@type":"Q"}', '{"@type":"P","n":2}')
    pages = spark.createDataFrame([("u", html), ("u", ld('{"@type":"P","n":3}')), ("w", "<p>")], "url string, html string")
    read = lambda which: v.pick_block(pages, "P", which).select(
        "url", F.try_variant_get("block", "$.n", "int").alias("n")).collect()
    assert [tuple(r) for r in read("first")] == [("u", 1), ("u", 3)]  # two stored copies of a page are not mixed
    assert [tuple(r) for r in read("last")] == [("u", 2), ("u", 3)]


def test_truthy_follows_the_json_type(value):
    read = lambda s: J.truthy(F.try_parse_json(s), "$.p")
    for text, want in (
        ('{"p":39.90}', "39.9"), ('{"p":"39.90"}', "39.90"), ('{"p":0}', None), ('{"p":0.0}', None), ('{"p":"0"}', "0"),
        ('{"p":""}', None), ('{"p":null}', None), ('{"p":false}', None), ('{"p":"false"}', "false"), ("{}", None),
    ):
        assert value(text, read) == want, text


def test_attributes_in_one_scan_are_those_of_each_tag(spark):
    pages = ['<a href="/a?x&amp;y" class=z>', "<A\n class='q'\thref = '/b'>x</A><a>", "<a href=/c/d><a HREF='/e'><a hrefx='1' href=''>",
             "<a data-href='/n' href='/f'>", '<a href="/open>text<a href="/g">', "<a href=><a href='/it\"s'>", "<area href='/h'><a  href>", None, ""]
    anchor = H.any_of(H.tag(name="a"))
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    rows = df.select(
        H.attributes(F.col("html"), anchor, "href").alias("once"),
        F.transform(H.all_tags(F.col("html"), anchor), lambda t: H.attribute(t, "href")).alias("each"))
    got = rows.collect()
    assert [r.once for r in got] == [r.each for r in got]
    assert got[0].once == ["/a?x&y"] and got[2].once == ["/c/d", "", ""] and got[4].once == ["/open>", "/g"]


def test_let_is_no_element_of_an_array(spark):
    """Such an element works out the type of its whole body for every row."""
    df = spark.range(3).select(let(F.col("id"), lambda x: x + x).alias("twice"), nonblank(F.col("id").cast("string")).alias("text"))
    assert [(r.twice, r.text) for r in df.collect()] == [(0, "0"), (2, "1"), (4, "2")]
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "transform(" not in plan and "filter(" not in plan


ANCHOR = H.any_of(H.tag(name="a"))
TIDY = [
    "", "text = 1", "<p>no anchor</p>", '<a>x</a><a name="top">y</a><a title="un > deux" href="/x?a=1&amp;b=2">z</a>',
    "<!-- <a href='dead'> --><script>var x = \"<a href='s'>\"; // =\"</script><A\nHREF=u href = v>t</A>",
    '<b title="a href=n"><a data-href="n" href=\'it"s\'><a-b href=x><a href=>w</a><a href="">', "<a href=foo=\"b>r\"><a x= href=y>",
    "<style>a>b{}</style ><section><a href=1><!DOCTYPE html><!-- never ends <a href=2>",
]
UNTIDY = ['<a title="<b>" href=x>', "<a href=\"never ends>", "a < b <a href=x>", "<b x='y=\"z>'><a href=1>", 'text ="<a href=x>"', "<a href=x"]


def test_tidy_pages_are_read_in_one_pass(spark):
    """The same values as from the prepared page; what isn't tidy is told."""
    rows = spark.createDataFrame([(x, x in TIDY) for x in TIDY + UNTIDY], "s string, tidy boolean")
    got = rows.select("s", "tidy", H.tidy_attributes(F.col("s"), "a", "href").alias("one"),
                      H.attributes(markup(F.col("s")), ANCHOR, "href").alias("old")).collect()
    assert [r.s for r in got if (r.one is not None) != r.tidy] == []
    assert [(r.s, r.one, r.old) for r in got if r.tidy and r.one != r.old] == []


def test_tidy_pages_of_many_tags(spark):
    many = 100_000
    pages = ['<a href="x">' * many, "<p>" * many, "<p " * many, "<!--" * many, '<a href="' * many, "=" * many, "<a href=" * many]
    read = spark.createDataFrame([(x,) for x in pages], "s string").select(F.size(H.tidy_attributes(F.col("s"), "a", "href")))
    assert [r[0] for r in read.collect()] == [many, 0, None, 0, None, 0, None]
