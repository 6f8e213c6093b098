import pytest

import vitrine as v
from vitrine.operators.links import LinkRules

BASE = "https://shop.example.com"


@pytest.fixture
def listing(spark):
    def run(*pages):
        """Each page: (listing_no, html, category, positive words)."""
        stored = spark.createDataFrame([(f"l{n}", h) for n, h, _, _ in pages], "url string, html string")
        config = spark.createDataFrame(
            [("s", n, f"l{n}", c, p) for n, _, c, p in pages],
            "source string, listing_no int, url string, category string, positive array<string>",
        )
        return stored, config

    return run


def found(df):
    return [(r.url.removeprefix(BASE), r.category) for r in df.orderBy("listing_no", "pos").collect()]


def test_structured_links(listing):
    pages, config = listing(
        (1, """<a href="/fr/fr/x/hd-skin-MI000012345.html?q=1">a</a><a href='https://shop.example.com/fr/fr/x/hd-skin-MI000012345.html'>b</a>
           <A HREF=x></A><a href=" /fr/fr/teint/other-I12345.html ">c</a><a href="/fr/fr/levres/other-I12345.html">d</a>
           <a href="/fr/fr/teint/pinceau-I12345.html">e</a><a href="/fr/fr/teint/hd-skin-I1234.html">f</a>
           <a href="/en/hd-skin-I12345.html">g</a><a href="relative-I12345.html">h</a><a>i</a>""", "fond de teint", ["hd-skin"]),
        (2, '<a href="/fr/fr/teint/other-I12345.html">c</a><a href="/fr/fr/a/concealer-I99999.html">z</a>', "correcteur", ["concealer"]),
    )
    links = v.collect_links(pages, config, v.STRUCTURED, BASE, "shop.example.com/fr/fr/")
    assert found(links) == [
        ("/fr/fr/x/hd-skin-MI000012345.html", "fond de teint"),
        ("/fr/fr/teint/other-I12345.html", "fond de teint"),   # first listing wins
        ("/fr/fr/a/concealer-I99999.html", "correcteur"),
    ]


def test_widget_links_by_article(listing):
    pages, config = listing((1, """<a href="/fr/a-foundation/999ABC01.html">1</a><a href="/fr/b-foundation/999ABC01.html">same article</a>
        <a href="/fr/c-foundation/0123456789.html">2</a><a href="/fr/c-foundation/x.html">3</a><a href="/fr/foundation/y.html?q">no: query</a>
        <a href="/fr/foundation-duo/z.html">no: excluded</a><a href="/fr/blush/z.html">no: keyword</a>""", "fond de teint", ["foundation"]),
        (2, '<a href="/fr/d-foundation/999ABC01.html">other listing</a>', "correcteur", ["foundation"]))
    links = v.collect_links(pages, config, v.WIDGET, BASE)
    assert [u for u, _ in found(links)] == [
        "/fr/a-foundation/999ABC01.html", "/fr/c-foundation/0123456789.html", "/fr/c-foundation/x.html",
        "/fr/d-foundation/999ABC01.html",   # articles are compared inside one listing only
    ]


@pytest.mark.parametrize("html, want", [
    ('<a class="ProductCard" href="/b">b</a><a data-at="product_name" href="/a?x">a</a>', ["/a"]),
    ('<a class="x ProductCard" href="/b">b</a><article><a href="/p/c">c</a></article>', ["/b"]),
    ('<div class="product-card"><div><a href="/p/c">c</a></div><a href="/q">q</a></div><a href="/p/d">d</a>', ["/p/c"]),
    ('<article><a href="/p/e">e</a></article><a href="/p/abc-P12.html">f</a>', ["/p/e"]),
    ('<a href="/p/abc-P12.html?x">f</a><a href="/p/ABC-P12.html">g</a><a href="/z">z</a>', ["/p/abc-P12.html"]),
])
def test_retail_selector_chain(listing, html, want):
    pages, config = listing((1, html, "yeux", []))
    assert [u for u, _ in found(v.collect_links(pages, config, v.RETAIL, BASE))] == want


def test_listing_is_joined_by_size(listing, spark):
    pages, _ = listing(
        (0, '<a href="/x/hd-skin-I00001.html?a">a</a><a href="/x/none-I00002.html">b</a><a href="/x/brush-I00003.html">c</a>', "", []),
        (1, '<a href="/x/hd-skin-I00001.html">a</a><a href="/x/concealer-I00004.html">d</a>', "", []),
        (2, '<a href="/x/hd-skin-I00009.html">not listed</a>', "", []),
    )
    words = v.LISTING_KEYWORDS["structured"]
    config = v.listing_table(spark, "s", [("l0", "fond de teint"), ("l1", "correcteur")], words)
    want = [("/x/hd-skin-I00001.html", "fond de teint"), ("/x/concealer-I00004.html", "correcteur")]
    assert found(v.collect_links(pages, config, v.STRUCTURED, BASE)) == want
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        large = v.collect_links(pages, config, v.STRUCTURED, BASE)
        assert "Broadcast" not in large._jdf.queryExecution().executedPlan().toString() and found(large) == want
    finally:
        spark.conf.set(key, before)


def test_anchors_in_comments_scripts_and_attributes_are_none(spark):
    html = ("<!-- <a href='/dead.html'> --><a title=\"x > y\" href=\"/b.html\">b</a><script>'<a href=\"/s.html\">'</script>"
            "<div data-x='<a href=\"/d.html\">'></div><a title='q=\"1\"' href='/c.html?a=1&amp;b=2'>c</a>")
    pages = spark.createDataFrame([(html,)], "html string")
    assert [r.href for r in v.extract_links(pages).orderBy("pos").collect()] == ["/b.html", "/c.html?a=1&b=2"]


def test_first_seen_is_idempotent_and_partition_free(spark):
    rows = [(i % 7, i % 3, i, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "key int, listing_no int, pos int, v string")
    once = v.first_seen(df.repartition(5), ["key"], ["listing_no", "pos"])
    want = {k: min((l, p, x) for kk, l, p, x in rows if kk == k) for k in range(7)}
    assert {r.key: (r.listing_no, r.pos, r.v) for r in once.collect()} == want
    twice = v.first_seen(once, ["key"], ["listing_no", "pos"])
    assert sorted(twice.collect()) == sorted(once.collect())
    assert once.columns == df.columns


def test_first_seen_keeps_null_keys_and_hot_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1)] + [("hot", i) for i in range(500)], "key string, pos int")
    assert {(r.key, r.pos) for r in v.first_seen(df, ["key"], ["pos"]).collect()} == {(None, 1), ("hot", 0)}


def test_pages_and_frontier(spark):
    links = spark.createDataFrame([("a", 1), ("b", 2)], "url string, pos int")
    pages = spark.createDataFrame([("a", "<p>")], "url string, html string")
    assert [r.url for r in v.attach_pages(links, pages).collect()] == ["a"]
    assert [r.url for r in v.frontier(links, pages).collect()] == ["b"]
    assert [r.url for r in v.take_first(links, 1, ["pos"]).collect()] == ["a"]


def test_keyword_gate(spark):
    df = spark.createDataFrame(
        [("X/Foundation", ["foundation"]), ("x/teint/y", ["foundation"]), ("x/brush-foundation", ["foundation"]), ("x/y", []), ("z", None)],
        "url string, words array<string>",
    )
    assert [r.url for r in v.keyword_gate(df, "url", "words", ["brush"], "/teint/").collect()] == ["X/Foundation", "x/teint/y", "x/y", "z"]
    assert [r.url for r in v.keyword_gate(df, "url", ["foundation"]).collect()] == ["X/Foundation", "x/brush-foundation"]
    assert v.keyword_gate(df, "url").count() == 5


def test_extract_links_positions(spark):
    pages = spark.createDataFrame([("u", '<a>0</a><a href="">1</a><abbr href="/n"><a id=1 href="/2">2</a>')], "url string, html string")
    assert [tuple(r) for r in v.extract_links(pages, LinkRules()).collect()] == [("u", 2, "/2")]


def test_collect_catalogue(listing, spark):
    pages, config = listing((1, '<a href="/fr/fr/teint/a-I00001.html?c=1">a</a><a href="/fr/fr/teint/b-I00002.html">b</a><a href="/fr/fr/teint/c-I00003.html">c</a>', "fond de teint", []))
    stored = spark.createDataFrame([
        (f"{BASE}/fr/fr/teint/a-I00001.html", "<h1>A</h1><p>9 €</p>"),
        (f"{BASE}/fr/fr/teint/a-I00001.html?v=2", "<h1>A copy</h1>"),
        (f"{BASE}/fr/fr/teint/b-I00002.html", "<p>no name</p>"),
        (f"{BASE}/fr/fr/teint/unlinked-I00009.html", "<h1>U</h1>"),
    ], "url string, html string")
    got = v.collect_catalogue(pages.unionByName(stored), config, v.STRUCTURED, brand="Maison", base=BASE)
    rows = got.collect()
    assert [(r.source, r.product_name, r.category, r.source_url) for r in rows] == [
        ("s", "A", "fond de teint", f"{BASE}/fr/fr/teint/a-I00001.html")
    ]
    assert v.conform(got).columns == ["source", *v.FIELDS]


def test_first_seen_carries_each_column_once(spark):
    rows = spark.createDataFrame([("k", "u2", 1, "x"), ("k", "u1", 2, "y"), (None, "u3", 3, None), ("k", "u1", 1, "z")],
                                 "article string, url string, n int, more string")
    first = v.first_seen(rows, ["article"], ["url", "n"])
    assert first.columns == rows.columns
    assert {tuple(r) for r in first.collect()} == {("k", "u1", 1, "z"), (None, "u3", 3, None)}
    assert "min_by" not in first._jdf.queryExecution().optimizedPlan().toString()


def test_links_of_untidy_pages_and_pages_without_any(spark):
    pages = ['<a href="/a">1</a><a>2</a><a href="/b?x=1&amp;y=2">3</a>', '<b title="<a href=n>"><a>1</a><a href=" /c ">2</a>', "<a>1</a>", None]
    links = v.extract_links(spark.createDataFrame(list(enumerate(pages)), "id int, html string"))
    assert sorted(tuple(r) for r in links.collect()) == [(0, 0, "/a"), (0, 2, "/b?x=1&y=2"), (1, 1, "/c")]
