"""Catalogue-shaped inputs derived by Spark from the driver's tables.

Each grows with its table: one offer per line item, one product page and one feed
page per part, one listing page per order. Nothing is collected or sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions.rules import Tag, all_matches, first_match
from vitrine.schema import FIELDS, TAG_JOIN

BASE = "https://shop.example.com"

OFFER_FINISH = [
    ("hot", "Rayonnant"), ("cold", "mat"), ("blue", "naturel"), ("new", "satine"), ("old", "satiné"),
]
OFFER_COVERAGE = [("ring", "totale"), ("gear", "moyenne"), ("bolt", "légère"), ("rod", "legere"), ("plate", "modulable")]
OFFER_SKIN = [
    Tag("grasse", ("red", "anvil")), Tag("sèche", ("blue", "rod")), Tag("mixte", ("small",)),
    Tag("sensible", ("gizmo", "widget")),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Narrow rows of which wide pages are made, dealt over sixteen times the tasks that read them."""
    return rows.repartition(16 * rows.rdd.getNumPartitions())


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source``, the 14 product fields and ``page_text``; one row per line item."""
    item = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    joined = item.join(table(spark, sf_dir, "part"), "p_partkey")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kept = (F.lit(1.0) - F.col("l_discount")).cast("decimal(3,2)")
    rated = F.col("l_returnflag") != "N"
    base = joined.select(
        F.col("l_returnflag").alias("source"),
        F.concat("p_name", F.lit(" — #"), F.col("p_partkey").cast("string")).alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.lower("p_type").alias("category"),
        price.alias("price"),
        F.when(F.col("l_discount") > 0, (price * kept).cast("decimal(12,2)")).alias("promo_price"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_size").cast("decimal(8,2)")).alias("volume_ml"),
        F.when(rated, (5 - F.col("l_tax") * 10).cast("decimal(3,1)").cast("decimal(6,4)")).alias("rating"),
        F.when(rated, F.col("l_quantity").cast("bigint")).alias("review_count"),
        F.col("l_linenumber").alias("shade_count"),
        first_match(F.col("p_name"), OFFER_FINISH).alias("finish_type"),
        first_match(F.col("p_name"), OFFER_COVERAGE).alias("coverage_level"),
        F.nullif(F.array_join(all_matches(F.col("p_name"), OFFER_SKIN), TAG_JOIN), F.lit("")).alias("skin_type"),
        F.when(F.col("l_linestatus") == "O", "En stock").otherwise("Rupture").alias("availability"),
        F.concat(
            F.lit(f"{BASE}/p/"), F.col("p_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"),
            F.lit(".html?o="), F.col("l_orderkey").cast("string"),
        ).alias("source_url"),
        "p_name", "p_size",
    )
    promo_text = F.coalesce(F.concat(F.col("promo_price").cast("string"), F.lit(" € ")), F.lit(""))
    page_text = F.concat(
        "p_name", F.lit(" "), F.col("price").cast("string"), F.lit(" € "), promo_text,
        F.col("p_size").cast("string"), F.lit(" ml Teintes : "), F.col("shade_count").cast("string"),
    )
    return base.select("source", *FIELDS, page_text.alias("page_text"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers(spark, sf_dir).select("source", *FIELDS)


def by_source(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The offers as three shops' catalogues; the second shop publishes no ratings at all."""
    every = catalogue(spark, sf_dir)
    shops = {s: every.filter(F.col("source") == s).drop("source") for s in ("A", "N", "R")}
    shops["N"] = shops["N"].drop("rating", "review_count")
    return shops


# ---- product pages -----------------------------------------------------------------

_WORD = "CASE k % 3 WHEN 0 THEN 'foundation' WHEN 1 THEN 'full-cover' ELSE 'skin-tint' END"

_STRUCTURED_LD = r"""CASE v
 WHEN 0 THEN concat('<script type="application/ld+json">{"@type":"Product","name":" ', p_name, '  ', k,
   '","brand":{"@type":"Brand","name":"', p_brand, '"},"offers":{"price":', s + 10,
   '.90,"availability":"https://schema.org/OutOfStock"},"aggregateRating":{"ratingValue":"4.5","reviewCount":', s, '}}</script>')
 WHEN 1 THEN concat('<script type=''application/ld+json''>[{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"Accueil"}},{"item":{"name":"',
   p_type, '"}},{"item":{"name":"x"}}]},{"@type":"Product","name":"', p_name, ' ', k, '","brand":"', p_brand,
   '","offers":[{"price":"', s + 10, '.90"}],"aggregateRating":{"ratingValue":0,"bestRating":5,"ratingCount":"0"}}, 7]</script>')
 WHEN 2 THEN concat('<script type="application/ld+json">{"@type":"Product","name":</script><script type="application/ld+json"> </script>')
 WHEN 3 THEN concat('<meta property="og:title" content="', p_name, ' ', k, ' | Boutique">')
 WHEN 4 THEN concat('<script type="application/ld+json">{"@type":"Product","name":"","brand":{"name":""},"offers":{"price":0,"lowPrice":"',
   s + 10, '.90"}}</script>')
 ELSE concat('<script type="application/ld+json">{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"Accueil"}}]}</script>',
   '<script type="application/ld+json">{"@type":"Product","name":"', p_name, ' ', k, '","offers":{"price":1}}</script>')
END"""

_STRUCTURED_BODY = r"""concat(
 CASE WHEN v IN (2, 4) THEN concat('<h1 class="t">', p_name, ' <b>', k, '</b></h1>') ELSE '' END,
 CASE v
  WHEN 2 THEN concat('<ol class="breadcrumb"><li><a href="/">Accueil</a></li><li><a href="/t">', p_type, '</a></li></ol>')
  ELSE '' END,
 CASE v
  WHEN 2 THEN concat('<span class="big product-price">', s + 10, ',90 €</span><i>2 €</i>')
  WHEN 3 THEN concat('<p>', s + 10, ',90 €</p>')
  WHEN 5 THEN concat('<div class="box price"><div>', s + 10, ',90&nbsp;€</div> <div><s>', s + 5, '.50 €</s></div></div><p>3 €</p>')
  ELSE '' END,
 '<p>Contenance ', CASE WHEN s % 2 = 1 THEN concat(s, ' ml') ELSE concat(s, ',5 g') END, '</p>',
 CASE v WHEN 2 THEN '<p>Rupture de stock</p>' WHEN 3 THEN '<p>indisponible</p><button>Ajouter au panier</button>' ELSE '' END,
 CASE WHEN v IN (2, 3, 4) THEN concat('<p>4,', s % 10, ' sur 5</p><p>', s, ' avis</p>') ELSE '' END,
 CASE s % 3
  WHEN 0 THEN concat('<p>', s, ' teintes</p>')
  WHEN 1 THEN concat('<ul class="color-list">', CASE WHEN k % 2 = 0 THEN '<ul class="color-in">' ELSE '' END,
   repeat('<li class="swatch">c</li>', 1 + s % 4), CASE WHEN k % 2 = 0 THEN '</ul>' ELSE '' END, '<li>d</li></ul><i class="swatch-size">S</i>')
  ELSE '' END,
 CASE s % 4
  WHEN 0 THEN '<p>Fini mat, Couvrance Moyenne</p>' WHEN 1 THEN '<p>Satiné. Couvrance modulable</p>'
  WHEN 2 THEN '<p>Glow</p>' ELSE '' END,
 CASE s % 5
  WHEN 0 THEN '<p>Pour peaux normales, mixtes et grasses.</p>' WHEN 1 THEN '<p>Hydratant, peau sensible</p>'
  WHEN 2 THEN '<p>Peau. Grasse</p>' WHEN 3 THEN '<p>Tous types</p>' ELSE '' END)"""

_WIDGET_LD = r"""CASE v
 WHEN 0 THEN concat('<script type="application/ld+json">{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"Teint"}},{"item":{"name":"',
   p_name, ' ', k, '"}}]}</script>')
 WHEN 1 THEN concat('<script type="application/ld+json">{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"first"}}]}</script>',
   '<script type="application/ld+json">{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"', p_name, ' ', k, '"}}]}</script>')
 WHEN 2 THEN concat('<script type="application/ld+json">[{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"in a list"}}]}]</script>',
   '<meta content="', p_name, ' ', k, ' | Boutique - Paris" property="og:title">')
 WHEN 3 THEN '<p>no name</p>'
 ELSE concat('<meta property="og:title" content="', p_name, ' ', k, '">') END"""

_WIDGET_BODY = r"""concat(
 CASE v
  WHEN 0 THEN concat('<div class="product-info-content"><div><p>', s + 10, ',90 €</p></div><p>', s, ' g</p></div><p>', s, ' ml 1,00 €</p>')
  WHEN 1 THEN concat('<div class="a product-info-content b"><b>', s + 10, '.90 €</b> <s>', s + 20, ',90 €</s> ', s, ' ml</div>')
  WHEN 2 THEN concat('<meta property="og:price:amount" content="', s + 10, '.90"><p>', s, ' €</p>')
  ELSE concat('<p>', s + 10, ',90 € pour ', s, ',5 ml</p>') END,
 CASE WHEN s % 7 = 0 THEN '<meta property="og:availability" content="OutOfStock">'
      WHEN s % 7 = 1 THEN '<meta property="og:availability" content="instock">' ELSE '' END,
 CASE s % 4
  WHEN 0 THEN '<dt>Fini</dt><dd>Lisse et mat,</dd><dt>Couvrance</dt><dd>Moyenne à haute</dd><dt>Teinte</dt>'
  WHEN 1 THEN '<p>Fini Rayonnant  etc</p><p>Couvrance Légère Ajouter</p>'
  WHEN 2 THEN '<p>Fini mat</p>' ELSE '' END,
 CASE s % 3
  WHEN 0 THEN concat('<p>Teintes : ', s, '</p>')
  WHEN 1 THEN '<p>Mont Blanc L1</p><p>Deauville L2</p><p>Gobi M1</p><p>Mont Blanc L1</p><p>Macao D1</p>'
  ELSE '<p>Gobi M1</p>' END,
 CASE WHEN s % 2 = 0 THEN concat('<div class="bv_avgRating_component_container"><b>4,', s % 10, '</b></div><div class="bv_numReviews_text">(<span>', s, '</span>)</div>') ELSE '' END,
 CASE s % 5
  WHEN 0 THEN '<p>Peau grasse ou mixte</p>' WHEN 1 THEN '<p>Hydrate, peau sensible</p>'
  WHEN 2 THEN '<p>sans huile, tous les types</p>' ELSE '' END)"""

_RETAIL_LD = r"""CASE v
 WHEN 0 THEN concat('<script type="application/ld+json">{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":""}}]}</script>',
   '<script type="application/ld+json">{"@type":"Product","name":"', p_name, ' ', k, '","brand":{"name":"', p_brand,
   '"},"offers":{"price":"","lowPrice":', s + 10, '.9},"aggregateRating":{"ratingValue":4.25,"reviewCount":0,"ratingCount":', s, '}}</script>')
 WHEN 1 THEN concat('<script type="application/ld+json">{"@type":"Product","name":"', p_name, ' ', k, '","brand":"', p_brand,
   '","offers":[{"price":"', s + 10, '.90"}]}</script>')
 WHEN 2 THEN concat('<script type="application/ld+json">[{"@type":"Product","name":"in a list"}]</script><h1><i>decoy</i></h1><h1 data-at="product_name">', p_name, '<b> ', k, '</b></h1>')
 WHEN 3 THEN concat('<meta property="og:title" content="', p_name, ' ', k, ' - Boutique">')
 ELSE concat('<h1>', p_name, '</h1>') END"""

_RETAIL_BODY = r"""concat(
 CASE WHEN s % 2 = 0 THEN concat('<nav aria-label="breadcrumb"><ol class="breadcrumb-list"><li>Accueil</li><li><a>', p_type, '</a></li><li>x</li></ol></nav>') ELSE '' END,
 CASE v
  WHEN 2 THEN concat('<div class="ProductPrice"><span>', s + 10, ',90 €</span> <del>', s + 20, ',90 €</del></div>')
  WHEN 3 THEN concat('<span data-at="price">', s + 10, ',90 €</span>')
  WHEN 4 THEN concat('<p>', s + 10, ',90 €</p>') ELSE '<p>9,99 €</p>' END,
 CASE s % 3
  WHEN 0 THEN concat('<span data-at="product_format">', s, ' ML</span>') WHEN 1 THEN concat('<p>', s, ' g</p>') ELSE '' END,
 CASE WHEN s % 7 = 0 THEN '<p>Sold out</p>' ELSE '' END,
 CASE WHEN s % 7 = 1 THEN '<button class="add-to-cart" disabled="disabled">+</button>'
      WHEN s % 7 = 2 THEN '<button class="add-to-cart" disabled="">+</button>' ELSE '' END,
 CASE WHEN v = 2 THEN concat('<div aria-label="4.', s % 10, ' étoiles sur 5"></div><span class="review-count">', s, ' notes</span>')
      WHEN v = 3 THEN concat('<p>', s, ' avis</p>') ELSE '' END,
 CASE s % 4
  WHEN 0 THEN repeat('<button aria-label="teinte 01"></button>', 2 + s % 5)
  WHEN 1 THEN concat('<p>', s, ' teintes</p><i class="shade-swatch">1</i>') ELSE '' END,
 CASE s % 5
  WHEN 0 THEN '<p>Satiné, couvrance légère, nourrissant</p>' WHEN 1 THEN '<p>Transparent, bonne couvrance, peau normale</p>'
  WHEN 2 THEN '<p>Automate, contrôle du sébum</p>' ELSE '' END)"""

_PAGE_PARTS = {
    "structured": (_STRUCTURED_LD, _STRUCTURED_BODY, 6),
    "widget": (_WIDGET_LD, _WIDGET_BODY, 5),
    "retail": (_RETAIL_LD, _RETAIL_BODY, 5),
}


# Read on every second page: a comment, a script and an attribute that look like facts.
_DECOYS = r"""CASE WHEN k % 2 = 0 THEN '' ELSE concat(
 '<!-- <h1>decoy</h1><h1 data-at="product_name">decoy</h1><div class="price product-info-content product-price">99,99 € 9 ml</div>',
 '<script type="application/ld+json">{"@type":"Product","name":"decoy","offers":{"price":"99.99"}}</script>',
 '<script type="application/ld+json">{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"decoy"}}]}</script>',
 '<div class="bv_avgRating_component_container">1,1</div><i class="swatch">x</i><meta property="og:title" content="decoy"> -->',
 '<script>var box = ''<div class="price product-info-content product-price">98,99 €</div><!-- '';</script>',
 '<div title="5 > 4 <b class=''price''>" data-x=''<i class="swatch shade-swatch">''></div>') END"""
# On some pages a long text stands before the facts.
_FILLER = "CASE WHEN k % 11 = 0 THEN concat('<p>', repeat('bla ', 1000), '</p>') ELSE '' END"


_CODE = "lpad(CAST(k AS STRING), 9, '0')"
#: Addresses of the shops whose listing pages are collected.
_SHOP_URL = {
    "structured": f"concat('{BASE}/fr/fr/teint/', {_WORD}, '-I', {_CODE}, '.html')",
    "widget": f"concat('{BASE}/fr/teint/', {_WORD}, '/0', {_CODE}, '.html')",
    "retail": f"concat('{BASE}/p/', {_WORD}, '-P', CAST(k AS STRING), '.html')",
}


def _pages(spark: SparkSession, sf_dir: str, kind: str, url: str, html: str) -> DataFrame:
    """One row per part; ``{ld}`` and ``{body}`` stand for the parts of a page of that kind."""
    ld, body, variants = _PAGE_PARTS[kind]
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS k", "p_size AS s", "p_name", "p_brand", "p_type", f"p_size % {variants} AS v"
    )
    return spread(parts).selectExpr("k", f"{url} AS url", f"{html.replace('{ld}', ld).replace('{body}', body)} AS html")


_HTML = f"""concat('<!DOCTYPE html><html><head><title>Boutique</title><style>.x{{}}</style>', {_DECOYS}, {{ld}},
            '</head><body><!-- 7 € 9 ml -->', {_FILLER}, {{body}}, '</body></html>')""".replace("{{", "{").replace("}}", "}")


def product_pages(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """``(url, html)``: one product page of the given kind per part."""
    return _pages(spark, sf_dir, kind, _SHOP_URL["structured"], _HTML).select("url", "html")


def shop_pages(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """``(url, html)``: the stored product pages of one shop, as a crawl leaves them.

    Some are stored under an address with a query string only, some twice, and some have no name.
    """
    html = f"CASE WHEN k % 17 = 0 THEN '<html><body><p>9,99 €</p></body></html>' ELSE {_HTML} END"
    pages = _pages(spark, sf_dir, kind, _SHOP_URL[kind], html)
    tagged = F.concat("url", F.lit("?src="), F.col("k").cast("string"))
    once = pages.select(F.when(F.col("k") % 5 == 0, tagged).otherwise(F.col("url")).alias("url"), "html")
    return once.unionAll(pages.where("k % 7 = 0").select(tagged.alias("url"), "html"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(url, html)``: one listing page per order with links to the pages of parts."""
    orders = spread(table(spark, sf_dir, "orders").selectExpr("o_orderkey AS o", "o_custkey AS k"))
    code = "lpad(CAST(k AS STRING), 9, '0')"
    return orders.selectExpr(
        f"concat('{BASE}/liste/', o) AS url",
        f"""concat('<html><body><nav><a name="top">x</a><a href="#top">haut</a><a href="mailto:a@b.example">m</a></nav>',
            '<!-- <a href="/fr/fr/teint/foundation-I777777777.html">dead</a> --><script>"<a href=''/fr/fr/teint/foundation-I7777.html''>"</script>',
            '<a class="tile" title="un > deux" href="/fr/fr/teint/', {_WORD}, '-I', {code}, '.html?src=', o, '">un</a>',
            '<a href=''{BASE}/fr/fr/levres/rouge-I', {code}, '.html''>deux</a>',
            '<a href="/fr/fr/teint/brush-I', {code}, '.html">trois</a>',
            '<a
 href="{BASE}/fr/fr/teint/', {_WORD}, '-I', {code}, '.html">encore</a>',
            '<a href="/fr/fr/teint/foundation-MI9', {code}, '.html">absent</a>',
            '<a href="/fr/fr/teint/foundation-I12.html">court</a></body></html>') AS html""",
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, listing_no, url, category, positive)`` of the listing pages."""
    return table(spark, sf_dir, "orders").selectExpr(
        "'boutique' AS source",
        "o_orderkey AS listing_no",
        f"concat('{BASE}/liste/', o_orderkey) AS url",
        "CASE o_orderstatus WHEN 'F' THEN 'fond de teint' ELSE 'correcteur' END AS category",
        "CASE o_orderstatus WHEN 'F' THEN array('foundation', 'skin-tint') ELSE array('full-cover') END AS positive",
    )


def widget_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing page per order: two addresses of one article, one of another kind, one with a query string."""
    orders = spread(table(spark, sf_dir, "orders").selectExpr("o_orderkey AS o", "o_custkey AS k"))
    return orders.selectExpr(
        f"concat('{BASE}/liste/', o) AS url",
        f"""concat('<a href="/fr/teint/', {_WORD}, '/0', {_CODE}, '.html">un</a><a href="/fr/autre/', {_WORD}, '/0', {_CODE}, '.html">bis</a>',
            '<a href="/fr/teint/foundation-lip/0', {_CODE}, '.html">lip</a><a href="/fr/teint/', {_WORD}, '/0', {_CODE}, '.html?x=1">x</a>') AS html""",
    )


def retail_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing page per order: marked anchors, anchors in cards, or neither."""
    orders = spread(table(spark, sf_dir, "orders").selectExpr("o_orderkey AS o", "o_custkey AS k"))
    href = f"/p/', {_WORD}, '-P', CAST(k AS STRING), '.html"
    return orders.selectExpr(
        f"concat('{BASE}/liste/', o) AS url",
        f"""CASE o % 3
            WHEN 0 THEN concat('<a href="{href}">plain</a><a data-at="product_name" href="{href}?from=', o, '">marked</a>')
            WHEN 1 THEN concat('<a href="/p/other-P1.html">x</a><div class="product-card"><div><a href="{href}">card</a></div></div><a href="/p/last-P2.html">y</a>')
            ELSE concat('<a href="/z">z</a><a href="{href}">fallback</a>') END AS html""",
    )


def page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's pages as listings: number, language as category, no keywords."""
    return table(spark, sf_dir, "pages").selectExpr(
        "'web' AS source",
        "page_id AS listing_no",
        "url",
        "regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS category",
        "CAST(array() AS ARRAY<STRING>) AS positive",
    )


# ---- feed pages ----------------------------------------------------------------------

_FEED_BODY = r"""CASE s % 10
 WHEN 8 THEN '{"products": []}'
 WHEN 7 THEN '{}'
 WHEN 6 THEN '{"products": ['
 ELSE concat('{"products":[{"title":"', p_name,
   CASE s % 4 WHEN 0 THEN ' Soft Matte Longwear' WHEN 1 THEN ' Powder' WHEN 2 THEN ' Soft''Lit' ELSE ' Stick' END,
   '","vendor":"', p_brand, '"', CASE s % 5 WHEN 0 THEN ',"product_type":"Makeup Sponges"' WHEN 1 THEN '' ELSE concat(',"product_type":"', p_type, '"') END,
   ',"handle":"a-', k, '","variants":[{"title":"', CASE s % 3 WHEN 0 THEN 'Mini' WHEN 1 THEN concat('#', k) ELSE '01' END,
   '","price":"', s + 10, '.90","compare_at_price":', CASE WHEN s % 2 = 0 THEN concat('"', s + 20, '.00"') ELSE 'null' END,
   ',"available":', CASE WHEN s % 3 = 0 THEN 'true' ELSE 'false' END, '},{"title":"02","price":"1.00"}]},',
   '{"title":"', p_name, ' vide","vendor":"', p_brand, '","product_type":"', p_type, '","handle":"b-', k, '","variants":[]}]}')
END"""


def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(feed, page, status, body)``: one feed page per part, eight pages per feed."""
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS k", "p_size AS s", "p_name", "p_brand", "p_type")
    return parts.selectExpr(
        "concat('feed-', CAST(k DIV 8 AS STRING)) AS feed",
        "CAST(k % 8 + 1 AS INT) AS page",
        "CASE WHEN s % 10 = 9 THEN 503 ELSE 200 END AS status",
        f"{_FEED_BODY} AS body",
    )
