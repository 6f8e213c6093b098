"""Field chains on hand-written pages, one branch after the other."""

from decimal import Decimal

import pytest

import vitrine as v


def ld(*blocks):
    return "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks)


@pytest.fixture
def records(spark):
    """Records of several pages, each an HTML text or (HTML text, category), in order."""

    def run(kind, *pages, **options):
        rows = [(f"u{i:03}", *(p if isinstance(p, tuple) else (p, None))) for i, p in enumerate(pages)]
        table = spark.createDataFrame(rows, "url string, html string, category string").coalesce(1)
        found = v.extract_products(table, v.PROFILES[kind], "Maison", extras=True, **options)
        return sorted(found.collect(), key=lambda r: r.source_url)

    return run


@pytest.fixture
def record(records):
    return lambda kind, html, category=None, **options: records(kind, (html, category), **options)[0]


def test_structured_ld_wins(record):
    r = record("structured", ld(
        "{broken",
        '{"@type":"Product","name":" Base \\n X ","brand":{"name":"B"},"offers":{"price":39.90,"availability":"x/SoldOut"},'
        '"aggregateRating":{"ratingValue":"4.56","reviewCount":12}}',
        '[{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"A"}},{"item":{"name":" Teint "}},{"item":{"name":"C"}}]}]',
    ) + "<h1>other</h1><p>3,0 sur 5</p><p>99 avis</p>", "fond de teint")
    assert (r.product_name, r.brand, r.category) == ("Base X", "B", "teint")
    assert (r.price, r.promo_price) == (Decimal("39.90"), None)
    assert (r.rating, r.review_count) == (Decimal("4.5600"), 12)
    assert (r.availability, r.in_stock) == ("Rupture", False)


def test_structured_second_product_block_is_not_read(record):
    r = record("structured", ld('{"@type":"Product","name":""}', '{"@type":"Product","name":"n","brand":"b","offers":{"price":2}}'))
    assert (r.product_name, r.brand, r.price) == ("", "Maison", None)


def test_structured_text_fallbacks(record):
    r = record("structured", """<h1> Fond <b>de</b> teint</h1><meta property="og:title" content="no">
      <ol class="breadcrumb"><li><a>Accueil</a></li><li><a>CORRECTEUR</a></li></ol>
      <div class="price"><s>45,90&nbsp;€</s> <b>39.90 €</b></div><p>30 mlx 12,5 g</p>
      <p>4,6 / 5</p><p>1 commentaire</p><i class="swatch"></i><i class="swatch"></i>
      <p>semi-mat, moyenne à haute</p><p>Pour peaux sèches, hydratant; et mixte; mature; tous les types</p>""", "fond de teint")
    assert (r.product_name, r.category) == ("Fond de teint", "correcteur")
    assert (r.price, r.promo_price) == (Decimal("45.90"), Decimal("39.90"))
    assert (r.volume_ml, r.volume_unit) == (Decimal("12.50"), "g")
    assert (r.rating, r.review_count, r.shade_count) == (Decimal("4.6000"), 1, 2)
    assert (r.finish_type, r.coverage_level) == ("satine", "moyenne a haute")
    assert r.skin_types == ["seche", "mixte", "mature", "tous types"]
    assert r.skin_type == "seche / mixte / mature / tous types"
    assert r.availability == "En stock"


def test_structured_price_rules(records):
    offer = ld('{"@type":"Product","offers":{"price":"20"}}')
    cases = [
        (offer + "<p class='price'>30 €</p>", (Decimal(20), None)),            # one price: JSON-LD stays
        (offer + "<p class='price'>30 € 25 €</p>", (Decimal(30), Decimal(25))),  # two override it
        (ld('{"@type":"Product","offers":[{"price":0},{"price":5}]}'), (None, None)),
        ("<p>600 € 1 € 499,5 €</p>", (Decimal("499.50"), None)),               # open range (1, 500)
        ("<p>" + "x" * 4000 + "</p><p>9 €</p>", (Decimal(9), None)),           # however late it stands
        ("<!-- <p class='price'>99 €</p> --><p class='price'>20 €</p>", (Decimal(20), None)),
        ("<script>'<p class=\"price\">99 €</p>'</script><p class='price'>20 €</p>", (Decimal(20), None)),
        ("<div title='a > b' class='price'>20 €</div><p>40 €</p>", (Decimal(20), None)),
        ("<p class='price'>gratuit</p><p>9 €</p>", (None, None)),              # an empty zone still counts
    ]
    assert [(r.price, r.promo_price) for r in records("structured", *[h for h, _ in cases])] == [w for _, w in cases]


def test_structured_stop_phrase_and_button(records):
    stop = "<p>Rupture de stock</p>"
    pages = [stop, stop + "<button>AJOUTER au panier</button>", stop + "<button>Rajouter</button>",
             stop + '<button title="Ajouter"></button>', stop + "<script>t='ajouter'</script>"]
    assert [r.in_stock for r in records("structured", *pages)] == [False, True, False, False, True]


def test_structured_category_chain(records):
    crumb = ld('{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"LEVRES"}},{"item":{"name":"x"}}]}')
    links = '<nav class="breadcrumb"><a>a</a><a>Yeux</a></nav>'
    cases = [
        (crumb + links, "teint", "levres"),
        (crumb + links, "levres", "yeux"),      # same as the listing: the markup is asked
        (crumb, "levres", "levres"),
        ("<p>", "teint", "teint"),
        ('<nav class="breadcrumb"><a>a</a></nav>', "teint", "teint"),
        (ld('{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"seul"}}]}'), "teint", "teint"),
        (ld('{"@type":"BreadcrumbList","itemListElement":[{"item":"url"},{"item":{}}]}'), "teint", "teint"),
    ]
    assert [r.category for r in records("structured", *[c[:2] for c in cases])] == [c[2] for c in cases]


def test_best_rating_is_optional(record):
    html = ld('{"@type":"Product","aggregateRating":{"ratingValue":0,"bestRating":5}}') + "<p>3.5/5</p>"
    assert record("structured", html).rating == Decimal(5)
    assert record("structured", html, best_rating=False).rating == Decimal("3.5")


def test_structured_shades(records):
    cases = [
        ("<i class='swatch'></i><i class='swatch'></i><p>12 teintes</p>", 12),
        ("<i class='swatch'></i>", None),
        ("<i class='swatch'></i>" * 99, 99),
        ("<i class='swatch'></i>" * 100, 100),
        ('<ul class="color-a"><ul class="color-b"><li>1</li></ul><li>2</li><li>3</li></ul>', 3),
        ('<div data-attr="color"><button>1</button><button class="swatch">2</button></div><button>x</button>', 2),
        ('<ul class="colors"><li>1</li><li>2</li></ul><ul><li>3</li></ul>', 2),
    ]
    assert [r.shade_count for r in records("structured", *[h for h, _ in cases])] == [n for _, n in cases]


def test_widget(record):
    r = record("widget", ld(
        '[{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"in a list"}}]}]',
        '{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"first"}}]}',
        '{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"a"}},{"item":{"name":"Fond  X"}}]}',
        '{"@type":"BreadcrumbList","itemListElement":[{"item":"not an object"}]}',
    ) + """<div class="product-info-content"><div>56,00 €</div><div>44.80 €</div> 9 ML 30 g</div><p>12 ml 999,00 €</p>
      <p>Fini  Rayonnant et lisse,  Couvrance Légère Bénéfice</p>
      <p>Teintes  : 36</p><div class="bv_avgRating_component_container"><b>4</b><b>,7</b></div>
      <div class="bv_numReviews_text">(1 234)</div><meta property="og:availability" content="Out of stock">
      <p>Sans huile, hydrate, peau sensible, tous types</p>""", "correcteur")
    assert (r.product_name, r.brand, r.category) == ("Fond  X", "Maison", "correcteur")
    assert (r.price, r.promo_price) == (Decimal("56.00"), Decimal("44.80"))
    assert (r.volume_ml, r.volume_unit) == (Decimal(30), "g")   # only lower-case "ml" counts
    assert (r.finish_type, r.coverage_level) == ("Rayonnant et lisse", "Légère")
    assert (r.rating, r.review_count, r.shade_count) == (Decimal("4.7"), 1, 36)
    assert r.skin_type == "grasse / sèche / tous types / sensible"
    assert r.availability == "rupture"


def test_widget_fallbacks(record):
    r = record("widget", """<meta property="og:title" content="Fond - X | Shop | Y"><meta property="og:price:amount" content="51,5">
      <p>12 € 9,9 €</p><p>Fini mat</p><p>Oslo L1 Siberia L2 Gobi L3 Oslo L1</p>""")
    assert (r.product_name, r.price, r.promo_price) == ("Fond - X", Decimal("51.50"), None)
    assert (r.finish_type, r.coverage_level, r.skin_type) == (None, None, None)
    assert (r.shade_count, r.rating, r.availability) == (3, None, "en stock")
    assert record("widget", "<p>Oslo L1 Siberia L2 Gobi L3</p>").shade_count is None
    assert record("widget", "<p>700,00 € 0,50 €</p>").price == Decimal(700)   # no range here
    assert record("widget", "<p>x</p>").product_name == ""


def test_retail(record):
    r = record("retail", ld(
        '{"@type":"Other"}',
        '{"@type":"BreadcrumbList","itemListElement":[{"item":{"name":"Mascara X"}}]}',
        '{"@type":"Product","name":"later","brand":"B1","offers":{"price":""}}',
        '{"@type":"Product","brand":{"name":"B2"},"offers":{"lowPrice":12.99},"aggregateRating":{"ratingValue":4.3,"ratingCount":7}}',
    ) + """<nav aria-label="breadcrumb"><ol class="breadcrumb"><li>Accueil</li><li>Yeux</li><li>x</li></ol></nav>
      <p class="product-price">20,00 € 15,00 €</p><span class="item-size">8,5 ML</span>
      <button class="add-to-cart" disabled="disabled">+</button><p>Satiné, bonne couvrance, nourri, peau normale</p>""", "yeux")
    assert (r.product_name, r.brand, r.category) == ("Mascara X", "B2", "Yeux")
    assert (r.price, r.promo_price) == (Decimal("12.99"), None)
    assert (r.volume_ml, r.rating, r.review_count) == (Decimal("8.5"), Decimal("4.3"), 7)
    assert (r.finish_type, r.coverage_level, r.skin_type) == ("satiné", "forte", "sèche / tous types")
    assert r.availability == "Rupture"


def test_retail_fallbacks(record):
    r = record("retail", """<h1>wrong</h1><h1 class="product-name-x"> Rouge <b>à</b> lèvres</h1>
      <div class="my-Price"><b>20,00 €</b><s>15,00 €</s></div>
      <div data-at="rating_value">4,5</div><b data-at="reviews_count">17 notes</b>
      <i class="color-option"></i><p>9 teintes</p><button class="add-to-cart" disabled="">+</button><p>Formule matte 3 g</p>""", "lèvres")
    assert (r.product_name, r.brand, r.category) == ("Rougeàlèvres", "Maison", "lèvres")
    assert (r.price, r.promo_price) == (Decimal("20.00"), Decimal("15.00"))
    assert (r.rating, r.review_count, r.shade_count) == (Decimal("4.5"), 17, 9)
    assert (r.volume_ml, r.volume_unit, r.finish_type) == (Decimal(3), "g", "mat")
    assert r.availability == "En stock"     # an empty disabled attribute does not count
    assert record("retail", '<p aria-label="4.5 étoiles sur 5"></p>').rating == Decimal("4.5")
    assert record("retail", "<p>" + "x" * 4000 + "</p><p>rupture</p>").availability == "Rupture"
    assert record("retail", "<p>indisponible</p>").availability == "Rupture"


def test_named_only(spark):
    pages = spark.createDataFrame([("a", "<h1>x</h1>"), ("b", "<p>")], "url string, html string")
    records = v.extract_products(pages, v.STRUCTURED, "Maison")
    assert records.columns == v.FIELDS
    assert [r.source_url for r in v.named_only(records).collect()] == ["a"]


def test_records_do_not_depend_on_partitioning(spark):
    rows = [(f"u{i}", f"<h1>n{i}</h1><p class='price'>{i + 2},50 €</p><p>{i} ml</p>") for i in range(40)]
    pages = spark.createDataFrame(rows, "url string, html string")
    one = v.extract_products(pages.coalesce(1), v.STRUCTURED, "Maison").orderBy("source_url").collect()
    many = v.extract_products(pages.repartition(7), v.STRUCTURED, "Maison").orderBy("source_url").collect()
    assert one == many
