"""Registered queries: one callable per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, SparkSession, functions as F

import vitrine as v
from checks import inputs as I
from vitrine.functions.numbers import CENT_PRICE, number
from vitrine.functions.rules import Tag
from vitrine.functions.text import GAP
from vitrine.functions.urls import PLAIN_URL
from vitrine.profiles import SHADE_LABEL, STRUCTURED_EXCLUDED
from vitrine.shared import shared_dir, stored

Query = Callable[[SparkSession, str], DataFrame]

# ---- vocabularies and rules of the checks -------------------------------------------

VOCAB = {
    "finish_type": {"satine": "satiné", "mat": "mat", "Naturel": "naturel"},
    "coverage_level": {"LÉGÈRE": "légère", "totale": "totale", "Moyenne": "moyenne"},
    "availability": {"EN  STOCK": "en stock", "rupture": "rupture"},
}
DOC_RULES = [("the", "anglais"), ("nicht", "allemand"), ("para", "espagnol"), ("que", "français")]
DOC_TAGS = [
    Tag("cote", ("http", "email")), Tag("proche", (), ("que",)), Tag("nombre", ("1", "2", "3")),
    Tag("cote", ("license", "copyright")),
]
DOC_ANCHORS = ("de", "the")
# A thousand rules: three syllables each, 37 labels.
SYLLABLES = ("th", "on", "er", "an", "re", "es", "nd", "ti", "eau", "que")
MANY_RULES = [(a + b + c, f"g{i % 37}") for i, (c, b, a) in enumerate(product(SYLLABLES, repeat=3))]


def _pages(s: SparkSession, d: str) -> DataFrame:
    return I.table(s, d, "pages")


def _documents(s: SparkSession, d: str) -> DataFrame:
    return I.table(s, d, "documents")


# ---- master table --------------------------------------------------------------------

def master_union(s, d):
    return v.build_master(I.by_source(s, d))


def master_rows(s, d):
    return v.master_size(v.build_master(I.by_source(s, d)))


def numbered_rows(s, d):
    order = ["source", "source_url", "shade_count", "price", "promo_price", "rating", "review_count"]
    rows = v.number_rows(I.catalogue(s, d), order)
    return rows.select(F.col("row_no").cast("bigint").alias("row_no"), *order)


def record_with_defaults(s, d):
    parts = I.table(s, d, "part").select(
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand")).alias("brand"),
        F.lower("p_type").alias("category"),
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".5 ")).alias("price"),
        F.when(F.col("p_size") % 2 == 0, F.lit("")).otherwise("12").alias("shade_count"),
        F.concat(F.lit("p/"), F.col("p_partkey").cast("string")).alias("source_url"),
    )
    return v.to_canonical(parts, "parts", {"brand": "Maison", "availability": "En stock"})


def csv_round_trip(s, d):
    """Write each shop's offers as CSV to the shared folder and read them back."""
    folder = f"{shared_dir(s)}/csv-{uuid.uuid4().hex}"
    for shop, df in I.by_source(s, d).items():
        v.write_catalog_csv(v.build_master([df.select("*", *[
            F.lit(None).cast("string").alias(c) for c in v.FIELDS if c not in df.columns
        ])]), f"{folder}/{shop}")
    return v.read_catalogs(s, {shop: f"{folder}/{shop}" for shop in ("A", "N", "R")})


def csv_rejected_rows(s, d):
    """Each shop's offers as CSV with words for numbers in some rows: records read and rows set aside."""
    folder = f"{shared_dir(s)}/csv-{uuid.uuid4().hex}"
    out = []
    for shop in ("A", "N", "R"):
        rows = I.catalogue(s, d).where(F.col("source") == shop)
        rows = rows.select(*[F.col(c).cast("string").alias(c) for c in v.FIELDS]).withColumns({
            "price": F.when(F.col("shade_count") == 7, "cher").otherwise(F.col("price")),
            "review_count": F.when(F.col("shade_count") == 6, "beaucoup").otherwise(F.col("review_count"))})
        rows.write.csv(f"{folder}/{shop}", header=True, escape='"')
        good, bad = v.read_catalog_csv_checked(s, f"{folder}/{shop}")
        out += [good.select(F.lit(shop).alias("source"), F.lit(True).alias("good")), bad.select(F.lit(shop), F.lit(False))]
    return reduce(DataFrame.unionAll, out).groupBy("source").agg(
        F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_rejected"))


# ---- brand figures -------------------------------------------------------------------

def brand_benchmark(s, d):
    return v.brand_benchmark(I.catalogue(s, d))


def brand_benchmark_category(s, d):
    return v.brand_benchmark(I.catalogue(s, d), category="promo")


def brand_report(s, d):
    return v.brand_report(I.by_source(s, d))


def brand_report_promo(s, d):
    """The report of one category over the master table, read once."""
    return v.brand_report(I.catalogue(s, d), category="promo")


def count_by_category(s, d):
    return v.count_by(I.catalogue(s, d), ["category"], ordered=True)


def category_split(s, d):
    return v.count_where(I.catalogue(s, d), "category", ["promo", "standard"])


def finish_mix(s, d):
    return v.finish_mix(I.catalogue(s, d))


def finish_table(s, d):
    return v.finish_table(I.catalogue(s, d), ["mat", "naturel", "satine"])


def coverage_mix(s, d):
    return v.finish_mix(I.catalogue(s, d), col="coverage_level")


def skin_mix(s, d):
    return v.tag_mix(I.catalogue(s, d))


def family_rollup(s, d):
    return v.family_rollup(I.catalogue(s, d))


def availability_rate(s, d):
    return v.availability_rate(I.catalogue(s, d))


def promo_depth(s, d):
    return v.promo_depth(v.price_direction(I.catalogue(s, d)))


def completeness(s, d):
    return v.completeness(I.catalogue(s, d))


def rank_price(s, d):
    bench = v.brand_benchmark(I.catalogue(s, d)).select("brand", "avg_price")
    return v.rank_brands(bench, "avg_price")


def rank_reviews(s, d):
    bench = v.brand_benchmark(I.catalogue(s, d)).select("brand", "avg_reviews")
    return v.rank_brands(bench, "avg_reviews", best="low")


def rank_rating_by_shop(s, d):
    bench = v.brand_benchmark(I.catalogue(s, d), by="source").select("source", "avg_rating")
    return v.rank_brands(bench, "avg_rating")


def rank_products(s, d):
    """Products by their average price: as many groups as names."""
    bench = v.brand_benchmark(I.catalogue(s, d), by="product_name").select("product_name", "avg_price")
    return v.rank_rows(bench, "avg_price", ["product_name"])


def rank_shade_counts(s, d):
    """Products by their largest number of shades: most share a rank."""
    bench = v.brand_benchmark(I.catalogue(s, d), by="product_name").select("product_name", "max_shades")
    return v.rank_rows(bench, "max_shades", ["product_name"], best="low")


def market_gap_price(s, d):
    return v.market_gap(I.catalogue(s, d), "price")


def market_gap_rating(s, d):
    return v.market_gap(I.catalogue(s, d), "rating")


# ---- harmonisation -------------------------------------------------------------------

def harmonised_labels(s, d):
    fixed = v.harmonise(I.catalogue(s, d), VOCAB)
    return v.count_by(fixed, ["source", "finish_type", "coverage_level", "availability"])


def harmonised_from_table(s, d):
    """As ``harmonised_labels``, with the vocabulary as a table."""
    fixed = v.harmonise(I.catalogue(s, d), v.vocabulary_table(s, VOCAB), list(VOCAB))
    return v.count_by(fixed, ["source", "finish_type", "coverage_level", "availability"])


def unmapped_labels(s, d):
    return v.unmapped(I.catalogue(s, d), VOCAB)


def brand_groups(s, d):
    groups = I.table(s, d, "nation").select(
        F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("brand"),
        F.concat(F.lit("Groupe "), F.col("n_regionkey").cast("string")).alias("brand_group"),
    ).filter(F.col("brand") != "Brand#7")
    return v.brand_benchmark(v.brand_group(I.catalogue(s, d), groups), by="brand_group")


def price_direction(s, d):
    return v.price_direction(I.catalogue(s, d)).select(
        "source_url", "price", "promo_price", "list_price", "sale_price", "on_promo"
    )


def families(s, d):
    return v.split_family(I.catalogue(s, d)).groupBy("family", "shade").agg(F.count("*").alias("n"))


def normalised_text(s, d):
    key = v.normalise(F.col("text"))
    return _documents(s, d).select(
        "doc_id", F.md5(key).alias("text_key"), F.length(key).cast("bigint").alias("n_chars_key")
    )


# ---- links ---------------------------------------------------------------------------

def page_links(s, d):
    return v.extract_links(_pages(s, d).select("page_id", "html"))


def page_links_resolved(s, d):
    host = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    links = v.extract_links(_pages(s, d).select("page_id", host.alias("base"), "html"))
    url = v.canonical_url(v.absolute_url(F.col("href"), F.col("base")))
    return links.select("page_id", "pos", url.alias("url"), v.slug(url).alias("slug"))


def page_slugs(s, d):
    url = v.canonical_url(F.col("url"))
    return _pages(s, d).select(
        "page_id", url.alias("url"), v.slug(F.col("url")).alias("last_part"),
        v.slug(F.col("url"), "locale").alias("locale_part"), v.slug(F.col("url"), "product").alias("product_part"),
    )


def offer_slugs(s, d):
    return I.catalogue(s, d).groupBy(v.slug(F.col("source_url"), "product", 0).alias("slug")).agg(F.count("*").alias("n"))


def keyword_gate_pages(s, d):
    return v.keyword_gate(_pages(s, d).select("page_id", "url"), "url", ["blog", "www"], ["casino", "+"], "/fr/")


def keyword_gate_rows(s, d):
    """Keywords of the row itself: every second page asks for none."""
    words = F.when(F.col("page_id") % 2 == 0, F.array(F.lit("blog"), F.lit("/en/"))).otherwise(
        F.array().cast("array<string>")
    )
    pages = _pages(s, d).select("page_id", "url", words.alias("positive"))
    return v.keyword_gate(pages, "url", "positive", STRUCTURED_EXCLUDED, "/teint/").select("page_id", "url")


def keyword_gate_parts(s, d):
    return v.keyword_gate(I.table(s, d, "part").select("p_partkey", "p_name"), "p_name", ["red", "blue"], ["rod"])


def pattern_gate_pages(s, d):
    return v.pattern_gate(
        _pages(s, d).select("page_id", "url"), "url", domain="example.com/", pattern=r"/\d{3,}\.html(?:\?|$)", suffix=".html"
    )


def first_seen_links(s, d):
    """The first page and position of every href of the web pages."""
    links = v.extract_links(_pages(s, d).select("page_id", "html"))
    return v.first_position(links, ["href"], "page_id", "pos")


def first_seen_in_page(s, d):
    links = v.extract_links(_pages(s, d).select("page_id", "html"))
    return v.first_seen(links, ["page_id", "href"], ["pos"]).select("page_id", "href", "pos")


def first_seen_article(s, d):
    """First offer of each article code in the address."""
    rows = I.catalogue(s, d).select("source", "source_url", "price", "shade_count", "promo_price")
    key = v.article_key(F.col("source_url"), r"/p/(\d+)-")
    order = ["source_url", "source", "shade_count", "price", "promo_price"]
    return v.first_seen(rows.withColumn("article", key), ["article"], order)


def listing_join(s, d):
    pages = v.attach_listing(_pages(s, d).select("url", "html"), I.page_listing(s, d))
    links = v.extract_links(pages.select("source", "listing_no", "category", "html"))
    return links.groupBy("source", "category").agg(
        F.count("*").alias("n_links"), F.count_distinct("href").alias("n_hrefs")
    )


def shop_links(s, d):
    return v.collect_links(
        I.listing_pages(s, d), I.listings(s, d), v.STRUCTURED, I.BASE, "shop.example.com/fr/fr/"
    )


def shop_links_widget(s, d):
    return v.collect_links(I.widget_listing_pages(s, d), I.listings(s, d), v.WIDGET, I.BASE)


def shop_links_retail(s, d):
    return v.collect_links(I.retail_listing_pages(s, d), _unasked(s, d), v.RETAIL, I.BASE)


def _unasked(s, d):
    """The listings without keywords."""
    return I.listings(s, d).withColumn("positive", F.array().cast("array<string>"))


def shop_links_with_page(s, d):
    pages = I.shop_pages(s, d, "structured")
    titled = pages.select("url", F.regexp_extract("html", "<title>([^<]*)<", 1).alias("title"))
    return v.attach_pages(shop_links(s, d), titled).select("source", "listing_no", "pos", "url", "category", "title")


def shop_links_with_page_store(s, d):
    """As ``shop_links_with_page``, from a page store bucketed by address."""
    store = v.bucket_pages(I.shop_pages(s, d, "structured"), f"pages_{uuid.uuid4().hex}", 8)
    links = shop_links(s, d)
    found = v.linked_pages(store, links)
    titled = found.select("url", PLAIN_URL, F.regexp_extract("html", "<title>([^<]*)<", 1).alias("title"))
    return v.attach_pages(links, titled).select("source", "listing_no", "pos", "url", "category", "title")


def shop_frontier(s, d):
    return v.frontier(shop_links(s, d), I.shop_pages(s, d, "structured"))


def first_links(s, d):
    links = v.extract_links(_pages(s, d).select("page_id", "html"))
    return v.take_first(links, 100, ["page_id", "pos"])


# ---- text rules ----------------------------------------------------------------------

def visible_text(s, d):
    text = v.with_text(_pages(s, d).select("page_id", "html"))
    return text.select(
        "page_id", F.md5("text").alias("text_key"), F.md5("text_lower").alias("lower_key"),
        F.length("text").cast("bigint").alias("n_chars"),
    )


def document_first_match(s, d):
    lower = _documents(s, d).select("doc_id", F.lower("text").alias("text"))
    return lower.select(
        "doc_id", v.first_match(F.col("text"), DOC_RULES).alias("first_rule"),
        v.first_match(F.col("text"), DOC_RULES, whole_words=True).alias("first_word"),
        v.first_match(F.col("text"), DOC_RULES, plain=True).alias("first_plain"),
    )


def document_first_of_many(s, d):
    """The first of a thousand rules."""
    lower = _documents(s, d).select("doc_id", F.lower("text").alias("text"))
    return lower.select("doc_id", v.first_match(F.col("text"), MANY_RULES).alias("first_rule"))


def document_tags(s, d):
    lower = _documents(s, d).select("doc_id", F.lower("text").alias("text"))
    tags = v.all_matches(F.col("text"), DOC_TAGS, DOC_ANCHORS)
    return lower.select("doc_id", F.array_join(tags, " / ").alias("tags"), F.size(tags).alias("n_tags"))


def document_numbers(s, d):
    """Rating, review and volume patterns over whole texts."""
    text, lower = F.col("text"), F.lower("text")
    amount, unit = v.volume(text)
    return _documents(s, d).select(
        "doc_id",
        number(text, rf"(\d[.,]\d){GAP}(?:sur|/){GAP}5", "decimal(6,4)").alias("rating"),
        number(lower, rf"(\d+){GAP}(?:avis|reviews?|commentaires?|the|de|en)", "bigint").alias("reviews"),
        amount.alias("volume"), unit.alias("unit"),
    )


def stored_page_shades(s, d):
    """Shade counts of stored pages, read back from the shared folder, with the limits of a profile."""
    path = f"{shared_dir(s)}/pages-{uuid.uuid4().hex}"
    I.product_pages(s, d, "structured").write.parquet(path)
    profile = replace(v.STRUCTURED, least_shades=3, most_shades=4)
    return v.extract_products(v.read_pages(s, path), profile, "Maison").select("source_url", "shade_count")


def offer_prices(s, d):
    found = I.offers(s, d).select("source_url", "price", v.prices(F.col("page_text"), CENT_PRICE, 1, 50000).alias("found"))
    high, low = v.price_pair(F.col("found"))
    return found.select(
        "source_url", "price", high.alias("high"), low.alias("low"), F.size("found").alias("n_prices")
    )


def offer_text_fields(s, d):
    amount, unit = v.volume(F.col("page_text"), ml_ends_word=True)
    shades = number(F.col("page_text"), SHADE_LABEL, "int")
    return I.offers(s, d).groupBy(amount.alias("volume"), unit.alias("unit"), shades.alias("shades")).agg(
        F.count("*").alias("n")
    )


# ---- structured data and product pages -----------------------------------------------

def ld_blocks(s, d):
    blocks = v.json_ld_blocks(I.product_pages(s, d, "structured"))
    return blocks.select("url", "block_no", "type")


def ld_blocks_unlisted(s, d):
    blocks = v.json_ld_blocks(I.product_pages(s, d, "structured"), flatten_lists=False)
    return blocks.groupBy("type").agg(F.count("*").alias("n"))


def ld_first_product(s, d):
    block = v.pick_block(I.product_pages(s, d, "structured"), "Product")
    return block.select("url", F.try_variant_get("block", "$.name", "string").alias("name"))


def ld_last_crumb(s, d):
    block = v.pick_block(I.product_pages(s, d, "widget"), "BreadcrumbList", "last")
    name = F.try_variant_get("block", "$.itemListElement[0].item.name", "string")
    return block.select("url", name.alias("name"))


def _products(kind: str, s, d):
    pages = I.product_pages(s, d, kind)
    records = v.extract_products(pages, v.PROFILES[kind], "Maison", extras=True)
    return records.select(*v.FIELDS, "volume_unit", "in_stock")


def products_structured(s, d):
    return _products("structured", s, d)


def products_widget(s, d):
    return _products("widget", s, d)


def products_retail(s, d):
    return _products("retail", s, d)


def web_page_products(s, d):
    pages = _pages(s, d).select("url", "html")
    return v.named_only(v.extract_products(pages, v.STRUCTURED, "Maison"))


def _shop(kind: str, s, d, **how):
    pages = {"structured": I.listing_pages, "widget": I.widget_listing_pages, "retail": I.retail_listing_pages}[kind](s, d)
    listing = _unasked(s, d) if kind == "retail" else I.listings(s, d)
    domain = "shop.example.com/fr/fr/" if kind == "structured" else None
    return v.collect_catalogue(
        I.shop_pages(s, d, kind).unionByName(pages), listing, v.PROFILES[kind], brand="Maison", base=I.BASE, domain=domain, **how)


def shop_catalogue(s, d):
    return _shop("structured", s, d)


def shop_catalogue_limited(s, d):
    return _shop("structured", s, d, limit=50).select("source", "source_url", "product_name", "category", "price")


def shop_catalogue_widget(s, d):
    return _shop("widget", s, d)


def shop_catalogue_retail(s, d):
    return _shop("retail", s, d)


def all_shops_report(s, d):
    """Three shops of pages and one of feeds, united, with one vocabulary and brand groups, compared."""
    shops = [_shop(kind, s, d, extras=("volume_unit",)).withColumn("source", F.lit(kind)) for kind in v.PROFILES]
    feed = feed_products(s, d).withColumns({"source": F.lit("feed"), "volume_unit": F.lit("ml")})
    # Written before it is compared: the plans that parse the pages are analysed and run once, not with every step on top.
    master = v.harmonise(stored(v.build_master([*shops, feed]), "master"), v.VOCABULARY)
    groups = v.group_table(s, {"Brand#1": "Groupe", "Brand#2": "Groupe", "Maison": "Maison"})
    return v.brand_report(v.brand_group(master, groups), by="brand_group")


def all_shops_labels(s, d):
    """The common labels of the same master table."""
    shops = [_shop(kind, s, d).withColumn("source", F.lit(kind)) for kind in v.PROFILES]
    feed = feed_products(s, d).withColumn("source", F.lit("feed"))
    master = v.harmonise(stored(v.build_master([*shops, feed]), "master"), v.VOCABULARY)
    return v.count_by(master, ["source", "finish_type", "coverage_level", "availability"])


# ---- feeds ---------------------------------------------------------------------------

def feed_read(s, d):
    return v.read_feed(I.feed_pages(s, d)).select("feed", "page", F.size("products").alias("n_products"))


def feed_products(s, d):
    return v.feed_products(v.read_feed(I.feed_pages(s, d)), f"{I.BASE}/products/")


ALL: dict[str, Query] = {
    f.__name__: f
    for f in (
        brand_report, brand_report_promo, master_union, master_rows, numbered_rows, record_with_defaults, csv_round_trip,
        csv_rejected_rows, rank_products, rank_shade_counts, harmonised_from_table, shop_links_with_page_store, document_first_of_many,
        brand_benchmark, brand_benchmark_category, count_by_category, category_split, finish_mix, finish_table,
        coverage_mix, skin_mix, family_rollup, availability_rate, promo_depth, completeness, rank_price,
        rank_reviews, rank_rating_by_shop, market_gap_price, market_gap_rating, harmonised_labels,
        unmapped_labels, brand_groups, price_direction, families, normalised_text, page_links,
        page_links_resolved, page_slugs, offer_slugs, keyword_gate_pages, keyword_gate_rows, keyword_gate_parts,
        pattern_gate_pages, first_seen_links, first_seen_in_page, first_seen_article, listing_join,
        shop_links, shop_links_widget, shop_links_retail, shop_links_with_page, shop_frontier, first_links, visible_text,
        document_first_match, document_tags, document_numbers, stored_page_shades, offer_prices, offer_text_fields,
        ld_blocks, ld_blocks_unlisted, ld_first_product, ld_last_crumb, products_structured, products_widget,
        products_retail, web_page_products, shop_catalogue, shop_catalogue_limited, shop_catalogue_widget,
        shop_catalogue_retail, all_shops_report, all_shops_labels, feed_read, feed_products,
    )
}
