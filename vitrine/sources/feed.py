"""Paged JSON product feeds kept as a table of page bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.profiles import FEED_BLOCKED_TYPES
from vitrine.functions.rules import contains_any
from vitrine.schema import FEED, FIELDS, conform


def read_feed(pages: DataFrame, max_pages: int | None = None, first_page: int = 1) -> DataFrame:
    """Parsed pages ``(feed, page, products)`` from ``first_page`` up to the first failed, empty or missing one.

    ``pages`` holds ``(feed, page, status, body)``. A page fails when its status is not 200 or its body has no
    readable list of products. Which pages count is settled on short rows ``(feed, page)``, which are joined back on both
    columns: a feed that holds a large part of all pages is no hot key there, and each kept body is parsed once.
    """
    bounds = F.col("page") >= first_page
    if max_pages is not None:
        bounds = bounds & (F.col("page") < first_page + max_pages)
    listed = F.json_array_length(F.get_json_object("body", "$.products"))
    usable = pages.filter(bounds & (F.col("status") == 200) & (listed > 0)).select("feed", "page").distinct()
    # A page whose successor isn't usable is the last of its run; the first run must begin at the first page.
    before = usable.select("feed", (F.col("page") - 1).alias("page"))
    last = usable.join(before, ["feed", "page"], "left_anti").groupBy("feed").agg(F.min("page").alias("last"))
    begun = usable.filter(F.col("page") == first_page).select("feed")
    kept = usable.join(last.join(begun, "feed", "left_semi"), "feed").filter("page <= last").select("feed", "page")
    return pages.join(kept, ["feed", "page"], "left_semi").select(
        "feed", "page", F.from_json("body", FEED)["products"].alias("products"))


def _by_title(title: Column, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """First rule of which all words occur."""
    chain = F.lit(default)
    for words, value in reversed(rules):
        test = F.lit(True)
        for w in words:
            test = test & F.contains(title, F.lit(w))
        chain = F.when(test, value).otherwise(chain)
    return chain


# ---- Fixed values: what the feed shop's titles tell ------------------------------
FEED_FINISH = [(("matte",), "mat"), (("powder",), "mat"), (("soft'lit",), "lumineux")]
FEED_COVERAGE = [(("matte", "longwear"), "couvrant"), (("soft'lit",), "moyen")]
FEED_SKIN = [(("matte",), "grasse"), (("soft'lit",), "sèche")]
FEED_SMALL = ("mini", "12")          # variant titles of a 12 ml product
FEED_STICK = ("stick", "powder")     # product titles of a 9 ml product


def feed_products(
    feed: DataFrame, base_url: str, blocked_types: Sequence[str] = FEED_BLOCKED_TYPES
) -> DataFrame:
    """One product record per feed product, from its title and its first variant.

    A price that is no number becomes null. A product without a type passes the block list; one without variants is kept
    with no price and counts as unavailable.
    """
    products = feed.select(F.col("feed").alias("source"), F.explode("products").alias("p"))
    if blocked_types:
        products = products.filter(~F.coalesce(F.col("p.product_type"), F.lit("")).isin(*blocked_types))
    shaped = products.select(
        "source",
        "p",
        F.get("p.variants", F.lit(0)).alias("v"),
        F.coalesce(F.size("p.variants"), F.lit(0)).alias("shade_count"),
        F.lower("p.title").alias("title"),
    )
    variant = F.lower(F.coalesce(F.col("v.title"), F.lit("")))
    size = (
        F.when(contains_any(variant, FEED_SMALL), "12")
        .when(contains_any(F.col("title"), FEED_STICK), "9")
        .otherwise("32")
    )
    none = F.lit(None).cast("string")
    record = {
        "product_name": F.col("p.title"),
        "brand": F.col("p.vendor"),
        "category": F.coalesce(F.col("p.product_type"), F.lit("")),
        "price": F.col("v.price"),
        "promo_price": F.col("v.compare_at_price"),
        "volume_ml": size,
        "rating": none,
        "review_count": none,
        "shade_count": F.col("shade_count"),
        "finish_type": _by_title(F.col("title"), FEED_FINISH, "naturel"),
        "coverage_level": _by_title(F.col("title"), FEED_COVERAGE, "léger"),
        "skin_type": _by_title(F.col("title"), FEED_SKIN, "mixte"),
        "availability": F.when(F.col("v.available"), "en stock").otherwise("rupture"),
        "source_url": F.concat(F.lit(base_url), F.col("p.handle")),
    }
    return conform(shaped.select("source", *[record[f].alias(f) for f in FIELDS]), strict=False)
