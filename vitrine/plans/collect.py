"""From stored pages to product records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.functions.urls import canonical_url
from vitrine.operators.links import (
    first_seen, keyword_gate, linked_pages, pattern_gate, product_links, take_first, unique_links,
)
from vitrine.operators.products import extract_products, named_only, settle_category
from vitrine.profiles import Profile
from vitrine.schema import FIELDS
from vitrine.shared import stored


def collect_links(
    pages: DataFrame, listing: DataFrame, profile: Profile, base: str, domain: str | None = None
) -> DataFrame:
    """Unique product links ``(source, listing_no, pos, url, category)`` of the listing pages."""
    return unique_links(product_links(pages, listing, profile, base, domain), profile.links.article, listing)


def page_records(
    pages: DataFrame, profile: Profile, brand: str, domain: str | None = None
) -> DataFrame:
    """One record per address of a stored product page, category still open.

    The address gates run before the HTML is parsed. The records, not the pages, are
    reduced to one per address: a few short columns are shuffled instead of HTML, and
    copies of one page are combined inside each task.
    """
    rules = profile.links
    candidates = pages.select("url", "html", canonical_url(F.col("url")).alias("_plain"))
    candidates = pattern_gate(candidates, "_plain", domain, rules.pattern, rules.suffix)
    candidates = keyword_gate(candidates, "_plain", exclude=rules.exclude).select("url", "html")
    records = extract_products(candidates, profile, brand, extras=True)
    keyed = records.withColumn("url", canonical_url(F.col("source_url")))
    return first_seen(keyed, ["url"], ["source_url", "content"])


def collect_catalogue(
    pages: DataFrame,
    listing: DataFrame,
    profile: Profile,
    *,
    brand: str,
    base: str,
    domain: str | None = None,
    limit: int | None = None,
    extras: tuple[str, ...] = (),
) -> DataFrame:
    """Product records of all links found on the listing pages whose page is stored.

    ``pages(url, html)`` holds listing and product pages alike; ``listing`` is
    ``(source, listing_no, url, category, positive)``. ``limit`` takes the first links
    in discovery order. The links are found and written to the shared folder first; only pages that one of
    them leads to are parsed.
    """
    links = collect_links(pages, listing, profile, base, domain)
    if limit is not None:
        links = take_first(links, limit, ["listing_no", "pos", "source", "url"])
    links = stored(links, "links")
    records = page_records(linked_pages(pages, links), profile, brand, domain).drop("category")
    joined = links.select("source", "url", F.col("category").alias("_listing")).join(records, "url", "inner")
    settled = joined.withColumns({
        "category": settle_category(profile, F.col("_listing"), F.col("crumb_ld"), F.col("crumb_links")),
        "source_url": F.col("url"),
    })
    if profile.name_required:
        settled = named_only(settled)
    return settled.select("source", *FIELDS, *extras)
