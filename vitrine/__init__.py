"""Product catalogues of several shops on Spark: collect, unite, compare."""

from vitrine.functions.numbers import price_pair, prices, volume
from vitrine.functions.rules import Tag, all_matches, first_match
from vitrine.functions.text import normalise, visible_text
from vitrine.functions.urls import absolute_url, canonical_url, slug
from vitrine.operators.blocks import json_ld_blocks, pick_block, with_text
from vitrine.operators.links import (
    article_key, attach_listing, attach_pages, extract_links, first_position, first_seen, frontier, keyword_gate, linked_pages,
    listing_table, pattern_gate, product_links, take_first, unique_links,
)
from vitrine.operators.master import (
    brand_group, build_master, harmonise, number_rows, price_direction, split_family, unmapped,
)
from vitrine.operators.metrics import (
    availability_rate, brand_benchmark, completeness, count_by, count_where, explode_tags, family_rollup,
    finish_mix, finish_table, in_stock, market_gap, master_size, promo_depth, rank_brands, rank_rows, tag_mix,
)
from vitrine.operators.products import extract_products, named_only
from vitrine.plans.collect import collect_catalogue, collect_links, page_records
from vitrine.plans.report import brand_report
from vitrine.profiles import LISTING_KEYWORDS, PROFILES, RETAIL, STRUCTURED, WIDGET, LinkRules, Profile
from vitrine.schema import CANONICAL, FEED, FIELDS, RAW, conform, to_canonical
from vitrine.vocabulary import VOCABULARY, group_table, vocabulary_table
from vitrine.sources import (
    bucket_pages, feed_products, read_catalog_csv, read_catalog_csv_checked, read_catalogs, read_feed, read_pages, write_catalog_csv,
)

__all__ = [name for name in dir() if not name.startswith("_")]
