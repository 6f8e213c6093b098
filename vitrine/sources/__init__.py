"""Readers and writers."""

from vitrine.sources.catalog_csv import read_catalog_csv, read_catalog_csv_checked, read_catalogs, write_catalog_csv
from vitrine.sources.feed import feed_products, read_feed
from vitrine.sources.stored_pages import bucket_pages, read_pages

__all__ = [
    "bucket_pages", "feed_products", "read_catalog_csv", "read_catalog_csv_checked", "read_catalogs", "read_feed", "read_pages",
    "write_catalog_csv",
]
