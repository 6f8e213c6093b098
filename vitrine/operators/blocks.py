"""JSON-LD blocks as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.functions.jsonld import block_array, objects, of_type
from vitrine.functions.text import visible_text


def with_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``text`` and ``text_lower``."""
    with_raw = pages.withColumn("text", visible_text(F.col(html)))
    return with_raw.withColumn("text_lower", F.lower("text"))


def json_ld_blocks(pages: DataFrame, flatten_lists: bool = True, key: str = "url") -> DataFrame:
    """One row ``(key, block_no, type, block)`` per JSON-LD object of a page."""
    rows = pages.select(key, F.posexplode(objects(block_array(F.col("html"), flatten_lists))).alias("block_no", "block"))
    return rows.select(key, "block_no", F.try_variant_get("block", "$['@type']", "string").alias("type"), "block")


def pick_block(pages: DataFrame, type: str, which: str = "first", flatten_lists: bool = True, key: str = "url") -> DataFrame:
    """(key, block) of each page with a block of the type: its first or last one, found in the row."""
    found = of_type(block_array(F.col("html"), flatten_lists), type)
    block = F.try_element_at(found, F.lit({"first": 1, "last": -1}[which]))
    # The explode keeps Catalyst from finding every block once more for the filter.
    return pages.select(key, F.explode(F.filter(F.array(block), lambda b: b.isNotNull())).alias("block"))
