"""Embedded JSON-LD of a page as VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vitrine.functions.html import any_of, equals, tag
from vitrine.functions.once import keep_if, let, nonblank
from vitrine.functions.text import strip, without_comments

_OPENING = any_of(tag(equals("type", "application/ld+json"), name="script"))
_SCRIPT = rf"{_OPENING.pattern}((?:[^<]++|<(?!/(?i:script)\s*+>))*+)</(?i:script)\s*+>"


def _is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def _only_value(text: Column) -> Column:
    """The one JSON value of a text; null for none, several or trailing characters."""
    # The parser stops behind the first value; the brackets make it read to the end.
    values = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), strip(text), F.lit("]"))), "$", "array<variant>"
    )
    return F.get(keep_if(values, lambda x: F.size(x) == 1), F.lit(0))


def block_array(html: Column, flatten_lists: bool = True) -> Column:
    """ARRAY<VARIANT> of the JSON-LD values of a page, in page order.

    Blank and broken blocks are skipped. A block that is a list gives its entries, or
    itself with ``flatten_lists=False``; ``of_type`` picks objects only.
    """
    texts = F.regexp_extract_all(without_comments(html), F.lit(_SCRIPT), F.lit(1))
    parsed = F.filter(F.transform(texts, _only_value), lambda v: v.isNotNull())
    if flatten_lists:
        parsed = F.flatten(
            F.transform(parsed, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)))
        )
    none = F.array().cast("array<variant>")
    return F.when(F.contains(html, F.lit("ld+json")), parsed).otherwise(none)


def objects(blocks: Column) -> Column:
    """The blocks that are JSON objects."""
    return F.filter(blocks, lambda b: F.coalesce(_is_object(b), F.lit(False)))


def of_type(blocks: Column, *types: str) -> Column:
    """The blocks whose ``@type`` is one of ``types``."""
    return F.filter(
        blocks, lambda b: F.coalesce(F.try_variant_get(b, "$['@type']", "string").isin(*types), F.lit(False))
    )


def get(block: Column, path: str) -> Column:
    """Text at ``path``, null when absent."""
    return F.try_variant_get(block, path, "string")


def truthy(block: Column, path: str) -> Column:
    """Text at ``path`` unless it is absent, empty, false or the number zero.

    The text "0" counts, the number 0 does not.
    """
    text = F.try_variant_get(block, path, "string")
    is_text = F.schema_of_variant(F.try_variant_get(block, path, "variant")) == "STRING"
    empty = lambda x: x.isin("false", "{}", "[]") | (x.try_cast("double") == 0)
    return let(nonblank(text), lambda x: F.when(is_text | ~F.coalesce(empty(x), F.lit(False)), x))


def kind_of(block: Column, path: str) -> Column:
    """``OBJECT``, ``ARRAY``, ``STRING``, ... of the value at ``path``."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(block, path, "variant")), r"^[A-Z]+", 0)
