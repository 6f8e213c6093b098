"""Link addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def absolute_url(href: Column, base: str | Column) -> Column:
    """``/path`` behind ``base``, ``http...`` as it is, anything else null."""
    base = F.lit(base) if isinstance(base, str) else base
    return F.when(F.startswith(href, F.lit("/")), F.concat(base, href)).when(
        F.startswith(href, F.lit("http")), href
    )


#: Column of a bucketed page store with the canonical address.
PLAIN_URL = "_plain_url"


def canonical_url(url: Column) -> Column:
    """The address without its query string."""
    return F.substring_index(url, "?", 1)


def slug(url: Column, kind: str = "last", length: int | None = None) -> Column:
    """Short display name of an address.

    ``last``: last path part, 60 characters. ``product``: part behind the last
    ``/p/``, 50 characters, else the last 40 characters. ``locale``: part behind
    the last ``/fr/``, 50 characters. ``length`` replaces these numbers; 0 cuts nothing.
    """
    def cut(part: Column, usual: int) -> Column:
        n = usual if length is None else length
        return F.substring(part, 1, n) if n else part

    if kind == "last":
        return cut(F.substring_index(url, "/", -1), 60)
    if kind == "locale":
        return cut(F.substring_index(url, "/fr/", -1), 50)
    if kind == "product":
        n = 40 if length is None else length
        rest = F.right(url, F.lit(n)) if n else url
        return F.when(F.contains(url, F.lit("/p/")), cut(F.substring_index(url, "/p/", -1), 50)).otherwise(rest)
    raise ValueError(f"unknown slug kind {kind!r}")
