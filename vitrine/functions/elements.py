"""Selectors over the elements of a stored page.

``page_table`` scans a page once. It holds the elements with tag, attributes and the interval they cover, the visible text
nodes with their places, and the data scripts. A selector is a filter over the elements; an element or text lies in another
element if its place lies in that one's interval. All functions below take the page table, not the HTML.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache, reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F

from vitrine.functions.once import let
from vitrine.functions.page_parser import DDL, parse


@cache
def _scan() -> Callable[[Column], Column]:
    return F.arrow_udf(parse, DDL)


def page_table(html: Column) -> Column:
    """``struct<elements, texts, scripts>`` of a page; empty arrays for null."""
    return _scan()(html)


@dataclass(frozen=True)
class Attr:
    """A test on one attribute of an element."""

    name: str
    value: str
    mode: str  # "has": part of the value, "word": one of its words, "is": all of it
    wanted: bool = True

    def fits(self, element: Column) -> Column:
        value = element["attributes"][self.name]
        if self.mode == "word":
            words = F.concat(F.lit(" "), F.translate(value, "\t\n\f\r", "    "), F.lit(" "))
            found = F.contains(words, F.lit(f" {self.value} "))
        else:
            found = F.contains(value, F.lit(self.value)) if self.mode == "has" else value == self.value
        found = F.coalesce(found, F.lit(False))
        return found if self.wanted else ~found


@dataclass(frozen=True)
class Tag:
    name: str
    attrs: tuple[Attr, ...]
    except_all: tuple[Attr, ...] = ()

    def fits(self, element: Column) -> Column:
        tests = [element["tag"] == self.name] if self.name else []
        tests += [a.fits(element) for a in self.attrs]
        if self.except_all:
            tests.append(~reduce(and_, [a.fits(element) for a in self.except_all]))
        return reduce(and_, tests, F.lit(True))


@dataclass(frozen=True)
class Selector:
    """The elements that fit one of the tags."""

    tags: tuple[Tag, ...]

    def fits(self, element: Column) -> Column:
        return reduce(or_, [t.fits(element) for t in self.tags])


def has(name: str, part: str) -> Attr:
    """The attribute contains ``part`` (CSS ``[name*='part']``)."""
    return Attr(name, part, "has")


def lacks(name: str, part: str) -> Attr:
    """The attribute does not contain ``part``."""
    return Attr(name, part, "has", wanted=False)


def equals(name: str, value: str) -> Attr:
    """The attribute is exactly ``value``."""
    return Attr(name, value, "is")


def word(name: str, value: str) -> Attr:
    """One of the blank-separated words of the attribute is ``value`` (CSS ``.value``)."""
    return Attr(name, value, "word")


def tag(*attrs: Attr, name: str = "", except_all: tuple[Attr, ...] = ()) -> Tag:
    """An element with a name (any by default) that passes all tests.

    Elements that pass all tests of ``except_all`` are left out.
    """
    return Tag(name, attrs, except_all)


def any_of(*tags: Tag) -> Selector:
    """The elements that fit one of ``tags``, in page order."""
    return Selector(tags)


def elements(page: Column, selector: Selector, zone: Selector | None = None) -> Column:
    """All elements that fit, in page order; with ``zone`` those inside an element that fits the zone."""
    if zone is None:
        return F.filter(page["elements"], selector.fits)

    def inside(zones: Column) -> Column:
        return F.filter(page["elements"], lambda e: selector.fits(e) & F.exists(
            zones, lambda z: (e["start"] >= z["inner"]) & (e["start"] < z["end"])))

    return let(elements(page, zone), inside)


def first(page: Column, selector: Selector) -> Column:
    """The first element that fits; null when there is none."""
    return F.get(elements(page, selector), F.lit(0))


def count(page: Column, selector: Selector, zone: Selector | None = None) -> Column:
    return F.size(elements(page, selector, zone))


def attribute(element: Column, name: str) -> Column:
    """Decoded value of one attribute of an element, empty when absent."""
    return F.coalesce(element["attributes"][name], F.lit(""))


def meta(page: Column, prop: str) -> Column:
    """``content`` of the first ``<meta property=...>``."""
    return let(first(page, any_of(tag(equals("property", prop), name="meta"))), lambda e: attribute(e, "content"))


def text_of(page: Column, element: Column, between: str) -> Column:
    """Visible text nodes inside one element, each stripped, joined by ``between``."""
    nodes = F.filter(page["texts"], lambda t: (t["at"] >= element["inner"]) & (t["at"] < element["end"]))
    return F.array_join(F.transform(nodes, lambda t: t["text"]), between)


def all_text(page: Column) -> Column:
    """Visible text of the whole page: its nodes joined by one space."""
    return F.array_join(F.transform(page["texts"], lambda t: t["text"]), " ")


def _of_first(page: Column, selector: Selector, value: Callable[[Column], Column]) -> Column:
    return let(first(page, selector), lambda e: F.when(e.isNotNull(), value(e)))


def zone_text(page: Column, selector: Selector) -> Column:
    """Visible text of the first element that fits; null when there is none."""
    return _of_first(page, selector, lambda e: text_of(page, e, " "))


def joined_text(page: Column, selector: Selector) -> Column:
    """As ``zone_text`` with the text nodes joined without a space."""
    return _of_first(page, selector, lambda e: text_of(page, e, ""))


def list_texts(page: Column, zone: Selector, item: str) -> Column:
    """Texts of the ``item`` elements inside the ``zone`` elements, in page order."""
    return F.transform(elements(page, any_of(tag(name=item)), zone), lambda e: text_of(page, e, ""))
