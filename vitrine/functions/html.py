"""Elements and attributes of stored HTML by regular expression.

There is no DOM here. A selector is a regex for the opening tag of the wanted
element; ``element()`` then follows the nesting of that tag name up to its own
closing tag. The functions expect what ``text.markup`` makes of a page: no comments
and scripts, and no angle brackets inside attribute values.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from vitrine.functions.once import let, nonblank
from vitrine.functions.text import BLANK_CHARS, MARK, RAW, decode_references, strip, visible_text

_ANY_TAG = r"[a-zA-Z][\w-]*+"
_TAG_END = "[^>]*+>"


@dataclass(frozen=True)
class Attr:
    """A test on one attribute of an opening tag."""

    name: str
    value: str
    mode: str  # "has": part of the value, "word": one of its words, "is": all of it
    wanted: bool = True

    def inside(self, quote: str) -> str:
        """The value from its opening quote on (``quote`` is empty for a bare value)."""
        text = re.escape(self.value)
        others = rf"[^{quote}>]" if quote else r"""[^\s"'>]"""
        end = rf"[\s{quote}]" if quote else r"[\s/>]"
        if self.mode == "has":
            return rf"{others}*?{text}"
        if self.mode == "word":
            return rf"(?:{others}*?\s)?{text}{end}"
        return rf"{text}{quote or end}"


@dataclass(frozen=True)
class Tag:
    name: str
    attrs: tuple[Attr, ...]
    except_all: tuple[Attr, ...] = ()


@dataclass(frozen=True)
class Selector:
    """A regex for the opening tag and texts of which a page must hold at least one."""

    pattern: str
    hints: tuple[str, ...]


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
    """An opening tag with a name (any by default) that passes all tests.

    Tags that pass all tests of ``except_all`` are left out.
    """
    return Tag(name, attrs, except_all)


def _look(attrs: list[Attr], wanted: bool) -> str:
    """Look-ahead over the attributes of a tag: one of ``attrs``, which share a name."""
    inside = {quote: "|".join(a.inside(quote) for a in attrs) for quote in ('"', "'", "")}
    values = "|".join(f"{quote}(?:{test})" for quote, test in inside.items())
    return rf"(?{'=' if wanted else '!'}[^>]*?\s{attrs[0].name}\s*+=\s*+(?:{values}))"


def any_of(*tags: Tag) -> Selector:
    """The opening tags that fit one of ``tags``.

    Tags that differ in the tested value only share one look-ahead, so a tag without
    the attribute is passed over once.
    """
    shared: dict[tuple, list[Attr]] = {}
    branches = []
    for t in tags:
        if len(t.attrs) == 1 and t.attrs[0].wanted and not t.except_all:
            shared.setdefault((t.name, t.attrs[0].name), []).append(t.attrs[0])
        else:
            tests = "".join(_look([a], a.wanted) for a in t.attrs)
            if t.except_all:
                tests += f"(?!{''.join(_look([a], a.wanted) for a in t.except_all)})"
            branches.append(_named(t.name) + tests)
    branches += [_named(name) + _look(attrs, True) for (name, _), attrs in shared.items()]
    hints = {next((a.value for a in t.attrs if a.wanted), f"<{t.name}" if t.name else "<") for t in tags}
    return Selector(rf"<(?:{'|'.join(branches)}){_TAG_END}", tuple(sorted(hints)))


def _named(name: str) -> str:
    return rf"(?i:{name})(?![\w-])" if name else _ANY_TAG


def hinted(html: Column, selector: Selector) -> Column:
    """Cheap test that spares most pages the regex; tag names may come in capitals."""
    texts = [x for h in selector.hints for x in ({h, h.upper()} if h.startswith("<") else {h})]
    return reduce(or_, [F.contains(html, F.lit(x)) for x in sorted(texts)])


def first_tag(html: Column, selector: Selector) -> Column:
    """The first opening tag that fits, or an empty string."""
    return F.when(hinted(html, selector), F.regexp_extract(html, selector.pattern, 0)).otherwise("")


def all_tags(html: Column, selector: Selector) -> Column:
    """All opening tags that fit, in page order."""
    found = F.regexp_extract_all(html, F.lit(selector.pattern), F.lit(0))
    return F.when(hinted(html, selector), found).otherwise(F.array().cast("array<string>"))


def count_tags(html: Column, selector: Selector) -> Column:
    return F.size(all_tags(html, selector))


def attribute(opening_tag: Column, name: str) -> Column:
    """Value of one attribute of an opening tag, empty when absent."""
    value = F.regexp_extract(
        opening_tag,
        rf"""\s{name}\s*=\s*["']?((?<=")[^"]*|(?<=')[^']*|(?<=[=\s])[^\s"'>]+)""",
        1,
    )
    return decode_references(value)


def attributes(html: Column, selector: Selector, name: str) -> Column:
    """``attribute`` of all opening tags that fit, in page order, from one scan of the page."""
    # A value whose quote is never closed ends with its tag.
    value = rf"""\s{name}\s*=\s*["']?((?<=")[^">]*+>?|(?<=')[^'>]*+>?|(?<=[=\s])[^\s"'>]+)"""
    body = selector.pattern.removesuffix(_TAG_END)
    found = F.regexp_extract_all(html, F.lit(rf"{body}(?:(?=[^>]*?{value})|){_TAG_END}"), F.lit(1))
    values = F.when(hinted(html, selector), found).otherwise(F.array().cast("array<string>"))
    return let(values, _decoded)


def _decoded(values: Column) -> Column:
    return F.when(F.exists(values, lambda x: F.contains(x, F.lit("&"))), F.transform(values, decode_references)).otherwise(values)


# What a tidy page is made of: text, raw elements, comments, and tags whose quotes are closed. Quoted values without "<", and without
# what looks like a value in the other quotes, can't be taken for anything else, wherever the page is read from.
_DOUBLE = r"""\s*+"[^"<=]*+(?:=(?!\s*+')[^"<=]*+)*+\""""
_SINGLE = r"""\s*+'[^'<=]*+(?:=(?!\s*+")[^'<=]*+)*+'"""
_INSIDE = rf"""[^<>=]*+(?:=(?:{_DOUBLE}|{_SINGLE}|(?!\s*+["']))[^<>=]*+)*+"""
_TEXT = r"""[^<=]++|=(?!\s*+["'<])"""


def tidy_attributes(html: Column, tag_name: str, name: str) -> Column:
    """As ``attributes(markup(html), ...)`` of all opening tags with the name, for tidy pages; null for others.

    One pass over the page as it is stored, which leaves the values alone behind marks; a page that isn't tidy leaves more.
    """
    wanted = _named(tag_name)
    quoted = rf"""(?:{_DOUBLE}|{_SINGLE}|(?!\s*+["']))"""
    value = rf"""\s{name}\s*+(?=={quoted})=\s*+["']?+((?<=")[^"]*+|(?<=')[^']*+|(?<=[=\s])[^\s"'<>]++)"""
    before = rf"(?:[^<>=\s]++|\s(?!{name}\s*+=\s*+[^\s>])|={quoted})*+"
    # The pattern's first group is the name of a raw element.
    passed = rf"(?:{_TEXT}|<(?=[sStT!]){RAW.format(1)}|<(?!{wanted}){_INSIDE}>)*+"
    pattern = rf"(?s)\G{passed}(?:<{wanted}{before}(?:{value})?+{_INSIDE}>|(?!\G)\z)"
    left = F.regexp_replace(F.concat(html, F.lit(" ")), pattern, f"{MARK[0]}$2")
    return let(left, lambda x: F.when(F.endswith(x, F.lit(MARK[0])), let(
        F.split(x, MARK[0], -1), lambda v: _decoded(F.slice(v, F.lit(2), F.size(v) - 2)))))


def meta(html: Column, prop: str) -> Column:
    """``content`` of the first ``<meta property=...>``."""
    return attribute(first_tag(html, any_of(tag(equals("property", prop), name="meta"))), "content")


def _balanced(tail: Column) -> Column:
    """(text, closed): ``tail``, which starts with an opening tag, up to that tag's closing tag.

    The pieces between same-named tags are folded with a depth counter; an element that is never closed runs to the end.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("end"), F.lit(False).alias("closed"))

    def step(state: Column, piece: Column) -> Column:
        depth = state["depth"] + F.when(F.startswith(piece, F.lit("</")), -1).otherwise(1)
        closed = state["closed"] | (depth == 0)
        end = state["end"] + F.when(closed, 0).otherwise(F.length(piece))
        return F.struct(depth.alias("depth"), end.alias("end"), closed.alias("closed"))

    def cut(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, rf"^<({_ANY_TAG})", 1))
        pieces = F.split(t, F.concat(F.lit("(?i)(?=</?"), name, F.lit(r"(?![\w-]))")), -1)
        empty = F.rlike(t, F.lit(r"(?i)^<(?:meta|link|input|img|br|hr)(?![\w-])"))
        return F.when(empty, F.struct(F.regexp_extract(t, "^<[^>]*>", 0).alias("text"), F.lit(True).alias("closed"))).otherwise(
            let(F.aggregate(pieces, start, step), lambda s: F.struct(
                F.substring(t, F.lit(1), s["end"]).alias("text"), s["closed"].alias("closed"))))

    return let(tail, cut)


def balanced(tail: Column) -> Column:
    """Cut ``tail``, which starts with an opening tag, at that tag's closing tag."""
    return _balanced(tail)["text"]


def element(html: Column, selector: Selector) -> Column:
    """The first element that fits, opening tag included; null when there is none."""
    tail = nonblank(F.regexp_extract(html, rf"(?s){selector.pattern}.*", 0))
    return F.when(hinted(html, selector), balanced(tail))


def elements(html: Column, selector: Selector) -> Column:
    """Array of the elements that fit, the outermost only: what lies inside another one is part of it."""
    # The blank in front keeps the first piece from being an element.
    pieces = F.split(F.concat(F.lit(" "), html), f"(?={selector.pattern})", -1)
    first = F.struct(
        F.array().cast("array<string>").alias("found"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(state: Column, piece: Column) -> Column:
        """``at``: where the piece starts in the page; ``end``: where the last element ended."""
        next_at = state["at"] + F.length(piece)

        def opened(own: Column) -> Column:
            # Most elements close before the next one opens; only others are followed through the rest of the page.
            text = F.when(own["closed"], own["text"]).otherwise(balanced(F.substr(html, state["at"])))
            return let(text, lambda t: F.struct(
                F.array_append(state["found"], t).alias("found"), next_at.alias("at"), (state["at"] + F.length(t)).alias("end")))

        skipped = (state["at"] == 0) | (state["at"] < state["end"])
        return F.when(skipped, F.struct(
            state["found"].alias("found"), next_at.alias("at"), state["end"].alias("end"))).otherwise(let(_balanced(piece), opened))

    found = let(pieces, lambda p: F.aggregate(p, first, step, lambda s: s["found"]))
    return F.when(hinted(html, selector), found).otherwise(F.array().cast("array<string>"))


def zone_text(html: Column, selector: Selector) -> Column:
    """Visible text of the first element that fits; null when there is none."""
    return visible_text(element(html, selector))


def joined_text(html: Column, selector: Selector) -> Column:
    """As ``zone_text`` with the text nodes joined without a space."""
    inner = F.regexp_replace(element(html, selector), r"<!--.*?-->|<[^>]*>", "\u0001")
    nodes = F.transform(F.split(inner, "\u0001", -1), strip)
    return decode_references(F.array_join(nodes, ""))


def list_texts(html: Column, zone: Selector, item: str) -> Column:
    """Texts of the ``item`` elements inside all ``zone`` elements, in page order."""
    inside = F.array_join(elements(html, zone), " ")
    found = F.regexp_extract_all(
        inside, F.lit(rf"(?i)<{item}(?![\w-])[^>]*+>((?:[^<]++|<(?!/{item}\s*>|{item}(?![\w-])))*+)"), F.lit(1)
    )
    return F.transform(found, lambda x: decode_references(_joined(x)))


def _joined(fragment: Column) -> Column:
    return F.trim(F.regexp_replace(fragment, r"\s*<[^>]*>\s*", ""), F.lit(BLANK_CHARS))
