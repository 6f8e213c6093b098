"""One scan over a stored page: its elements as intervals, its text nodes, its data scripts.

The nesting of tags, with the end tags that HTML implies, can't be followed by built-in column functions in linear
time. This small parser does it in Arrow batches; everything that is read from its result is a column expression.
Elements nest or lie apart, so that containment is a comparison of numbers. Positions are characters of the page.
"""

from __future__ import annotations

import re
import sys
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle

# Executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of pages that are parsed before their elements become Arrow arrays.
SLICE = 1 << 21

_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
#: Markup of any kind: raw elements, comments, declarations, tags; last what never ends, after which all is text.
#: A quoted attribute value may hold ">".
_MARKUP = re.compile(
    rf"<(?:(script|style|template)(?![\w-])({_INSIDE})>(.*?)(?:</\1\s*+>|\Z())|!--.*?(?:-->|\Z)|[!?][^>]*+>"
    rf"|(/?)([a-zA-Z][^\s/>]*+)({_INSIDE})>|(/?[a-zA-Z!?]))", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+""")

# Elements without content, and end tags that HTML implies: what an opening tag closes, and within what.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = ("address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
           "hgroup hr li main menu nav ol p pre section summary table ul")
_PARAGRAPH = (("p",), ("button", "table", "td", "th", "caption", "object"))
IMPLIED = {name: [_PARAGRAPH] for name in _BLOCKS.split()}
for _names, _closed, _within in (
        ("li", "li", "ul ol menu"), ("dt dd", "dt dd", "dl"), ("option", "option", "select datalist optgroup"),
        ("optgroup", "option optgroup", "select"), ("tr", "tr td th", "table"), ("td th", "td th", "tr table"),
        ("thead tbody tfoot", "tr td th thead tbody tfoot", "table")):
    for _name in _names.split():
        IMPLIED[_name] = [(tuple(_closed.split()), tuple(_within.split())), *IMPLIED.get(_name, ())]
#: What an end tag from outside doesn't reach into, table parts excepted.
BARRIERS = ("td", "th", "caption", "button", "object")
_TABLE = frozenset(("table", "tr", "thead", "tbody", "tfoot", *BARRIERS))
_CODE = re.compile(r"(?i)^(?:module|(?:text|application)/(?:x-)?(?:java|ecma)script.*)?$")

ELEMENT = pa.struct([("tag", pa.string()), ("start", pa.int32()), ("inner", pa.int32()), ("end", pa.int32()), ("depth", pa.int32()),
                     ("attributes", pa.map_(pa.string(), pa.string()))])
TEXT = pa.struct([("at", pa.int32()), ("text", pa.string())])
SCRIPT = pa.struct([("type", pa.string()), ("text", pa.string())])
PAGE = pa.struct([("elements", pa.list_(ELEMENT)), ("texts", pa.list_(TEXT)), ("scripts", pa.list_(SCRIPT))])
DDL = ("struct<elements:array<struct<tag:string,start:int,inner:int,end:int,depth:int,attributes:map<string,string>>>,"
       "texts:array<struct<at:int,text:string>>,scripts:array<struct<type:string,text:string>>>")


def attributes(inside: str) -> dict[str, str]:
    """Names in lower case and decoded values of an opening tag; of repeated names the first counts."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(inside):
        name = name.lower()
        if name not in out:
            if value[:1] in "\"'":
                value = value[1:-1]
            out[name] = unescape(value) if "&" in value else value
    return out


class Columns:
    """The pages of a batch, field by field."""

    def __init__(self):
        self.tag, self.start, self.inner, self.end, self.depth = [], [], [], [], []
        self.names, self.values, self.ends_of_attributes = [], [], [0]
        self.at, self.text, self.types, self.codes = [], [], [], []
        self.ends = [0], [0], [0]

    def page(self, html: str) -> None:
        if html:
            self._scan(html)
        for ends, column in zip(self.ends, (self.tag, self.at, self.types)):
            ends.append(len(column))

    def _scan(self, html: str) -> None:
        tag, start, inner, end, depth = self.tag, self.start, self.inner, self.end, self.depth
        names, values, marks = self.names, self.values, self.ends_of_attributes
        at, text = self.at, self.text
        stack: list[int] = []  # open elements, as places in the columns
        opened: dict[str, list[int]] = {}  # heights of the open elements of a name

        def close(height: int, position: int) -> None:
            """Ends all open elements from ``height`` on."""
            while len(stack) > height:
                place = stack.pop()
                end[place] = position
                opened[tag[place]].pop()

        def top(those) -> int:
            return max([opened[n][-1] for n in those if opened.get(n)], default=-1)

        done = 0
        for m in _MARKUP.finditer(html):
            here = m.start()
            if m[8] is not None:
                break
            if here > done:
                node = html[done:here]
                node = (unescape(node) if "&" in node else node).strip()
                if node:
                    at.append(done)
                    text.append(node)
            done = m.end()
            name = m[6]
            if name is None:
                raw = m[1]
                if raw is None:
                    continue
                name, inside = raw.lower(), m[2]
            else:
                name, inside = name.lower(), m[7]
                if m[5]:
                    heights = opened.get(name)
                    if heights and (name in _TABLE or heights[-1] > top(BARRIERS)):
                        close(heights[-1], here)
                    continue
            for closed, within in IMPLIED.get(name, ()):
                heights = [opened[n][-1] for n in closed if opened.get(n)]
                if heights:
                    limit = top(within)
                    heights = [h for h in heights if h > limit]
                    if heights:
                        close(min(heights), here)
            place = len(tag)
            tag.append(name)
            start.append(here)
            depth.append(len(stack))
            own = attributes(inside) if inside and not inside.isspace() else {}
            names.extend(own)
            values.extend(own.values())
            marks.append(len(names))
            if m[1] is not None:
                inner.append(m.start(3))
                end.append(m.end(3))
                kind = own.get("type", "").strip()
                if name == "script" and m[4] is None and not _CODE.match(kind):
                    self.types.append(kind)
                    self.codes.append(m[3])
            elif name in VOID:
                inner.append(done)
                end.append(done)
            else:
                inner.append(done)
                end.append(len(html))
                opened.setdefault(name, []).append(len(stack))
                stack.append(place)
        node = html[done:]
        node = (unescape(node) if "&" in node else node).strip()
        if node:
            at.append(done)
            text.append(node)

    def array(self) -> pa.Array:
        ints, texts = pa.int32(), pa.string()
        pairs = pa.MapArray.from_arrays(
            pa.array(self.ends_of_attributes, ints), pa.array(self.names, texts), pa.array(self.values, texts))
        elements = pa.StructArray.from_arrays(
            [pa.array(self.tag, texts), *(pa.array(x, ints) for x in (self.start, self.inner, self.end, self.depth)), pairs], fields=list(ELEMENT))
        nodes = pa.StructArray.from_arrays([pa.array(self.at, ints), pa.array(self.text, texts)], fields=list(TEXT))
        scripts = pa.StructArray.from_arrays([pa.array(self.types, texts), pa.array(self.codes, texts)], fields=list(SCRIPT))
        lists = [pa.ListArray.from_arrays(pa.array(ends, ints), x) for ends, x in zip(self.ends, (elements, nodes, scripts))]
        return pa.StructArray.from_arrays([x.cast(f.type) for x, f in zip(lists, PAGE)], fields=list(PAGE))


def parse(pages: pa.Array) -> pa.Array:
    """The tables of a batch of pages; a null page has empty ones. Only a slice of the batch is held as Python objects."""
    done, columns, size = [], Columns(), 0
    for page in pages:
        html = page.as_py()
        columns.page(html or "")
        size += len(html or "")
        if size >= SLICE:
            done.append(columns.array())
            columns, size = Columns(), 0
    return pa.concat_arrays([*done, columns.array()])
