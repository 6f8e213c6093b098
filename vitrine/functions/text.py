"""Visible text of a page, blanks, accents and character references."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column, functions as F

from vitrine.functions.once import let

# What counts as a blank. Java's \s and Spark's trim() leave the
# no-break spaces alone, which French price and name texts use all the time.
BLANK_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
#: The same set as the inside of a regex character class (Java and RE2).
BLANK = r"\x09-\x0D\x1C-\x20\x{85}\p{Z}"
#: One optional run of blanks.
GAP = f"[{BLANK}]*"
#: A word character; \b differs between regex engines next to accented letters.
WORD = r"\p{L}\p{N}_"

#: Named references of HTML, without ampersand and semicolon.
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
#: Those that count without a semicolon too, longest first.
LOOSE = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
#: Numbers that stand for a character of the old Windows code page.
OLD_NUMBERS = {n: bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}
# References of blanks, which belong to the blanks at the ends of a text node.
_BLANK_REFERENCES = (
    ("nbsp|NonBreakingSpace|#0*160|#[xX]0*[aA]0", "\xa0"), ("ensp|#0*8194|#[xX]0*2002", "\u2002"),
    ("emsp|#0*8195|#[xX]0*2003", "\u2003"), ("thinsp|ThinSpace|#0*8201|#[xX]0*2009", "\u2009"),
    ("#0*8239|#[xX]0*202[fF]", "\u202f"), ("Tab|#0*9|#[xX]0*9", "\t"),
    ("NewLine|#0*10|#[xX]0*[aA]", "\n"), ("#0*13|#[xX]0*[dD]", "\r"), ("#0*32|#[xX]0*20", " "),
)

# Accented letters and their plain forms, position by position.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"

# One piece of markup; a quoted attribute value may hold ">".
_TAG = r"""/?[a-zA-Z](?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
# What lies before an end, and the end: runs are taken at once, where ``.*?`` would try the end at every character.
_RAW_REST = r"(?:[^<]++|<(?!/(?i:\{0})\s*+>))*+(?:</(?i:\{0})\s*+>|\z)"
_COMMENT = r"!--(?:[^-]++|-(?!->))*+(?:-->|\z)"
_HIDDEN = rf"(?i:(script|style|template)\b)[^>]*+>{_RAW_REST.format(1)}"
_MARKUP = rf"<(?:{_HIDDEN}|{_COMMENT}|[!?][^>]*+>|{_TAG})"
# All markup between two pieces of text, with the blanks around it. Possessive
# loops keep the Java matcher iterative, so thousands of tags in a row are safe;
# the look-behind stops a long blank run from being retried at every position.
_BETWEEN = rf"(?s)(?=[<{BLANK}])(?<![{BLANK}])(?:[{BLANK}]*+{_MARKUP})++[{BLANK}]*+"


MARK = "\ufdd0\ufdd1"  # noncharacters, which no text may contain
_SLOTS = 1024


def _named_references() -> str:
    """The named references dealt over slots by a hash of their names, so that one is found without a walk over all of them.

    One text for the plan, as thousands of literals cost seconds in every query that is built on them.
    """
    slots = [""] * _SLOTS
    for name, text in ENTITIES.items():
        slots[crc32(name.encode()) % _SLOTS] += f"{MARK[0]}{name}{MARK[1]}{text}"
    return "\ufdd2".join(slots)


_NAMES = _named_references()
# From number 128 on; the numbers without a character there stand for themselves.
_OLD = "".join(OLD_NUMBERS.get(n, chr(n)) for n in range(128, 160))


def _named(name: Column) -> Column:
    """What the reference of this name stands for, null for unknown names."""
    slot = F.get(F.split(F.lit(_NAMES), "\ufdd2", -1), F.pmod(F.crc32(name), F.lit(_SLOTS)).cast("int"))
    key = F.concat(F.lit(MARK[0]), name, F.lit(MARK[1]))
    return let(slot, lambda s: F.when(F.contains(s, key), F.substring_index(_behind(s, key), MARK[0], 1)))


def _behind(text: Column, key: Column) -> Column:
    """The text behind the first ``key``, which must occur."""
    return F.substr(text, F.instr(text, key) + F.length(key))


def strip(text: Column) -> Column:
    """Remove blanks, no-break ones included, at both ends."""
    blanks = F.lit(BLANK_CHARS)
    # Trimming by a set walks the whole text and lays out all its characters; most texts have nothing to trim.
    return let(text, lambda t: F.when(
        F.contains(blanks, F.left(t, F.lit(1))) | F.contains(blanks, F.right(t, F.lit(1))), F.trim(t, blanks)).otherwise(t))


def collapse(text: Column) -> Column:
    """Turn each run of blanks into one space and strip the ends."""
    return F.trim(F.regexp_replace(text, f"[{BLANK}]+", " "))


def fold_accents(text: Column) -> Column:
    """Lower-case text without accents."""
    plain = F.translate(F.lower(text), ACCENTED, PLAIN)
    return F.replace(F.replace(plain, F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae"))


def normalise(text: Column) -> Column:
    """Matching key of a label: blanks collapsed, lower case, no accents."""
    return fold_accents(collapse(text))


def decode_references(text: Column) -> Column:
    """Decode ``&name;``, ``&#n;`` and ``&#xh;`` in one pass, as HTML does: old names and numbers need no semicolon."""
    def numbered(digits: Column) -> Column:
        code = F.when(
            F.rlike(digits, F.lit(r"^#[xX]0*[0-9A-Fa-f]{1,6}$")), F.conv(F.substr(digits, F.lit(3)), 16, 10).try_cast("int")
        ).when(F.rlike(digits, F.lit(r"^#0*\d{1,7}$")), F.substr(digits, F.lit(2)).try_cast("int"))
        return let(code, lambda c: F.when(c.between(128, 159), F.substr(F.lit(_OLD), c - 127, F.lit(1))).when(
            c.between(1, 0xD7FF) | c.between(0xE000, 0x10FFFF),
            F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"),
        ))

    def replaced(piece: Column, found: Column, value: Callable[[Column], Column]) -> Column:
        """The piece with the reference in front decoded; null if it is none. ``found``: as written, ampersand included."""
        return let(found, lambda f: F.when(f != "", F.concat(
            let(F.rtrim(F.substr(f, F.lit(2)), F.lit(";")), value), F.substr(piece, F.length(f) + F.lit(1)))))

    def decoded(piece: Column) -> Column:
        # The text in front of the first reference is none, however long it is.
        return F.when(F.startswith(piece, F.lit("&")), F.coalesce(
            replaced(piece, F.regexp_extract(piece, r"^&[0-9A-Za-z]{1,31};", 0), _named),
            replaced(piece, F.regexp_extract(piece, r"^&#(?:[xX][0-9A-Fa-f]+|\d+);?", 0), numbered),
            replaced(piece, F.regexp_extract(piece, f"^&(?:{'|'.join(LOOSE)})", 0), _named),
            piece,
        )).otherwise(piece)

    def whole(t: Column) -> Column:
        pieces = F.transform(F.split(t, "(?=&)", -1), decoded)
        return F.when(F.contains(t, F.lit("&")), F.array_join(pieces, "")).otherwise(t)

    # The references that ``markup`` writes need no lookup. What they stand for belongs to no reference, so none comes to be.
    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), let(_signs(t), whole)).otherwise(t))


def blank_references(html: Column) -> Column:
    """References of blanks as these blanks, so that they count at the ends of a text node."""
    for names, blank in _BLANK_REFERENCES:
        html = F.regexp_replace(html, f"&(?:{names});", blank)
    return html


def visible_text(html: Column) -> Column:
    """Text of the page: every text node stripped, joined by one space.

    Scripts, styles, templates and comments are left out. Blanks inside one text
    node stay as they are, written out or as references.
    """
    blanks = let(html, lambda h: F.when(F.contains(h, F.lit("&")) & F.rlike(h, F.lit(
        "&(?:nbsp|NonBreakingSpace|ensp|emsp|thinsp|ThinSpace|Tab|NewLine|#)")), blank_references(h)).otherwise(h))
    return decode_references(strip(F.regexp_replace(blanks, _BETWEEN, " ")))


# Behind the "<": elements whose content is no markup, and comments; a comment inside such an element is part of it.
_RAW = r"(?i:(script|style|template))(?![\w-])(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>" + _RAW_REST
#: Raw elements and comments, with the number of the group of the element's name left open.
RAW = f"(?:{_RAW}|{_COMMENT})"
_SIGNS = {"<": "&lt;", ">": "&gt;", "=": "&#61;"}  # that stand for themselves in quoted values only


def without_comments(html: Column) -> Column:
    """The page without its comments; scripts stay."""
    pattern = rf"(?s)(?=<[sStT!])(?:(<{_RAW.format(2)})|<{_COMMENT})"
    return F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, pattern, "$1")).otherwise(html)


def markup(html: Column) -> Column:
    """The page's own tags and text: no comments, scripts, styles and templates, and no tags inside attributes.

    Angle brackets and equals signs in quoted values become references, so that a tag ends at its first ``>`` and what
    looks like an attribute is one.
    """
    bare = F.regexp_replace(html, rf"(?s)<(?=[sStT!]){RAW.format(1)}", "")
    # One pass a kind of quote puts a mark before each such character, the marks become references without a regex.
    # A match takes all text since the last one in possessive loops, so a page costs one step of them, not a try a place.
    # Most pages have no such character, which a search for the first one tells.
    for quote in ('"', "'"):
        inside = rf"[^{quote}<>=]*+"
        value = rf"=\s*+{quote}{inside}"
        passed = rf"[^=]*+(?:(?!{value}[<>=])=[^=]*+)*+"
        marks = rf"\G((?!\A){inside}|{passed}{value})([<>=])"
        bare = let(bare, lambda b: F.when(
            F.contains(b, F.lit(quote)) & F.rlike(b, F.lit(f"{value}[<>=]")), F.regexp_replace(b, marks, f"$1{MARK}$2"),
        ).otherwise(b))

    def written(piece: Column, place: Column) -> Column:
        """A piece behind a mark, which begins with the sign."""
        reference = F.when(place == 0, F.left(piece, F.lit(1)))
        for sign, name in _SIGNS.items():
            reference = reference.when(F.startswith(piece, F.lit(sign)), name)
        return F.concat(reference, F.substr(piece, F.lit(2)))

    return let(bare, lambda b: F.when(F.contains(b, F.lit(MARK)), F.array_join(F.transform(F.split(b, MARK, -1), written), "")).otherwise(b))


def _signs(text: Column) -> Column:
    """The text with the references of ``markup`` as the signs they stand for."""
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[1]), F.lit(pair[0])), _SIGNS.items(), text)
