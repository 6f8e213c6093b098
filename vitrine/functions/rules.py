"""Ordered keyword rules as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from vitrine.functions.once import let
from vitrine.functions.text import WORD, fold_accents


@dataclass(frozen=True)
class Tag:
    """A tag set when any word occurs, or any ``near`` word follows the anchor.

    The anchor stands before the ``near`` word in the same sentence: no full stop
    between the two and at most 120 characters.
    """

    label: str
    words: tuple[str, ...] = ()
    near: tuple[str, ...] = ()


#: From this many keywords on, a text is read once for all of them instead of once for each.
MANY = 32


def _quoted(text: str) -> str:
    """Text as a regex for itself, in Java."""
    return "".join(c if c.isalnum() or c in " _" else f"\\x{{{ord(c):X}}}" for c in text)


def trie(words: Sequence[str]) -> str:
    """A regex for the longest of the words that starts at a place: shared beginnings are tried once."""
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        ends = "" in node
        branches = []
        for c, below in sorted(node.items()):
            if not c:
                continue
            chain = c
            while len(below) == 1 and "" not in below:
                (c, below), = below.items()
                chain += c
            branches.append(_quoted(chain) + (pattern(below) if set(below) != {""} else ""))
        if not branches:
            return ""
        return f"(?:{'|'.join(branches)})" + ("?" if ends else "")

    return pattern(root)


def _first_letters(words: Sequence[str]) -> str:
    """A look-ahead that most places fail at once."""
    return f"(?=[{''.join(_quoted(c) for c in sorted({w[0] for w in words}))}])"


def _texts(values: Sequence[str]) -> Column:
    """An array literal of any length, handed over as one text."""
    mark = next(c for c in map(chr, range(0xE000, 0xF900)) if not any(c in x for x in values))
    return F.split(F.lit(mark.join(values)), mark, -1)


def _first_of_many(text: Column, rules: Sequence[tuple[str, str]], whole_words: bool) -> Column:
    """``first_match`` for many rules: one scan finds the longest keyword of every place, which stands for those it begins with."""
    ranks: dict[str, int] = {}
    for i, (keyword, _) in enumerate(rules):
        ranks.setdefault(keyword.strip() if whole_words else keyword, i)
    if "" in ranks:  # found in every text
        rules = rules[:ranks.pop("") + 1]
        empty, ranks = len(rules) - 1, {k: i for k, i in ranks.items() if i < len(rules)}
    else:
        empty = None
    inner = lambda c: c.isalnum() or c == "_"

    def best(keyword: str) -> int:
        begun = [keyword[:n] for n in range(1, len(keyword)) if not whole_words or not inner(keyword[n])]
        return min(ranks[w] for w in [*begun, keyword] if w in ranks)

    known = sorted(ranks, key=lambda k: (best(k), k))
    values, places = _texts([rules[best(k)][1] for k in known]), _texts(known)
    if whole_words:
        pattern = f"(?<![{WORD}]){_first_letters(known)}(?=({trie(known)})(?![{WORD}]))"
    else:
        pattern = f"{_first_letters(known)}(?=({trie(known)}))"
    hits = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
    at = F.array_min(F.transform(hits, lambda h: F.array_position(places, h)))
    found = let(at, lambda i: F.get(values, (i - 1).cast("int")))
    return found if empty is None else F.when(text.isNotNull(), F.coalesce(found, F.lit(rules[empty][1])))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(w)) for w in words])


def one_of(text: Column, words: Sequence[str]) -> Column:
    """As ``contains_any`` for short texts: one regex, so ``text`` is evaluated once."""
    if "" in words:  # found in every text
        return F.rlike(text, F.lit(""))
    return F.rlike(text, F.lit(_first_letters(words) + trie(words)))


def near_word(text: Column, anchors: Sequence[str], target: str, reach: int = 120) -> Column:
    """A word that is an anchor, then a word starting with ``target`` within reach.

    Of all anchors before a target only the nearest matters, so the gap behind one ends at the next anchor or target:
    no character is passed over twice, however many anchors a text holds.
    """
    anchor = rf"(?<![{WORD}])(?:{'|'.join(map(_quoted, anchors))})"
    goal = rf"(?<=[^.{WORD}]){_quoted(target)}"
    pattern = rf"{anchor}(?:(?!{anchor}|{goal})[^.]){{0,{reach}}}+{goal}"
    # The plain substring tests are cheap and spare most texts the regex.
    return contains_any(text, anchors) & F.contains(text, F.lit(target)) & F.rlike(text, F.lit(pattern))


def first_match(
    text: Column, rules: Sequence[tuple[str, str]], *, whole_words: bool = False, plain: bool = False
) -> Column:
    """Value of the first rule whose keyword occurs in ``text``, else null.

    ``whole_words`` wants the keyword between non-word characters; ``plain``
    compares without accents. Both are off by default. With many rules the text is
    read once for all of them.
    """
    if plain:
        text = fold_accents(text)
    if len(rules) >= MANY:
        return _first_of_many(text, rules, whole_words)

    def hit(keyword: str) -> Column:
        if not whole_words:
            return F.contains(text, F.lit(keyword))
        escaped = "".join(c if c.isalnum() or c == " " else f"\\{c}" for c in keyword.strip())
        return F.rlike(text, F.lit(rf"(?:^|[^{WORD}]){escaped}(?:[^{WORD}]|$)"))

    return F.coalesce(*[F.when(hit(keyword), F.lit(value)) for keyword, value in rules])


def all_matches(text: Column, rules: Sequence[Tag], anchors: Sequence[str] = ()) -> Column:
    """Array of the labels of all rules that hold, in rule order, without repeats."""

    def holds(rule: Tag) -> Column:
        tests = [contains_any(text, rule.words)] if rule.words else []
        tests += [near_word(text, anchors, target) for target in rule.near]
        return reduce(or_, tests)

    return F.array_distinct(
        F.array_compact(F.array(*[F.when(holds(r), F.lit(r.label)) for r in rules]))
    )
