"""Numbers in running text: prices, volumes, counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vitrine.functions.once import nonblank
from vitrine.functions.text import GAP, WORD

# What a price looks like in front of the euro sign.
ANY_PRICE = r"\d+(?:[.,]\d{1,2})?"
CENT_PRICE = r"\d+[.,]\d{2}"

_NUMBER = r"\d+(?:[.,]\d+)?"


def _runs(pattern: str) -> str:
    """``pattern`` with its leading number tried at the start of a digit run only.

    A match from inside a run could always start earlier, so nothing is lost; without
    it a text of n digits costs n attempts of up to n steps.
    """
    flags, body = (pattern[:4], pattern[4:]) if pattern.startswith("(?i)") else ("", pattern)
    return flags + r"(?<!\d)" + body if body.startswith(r"(\d+") else pattern


def number(text: Column, pattern: str, kind: str = "decimal(12,2)") -> Column:
    """First captured number, comma or point, as ``kind``; null when absent."""
    # Casting an empty string to DECIMAL costs a Java exception per row.
    return F.translate(nonblank(F.regexp_extract(text, _runs(pattern), 1)), ",", ".").try_cast(kind)


def prices(text: Column, pattern: str = ANY_PRICE, low: float | None = None, high: float | None = None) -> Column:
    """Distinct euro prices of the text, highest first, within the open range."""
    dotted = F.translate(text, ",", ".")  # once per text instead of once per price
    found = F.regexp_extract_all(dotted, F.lit(_runs(rf"({pattern}){GAP}€")), F.lit(1))
    amounts = F.filter(
        found.try_cast("array<decimal(12,2)>"),
        lambda p: p.isNotNull()
        & (F.lit(True) if low is None else p > F.lit(low))
        & (F.lit(True) if high is None else p < F.lit(high)),
    )
    return F.sort_array(F.array_distinct(amounts), asc=False)


def price_pair(found: Column) -> tuple[Column, Column]:
    """(price, promo price) of a descending price array: highest, then lowest if two or more."""
    high = F.get(found, F.lit(0))
    low = F.when(F.size(found) >= 2, F.try_element_at(found, F.lit(-1)))
    return high, low


def volumes(
    text: Column, *, any_case: bool = True, ml_ends_word: bool = False, g_ends: str = f"(?![{WORD}])"
) -> tuple[Column, Column]:
    """(millilitres, grams): the first amount of each kind."""
    case = "(?i)" if any_case else ""
    end = f"(?![{WORD}])" if ml_ends_word else ""
    ml = number(text, rf"{case}({_NUMBER}){GAP}ml{end}", "decimal(8,2)")
    grams = number(text, rf"({_NUMBER}){GAP}g{g_ends}", "decimal(8,2)")
    return ml, grams


def volume(text: Column, **how) -> tuple[Column, Column]:
    """(amount, unit) of the first ``n ml``, else of the first ``n g``; see ``volumes``."""
    ml, grams = volumes(text, **how)
    unit = F.when(ml.isNotNull(), F.lit("ml")).when(grams.isNotNull(), F.lit("g"))
    return F.coalesce(ml, grams), unit
