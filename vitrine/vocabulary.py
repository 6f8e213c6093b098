"""One vocabulary for the labels of all shops, for ``harmonise`` and ``brand_group``.

Labels are compared without case, accents and extra blanks, so one spelling of each is enough.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Labels that the shops use, and the common one of each.
VOCABULARY: dict[str, dict[str, str]] = {
    "category": {
        "Foundations & Concealers": "fond de teint", "fond de teint": "fond de teint", "correcteur": "correcteur",
        "lèvres": "lèvres", "yeux": "yeux", "blush & bronzer": "blush & bronzer",
    },
    "finish_type": {
        "mat": "mat", "Lisse et mat": "mat", "naturel": "naturel", "satiné": "satiné", "irisé": "irisé",
        "lumineux": "lumineux", "Rayonnant": "lumineux", "transparent": "transparent",
    },
    "coverage_level": {
        "légère": "légère", "léger": "légère", "moyenne": "moyenne", "moyen": "moyenne", "moyenne à haute": "moyenne à haute",
        "modulable": "modulable", "totale": "totale", "couvrant": "totale", "forte": "totale",
    },
    "availability": {"en stock": "en stock", "rupture": "rupture"},
}


def group_table(spark: SparkSession, groups: Mapping[str, str]) -> DataFrame:
    """``(brand, brand_group)`` rows for ``brand_group``."""
    return spark.createDataFrame(sorted(groups.items()), "brand string, brand_group string")


def vocabulary_table(spark: SparkSession, vocab: Mapping[str, Mapping[str, str]] = VOCABULARY) -> DataFrame:
    """``(field, label, common)`` rows for ``harmonise``."""
    rows = [(field, label, common) for field, labels in vocab.items() for label, common in labels.items()]
    return spark.createDataFrame(rows, "field string, label string, common string")
