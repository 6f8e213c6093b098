"""The fixed product record: names, order and Spark types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The 14 columns of a product record, in output order.
FIELDS = [
    "product_name", "brand", "category", "price", "promo_price",
    "volume_ml", "rating", "review_count", "shade_count",
    "finish_type", "coverage_level", "skin_type",
    "availability", "source_url",
]

#: Tags of ``skin_type`` are stored as one string joined by this text.
TAG_JOIN = " / "

# Ratings published by shops carry up to four decimals; keeping them as DECIMAL
# makes every sum independent of the row order.
_TYPES = {
    "price": T.DecimalType(12, 2),
    "promo_price": T.DecimalType(12, 2),
    "volume_ml": T.DecimalType(8, 2),
    "rating": T.DecimalType(6, 4),
    "review_count": T.LongType(),
    "shade_count": T.IntegerType(),
}

CANONICAL = T.StructType(
    [T.StructField(name, _TYPES.get(name, T.StringType())) for name in FIELDS]
)

# A CSV written elsewhere may hold counts as "732.0", so the raw layer reads both
# review columns as DOUBLE and leaves the final type to conform().
RAW = T.StructType(
    [
        T.StructField(
            name,
            T.DoubleType() if name in ("rating", "review_count") else _TYPES.get(name, T.StringType()),
        )
        for name in FIELDS
    ]
)

FEED = T.StructType([
    T.StructField("products", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("product_type", T.StringType()),
        T.StructField("handle", T.StringType()),
        T.StructField("variants", T.ArrayType(T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("price", T.StringType()),
            T.StructField("compare_at_price", T.StringType()),
            T.StructField("available", T.BooleanType()),
        ]))),
    ]))),
])


def filled(value: Column, default: Column | str | None = None) -> Column:
    """``value`` unless it is null or an empty string, else ``default``."""
    value = F.nullif(value, F.lit(""))
    if default is None:
        return value
    return F.coalesce(value, F.lit(default) if isinstance(default, str) else default)


def conform(df: DataFrame, *, strict: bool = True, keep: tuple[str, ...] = ("source",)) -> DataFrame:
    """Select the 14 columns in order with their types; blanks become null.

    A missing or unknown column raises. Columns named in ``keep`` pass through in
    front when present (lineage). With ``strict=False`` a value that does not fit
    its type becomes null instead of failing the job.
    """
    kept = [c for c in keep if c in df.columns]
    missing = [c for c in FIELDS if c not in df.columns]
    unknown = [c for c in df.columns if c not in FIELDS and c not in kept]
    if missing or unknown:
        raise ValueError(f"not a product record: missing {missing}, unknown {unknown}")

    def typed(field: T.StructField) -> Column:
        col, have = F.col(field.name), df.schema[field.name].dataType
        if isinstance(have, T.StringType):
            col = F.nullif(F.trim(col), F.lit("")) if field.name in _TYPES else filled(col)
        if have == field.dataType:
            return col.alias(field.name)
        return (col.cast(field.dataType) if strict else col.try_cast(field.dataType)).alias(field.name)

    return df.select(*kept, *[typed(f) for f in CANONICAL.fields])


def to_canonical(df: DataFrame, source: str | Column, defaults: dict[str, str] | None = None) -> DataFrame:
    """Build the product record with a ``source`` column.

    ``defaults`` holds constants (brand, availability, ...) used where the row is
    blank; a field absent from ``df`` is filled from its default or with null.
    """
    defaults = defaults or {}
    columns = []
    for field in CANONICAL.fields:
        default = defaults.get(field.name)
        if field.name not in df.columns:
            columns.append(F.lit(default).cast(field.dataType).alias(field.name))
        elif default is None:
            columns.append(F.col(field.name))
        else:
            columns.append(filled(F.col(field.name).cast("string"), default).alias(field.name))
    lineage = F.lit(source) if isinstance(source, str) else source
    return conform(df.select(lineage.alias("source"), *columns))
