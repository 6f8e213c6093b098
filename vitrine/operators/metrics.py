"""Brand comparison figures.

All sums run on DECIMAL or BIGINT, so no figure depends on the order of rows. Every
aggregation combines inside the map tasks first: a brand that holds a third of the
rows sends one row per task. Windows run on aggregated rows only, one per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.operators.master import OTHER, number_rows, split_family
from vitrine.schema import FIELDS, TAG_JOIN

_RATIO = "decimal(18,9)"


def mean(col: Column | str) -> Column:
    """Average of the non-null values as DOUBLE."""
    return F.sum(col).cast("double") / F.nullif(F.count(col), F.lit(0))


def share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0))


def count_by(df: DataFrame, cols: Sequence[str], *, ordered: bool = False) -> DataFrame:
    """Rows per group; ``ordered`` sorts the summary by the group."""
    counted = df.groupBy(*cols).agg(F.count("*").alias("n"))
    return counted.orderBy(*cols) if ordered else counted


def count_where(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """One row with the number of rows equal to each value (columns ``n_0``, ``n_1``, ...)."""
    return df.agg(*[F.count_if(F.col(col) == v).alias(f"n_{i}") for i, v in enumerate(values)])


def master_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_products"))


def brand_benchmark(df: DataFrame, category: str | None = None, by: str = "brand") -> DataFrame:
    """All brand measures in one pass, raw prices as they stand in ``price``.

    ``price_per_ml_mean`` averages the ratios of the products, ``price_per_ml_total``
    divides the sums; both skip products without a volume.
    """
    if category is not None:
        df = df.filter(F.col("category") == category)
    sized = F.col("volume_ml") > 0
    ratio = F.when(sized, (F.col("price") / F.nullif(F.col("volume_ml"), F.lit(0))).cast(_RATIO))
    priced = sized & F.col("price").isNotNull()
    return df.groupBy(by).agg(
        F.count("*").alias("n_products"),
        mean("price").alias("avg_price"),
        mean(ratio).alias("price_per_ml_mean"),
        share(F.sum(F.when(priced, F.col("price"))), F.sum(F.when(priced, F.col("volume_ml"))).cast("double"))
        .alias("price_per_ml_total"),
        mean("shade_count").alias("avg_shades"),
        F.max("shade_count").alias("max_shades"),
        mean("rating").alias("avg_rating"),
        mean("review_count").alias("avg_reviews"),
    )


def finish_mix(df: DataFrame, by: str = "brand", col: str = "finish_type") -> DataFrame:
    """Products and share of each finish inside a brand; a blank finish counts as its own group."""
    counted = df.groupBy(by, col).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(by))
    return counted.withColumn("share", share(F.col("n"), whole))


def finish_table(df: DataFrame, values: Sequence[str], by: str = "brand", col: str = "finish_type") -> DataFrame:
    """One row per brand, one count column per finish named in ``values`` plus ``other``."""
    known = F.when(F.col(col).isin(*values), F.col(col)).otherwise(OTHER)
    return df.groupBy(by).agg(*[F.count_if(known == v).alias(v) for v in [*values, OTHER]])


def family_rollup(df: DataFrame, by: str = "brand") -> DataFrame:
    """Rows, distinct shades and price range of each product family."""
    return split_family(df).groupBy(by, "family").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("shade").alias("n_shades"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )


def explode_tags(df: DataFrame, tag_col: str = "skin_type") -> DataFrame:
    """One row per tag of a joined tag column, as ``tag``; rows without tags fall away."""
    return df.select("*", F.explode(F.split(F.col(tag_col), TAG_JOIN)).alias("tag"))


def tag_mix(df: DataFrame, tag_col: str = "skin_type", by: str = "brand") -> DataFrame:
    """Products per brand and tag; a product counts once for each of its tags."""
    return explode_tags(df.select(by, tag_col), tag_col).groupBy(by, "tag").agg(F.count("*").alias("n"))


def in_stock(label: Column | str = "availability") -> Column:
    """Whether an availability label of any shop means that the product can be bought."""
    label = F.col(label) if isinstance(label, str) else label
    return F.lower(F.trim(label)) == "en stock"


def availability_rate(df: DataFrame, by: str = "brand") -> DataFrame:
    known = F.col("availability").isNotNull()
    return df.groupBy(by).agg(
        F.count("*").alias("n_products"),
        share(F.count_if(in_stock()), F.count_if(known)).alias("availability_rate"),
    )


def promo_depth(df: DataFrame, by: str = "brand") -> DataFrame:
    """Promoted share and average discount; needs ``price_direction``."""
    cut = F.when(
        F.col("on_promo"),
        F.lit(1).cast("decimal(2,0)") - (F.col("sale_price") / F.nullif(F.col("list_price"), F.lit(0))).cast(_RATIO),
    )
    return df.groupBy(by).agg(
        F.count("*").alias("n_products"),
        F.count_if("on_promo").alias("n_promo"),
        share(F.count_if("on_promo"), F.count("*")).alias("promo_share"),
        mean(cut).alias("avg_discount"),
    )


def completeness(df: DataFrame, by: str = "source", cols: Sequence[str] = FIELDS) -> DataFrame:
    """Rows, blanks, distinct values, smallest and largest value of each column per source.

    The table is read once and turned long, without blanks; each value is sent once per task, with the number of its rows. All
    figures come from these counts, numbers being compared as numbers; nothing but final counts meets in one group.
    """
    kinds = dict(df.dtypes)
    numeric = [c for c in cols if kinds[c] in ("int", "bigint", "double") or kinds[c].startswith("decimal")]
    every = "_" + max(cols, key=len)  # no column's name; stands for the rows as such
    texts = df.select(F.col(by).alias("_by"), F.lit("").alias(every), *[F.col(c).cast("string").alias(c) for c in cols])
    long = texts.unpivot(["_by"], [every, *cols], "_column", "_value").where(F.col("_value").isNotNull())
    counted = long.groupBy("_by", "_column", "_value").agg(F.count("*").alias("_n"))
    is_one = lambda c: F.col("_column") == c
    number = lambda c: F.when(is_one(c), F.col("_value").try_cast(kinds[c]))
    worded = F.when(~F.col("_column").isin(*numeric) if numeric else F.lit(True), F.col("_value"))
    end = lambda f: F.coalesce(f(worded), *[f(number(c)).cast("string") for c in numeric])
    found = counted.groupBy("_by", "_column").agg(
        F.sum("_n").alias("n"), F.count("*").alias("distinct"), end(F.min).alias("low"), end(F.max).alias("high"))
    each = found.groupBy("_by").agg(F.map_from_entries(F.collect_list(F.struct(
        "_column", F.struct("n", "distinct", "low", "high")))).alias("of"))
    of = lambda c: F.try_element_at("of", F.lit(c))
    n_rows = of(every)["n"]
    return each.select(F.col("_by").alias(by), F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), n_rows.alias("n_rows"), (n_rows - F.coalesce(of(c)["n"], F.lit(0))).alias("n_null"),
        F.coalesce(of(c)["distinct"], F.lit(0)).alias("n_distinct"), of(c)["low"].alias("min_value"),
        of(c)["high"].alias("max_value")) for c in cols])))


#: Columns with so few values that one task may see a row for each.
BRAND_LIKE = ("brand", "brand_group", "source", "category")


def _brand_like(by: str) -> None:
    if by not in BRAND_LIKE:
        raise ValueError(f"{by!r} may have as many values as rows; rank or compare one of {BRAND_LIKE}")


def rank_brands(bench: DataFrame, measure: str, best: str = "high") -> DataFrame:
    """Add ``rank`` on a measure, ties share a rank, brands without a value come last.

    ``bench`` is aggregated: one row per brand, whose column stands first. Ranking streams over these sorted rows.
    """
    _brand_like(bench.columns[0])
    col = F.col(measure)
    order = {"high": col.desc_nulls_last(), "low": col.asc_nulls_last()}[best]
    return bench.withColumn("rank", F.rank().over(Window.orderBy(order)))


def rank_rows(df: DataFrame, measure: str, by: Sequence[str], best: str = "high") -> DataFrame:
    """Add ``rank`` on a measure over any number of rows; ties share a rank, rows without a value come last.

    ``by`` makes the order total. Rows are range-partitioned and numbered across the partitions; a value's rank is its
    first number, found by a hash aggregation. No window spans the table, and ties of any number stay spread.
    """
    col = F.col(measure)
    order = [{"high": col.desc_nulls_last(), "low": col.asc_nulls_last()}[best], *by]
    numbered = number_rows(df, order)
    firsts = numbered.groupBy(F.col(measure).alias("_value")).agg((F.min("row_no") + 1).cast("int").alias("rank"))
    return numbered.join(firsts, col.eqNullSafe(F.col("_value"))).select(*df.columns, "rank")


def market_gap(df: DataFrame, measure: str, by: str = "brand") -> DataFrame:
    """Brand average of a measure against the average of all products.

    The market average comes from the brands' own sums and counts, so the products
    are read once and no join is needed. ``by`` is one of BRAND_LIKE: these have few values.
    """
    _brand_like(by)
    sums = df.groupBy(by).agg(F.sum(measure).alias("_sum"), F.count(measure).alias("_n"))
    everyone = Window.partitionBy()
    market = F.sum("_sum").over(everyone).cast("double") / F.nullif(F.sum("_n").over(everyone), F.lit(0))
    own = F.col("_sum").cast("double") / F.nullif(F.col("_n"), F.lit(0))
    return sums.select(by, own.alias("brand_value"), market.alias("market_value")).withColumn(
        "gap", F.col("brand_value") - F.col("market_value")
    )
