"""The brand report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from vitrine.operators.master import build_master, price_direction
from vitrine.operators.metrics import mean, share
from vitrine.schema import conform


def brand_report(
    catalogues: Mapping[str, DataFrame] | DataFrame, category: str | None = None, by: str = "brand"
) -> DataFrame:
    """One row per brand over all shops: price, range, rating, promotion and three ranks.

    ``catalogues`` holds one table per shop, or is the master table itself. With a column ``volume_unit`` there is a
    price per millilitre of the products sold by volume beside the raw one. ``by`` may be ``brand_group``.

    The products are read and aggregated once; the ranks run on the brand rows.
    """
    master = build_master(catalogues) if isinstance(catalogues, Mapping) else catalogues
    units = "volume_unit" in master.columns
    master = price_direction(conform(master, keep=("source", "volume_unit", "brand_group")))
    if category is not None:
        master = master.filter(F.col("category") == category)
    liquid = (F.col("volume_ml") > 0) & F.col("list_price").isNotNull()
    liquid = liquid & (F.col("volume_unit") == "ml") if units else liquid
    ml_only = share(
        F.sum(F.when(liquid, F.col("list_price"))), F.sum(F.when(liquid, F.col("volume_ml"))).cast("double"))
    brands = master.groupBy(by).agg(
        F.count("*").alias("n_products"),
        mean("list_price").alias("avg_list_price"),
        share(
            F.sum(F.when(F.col("volume_ml") > 0, F.col("list_price"))),
            F.sum(F.when((F.col("volume_ml") > 0) & F.col("list_price").isNotNull(), F.col("volume_ml"))).cast("double"),
        ).alias("list_price_per_ml"),
        F.max("shade_count").alias("max_shades"),
        mean("rating").alias("avg_rating"),
        mean("review_count").alias("avg_reviews"),
        share(F.count_if("on_promo"), F.count("*")).alias("promo_share"),
        *([ml_only.alias("list_price_per_ml_only")] if units else []),
    )

    def rank(order):
        return F.rank().over(Window.orderBy(order))

    return brands.withColumns({
        "price_rank": rank(F.col("avg_list_price").desc_nulls_last()),
        "rating_rank": rank(F.col("avg_rating").desc_nulls_last()),
        "fewest_reviews_rank": rank(F.col("avg_reviews").asc_nulls_last()),
    })
