"""Stored page sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions.urls import PLAIN_URL, canonical_url
from vitrine.shared import shared_dir


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(url, html)`` of a Parquet table of pages."""
    return spark.read.parquet(path).select("url", "html")


def bucket_pages(pages: DataFrame, name: str, buckets: int = 64) -> DataFrame:
    """Stored pages as a table ``name``, bucketed by canonical address, which it holds as a column of its own.

    The table lies in the shared folder. A crawl pays for the shuffle of its HTML once; ``linked_pages``, ``attach_pages`` and
    ``frontier`` then meet it bucket by bucket, and only links are shuffled. ``buckets`` should keep a bucket
    within an executor's memory.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/vitrine-pages-{uuid.uuid4().hex}"
    plain = pages.withColumn(PLAIN_URL, canonical_url(F.col("url"))).repartition(buckets, PLAIN_URL)
    plain.write.bucketBy(buckets, PLAIN_URL).sortBy(PLAIN_URL).option("path", path).mode("overwrite").saveAsTable(name)
    return spark.table(name)
