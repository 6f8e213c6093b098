"""What several operators share: tables, intermediate results, words."""

from __future__ import annotations

import contextlib
import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The ASCII white space of the contracts, and letters that are lower-cased.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="vitrine-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, lost executors cost nothing."""
    path = f"{shared_dir(df.sparkSession)}/vitrine-{name}-{uuid.uuid4().hex}"
    df.write.options(**options or {}).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what ``stored`` wrote for these tables, once all that reads them is stored itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else left; ``lower`` where the text is ASCII, as it is much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def space_words(text: Column) -> Column:
    """Words between runs of ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def pair_up(values: Column, step: int, join) -> Column:
    """``join(values[i], values[i + step])`` for every i that has both."""
    n = F.size(values)
    return F.when(n > step, F.zip_with(
        F.slice(values, F.lit(1), n - step), F.slice(values, F.lit(step + 1), n - step), join,
    )).otherwise(F.slice(values, 1, 0))


def worker_cache() -> dict:
    """A dictionary that outlives tasks in a Python worker."""
    return sys.modules.setdefault("_vitrine_llm_cache", types.ModuleType("_vitrine_llm_cache")).__dict__


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Jobs run inside hand at most ``rows`` rows at a time to Python; the session's setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Rows of whole texts go to Python in small batches, so that a worker holds few of them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
