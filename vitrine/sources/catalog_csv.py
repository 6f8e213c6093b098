"""Product records as CSV files with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vitrine.operators.master import build_master
from vitrine.schema import FIELDS, RAW, conform
from vitrine.shared import stored

#: Column with the text of a row that does not fit the record.
REJECTED = "rejected_row"


def read_catalog_csv(spark: SparkSession, path: str | list[str], *, multi_line: bool = False) -> DataFrame:
    """Read one shop's CSV; blanks are null, a wrong header or a broken row raises.

    ``multi_line=True`` accepts line ends inside quotes, at the price of reading each
    file in one task; without it such a row raises and large files are split.
    """
    raw = spark.read.csv(
        path, schema=RAW, header=True, enforceSchema=False, mode="FAILFAST",
        encoding="UTF-8", escape='"', multiLine=multi_line,
    )
    return conform(raw)


def read_catalog_csv_checked(
    spark: SparkSession, path: str | list[str], *, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(records, rejected rows): as ``read_catalog_csv``, but broken rows are set aside instead of ending the job.

    A row with too few or too many fields or a value that does not fit its type is no record; its text stands in
    ``rejected_row`` beside the file it came from. The files are read once: both tables come from one stored result.
    """
    raw = spark.read.csv(
        path, schema=T.StructType([*RAW.fields, T.StructField(REJECTED, T.StringType())]), header=True, enforceSchema=False, mode="PERMISSIVE",
        columnNameOfCorruptRecord=REJECTED, encoding="UTF-8", escape='"', multiLine=multi_line,
    )
    rows = stored(raw.withColumn("file", F.col("_metadata.file_path")), "checked-csv")
    good = conform(rows.where(F.col(REJECTED).isNull()).drop(REJECTED, "file"))
    return good, rows.where(F.col(REJECTED).isNotNull()).select("file", REJECTED)


def read_catalogs(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """Read the CSV of each source, in order, into one table with a ``source`` column."""
    return build_master({name: read_catalog_csv(spark, path) for name, path in sources.items()})


def write_catalog_csv(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Write the 14 columns with a header; null and blank become an empty field."""
    lineage = [c for c in df.columns if c not in FIELDS]
    conform(df, keep=tuple(c for c in lineage if c in ("source", "row_no"))).select(*FIELDS).write.csv(
        path, mode=mode, header=True, encoding="UTF-8", escape='"', nullValue="", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
