"""From raw documents to tokens: quality, lines, near copies, benchmark passages, token identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.llm import decontam, jaccard_join, line_dedup, quality, sentence_pieces
from vitrine.llm.core import stored, table
from vitrine.llm.queries import model_file


def _carried(docs: DataFrame) -> DataFrame:
    """(doc_id, text, carried): all other columns in one struct, so that none clashes with an operator's own."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*rest) if rest else F.lit(0)).alias("carried"))


def _restored(rows: DataFrame, docs: DataFrame, text: Column | str = "text") -> DataFrame:
    """The columns of ``docs``, with another text and its length."""
    text = F.col(text) if isinstance(text, str) else text
    fixed = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.char_length(text).cast("bigint")}
    return rows.select(*[fixed.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null, empty and short texts fail the base rule; repeated rows get equal verdicts; an empty table stays empty.
    """
    return quality.kept_rows(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more in five documents or more stay in the last document only.

    No row goes: a text may become empty, and null becomes empty. Rows of the largest doc_id all keep a line.
    """
    return _restored(line_dedup.with_kept_lines(_carried(docs)), docs, "kept_text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays, texts without words all stay.

    Rows that share this doc_id are told apart by their texts only: of equal texts one stays, others stay each, as do
    rows whose doc_id is null.
    """
    own = _carried(docs)
    first = jaccard_join.near_copies(own).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.select(F.col("doc_id").alias("first")).distinct()
    stay = own.join(first, F.col("doc_id").eqNullSafe(F.col("first")), "left_semi")
    stay = stay.withColumn("hash of text", F.xxhash64("text")).dropDuplicates(["doc_id", "hash of text"])
    return _restored(stay, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go; without benchmark items, or words of its own, a document stays."""
    hits = decontam.with_hits(_carried(docs), table(spark, sf_dir, "benchmark"), ["doc_id", "text", "carried"])
    return _restored(hits.where("n_hit = 0"), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of what is left, one row for each document; an empty text has no ids."""
    return sentence_pieces.encode(docs, model_file())


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("token identifiers", encode),
]

# Quality verdicts and identifiers have no SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
