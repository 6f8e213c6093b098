"""Lines that many documents share: found by hash, dropped through per-document keep bitmaps.

Each row counts as a document. Keys are 128-bit hashes of the trimmed, lower-cased line.

1. The distinct keys of each row are dealt by ``repartitionByRange`` on (hash, salt), sorted by
   (hash, salt, document): the first row of each run is the last document holding the key there, the
   run's length its number of documents. The salt splits a line that a third of all documents hold.
2. One row per (hash, salt) is summed by hash; keys in ``min_docs`` documents or more stay.
3. Their occurrences become bits, 64 lines to a word; words without a dropped line are not stored.

Texts are not moved for 1 to 3, only when the bitmaps are applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.functions.once import let
from vitrine.llm.core import SPACE, ascii_lower, stored

MIN_CHARS, MIN_DOCS = 40, 5
LEAST_SALTS = 64


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(text: Column, min_chars: int) -> Column:
    """Two hashes per line, null for lines shorter than ``min_chars``."""

    def key(line: Column) -> Column:
        return let(F.btrim(line, F.lit(SPACE)), lambda s: F.when(
            F.char_length(s) >= min_chars,
            let(ascii_lower(s), lambda k: F.struct(
                F.xxhash64(k).alias("a"), F.xxhash64(F.lit(7), k).alias("b"))),
        ))

    return F.transform(_lines(text), key)


def frequent_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(a, b, n_docs, keeper): keys of at least ``min_docs`` rows and the largest doc_id among these.

    A null doc_id is smaller than any other; if only such rows hold the key, all of them keep it.
    """
    salts = max(LEAST_SALTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    held = docs.select(
        F.col("doc_id").alias("d"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(salts)).alias("salt"),
        F.explode(F.array_distinct(F.filter(_keys(F.col("text"), min_chars), lambda k: k.isNotNull()))).alias("k"),
    ).select("k.a", "k.b", "salt", "d")
    key = ["a", "b", "salt"]
    ordered = Window.partitionBy(*key).orderBy(F.desc_nulls_last("d"))
    runs = (
        held.repartitionByRange(*key)
        .withColumn("first", F.row_number().over(ordered))
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
        .where("first = 1")
    )
    return runs.groupBy("a", "b").agg(F.sum("n").alias("n_docs"), F.max("d").alias("keeper")).where(
        F.col("n_docs") >= min_docs)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, words): for each row that loses lines, ``words`` of (word, bits), sorted by word.

    Bit i of word w is set if line 64 w + i is dropped; lines of all other words are kept. ``row`` is a
    hash of the text and tells rows of one doc_id apart; rows that are wholly equal share a bitmap.
    """
    # Stored, so that the join has nothing but two plain exchanges, which Spark can split at a hot line.
    frequent = stored(frequent_lines(docs, min_chars, min_docs), "frequent-lines")
    at = docs.select(
        F.col("doc_id"), F.xxhash64("text").alias("row"), F.posexplode(_keys(F.col("text"), min_chars)).alias("pos", "k"),
    ).where("k is not null").select("doc_id", "row", "pos", "k.a", "k.b")
    lost = at.join(frequent, ["a", "b"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    bits = lost.groupBy("doc_id", "row", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits"))
    return bits.groupBy("doc_id", "row").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))


def with_kept_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped`` added (such columns of its own are replaced).

    Keys of at least ``min_chars`` code points in at least ``min_docs`` rows lose all lines but those of the
    largest doc_id. Null and empty texts are one empty line; an empty table gives an empty one.
    """
    maps = keep_bitmaps(docs, min_chars, min_docs)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"))
    own = own.select("own", F.xxhash64("own.text").alias("row"))
    maps = maps.withColumnsRenamed({"doc_id": "d", "row": "r"})
    joined = own.join(
        maps.hint("shuffle_hash"), (F.col("row") == F.col("r")) & F.col("own.doc_id").eqNullSafe(F.col("d")), "left")
    lines, words = _lines(F.col("own.text")), F.col("words")
    dense = F.transform(
        F.sequence(F.lit(0), F.element_at(words, -1)["word"]),
        lambda w: F.coalesce(F.element_at(F.map_from_entries(words), w), F.lit(0).cast("bigint")))
    kept = let(dense, lambda have: F.array_join(F.filter(lines, lambda x, i: F.coalesce(
        F.call_function("shiftrightunsigned", F.get(have, F.shiftright(i, 6)), i.bitwiseAND(63)).bitwiseAND(1) == 0,
        F.lit(True))), "\n"))
    worked = joined.select("own", F.struct(
        F.when(words.isNull(), F.coalesce("own.text", F.lit(""))).otherwise(kept).alias("kept_text"),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.aggregate(words, F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w["bits"])), F.lit(0))
        .cast("bigint").alias("n_dropped")).alias("result"))
    added = ["kept_text", "n_lines", "n_dropped"]
    return worked.select(
        *[F.col(f"own.`{c}`") for c in docs.columns if c not in added], *[F.col(f"result.{c}") for c in added])


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """One row per document: lines, dropped lines and the SHA-256 of what is kept."""
    return with_kept_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH line AS (
  SELECT doc_id, i, x, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM line WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM (SELECT line.*, keeper IS NOT NULL AND keeper <> doc_id AS lost FROM line LEFT JOIN frequent USING (k))
GROUP BY doc_id
"""
