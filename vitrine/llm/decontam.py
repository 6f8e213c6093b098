"""Benchmark passages in training documents, found by winnowing and extended word by word.

Items and documents are cut into words. Of each 10-word window the smallest hash of its seven 4-grams is
kept (leftmost of equal ones), so any window that a document shares with an item leaves the same fingerprint
in both. Fingerprints meet in a join; each meeting is then extended left and right on the words themselves, and
counts if ten or more agree. An item of fewer than ten words is one window: its smallest word hash is its
fingerprint, and the words around are compared with the whole item.

Texts of documents without a common fingerprint are read once and not moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.once import let
from vitrine.llm.core import ascii_lower, pair_up

WINDOW, GRAM = 10, 4
SPAN = WINDOW - GRAM + 1  # 4-grams in a window
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value: what stands between words, in lower-cased text


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def _grams(words: Column) -> Column:
    """Hashes of all 4-grams."""
    one = F.transform(words, lambda w: F.xxhash64(w))
    return let(one, lambda h: let(pair_up(h, 1, lambda a, b: F.xxhash64(a, b)), lambda h2: pair_up(
        h2, 2, lambda a, b: F.xxhash64(a, b))))


def _windows(grams: Column) -> Column:
    """First 4-gram of each window, counted from 1."""
    return F.when(F.size(grams) >= SPAN, F.sequence(F.lit(1), F.size(grams) - SPAN + 1)).otherwise(
        F.array().cast("array<int>"))


def _fingerprints(words: Column) -> Column:
    """The distinct winnowed hashes."""
    return let(_grams(words), lambda g: F.array_distinct(
        F.transform(_windows(g), lambda i: F.array_min(F.slice(g, i, F.lit(SPAN))))))


def _marks(words: Column) -> Column:
    """The winnowed (p, fp): word positions from 0 and their hashes."""

    def at(g: Column, i: Column) -> Column:
        return let(F.slice(g, i, F.lit(SPAN)), lambda w: let(F.array_min(w), lambda m: F.struct(
            (i - 2 + F.array_position(w, m)).cast("int").alias("p"), m.alias("fp"))))

    return let(_grams(words), lambda g: F.array_distinct(F.transform(_windows(g), lambda i: at(g, i))))


def _around(words: Column, p: Column, before: int, after: int) -> Column:
    """(left, right): up to ``before`` words before p, nearest last, and up to ``after`` words from p on."""
    first = F.greatest(p - before, F.lit(0))
    return F.struct(
        F.slice(words, first + 1, p - first).alias("left"), F.slice(words, p + 1, F.lit(after)).alias("right"))


def _same(a: Column, b: Column) -> Column:
    """How many of the first elements of two arrays agree."""
    n = F.least(F.size(a), F.size(b))
    return let(n, lambda m: F.coalesce(
        F.get(F.filter(F.sequence(F.lit(0), m - 1), lambda i: (i < m) & (F.get(a, i) != F.get(b, i))), F.lit(0)), m))


def _common(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0)).otherwise(_same(a, b))


def item_marks(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, item, left, right) of long items and (fp, item, q, whole) of short ones; q: where the fingerprint stands."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             words_of(F.col("text")).alias("w"))
    long = items.where(F.size("w") >= WINDOW).select("item", "w", F.explode(_marks(F.col("w"))).alias("m")).select(
        F.col("m.fp").alias("fp"), "item", _around(F.col("w"), F.col("m.p"), SPAN - 1, WINDOW).alias("c"),
    ).select("fp", "item", F.col("c.left").alias("il"), F.col("c.right").alias("ir")).distinct()
    short = items.where((F.size("w") < WINDOW) & (F.size("w") > 0)).select(
        "item", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h")).select(
        F.array_min("h").alias("fp"), "item", (F.array_position("h", F.array_min("h")) - 1).cast("int").alias("q"),
        F.col("w").alias("whole")).distinct()
    return long, short


def hit_ranges(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, row, item, start, stop): word ranges of documents that repeat an item; ``row`` is a hash of the text.

    Ranges of one item may overlap. Null texts and texts of punctuation have no words and no ranges.
    """
    long, short = item_marks(benchmark)
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    met = base.select("doc_id", "row", F.explode(_fingerprints(words_of(F.col("text")))).alias("fp")).join(
        long.select("fp").distinct(), "fp").select("doc_id", "row", "fp", F.lit(True).alias("gram"))
    met_short = base.select("doc_id", "row", F.explode(F.array_distinct(F.transform(
        words_of(F.col("text")), lambda w: F.xxhash64(w)))).alias("fp")).join(
        short.select("fp").distinct(), "fp").select("doc_id", "row", "fp", F.lit(False).alias("gram"))
    met = met.union(met_short).groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(
        F.collect_set(F.when(F.col("gram"), F.col("fp"))).alias("grams"),
        F.collect_set(F.when(~F.col("gram"), F.col("fp"))).alias("words"))
    found = base.join(met.hint("shuffle_hash"), (F.col("row") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d")))
    found = found.select("doc_id", "row", "grams", "words", words_of(F.col("text")).alias("w")).distinct()

    marks = F.filter(_marks(F.col("w")), lambda m: F.array_contains("grams", m["fp"]))
    longs = found.where(F.size("grams") > 0).select("doc_id", "row", F.explode(F.transform(marks, lambda m: F.struct(
        m["p"].alias("p"), m["fp"].alias("fp"), _around(F.col("w"), m["p"], SPAN - 1, WINDOW).alias("c")))).alias("m"))
    longs = longs.select("doc_id", "row", "m.p", "m.fp", "m.c.left", "m.c.right").join(long, "fp").select(
        "doc_id", "row", "item", "p", _common(F.reverse("left"), F.reverse("il")).alias("before"),
        _common(F.col("right"), F.col("ir")).alias("after")).where(F.col("before") + F.col("after") >= WINDOW)
    longs = longs.select("doc_id", "row", "item", (F.col("p") - F.col("before")).alias("start"),
                         (F.col("p") + F.col("after")).alias("stop"))

    hashed = F.transform(F.col("w"), lambda x, i: F.struct(i.alias("p"), F.xxhash64(x).alias("fp")))
    marks = F.filter(hashed, lambda m: F.array_contains("words", m["fp"]))
    shorts = found.where(F.size("words") > 0).select("doc_id", "row", F.explode(F.transform(marks, lambda m: F.struct(
        m["p"].alias("p"), m["fp"].alias("fp"), _around(F.col("w"), m["p"], WINDOW, WINDOW).alias("c")))).alias("m"))
    left = F.slice(F.col("left"), F.size("left") - F.col("q") + 1, F.col("q"))
    shorts = shorts.select("doc_id", "row", "m.p", "m.fp", "m.c.left", "m.c.right").join(short, "fp").where(
        F.size("left") >= F.col("q")).where(
        F.concat(left, F.slice(F.col("right"), F.lit(1), F.size("whole") - F.col("q"))) == F.col("whole"))
    shorts = shorts.select("doc_id", "row", "item", (F.col("p") - F.col("q")).alias("start"),
                           (F.col("p") - F.col("q") + F.size("whole")).alias("stop"))
    return longs.union(shorts)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, row, n_hit, items): words covered and the sorted item ids, of rows with a hit only.

    Rows that are wholly equal share one line. A null item_id counts as an empty string, an id that
    several items share counts once.
    """
    ranges = hit_ranges(docs, benchmark).groupBy("doc_id", "row").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("r"), F.array_sort(F.collect_set("item")).alias("items"))
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("r", none, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], s["end"]))).alias("n"),
        F.greatest(s["end"], x["stop"]).alias("end")))["n"]
    return ranges.select("doc_id", "row", covered.cast("bigint").alias("n_hit"), "items")


def with_hits(docs: DataFrame, benchmark: DataFrame, columns: list) -> DataFrame:
    """Every row of ``docs`` as ``columns`` (over its own columns) plus n_hit (0 if clean) and items (null if clean).

    Columns of ``docs`` may have any names; those called n_hit or items are replaced. Rows that are repeated, or share a
    null doc_id, are judged by their own text. An empty table gives an empty one, an empty benchmark leaves all clean.
    """
    hits = contamination(docs, benchmark).withColumnsRenamed({"doc_id": "hit_d", "row": "hit_r", "n_hit": "hit_n", "items": "hit_i"})
    own = docs.select(F.struct(*columns).alias("own"), F.col("doc_id").alias("own_d"), F.xxhash64("text").alias("own_r"))
    joined = own.join(hits.hint("shuffle_hash"), (F.col("own_r") == F.col("hit_r")) & F.col("own_d").eqNullSafe(F.col("hit_d")), "left")
    kept = [c for c in own.schema["own"].dataType.names if c not in ("n_hit", "items")]
    return joined.select(*[F.col("own").getField(c).alias(c) for c in kept], F.coalesce("hit_n", F.lit(0)).alias("n_hit"),
                         F.col("hit_i").alias("items"))


def decontam_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items and the SHA-256 of their ids."""
    out = with_hits(docs.select("doc_id", "text"), benchmark,
                    ["doc_id", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words")])
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", F.col("n_hit").cast("bigint").alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS x
  FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS x
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
hit AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.x = bw.x),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""
