"""Quality by importance ratio: hashed n-grams under a trusted target against the raw corpus.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two multinomials over the buckets are
counted: the raw corpus over every document, the target over trusted ones (labels with quality 1
and toxic 0). A document's verdict compares

    sum over its n-grams of ln(target / raw)  /  (n-grams + PRIOR)

with one threshold; equal documents always get equal verdicts.

The target and the threshold are fitted on all labelled documents; for the threshold a trusted one is scored
against the target without its own n-grams, as a document outside the target is. The bucket weights and the
target's counts are arrays of ``BUCKETS`` numbers in the plan.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.functions.once import let
from vitrine.llm.core import discard, pair_up, space_words, stored

BUCKETS, PRIOR, SPARE = 1 << 14, 20, 0.0005
SCORE_DIGITS = 9
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"  # fixed value


def described(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document: its columns ``keep`` as the struct ``own``, the base counts, and ``buckets``, those of all
    its words, then of all its word pairs. The text is split and hashed here and nowhere else."""
    own = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("own")
    split = docs.select(own, F.coalesce("text", F.lit("")).alias("text"), space_words(F.col("text")).alias("words"))
    split = split.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    words = F.col("words")
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return split.select(
        "own", F.size(words).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _repeated(F.col("hashes")).cast("bigint").alias("n_repeat_words"),
        F.transform(F.concat(F.col("hashes"), pair_up(F.col("hashes"), 1, lambda x, y: F.xxhash64(x, y))),
                    lambda h: F.pmod(h, F.lit(BUCKETS)).cast("smallint")).alias("buckets"),
    )


def labelled_grams(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(good, bad, n_words, grams) of every described row with a trusted or a rejected label; grams: buckets with counts.

    ``doc_id`` is a bigint.
    """
    good, bad = (F.col("quality") == 1) & (F.col("toxic") == 0), F.col("quality") == 0
    # Buckets are shuffled only where the labels are too many to broadcast: 64 neighbouring ids are one row of two
    # bitmaps, and stored they are planned by their size.
    word, bit = F.shiftright("doc_id", 6), F.expr("shiftleft(1L, CAST(doc_id & 63 AS INT))")
    marks = stored(labels.where(F.col("doc_id").isNotNull() & (good | bad)).groupBy(word.alias("word")).agg(
        F.bit_or(F.when(good, bit).otherwise(0)).alias("goods"), F.bit_or(F.when(bad, bit).otherwise(0)).alias("bads")),
        "label-bits")
    rows = rows.select(F.col("own.doc_id").alias("doc_id"), "n_words", "buckets")
    some = rows.join(marks, word == F.col("word")).select(
        (F.col("goods").bitwiseAND(bit) != 0).alias("good"), (F.col("bads").bitwiseAND(bit) != 0).alias("bad"),
        "n_words", "buckets")

    def runs(order: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(order) - 1),
                          lambda i: (i == 0) | (F.get(order, i) != F.get(order, i - 1)))
        return F.when(F.size(order) > 0, let(starts, lambda p: F.zip_with(
            p, F.concat(F.slice(p, F.lit(2), F.size(p)), F.array(F.size(order))),
            lambda i, end: F.struct(F.get(order, i).alias("bucket"), (end - i).alias("n")))))

    return some.where("good OR bad").select(
        "good", "bad", "n_words", let(F.sort_array("buckets"), runs).alias("grams"))


def bucket_counts(rows: DataFrame) -> DataFrame:
    """(bucket, n): n-grams of all described rows."""
    return rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def bucket_weights(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """(bucket, weight, trusted): ln(target / raw) of every bucket seen, both with one added, and the target's count.

    With no trusted document all weights are 0.
    """
    target = labelled.where("good").select(F.explode("grams").alias("g")).groupBy(F.col("g.bucket").alias("bucket")).agg(
        F.sum("g.n").alias("trusted"))
    both = bucket_counts(rows).withColumnRenamed("n", "raw").join(target, "bucket", "left")
    # One row per bucket, at most BUCKETS: the totals may be taken in one task.
    whole = Window.partitionBy(F.lit(1))
    t, r = F.coalesce("trusted", F.lit(0)), F.col("raw")
    sum_t, sum_r = F.sum(t).over(whole), F.sum(r).over(whole)
    return both.select("bucket", F.when(sum_t > 0, F.round(
        F.log((t + 1) / (sum_t + BUCKETS)) - F.log((r + 1) / (sum_r + BUCKETS)), 9)).otherwise(F.lit(0.0)).alias("weight"),
        t.alias("trusted"))


def _arrays(weights: DataFrame) -> tuple[Column, Column, int]:
    """Weights and target counts, position = bucket, as constants, and the total of the target.

    BUCKETS rows at most come to the driver.
    """
    values, counts = ["0.0"] * BUCKETS, [0] * BUCKETS
    for bucket, weight, trusted in weights.collect():
        values[bucket], counts[bucket] = repr(weight), trusted
    return (F.split(F.lit(",".join(values)), ",").cast("array<double>"),
            F.split(F.lit(",".join(map(str, counts))), ",").cast("array<bigint>"), sum(counts))


def _score(buckets: Column, weights: Column) -> Column:
    total = F.aggregate(buckets, F.lit(0.0), lambda s, b: s + F.coalesce(F.get(weights, b.cast("int")), F.lit(0.0)))
    return F.round(total / (F.size(buckets) + PRIOR), SCORE_DIGITS)


def _repeated(hashes: Column) -> Column:
    """Words inside REPEAT_WINDOW-word windows that occur twice or more; windows may overlap."""
    step = hashes
    for width in (1, 2, 4):  # hashes of 2, 4 and then 8 words
        step = (lambda s, w: let(s, lambda x: pair_up(x, w, lambda a, b: F.xxhash64(a, b))))(step, width)

    def covered(windows: Column) -> Column:
        order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(order, lambda o: F.array_sort(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(o) - 1), lambda j: (
                F.get(o, j)["h"].eqNullSafe(F.get(o, j - 1)["h"]) | F.get(o, j)["h"].eqNullSafe(F.get(o, j + 1)["h"]))),
            lambda j: F.get(o, j)["i"])))
        return let(starts, lambda p: F.aggregate(
            F.zip_with(F.slice(p, F.lit(2), F.size(p)), p, lambda b, a: F.coalesce(
                F.least(b - a, F.lit(REPEAT_WINDOW)), F.lit(REPEAT_WINDOW))),
            F.lit(0), lambda n, x: n + x))

    return let(step, lambda windows: F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), covered(windows)).otherwise(F.lit(0)))


def outside_scores(labelled: DataFrame, weights: Column, counts: Column, total: int) -> DataFrame:
    """(good, bad, s) of rows with MIN_WORDS or more: the score, of a trusted row against the target without that row."""
    def sum_of(term) -> Column:
        return F.aggregate("grams", F.lit(0.0), lambda s, g: s + g["n"] * term(g))

    weight = lambda g: F.coalesce(F.get(weights, g["bucket"].cast("int")), F.lit(0.0))
    n = F.aggregate("grams", F.lit(0), lambda s, g: s + g["n"])
    left_out = sum_of(lambda g: weight(g) + F.log(
        (F.get(counts, g["bucket"].cast("int")) - g["n"] + 1) / (F.get(counts, g["bucket"].cast("int")) + 1)))
    score = F.when(F.col("good"), left_out + F.col("size") * F.log(F.lit(float(total + BUCKETS)) / (total + BUCKETS - F.col("size")))
                   ).otherwise(sum_of(weight))
    return labelled.where(F.col("n_words") >= MIN_WORDS).withColumn("size", n).select(
        "good", "bad", F.round(score / (F.col("size") + PRIOR), SCORE_DIGITS).alias("s"))


def value_at(values: DataFrame, share: float) -> int | None:
    """Of the integers ``v`` the one at position ``share`` from the smallest; None without any.

    Counted in ever narrower ranges, each about a thousand times narrower; only counts of ranges come to the driver.
    """
    rank, within = None, values.where(F.col("v").isNotNull())
    for width in (10**6, 10**3, 1):
        ranges = sorted(tuple(x) for x in within.groupBy(F.floor(F.col("v") / width).alias("r")).count().collect())
        if not ranges:
            return None
        if rank is None:
            rank = int(share * (sum(c for _, c in ranges) - 1))
        ends = list(accumulate(c for _, c in ranges))
        i = next(i for i, end in enumerate(ends) if end > rank)
        rank -= ends[i] - ranges[i][1]
        first = ranges[i][0] * width
        within = within.where(F.col("v").between(first, first + width - 1))
    return first


def threshold(scores: DataFrame) -> float:
    """The score below which a document goes, from ``outside_scores``.

    At most the share SPARE of trusted documents lies below it; it is halfway from there to the best rejected
    score beneath, if there is one. With no trusted or no rejected label nothing lies below.
    """
    low = value_at(scores.where("good").select(F.round(F.col("s") * 10**SCORE_DIGITS).cast("bigint").alias("v")), SPARE)
    if low is None:
        return float("-inf")
    low /= 10**SCORE_DIGITS
    below = scores.where("bad").where(F.col("s") < low).agg(F.max("s")).first()[0]
    return float("-inf") if below is None else (low + below) / 2


def fitted(rows: DataFrame, labels: DataFrame) -> tuple[Column, float]:
    """The bucket weights as a constant, and the threshold, from described rows."""
    labelled = stored(labelled_grams(rows, labels), "labelled-grams")
    weights, counts, total = _arrays(bucket_weights(rows, labelled))
    scores = stored(outside_scores(labelled, weights, counts, total), "labelled-scores")
    least = threshold(scores)
    discard(labelled, scores)
    return weights, least


def verdicts(rows: DataFrame, weights: Column, least: float) -> DataFrame:
    """Described rows with ``base_failed``, ``score`` and ``kept`` in place of their buckets."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    scored = rows.withColumn("score", _score(F.col("buckets"), weights)).withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(least))).drop("buckets")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One line per row: doc_id, the base counts, ``score``, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base rule; repeated rows get equal verdicts; other columns are
    not read. An empty table gives an empty result. Buckets are written once, and counts, fit and scores read those.
    """
    rows = stored(described(docs, ["doc_id"]), "buckets")
    out = verdicts(rows, *fitted(rows, labels))
    return out.select("own.doc_id", *out.columns[1:])


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, as they are; edge cases as in ``judged``.

    The written buckets serve the fit and go after it; whole rows are described again instead of being written with them.
    """
    rows = stored(described(docs, ["doc_id"]).select("own", "n_words", "buckets"), "buckets")
    weights, least = fitted(rows, labels)
    discard(rows)
    # A filter would be pushed below the projections and split and hash every text once for each mention of its
    # words; it isn't pushed through an explode.
    stay = F.when(F.col("kept"), F.array("own"))
    out = verdicts(described(docs, docs.columns), weights, least)
    return out.select(F.explode(stay).alias("own")).select(*[F.col(f"own.`{c}`") for c in docs.columns])
