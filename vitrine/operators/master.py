"""The master table: union of the shops and one vocabulary for all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.functions.text import normalise
from vitrine.schema import FIELDS
from vitrine.shared import stored

#: Between family and shade in a feed product's name.
FAMILY_MARK = " — "

#: Label of a value the vocabulary does not know.
OTHER = "autre"

#: Columns of the record whose labels a vocabulary table may replace.
VOCABULARY_FIELDS = ("category", "finish_type", "coverage_level", "availability")


def build_master(dfs: Mapping[str, DataFrame] | Sequence[DataFrame]) -> DataFrame:
    """Union by column name; missing columns become null, duplicates stay.

    With a mapping each row keeps the name of its source.
    """
    if isinstance(dfs, Mapping):
        dfs = [df.withColumn("source", F.lit(name)) for name, df in dfs.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    lead = [c for c in union.columns if c not in FIELDS]
    return union.select(*lead, *[c for c in FIELDS if c in union.columns])


def number_rows(df: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Add ``row_no`` 0..n-1, contiguous, in ``order`` or as the rows come.

    The rows are range-partitioned and sorted, and written with their partition and place to the shared folder, so that
    both stay as they are. The partitions' sizes, one row each, are summed up to offsets.
    """
    placed = (df.orderBy(*order) if order else df).withColumn("_place", F.monotonically_increasing_id())
    placed = stored(placed, "placed-rows").withColumns(
        {"_part": F.shiftright("_place", 33), "_place": F.col("_place").bitwiseAND((1 << 33) - 1)})
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_part").select((F.col("_start") + F.col("_place")).alias("row_no"), *df.columns)


def _lookup(mapping: Mapping[str, str], key: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(pairs, key)


def harmonise(
    df: DataFrame, vocab: Mapping[str, Mapping[str, str]] | DataFrame, fields: Sequence[str] | None = None
) -> DataFrame:
    """Replace labels by the common vocabulary.

    ``vocab`` maps a column to ``{label: common label}`` or is a table ``(field, label, common)``, of which the
    ``fields`` are used (those of the record with a vocabulary by default). Labels are compared without
    case, accents and extra blanks. An unknown label becomes ``autre``; blank stays
    blank. A mapping travels inside the plan; a table is joined, see ``_harmonise_from``.
    """
    if isinstance(vocab, DataFrame):
        return _harmonise_from(df, vocab, VOCABULARY_FIELDS if fields is None else fields)
    changed = {}
    for field, mapping in vocab.items():
        keys = {_plain(k): v for k, v in mapping.items()}
        key = normalise(F.col(field))
        changed[field] = F.when(F.coalesce(key, F.lit("")) != "", F.coalesce(_lookup(keys, key), F.lit(OTHER)))
    return df.withColumns(changed)


def _harmonise_from(df: DataFrame, vocab: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One equi-join a field on the compared label, broadcast or shuffled as the measured size of the vocabulary asks.

    Of labels that are compared alike the smallest common one counts. Rows are neither dropped nor repeated.
    """
    out = df
    for field in fields:
        own = vocab.where((F.col("field") == field) & F.col("common").isNotNull())
        own = own.groupBy(normalise(F.col("label")).alias("_key")).agg(F.min("common").alias("_common")).where("_key != ''")
        keyed = out.withColumn("_label", normalise(F.col(field))).join(own, F.col("_label") == F.col("_key"), "left")
        told = F.when(F.coalesce("_label", F.lit("")) != "", F.coalesce("_common", F.lit(OTHER)))
        out = keyed.withColumn(field, told).select(*df.columns)
    return out


def _plain(label: str) -> str:
    """Python twin of ``normalise`` for the few labels of a vocabulary."""
    from vitrine.functions.text import ACCENTED, PLAIN

    text = " ".join(label.split()).lower().translate(str.maketrans(ACCENTED, PLAIN))
    return text.replace("œ", "oe").replace("æ", "ae")


def unmapped(df: DataFrame, vocab: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """How many rows of each column hold a label that the vocabulary lacks; ``df`` isn't harmonised yet."""
    def failed(field: str, mapping: Mapping[str, str]) -> Column:
        key = normalise(F.col(field))
        return (F.coalesce(key, F.lit("")) != "") & ~F.coalesce(key, F.lit("")).isin(*[_plain(k) for k in mapping])

    counts = df.agg(*[F.count_if(failed(f, m)).alias(f) for f, m in vocab.items()])
    return counts.unpivot([], list(vocab), "field", "n_unmapped")


def brand_group(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Add ``brand_group`` from ``groups(brand, brand_group)``; unlisted brands stay alone.

    No broadcast is forced: Catalyst broadcasts the map when its size allows, else the
    join is a shuffle join whose hot brands AQE splits.
    """
    once = groups.groupBy("brand").agg(F.min("brand_group").alias("_group"))
    return (
        df.join(once, "brand", "left")
        .withColumn("brand_group", F.coalesce("_group", "brand"))
        .select(*df.columns, "brand_group")
    )


def price_direction(df: DataFrame) -> DataFrame:
    """Add ``list_price``, ``sale_price`` and ``on_promo`` whichever column holds the old price."""
    return df.withColumns({
        "list_price": F.greatest("price", "promo_price"),
        "sale_price": F.least("price", "promo_price"),
        "on_promo": F.coalesce(F.col("price") != F.col("promo_price"), F.lit(False)),
    })


def split_family(df: DataFrame, mark: str = FAMILY_MARK) -> DataFrame:
    """Add ``family`` and ``shade`` from the product name; no mark, no shade."""
    name = F.col("product_name")
    at = F.instr(name, F.lit(mark))
    return df.withColumns({
        "family": F.substring_index(name, mark, 1),
        "shade": F.when(at > 0, F.substr(name, at + F.lit(len(mark)))),
    })
