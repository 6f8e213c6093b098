from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import vitrine as v

ROWS = [
    # source, name, brand, category, price, promo, volume, rating, reviews, shades, finish, skin, availability
    ("f", "Soft — #1", "Fa", "teint", "30.00", None, "30", None, None, 2, "mat", "grasse", "en stock"),
    ("f", "Soft — #2", "Fa", "teint", "23.00", "45.00", "12", None, None, 2, "satine", "mixte", "rupture"),
    ("f", "Care", "Fb", "soin", "20.00", None, None, None, None, 1, None, None, "en stock"),
    ("n", "Light", "N", "teint", "56.00", "44.80", "30", "4.5", 732, 47, "Satiné", "sèche / sensible", "En stock"),
    ("n", "Cream", "N", "correcteur", "33.00", None, "6", "4.7", 489, 16, "SATIN", "grasse / sèche", "Rupture"),
]


@pytest.fixture(scope="module")
def master(spark):
    df = spark.createDataFrame(
        [(s, n, b, c, p, q, vol, r, rc, sh, f, None, sk, a, f"http://{s}/{n}") for s, n, b, c, p, q, vol, r, rc, sh, f, sk, a in ROWS],
        "source string, product_name string, brand string, category string, price string, promo_price string, volume_ml string, "
        "rating string, review_count int, shade_count int, finish_type string, coverage_level string, skin_type string, "
        "availability string, source_url string",
    )
    return v.conform(df).cache()


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_union_fills_missing_columns_and_keeps_duplicates(spark, master):
    one = master.drop("source", "rating")
    union = v.build_master({"a": one, "b": master.drop("source"), "c": one})
    assert union.columns == ["source", *v.FIELDS]
    assert v.master_size(union).first().n_products == 3 * len(ROWS)
    assert union.filter("source = 'a' AND rating IS NOT NULL").count() == 0
    assert v.build_master([one, one]).count() == 2 * len(ROWS)


def test_number_rows(master):
    rows = v.number_rows(master.repartition(3), ["source", "product_name"]).orderBy("row_no").collect()
    assert [r.row_no for r in rows] == list(range(len(ROWS)))
    assert [(r.source, r.product_name) for r in rows] == sorted((x[0], x[1]) for x in ROWS)
    assert [r.row_no for r in v.number_rows(master).orderBy("row_no").collect()] == list(range(len(ROWS)))


def test_harmonise(master):
    vocab = {"finish_type": {"Satiné": "satiné", "satin": "satiné"}, "availability": {"EN STOCK": "en stock", "rupture": "rupture"}}
    fixed = v.harmonise(master, vocab)
    names = by(fixed, "product_name")
    assert [names[n].finish_type for n in ("Light", "Cream", "Soft — #1", "Soft — #2", "Care")] == ["satiné", "satiné", "autre", "satiné", None]
    assert {r.availability for r in names.values()} == {"en stock", "rupture"}
    assert {r.field: r.n_unmapped for r in v.unmapped(master, vocab).collect()} == {"finish_type": 1, "availability": 0}


def test_brand_group_never_multiplies_rows(spark, master):
    groups = spark.createDataFrame([("Fb", "Fa"), ("Fb", "Fa"), ("Fa", "Fa")], "brand string, brand_group string")
    grouped = v.brand_group(master, groups)
    assert grouped.count() == len(ROWS)
    assert {r.brand_group for r in grouped.collect()} == {"Fa", "N"}


def test_price_direction(master):
    rows = by(v.price_direction(master), "product_name")
    a, b, c = rows["Soft — #2"], rows["Light"], rows["Care"]
    assert (a.list_price, a.sale_price, a.on_promo) == (Decimal("45.00"), Decimal("23.00"), True)
    assert (b.list_price, b.sale_price, b.on_promo) == (Decimal("56.00"), Decimal("44.80"), True)
    assert (c.list_price, c.sale_price, c.on_promo) == (Decimal("20.00"), Decimal("20.00"), False)
    assert all(r.sale_price <= r.list_price for r in rows.values())


def test_families(master):
    rows = by(v.split_family(master), "product_name")
    assert (rows["Soft — #2"].family, rows["Soft — #2"].shade) == ("Soft", "#2")
    assert (rows["Care"].family, rows["Care"].shade) == ("Care", None)
    rolled = by(v.family_rollup(master), "family")
    assert tuple(rolled["Soft"])[2:] == (2, 2, Decimal("23.00"), Decimal("30.00"))
    assert rolled["Care"].n_shades == 0


def test_benchmark(master):
    b = by(v.brand_benchmark(master), "brand")
    n, f = b["N"], b["Fb"]
    assert n.avg_price == pytest.approx(44.5) and n.avg_reviews == pytest.approx(610.5)
    assert n.price_per_ml_mean == pytest.approx((56 / 30 + 33 / 6) / 2)
    assert n.price_per_ml_total == pytest.approx(89 / 36)
    assert (n.avg_shades, n.max_shades, n.avg_rating) == (31.5, 47, 4.6)
    assert (f.price_per_ml_mean, f.price_per_ml_total, f.avg_rating) == (None, None, None)
    assert by(v.brand_benchmark(master, "teint"), "brand")["N"].n_products == 1


def test_ranks_and_gap(master):
    bench = v.brand_benchmark(master)
    assert {r.brand: r.rank for r in v.rank_brands(bench, "avg_price").collect()} == {"N": 1, "Fa": 2, "Fb": 3}
    assert {r.brand: r.rank for r in v.rank_brands(bench, "avg_rating").collect()} == {"N": 1, "Fa": 2, "Fb": 2}
    assert {r.brand: r.rank for r in v.rank_brands(bench, "avg_price", "low").collect()} == {"N": 3, "Fa": 2, "Fb": 1}
    gap = by(v.market_gap(master, "price"), "brand")
    assert gap["N"].market_value == pytest.approx(162 / 5) and gap["N"].gap == pytest.approx(44.5 - 32.4)


def test_mixes(master):
    mix = {(r.brand, r.finish_type): (r.n, r.share) for r in v.finish_mix(master).collect()}
    assert mix[("Fa", "mat")] == (1, 0.5) and mix[("Fb", None)] == (1, 1.0)
    wide = by(v.finish_table(master, ["mat", "satine"]), "brand")
    assert (wide["Fa"].mat, wide["Fa"].satine, wide["N"].autre) == (1, 1, 2)
    tags = {(r.brand, r.tag): r.n for r in v.tag_mix(master).collect()}
    assert tags == {("Fa", "grasse"): 1, ("Fa", "mixte"): 1, ("N", "sèche"): 2, ("N", "sensible"): 1, ("N", "grasse"): 1}


def test_rates(master):
    assert {r.brand: r.availability_rate for r in v.availability_rate(master).collect()} == {"Fa": 0.5, "Fb": 1.0, "N": 0.5}
    promo = by(v.promo_depth(v.price_direction(master)), "brand")
    assert promo["N"].avg_discount == pytest.approx(0.2) and promo["N"].promo_share == 0.5
    assert promo["Fb"].avg_discount is None


def test_counts(master):
    assert [tuple(r) for r in v.count_by(master, ["category"], ordered=True).collect()] == [("correcteur", 1), ("soin", 1), ("teint", 3)]
    assert tuple(v.count_where(master, "category", ["teint", "correcteur"]).first()) == (3, 1)


def test_completeness(master):
    rows = {(r.source, r.column_name): tuple(r)[2:] for r in v.completeness(master).collect()}
    assert rows[("f", "price")] == (3, 0, 3, "20.00", "30.00")
    assert rows[("f", "rating")] == (3, 3, 0, None, None)
    assert rows[("n", "review_count")] == (2, 0, 2, "489", "732")
    assert rows[("f", "finish_type")] == (3, 1, 2, "mat", "satine")
    assert len(rows) == 2 * len(v.FIELDS)


def test_brand_report(master):
    shops = {s: master.filter(F.col("source") == s).drop("source") for s in ("f", "n")}
    shops["f"] = shops["f"].drop("rating", "review_count")
    rows = by(v.brand_report(shops), "brand")
    assert rows["N"].price_rank == 1 and rows["N"].rating_rank == 1 and rows["N"].fewest_reviews_rank == 1
    assert rows["Fa"].avg_list_price == pytest.approx(37.5)
    assert sorted(map(str, v.brand_report(master).collect())) == sorted(map(str, rows.values()))


def test_figures_do_not_depend_on_partitioning(master):
    assert sorted(v.brand_benchmark(master.repartition(4)).collect()) == sorted(v.brand_benchmark(master.coalesce(1)).collect())


def test_harmonise_from_a_table(spark, master):
    vocab = {"finish_type": {"Mat": "mat", "SATINÉ": "satiné"}, "availability": {"en stock": "en stock"}}
    table = v.vocabulary_table(spark, vocab).unionAll(spark.createDataFrame(
        [("finish_type", " mat ", "zzz"), ("finish_type", None, "x"), ("finish_type", "naturel", None), ("brand", "A", "B")], "field string, label string, common string"))
    want = v.harmonise(master, vocab)
    got = v.harmonise(master, table, list(vocab))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rank_rows_equals_the_window(spark):
    rows = [(i, [None, 1.0, 2.5, 2.5, 7.0][i % 5] if i < 300 else 3.0, i % 3) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, m double, _value int").repartition(7)
    for best, order in (("high", "m DESC NULLS LAST"), ("low", "m NULLS LAST")):
        want = {r.id: r.r for r in df.selectExpr("id", f"rank() over (order by {order}) r").collect()}
        got = v.rank_rows(df.drop("_value"), "m", ["id"], best).collect()
        assert {r.id: r["rank"] for r in got} == want and len(got) == 500
    plan = v.rank_rows(df.drop("_value"), "m", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and v.rank_rows(df.drop("_value").where("id < 0"), "m", ["id"]).count() == 0


def test_completeness_reads_the_table_once(spark):
    rows = spark.createDataFrame([(None, 1, "10"), ("a", None, "9"), ("a", 10, "9"), ("a", 9, None), ("b", None, None)], "s string, n int, t string")
    done = v.completeness(rows, "s", ["n", "t"])
    assert {tuple(r) for r in done.collect()} == {
        (None, "n", 1, 0, 1, "1", "1"), (None, "t", 1, 0, 1, "10", "10"), ("a", "n", 3, 1, 2, "9", "10"), ("a", "t", 3, 1, 1, "9", "9"),
        ("b", "n", 1, 1, 0, None, None), ("b", "t", 1, 1, 0, None, None)}
    assert done._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
