from decimal import Decimal

import pytest

import vitrine as v

HEADER = ",".join(v.FIELDS)
ROW_A = 'Base 1,M,teint,42.0,33.6,30,4.6,524,40,mat,totale,grasse / mixte,en stock,http://a/1'
ROW_B = '"Base, ""2""",M,teint,9.99,,,,,1,,,,Rupture,http://a/2'


@pytest.fixture
def csv(tmp_path):
    def write(name, *lines, end="\n"):
        path = tmp_path / name
        path.write_bytes((end.join(lines) + end).encode("utf-8"))
        return str(path)

    return write


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_read_csv(spark, csv, end):
    df = v.read_catalog_csv(spark, csv("a.csv", HEADER, ROW_A, ROW_B, end=end))
    assert df.schema == v.CANONICAL
    a, b = df.orderBy("source_url").collect()
    assert (a.price, a.promo_price, a.rating, a.review_count, a.shade_count) == (
        Decimal("42.00"), Decimal("33.60"), Decimal("4.6000"), 524, 40)
    assert (b.product_name, b.promo_price, b.volume_ml, b.rating, b.finish_type) == ('Base, "2"', None, None, None, None)
    assert b.source_url == "http://a/2"     # no stray carriage return


def test_read_csv_wrong_header_or_row_raises(spark, csv):
    with pytest.raises(Exception):
        v.read_catalog_csv(spark, csv("h.csv", HEADER.replace("rating", "note"), ROW_A)).collect()
    with pytest.raises(Exception):
        v.read_catalog_csv(spark, csv("r.csv", HEADER, ROW_A.replace("42.0", "cher"))).collect()


def test_read_catalogs_and_round_trip(spark, csv, tmp_path):
    paths = {"x": csv("x.csv", HEADER, ROW_A), "y": csv("y.csv", HEADER, ROW_B, ROW_A, end="\r\n")}
    master = v.read_catalogs(spark, paths)
    assert {(r.source, r.n) for r in v.count_by(master, ["source"]).collect()} == {("x", 1), ("y", 2)}
    v.write_catalog_csv(master, str(tmp_path / "out"))
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("*.csv"))
    assert HEADER in text and '""' not in text.replace('""2""', "")
    again = v.read_catalog_csv(spark, str(tmp_path / "out"))
    assert sorted(again.collect(), key=str) == sorted(master.select(*v.FIELDS).collect(), key=str)


def test_line_end_in_quotes_needs_multi_line(spark, csv):
    path = csv("m.csv", HEADER, ROW_A.replace("Base 1", '"Base\n1"'))
    assert v.read_catalog_csv(spark, path, multi_line=True).first().product_name == "Base\n1"
    with pytest.raises(Exception):
        v.read_catalog_csv(spark, path).collect()


def test_count_written_as_float(spark, csv):
    assert v.read_catalog_csv(spark, csv("f.csv", HEADER, ROW_A.replace(",524,", ",524.0,"))).first().review_count == 524


def test_conform_names_and_types(spark):
    full = spark.createDataFrame([tuple("x" if f == "product_name" else "" for f in v.FIELDS)], v.FIELDS)
    row = v.conform(full).first()
    assert row.product_name == "x" and row.price is None and row.brand is None
    with pytest.raises(ValueError, match="missing"):
        v.conform(full.drop("price"))
    with pytest.raises(ValueError, match="unknown"):
        v.conform(full.withColumn("colour", full.brand))
    bad = full.withColumn("price", full.product_name)
    assert v.conform(bad, strict=False).first().price is None
    with pytest.raises(Exception):
        v.conform(bad).collect()


FEED = [
    ("f", 1, 200, '{"products":[{"title":"Soft\'Lit Base","vendor":"B","product_type":"Foundation","handle":"h1",'
                  '"variants":[{"title":"#120","price":"39.90","compare_at_price":"45.00","available":true},{"title":"2"}]},'
                  '{"title":"Sponge","vendor":"B","product_type":"Makeup Sponges","handle":"h2","variants":[]}]}'),
    ("f", 2, 200, '{"products":[{"title":"Matte Longwear Powder","vendor":"B","handle":"h3","variants":[]},{"title":"Stick","vendor":"B","handle":"h4"}]}'),
    ("f", 3, 500, '{"products":[{"title":"never"}]}'),
    ("f", 4, 200, '{"products":[{"title":"after the stop"}]}'),
    ("g", 1, 200, '{"products":[]}'), ("g", 2, 200, '{"products":[{"title":"x"}]}'),
    ("k", 1, 200, "not json"), ("l", 1, 200, None),
    ("n", 1, 200, '{"products":[{"title":"one"}]}'), ("n", 3, 200, '{"products":[{"title":"behind a gap"}]}'),
    ("o", 1, 200, '{"products":[{"title":"late","variants":[{"price":"1,234.00"}]}]}'),
    *[("p", i, 200, '{"products":[{"title":"p"}]}') for i in range(1, 9)],
    ("m", 5, 200, '{"products":[{"title":"five"}]}'), ("m", 6, 200, '{"products":[{"title":"six"}]}'),
]


def test_feed(spark):
    pages = spark.createDataFrame(FEED, "feed string, page int, status int, body string")
    feed = v.read_feed(pages)
    assert {(r.feed, r.page) for r in feed.collect()} == {("f", 1), ("f", 2), ("n", 1), ("o", 1), *[("p", i) for i in range(1, 9)]}
    assert v.read_feed(pages, max_pages=5).filter("feed = 'p'").count() == 5
    assert v.feed_products(feed.filter("feed = 'o'"), "u").first().price is None
    rows = {r.source_url: r for r in v.feed_products(feed.filter("feed = 'f'"), "http://s/p/").collect()}
    assert set(rows) == {"http://s/p/h1", "http://s/p/h3", "http://s/p/h4"}   # the blocked type is gone, no type passes
    a, b, c = (rows[f"http://s/p/h{i}"] for i in (1, 3, 4))
    assert (a.price, a.promo_price, a.volume_ml, a.shade_count) == (Decimal("39.90"), Decimal("45.00"), Decimal(12), 2)
    assert (a.finish_type, a.coverage_level, a.skin_type, a.availability) == ("lumineux", "moyen", "sèche", "en stock")
    assert (b.price, b.volume_ml, b.shade_count, b.availability) == (None, Decimal(9), 0, "rupture")
    assert (b.finish_type, b.coverage_level, b.skin_type, b.category) == ("mat", "couvrant", "grasse", None)
    assert (c.finish_type, c.coverage_level, c.skin_type, c.volume_ml) == ("naturel", "léger", "mixte", Decimal(9))


def test_to_canonical_defaults(spark):
    df = spark.createDataFrame([("a", "", "9,9"), ("b", "B", None)], "product_name string, brand string, finish_type string")
    rows = v.to_canonical(df, "s", {"brand": "Maison", "availability": "En stock"}).orderBy("product_name").collect()
    assert [(r.source, r.brand, r.availability, r.price) for r in rows] == [("s", "Maison", "En stock", None), ("s", "B", "En stock", None)]


def test_checked_csv_sets_broken_rows_aside(spark, csv):
    path = csv("c.csv", HEADER, ROW_A, ROW_A.replace("42.0", "cher"), ROW_B, ROW_B + ",more", "too,few")
    good, bad = v.read_catalog_csv_checked(spark, path)
    want = v.read_catalog_csv(spark, csv("ok.csv", HEADER, ROW_A, ROW_B))
    assert sorted(map(str, good.collect())) == sorted(map(str, want.collect())) and good.schema == want.schema
    rows = bad.collect()
    assert sorted(r.rejected_row for r in rows) == sorted([ROW_A.replace("42.0", "cher"), ROW_B + ",more", "too,few"])
    assert all(r.file.endswith("c.csv") for r in rows)


def test_checked_csv_of_no_rows(spark, csv):
    good, bad = v.read_catalog_csv_checked(spark, csv("e.csv", HEADER))
    assert good.count() == bad.count() == 0
