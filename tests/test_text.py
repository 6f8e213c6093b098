import random
import re
import time

import pytest
from pyspark.sql import functions as F

import vitrine as v
from vitrine.functions.numbers import CENT_PRICE, number, price_pair
from vitrine.functions.rules import Tag, contains_any, near_word, one_of
from vitrine.functions.text import ENTITIES, collapse, decode_references, markup, strip


def test_visible_text_joins_stripped_nodes(value):
    html = "<p>\n a  b </p><b>c</b>d<script>x='</p>'</script><!-- e --><style>f{}</style> <i> </i>g"
    assert value(html, v.visible_text) == "a  b c d g"


def test_visible_text_keeps_a_bare_less_than_and_quoted_greater_than(value):
    assert value('<p title="1 > 0">a < b</p>', v.visible_text) == "a < b"


def test_visible_text_unclosed_script_hides_the_rest(value):
    assert value("<p>a</p><SCRIPT>b", v.visible_text) == "a"


def test_visible_text_of_many_tags_and_blanks(value):
    assert value("<td></td>" * 50_000 + " " * 50_000 + "x", v.visible_text) == "x"


def test_references_are_decoded_once(value):
    text = "&eacute;&#233;&#xE9;&#128; &amp;lt; &nosuch; &#0; a&b &#x110000;"
    assert value(text, decode_references) == "ééé€ &lt; &nosuch; &#0; a&b &#x110000;"


def test_no_break_blanks_are_blanks(value):
    assert value("  a  b  ", strip) == "a  b"
    assert value("  a  b  ", collapse) == "a b"


def test_normalise(value):
    assert value(" Œuvre  LÉGÈRE à ", v.normalise) == "oeuvre legere a"
    once = value("Ça  ÉTÉ", v.normalise)
    assert value(once, v.normalise) == once


def test_first_match_takes_the_first_rule_not_the_first_word(value):
    rules = [("semi-mat", "satine"), ("mat", "mat"), ("glow", "lumineux")]
    assert value("glow et semi-mat", lambda s: v.first_match(s, rules)) == "satine"
    assert value("automate", lambda s: v.first_match(s, rules)) == "mat"
    assert value("automate", lambda s: v.first_match(s, rules, whole_words=True)) is None
    assert value("rien", lambda s: v.first_match(s, rules)) is None
    assert value("couvrance légère", lambda s: v.first_match(s, [("legere", "x")])) is None
    assert value("couvrance légère", lambda s: v.first_match(s, [("legere", "x")], plain=True)) == "x"


def test_near_word_reach_and_full_stop(value):
    near = lambda s: near_word(s, ("peau", "peaux"), "grasse")
    assert value("pour peaux mixtes et grasses", near)
    assert not value("la peau. grasse", near)
    assert not value("la peaugrasse", near)
    assert not value("lapeau grasse", near)
    assert value("épeau peau " + "x" * 118 + " grasse", near)
    assert not value("peau " + "x" * 119 + " grasse", near)
    assert not value("peau dégrasse", near)


def test_all_matches_order_and_no_repeats(value):
    rules = [Tag("a", ("x",)), Tag("b", ("y",)), Tag("a", ("z",))]
    assert value("z y x", lambda s: v.all_matches(s, rules)) == ["a", "b"]
    assert value("z y", lambda s: v.all_matches(s, rules)) == ["b", "a"]
    assert value("", lambda s: v.all_matches(s, rules)) == []


def test_one_of_quotes_its_words(value):
    for text, hit in (("a+b", True), ("ab", False), ("a.b", False)):
        assert value(text, lambda s: one_of(s, ["+", "x.y"])) is hit
        assert value(text, lambda s: contains_any(s, ["+", "x.y"])) is hit


def test_prices(value):
    text = "45,90 € puis 39.90 € ou 45.9€ et 1 € 500 € 7,123 € 12"
    found = [float(x) for x in value(text, lambda s: v.prices(s, low=1, high=500))]
    assert found == [123.0, 45.9, 39.9]  # 7,123 has three decimals: only its last part is a price
    assert [float(x) for x in value("3 € 4,50 €", lambda s: v.prices(s, CENT_PRICE, None, None))] == [4.5]
    pair = value("9 € 8 € 7 €", lambda s: F.struct(*[c.alias(n) for c, n in zip(price_pair(v.prices(s)), "hl")]))
    assert (float(pair.h), float(pair.l)) == (9.0, 7.0)
    assert value("9 €", lambda s: price_pair(v.prices(s))[1]) is None


def test_volume(value):
    both = lambda s: F.struct(*[c.alias(n) for c, n in zip(v.volume(s, ml_ends_word=True), "au")])
    assert tuple(value("12 g et 30,5 ML.", both)) == (30.5, "ml")
    assert tuple(value("12 g et 30 mlx", both)) == (12, "g")
    assert tuple(value("12 gr", both)) == (None, None)


def test_long_digit_runs_are_linear(value):
    assert value("7" * 300_000 + " x 12 teintes", lambda s: number(s, r"(\d+) teinte", "int")) == 12
    assert [float(x) for x in value("7" * 300_000 + " 9 €", v.prices)] == [9.0]
    assert value("12x" + "7" * 20 + " ml", lambda s: v.volume(s)[0]) is None   # too long for the column


def test_number_of_blank_is_null(value):
    assert value("none", lambda s: number(s, r"(\d+)")) is None


def test_urls(value):
    for href, want in (("/a", "b/a"), ("http://x", "http://x"), ("mailto:a", None), ("", None), ("a/b", None)):
        assert value(href, lambda s: v.absolute_url(s, "b")) == want
    assert value("http://x/a?b=c?d", v.canonical_url) == "http://x/a"
    assert value("http://x/" + "y" * 80, v.slug) == "y" * 60
    assert value("http://x/p/abc-P1.html", lambda s: v.slug(s, "product")) == "abc-P1.html"
    assert value("http://x/" + "y" * 80, lambda s: v.slug(s, "product")) == "y" * 40
    assert value("http://x/fr/q/fr/z", lambda s: v.slug(s, "locale")) == "z"


def test_every_reference_is_decoded_before_blanks_are_stripped(value):
    import html

    for text in ("Gr&szlig;e &frac12; &Ouml;l", "&ampx &lt3 &copy2 &notit; &notin; &bogus; &#8364 &#x20AC; &#150; &#0; &hearts", "&NotEqualTilde;"):
        assert value(text, v.visible_text) == html.unescape(text).replace("\ufffd", "&#0;")
    assert value("<b>&#160;x&#xA0;</b><i>&nbsp;</i><b>y&ensp;z</b>", v.visible_text) == "x y\u2002z"


def test_many_rules_equal_one_scan_per_rule(spark):
    rnd = random.Random(6)
    words = sorted({"".join(rnd.choice("ab -+é") for _ in range(rnd.randint(1, 5))) for _ in range(200)}, key=lambda w: rnd.random())
    rules = [(w, f"v{i % 11}") for i, w in enumerate(words) if w.strip()]
    texts = ["".join(rnd.choice("abc -+é.") for _ in range(rnd.randint(0, 40))) for _ in range(300)] + ["", None]
    table = spark.createDataFrame([(t,) for t in texts], "s string")
    few = lambda **how: F.coalesce(*[v.first_match(F.col("s"), [r], **how) for r in rules])
    for how in ({}, {"whole_words": True}):
        assert table.where(~v.first_match(F.col("s"), rules, **how).eqNullSafe(few(**how))).count() == 0


def test_many_rules_take_the_time_of_one_scan(spark):
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in range(4000)]
    table = spark.createDataFrame([(" ".join("".join(rnd.choice("abcdefgh") for _ in range(8)) for _ in range(20_000)),)], "s string").cache()

    def seconds(n):
        best = 99.0
        for _ in range(2):
            start = time.time()
            table.select(v.first_match(F.col("s"), [(w, "x") for w in words[:n]])).collect()
            best = min(best, time.time() - start)
        return best

    assert seconds(4000) < 8 * seconds(100) + 2


def test_an_empty_keyword_is_in_every_text(value):
    rules = [(f"k{i}", str(i)) for i in range(40)]
    assert value("x", lambda s: v.first_match(s, [*rules[:5], ("", "all"), *rules[5:]])) == "all"
    assert value("k2 k7", lambda s: v.first_match(s, [*rules[:5], ("", "all"), *rules[5:]])) == "2"
    assert value("k7", lambda s: v.first_match(s, [*rules[:5], ("", "all"), *rules[5:]])) == "all"


def test_one_of_many_words(value):
    words = [f"w{i}+" for i in range(50)]
    assert value("a w49+ b", lambda s: one_of(s, words)) and not value("a w49 w5", lambda s: one_of(s, words))


def test_near_word_equals_the_pattern_that_retries_at_every_anchor(spark):
    rnd = random.Random(3)
    parts = ["peau", "peaux", "grasse", " ", ".", "x", "-", "é", "gras", "peaugrasse", " grasse", " peau ", "grasse"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) + " " * rnd.choice([0, 0, 3, 118, 119, 120, 121]) + rnd.choice(parts)
             for _ in range(3000)]
    word = r"[^\W]"
    plain = re.compile(rf"(?:^|(?!{word})[\s\S])(?:peau|peaux)[^.]{{0,119}}(?!{word})[^.]grasse")
    table = spark.createDataFrame([(t, bool(plain.search(t))) for t in texts], "s string, want boolean")
    assert table.where(near_word(F.col("s"), ("peau", "peaux"), "grasse") != F.col("want")).count() == 0


@pytest.mark.parametrize("unit", ["peau ", "peau grass ", " grasse peau."])
def test_near_word_on_a_million_anchors(spark, unit):
    table = spark.createDataFrame([(unit * 1_000_000,)], "s string")
    start = time.time()
    assert not table.select(near_word(F.col("s"), ("peau", "peaux"), "grasse").alias("x")).first()["x"]
    assert time.time() - start < 20


def test_markup_turns_each_sign_of_a_quoted_value(spark):
    pages = {
        """<a title="1 < 2 = x > 0" b='p="q">' c=d>e = f</a>""":
            """<a title="1 &lt; 2 &#61; x &gt; 0" b='p&#61;"q"&gt;' c=d>e = f</a>""",
        """<a b = "<<>>" c="">x = "y"</a>""": """<a b = "&lt;&lt;&gt;&gt;" c="">x = "y"</a>""",
        """<!-- <a b="<"> --><p>"a < b"</p>""": """<p>"a < b"</p>""",
    }
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    assert [r[0] for r in df.select(markup(F.col("html"))).collect()] == list(pages.values())


def test_references_are_found_without_a_walk_over_all(spark):
    """The names travel as one text, not as thousands of literals of a map; each is found, and nothing else is."""
    pages = spark.createDataFrame([(f"&{name};", text) for name, text in ENTITIES.items()] + [
        ("&amp;lt;&lt;&gt;&#61;", "&lt;<>="), ("&amp;#61; &lt&#61; &#129;&#128;", "&#61; <= \x81€"), ("&;&#; &bogus; &", "&;&#; &bogus; &")],
        "s string, want string")
    read = pages.select("*", decode_references(F.col("s")).alias("got"))
    assert [r for r in read.collect() if r.got != r.want] == []
    assert "map(" not in read._jdf.queryExecution().analyzed().toString()
