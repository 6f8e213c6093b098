"""DuckDB SQL for the registered queries, over the same whole tables."""

from __future__ import annotations

from itertools import product

from checks.inputs import BASE
from vitrine.functions.text import ACCENTED, BLANK, GAP, PLAIN, WORD
from vitrine.profiles import (
    SHADE_TEXT, STRUCTURED_COVERAGE, STRUCTURED_EXCLUDED, STRUCTURED_FINISH, STRUCTURED_OUT,
)
from vitrine.schema import CANONICAL, FIELDS


# References that the driver's pages hold, on their own account.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "copy": "©", "middot": "·", "amp": "&"}


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def any_word(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(w)})" for w in words) + ")"


def first_rule(col: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN contains({col}, {q(k)}) THEN {q(v)}" for k, v in rules) + " END"


def extract(col: str, pattern: str) -> str:
    return f"NULLIF(regexp_extract({col}, {q(pattern)}, 1), '')"


def dotted(col: str, pattern: str) -> str:
    return f"replace({extract(col, pattern)}, ',', '.')"


def near(col: str, anchors, target: str) -> str:
    return (
        f"regexp_matches({col}, "
        + q(rf"(?:^|[^{WORD}])(?:{'|'.join(anchors)})[^.]{{0,119}}[^.{WORD}]{target}") + ")"
    )


OFFERS = f"""offers AS (
 SELECT *, p_name || ' ' || CAST(price AS VARCHAR) || ' € ' || coalesce(CAST(promo_price AS VARCHAR) || ' € ', '')
   || CAST(p_size AS VARCHAR) || ' ml Teintes : ' || CAST(shade_count AS VARCHAR) AS page_text
 FROM (SELECT l_returnflag AS source, p_name || ' — #' || CAST(p_partkey AS VARCHAR) AS product_name,
  p_brand AS brand, lower(p_type) AS category, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
  CASE WHEN l_discount > 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(3,2)) AS DECIMAL(12,2)) END AS promo_price,
  CASE WHEN p_size % 10 <> 0 THEN CAST(p_size AS DECIMAL(8,2)) END AS volume_ml,
  CASE WHEN l_returnflag <> 'N' THEN CAST(CAST(5 - l_tax * 10 AS DECIMAL(3,1)) AS DECIMAL(6,4)) END AS rating,
  CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS BIGINT) END AS review_count,
  l_linenumber AS shade_count,
  CASE WHEN contains(p_name,'hot') THEN 'Rayonnant' WHEN contains(p_name,'cold') THEN 'mat' WHEN contains(p_name,'blue') THEN 'naturel'
   WHEN contains(p_name,'new') THEN 'satine' WHEN contains(p_name,'old') THEN 'satiné' END AS finish_type,
  CASE WHEN contains(p_name,'ring') THEN 'totale' WHEN contains(p_name,'gear') THEN 'moyenne' WHEN contains(p_name,'bolt') THEN 'légère'
   WHEN contains(p_name,'rod') THEN 'legere' WHEN contains(p_name,'plate') THEN 'modulable' END AS coverage_level,
  NULLIF(concat_ws(' / ', CASE WHEN contains(p_name,'red') OR contains(p_name,'anvil') THEN 'grasse' END,
   CASE WHEN contains(p_name,'blue') OR contains(p_name,'rod') THEN 'sèche' END, CASE WHEN contains(p_name,'small') THEN 'mixte' END,
   CASE WHEN contains(p_name,'gizmo') OR contains(p_name,'widget') THEN 'sensible' END), '') AS skin_type,
  CASE l_linestatus WHEN 'O' THEN 'En stock' ELSE 'Rupture' END AS availability,
  '{BASE}/p/' || CAST(p_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '.html?o=' || CAST(l_orderkey AS VARCHAR) AS source_url,
  p_name, p_size
 FROM lineitem JOIN part ON l_partkey = p_partkey) t)"""

ALL_FIELDS = ", ".join(FIELDS)


def offers(select: str) -> str:
    return f"WITH {OFFERS} {select}"


def mean(col: str) -> str:
    return f"CAST(SUM({col}) AS DOUBLE) / NULLIF(COUNT({col}), 0)"


BENCH = f"""COUNT(*) AS n_products, {mean('price')} AS avg_price,
 CAST(SUM(CASE WHEN volume_ml > 0 THEN CAST(price / volume_ml AS DECIMAL(18,9)) END) AS DOUBLE)
   / NULLIF(COUNT(CASE WHEN volume_ml > 0 THEN price END), 0) AS price_per_ml_mean,
 CAST(SUM(CASE WHEN volume_ml > 0 THEN price END) AS DOUBLE) / CAST(SUM(CASE WHEN volume_ml > 0 THEN volume_ml END) AS DOUBLE) AS price_per_ml_total,
 {mean('shade_count')} AS avg_shades, MAX(shade_count) AS max_shades,
 {mean('rating')} AS avg_rating, {mean('review_count')} AS avg_reviews"""


def mix(col: str) -> str:
    return offers(f"""SELECT brand, {col}, n, CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY brand) AS share
 FROM (SELECT brand, {col}, COUNT(*) AS n FROM offers GROUP BY brand, {col})""")


def ranked(by: str, measure: str, col: str, order: str) -> str:
    return offers(f"""SELECT {by}, {measure}, CAST(RANK() OVER (ORDER BY {measure} {order} NULLS LAST) AS INT) AS rank
 FROM (SELECT {by}, {mean(col)} AS {measure} FROM offers GROUP BY {by})""")


def report(where: str) -> str:
    return offers(f"""SELECT *, CAST(RANK() OVER (ORDER BY avg_list_price DESC NULLS LAST) AS INT) AS price_rank,
 CAST(RANK() OVER (ORDER BY avg_rating DESC NULLS LAST) AS INT) AS rating_rank,
 CAST(RANK() OVER (ORDER BY avg_reviews ASC NULLS LAST) AS INT) AS fewest_reviews_rank
 FROM (SELECT brand, COUNT(*) AS n_products, {mean('list_price')} AS avg_list_price,
 CAST(SUM(CASE WHEN volume_ml > 0 THEN list_price END) AS DOUBLE) / CAST(SUM(CASE WHEN volume_ml > 0 THEN volume_ml END) AS DOUBLE) AS list_price_per_ml,
 MAX(shade_count) AS max_shades, {mean('rating')} AS avg_rating, {mean('review_count')} AS avg_reviews,
 CAST(COUNT(*) FILTER (on_promo) AS DOUBLE) / COUNT(*) AS promo_share FROM ({PRICED}) {where} GROUP BY brand)""")


def gap(col: str) -> str:
    return offers(f"""SELECT brand, b AS brand_value, m AS market_value, b - m AS gap
 FROM (SELECT brand, {mean(col)} AS b FROM offers GROUP BY brand), (SELECT {mean(col)} AS m FROM offers)""")


def completeness() -> str:
    parts = [
        f"""SELECT source, '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_null,
 COUNT(DISTINCT {c}) AS n_distinct, CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value
 FROM offers GROUP BY source"""
        for c in FIELDS
    ]
    return offers(" UNION ALL ".join(parts))


def folded(col: str) -> str:
    plain = f"translate(lower({col}), {q(ACCENTED)}, {q(PLAIN)})"
    return f"replace(replace({plain}, 'œ', 'oe'), 'æ', 'ae')"


def normalised(col: str) -> str:
    return folded(f"trim(regexp_replace({col}, {q(f'[{BLANK}]+')}, ' ', 'g'))")


HARMONISED = f"""harmonised AS (SELECT source,
 CASE {normalised('finish_type')} WHEN 'satine' THEN 'satiné' WHEN 'mat' THEN 'mat' WHEN 'naturel' THEN 'naturel'
  ELSE CASE WHEN finish_type IS NOT NULL THEN 'autre' END END AS finish_type,
 CASE {normalised('coverage_level')} WHEN 'legere' THEN 'légère' WHEN 'totale' THEN 'totale' WHEN 'moyenne' THEN 'moyenne'
  ELSE CASE WHEN coverage_level IS NOT NULL THEN 'autre' END END AS coverage_level,
 CASE {normalised('availability')} WHEN 'en stock' THEN 'en stock' WHEN 'rupture' THEN 'rupture' ELSE 'autre' END AS availability
 FROM offers)"""

PRICED = """SELECT *, greatest(price, promo_price) AS list_price, least(price, promo_price) AS sale_price,
 coalesce(price <> promo_price, false) AS on_promo FROM offers"""

# ---- page text -----------------------------------------------------------------------

_HIDDEN = "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in ("script", "style", "template"))
_TAG = r"""</?[a-z](?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*>"""
_BETWEEN = rf"(?is)(?:{GAP}(?:{_HIDDEN}|<!--.*?(?:-->|\z)|<[!?][^>]*>|{_TAG}))+{GAP}"


def decoded(col: str) -> str:
    """Named references one after the other, the ampersand last."""
    for name in [n for n in ENTITIES if n != "amp"]:
        col = f"replace({col}, {q(f'&{name};')}, {q(ENTITIES[name])})"
    return f"replace(replace({col}, {q('&#39;')}, {q(chr(39))}), '&amp;', '&')"


def visible(col: str) -> str:
    blank = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(133)||chr(160)||chr(8239)||chr(12288)"
    return decoded(f"trim(regexp_replace(replace({col}, '&nbsp;', chr(160)), {q(_BETWEEN)}, ' ', 'g'), {blank})")


LINKS = """links AS (SELECT page_id, CAST(pos - 1 AS INT) AS pos, href FROM (
 SELECT page_id, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS pos
 FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS hrefs FROM pages)) WHERE href <> '')"""

SHOP_WORD = "CASE k % 3 WHEN 0 THEN 'foundation' WHEN 1 THEN 'full-cover' ELSE 'skin-tint' END"
PART = "(SELECT p_partkey AS k, p_size AS s, p_name, p_brand, p_type FROM part)"


def shop_url(path: str = "teint", word: str = SHOP_WORD, code: str = "I") -> str:
    return f"'{BASE}/fr/fr/{path}/' || {word} || '-{code}' || lpad(CAST(k AS VARCHAR), 9, '0') || '.html'"


# Every order lists the page of its customer key first and the missing page fifth; all
# addresses below /teint/ pass without a keyword, /levres/ needs one and has none.
SHOP_LINKS = f"""first_order AS (
 SELECT k, o AS listing_no, CASE st WHEN 'F' THEN 'fond de teint' ELSE 'correcteur' END AS category FROM (
  SELECT o_custkey AS k, o_orderkey AS o, o_orderstatus AS st, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
  FROM orders) WHERE rn = 1),
shop_links AS (
 SELECT 'boutique' AS source, listing_no, 3 AS pos, {shop_url()} AS url, category FROM first_order
 UNION ALL
 SELECT 'boutique', listing_no, 7, '{BASE}/fr/fr/teint/foundation-MI9' || lpad(CAST(k AS VARCHAR), 9, '0') || '.html', category FROM first_order)"""


#: Addresses of the three shops, over k.
CODE = "lpad(CAST(k AS VARCHAR), 9, '0')"
WIDGET_URL = f"'{BASE}/fr/teint/' || {SHOP_WORD} || '/0' || {CODE} || '.html'"
RETAIL_URL = f"'{BASE}/p/' || {SHOP_WORD} || '-P' || k || '.html'"
LISTED = "CASE st WHEN 'F' THEN 'fond de teint' ELSE 'correcteur' END AS category"
# A widget listing keeps an address if it holds one of its words; the first anchor of an article stays.
WIDGET_LINKS = f"""widget_links AS (SELECT 'boutique' AS source, listing_no, 0 AS pos, {WIDGET_URL} AS url, category, k FROM (
  SELECT o_custkey AS k, o_orderkey AS listing_no, o_orderstatus AS st, {LISTED.replace('st', 'o_orderstatus', 1)},
   ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders
  WHERE (o_orderstatus = 'F') = (o_custkey % 3 <> 1)) WHERE rn = 1)"""
RETAIL_LINKS = f"""retail_links AS (SELECT 'boutique' AS source, listing_no, 0 AS pos, {RETAIL_URL} AS url,
  category, k FROM (SELECT o_custkey AS k, o_orderkey AS listing_no, {LISTED.replace('st', 'o_orderstatus', 1)},
   ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1)"""


def record(**fields: str) -> str:
    """Expected product record: typed columns, null where not given."""
    out = []
    for f in CANONICAL.fields:
        kind = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INT"}.get(
            f.dataType.simpleString(), f.dataType.simpleString().upper()
        )
        out.append(f"CAST({fields.pop(f.name, 'NULL')} AS {kind}) AS {f.name}")
    return ", ".join(out + [f"{v} AS {k}" for k, v in fields.items()])


def structured(category: str) -> dict[str, str]:
    return dict(
        product_name="p_name || ' ' || k",
        brand="CASE WHEN v IN (0, 1) THEN p_brand ELSE 'Maison' END",
        category=f"CASE WHEN v IN (1, 2) THEN lower(p_type) ELSE {category} END",
        price="(s + 10) || '.90'",
        promo_price="CASE WHEN v = 5 THEN (s + 5) || '.50' END",
        volume_ml="CASE WHEN s % 2 = 1 THEN s || '' ELSE s || '.5' END",
        rating="CASE v WHEN 0 THEN '4.5' WHEN 1 THEN '5' WHEN 5 THEN NULL ELSE '4.' || (s % 10) END",
        review_count="CASE v WHEN 1 THEN 0 WHEN 5 THEN NULL ELSE s END",
        shade_count="CASE s % 3 WHEN 0 THEN s WHEN 1 THEN 2 + s % 4 END",
        finish_type="CASE s % 4 WHEN 0 THEN 'mat' WHEN 1 THEN 'satine' WHEN 2 THEN 'lumineux' END",
        coverage_level="CASE s % 4 WHEN 0 THEN 'moyenne' WHEN 1 THEN 'modulable' END",
        skin_type="CASE s % 5 WHEN 0 THEN 'grasse / mixte / normale' WHEN 1 THEN 'seche / sensible' WHEN 3 THEN 'tous types' END",
        availability="CASE WHEN v IN (0, 2) THEN 'Rupture' ELSE 'En stock' END",
        source_url=shop_url(),
    )


STRUCTURED_UNIT = dict(
    volume_unit="CASE WHEN s % 2 = 1 THEN 'ml' ELSE 'g' END", in_stock="v NOT IN (0, 2)"
)

WIDGET = dict(
    product_name="CASE WHEN v = 3 THEN '' ELSE p_name || ' ' || k END",
    brand="'Maison'",
    price="CASE WHEN v = 1 THEN (s + 20) || '.90' ELSE (s + 10) || '.90' END",
    promo_price="CASE WHEN v = 1 THEN (s + 10) || '.90' END",
    volume_ml="CASE v WHEN 0 THEN s || '' WHEN 1 THEN s || '' WHEN 2 THEN NULL ELSE s || '.5' END",
    rating="CASE WHEN s % 2 = 0 THEN '4.' || (s % 10) END",
    review_count="CASE WHEN s % 2 = 0 THEN s END",
    shade_count="CASE s % 3 WHEN 0 THEN s WHEN 1 THEN 4 END",
    finish_type="CASE s % 4 WHEN 0 THEN 'Lisse et mat' WHEN 1 THEN 'Rayonnant' END",
    coverage_level="CASE s % 4 WHEN 0 THEN 'Moyenne à haute' WHEN 1 THEN 'Légère' END",
    skin_type="CASE s % 5 WHEN 0 THEN 'grasse / mixte' WHEN 1 THEN 'sèche / sensible' WHEN 2 THEN 'grasse / tous types' END",
    availability="CASE WHEN s % 7 = 0 THEN 'rupture' ELSE 'en stock' END",
    source_url=shop_url(),
    volume_unit="CASE v WHEN 0 THEN 'g' WHEN 2 THEN NULL ELSE 'ml' END",
    in_stock="s % 7 <> 0",
)

RETAIL = dict(
    product_name="CASE v WHEN 2 THEN p_name || k WHEN 4 THEN p_name ELSE p_name || ' ' || k END",
    brand="CASE WHEN v IN (0, 1) THEN p_brand ELSE 'Maison' END",
    category="CASE WHEN s % 2 = 0 THEN p_type END",
    price="CASE WHEN v = 2 THEN (s + 20) || '.90' ELSE (s + 10) || '.90' END",
    promo_price="CASE WHEN v = 2 THEN (s + 10) || '.90' END",
    volume_ml="CASE WHEN s % 3 < 2 THEN s END",
    rating="CASE v WHEN 0 THEN '4.25' WHEN 2 THEN '4.' || (s % 10) END",
    review_count="CASE WHEN v IN (0, 2, 3) THEN s END",
    shade_count="CASE s % 4 WHEN 0 THEN 2 + s % 5 WHEN 1 THEN s END",
    finish_type="CASE v WHEN 0 THEN 'satiné' WHEN 1 THEN 'transparent' WHEN 2 THEN 'mat' END",
    coverage_level="CASE v WHEN 0 THEN 'légère' WHEN 1 THEN 'forte' END",
    skin_type="CASE v WHEN 0 THEN 'sèche' WHEN 1 THEN 'tous types' WHEN 2 THEN 'grasse' END",
    availability="CASE WHEN s % 7 < 2 THEN 'Rupture' ELSE 'En stock' END",
    source_url=shop_url(),
    volume_unit="CASE s % 3 WHEN 0 THEN 'ml' WHEN 1 THEN 'g' END",
    in_stock="s % 7 >= 2",
)


def products(fields: dict[str, str], variants: int) -> str:
    return f"SELECT {record(**fields)} FROM (SELECT *, s % {variants} AS v FROM {PART})"


def web_page_products() -> str:
    named = "(product_name || ' ' || text)"
    number = r"(\d+(?:[.,]\d+)?)"
    # Skin-type rules.
    skin = [
        ("grasse", ("anti-brillance", "matifiant", "controle du sebum", "et grasses", "et grasse"), ("grasse",)),
        ("seche", ("hydratant", "deshydrate", "et seches", "et sèches"), ("seche", "sèche")),
        ("mixte", ("et mixtes", "et mixte"), ("mixte",)), ("normale", ("et normales",), ("normale",)),
        ("sensible", ("sensible",), ()), ("mature", ("mature",), ()),
        ("tous types", ("tous types", "tous les types"), ()),
    ]
    tags = ", ".join(
        f"CASE WHEN {' OR '.join([any_word('low', w)] + [near('low', ('peau', 'peaux'), t) for t in n])} THEN {q(label)} END"
        for label, w, n in skin
    )
    volume = f"coalesce({dotted(named, rf'(?i){number}{GAP}ml(?:[^{WORD}]|$)')}, {dotted(named, rf'{number}{GAP}g(?:[^{WORD}]|$)')})"
    fields = dict(
        product_name="product_name", brand="'Maison'", volume_ml=f"TRY_CAST({volume} AS DECIMAL(8,2))",
        rating=f"TRY_CAST({dotted('text', rf'(\d[.,]\d){GAP}(?:sur|/){GAP}5')} AS DECIMAL(6,4))",
        review_count=f"TRY_CAST({extract('low', rf'(\d+){GAP}(?:avis|reviews?|commentaires?)')} AS BIGINT)",
        shade_count=f"TRY_CAST({extract('low', SHADE_TEXT)} AS INT)",
        finish_type=first_rule("low", STRUCTURED_FINISH),
        coverage_level=first_rule("low", STRUCTURED_COVERAGE),
        skin_type=f"NULLIF(concat_ws(' / ', {tags}), '')",
        availability=f"CASE WHEN {any_word('low', STRUCTURED_OUT)} AND NOT regexp_matches(html, '(?i)ajouter') THEN 'Rupture' ELSE 'En stock' END",
        source_url="url",
    )
    return f"""WITH t AS (SELECT url, html, {visible('html')} AS text,
 trim(regexp_replace({visible("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1', 1)")}, {q(f'[{BLANK}]+')}, ' ', 'g')) AS product_name FROM pages),
 l AS (SELECT *, lower(text) AS low FROM t)
 SELECT {record(**fields)} FROM l WHERE product_name <> ''"""


FEED_BAD = "(s % 10 IN (6, 7, 8, 9))"
FEED = f"""feed AS (SELECT *, 'feed-' || CAST(k // 8 AS VARCHAR) AS feed, CAST(k % 8 + 1 AS INT) AS page FROM {PART}),
 head AS (SELECT *, MIN(CASE WHEN {FEED_BAD} THEN page END) OVER (PARTITION BY feed) AS stop FROM feed ),
 kept AS (SELECT * FROM head WHERE stop IS NULL OR page < stop)"""


def feed_products() -> str:
    title = "p_name || CASE s % 4 WHEN 0 THEN ' Soft Matte Longwear' WHEN 1 THEN ' Powder' WHEN 2 THEN ' Soft''Lit' ELSE ' Stick' END"
    first = dict(
        product_name=title, brand="p_brand", category="CASE WHEN s % 5 > 1 THEN p_type END", price="(s + 10) || '.90'",
        promo_price="CASE WHEN s % 2 = 0 THEN (s + 20) || '.00' END",
        volume_ml="CASE WHEN s % 3 = 0 OR (s % 3 = 1 AND contains(CAST(k AS VARCHAR), '12')) THEN 12 WHEN s % 4 IN (1, 3) THEN 9 ELSE 32 END",
        shade_count="2",
        finish_type="CASE WHEN s % 4 < 2 THEN 'mat' WHEN s % 4 = 2 THEN 'lumineux' ELSE 'naturel' END",
        coverage_level="CASE s % 4 WHEN 0 THEN 'couvrant' WHEN 2 THEN 'moyen' ELSE 'léger' END",
        skin_type="CASE s % 4 WHEN 0 THEN 'grasse' WHEN 2 THEN 'sèche' ELSE 'mixte' END",
        availability="CASE WHEN s % 3 = 0 THEN 'en stock' ELSE 'rupture' END",
        source_url=f"'{BASE}/products/a-' || k",
    )
    second = dict(
        product_name="p_name || ' vide'", brand="p_brand", category="p_type", volume_ml="32", shade_count="0",
        finish_type="'naturel'", coverage_level="'léger'", skin_type="'mixte'", availability="'rupture'",
        source_url=f"'{BASE}/products/b-' || k",
    )
    return f"""WITH {FEED} SELECT feed AS source, {record(**first)} FROM kept WHERE s % 5 <> 0
 UNION ALL SELECT feed AS source, {record(**second)} FROM kept"""


def shop_catalogue(select: str = f"source, {ALL_FIELDS}", tail: str = "") -> str:
    fields = record(**{**structured("listed"), "source_url": "url"})
    return f"""WITH {SHOP_LINKS}, joined AS (SELECT l.source, l.url, l.category AS listed, p.*, s % 6 AS v
 FROM (SELECT * FROM shop_links {tail}) l JOIN {PART} p ON l.url = {shop_url()} WHERE k % 17 <> 0) SELECT {select} FROM (SELECT source, {fields} FROM joined)"""


def other_shop(kind: str) -> str:
    """Records of the widget or the retail shop, with ``source`` and ``volume_unit``."""
    fields, links, variants = {"widget": (WIDGET, "widget_links", 5), "retail": (RETAIL, "retail_links", 5)}[kind]
    own = {k: v for k, v in fields.items() if k != "in_stock"}
    own["category"] = "CASE WHEN s % 2 = 0 AND k % 17 <> 0 THEN p_type ELSE listed END" if kind == "retail" else "listed"
    own["source_url"] = "url"
    if kind == "retail":
        where = "WHERE k % 17 <> 0"
    else:  # a page without a name stays, with next to nothing on it
        blank = {"product_name": "''", "price": "'9.99'", "availability": "'en stock'"}
        kept = ("brand", "category", "source_url")
        own = {c: x if c in kept else f"CASE WHEN k % 17 = 0 THEN {blank.get(c, 'NULL')} ELSE {x} END" for c, x in own.items()}
        where = ""
    return f"""SELECT source, {record(**own)} FROM (SELECT l.source, l.url, l.category AS listed, p.*, s % {variants} AS v
 FROM {links} l JOIN {PART} p ON p.k = l.k) {where}"""


def common(col: str, labels: dict[str, list[str]]) -> str:
    """The common label of a column, on the SQL's own account."""
    key = folded(f"trim({col})")
    rules = " ".join(f"WHEN {key} IN ({', '.join(q(x) for x in names)}) THEN {q(label)}" for label, names in labels.items())
    return f"CASE WHEN coalesce(trim({col}), '') = '' THEN NULL {rules} ELSE 'autre' END"


FINISHES = {"mat": ["mat", "lisse et mat"], "naturel": ["naturel"], "satiné": ["satine"], "irisé": ["irise"],
            "lumineux": ["lumineux", "rayonnant"], "transparent": ["transparent"]}
COVERAGES = {"légère": ["legere", "leger"], "moyenne": ["moyenne", "moyen"], "moyenne à haute": ["moyenne a haute"],
             "modulable": ["modulable"], "totale": ["totale", "couvrant", "forte"]}


def all_shops() -> str:
    """The master table of the four shops: structured, widget and retail pages, and the feed."""
    unit = "CASE WHEN s % 2 = 1 THEN 'ml' ELSE 'g' END"
    first = record(**{**structured("listed"), "source_url": "url", "volume_unit": unit})
    feed = feed_products().removeprefix(f"WITH {FEED} ")
    return f"""WITH {SHOP_LINKS}, {WIDGET_LINKS}, {RETAIL_LINKS}, {FEED}, master AS (
 SELECT 'structured' AS source, {ALL_FIELDS}, volume_unit FROM (SELECT {first} FROM (SELECT l.url, l.category AS listed, p.*, s % 6 AS v
  FROM shop_links l JOIN {PART} p ON l.url = {shop_url()} WHERE k % 17 <> 0))
 UNION ALL SELECT 'widget', {ALL_FIELDS}, volume_unit FROM ({other_shop('widget')})
 UNION ALL SELECT 'retail', {ALL_FIELDS}, volume_unit FROM ({other_shop('retail')})
 UNION ALL SELECT 'feed', {ALL_FIELDS}, 'ml' FROM ({feed}))"""


def all_shops_report() -> str:
    priced = """SELECT *, greatest(price, promo_price) AS list_price, coalesce(price <> promo_price, false) AS on_promo,
 CASE WHEN brand IN ('Brand#1', 'Brand#2') THEN 'Groupe' ELSE brand END AS brand_group FROM master"""
    return f"""{all_shops()} SELECT *, CAST(RANK() OVER (ORDER BY avg_list_price DESC NULLS LAST) AS INT) AS price_rank,
 CAST(RANK() OVER (ORDER BY avg_rating DESC NULLS LAST) AS INT) AS rating_rank,
 CAST(RANK() OVER (ORDER BY avg_reviews ASC NULLS LAST) AS INT) AS fewest_reviews_rank
 FROM (SELECT brand_group, COUNT(*) AS n_products, {mean('list_price')} AS avg_list_price,
 CAST(SUM(CASE WHEN volume_ml > 0 THEN list_price END) AS DOUBLE) / CAST(SUM(CASE WHEN volume_ml > 0 AND list_price IS NOT NULL THEN volume_ml END) AS DOUBLE) AS list_price_per_ml,
 MAX(shade_count) AS max_shades, {mean('rating')} AS avg_rating, {mean('review_count')} AS avg_reviews,
 CAST(COUNT(*) FILTER (on_promo) AS DOUBLE) / COUNT(*) AS promo_share,
 CAST(SUM(CASE WHEN volume_ml > 0 AND volume_unit = 'ml' THEN list_price END) AS DOUBLE)
  / CAST(SUM(CASE WHEN volume_ml > 0 AND volume_unit = 'ml' AND list_price IS NOT NULL THEN volume_ml END) AS DOUBLE) AS list_price_per_ml_only
 FROM ({priced}) GROUP BY brand_group)"""


def all_sql() -> dict[str, str]:
    web_listing = "regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1)"
    number = r"(\d+(?:[.,]\d+)?)"
    whole_word = lambda w: q(rf"(?:^|[^{WORD}]){w}(?:[^{WORD}]|$)")
    doc_rules = [("the", "anglais"), ("nicht", "allemand"), ("para", "espagnol"), ("que", "français")]
    doc_tags = (
        f"CASE WHEN {any_word('low', ('http', 'email'))} OR {any_word('low', ('license', 'copyright'))} THEN 'cote' END, "
        f"CASE WHEN {near('low', ('de', 'the'), 'que')} THEN 'proche' END, "
        f"CASE WHEN {any_word('low', '123')} THEN 'nombre' END"
    )
    # Tags keep the order of the first rule that sets them.
    late = f"NOT {any_word('low', ('http', 'email'))} AND {any_word('low', ('license', 'copyright'))}"
    doc_tags_late = (
        f"CASE WHEN {near('low', ('de', 'the'), 'que')} THEN 'proche' END, "
        f"CASE WHEN {any_word('low', '123')} THEN 'nombre' END, 'cote'"
    )
    syllables = ("th", "on", "er", "an", "re", "es", "nd", "ti", "eau", "que")
    many = [(a + b + c, f"g{i % 37}") for i, (c, b, a) in enumerate(product(syllables, repeat=3))]
    skin_rows = "unnest(string_split(skin_type, ' / '))"
    order_cols = "source, source_url, shade_count, price, promo_price, rating, review_count"
    null_first = ", ".join(f"{c} NULLS FIRST" for c in order_cols.split(", "))
    sql = {
        "brand_report": report(""),
        "brand_report_promo": report("WHERE category = 'promo'"),
        "master_union": offers(f"SELECT source, {ALL_FIELDS} FROM offers"),
        "master_rows": offers("SELECT COUNT(*) AS n_products FROM offers"),
        "numbered_rows": offers(f"SELECT ROW_NUMBER() OVER (ORDER BY {null_first}) - 1 AS row_no, {order_cols} FROM offers"),
        "record_with_defaults": "SELECT 'parts' AS source, " + record(
            product_name="p_name", brand="CASE WHEN p_size % 3 = 0 THEN 'Maison' ELSE p_brand END", category="lower(p_type)",
            price="p_size || '.5'", shade_count="CASE WHEN p_size % 2 = 1 THEN 12 END", availability="'En stock'",
            source_url="'p/' || p_partkey",
        ) + " FROM part",
        "csv_round_trip": offers(f"SELECT source, {ALL_FIELDS} FROM offers"),
        "brand_benchmark": offers(f"SELECT brand, {BENCH} FROM offers GROUP BY brand"),
        "brand_benchmark_category": offers(f"SELECT brand, {BENCH} FROM offers WHERE category = 'promo' GROUP BY brand"),
        "count_by_category": offers("SELECT category, COUNT(*) AS n FROM offers GROUP BY category ORDER BY category"),
        "category_split": offers("SELECT COUNT(*) FILTER (category = 'promo') AS n_0, COUNT(*) FILTER (category = 'standard') AS n_1 FROM offers"),
        "finish_mix": mix("finish_type"),
        "finish_table": offers("""SELECT brand, COUNT(*) FILTER (finish_type = 'mat') AS mat, COUNT(*) FILTER (finish_type = 'naturel') AS naturel,
 COUNT(*) FILTER (finish_type = 'satine') AS satine, COUNT(*) FILTER (coalesce(finish_type, '') NOT IN ('mat', 'naturel', 'satine')) AS autre
 FROM offers GROUP BY brand"""),
        "coverage_mix": mix("coverage_level"),
        "skin_mix": offers(f"SELECT brand, tag, COUNT(*) AS n FROM (SELECT brand, {skin_rows} AS tag FROM offers) GROUP BY brand, tag"),
        "family_rollup": offers("""SELECT brand, p_name AS family, COUNT(*) AS n_rows, COUNT(DISTINCT product_name) AS n_shades,
 MIN(price) AS min_price, MAX(price) AS max_price FROM offers GROUP BY brand, p_name"""),
        "availability_rate": offers("""SELECT brand, COUNT(*) AS n_products,
 CAST(COUNT(*) FILTER (availability = 'En stock') AS DOUBLE) / COUNT(*) AS availability_rate FROM offers GROUP BY brand"""),
        "promo_depth": offers(f"""SELECT brand, COUNT(*) AS n_products, COUNT(*) FILTER (on_promo) AS n_promo,
 CAST(COUNT(*) FILTER (on_promo) AS DOUBLE) / COUNT(*) AS promo_share,
 CAST(SUM(CASE WHEN on_promo THEN 1 - CAST(sale_price / list_price AS DECIMAL(18,9)) END) AS DOUBLE) / NULLIF(COUNT(*) FILTER (on_promo), 0) AS avg_discount
 FROM ({PRICED}) GROUP BY brand"""),
        "completeness": completeness(),
        "csv_rejected_rows": offers("""SELECT source, COUNT(*) FILTER (shade_count NOT IN (6, 7)) AS n_good,
 COUNT(*) FILTER (shade_count IN (6, 7)) AS n_rejected FROM offers GROUP BY source"""),
        "rank_products": ranked("product_name", "avg_price", "price", "DESC"),
        "rank_shade_counts": offers("""SELECT product_name, max_shades, CAST(RANK() OVER (ORDER BY max_shades NULLS LAST) AS INT) AS rank
 FROM (SELECT product_name, MAX(shade_count) AS max_shades FROM offers GROUP BY product_name)"""),
        "document_first_of_many": f"SELECT doc_id, {first_rule('low', many)} AS first_rule FROM (SELECT doc_id, lower(text) AS low FROM documents)",
        "rank_price": ranked("brand", "avg_price", "price", "DESC"),
        "rank_reviews": ranked("brand", "avg_reviews", "review_count", "ASC"),
        "rank_rating_by_shop": ranked("source", "avg_rating", "rating", "DESC"),
        "market_gap_price": gap("price"),
        "market_gap_rating": gap("rating"),
        "harmonised_labels": f"""WITH {OFFERS}, {HARMONISED} SELECT source, finish_type, coverage_level, availability, COUNT(*) AS n
 FROM harmonised GROUP BY ALL""",
        "unmapped_labels": f"""WITH {OFFERS}, {HARMONISED}
 SELECT 'finish_type' AS field, COUNT(*) FILTER (finish_type = 'autre') AS n_unmapped FROM harmonised
 UNION ALL SELECT 'coverage_level', COUNT(*) FILTER (coverage_level = 'autre') FROM harmonised
 UNION ALL SELECT 'availability', COUNT(*) FILTER (availability = 'autre') FROM harmonised""",
        "brand_groups": offers(f"""SELECT brand_group, {BENCH} FROM (SELECT o.*, coalesce('Groupe ' || n_regionkey, brand) AS brand_group
 FROM offers o LEFT JOIN nation ON brand = 'Brand#' || n_nationkey AND n_nationkey <> 7) GROUP BY brand_group"""),
        "price_direction": offers(f"SELECT source_url, price, promo_price, list_price, sale_price, on_promo FROM ({PRICED})"),
        "families": offers("""SELECT p_name AS family, substr(product_name, length(p_name) + 4) AS shade, COUNT(*) AS n
 FROM offers GROUP BY p_name, product_name"""),
        "normalised_text": f"SELECT doc_id, md5(t) AS text_key, length(t) AS n_chars_key FROM (SELECT doc_id, {normalised('text')} AS t FROM documents)",
        "page_links": f"WITH {LINKS} SELECT page_id, pos, href FROM links",
        "page_links_resolved": f"""WITH {LINKS} SELECT page_id, pos, url, substr(regexp_extract(url, '([^/]*)$', 1), 1, 60) AS slug FROM (
 SELECT page_id, pos, regexp_replace(CASE WHEN starts_with(href, '/') THEN base || href WHEN starts_with(href, 'http') THEN href END, '\\?.*', '', 'g') AS url
 FROM links JOIN (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS base FROM pages) USING (page_id))""",
        "page_slugs": """SELECT page_id, regexp_replace(url, '\\?.*', '', 'g') AS url, substr(regexp_extract(url, '([^/]*)$', 1), 1, 60) AS last_part,
 substr(CASE WHEN contains(url, '/fr/') THEN regexp_extract(url, '^.*/fr/(.*)$', 1) ELSE url END, 1, 50) AS locale_part, right(url, 40) AS product_part FROM pages""",
        "offer_slugs": offers("SELECT regexp_extract(source_url, '/p/(.*)$', 1) AS slug, COUNT(*) AS n FROM offers GROUP BY 1"),
        "keyword_gate_pages": """SELECT page_id, url FROM pages WHERE NOT (contains(lower(url), 'casino') OR contains(lower(url), '+'))
 AND (contains(lower(url), 'blog') OR contains(lower(url), 'www') OR contains(lower(url), '/fr/'))""",
        "keyword_gate_rows": f"""SELECT page_id, url FROM pages WHERE NOT {any_word('lower(url)', STRUCTURED_EXCLUDED)}
 AND (page_id % 2 = 1 OR contains(lower(url), 'blog') OR contains(lower(url), '/en/') OR contains(lower(url), '/teint/'))""",
        "keyword_gate_parts": "SELECT p_partkey, p_name FROM part WHERE (p_name LIKE '%red%' OR p_name LIKE '%blue%') AND p_name NOT LIKE '%rod%'",
        "pattern_gate_pages": r"SELECT page_id, url FROM pages WHERE contains(url, 'example.com/') AND regexp_matches(url, '/\d{3,}\.html(?:\?|$)') AND suffix(url, '.html')",
        "first_seen_links": f"""WITH {LINKS} SELECT href, page_id, pos FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY href ORDER BY page_id, pos) AS rn FROM links) WHERE rn = 1""",
        "first_seen_in_page": f"WITH {LINKS} SELECT page_id, href, MIN(pos) AS pos FROM links GROUP BY page_id, href",
        "first_seen_article": offers(r"""SELECT source, source_url, price, shade_count, promo_price, article FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY article ORDER BY source_url, source, shade_count, price, promo_price NULLS FIRST) AS rn
 FROM (SELECT *, coalesce(NULLIF(regexp_extract(source_url, '/p/(\d+)-', 1), ''), source_url) AS article FROM offers)) WHERE rn = 1"""),
        "listing_join": f"""WITH {LINKS} SELECT 'web' AS source, {web_listing} AS category, COUNT(*) AS n_links, COUNT(DISTINCT href) AS n_hrefs
 FROM links JOIN pages USING (page_id) GROUP BY 2""",
        "shop_links": f"WITH {SHOP_LINKS} SELECT source, listing_no, pos, url, category FROM shop_links",
        "shop_links_with_page": f"""WITH {SHOP_LINKS} SELECT source, listing_no, pos, url, category,
 CASE WHEN CAST(regexp_extract(url, '-I(\\d+)', 1) AS BIGINT) % 17 = 0 THEN '' ELSE 'Boutique' END AS title FROM shop_links
 WHERE url IN (SELECT {shop_url()} FROM {PART})""",
        "shop_frontier": f"WITH {SHOP_LINKS} SELECT source, listing_no, pos, url, category FROM shop_links WHERE url NOT IN (SELECT {shop_url()} FROM {PART})",
        "first_links": f"WITH {LINKS} SELECT page_id, pos, href FROM links ORDER BY page_id, pos LIMIT 100",
        "visible_text": f"""SELECT page_id, md5(t) AS text_key, md5(lower(t)) AS lower_key, length(t) AS n_chars FROM (SELECT page_id, {visible('html')} AS t FROM pages)""",
        "document_first_match": f"""SELECT doc_id, {first_rule('low', doc_rules)} AS first_rule,
 CASE {' '.join(f"WHEN regexp_matches(low, {whole_word(k)}) THEN {q(v)}" for k, v in doc_rules)} END AS first_word,
 {first_rule('head', doc_rules)} AS first_plain FROM (SELECT doc_id, lower(text) AS low, {folded('lower(text)')} AS head FROM documents)""",
        "document_tags": f"""SELECT doc_id, tags, CASE WHEN tags = '' THEN 0 ELSE len(string_split(tags, ' / ')) END AS n_tags FROM (
 SELECT doc_id, CASE WHEN {late} THEN concat_ws(' / ', {doc_tags_late}) ELSE concat_ws(' / ', {doc_tags}) END AS tags
 FROM (SELECT doc_id, lower(text) AS low FROM documents))""",
        "document_numbers": f"""SELECT doc_id, TRY_CAST({dotted('text', rf'(\d[.,]\d){GAP}(?:sur|/){GAP}5')} AS DECIMAL(6,4)) AS rating,
 TRY_CAST({dotted('lower(text)', rf'(\d+){GAP}(?:avis|reviews?|commentaires?|the|de|en)')} AS BIGINT) AS reviews,
 CAST(coalesce(ml, g) AS DECIMAL(8,2)) AS volume,
 CASE WHEN ml IS NOT NULL THEN 'ml' WHEN g IS NOT NULL THEN 'g' END AS unit FROM (SELECT doc_id, text,
 {dotted('text', rf'(?i){number}{GAP}ml')} AS ml, {dotted('text', rf'{number}{GAP}g(?:[^{WORD}]|$)')} AS g FROM documents)""",
        "stored_page_shades": f"""SELECT {shop_url()} AS source_url, CAST(CASE WHEN s % 3 = 0 THEN s
  WHEN s % 3 = 1 AND 2 + s % 4 BETWEEN 3 AND 4 THEN 2 + s % 4 END AS INT) AS shade_count FROM {PART}""",
        "offer_prices": offers("""SELECT source_url, price, CASE WHEN n > 0 THEN hi END AS high, CASE WHEN n > 1 THEN lo END AS low, n AS n_prices FROM (
 SELECT *, CASE WHEN a AND b AND price <> promo_price THEN 2 WHEN a OR b THEN 1 ELSE 0 END AS n,
  CASE WHEN a THEN price ELSE promo_price END AS hi, promo_price AS lo FROM (
  SELECT *, price > 1 AND price < 50000 AS a, coalesce(promo_price > 1 AND promo_price < 50000, false) AS b FROM offers))"""),
        "offer_text_fields": offers("""SELECT CAST(p_size AS DECIMAL(8,2)) AS volume, 'ml' AS unit, shade_count AS shades, COUNT(*) AS n
 FROM offers GROUP BY p_size, shade_count"""),
        "ld_blocks": f"""SELECT {shop_url()} AS url, CAST(n AS INT) AS block_no, CASE WHEN (v IN (1, 5) AND n = 0) THEN 'BreadcrumbList' ELSE 'Product' END AS type
 FROM (SELECT *, s % 6 AS v FROM {PART}), (VALUES (0), (1)) b(n) WHERE (v IN (0, 4) AND n = 0) OR v IN (1, 5)""",
        "ld_blocks_unlisted": f"""SELECT type, COUNT(*) AS n FROM (SELECT s % 6 AS v FROM {PART}), (VALUES ('Product'), ('BreadcrumbList')) t(type)
 WHERE (v IN (0, 4) AND type = 'Product') OR v = 5 GROUP BY type""",
        "ld_first_product": f"""SELECT {shop_url()} AS url, CASE v WHEN 0 THEN ' ' || p_name || '  ' || k WHEN 4 THEN '' ELSE p_name || ' ' || k END AS name
 FROM (SELECT *, s % 6 AS v FROM {PART}) WHERE v IN (0, 1, 4, 5)""",
        "ld_last_crumb": f"""SELECT {shop_url()} AS url, CASE v WHEN 0 THEN 'Teint' WHEN 1 THEN p_name || ' ' || k ELSE 'in a list' END AS name
 FROM (SELECT *, s % 5 AS v FROM {PART}) WHERE v < 3""",
        "products_structured": products({**structured("NULL"), **STRUCTURED_UNIT}, 6),
        "products_widget": products(WIDGET, 5),
        "products_retail": products(RETAIL, 5),
        "web_page_products": web_page_products(),
        "shop_catalogue": shop_catalogue(),
        "shop_catalogue_limited": shop_catalogue(
            "source, source_url, product_name, category, price", "ORDER BY listing_no, pos LIMIT 50"
        ),
        "shop_links_widget": f"WITH {WIDGET_LINKS} SELECT source, listing_no, pos, url, category FROM widget_links",
        "shop_links_retail": f"""WITH {RETAIL_LINKS} SELECT source, listing_no, pos, url, category FROM retail_links""",
        "shop_catalogue_widget": f"WITH {WIDGET_LINKS} SELECT source, {ALL_FIELDS} FROM ({other_shop('widget')})",
        "shop_catalogue_retail": f"WITH {RETAIL_LINKS} SELECT source, {ALL_FIELDS} FROM ({other_shop('retail')})",
        "all_shops_report": all_shops_report(),
        "all_shops_labels": f"""{all_shops()} SELECT source, {common('finish_type', FINISHES)} AS finish_type,
 {common('coverage_level', COVERAGES)} AS coverage_level, CASE lower(availability) WHEN 'en stock' THEN 'en stock' ELSE 'rupture' END AS availability, COUNT(*) AS n
 FROM master GROUP BY ALL""",
        "feed_read": f"WITH {FEED} SELECT feed, page, 2 AS n_products FROM kept",
        "feed_products": feed_products(),
    }
    # The same result, another way.
    return sql | {"harmonised_from_table": sql["harmonised_labels"], "shop_links_with_page_store": sql["shop_links_with_page"]}
