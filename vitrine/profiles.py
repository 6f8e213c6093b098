"""How each kind of shop page is read: word lists, patterns and fallback orders.

Three page kinds are known. ``STRUCTURED`` pages carry JSON-LD and win from it;
``WIDGET`` pages show their facts in a product box and a review widget; ``RETAIL``
pages belong to a shop that sells many brands. Shop names, addresses and brand
defaults are parameters of the caller.
"""

from __future__ import annotations

from dataclasses import dataclass

from vitrine.functions.html import Selector, any_of, equals, has, lacks, tag, word
from vitrine.functions.numbers import ANY_PRICE, CENT_PRICE
from vitrine.functions.rules import Tag
from vitrine.functions.text import BLANK, GAP, WORD


@dataclass(frozen=True)
class LinkRules:
    """Which anchors of a listing page lead to products."""

    pattern: str | None = None          # regex on the resolved address
    suffix: str | None = None           # end of the raw href
    exclude: tuple[str, ...] = ()       # words no product address may hold
    allow: str | None = None            # passes without a listing keyword
    article: str | None = None          # article code inside the address
    anchors: tuple[tuple[Selector | None, Selector], ...] = ()  # (zone, anchor), first that finds any
    fallback: str | None = None         # href pattern when no selector finds any


@dataclass(frozen=True)
class Profile:
    """Where a page kind keeps each field, in fallback order.

    The windows are numbers of characters that are looked at from the start of the text; None looks at all of it.
    Shade counts taken from the markup count from ``least_shades`` up to ``most_shades``.
    """

    name: tuple[str, ...]
    title_cut: str
    price: str
    price_zone: Selector
    price_pattern: str
    price_range: tuple[float | None, float | None]
    price_window: int | None
    volume_zone: Selector | str | None
    volume_window: int | None
    stock: str
    rating: tuple[tuple[str, str | Selector], ...]  # (where, pattern or selector)
    reviews: tuple[tuple[str, str | Selector], ...]
    shades: tuple[str, ...]
    swatches: Selector | None
    skin: tuple[Tag, ...]
    swatch_items: tuple[tuple[Selector, Selector], ...] = ()  # (zone, item)
    finish: tuple[tuple[str, str], ...] = ()
    finish_window: int | None = None
    finish_label: str | None = None
    coverage: tuple[tuple[str, str], ...] = ()
    coverage_window: int | None = None
    out_window: int | None = None
    least_shades: int = 2
    most_shades: int | None = None
    coverage_label: str | None = None
    out_phrases: tuple[str, ...] = ()
    category: str | None = None
    ld_brand: bool = True
    flatten_lists: bool = False
    collapse_name: bool = False
    name_required: bool = True
    volume_any_case: bool = True
    ml_ends_word: bool = False
    g_ends: str = f"(?![{WORD}])"
    in_stock_label: str = "En stock"
    out_label: str = "Rupture"
    links: LinkRules = LinkRules()


# ---- Fixed values: keywords of the listing pages, by page kind and category ----
LISTING_KEYWORDS = {
    "structured": {
        "fond de teint": [
            "fond-de-teint", "foundation", "skin-tint",
            "hd-skin", "matte-velvet", "reboot", "watertone",
            "ultra-hd",
        ],
        "correcteur": [
            "concealer", "correcteur", "anti-cernes",
            "underpainting", "full-cover",
        ],
    },
    "widget": {
        "fond de teint": ["foundation", "tinted"],
        "correcteur": ["concealer", "brightener", "corrector"],
    },
    "retail": {},
}

# ---- Fixed values: words that rule a product address out -----------------------
STRUCTURED_EXCLUDED = (
    "pinceau", "brush", "eponge", "sponge",
    "kits-maquillage", "/kits-", "+",
    "palettes-teint", "palettes-maquillage",
    "demaquillant", "fixateur",
)
WIDGET_EXCLUDED = (
    "pump", "pompe", "brush", "pinceau",
    "bundle", "duo", "coffret",
    "lip", "balm",
)

# ---- Fixed values: finish and coverage rules, first hit wins --------------------
STRUCTURED_FINISH = (
    ("semi-mat", "satine"), ("semi mat", "satine"),
    ("matifiant", "mat"), ("fini mat", "mat"), ("matte", "mat"), (" mat ", "mat"),
    ("satine", "satine"), ("satin", "satine"), ("irise", "irise"),
    ("lumineux", "lumineux"), ("radieux", "lumineux"), ("glow", "lumineux"), ("eclat", "lumineux"),
    ("naturel", "naturel"),
)
STRUCTURED_COVERAGE = (
    ("couvrance totale", "totale"), ("couvrance complete", "totale"),
    ("haute couvrance", "totale"), ("couvrance haute", "totale"),
    ("moyenne a haute", "moyenne a haute"), ("moyenne à haute", "moyenne a haute"),
    ("couvrance moyenne", "moyenne"), ("couvrance modulable", "modulable"),
    ("couvrance legere", "legere"), ("couvrance naturelle", "legere"),
)
RETAIL_FINISH = (
    ("mat", "mat"), ("matte", "mat"), ("satiné", "satiné"), ("satin", "satiné"),
    ("lumineux", "lumineux"), ("radieux", "lumineux"), ("glow", "lumineux"),
    ("naturel", "naturel"), ("transparent", "transparent"),
)
RETAIL_COVERAGE = (
    ("couvrance totale", "totale"), ("couvrance complète", "totale"), ("couvrance forte", "totale"),
    ("couvrance moyenne", "moyenne"), ("couvrance modulable", "modulable"),
    ("couvrance légère", "légère"), ("couvrance naturelle", "légère"), ("bonne couvrance", "forte"),
)

# ---- Fixed values: labelled finish and coverage, and shade names ---------------
WIDGET_FINISH_LABEL = rf"Fini[{BLANK}]+([A-ZÀ-Ÿ][a-zà-ÿ{BLANK},]+?)(?:[{BLANK}]+Couvrance|[{BLANK}]{{2,}})"
WIDGET_COVERAGE_LABEL = (
    rf"Couvrance[{BLANK}]+([A-ZÀ-Ÿ][a-zà-ÿ{BLANK},]+?)"
    rf"(?:[{BLANK}]+Bénéfice|[{BLANK}]+Teinte|[{BLANK}]+Ajouter|[{BLANK}]+Livraison|[{BLANK}]{{2,}})"
)
SHADE_LABEL = rf"Teintes{GAP}:{GAP}(\d+)"
SHADE_NAME = rf"[A-Z][a-zà-ÿ ]+[{BLANK}]+[LMD]\d"
SHADE_TEXT = rf"(\d+){GAP}teinte"

# ---- Fixed values: skin-type rules, every hit counts ----------------------------
SKIN_ANCHORS = ("peau", "peaux")
STRUCTURED_SKIN = (
    Tag("grasse", ("anti-brillance", "matifiant", "controle du sebum", "et grasses", "et grasse"), ("grasse",)),
    Tag("seche", ("hydratant", "deshydrate", "et seches", "et sèches"), ("seche", "sèche")),
    Tag("mixte", ("et mixtes", "et mixte"), ("mixte",)),
    Tag("normale", ("et normales",), ("normale",)),
    Tag("sensible", ("sensible",)),
    Tag("mature", ("mature",)),
    Tag("tous types", ("tous types", "tous les types")),
)
WIDGET_SKIN = (
    Tag("grasse", ("peau grasse", "contrôle du sébum", "anti-brillance", "sans huile")),
    Tag("sèche", ("peau sèche", "hydratant", "hydrate")),
    Tag("mixte", ("mixte",)),
    Tag("tous types", ("tous types", "tous les types")),
    Tag("sensible", ("sensible",)),
)
RETAIL_SKIN = (
    Tag("grasse", ("peau grasse", "anti-brillance", "contrôle du sébum")),
    Tag("sèche", ("peau sèche", "hydratant", "nourri")),
    Tag("mixte", ("mixte",)),
    Tag("tous types", ("tous types", "tous les types", "peau normale")),
    Tag("sensible", ("sensible",)),
)

# ---- Fixed values: phrases of products that cannot be bought --------------------
STRUCTURED_OUT = (
    "ce produit n'est plus disponible",
    "m'informer du retour en stock",
    "rupture de stock",
    "indisponible",
)
RETAIL_OUT = ("rupture", "out of stock", "indisponible", "sold out")

# ---- Fixed values: feed rules --------------------------------------------------
FEED_BLOCKED_TYPES = ("Makeup Sponges", "Makeup Brushes", "Bundle Builder")

# ---- Fixed values: selectors, address patterns and fallback orders of the page kinds ----
_SWATCH = (has("class", "swatch"), lacks("class", "size"))

STRUCTURED = Profile(
    name=("ld_product", "h1", "title"),
    title_cut="[-|]",
    collapse_name=True,
    flatten_lists=True,
    category="structured",
    price="zone_over_ld",
    price_zone=any_of(
        tag(word("class", "price")), tag(word("class", "product-price")),
        tag(has("class", "price-wrapper")), tag(has("class", "product-tile-price")),
    ),
    price_pattern=ANY_PRICE,
    price_range=(1, 500),
    price_window=None,
    volume_zone=None,
    volume_window=None,
    ml_ends_word=True,
    stock="structured",
    out_phrases=STRUCTURED_OUT,
    rating=(("ld", ""), ("text", rf"(\d[.,]\d){GAP}(?:sur|/){GAP}5")),
    reviews=(("ld", ""), ("lower", rf"(\d+){GAP}(?:avis|reviews?|commentaires?)")),
    shades=("text", "swatches"),
    swatches=any_of(tag(*_SWATCH)),
    # An item that is a swatch itself has been counted already.
    swatch_items=(
        (any_of(tag(has("data-attr", "color"))), any_of(tag(name="button", except_all=_SWATCH))),
        (any_of(tag(has("class", "color"), name="ul")), any_of(tag(name="li", except_all=_SWATCH))),
    ),
    finish=STRUCTURED_FINISH,
    coverage=STRUCTURED_COVERAGE,
    skin=STRUCTURED_SKIN,
    links=LinkRules(
        pattern=r"-M?I\d{5,}\.html(?:\?|$)", exclude=STRUCTURED_EXCLUDED, allow="/teint/",
    ),
)

WIDGET = Profile(
    name=("ld_last_crumb", "title"),
    title_cut=r"\|",
    price="zone_then_meta",
    price_zone=any_of(tag(word("class", "product-info-content"))),
    price_pattern=CENT_PRICE,
    price_range=(None, None),
    price_window=None,
    volume_zone="price",
    volume_window=None,
    volume_any_case=False,
    g_ends=rf"(?:[{BLANK}]|$)",
    stock="meta",
    in_stock_label="en stock",
    out_label="rupture",
    rating=(("zone", any_of(tag(word("class", "bv_avgRating_component_container"), name="div"))),),
    reviews=(("zone", any_of(tag(word("class", "bv_numReviews_text"), name="div"))),),
    finish_label=WIDGET_FINISH_LABEL,
    coverage_label=WIDGET_COVERAGE_LABEL,
    shades=("label", "names"),
    swatches=None,
    least_shades=4,
    skin=WIDGET_SKIN,
    ld_brand=False,
    name_required=False,
    links=LinkRules(
        suffix=".html", exclude=WIDGET_EXCLUDED, article=r"/(999\w+|0\d{9,})\.html",
    ),
)

RETAIL = Profile(
    name=("ld_first_named", "h1_ranked", "title"),
    title_cut="[-|]",
    category="retail",
    price="ld_then_zone",
    price_zone=any_of(
        tag(has("class", "product-price")), tag(has("class", "Price")),
        tag(equals("data-at", "price")), tag(has("class", "price-box")),
    ),
    price_pattern=CENT_PRICE,
    price_range=(1, 500),
    price_window=None,
    volume_zone=any_of(
        tag(has("class", "product-format")), tag(has("class", "size")),
        tag(equals("data-at", "product_format")),
    ),
    volume_window=None,
    stock="retail",
    out_phrases=RETAIL_OUT,
    rating=(
        ("ld", ""),
        ("zone", any_of(
            tag(has("aria-label", "toile")), tag(has("class", "rating-value")),
            tag(equals("data-at", "rating_value")),
        )),
    ),
    reviews=(
        ("ld", ""),
        ("zone", any_of(
            tag(equals("data-at", "reviews_count")), tag(has("class", "review-count")),
            tag(has("class", "reviews-nb")),
        )),
        ("lower", rf"(\d+){GAP}avis"),
    ),
    shades=("swatches", "text"),
    swatches=any_of(
        tag(equals("data-at", "color_swatch")), tag(has("class", "shade-swatch")),
        tag(has("class", "color-option")), tag(has("aria-label", "teinte"), name="button"),
        tag(has("class", "Swatch")),
    ),
    finish=RETAIL_FINISH,
    coverage=RETAIL_COVERAGE,
    skin=RETAIL_SKIN,
    links=LinkRules(
        anchors=(
            (None, any_of(tag(equals("data-at", "product_name"), name="a"))),
            (None, any_of(tag(has("class", "product-item-link"), name="a"))),
            (None, any_of(tag(has("class", "ProductCard"), name="a"))),
            (any_of(tag(has("class", "product-card"), name="div")), any_of(tag(has("href", "/p/"), name="a"))),
            (any_of(tag(name="article")), any_of(tag(has("href", "/p/"), name="a"))),
        ),
        fallback=r"/p/[a-z0-9\-]+-P\d+\.html",
    ),
)

PROFILES = {"structured": STRUCTURED, "widget": WIDGET, "retail": RETAIL}
