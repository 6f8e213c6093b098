"""One product record per stored page.

Every field is a column expression over the whole table: no shuffle, no Python
worker. Each stage adds the columns the next one shares, so the tag-stripped text
is built once per page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions import html as H
from vitrine.functions import jsonld as J
from vitrine.functions.numbers import number, price_pair, prices, volumes
from vitrine.functions.once import let, nonblank
from vitrine.functions.rules import all_matches, contains_any, first_match
from vitrine.functions.text import GAP, collapse, markup, strip, visible_text
from vitrine.profiles import SHADE_LABEL, SHADE_NAME, SHADE_TEXT, SKIN_ANCHORS, Profile
from vitrine.schema import CANONICAL, FIELDS, TAG_JOIN

_H1_RANKED = (
    H.any_of(H.tag(H.equals("data-at", "product_name"), name="h1")),
    H.any_of(H.tag(H.has("class", "product-name"), name="h1")),
    H.any_of(H.tag(H.has("class", "ProductName"), name="h1")),
    H.any_of(H.tag(name="h1")),
)
_ADD_BUTTON = H.any_of(
    H.tag(H.equals("data-at", "btn_add_to_basket"), name="button"),
    H.tag(H.has("class", "add-to-cart"), name="button"),
)
_MONEY = CANONICAL["price"].dataType
_CRUMB_LINKS = H.any_of(H.tag(H.word("class", "breadcrumb")), H.tag(H.has("class", "breadcrumb"), name="ol"))
_CRUMB_ITEMS = H.any_of(
    H.tag(H.has("class", "breadcrumb"), name="ol"), H.tag(H.has("aria-label", "breadcrumb"), name="nav")
)


def _first(blocks: Column, value: Callable[[Column], Column]) -> Column:
    """First non-null ``value`` over an array of blocks."""
    return F.get(F.filter(F.transform(blocks, value), lambda x: x.isNotNull()), F.lit(0))


def _last(blocks: Column, value: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(F.transform(blocks, value), lambda x: x.isNotNull()), F.lit(-1))


def _crumb(block: Column, position: int) -> Column:
    """Breadcrumb entry counted from the end, null when there are too few."""
    entries = F.try_variant_get(block, "$.itemListElement", "array<variant>")
    return F.try_element_at(entries, F.lit(position))


def _last_crumb_name(block: Column) -> Column:

    def named(entry: Column) -> Column:
        missing = F.try_variant_get(entry, "$.item", "variant").isNull() & entry.isNotNull()
        usable = missing | (J.kind_of(entry, "$.item") == "OBJECT")
        return F.when(usable, F.coalesce(J.get(entry, "$.item.name"), F.lit("")))

    return let(_crumb(block, -1), named)


def _head(name: str, window: int | None) -> Column:
    return F.col(name) if window is None else F.substring(name, 1, window)


# ---- field chains: each returns a column, null when the page does not say ---------

def _name(profile: Profile) -> Column:
    html, blocks, products = F.col("markup"), F.col("blocks"), F.col("products")
    cut = F.regexp_replace(H.meta(html, "og:title"), rf"{GAP}{profile.title_cut}.*", "")

    def first_named(block: Column) -> Column:
        is_product = F.try_variant_get(block, "$['@type']", "string") == "Product"
        return nonblank(F.when(is_product, J.get(block, "$.name")).otherwise(_last_crumb_name(block)))

    steps = {
        "ld_product": lambda: nonblank(strip(_first(products, lambda b: J.get(b, "$.name")))),
        "ld_last_crumb": lambda: nonblank(_last(J.of_type(blocks, "BreadcrumbList"), _last_crumb_name)),
        "ld_first_named": lambda: _first(J.of_type(blocks, "Product", "BreadcrumbList"), first_named),
        "h1": lambda: nonblank(H.zone_text(html, _H1_RANKED[-1])),
        "h1_ranked": lambda: nonblank(F.coalesce(*[H.joined_text(html, s) for s in _H1_RANKED])),
        "title": lambda: nonblank(strip(cut)),
    }
    name = F.coalesce(*[steps[step]() for step in profile.name], F.lit(""))
    return collapse(name) if profile.collapse_name else name


def _brand(profile: Profile, default: str) -> Column:
    if not profile.ld_brand:
        return F.lit(default)

    def named(block: Column) -> Column:
        kind = J.kind_of(block, "$.brand")
        return F.when(kind == "OBJECT", J.get(block, "$.brand.name")).when(kind == "STRING", J.get(block, "$.brand"))

    return F.coalesce(_last(F.col("products"), lambda b: nonblank(named(b))), F.lit(default))


def _crumbs(profile: Profile) -> tuple[Column, Column]:
    """(category of the JSON-LD breadcrumb, category of the breadcrumb markup)."""
    none = F.lit(None).cast("string")
    if profile.category == "structured":
        crumb = F.get(J.of_type(F.col("blocks"), "BreadcrumbList"), F.lit(0))
        entry = _crumb(crumb, -2)
        return (
            F.lower(nonblank(strip(J.get(entry, "$.item.name")))),
            let(
                H.list_texts(F.col("markup"), _CRUMB_LINKS, "a"),
                lambda x: F.when(F.size(x) >= 2, nonblank(F.lower(F.try_element_at(x, F.lit(-1))))),
            ),
        )
    if profile.category == "retail":
        items = H.list_texts(F.col("markup"), _CRUMB_ITEMS, "li")
        return none, nonblank(F.try_element_at(items, F.lit(-2)))
    return none, none


def settle_category(profile: Profile, listing: Column, crumb_ld: Column, crumb_links: Column) -> Column:
    """Category of the page where it differs from the listing's, else the listing's."""
    from_links = F.coalesce(crumb_links, listing)
    return F.when(crumb_ld.isNotNull() & ~crumb_ld.eqNullSafe(listing), crumb_ld).otherwise(from_links)


def _ld_price(block: Column) -> Column:
    return F.coalesce(
        J.truthy(block, "$.offers.price"), J.truthy(block, "$.offers.lowPrice"), J.truthy(block, "$.offers[0].price")
    )


def _found_prices(profile: Profile) -> Column:
    zone = F.coalesce("price_zone", _head("text", profile.price_window))
    return prices(zone, profile.price_pattern, *profile.price_range)


def _price(profile: Profile) -> tuple[Column, Column]:
    """(price, promo price) from the columns ``found_prices`` and ``ld_price``."""
    high, low = price_pair(F.col("found_prices"))
    ld = F.col("ld_price")
    if profile.price == "zone_then_meta":
        told = H.meta(F.col("markup"), "og:price:amount")
        return F.coalesce(high, F.translate(nonblank(told), ",", ".").try_cast(_MONEY)), low
    if profile.price == "zone_over_ld":
        return F.when(low.isNotNull(), high).otherwise(F.coalesce(ld, high)), low
    return F.coalesce(ld, high), F.when(ld.isNull(), low)


def _volume_text(profile: Profile) -> Column:
    head = _head("text", profile.volume_window)
    named = F.concat_ws(" ", F.col("product_name"), head)
    if profile.volume_zone is None:
        return named
    if profile.volume_zone == "price":
        return F.coalesce("price_zone", head)
    return F.coalesce(H.zone_text(F.col("markup"), profile.volume_zone), named)


def _sold_out(profile: Profile) -> Column:
    html = F.col("markup")
    if profile.stock == "meta":
        return F.contains(F.lower(H.meta(html, "og:availability")), F.lit("out"))
    if profile.stock == "retail":
        told = contains_any(_head("text_lower", profile.out_window), profile.out_phrases)
        return told | (H.attribute(H.first_tag(html, _ADD_BUTTON), "disabled") != "")
    marked = F.exists(
        "products",
        lambda b: F.coalesce(
            contains_any(F.lower(J.get(b, "$.offers.availability")), ("outofstock", "sold")), F.lit(False)
        ),
    )
    told = contains_any(F.col("text_lower"), profile.out_phrases)
    # The button text may stand anywhere between tags, scripts and comments included.
    between = F.regexp_replace("html", r"</?[a-zA-Z][^>]*>", " ")
    button = F.rlike(between, F.lit(r"(?iu)(?:^|[^\p{L}\p{N}_])ajouter(?:[^\p{L}\p{N}_]|$)"))
    return marked | (told & ~button)


def _counted(
    steps: tuple[tuple[str, str], ...], ld: Callable[[Column], Column], pattern: str, kind: str, label: bool
) -> Column:
    """Rating or review count by the profile's steps."""
    html = F.col("markup")

    def step(where: str, what: str) -> Column:
        if where == "ld":
            return _first(F.col("products"), ld).try_cast(kind)
        if where == "zone":
            shown = H.joined_text(html, what)
            if label:
                shown = F.concat(H.attribute(H.first_tag(html, what), "aria-label"), shown)
            return number(shown, pattern, kind)
        return number(F.col({"text": "text", "lower": "text_lower"}[where]), what, kind)

    return F.coalesce(*[step(*s) for s in steps])


def _shown_shades(profile: Profile) -> Column:
    """Number of shades the markup shows."""
    html = F.col("markup")
    if profile.swatches is None:
        return F.size(F.array_distinct("shade_names"))
    shown = H.count_tags(html, profile.swatches)
    for zone, item in profile.swatch_items:
        shown = shown + H.count_tags(F.array_join(H.elements(html, zone), ""), item)
    return shown


def _shades(profile: Profile) -> Column:
    shown, told = F.col("shown_shades"), F.col("told_shades")
    counted = F.size("shade_names") if profile.swatches is None else shown
    enough = counted >= profile.least_shades
    if profile.most_shades is not None:
        enough = enough & (counted <= profile.most_shades)
    if profile.shades[0] == "swatches":
        return F.coalesce(F.when(enough, shown), told)
    return F.coalesce(told, F.when(enough, shown))


def _labelled(text: Column, pattern: str) -> Column:
    return nonblank(F.rtrim(strip(F.regexp_extract(text, pattern, 1)), F.lit(",")))


def extract_products(
    pages: DataFrame, profile: Profile, brand: str, *, best_rating: bool = True, extras: bool = False
) -> DataFrame:
    """Product records of ``pages(url, html[, category])``.

    ``category`` is the listing's; leave it out to join the listing afterwards, as
    ``collect_catalogue`` does, and take ``crumb_ld`` and ``crumb_links`` from the
    extras. ``best_rating=False`` drops the fallback to the highest possible rating.
    The extras are ``volume_unit`` (ml or g), ``in_stock``, the ``skin_types`` array and ``content``, a hash of the page.
    """
    listing = F.col("category") if "category" in pages.columns else F.lit(None).cast("string")
    records = pages.select(F.col("url").alias("source_url"), listing.alias("listing_category"), "html",
                           F.xxhash64("html").alias("content"))
    for columns in _stages(profile, brand, best_rating):
        records = records.select(*columns)
    more = ["volume_unit", "in_stock", "skin_types", "crumb_ld", "crumb_links", "content"] if extras else []
    return records.select(*FIELDS, *more)


def _stages(profile: Profile, brand: str, best_rating: bool) -> list[list[Column | str]]:
    """The select lists of ``extract_products``, one after the other."""
    html, text, lower = F.col("html"), F.col("text"), F.col("text_lower")
    read = [
        "*",
        J.block_array(html, profile.flatten_lists).alias("blocks"),
        markup(html).alias("markup"),
        visible_text(html).alias("text"),
    ]
    found = J.of_type(F.col("blocks"), "Product")
    ready = [
        "*",
        F.lower("text").alias("text_lower"),
        # A structured page is described by its first Product block only.
        (F.slice(found, 1, 1) if profile.flatten_lists else found).alias("products"),
        H.zone_text(F.col("markup"), profile.price_zone).alias("price_zone"),
    ]
    by_label = profile.swatches is None
    named = [
        "*",
        _name(profile).alias("product_name"),
        _found_prices(profile).alias("found_prices"),
        F.translate(_first(F.col("products"), _ld_price), ",", ".").try_cast(_MONEY).alias("ld_price"),
        number(text if by_label else lower, SHADE_LABEL if by_label else SHADE_TEXT, "int").alias("told_shades"),
        (F.regexp_extract_all(text, F.lit(SHADE_NAME), F.lit(0)) if by_label else F.array()).alias("shade_names"),
    ]
    zoned = ["*", _volume_text(profile).alias("volume_text"), _shown_shades(profile).alias("shown_shades")]

    ml, grams = volumes(
        F.col("volume_text"),
        any_case=profile.volume_any_case, ml_ends_word=profile.ml_ends_word, g_ends=profile.g_ends,
    )
    rating_paths = ["$.aggregateRating.ratingValue"] + ["$.aggregateRating.bestRating"] * best_rating
    review_paths = ["$.aggregateRating.reviewCount", "$.aggregateRating.ratingCount"]
    price, promo = _price(profile)
    crumb_ld, crumb_links = _crumbs(profile)
    values = {
        "brand": _brand(profile, brand),
        "crumb_ld": crumb_ld,
        "crumb_links": crumb_links,
        "price": price,
        "promo_price": promo,
        "ml": ml,
        "grams": grams,
        "sold_out": F.coalesce(_sold_out(profile), F.lit(False)),
        "rating": _counted(
            profile.rating, lambda b: F.coalesce(*[J.truthy(b, p) for p in rating_paths]), r"(\d+[.,]\d+)",
            CANONICAL["rating"].dataType.simpleString(), True,
        ),
        "review_count": _counted(
            profile.reviews, lambda b: F.coalesce(*[J.truthy(b, p) for p in review_paths]), r"(\d+)", "bigint", False
        ),
        "shade_count": _shades(profile),
        "finish_type": _labelled(text, profile.finish_label)
        if profile.finish_label
        else first_match(_head("text_lower", profile.finish_window), profile.finish),
        "coverage_level": _labelled(text, profile.coverage_label)
        if profile.coverage_label
        else first_match(_head("text_lower", profile.coverage_window), profile.coverage),
        "skin_types": all_matches(lower, profile.skin, SKIN_ANCHORS),
    }
    fields = ["source_url", "listing_category", "content", "product_name", *[c.alias(n) for n, c in values.items()]]
    settled = [
        "*",
        settle_category(profile, F.col("listing_category"), F.col("crumb_ld"), F.col("crumb_links")).alias("category"),
        F.when(F.size("skin_types") > 0, F.array_join("skin_types", TAG_JOIN)).alias("skin_type"),
        F.coalesce("ml", "grams").alias("volume_ml"),
        F.when(F.col("ml").isNotNull(), "ml").when(F.col("grams").isNotNull(), "g").alias("volume_unit"),
        F.when(F.col("sold_out"), profile.out_label).otherwise(profile.in_stock_label).alias("availability"),
        (~F.col("sold_out")).alias("in_stock"),
    ]
    return [read, ready, named, zoned, fields, settled]


def named_only(records: DataFrame) -> DataFrame:
    """Drop records without a name."""
    # Catalyst would push a filter below the projections and find every name twice,
    # JSON and HTML included; it does not push through an explode.
    named = F.when(F.col("product_name") != "", F.array(F.struct("*")))
    return records.select(F.explode(named).alias("record")).select("record.*")
