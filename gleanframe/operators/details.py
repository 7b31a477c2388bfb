"""Detail and account pages -> records.

Each job walks a page once (``walk_pages``) for the fields it needs and derives its columns from
the collected text nodes with column expressions. Nothing here shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe import schemas
from gleanframe.functions import text as t
from gleanframe.functions.html import Field, Step
from gleanframe.operators.pages import walk_pages

# Page elements (fixed values).
_KEY = Step("div", "b-advert-attribute__key")
_VALUE = Step("div", "b-advert-attribute__value")
_REGION = Step("div", "b-advert-info-statistics--region")
_ICONS = Step("div", "b-advert-icon-attributes-container")
_PRICE = Step("div", "qa-advert-price-view")
_PRICE_VALUE = Step("span", "qa-advert-price-view-value")
_PRICE_PERIOD = Step("span", "b-alt-advert-price__period")
_SELLER = Step("div", "b-seller-block__info")

TITLE = Field("title_nodes", "texts", ((Step("div", "b-advert-title-inner"),),))
REGION = Field("region_nodes", "texts", ((_REGION,),))
FIRST_ICON = Field("first_icon_nodes", "texts",
                   ((_ICONS, Step("div", "b-advert-icon-attribute", nth=1), Step("span")),))
ICONS = Field("icon_nodes", "texts",
              ((_ICONS, Step("div", "b-advert-icon-attribute"), Step("span")),))
ALL_TILES = Field("tiles", "pairs",
                  ((Step("div", "b-advert-attributes-wrapper"), Step(None, "b-advert-attribute")),),
                  (_KEY, _VALUE))
PRICE = Field("price_nodes", "texts", ((_PRICE, _PRICE_VALUE),))
PRICE_PARTS = Field("price_part_nodes", "texts",
                    ((_PRICE, _PRICE_VALUE), (_PRICE, _PRICE_PERIOD)))
SELLER = Field("seller_nodes", "texts", ((_SELLER, Step("div", "b-seller-block__name")),))
SECOND_STAT = Field("second_stat_nodes", "texts",
                    ((_SELLER, Step("div", "b-seller-block__info__stat", nth=2)),))

TILES = Field("tiles", "pairs",
              ((Step("div", "b-advert-attributes--tiles"), Step("div", "b-advert-attribute")),),
              (_KEY, _VALUE))
ANY_DESCRIPTION = Field("any_description_nodes", "texts",
                        ((Step("div", cls_part="description"),),))
DESCRIPTION = Field("description_nodes", "texts", ((Step("div", "description"),),))
ANY_REGION = Field("any_region_nodes", "texts",
                   ((Step("div", cls_part="advert-info-statistics--region"),),))
NAME = Field("name_nodes", "texts", ((Step("div", "b-seller-block__name"),),))
ANY_NAME = Field("any_name_nodes", "texts", ((Step("div", cls_part="seller-block__name"),),))
STATS = Field("stats", "elements", ((Step("div", "b-seller-block__info__stat"),),))
ANY_STATS = Field("any_stats", "elements",
                  ((Step("div", cls_part="seller-block__info__stat"),),))
DETAIL_LINES = Field("detail_line_nodes", "texts",
                     ((Step("div", cls_part="b-advert__description-wrapper"),
                       Step("span", cls_part="qa-description-text")),))

LISTING_ANCHOR = (Step("a", "b-list-advert-base"),)
HEADING_ANCHOR = (Step("h3", "add-title"), Step("a"))

_PANEL = (Step("aside", "panel-details"), Step("ul"))
HEADING = Field("heading_nodes", "texts", ((Step("div", "slider-left"), Step("h1")),))
PANEL = [Field(f"panel_{n}_nodes", "texts", ((*_PANEL, Step("li", nth=n), Step("p")),))
         for n in (1, 2, 3, 4)]
ACCOUNT_SELLER = Field("account_seller_nodes", "texts", ((Step("span", "name"), Step("a")),))

# A key that holds one of these words names the condition (fixed values).
CONDITION_WORDS = ["condition", "built", "status"]


def _stripped_first(nodes: str) -> Column:
    return t.strip(t.first(F.col(nodes)))


# ---- attribute tiles ------------------------------------------------------------------------

def kv_table_explode(pages: DataFrame) -> DataFrame:
    """One row per attribute tile: key lower-cased and stripped ('' when missing), value stripped
    (null when missing)."""
    walked = walk_pages(pages, [ALL_TILES]).select("url", F.posexplode("tiles").alias("pos", "tile"))
    return walked.select(
        "url", "pos",
        t.strip(F.lower(F.coalesce("tile.key", F.lit("")))).alias("key"),
        t.strip(F.col("tile.value")).alias("value"))


def _lower_key(tile: Column) -> Column:
    return F.lower(F.coalesce(tile["key"], F.lit("")))


def _value_or_blank(tile: Column) -> Column:
    """'' for a tile without value text, null only when there is no tile."""
    return F.when(tile.isNotNull(), F.coalesce(t.strip(tile["value"]), F.lit("")))


def pick_exact(tiles: Column, name: str) -> Column:
    """Value of the first tile whose key is the name."""
    return _value_or_blank(t.first(F.filter(tiles, lambda x: t.strip(_lower_key(x)) == name)))


def pick_any_word(tiles: Column, words: list[str]) -> Column:
    """Value of the first tile, in page order, whose key holds any of the words."""
    return _value_or_blank(t.first(F.filter(tiles, lambda x: t.contains_any(_lower_key(x), words))))


def kv_pick_exact(pages: DataFrame, name: str, column: str) -> DataFrame:
    return walk_pages(pages, [TILES]).select("url", pick_exact(F.col("tiles"), name).alias(column))


def kv_pick_any_keyword(pages: DataFrame, words: list[str], column: str) -> DataFrame:
    return walk_pages(pages, [TILES]).select(
        "url", pick_any_word(F.col("tiles"), words).alias(column))


# Tile classes, tested in this order; the first that fits takes the tile (fixed values).
TILE_CLASSES = {"property_size": "property size", "condition": "condition",
                "furnishing": "furnishing", "toilets": "toilet"}
# Icon classes, likewise (fixed values).
ICON_CLASSES = {"bedrooms": ["bedroom", "bdrm"], "bathrooms": ["bathroom"], "toilets": ["toilet"]}


def _exclusive(tests: dict[str, Column], name: str) -> Column:
    """The test of one class and none of those before it."""
    names = list(tests)
    earlier = [~tests[n] for n in names[:names.index(name)]]
    return reduce(lambda a, b: a & b, [*earlier, tests[name]])


def _tiles_of(tiles: Column, name: str) -> Column:
    def fits(tile: Column) -> Column:
        key = _lower_key(tile)
        return _exclusive({c: F.contains(key, F.lit(w)) for c, w in TILE_CLASSES.items()}, name)

    return F.filter(tiles, fits)


def pick_last(tiles: Column, name: str) -> Column:
    """Value of the last tile of a class; a last tile without value gives null."""
    return t.strip(t.last(_tiles_of(tiles, name))["value"])


def kv_pick_last_chain(pages: DataFrame) -> DataFrame:
    return walk_pages(pages, [ALL_TILES]).select(
        "url", *[pick_last(F.col("tiles"), n).alias(n) for n in TILE_CLASSES])


def pick_icon(icons: Column, name: str) -> Column:
    """Last icon text of a class."""
    def fits(icon: Column) -> Column:
        low = F.lower(icon)
        return _exclusive({c: t.contains_any(low, w) for c, w in ICON_CLASSES.items()}, name)

    return t.last(F.filter(icons, fits))


def _toilets(icons: Column, tiles: Column) -> Column:
    """A toilet tile, if there is one, overrides the icon, even without value."""
    return F.when(F.size(_tiles_of(tiles, "toilets")) > 0, pick_last(tiles, "toilets")).otherwise(
        pick_icon(icons, "toilets"))


def icon_classify(pages: DataFrame) -> DataFrame:
    icons, tiles = F.col("icons"), F.col("tiles")
    walked = walk_pages(pages, [ICONS, ALL_TILES]).select(
        "url", "tiles", t.strip_all(F.col("icon_nodes")).alias("icons"))
    return walked.select(
        "url",
        pick_icon(icons, "bedrooms").alias("bedrooms"),
        pick_icon(icons, "bathrooms").alias("bathrooms"),
        _toilets(icons, tiles).alias("toilets"))


# ---- records --------------------------------------------------------------------------------

_RECORD_FIELDS = [TITLE, REGION, FIRST_ICON, ICONS, ALL_TILES, PRICE, PRICE_PARTS, SELLER, SECOND_STAT]


def _record_columns() -> dict[str, Column]:
    """The columns of the record of a walked page with ``location`` and ``icons``."""
    icons, tiles, location = F.col("icons"), F.col("tiles"), F.col("location")
    return {
        "title": _stripped_first("title_nodes"),
        "location": location,
        "type": _stripped_first("first_icon_nodes"),
        "property_address": t.blank_to_null(location),
        "estate_name": t.blank_to_null(t.strip(t.part(location, "/", 1))),
        "property_size": pick_last(tiles, "property_size"),
        "condition": pick_last(tiles, "condition"),
        "furnishing": pick_last(tiles, "furnishing"),
        "toilets": _toilets(icons, tiles),
        "bedrooms": pick_icon(icons, "bedrooms"),
        "bathrooms": pick_icon(icons, "bathrooms"),
        "price_rent": _stripped_first("price_nodes"),
        "price_with_period": t.blank_to_null(
            F.array_join(F.transform("price_part_nodes", t.strip), " ")),
        "seller_or_agent_name": _stripped_first("seller_nodes"),
        "time_on_site": _stripped_first("second_stat_nodes"),
        "property_url": F.col("url"),
    }


def _with_record_parts(walked: DataFrame) -> DataFrame:
    return walked.withColumns({
        "location": t.strip(t.before_last(t.first(F.col("region_nodes")), ",")),
        "icons": t.strip_all(F.col("icon_nodes")),
    })


def detail_record_16(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The canonical record of a detail page; ``keep`` names further page columns to carry."""
    walked = _with_record_parts(walk_pages(pages, _RECORD_FIELDS, ("url", *keep)))
    values = _record_columns()
    return walked.select(*keep, *[values[c].alias(c) for c in schemas.DETAIL_16])


# The element that a detail page is waited for (fixed value); a page without it gives no record.
AWAITED = "b-advert-attributes-wrapper"
_AWAITED = Field("awaited", "attr", ((Step("div", AWAITED),),), "class")


def detail_audit(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every detail page, walked once: its record, and where it has none the ``error_kind``, the
    ``error_field`` it is about and a ``message``.

    no_page          nothing is stored for the URL, or blanks
    not_html         a text without any element
    missing_element  the awaited element is not there, as on a page that was cut off before it
    unreadable       the walk broke off, with its message
    """
    html = F.col("html")
    looked = pages.select(
        "url", *keep, "html",
        F.when(t.strip(F.coalesce(html, F.lit(""))) == "", "no_page").when(
            ~html.rlike("<[a-zA-Z]"), "not_html").alias("_kind"),
        F.coalesce(F.length("html"), F.lit(0)).alias("_size"))
    walked = _with_record_parts(walk_pages(
        looked, [*_RECORD_FIELDS, _AWAITED], ("url", *keep, "_kind", "_size"), error="_error"))
    kind = F.coalesce("_kind", F.when(F.col("_error").isNotNull(), "unreadable"),
                      F.when(F.size("awaited") == 0, "missing_element"))
    message = F.when(kind == "no_page", "nothing stored").when(
        kind == "not_html", F.concat(F.lit("no element in "), F.col("_size").cast("string"), F.lit(" characters"))).when(
        kind == "unreadable", F.col("_error")).when(
        kind == "missing_element", F.concat(F.lit(f"no {AWAITED} in "), F.col("_size").cast("string"), F.lit(" characters")))
    field = F.when(kind == "missing_element", AWAITED).when(kind.isNotNull(), "html")
    values = _record_columns()
    return walked.select(*keep, *[values[c].alias(c) for c in schemas.DETAIL_16], kind.alias("error_kind"),
                         field.alias("error_field"), message.alias("message"))


def detail_accepted(audited: DataFrame) -> DataFrame:
    """The records of the pages that have one."""
    return audited.filter("error_kind is null").drop("error_kind", "error_field", "message")


def detail_rejects(audited: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The other pages, with what was wrong."""
    return audited.filter("error_kind is not null").select(
        F.col("property_url").alias("url"), *keep, "error_kind", "error_field", "message")


def detail_fields_8(pages: DataFrame, stat_phrase: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The detail-only columns of the enriched record. ``stat_phrase`` marks the seller statistic
    that tells the time on the site; ``keep`` names further page columns to carry."""
    fields = [ANY_DESCRIPTION, DESCRIPTION, REGION, ANY_REGION, TILES, NAME, ANY_NAME, STATS,
              ANY_STATS, DETAIL_LINES]
    tiles = F.col("tiles")

    def nodes_of(elements: str, fits) -> Column:
        return F.flatten(F.transform(F.filter(elements, fits), lambda e: e["nodes"]))

    def first_token(word: str) -> Column:
        return t.part(pick_any_word(tiles, [word]), " ", 0)

    phrase = F.lit(stat_phrase)
    by_text = nodes_of("stats", lambda e: F.contains(e["full"], phrase))
    by_first_node = nodes_of(
        "any_stats", lambda e: F.coalesce(F.contains(t.first(e["nodes"]), phrase), F.lit(False)))
    lines = F.col("detail_line_nodes")
    values = {
        # the first source is not stripped, so a blank node counts as found
        "description": t.first_truthy(
            t.first(F.col("any_description_nodes")), _stripped_first("description_nodes")),
        "property_address": t.first_truthy(
            _stripped_first("region_nodes"), _stripped_first("any_region_nodes")),
        "estate_name": pick_exact(tiles, "estate name"),
        "condition": pick_any_word(tiles, CONDITION_WORDS),
        # an empty toilet tile falls through, an empty bathroom tile does not
        "toilets": F.coalesce(t.blank_to_null(first_token("toilet")), first_token("bathroom")),
        "ranter_or_agent_name": t.first_truthy(
            _stripped_first("name_nodes"), _stripped_first("any_name_nodes")),
        "time_on_site": t.first_truthy(
            t.strip(t.first(by_text)), t.strip(t.first(by_first_node))),
        "property_details": F.when(
            F.size(lines) > 0, F.array_join(t.strip_all(lines), "\n")),
    }
    return walk_pages(pages, fields, ("url", *keep)).select(
        "url", *keep, *[values[c].alias(c) for c in schemas.DETAIL_8])


def _account_columns(pages: DataFrame) -> DataFrame:
    walked = walk_pages(pages, [HEADING, *PANEL, ACCOUNT_SELLER])
    return walked.select(
        "url",
        # stripped before the split, so what follows the separator keeps its leading blank
        t.part(_stripped_first("heading_nodes"), ":", 1, 2).alias("description"),
        t.part(_stripped_first("panel_1_nodes"), "S", 1).alias("price"),
        _stripped_first("panel_2_nodes").alias("level"),
        _stripped_first("panel_3_nodes").alias("category"),
        _stripped_first("panel_4_nodes").alias("rating"),
        _stripped_first("account_seller_nodes").alias("seller"),
    )


def account_audit(pages: DataFrame) -> DataFrame:
    """All account pages, walked once: the seven columns and the first part that is missing. Complete
    records are those without one."""
    failing = F.coalesce(*[F.when(F.col(c).isNull(), c) for c in schemas.ACCOUNT_7[1:]])
    return _account_columns(pages).withColumn("failed_field", failing)


def account_record_7(pages: DataFrame) -> DataFrame:
    """Account records that have every part."""
    return account_audit(pages).filter(F.col("failed_field").isNull()).drop("failed_field")


def account_rejects(pages: DataFrame) -> DataFrame:
    """The other pages, with the first part that is missing."""
    return account_audit(pages).select("url", "failed_field").dropna()
