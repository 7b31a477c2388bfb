"""Listing responses -> records. A payload table has one row per response: page_num, body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe import schemas
from gleanframe.functions import text as t
from gleanframe.functions import urls
from gleanframe.operators.columns import with_once

ORDER = ("page_num", "pos")

# first '{' to last '}'; tried at the start of the text only, so it is linear in its length
_OBJECT = r"(?s)^[^{]*+(\{.*\})"

# Strict but for raw control characters within strings, which are kept.
_JSON = {"allowSingleQuotes": "false", "allowUnquotedControlChars": "true"}


def json_unwrap(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Replace the body by the JSON object inside it: first '{' to last '}', over line ends.
    Responses without one give no row (see json_rejects)."""
    found = F.regexp_extract_all(body, F.lit(_OBJECT), F.lit(1))
    return payloads.select(
        *[c for c in payloads.columns if c != body], F.explode(found).alias("json"))


def _parsed(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Add the response as ``docs``, parsed once: a list of one struct; null without JSON, a null
    or other list when the JSON is malformed. Values of an unexpected type are null."""
    found = t.blank_to_null(F.regexp_extract(body, _OBJECT, 1))
    wrapped = F.concat(F.lit('{"docs":['), found, F.lit("]}"))
    parsed = F.from_json(wrapped, schemas.WRAPPED_LISTING, _JSON)
    return with_once(payloads, "parsed", parsed).drop(body)


def _readable() -> Column:
    return F.coalesce(F.size("parsed.docs") == 1, F.lit(False))


def json_rejects(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Responses that yield no records, with the reason."""
    reason = F.when(F.col("parsed").isNull(), "no_json").otherwise("malformed")
    return _parsed(payloads, body).filter(~_readable()).withColumn("reason", reason).drop("parsed")


def parse_listing(payloads: DataFrame, body: str = "body") -> DataFrame:
    """One row per readable response: adverts (may be empty), total_pages (1 when missing),
    next_url."""
    doc = t.first(F.col("parsed.docs"))
    adverts = F.coalesce(
        doc["adverts_list"]["adverts"],
        F.array().cast(schemas.LISTING["adverts_list"].dataType["adverts"].dataType))
    total = F.coalesce(doc["adverts_list"]["total_pages"].try_cast("bigint"), F.lit(1))
    return (
        _parsed(payloads, body).filter(_readable())
        .withColumns({"adverts": adverts, "total_pages": total.cast("bigint"),
                      "next_url": doc["next_url"]})
        .drop("parsed")
    )


def non_empty_listing(listing: DataFrame) -> DataFrame:
    """Only a listing page that produced links schedules its next page."""
    return listing.filter(F.size("adverts") > 0)


def page_yield(listing: DataFrame, page: str = "page_num") -> DataFrame:
    """What a response gives: its records (``items``), and the requests that follow from it: one per
    advert with a URL, and the next page where there is a pointer to one within the page limit."""
    return listing.select(page, F.size("adverts").cast("bigint").alias("items"), requests_of(page).alias("requests"))


def requests_of(page: str = "page_num") -> Column:
    """Requests that follow from a response."""
    detail = F.size(F.filter("adverts", lambda a: a["url"].isNotNull()))
    following = F.col("next_url").isNotNull() & (F.col(page) < F.col("total_pages"))
    return (detail + F.when(following, 1).otherwise(0)).cast("bigint")


def listing_explode(listing: DataFrame) -> DataFrame:
    """One row per advert with its position in the response."""
    kept = [c for c in listing.columns if c != "adverts"]
    return listing.select(*kept, F.posexplode("adverts").alias("pos", "advert"))


def attrs_last_wins(adverts: DataFrame, names: dict[str, str], field: str = "value") -> DataFrame:
    """Add one column per attribute name (column -> name); a repeated name keeps its last value."""
    return adverts.withColumns(
        {c: t.attr_last(F.col("advert.attrs"), n, field) for c, n in names.items()})


def attrs_first_match(adverts: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
    """Add one column per (attribute name, field); the first attribute of that name counts."""
    return adverts.withColumns(
        {c: t.attr_first(F.col("advert.attrs"), n, f) for c, (n, f) in names.items()})


# Attribute names read by the two listing records (fixed values).
ATTRS_14 = {
    "property_size_sqm": "Property size", "bedrooms": "Bedrooms", "bathrooms": "Bathrooms",
    "furnishing": "Furnishing", "listing_by": "Listing by",
}
ATTRS_16 = {
    "bedrooms": ("Bedrooms", "semantic_value"), "bathrooms": ("Bathrooms", "semantic_value"),
    "size": ("Property size", "value"), "furnishing": ("Furnishing", "value"),
}


def listing_record_14(adverts: DataFrame) -> DataFrame:
    """The record of the JSON listing; property_url stays relative."""
    a = F.col("advert")
    return attrs_last_wins(adverts, ATTRS_14).select(
        *ORDER,
        a["title"].alias("title"),
        a["price_obj"]["value"].try_cast("double").alias("rent_per_period"),
        a["price_obj"]["period"].alias("rent_period"),
        a["region"].alias("region"),
        *ATTRS_14,
        a["user_id"].try_cast("bigint").alias("user_id"),
        a["is_owner"].try_cast("boolean").alias("is_owner"),
        a["can_view_contacts"].try_cast("boolean").alias("can_view_contacts"),
        a["status"].alias("status"),
        a["url"].alias("property_url"),
    )


def listing_record_16(adverts: DataFrame, site: str) -> DataFrame:
    """The record of the browsed listing; detail-only fields are null, the URL is absolute."""
    a = F.col("advert")
    none = F.lit(None).cast("string")
    view = a["price_obj"]["view"]
    values = {
        "title": a["title"],
        "location": a["region_item_text"],
        # an empty value counts as missing here, and only the plural ending is removed
        "type": F.replace(t.blank_to_null(F.col("bedrooms")), F.lit(" bedrooms"), F.lit("")),
        "estate": a["region_name"],
        "price_rent": view,
        "price_with_period": view,
        "property_url": urls.prefix(site, a["url"]),
    }
    missing = {"address", "condition", "toilets", "seller_or_agent_name", "time_on_site"}
    columns = []
    for name in schemas.LISTING_16:
        value = none if name in missing else values.get(name, F.col(name))
        columns.append(value.alias(name))
    return attrs_first_match(adverts, ATTRS_16).select(*ORDER, *columns)
