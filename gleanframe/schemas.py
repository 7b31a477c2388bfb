"""Schemas of listing responses and of the records made from them."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Leaves are read as strings and cast with try_cast afterwards, so that a response whose number
# arrives quoted is not rejected as a whole.
ATTRIBUTE = _strings("name", "value", "semantic_value")
PRICE = _strings("value", "period", "view")
ADVERT = T.StructType(
    _strings("title", "region", "region_name", "region_item_text", "url", "user_id",
             "is_owner", "can_view_contacts", "status").fields
    + [T.StructField("price_obj", PRICE), T.StructField("attrs", T.ArrayType(ATTRIBUTE))]
)
LISTING = T.StructType([
    T.StructField("adverts_list", T.StructType([
        T.StructField("adverts", T.ArrayType(ADVERT)),
        T.StructField("total_pages", T.StringType()),
    ])),
    T.StructField("next_url", T.StringType()),
])
# A response is parsed as the only element of a list: text behind its object, which the parser
# would pass over at the top level, makes the list unreadable.
WRAPPED_LISTING = T.StructType([T.StructField("docs", T.ArrayType(LISTING))])

# Column order of the written table (fixed values).
DETAIL_16 = [
    "title", "location", "type", "property_address", "estate_name", "property_size", "condition",
    "furnishing", "toilets", "bedrooms", "bathrooms", "price_rent", "price_with_period",
    "seller_or_agent_name", "time_on_site", "property_url",
]
# Listing record of the browsed listing (fixed values).
LISTING_16 = [
    "title", "location", "type", "bedrooms", "bathrooms", "address", "estate", "size", "condition",
    "furnishing", "toilets", "price_rent", "price_with_period", "seller_or_agent_name",
    "time_on_site", "property_url",
]
# Listing record of the JSON listing (fixed values).
LISTING_14 = [
    "title", "rent_per_period", "rent_period", "region", "property_size_sqm", "bedrooms",
    "bathrooms", "furnishing", "listing_by", "user_id", "is_owner", "can_view_contacts", "status",
    "property_url",
]
# Columns that only the detail page supplies (fixed values).
DETAIL_8 = [
    "description", "property_address", "estate_name", "condition", "toilets",
    "ranter_or_agent_name", "time_on_site", "property_details",
]
ACCOUNT_7 = ["url", "description", "price", "level", "category", "rating", "seller"]

# Listing-record names that differ from the written table's.
LISTING_TO_DETAIL = {
    "address": "property_address", "estate": "estate_name", "size": "property_size",
}
