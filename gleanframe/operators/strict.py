"""Listing responses read as they are: values keep their JSON types, and a missing key, an explicit null
and a value of another type are told apart.

A default stands for a missing key only. Where a crawler would break off at a null or a value of another type,
the response or the advert is rejected with the path of that value; the other adverts of the response are kept.
The response is one VARIANT column, parsed once; no schema is assumed and nothing is cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.operators.columns import with_once
from gleanframe.operators.listing import json_unwrap

# What a key must hold, by the first word of its type.
OBJECT, ARRAY = "OBJECT", "ARRAY"


def _get(value: Column, key: str, kind: str = "variant") -> Column:
    """The value under a key; null when the key is missing or the value is no object."""
    return F.try_variant_get(value, f"$.{key}", kind)


def _is(value: Column, kind: str) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit(kind))


def _fault(value: Column, path: Column, kind: str | None) -> Column:
    """Why a value under a key cannot be used: (path, reason), null when it can be, or is missing. ``kind`` null
    takes all types but null."""
    wrong = F.lit(False) if kind is None else ~_is(value, kind)
    reason = F.when(F.is_variant_null(value), "null_value").when(wrong, "wrong_type")
    return F.when(value.isNotNull() & reason.isNotNull(), F.struct(path.alias("path"), reason.alias("reason")))


def parse_strict(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Responses as ``doc``, null where the JSON is malformed; responses without JSON give no row."""
    found = json_unwrap(payloads, body)
    return with_once(found, "doc", F.try_parse_json("json")).drop("json")


def response_faults(parsed: DataFrame) -> DataFrame:
    """Add ``fault``: the first value of a response that cannot be used, in the order in which it is read."""
    doc = F.col("doc")
    listed = _get(doc, "adverts_list")
    root = F.when(doc.isNull(), F.struct(F.lit("$").alias("path"), F.lit("malformed").alias("reason"))).when(
        ~_is(doc, OBJECT), F.struct(F.lit("$").alias("path"), F.lit("wrong_type").alias("reason")))
    return with_once(parsed, "fault", F.coalesce(
        root, _fault(listed, F.lit("$.adverts_list"), OBJECT),
        _fault(_get(listed, "adverts"), F.lit("$.adverts_list.adverts"), ARRAY),
        _fault(_get(listed, "total_pages"), F.lit("$.adverts_list.total_pages"), None)))


def json_defaults_strict(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Responses that can be used: ``adverts`` (an array of variants, empty when missing), ``total_pages`` as a
    variant (1 when missing) and ``next_url`` (null when missing or null)."""
    good = response_faults(parse_strict(payloads, body)).filter("fault is null")
    listed = _get(F.col("doc"), "adverts_list")
    adverts = F.coalesce(_get(listed, "adverts", "array<variant>"), F.array().cast("array<variant>"))
    return good.withColumns({
        "adverts": adverts,
        "total_pages": F.coalesce(_get(listed, "total_pages"), F.parse_json(F.lit("1"))),
        "next_url": _get(F.col("doc"), "next_url", "string"),
    }).drop("doc", "fault")


def adverts_strict(listing: DataFrame) -> DataFrame:
    """One row per advert with its ``fault``: the first of its values that cannot be used.

    An advert must be an object, its ``price_obj`` one too, its ``attrs`` a list of objects that have a name
    and a value. A missing ``price_obj`` is empty, missing ``attrs`` are none.
    """
    kept = [c for c in listing.columns if c not in ("adverts", "total_pages", "next_url")]
    return _with_faults(listing.select(*kept, F.posexplode("adverts").alias("pos", "advert")))


def _with_faults(rows: DataFrame) -> DataFrame:
    """Add ``attrs`` and ``fault`` to rows of (pos, advert); a null advert has none."""
    rows = with_once(rows, "attrs", _get(F.col("advert"), "attrs", "array<variant>"))
    advert = F.col("advert")
    at = F.concat(F.lit("$.adverts_list.adverts["), F.col("pos").cast("string"), F.lit("]"))

    def attribute_fault(attr: Column, place: Column) -> Column:
        path = F.concat(at, F.lit(".attrs["), place.cast("string"), F.lit("]"))
        missing = F.coalesce(*[F.when(_get(attr, k).isNull(), F.lit(f".{k}")) for k in ("name", "value")])
        return F.when(~_is(attr, OBJECT), F.struct(path.alias("path"), F.lit("wrong_type").alias("reason"))).when(
            missing.isNotNull(), F.struct(F.concat(path, missing).alias("path"), F.lit("missing_key").alias("reason")))

    in_attrs = F.get(F.filter(F.transform("attrs", attribute_fault), lambda x: x.isNotNull()), F.lit(0))
    # attributes are read before the price
    return with_once(rows, "fault", F.coalesce(
        F.when(~_is(advert, OBJECT), F.struct(at.alias("path"), F.lit("wrong_type").alias("reason"))),
        _fault(_get(advert, "attrs"), F.concat(at, F.lit(".attrs")), ARRAY), in_attrs,
        _fault(_get(advert, "price_obj"), F.concat(at, F.lit(".price_obj")), OBJECT)))


def strict_rejects(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The responses (``pos`` null) and adverts that cannot be used, each with the path and the reason. The
    responses are parsed once for both."""
    keep = [c for c in payloads.columns if c != body]
    read = response_faults(parse_strict(payloads, body)).withColumnRenamed("fault", "_fault")
    adverts = _get(_get(F.col("doc"), "adverts_list"), "adverts", "array<variant>")
    rows = read.select(*keep, "_fault", F.posexplode_outer(F.when(F.col("_fault").isNull(), adverts)).alias(
        "pos", "advert"))
    found = _with_faults(rows).withColumn("_fault", F.coalesce("_fault", "fault")).filter("_fault is not null")
    return found.select(*keep, "pos", F.col("_fault.path").alias("path"), F.col("_fault.reason").alias("reason"))


# Columns of the record and the keys they come from (fixed values); attributes are read by name.
RAW = {"title": "title", "rent_per_period": "price_obj.value", "rent_period": "price_obj.period", "region": "region",
       "user_id": "user_id", "is_owner": "is_owner", "can_view_contacts": "can_view_contacts", "status": "status",
       "property_url": "url"}
RAW_ATTRS = {"property_size_sqm": "Property size", "bedrooms": "Bedrooms", "bathrooms": "Bathrooms",
             "furnishing": "Furnishing", "listing_by": "Listing by"}


def listing_record_raw(adverts: DataFrame) -> DataFrame:
    """The record of each advert that can be used, with every value as a variant just as it came: a price that
    is a text stays one. A repeated attribute keeps its last value; a missing key is null, an explicit null a
    variant null."""
    good = adverts.filter("fault is null")
    kept = [c for c in good.columns if c not in ("advert", "attrs", "fault")]

    def attribute(name: str) -> Column:
        named = F.filter("attrs", lambda a: _get(a, "name", "string") == name)
        return _get(F.get(F.reverse(named), F.lit(0)), "value")

    return good.select(
        *kept, *[_get(F.col("advert"), key).alias(column) for column, key in RAW.items()],
        *[attribute(name).alias(column) for column, name in RAW_ATTRS.items()])


def as_json(rows: DataFrame) -> DataFrame:
    """Variants as JSON text, for sinks that hold texts only."""
    return rows.select(*[
        F.to_json(F.col(c)).alias(c) if kind == "variant" else F.col(c) for c, kind in rows.dtypes])
