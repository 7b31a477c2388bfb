"""Inputs for the registered queries, the tests and the bench.

The test tables hold no listing responses, detail pages or account pages, so Spark renders them
from ``part`` and ``supplier`` in the shapes the jobs read. The jobs then parse them back, and the
oracle SQL computes the expected rows from the base tables directly. Expressions in capitals are
plain SQL that means the same in Spark and in the oracle's engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SITE = "https://market.example"
ACCOUNT_SITE = "https://accounts.example"
API = "https://market.example/api/listing"
SLUG = "flats-to-rent"
STAT_PHRASE = "on Market"
LISTING = SLUG

# Element classes, field names and URLs below are those of the input (fixed values).

# ---- listing responses ----------------------------------------------------------------------

PAGE = "(cast(floor(p_partkey / 20.0) as bigint) + 1)"
POS = "(p_partkey % 20)"
# some adverts repeat the URL of the one before, some have none
KEY = ("(case when p_partkey % 101 = 100 then null "
       "when p_partkey > 0 and p_partkey % 17 = 0 then p_partkey - 1 else p_partkey end)")
TITLE = ("(case when p_partkey % 29 = 0 then '' "
         "when p_partkey % 41 = 1 then p_name || chr(10) || 'second line' "
         "when p_partkey % 43 = 2 then p_name || ' \"de luxe\", large' else p_name end)")
# the same, escaped for JSON (chr(92) is the backslash)
TITLE_JSON = ("(case when p_partkey % 29 = 0 then '' "
              "when p_partkey % 41 = 1 then p_name || chr(92) || 'n' || 'second line' "
              "when p_partkey % 43 = 2 then p_name || ' ' || chr(92) || '\"de luxe' || chr(92) "
              "|| '\", large' else p_name end)")
HAS_PRICE = "(p_partkey % 23 <> 0)"
HAS_ATTRS = "(p_partkey % 31 <> 30)"
EXACT_FURNISHING = "(p_partkey % 37 <> 0)"
BATHS = "(p_partkey % 4 + 1)"
ROOMS = "(cast(p_size as string) || (case when p_size = 1 then ' bedroom' else ' bedrooms' end))"
OWNER = "(case when p_partkey % 3 = 0 then 'Owner' else 'Agent' end)"
# responses that hold no records
NO_JSON = "(page_num % 50 = 7)"
EMPTY = "(page_num % 50 = 4)"
CUT_OFF = "(page_num % 50 = 9)"
NO_TOTAL = "(page_num % 50 = 2)"

_ATTRS = f"""'[{{"name":"Bedrooms","value":"0","semantic_value":"' || {ROOMS} || '"}},'
 || '{{"name":"Bathrooms","value":"' || cast({BATHS} as string) || '","semantic_value":"' || cast({BATHS} as string) || ' bathrooms"}},'
 || '{{"name":"Bedrooms","value":"' || cast(p_size as string) || '","semantic_value":"0 bedrooms"}},'
 || '{{"name":"Property size","value":"' || cast(p_size * 10 as string) || ' sqm"}},'
 || '{{"name":"' || (case when {EXACT_FURNISHING} then 'Furnishing' else 'furnishing' end) || '","value":"' || p_type || '"}},'
 || '{{"name":"Listing by","value":"' || {OWNER} || '"}}]'"""

ADVERT_JSON = f"""('{{"title":"' || {TITLE_JSON} || '","region":"' || p_brand
 || '","region_name":"Estate ' || cast(p_size as string) || '","region_item_text":"Region/' || p_brand || '"'
 || (case when {KEY} is null then '' else ',"url":"/part/' || cast({KEY} as string) || '"' end)
 || ',"user_id":' || cast(p_size as string)
 || ',"is_owner":' || (case when p_partkey % 3 = 0 then 'true' else 'false' end)
 || (case when p_partkey % 5 = 0 then '' else ',"can_view_contacts":true' end) || ',"status":"active"'
 || (case when {HAS_PRICE} then ',"price_obj":{{"value":' || cast(p_retailprice as string)
     || ',"period":"per month","view":"KSh ' || cast(p_retailprice as string) || '"}}' else '' end)
 || (case when {HAS_ATTRS} then ',"attrs":' || {_ATTRS} else '' end) || '}}')"""

# page_num, adverts (the joined advert texts) and n_responses are given
BODY = f"""(case when {NO_JSON} then '<html><body>Service unavailable</body></html>'
 when {CUT_OFF} then '<html><body><pre>{{"adverts_list":{{"adverts":[' || adverts || '</pre></body></html>'
 else '<html><body><pre>' || chr(10) || '{{"adverts_list":{{"adverts":[' || chr(10)
  || (case when {EMPTY} then '' else adverts end) || ']'
  || (case when {NO_TOTAL} then '' else ',"total_pages":' || cast(n_responses + 5 as string) end) || '}}'
  || (case when page_num < n_responses then ',"next_url":"{API}?page=' || cast(page_num + 1 as string) || '"' else '' end)
  || '}}</pre></body></html>' end)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_num, body: one response per 20 adverts. p_partkey is unique, so a response holds 20
    adverts at most."""
    part = table(spark, sf_dir, "part")
    adverts = part.select(F.expr(PAGE).alias("page_num"), F.expr(POS).alias("pos"),
                          F.expr(ADVERT_JSON).alias("advert"))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "advert")))
    pages = adverts.groupBy("page_num").agg(
        F.array_join(F.transform(in_order, lambda x: x["advert"]), ",").alias("adverts"))
    n_responses = part.agg(F.max(F.expr(PAGE))).scalar()
    return pages.withColumn("n_responses", n_responses).select(
        "page_num", F.expr(BODY).alias("body"))


# ---- listing responses with nulls and values of other types ---------------------------------

STRICT_PRICE = """(case p_partkey % 23 when 0 then '' when 1 then ',"price_obj":null' when 2 then ',"price_obj":"free"'
 when 3 then ',"price_obj":{"value":null}' else ',"price_obj":{"value":' || (case when p_partkey % 2 = 0
 then cast(p_size as string) else '"' || cast(p_size as string) || '"' end) || ',"period":"per month"}' end)"""
STRICT_ATTRS = """(case p_partkey % 29 when 0 then '' when 1 then ',"attrs":null' when 2 then ',"attrs":{}'
 when 3 then ',"attrs":[{"name":"Bedrooms","value":1},{"name":"Bathrooms"}]' when 4 then ',"attrs":[7]'
 else ',"attrs":[{"name":"Bedrooms","value":0},{"name":"Bedrooms","value":' || cast(p_size as string) || '}]' end)"""
STRICT_ADVERT = f"""(case when p_partkey % 37 = 5 then '5'
 else '{{"title":"' || p_brand || '"' || {STRICT_PRICE} || {STRICT_ATTRS} || '}}' end)"""
STRICT_BODY = """(case page_num % 20 when 3 then '{"adverts_list":null}' when 4 then '{"adverts_list":{}}'
 when 5 then '{"adverts_list":{"adverts":null}}' when 6 then '{"adverts_list":{"adverts":"none"}}'
 when 9 then '{"adverts_list":{' || 'cut}' when 10 then 'Service unavailable' when 13 then '{"adverts_list":[]}'
 else '<pre>{"adverts_list":{"adverts":[' || adverts || ']' || (case page_num % 20 when 7 then ',"total_pages":null'
  when 8 then '' when 12 then ',"total_pages":"12"' else ',"total_pages":99' end) || '}'
  || (case when page_num % 20 = 11 then ',"next_url":null' else ',"next_url":"n/' || cast(page_num as string) || '"' end)
  || '}</pre>' end)"""


def strict_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_num, body: responses in which keys are missing, null or of another type. A response holds 20 adverts at
    most."""
    adverts = table(spark, sf_dir, "part").select(
        F.expr(PAGE).alias("page_num"), F.expr(POS).alias("pos"), F.expr(STRICT_ADVERT).alias("advert"))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "advert")))
    return adverts.groupBy("page_num").agg(
        F.array_join(F.transform(in_order, lambda x: x["advert"]), ",").alias("adverts")).select(
        "page_num", F.expr(STRICT_BODY).alias("body"))


# ---- detail pages ---------------------------------------------------------------------------

HAS_PAGE = "(p_partkey % 31 <> 5)"


def _tile(key: str, value: str, when: str = "true") -> str:
    return f"""(case when {when} then '<div class="b-advert-attribute"><div class="b-advert-attribute__value">'
      || {value} || '</div><div class="b-advert-attribute__key">{key}</div></div>' else '' end)"""


DETAIL_HTML = " || ".join([
    """'<!DOCTYPE html><html><head><meta charset="utf-8"><title>' || p_name || '</title>'""",
    """'<script>var t="</p><div class=b-advert-title-inner>script</div>";</script></head><body>'""",
    """'<!-- <div class="b-advert-title-inner">comment</div> --><ul class="nav"><li>'""",
    """'<a class="b-list-advert-base link" href="/part/' || cast(p_partkey + 1 as string) || '">next</a>'""",
    """'<li><a href="/about">about</a><li><a href="//' || p_partkey || '" class="b-list-advert-base">more</a></ul>'""",
    """'<div class="b-advert-title-inner">' || chr(10) || '  ' || p_name || ' &amp; more </div>'""",
    """(case when p_partkey % 47 = 4 then '' else '<div class="b-advert-info-statistics b-advert-info-statistics--region"> '
        || (case when p_partkey % 19 = 3 then 'Central' else 'Region/' || p_brand || ', x' end) || ' </div>' end)""",
    """'<div class="b-advert-icon-attributes-container">'""",
    """(case when p_partkey % 53 = 9 then '' else '<div class="b-advert-icon-attribute"><img src="i.png"><span> '
        || cast(p_size as string) || (case when p_partkey % 5 = 0 then ' bdrm' else ' Bedrooms' end) || ' </span></div>'
        || '<div class="b-advert-icon-attribute"><span> </span><span>' || cast(p_partkey % 4 + 1 as string) || ' bathrooms</span></div>'
        || (case when p_partkey % 3 = 0 then '<div class="b-advert-icon-attribute"><span>' || cast(p_partkey % 5 as string) || ' toilets</span></div>' else '' end) end)""",
    """'</div><div class="b-advert-attributes-wrapper"><div class="b-advert-attributes--tiles">'""",
    _tile(" Estate Name ", "(case when p_partkey % 37 = 1 then '' else ' Estate ' || p_brand end)",
          "p_partkey % 13 <> 4"),
    _tile("Built", "'2010'", "p_partkey % 10 = 6"),
    _tile("Condition", "p_type", "p_partkey % 11 <> 3"),
    _tile("Furnishing", "'Furnished'"),
    _tile("Property size", "cast(p_size * 10 as string) || ' sqm'"),
    _tile("Toilets", "cast(p_partkey % 3 + 1 as string) || ' toilets'", "p_partkey % 7 <> 2"),
    _tile("Bathrooms", "cast(p_partkey % 4 + 1 as string) || ' baths'"),
    _tile("Furnishing", "(case when p_partkey % 41 = 6 then '' else 'Semi' end)"),
    """'</div></div><div class="qa-advert-price-view"><span class="qa-advert-price-view-value"> KSh '""",
    """cast(p_retailprice as string) || ' </span>'""",
    """(case when p_partkey % 9 = 5 then '' else '<span class="b-alt-advert-price__period"> per month</span>' end)""",
    """'</div><div class="b-seller-block"><div class="b-seller-block__info">'""",
    """(case when p_partkey % 43 = 8 then '' else '<div class="b-seller-block__name">' || s_name || '</div>' end)""",
    """'<div class="b-seller-block__info__stat"><b>' || cast(p_partkey % 6 + 1 as string) || '</b> years on Market </div>'""",
    """'<div class="b-seller-block__info__stat">Replies fast</div></div></div>'""",
    """'<div class="b-advert__description-wrapper">' || (case when p_partkey % 8 = 1 then '' else ' About ' || p_name || ' ' end)""",
    """(case when p_partkey % 21 = 10 then '' when p_partkey % 21 = 11 then '<span class="qa-description-text">  </span>'
        else '<span class="qa-description-text"> First line of ' || p_name || ' </span><br><span class="qa-description-text">  </span>'
        || '<p><span class="qa-description-text">it&#39;s large</span>' end) || '</div>'""",
    """(case when p_partkey % 16 = 9 then '' else '<div class="description"> Short note </div>' end)""",
    """'<footer>&copy; market</footer></body>'""",
])

# ---- account pages --------------------------------------------------------------------------

ACCOUNT_HTML = " || ".join([
    """'<html><body><ul><li><h3 class="add-title"><a href="/item/' || cast(p_partkey as string) || '">open</a></h3></ul>'""",
    """'<div class="slider-left"><h1> ' || (case when p_partkey % 13 = 0 then 'Account ' else 'Account: ' end) || p_name
        || (case when p_partkey % 13 = 0 then '' else ': x' end) || ' </h1></div>'""",
    """'<aside class="panel-details"><ul><li><b>Price</b><p> ' || (case when p_partkey % 23 = 0 then 'KEs ' else 'KES ' end)""",
    """cast(p_retailprice as string) || ' </p><li><p>' || p_brand || '</p></li>'""",
    """(case when p_partkey % 31 = 0 then '' else '<li><p> ' || p_type || '</p><li><p>' || cast(p_size as string) || ' stars</p>' end)""",
    """'</ul></aside>' || (case when p_partkey % 19 = 0 then '' else '<span class="name"><a href="#"> ' || s_name || ' </a></span>' end)""",
])


def _part_with_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part with one of all suppliers as its seller. The narrow rows are spread before they
    grow into pages, since the small test table is a single file."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    part = part.repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    sellers = supplier.agg(F.max("s_suppkey") + 1).scalar()
    return part.withColumn("s_suppkey", F.pmod("p_partkey", sellers)).join(
        supplier.select("s_suppkey", "s_name"), "s_suppkey")


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, html: one page per part but for every 31st."""
    return _part_with_seller(spark, sf_dir).filter(HAS_PAGE).select(
        F.concat(F.lit(f"{SITE}/part/"), F.col("p_partkey").cast("string")).alias("url"),
        F.expr(DETAIL_HTML).alias("html"))


def detail_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, attempt, html: three reads of each detail page. The first lacks the seller on every
    fourth page, the second is of a changed page, the third failed."""
    pages = detail_pages(spark, sf_dir).withColumn(
        "attempt", F.explode(F.sequence(F.lit(1), F.lit(3))))
    number = F.regexp_extract("url", r"(\d+)$", 1).cast("bigint")
    early = F.when(number % 4 == 0, F.replace("html", F.lit("b-seller-block__name"), F.lit("later")))
    html = F.when(F.col("attempt") == 1, F.coalesce(early, F.col("html"))).when(
        F.col("attempt") == 2, F.replace("html", F.lit("&amp; more"), F.lit("&amp; changed")))
    return pages.select("url", "attempt", html.alias("html"))


# every sixth page is stored a second time, cut off before its attributes
STORED_TWICE = "(p_partkey % 6 = 0)"


def arrived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, fetched, html: the detail pages as they arrived. Some came twice, the later one half-empty."""
    pages = detail_pages(spark, sf_dir).withColumn("p_partkey", F.regexp_extract("url", r"(\d+)$", 1).cast("bigint"))
    copies = F.when(F.expr(STORED_TWICE), F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(1)))
    cut = F.substring_index("html", '<div class="b-advert-attributes-wrapper">', 1)
    return pages.withColumn("fetched", F.explode(copies)).select(
        "url", "fetched", F.when(F.col("fetched") == 2, cut).otherwise(F.col("html")).alias("html"))


def broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, html: the detail pages; some are no page at all, some are cut off before their attributes."""
    pages = detail_pages(spark, sf_dir).withColumn("n", F.regexp_extract("url", r"(\d+)$", 1).cast("bigint"))
    cut = F.substring_index("html", '<div class="b-advert-attributes-wrapper">', 1)
    html = F.when(F.col("n") % 13 == 1, "Service unavailable").when(F.col("n") % 13 == 2, F.lit(None)).when(
        F.col("n") % 13 == 3, "  \n").when(F.expr("n % 6 = 0"), cut).otherwise(F.col("html"))
    return pages.select("url", html.alias("html"))


def broken_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, attempt, html, failed_at: the reads of detail_reads, of which some broke off between two fields. The first
    breaks off after three on every fifth page, the second after as many as the key tells, the third at once."""
    reads = detail_reads(spark, sf_dir).withColumn("n", F.regexp_extract("url", r"(\d+)$", 1).cast("bigint"))
    first = F.when(F.col("n") % 5 == 0, 3)
    second = F.when(F.col("n") % 16 != 15, F.col("n") % 16)
    failed = F.when(F.col("attempt") == 1, first).when(F.col("attempt") == 2, second).otherwise(0)
    return reads.select("url", "attempt", "html", failed.cast("int").alias("failed_at"))


def at_minute(number, later: int = 0):
    """A time that goes up with a key."""
    return F.timestamp_seconds(F.lit(1_700_000_000) + (number + later) * 60)


# An account listing holds twenty links a page; every fifth page holds none, some links come twice, and
# attribute values are written in all forms that HTML has.
ACCOUNT_PAGE = "(cast(floor(p_partkey / 20.0) as bigint) + 1)"
NO_LINKS = "(page % 5 = 4)"
ACCOUNT_LINK = """(case p_partkey % 4 when 0 then '<a href="/item/' || cast(p_partkey as string) || '">'
 when 1 then '<A class=x HREF = \\'/item/' || cast(p_partkey as string) || '\\'>'
 when 2 then '<a href=/item/' || cast(p_partkey as string) || '>'
 else '<a title="a > b" href="&#47;item/' || cast(p_partkey - p_partkey % 8 % 7 as string) || '">' end)"""


def account_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, html: the pages of the account listing."""
    links = table(spark, sf_dir, "part").select(
        F.expr(ACCOUNT_PAGE).alias("page"), "p_partkey",
        F.concat(F.lit('<li><h3 class="add-title">'), F.expr(ACCOUNT_LINK), F.lit("open <b>it</b> now</a></h3>")).alias("link"))
    # twenty rows a group
    in_order = F.array_sort(F.collect_list(F.struct("p_partkey", "link")))
    pages = links.groupBy("page").agg(F.array_join(F.transform(in_order, lambda x: x["link"]), "").alias("links"))
    body = F.when(F.expr(NO_LINKS), F.lit("")).otherwise(F.col("links"))
    return pages.select(
        F.col("page").alias("page_id"), F.concat(F.lit(f"{ACCOUNT_SITE}/accounts?page="), F.col("page").cast("string")).alias("url"),
        F.concat(F.lit('<html><body><a href="/about">about</a><ul>'), body, F.lit("</ul></body></html>")).alias("html"))


def account_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_with_seller(spark, sf_dir).select(
        F.concat(F.lit(f"{ACCOUNT_SITE}/item/"), F.col("p_partkey").cast("string")).alias("url"),
        F.expr(ACCOUNT_HTML).alias("html"))


# ---- fetch log and snapshots ----------------------------------------------------------------

HTTP_CODE = ("(case event_type when 'signup' then 404 when 'purchase' then 429 "
             "when 'error' then 503 else 200 end)")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per attempt: the user stands for the URL, the event type for the status."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("url"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
        F.col("event_type").alias("status"), F.expr(f"cast({HTTP_CODE} as bigint)").alias("http_status"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts per page, numbered in time; the value tells whether one is complete. The job keeps
    the first few only, which Spark turns into a limit per page before the shuffle."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    in_time = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    return events.withColumn("attempt", F.row_number().over(in_time).cast("bigint"))
