"""The expected result of each registered query, as SQL over the base tables."""

from __future__ import annotations

from fixtures import render as r
from gleanframe.operators.records import READ_ORDER
from gleanframe.schemas import DETAIL_16

_READABLE = "page_num % 50 not in (7, 9)"

# every advert of a response with records, in listing order
_LISTED = f"""placed as (
  select *, {r.PAGE} as page_num, {r.POS} as pos, {r.KEY} as ukey, {r.TITLE} as title from part),
listed as (select * from placed where page_num % 50 not in (4, 7, 9))"""

_RESPONSES = f"""adverts as (
  select {r.PAGE} as page_num, string_agg({r.ADVERT_JSON}, ',' order by p_partkey) as adverts
  from part group by 1),
total as (select max(page_num) as n_responses from adverts),
responses as (select page_num, {r.BODY} as body from adverts, total)"""

_READ = f"""numbered as (select {r.PAGE} as page_num, count(*) as n from part group by 1),
total as (select max(page_num) as n_responses from numbered),
listing as (
  select page_num, case when {r.EMPTY} then 0 else n end as n_adverts,
    case when {r.NO_TOTAL} then 1 else n_responses + 5 end as total_pages,
    case when page_num < n_responses
      then '{r.API}?page=' || cast(page_num + 1 as varchar) end as next_url
  from numbered, total where {_READABLE})"""

_ATTRS_LAST = f"""case when {r.HAS_ATTRS} then cast(p_size * 10 as varchar) || ' sqm' end as property_size_sqm,
  case when {r.HAS_ATTRS} then cast(p_size as varchar) end as bedrooms,
  case when {r.HAS_ATTRS} then cast({r.BATHS} as varchar) end as bathrooms,
  case when {r.HAS_ATTRS} and {r.EXACT_FURNISHING} then p_type end as furnishing,
  case when {r.HAS_ATTRS} then {r.OWNER} end as listing_by"""

_ATTRS_FIRST = f"""case when {r.HAS_ATTRS} then {r.ROOMS} end as bedrooms,
  case when {r.HAS_ATTRS} then cast({r.BATHS} as varchar) || ' bathrooms' end as bathrooms,
  case when {r.HAS_ATTRS} then cast(p_size * 10 as varchar) || ' sqm' end as size,
  case when {r.HAS_ATTRS} and {r.EXACT_FURNISHING} then p_type end as furnishing"""

_RECORD_14 = f"""{_LISTED}, record_14 as (
  select page_num, pos, title,
    case when {r.HAS_PRICE} then p_retailprice end as rent_per_period,
    case when {r.HAS_PRICE} then 'per month' end as rent_period,
    p_brand as region, {_ATTRS_LAST},
    cast(p_size as bigint) as user_id, p_partkey % 3 = 0 as is_owner,
    case when p_partkey % 5 <> 0 then true end as can_view_contacts, 'active' as status,
    '/part/' || cast(ukey as varchar) as property_url, ukey
  from listed)"""

_RECORD_16 = f"""{_LISTED}, attrs as (select *, {_ATTRS_FIRST} from listed),
record_16 as (
  select page_num, pos, title, 'Region/' || p_brand as location,
    replace(bedrooms, ' bedrooms', '') as type, bedrooms, bathrooms,
    cast(null as varchar) as address, 'Estate ' || cast(p_size as varchar) as estate, size,
    cast(null as varchar) as condition, furnishing, cast(null as varchar) as toilets,
    case when {r.HAS_PRICE} then 'KSh ' || cast(p_retailprice as varchar) end as price_rent,
    case when {r.HAS_PRICE} then 'KSh ' || cast(p_retailprice as varchar) end as price_with_period,
    cast(null as varchar) as seller_or_agent_name, cast(null as varchar) as time_on_site,
    '{r.SITE}/part/' || cast(ukey as varchar) as property_url
  from attrs)"""

# parts with their seller, and what their detail page shows
_PAGED = f"""sellers as (select max(s_suppkey) + 1 as n from supplier),
paged as (
  select p.*, s.s_name, '{r.SITE}/part/' || cast(p_partkey as varchar) as url
  from part p, sellers, supplier s
  where s.s_suppkey = p.p_partkey % sellers.n and {r.HAS_PAGE})"""

_TILES = f"""{_PAGED}, tile as (
  select p_partkey, url, 1 as ord, 'estate name' as key,
    case when p_partkey % 37 <> 1 then 'Estate ' || p_brand end as value
  from paged where p_partkey % 13 <> 4
  union all select p_partkey, url, 2, 'built', '2010' from paged where p_partkey % 10 = 6
  union all select p_partkey, url, 3, 'condition', p_type from paged where p_partkey % 11 <> 3
  union all select p_partkey, url, 4, 'furnishing', 'Furnished' from paged
  union all select p_partkey, url, 5, 'property size', cast(p_size * 10 as varchar) || ' sqm' from paged
  union all select p_partkey, url, 6, 'toilets', cast(p_partkey % 3 + 1 as varchar) || ' toilets'
    from paged where p_partkey % 7 <> 2
  union all select p_partkey, url, 7, 'bathrooms', cast(p_partkey % 4 + 1 as varchar) || ' baths' from paged
  union all select p_partkey, url, 8, 'furnishing', case when p_partkey % 41 <> 6 then 'Semi' end from paged)"""

_ESTATE = ("case when p_partkey % 13 = 4 then null when p_partkey % 37 = 1 then '' "
           "else 'Estate ' || p_brand end")
_ANY_CONDITION = ("case when p_partkey % 10 = 6 then '2010' "
                  "when p_partkey % 11 <> 3 then p_type end")
_LAST_CHAIN = """cast(p_size * 10 as varchar) || ' sqm' as property_size,
  case when p_partkey % 11 <> 3 then p_type end as condition,
  case when p_partkey % 41 <> 6 then 'Semi' end as furnishing"""
_BEDROOMS = ("case when p_partkey % 53 <> 9 then cast(p_size as varchar) "
             "|| case when p_partkey % 5 = 0 then ' bdrm' else ' Bedrooms' end end")
_BATHROOMS = "case when p_partkey % 53 <> 9 then cast(p_partkey % 4 + 1 as varchar) || ' bathrooms' end"
_TOILETS = ("case when p_partkey % 7 <> 2 then cast(p_partkey % 3 + 1 as varchar) || ' toilets' "
            "when p_partkey % 53 <> 9 and p_partkey % 3 = 0 "
            "then cast(p_partkey % 5 as varchar) || ' toilets' end")
_LOCATION = ("case when p_partkey % 47 = 4 then null when p_partkey % 19 = 3 then 'Central' "
             "else 'Region/' || p_brand end")

_DETAIL_16 = f"""{_PAGED}, detail_16 as (
  select p_name || ' & more' as title, {_LOCATION} as location, {_BEDROOMS} as type,
    {_LOCATION} as property_address,
    case when p_partkey % 47 <> 4 and p_partkey % 19 <> 3 then p_brand end as estate_name,
    {_LAST_CHAIN}, {_TOILETS} as toilets, {_BEDROOMS} as bedrooms, {_BATHROOMS} as bathrooms,
    'KSh ' || cast(p_retailprice as varchar) as price_rent,
    'KSh ' || cast(p_retailprice as varchar)
      || case when p_partkey % 9 = 5 then '' else ' per month' end as price_with_period,
    case when p_partkey % 43 <> 8 then s_name end as seller_or_agent_name,
    case when p_partkey % 43 <> 8 then 'years on Market' else 'Replies fast' end as time_on_site,
    url as property_url
  from paged)"""

_DETAIL_8 = f"""{_PAGED}, detail_8 as (
  select p_partkey, url,
    case when p_partkey % 8 <> 1 then ' About ' || p_name || ' '
      when p_partkey % 16 <> 9 then ' Short note ' end as description,
    case when p_partkey % 47 = 4 then null when p_partkey % 19 = 3 then 'Central'
      else 'Region/' || p_brand || ', x' end as property_address,
    {_ESTATE} as estate_name, {_ANY_CONDITION} as condition,
    case when p_partkey % 7 <> 2 then cast(p_partkey % 3 + 1 as varchar)
      else cast(p_partkey % 4 + 1 as varchar) end as toilets,
    case when p_partkey % 43 <> 8 then s_name end as ranter_or_agent_name,
    'years on Market' as time_on_site,
    case when p_partkey % 21 = 10 then null when p_partkey % 21 = 11 then ''
      else 'First line of ' || p_name || chr(10) || 'it''s large' end as property_details
  from paged)"""

_ACCOUNTS = f"""sellers as (select max(s_suppkey) + 1 as n from supplier),
account as (
  select p.*, s.s_name, '{r.ACCOUNT_SITE}/item/' || cast(p_partkey as varchar) as url,
    case when p_partkey % 13 = 0 then 'description' when p_partkey % 23 = 0 then 'price'
      when p_partkey % 31 = 0 then 'category' when p_partkey % 19 = 0 then 'seller' end as failed_field
  from part p, sellers, supplier s where s.s_suppkey = p.p_partkey % sellers.n)"""

_HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"
_LINKS = """found as (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) as hrefs from pages),
links as (select page_id, url, unnest(hrefs) as href, generate_subscripts(hrefs, 1) - 1 as pos from found)"""


def _decoded(text: str) -> str:
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        text = f"replace({text}, '{entity}', '{char}')"
    return f"nullif(trim(regexp_replace({text}, '&amp;?', '&', 'g')), '')"


_FIRST_TEXTS = f"""select page_id,
  {_decoded("regexp_extract(html, '<title>([^<]*)', 1)")} as title,
  {_decoded("regexp_extract(html, '<div class=" + '"ad"' + ">([^<]*)', 1)")} as ad,
  {_decoded("regexp_extract(html, '<h1>([^<]*)', 1)")} as h1
from pages"""


def _schedule(lowered: str, priority: str = "user_id % 7") -> str:
    return f"""with ranked as (
  select user_id as url, event_id, {priority} as p0,
    row_number() over (partition by user_id order by ts, event_id) as attempt
  from events where event_type = 'error')
select url, event_id, attempt,
  case when attempt <= 5 then cast(least(power(2, attempt - 1), 30) as bigint) end as delay,
  case when attempt <= 5 then cast(p0 - ({lowered}) as bigint) end as priority,
  attempt > 5 as gave_up
from ranked"""


_RETRY = _schedule("attempt * (attempt + 1) / 2", "0")
_PAGE_NUM = (r"try_cast(coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), ''), '1') as bigint)")
_16 = ", ".join(DETAIL_16)
_UNION = f"""{_RECORD_16}, {_DETAIL_16}, feed as (
  select title, location, type, address as property_address, estate as estate_name,
    size as property_size, condition, furnishing, toilets, bedrooms, bathrooms, price_rent,
    price_with_period, seller_or_agent_name, time_on_site, property_url from record_16
  union all select {_16} from detail_16)"""
_READ_BACK = ", ".join(f"nullif({c}, '') as {c}" for c in DETAIL_16)
_ENRICHED = f"""{_RECORD_14}, {_DETAIL_8}, first_listed as (
  select * from record_14 where ukey is not null
  qualify row_number() over (partition by ukey order by page_num, pos) = 1)"""

_LINK_SITE = "regexp_extract(link, '^https?://([^/?#:]+)', 1)"
# the first read counts when it is complete, else the second; the third failed
_FIRST_READ = ("p_partkey % 4 <> 0 and p_partkey % 11 <> 3 and p_partkey % 41 <> 6 and p_partkey % 43 <> 8")
_SALE = _UNION.replace("p_name || ' & more' as title",
                       f"p_name || case when {_FIRST_READ} then ' & more' else ' & changed' end as title")


# ---- partial reads, strict responses, rejects, counters

_SECOND_READ = "p_partkey % 16 = 15 and p_partkey % 11 <> 3 and p_partkey % 41 <> 6 and p_partkey % 43 <> 8"
_READS = f"""{_DETAIL_16}, keyed as (
  select *, cast(regexp_extract(property_url, '([0-9]+)$', 1) as bigint) as p_partkey from detail_16),
reads as (
  select *, seller_or_agent_name as seller_2, case when p_partkey % 4 <> 0 then seller_or_agent_name end as seller_1,
    {_FIRST_READ} and p_partkey % 5 <> 0 as first_done, {_SECOND_READ} as second_done
  from keyed)"""


def _read_value(place: int, field: str) -> str:
    first = {"seller_or_agent_name": "seller_1"}.get(field, field)
    second = {"title": "replace(title, '& more', '& changed')"}.get(field, field)
    return (f"case when first_done or not second_done and p_partkey % 16 <= {place} and p_partkey % 16 <> 15 "
            f"then {first} else {second} end as {field}")


_REACHED = "(first_done or p_partkey % 5 <> 0 or p_partkey % 16 = 15)"
_STRICT_READ = f"""strict as (select *, {r.PAGE} as page_num, {r.POS} as pos from part),
answered as (select page_num, count(*) as n from strict group by 1)"""
_STRICT_GOOD = "page_num % 20 not in (3, 5, 6, 7, 9, 10, 13)"
_AT = "'$.adverts_list.adverts[' || cast(pos as varchar) || ']'"
_BROKEN = """case when p_partkey % 13 in (2, 3) then 'no_page' when p_partkey % 13 = 1 then 'not_html'
  when p_partkey % 6 = 0 then 'missing_element' end"""


ORACLES: dict[str, str] = {
    "src_listing_payloads": f"with {_RESPONSES} select page_num, body from responses",
    "src_listing_files": f"with {_RESPONSES} select page_num, body || chr(10) as body from responses",
    "src_pages": "select page_id, url, html from pages",
    "sink_csv_overwrite": f"with {_UNION} select {_READ_BACK} from feed",
    "src_csv_head": f"with {_UNION}, written as (select {_READ_BACK} from feed) select * from written "
                    f"order by {', '.join(c + ' nulls first' for c in DETAIL_16)} limit 5",
    "json_unwrap": f"with {_RESPONSES}, cut as (select page_num, "
                   r"regexp_extract(body, '(?s)(\{.*\})', 1) as json from responses) "
                   "select * from cut where json <> ''",
    "json_rejects": f"with {_RESPONSES} select page_num, "
                    f"case when {r.NO_JSON} then 'no_json' else 'malformed' end as reason "
                    f"from responses where {r.NO_JSON} or {r.CUT_OFF}",
    "json_defaults": f"with {_READ} select page_num, n_adverts, total_pages, next_url from listing",
    "non_empty_listing": f"with {_READ} select page_num, next_url from listing where n_adverts > 0",
    "listing_explode": f"with {_LISTED} select page_num, pos, title, "
                       "'/part/' || cast(ukey as varchar) as property_url from listed",
    "attrs_last_wins": f"with {_LISTED} select page_num, pos, {_ATTRS_LAST} from listed",
    "attrs_first_match": f"with {_LISTED} select page_num, pos, {_ATTRS_FIRST} from listed",
    "listing_record_14": f"with {_RECORD_14} select * exclude (ukey) from record_14",
    "listing_record_16": f"with {_RECORD_16} select * from record_16",
    "domain_filter": f"select page_id, url from pages where {_HOST} = 'example.net' "
                     f"or {_HOST} like '%.example.net'",
    "domain_filter_table": f"with hosts as (select page_id, url, {_HOST} as host from pages), "
                           r"domains as (select distinct regexp_replace(host, '^(www|blog|m)\.', '') as d "
                           "from hosts where url like '%?page=%' or url like '%&page=%') "
                           "select page_id, url from hosts where exists (select 1 from domains "
                           "where host = d or ends_with(host, '.' || d))",
    "block_detect": "select doc_id, contains(lower(text), 'license') or contains(lower(text), 'all rights') "
                    "as blocked from documents",
    "retryable_filter": f"select event_id, user_id as url, cast({r.HTTP_CODE} as bigint) as http_status "
                        "from events where event_type in ('purchase', 'error')",
    "extract_links": f"with {_LINKS} select page_id, pos, href from links",
    "extract_links_selected": f"with {_PAGED} select url, cast(0 as bigint) as pos, '/part/' || cast(p_partkey + 1 as varchar) as href "
                              "from paged union all select url, 1, '//' || cast(p_partkey as varchar) from paged",
    "absolutize_urls": f"with {_LINKS} select page_id, pos, '{r.SITE}/' || ltrim(href, '/') as stripped_url, "
                       f"'{r.SITE}' || href as prefixed_url, "
                       "regexp_extract(url, '^(https?://[^/]+)', 1) || href as resolved_url from links",
    "extract_first_text": _FIRST_TEXTS,
    "extract_all_texts": f"""with found as (
  select page_id, regexp_extract_all(html, '<a href="[^"]*">([^<]+)', 1) as texts from pages)
select page_id, cast(len(texts) as bigint) as n_texts, {_decoded("array_to_string(texts, '|')")} as texts
from found""".replace("as n_texts, nullif(trim(", "as n_texts, coalesce(nullif(trim(").replace(
        "'g')), '') as texts", "'g')), ''), '') as texts"),
    "kv_table_explode": f"with {_TILES} select url, row_number() over (partition by p_partkey order by ord) - 1 as pos, "
                        "key, value from tile",
    "kv_pick_exact": f"with {_PAGED} select url, {_ESTATE} as estate_name from paged",
    "kv_pick_any_keyword": f"with {_PAGED} select url, {_ANY_CONDITION} as condition from paged",
    "kv_pick_last_chain": f"with {_PAGED} select url, {_LAST_CHAIN}, "
                          "case when p_partkey % 7 <> 2 then cast(p_partkey % 3 + 1 as varchar) || ' toilets' end "
                          "as toilets from paged",
    "icon_classify": f"with {_PAGED} select url, {_BEDROOMS} as bedrooms, {_BATHROOMS} as bathrooms, "
                     f"{_TOILETS} as toilets from paged",
    "detail_record_16": f"with {_DETAIL_16} select * from detail_16",
    "detail_fields_8": f"with {_DETAIL_8} select * exclude (p_partkey) from detail_8",
    "account_record_7": f"with {_ACCOUNTS} select url, ' ' || p_name || ': x' as description, "
                        "' ' || cast(p_retailprice as varchar) as price, p_brand as level, p_type as category, "
                        "cast(p_size as varchar) || ' stars' as rating, s_name as seller "
                        "from account where failed_field is null",
    "account_rejects": f"with {_ACCOUNTS} select url, failed_field from account where failed_field is not null",
    "enrich_listing_with_detail": f"with {_ENRICHED} select l.* exclude (page_num, pos, ukey), "
                                  "d.* exclude (p_partkey, url) from first_listed l "
                                  "join detail_8 d on d.p_partkey = l.ukey",
    "listing_without_detail": f"with {_ENRICHED} select '{r.SITE}' || property_url as url, page_num, pos "
                              "from first_listed where ukey % 31 = 5",
    "frontier_unseen": f"with {_LINKS}, full_links as (select page_id, url like '%?page=%' or url like '%&page=%' "
                       "as on_listing, regexp_extract(url, '^(https?://[^/]+)', 1) || href as link from links) "
                       "select link as url, min(page_id) as first_page, count(*) as n_links from full_links "
                       "where link not in (select link from full_links where on_listing) group by link",
    "dedup_keep_first": f"with {_RECORD_14} select * exclude (ukey) from record_14 "
                        "qualify row_number() over (partition by property_url order by page_num, pos) = 1",
    "dedup_keep_first_text": "select min(doc_id) as doc_id, text, arg_min(source, doc_id) as source "
                             "from documents group by text",
    "dedup_dropped_report": f"with {_RECORD_14}, dropped as (select page_num, pos, title, property_url from record_14 "
                            "qualify row_number() over (partition by property_url order by page_num, pos) > 1) "
                            "select *, count(*) as copies from dropped group by all",
    "status_histogram": "select event_type as status, count(*) as responses from events group by 1",
    "page_yield": f"with {_READ}, urls as (select {r.PAGE} as page_num, count({r.KEY}) as n_urls from part group by 1) "
                  "select page_num, n_adverts as items, case when n_adverts > 0 then n_urls else 0 end "
                  "+ case when next_url is not null and page_num < total_pages then 1 else 0 end as requests "
                  "from listing join urls using (page_num)",
    "required_field_audit": f"with {_RECORD_14} select page_num, pos, property_url, "
                            "concat_ws(',', case when title = '' then 'title' end, "
                            "case when rent_per_period is null then 'price' end) as missing_fields "
                            "from record_14 where title = '' or rent_per_period is null",
    "required_field_totals": f"with {_RECORD_14} select 'title' as field, count(*) as records from record_14 "
                             "where title = '' union all select 'price', count(*) from record_14 "
                             "where rent_per_period is null",
    "failure_report": "select cast(json_extract_string(props, '$.k') as bigint) % 4 as kind, user_id as url, "
                      "count(*) as failures, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us "
                      "from events where event_type = 'error' group by 1, 2",
    "failure_totals": "select cast(json_extract_string(props, '$.k') as bigint) % 4 as kind, count(*) as failures, "
                      "count(distinct user_id) as urls from events where event_type = 'error' group by 1",
    "best_of_n_complete": """with tried as (
  select user_id, event_type, event_id, value,
    row_number() over (partition by user_id, event_type order by ts, event_id) as attempt from events),
kept as (select *, value >= 100 as complete from tried where attempt <= 3)
select user_id, event_type, attempt, event_id, value, complete from kept
qualify row_number() over (partition by user_id, event_type
  order by complete desc, case when complete then attempt else -attempt end) = 1""",
    "retry_schedule": _schedule("attempt * (attempt + 1) / 2"),
    "retry_schedule_exception": _schedule("attempt"),
    "frontier_ordered": f"select s.url, s.event_id, s.priority from ({_RETRY}) s join events e using (event_id) "
                        "where not s.gave_up order by s.priority desc, e.ts, e.event_id limit 100",
    "union_records": f"with {_UNION} select * from feed",
    "merge_records": f"""with {_RECORD_16}, {_DETAIL_16}, first_listed as (
  select title, location, type, address as property_address, estate as estate_name,
    size as property_size, condition, furnishing, toilets, bedrooms, bathrooms, price_rent,
    price_with_period, seller_or_agent_name, time_on_site, property_url from record_16
  where property_url is not null
  qualify row_number() over (partition by property_url order by page_num, pos) = 1)
select {', '.join(f'coalesce(d.{c}, l.{c}) as {c}' for c in DETAIL_16)}
from first_listed l full outer join detail_16 d on l.property_url = d.property_url""",
    "page_number": f"select page_id, {_PAGE_NUM} as page_num, "
                   "try_cast(string_split(url, '=')[2] as bigint) as number_after_equals from pages",
    "next_page_url": f"""with n as (select *, {_PAGE_NUM} as page_num,
    try_cast(string_split(url, '=')[2] as bigint) as after from pages)
select page_id, string_split(url, '=')[1] || '=' || cast(after + 1 as varchar) as next_counted_url,
  '{r.SITE}/{r.SLUG}?page=' || cast(page_num + 1 as varchar) as next_html_url,
  '{r.API}?slug={r.SLUG}&init_page=true&page=' || cast(page_num as varchar) || '&webp=false&lsmid='
    || cast(page_id as varchar) as api_url
from n""",
    "page_plan": f"with {_READ}, span as (select min(page_num) as lo, max(total_pages) as hi from listing "
                 "where page_num < total_pages) "
                 f"select '{r.LISTING}' as listing, g as page_num from span, "
                 "generate_series(lo + 1, hi) as t(g) where g not in (select page_num from numbered)",
    "page_gap_report": f"with {_READ}, span as (select max(total_pages) as hi from listing) "
                       f"select '{r.LISTING}' as listing, g as page_num from span, "
                       "generate_series(1, hi) as t(g) where g not in (select page_num from listing)",
    "next_pointer_closure": """with recursive pointer as (
  select p_partkey as page, p_partkey + 250 as next_page from part
  where p_size <> 50 and p_partkey + 250 <= (select max(p_partkey) from part)),
reached(page, depth) as (
  select p_partkey, 0 from part where p_partkey not in (select next_page from pointer)
  union all select next_page, depth + 1 from reached join pointer using (page)
    where page % 250 % 3 <> 0 or page // 250 < 3)
select page, cast(min(depth) as bigint) as depth from reached group by page""",
    "account_flow": f"""with {_ACCOUNTS}, placed as (select {r.ACCOUNT_PAGE} as page, p_partkey,
  case when p_partkey % 4 = 3 then p_partkey - p_partkey % 8 % 7 else p_partkey end as item from part),
asked as (select item, min(page) as first_page from placed where not {r.NO_LINKS} group by item),
found as (
  select '{r.ACCOUNT_SITE}/item/' || cast(item as varchar) as url, first_page,
    case when p_partkey is null then 'missing' when failed_field is null then 'record' else 'reject' end as kind,
    account.* exclude (url)
  from asked left join account on p_partkey = item and item % 11 <> 7)
select url, first_page, kind,
  case when p_partkey % 13 <> 0 then ' ' || p_name || ': x' end as description,
  case when p_partkey % 23 <> 0 then ' ' || cast(p_retailprice as varchar) end as price,
  p_brand as level, case when p_partkey % 31 <> 0 then p_type end as category,
  case when p_partkey % 31 <> 0 then cast(p_size as varchar) || ' stars' end as rating,
  case when p_partkey % 19 <> 0 then s_name end as seller, failed_field
from found
union all select '{r.ACCOUNT_SITE}/accounts?page=' || cast(page + 1 as varchar), page, 'next_page',
  null, null, null, null, null, null, null
from (select distinct page from placed where not {r.NO_LINKS})""",
    "account_links": f"""with placed as (select {r.ACCOUNT_PAGE} as page, p_partkey,
  case when p_partkey % 4 = 3 then p_partkey - p_partkey % 8 % 7 else p_partkey end as item from part)
select page as page_id, row_number() over (partition by page order by p_partkey) as pos,
  '/item/' || cast(item as varchar) as href from placed where not {r.NO_LINKS}
union all select distinct page, 0, '/about' from placed""",
    "account_texts": f"""with placed as (select {r.ACCOUNT_PAGE} as page, count(*) as n from part group by 1)
select page as page_id, 'about' || case when {r.NO_LINKS} then '' else repeat('|open|now', n) end as texts from placed""",
    "sale_listing_flow": f"with {_SALE} select * from feed",
    "link_flow": f"with {_LINKS}, full_links as (select page_id, url like '%?page=%' or url like '%&page=%' "
                 "as on_listing, regexp_extract(url, '^(https?://[^/]+)', 1) || href as link from links) "
                 "select link as url, min(page_id) as first_page, count(*) as n_links from full_links "
                 f"where ({_LINK_SITE} = 'example.net' or {_LINK_SITE} like '%.example.net') "
                 "and link not in (select link from full_links where on_listing) group by link",
    "stream_extract": _FIRST_TEXTS,
    "stream_dedup": "select user_id as url, event_id from events "
                    "qualify row_number() over (partition by user_id order by ts, event_id) = 1",
    "stream_status_counts": "select event_type as status, count(*) as responses from events group by 1",
    "stream_retry_state": _RETRY,
    "best_of_n_partial": f"with {_READS} select property_url, case when first_done then 1 when second_done then 2 "
                         f"else 3 end as attempt, {', '.join(_read_value(k, f) for k, f in enumerate(READ_ORDER))}, "
                         f"first_done or second_done as complete from reads where {_REACHED}",
    "partial_rejects": f"with {_READS} select property_url, 3::bigint as reads, "
                       f"({READ_ORDER}::varchar[])[greatest(3, p_partkey % 16) + 1] as failed_field "
                       f"from reads where not {_REACHED}",
    "json_defaults_strict": f"""with {_STRICT_READ}
select page_num, case when page_num % 20 = 4 then 0 else n end as n_adverts,
  case page_num % 20 when 4 then '1' when 8 then '1' when 12 then '"12"' else '99' end as total_pages,
  case when page_num % 20 not in (4, 11) then 'n/' || cast(page_num as varchar) end as next_url
from answered where {_STRICT_GOOD}""",
    "listing_record_raw": f"""with {_STRICT_READ}
select page_num, pos, '"' || p_brand || '"' as title,
  case when p_partkey % 23 = 3 then 'null' when p_partkey % 23 = 0 then null
    when p_partkey % 2 = 0 then p_size::varchar else '"' || p_size::varchar || '"' end as rent_per_period,
  case when p_partkey % 23 not in (0, 3) then '"per month"' end as rent_period,
  case when p_partkey % 29 <> 0 then p_size::varchar end as bedrooms
from strict where {_STRICT_GOOD} and page_num % 20 <> 4 and p_partkey % 37 <> 5
  and p_partkey % 29 not in (1, 2, 3, 4) and p_partkey % 23 not in (1, 2)""",
    "strict_rejects": f"""with {_STRICT_READ}
select page_num, null::bigint as pos, case page_num % 20 when 3 then '$.adverts_list' when 13 then '$.adverts_list'
    when 7 then '$.adverts_list.total_pages' when 9 then '$' else '$.adverts_list.adverts' end as path,
  case page_num % 20 when 6 then 'wrong_type' when 13 then 'wrong_type' when 9 then 'malformed' else 'null_value' end as reason
from answered where page_num % 20 in (3, 5, 6, 7, 9, 13)
union all
select page_num, pos, {_AT} || case when p_partkey % 37 = 5 then '' when p_partkey % 29 in (1, 2) then '.attrs'
    when p_partkey % 29 = 3 then '.attrs[1].value' when p_partkey % 29 = 4 then '.attrs[0]' else '.price_obj' end,
  case when p_partkey % 37 = 5 then 'wrong_type' when p_partkey % 29 = 1 then 'null_value'
    when p_partkey % 29 = 3 then 'missing_key' when p_partkey % 29 in (2, 4) then 'wrong_type'
    when p_partkey % 23 = 1 then 'null_value' else 'wrong_type' end
from strict where {_STRICT_GOOD} and page_num % 20 <> 4
  and (p_partkey % 37 = 5 or p_partkey % 29 in (1, 2, 3, 4) or p_partkey % 23 in (1, 2))""",
    "detail_rejects": f"with {_PAGED} select url, {_BROKEN} as error_kind, case when {_BROKEN} = 'missing_element' "
                      f"then 'b-advert-attributes-wrapper' else 'html' end as error_field from paged where {_BROKEN} is not null",
    "detail_accepted": f"with {_READS} select {_16} from reads where {_BROKEN} is null",
    "flow_counters": f"""with {_RECORD_14}, {_READ}, urls as (
  select {r.PAGE} as page_num, count({r.KEY}) as n_urls from part group by 1)
select 'responses' as counter, count(*) as value from listing
union all select 'requests', sum(case when n_adverts > 0 then n_urls else 0 end
  + case when next_url is not null and page_num < total_pages then 1 else 0 end)::bigint from listing join urls using (page_num)
union all select 'items', count(*) from record_14
union all select 'items_lacking_fields', count(*) from record_14 where title = '' or rent_per_period is null
union all select 'missing_title', count(*) from record_14 where title = ''
union all select 'missing_price', count(*) from record_14 where rent_per_period is null
union all select 'missing_region', count(*) from record_14 where region is null
union all select 'duplicates', count(ukey) - count(distinct ukey) from record_14""",
}
ORACLES["rent_listing_flow"] = ORACLES["enrich_listing_with_detail"]
ORACLES["frontier_increment"] = ORACLES["frontier_unseen"]
ORACLES["next_pointer_increment"] = ORACLES["next_pointer_closure"]
ORACLES["stream_enrich"] = ORACLES["enrich_listing_with_detail"]
ORACLES["phrase_hits"] = r"""with words as (
  select item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from benchmark),
phrases as (
  select distinct w[k] || ' ' || w[k + 1] as phrase
  from (select w, unnest(range(1, len(w))) as k from words where len(w) > 1)),
texts as (select doc_id, lower(text) as t from documents)
select doc_id, phrase, ((length(t) - length(replace(t, phrase, ''))) / length(phrase))::bigint as hits
from texts join phrases on contains(t, phrase)"""
