"""Reads that break off, responses that are not as they should be, outputs that are replaced, runs that count."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures import render
from gleanframe.functions import html as H
from gleanframe.operators import details, listing, pages, records, strict
from gleanframe.plans import flows
from gleanframe.plans.counters import RunCounters
from gleanframe.plans.run import arguments, run
from gleanframe.sources import csv_table

SF = "/root/testdata/sf0.001"


# ---- partial reads

def by_hand(reads, n=3):
    """Reads (key, attempt, a, b, c, failed_at) one after the other, as a crawler takes them."""
    out, lost = {}, {}
    for key in {r[0] for r in reads}:
        held, record = {}, None
        tried = sorted(r for r in reads if r[0] == key and r[1] <= n)
        for _, attempt, a, b, c, failed_at in tried:
            for place, (name, value) in enumerate((("a", a), ("b", b), ("c", c))):
                if failed_at is None or place < failed_at:
                    held[name] = value
            if failed_at is None and b:
                record = (attempt, held["a"], held["b"], held["c"], True)
                break
        if record is None:
            missing = [f for f in "abc" if f not in held]
            if missing:
                lost[key] = (missing[0], len(tried))
                continue
            record = (tried[-1][1], held["a"], held["b"], held["c"], False)
        out[key] = record
    return out, lost


def test_partial_reads_equal_a_walk_through_them(spark):
    rng = random.Random(7)
    reads = [(key, attempt, rng.choice([None, "x", "y"]), rng.choice([None, "", "z"]), str(key),
              rng.choice([None, 0, 1, 2, 3])) for key in range(300) for attempt in range(1, rng.randrange(2, 6))]
    df = spark.createDataFrame(reads, "k int, attempt int, a string, b string, c string, failed_at int").repartition(5)
    complete = F.coalesce(F.col("b") != "", F.lit(False))
    want, lost = by_hand([tuple((r[0], r[1], *r[2:])) for r in reads])
    got = records.best_of_n_partial(df, ["k"], complete, ["a", "b", "c"]).collect()
    assert {r.k: (r.attempt, r.a, r.b, r.c, r.complete) for r in got} == want
    rejects = records.partial_rejects(df, ["k"], complete, ["a", "b", "c"]).collect()
    assert {r.k: (r.failed_field, r.reads) for r in rejects} == lost
    assert lost and any(not r[-1] for r in want.values())


def test_whole_reads_give_the_same_as_snapshots(spark):
    reads = render.detail_reads(spark, SF)
    payloads = render.listing_payloads(spark, SF)
    plain = flows.sale_listing_flow(payloads, reads, render.SITE)
    marked = flows.sale_listing_flow(payloads, reads.withColumn("failed_at", F.lit(None).cast("int")), render.SITE)
    assert plain.exceptAll(marked).count() == 0 == marked.exceptAll(plain).count()


def test_partial_reads_need_one_shuffle(spark):
    plan = flows.partial_reads(spark.createDataFrame([], "url string, attempt int, html string, failed_at int"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "collect_list" not in text and "Window" not in text


# ---- responses as they are

def responses(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page_num long, body string")


def test_missing_null_and_wrong_type_are_told_apart(spark):
    rows = responses(
        spark, "{}", '{"adverts_list": null}', '{"adverts_list": {}}', '{"adverts_list": {"adverts": null}}',
        '{"adverts_list": {"adverts": {"a": 1}}}', '{"adverts_list": {"total_pages": null}}', "[1, 2]", "{x}", None, "",
        '<p>{"adverts_list": {"adverts": [], "total_pages": "7"}, "next_url": null}</p>')
    good = {r.page_num: (len(r.adverts), r.total_pages.toJson(), r.next_url)
            for r in strict.json_defaults_strict(rows).collect()}
    assert good == {0: (0, "1", None), 2: (0, "1", None), 10: (0, '"7"', None)}
    bad = {r.page_num: (r.path, r.reason) for r in strict.strict_rejects(rows).collect()}
    assert bad == {1: ("$.adverts_list", "null_value"), 3: ("$.adverts_list.adverts", "null_value"),
                   4: ("$.adverts_list.adverts", "wrong_type"), 5: ("$.adverts_list.total_pages", "null_value"),
                   7: ("$", "malformed")}


def test_values_keep_their_types(spark):
    advert = ('{"title": "a {b}", "price_obj": {"value": %s, "period": null}, "is_owner": true, "user_id": 12345678901, '
              '"attrs": [{"name": "Bedrooms", "value": 1}, {"name": "Bedrooms", "value": "2"}]}')
    prices = ["900", '"900"', "900.50", "null", '{"low": 1}', "[1, 2]"]
    body = '{"adverts_list": {"adverts": [' + ", ".join(advert % p for p in prices) + "]}}"
    rows = strict.listing_record_raw(strict.adverts_strict(strict.json_defaults_strict(responses(spark, body))))
    found = strict.as_json(rows).orderBy("pos").collect()
    assert [r.rent_per_period for r in found] == ["900", '"900"', "900.5", "null", '{"low":1}', "[1,2]"]
    assert {(r.bedrooms, r.rent_period, r.is_owner, r.user_id, r.region) for r in found} == {
        ('"2"', "null", "true", "12345678901", None)}


def test_one_bad_advert_does_not_cost_the_others(spark):
    adverts = ['{"title": 1}', "null", '"text"', '{"price_obj": null}', '{"attrs": [{"name": "x"}]}', '{"attrs": [{}, 3]}',
               '{"attrs": [null]}', '{"attrs": {}, "price_obj": 1}', '{"price_obj": {}}']
    rows = responses(spark, '{"adverts_list": {"adverts": [' + ",".join(adverts) + "]}}")
    bad = {r.pos: (r.path.removeprefix("$.adverts_list.adverts"), r.reason) for r in strict.strict_rejects(rows).collect()}
    assert bad == {1: ("[1]", "wrong_type"), 2: ("[2]", "wrong_type"), 3: ("[3].price_obj", "null_value"),
                   4: ("[4].attrs[0].value", "missing_key"), 5: ("[5].attrs[0].name", "missing_key"),
                   6: ("[6].attrs[0]", "wrong_type"), 7: ("[7].attrs", "wrong_type")}
    kept = strict.listing_record_raw(strict.adverts_strict(strict.json_defaults_strict(rows)))
    assert sorted(r.pos for r in kept.collect()) == [0, 8]


# ---- pages that give no record

def test_rejects_name_what_was_wrong(spark):
    good = '<div class="b-advert-attributes-wrapper"></div><div class="b-advert-title-inner">T</div>'
    stored = [("a", good), ("b", None), ("c", " \n"), ("d", "502 bad gateway <3"), ("e", "<html><body><p>x"),
              ("f", good[:20]), ("g", '<!-- <div class="b-advert-attributes-wrapper"> --><p>x</p>')]
    audited = details.detail_audit(spark.createDataFrame(stored, "url string, html string"))
    rejects = {r.url: (r.error_kind, r.error_field, r.message) for r in details.detail_rejects(audited).collect()}
    awaited = "b-advert-attributes-wrapper"
    assert rejects == {
        "b": ("no_page", "html", "nothing stored"), "c": ("no_page", "html", "nothing stored"),
        "d": ("not_html", "html", "no element in 18 characters"),
        "e": ("missing_element", awaited, f"no {awaited} in 16 characters"),
        "f": ("missing_element", awaited, f"no {awaited} in 20 characters"),
        "g": ("missing_element", awaited, f"no {awaited} in 58 characters")}
    (kept,) = details.detail_accepted(audited).collect()
    assert (kept.property_url, kept.title) == ("a", "T")
    plan = audited._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_a_page_that_breaks_the_walk_is_reported(spark, monkeypatch):
    class Breaking(H.PageWalk):
        def __call__(self, page):
            if page and "odd" in page:
                raise ValueError("odd page")
            return super().__call__(page)

    monkeypatch.setattr(pages.H, "PageWalk", Breaking)
    good = '<div class="b-advert-attributes-wrapper">{}</div>'
    rows = spark.createDataFrame([(n, good.format(n)) for n in ("odd", "even")], "url string, html string")
    rejects = details.detail_rejects(details.detail_audit(rows)).collect()
    assert [(r.url, r.error_kind, r.message) for r in rejects] == [("odd", "unreadable", "ValueError: odd page")]


# ---- counters

def test_counters_equal_separate_counts(spark):
    payloads, arrived = render.listing_payloads(spark, SF), render.arrived_pages(spark, SF)
    counters = RunCounters()
    rows = flows.rent_listing_flow(payloads, arrived, render.SITE, render.STAT_PHRASE, counters)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectMetrics") == 3
    bare = flows.rent_listing_flow(payloads, arrived, render.SITE, render.STAT_PHRASE)
    assert plan.count("Scan parquet") == bare._jdf.queryExecution().executedPlan().toString().count("Scan parquet")
    rows.write.format("noop").mode("overwrite").save()
    parsed = listing.parse_listing(payloads)
    found = listing.listing_record_14(listing.listing_explode(parsed))
    lacking = records.required_field_audit(found)
    totals = {r.field: r.records for r in records.required_field_totals(found).collect()}
    with_url = found.filter("property_url is not null")
    assert counters.report() == {
        "responses": parsed.count(), "requests": listing.page_yield(parsed).agg(F.sum("requests")).first()[0],
        "items": found.count(), "items_lacking_fields": lacking.count(),
        **{f"missing_{n}": totals.get(n, 0) for n in records.REQUIRED},
        "duplicates": with_url.count() - with_url.select("property_url").distinct().count()}


def test_counters_of_nothing(spark):
    counters = RunCounters()
    empty = spark.createDataFrame([], "page_num long, body string")
    rows = flows.rent_listing_flow(empty, spark.createDataFrame([], "url string, html string"), "s", "x", counters)
    assert rows.collect() == []
    assert set(counters.report().values()) == {0}


def test_a_run_writes_its_counters(spark, tmp_path):
    p, d, out, c = (str(tmp_path / n) for n in "pdoc")
    render.listing_payloads(spark, SF).write.parquet(p)
    render.detail_pages(spark, SF).write.parquet(d)
    run(spark, arguments(["rent", "--payloads", p, "--pages", d, "--out", out, "--site", render.SITE, "--counters", c]))
    counted = {r.counter: r.value for r in csv_table.read_csv_table(spark, c).collect()}
    assert counted["items"] > 100 and counted["duplicates"] > 0


# ---- replaced output

COLUMNS = ["a", "b"]


def table(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("a"), F.lit("x\ny").alias("b"))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    csv_table.sink_csv_overwrite(table(spark, 30), out, COLUMNS)
    broken = table(spark, 500).withColumn("b", F.when(F.col("a") == "499", F.raise_error(F.lit("lost"))).otherwise(F.col("b")))
    with pytest.raises(Exception, match="lost"):
        csv_table.sink_csv_overwrite(broken, out, COLUMNS)
    assert csv_table.read_csv_table(spark, out).count() == 30
    csv_table.sink_csv_overwrite(table(spark, 7), out, COLUMNS)
    assert csv_table.read_csv_table(spark, out).count() == 7
    assert [f.name for f in tmp_path.iterdir()] == ["out"]


def test_an_output_may_be_made_from_the_former_one(spark, tmp_path):
    out = str(tmp_path / "out")
    csv_table.sink_csv_overwrite(table(spark, 10), out, COLUMNS)
    csv_table.sink_csv_overwrite(csv_table.read_csv_table(spark, out, "a string, b string").filter("a < 5"), out, COLUMNS)
    assert csv_table.read_csv_table(spark, out).count() == 5


def test_a_run_lost_between_the_renames(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    csv_table.sink_csv_overwrite(table(spark, 10), out, COLUMNS)
    real, calls = csv_table.Replacing._rename, []

    def lost(self, old, new):
        calls.append(old)
        if len(calls) == 2:
            raise KeyboardInterrupt
        real(self, old, new)

    monkeypatch.setattr(csv_table.Replacing, "_rename", lost)
    with pytest.raises(KeyboardInterrupt):
        csv_table.sink_csv_overwrite(table(spark, 3), out, COLUMNS)
    monkeypatch.setattr(csv_table.Replacing, "_rename", real)
    assert csv_table.read_csv_table(spark, out).count() == 10
    csv_table.sink_csv_overwrite(table(spark, 4), out, COLUMNS)
    assert csv_table.read_csv_table(spark, out).count() == 4
    assert [f.name for f in tmp_path.iterdir()] == ["out"]
