"""Stores and closures that grow, streams that wait for each other, many phrases."""

import random

import pytest
from pyspark.sql import functions as F

from gleanframe.operators import frontier, paging, phrases
from gleanframe.operators.seen import SeenStore
from gleanframe.session import scratch_path
from gleanframe.streaming import jobs


# ---- seen URLs

@pytest.fixture()
def store(spark):
    made = SeenStore(spark, "seen_test", scratch_path(spark, "seen"), buckets=4)
    yield made
    made.drop()


def links(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id long, url string")


def test_the_store_grows_by_what_is_new(spark, store):
    store.add(links(spark, (1, "a"), (2, "a"), (3, "b"), (4, None)))
    store.add(links(spark, (5, "b"), (6, "c"), (7, "")))
    assert sorted(r.url for r in store.rows().collect()) == ["", "a", "b", "c"]
    found = {r.url: (r.first_page, r.n_links) for r in store.unseen(links(
        spark, (9, "a"), (8, "d"), (7, "d"), (6, None), (5, ""), (4, "c"))).collect()}
    assert found == {"d": (7, 2), None: (6, 1)}


def test_it_equals_the_plain_anti_join_after_appends(spark, store):
    rng = random.Random(3)
    seen = []
    for _ in range(4):
        batch = [(rng.randrange(50), f"u{rng.randrange(300)}") for _ in range(120)]
        new = links(spark, *batch)
        want = frontier.frontier_unseen(new, links(spark, *seen, (0, "x")))
        got = store.unseen(new).select(want.columns)
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
        store.add(new)
        seen += batch
    assert store.rows().count() == len({u for _, u in seen}) and store.files() <= 4 * 4


def test_the_stored_side_is_not_shuffled(spark, store):
    store.add(links(spark, *[(n, f"u{n}") for n in range(100)]))
    again = SeenStore(spark, "seen_test")
    assert again.buckets == 4
    plan = again.unseen(links(spark, (1, "a")))._jdf.queryExecution().executedPlan().toString()
    scan = [k for k, line in enumerate(plan.splitlines()) if "Scan parquet" in line]
    lines = plan.splitlines()
    join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    right = lines[next(k for k in range(join + 1, len(lines)) if lines[k].lstrip(" :").startswith("+- Sort")):]
    assert scan and not any("Exchange" in line for line in right) and "Bucketed: true" in plan


# ---- pointer chains

def depths(pointers, seeds):
    """Shortest ways, by breadth first."""
    ahead = {}
    for page, to in pointers:
        if to is not None:
            ahead[page] = min(to, ahead.get(page, to))
    out, edge, depth = {}, set(seeds), 0
    while edge:
        out |= {p: depth for p in edge}
        edge = {ahead[p] for p in edge if p in ahead} - set(out)
        depth += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_an_increment_equals_the_whole_closure(spark, seed):
    rng = random.Random(seed)
    order = list(range(60))
    rng.shuffle(order)
    pointers = [(p, rng.choice([p + 1, p + 1, p + 7, rng.randrange(60), None])) for p in order]
    schema = "page long, next_page long"

    def table(rows):
        return spark.createDataFrame(rows, schema).repartition(2)

    seeds, late = [0, 20], [41]
    known = pointers[:25]
    reached = paging.next_pointer_closure(table(known), spark.createDataFrame([(s,) for s in seeds], "page long"))
    for more, new_seeds in ((pointers[25:45], []), (pointers[45:], late)):
        extra = spark.createDataFrame([(s,) for s in new_seeds], "page long") if new_seeds else None
        reached = paging.next_pointer_increment(reached, table(known), table(more), extra)
        known, seeds = known + more, seeds + new_seeds
        assert {r.page: r.depth for r in reached.collect()} == depths(known, seeds)


def test_a_shorter_way_repairs_the_depths_behind_it(spark):
    chain = [(n, n + 1) for n in range(30)]
    schema = "page long, next_page long"
    seeds = spark.createDataFrame([(0,), (100,)], "page long")
    reached = paging.next_pointer_closure(spark.createDataFrame(chain, schema), seeds)
    added = [(100, 12), (30, 31)]
    got = paging.next_pointer_increment(
        reached, spark.createDataFrame(chain, schema), spark.createDataFrame(added, schema))
    assert {r.page: r.depth for r in got.collect()} == depths(chain + added, [0, 100])


def test_a_pointer_that_changes_takes_the_old_way_away(spark):
    schema = "page long, next_page long"
    old, added = [(1, 5), (5, 6)], [(1, 3)]
    reached = paging.next_pointer_closure(
        spark.createDataFrame(old, schema), spark.createDataFrame([(1,)], "page long"))
    got = paging.next_pointer_increment(
        reached, spark.createDataFrame(old, schema), spark.createDataFrame(added, schema))
    assert {r.page: r.depth for r in got.collect()} == {1: 0, 3: 1}


# ---- listing and pages as they come

LISTED = [(f"u{n}", n, n) for n in range(8)] + [("u1", 20, 20)]  # url, minute, pos
FETCHED = [(f"u{n}", n + 5, f"page {n}") for n in (0, 1, 2, 5)] + [("u2", 40, "later page"), ("other", 3, "x")]


def batches_of(order):
    """Files in which both sides land, by number."""
    rows = [("l", r) for r in LISTED] + [("f", r) for r in FETCHED]
    return [[rows[k] for k in range(n, len(rows), 3)] for n in order]


def land(spark, rows, side, folder):
    names = {"l": "url string, minute long, pos long", "f": "url string, minute long, detail string"}
    time = {"l": "listed_at", "f": "fetched_at"}
    df = spark.createDataFrame([r for kind, r in rows if kind == side], names[side]).withColumn(
        time[side], F.timestamp_seconds(F.lit(1_700_000_000) + F.col("minute") * 60)).drop("minute")
    df.coalesce(1).write.mode("append").parquet(folder)
    return df.schema


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_the_stream_join_equals_the_batch_join(spark, order):
    left, right, folder = (scratch_path(spark, n) for n in ("left", "right", "enrich"))
    for rows in batches_of(order):
        schemas = land(spark, rows, "l", left), land(spark, rows, "f", right)
        sides = [jobs.read_parquet_stream(spark, p, s) for p, s in zip((left, right), schemas)]
        jobs.stream_enrich(*sides, folder, wait="1 hour", delay="1 day").awaitTermination()
    got = jobs.enriched(spark, folder, ["url", "pos", "detail"], ("pos", "fetched_at"))
    assert sorted(tuple(r) for r in got.collect()) == [(f"u{n}", n, f"page {n}") for n in (0, 1, 2, 5)]


def test_listings_whose_page_never_comes_expire(spark):
    left, right, folder = (scratch_path(spark, n) for n in ("left", "right", "enrich"))
    later = [("l", ("new", 100_000, 1)), ("f", ("new", 100_001, "new page"))]
    for rows in ([("l", r) for r in LISTED] + [("f", r) for r in FETCHED], later, later):
        schemas = land(spark, rows, "l", left), land(spark, rows, "f", right)
        sides = [jobs.read_parquet_stream(spark, p, s) for p, s in zip((left, right), schemas)]
        query = jobs.stream_enrich(*sides, folder, wait="1 hour", delay="10 minutes")
        query.awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").filter("url <> 'new'")
    lost = {r.url for r in rows.filter("not arrived").collect()}
    assert {"u3", "u4", "u6", "u7"} <= lost and not lost & {"u0", "u2", "u5"}
    # only what landed last is still held
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


# ---- phrases

def test_hits_equal_counting_each_phrase(spark):
    rng = random.Random(5)
    texts = [(n, " ".join(rng.choice(["ab", "aba", "Ba", "é", "a"]) for _ in range(40))) for n in range(30)]
    texts += [(98, None), (99, ""), (100, "ab" * 50_000)]
    table = ["ab", "aba", "BA", "a é", "é a", "abab", None, "", "zz", "ab", "a" * 3]
    got = phrases.phrase_hits(
        spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, phrase string"),
        spark.createDataFrame([(p,) for p in table], "phrase string"), block_bytes=6)
    want = {(n, p.lower()): t.lower().count(p.lower()) for n, t in texts if t for p in table if p}
    found = [(r.doc_id, r.phrase, r.hits) for r in got.collect()]
    assert {(n, p): h for n, p, h in found} == {k: v for k, v in want.items() if v} and len(found) == len(set(found))


def test_no_phrases(spark):
    texts = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert phrases.phrase_hits(texts, spark.createDataFrame([], "phrase string")).collect() == []


def test_many_phrases_take_one_walk(spark):
    built = phrases.automaton([f"phrase {n} end" for n in range(10_000)])
    assert phrases.count_hits(built, "a phrase 77 end and phrase 9999 end, phrase 77 end") == {77: 2, 9999: 1}
