"""Page plans and pointer chains."""

from gleanframe.operators import paging


def test_plan_and_gaps(spark):
    read = spark.createDataFrame([("a", 2, 6), ("a", 4, 7), ("b", 1, 1), ("c", 3, 25_000)],
                                 "listing string, page_num long, total_pages long")
    fetched = spark.createDataFrame([("a", 2), ("a", 4), ("a", 5), ("b", 1), ("c", 3), ("c", 3)],
                                    "listing string, page_num long")
    plan = paging.page_plan(read, fetched)
    assert sorted(r.page_num for r in plan.filter("listing = 'a'").collect()) == [3, 6, 7]
    assert plan.filter("listing = 'b'").count() == 0
    assert plan.filter("listing = 'c'").count() == plan.filter("listing = 'c'").distinct().count() == 24_997
    gaps = paging.page_gap_report(read)
    assert sorted(r.page_num for r in gaps.filter("listing = 'a'").collect()) == [1, 3, 5, 6, 7]
    assert gaps.filter("listing = 'c'").count() == 24_999


def closure(spark, edges, seeds):
    pointers = spark.createDataFrame(edges, "page long, next_page long")
    start = spark.createDataFrame([(s,) for s in seeds], "page long")
    return {r.page: r.depth for r in paging.next_pointer_closure(pointers, start).collect()}


def test_long_chain(spark):
    edges = [(n, n + 1) for n in range(300)] + [(300, None), (900, 901)]
    assert closure(spark, edges, [0]) == {n: n for n in range(301)}


def test_cycle_and_merging_chains(spark):
    edges = [(1, 2), (2, 3), (3, 1), (10, 11), (11, 2), (20, 20)]
    assert closure(spark, edges, [10, 20]) == {10: 0, 11: 1, 2: 2, 3: 3, 1: 4, 20: 0}


def test_nearest_seed_counts_and_seeds_without_pointer_stay(spark):
    assert closure(spark, [(1, 2), (2, 3), (3, 4)], [1, 3, 3, 99]) == {1: 0, 2: 1, 3: 0, 4: 1, 99: 0}


def test_many_pages_pointing_to_one(spark):
    edges = [(n, 5000) for n in range(4000)] + [(5000, 5001), (5001, 5002)]
    got = closure(spark, edges, range(0, 4000, 2))
    assert len(got) == 2003 and [got[n] for n in (5000, 5001, 5002)] == [1, 2, 3]
