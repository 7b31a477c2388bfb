"""Every registered query against its oracle, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) == set(entry.ORACLES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    rows, problem = compare(spark, oracle, name, SF)
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 100


@pytest.mark.parametrize("name", [n for n in entry.QUERIES if not n.startswith("stream")])
def test_no_pairwise_joins_and_no_single_partition_sorts(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
    # what meets in one partition is partial aggregates or the rows of a limit, never a sort's or a window's input
    nodes = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    for above, below in zip(nodes, nodes[1:]):
        if below.startswith("Exchange SinglePartition"):
            assert not above.startswith(("Sort ", "Window", "SortMergeJoin"))


def test_texts_and_top_level_domains_are_no_shuffle_keys(spark):
    plans = {name: entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
             for name in ("dedup_keep_first_text", "domain_filter_table", "frontier_unseen")}
    assert "hashpartitioning(text" not in plans["dedup_keep_first_text"]
    assert plans["frontier_unseen"].count("Scan parquet") == 1
    # links and domains are both made from the pages here, and each is read twice
    assert plans["domain_filter_table"].count("Scan parquet") <= 4
