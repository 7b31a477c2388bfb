import numpy as np

from gleanframe.llm import exact_dedup as e
from gleanframe.llm.quotient import QuotientFilter, merged

DOCS = "doc_id bigint, text string, keep_id string, id string"


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2)
    parts = [rng.choice(values, n) for n in (700, 0, 3, 400)]
    filters = [QuotientFilter.of(p, np.ones(len(p), np.int64), 64) for p in parts]
    filters = [QuotientFilter.unpacked(*f.packed()) for f in filters]
    one = merged(filters, 64)
    want, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert (one.fingerprints(64) == want).all() and (one.counts == counts).all()


def test_groups_ties_nulls_and_repeats(table):
    rows = [(5, "a b", "x", "y"), (2, "ab", "x", None), (3, "a\tb ", None, None), (4, None, None, None),
            (9, " \n", None, None), (1, "other", None, None), (None, "ab", None, None),
            (7, "a b ", None, None), (8, "rep", None, None), (8, "rep", None, None)]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept)
           for r in e.exact_duplicates(table(rows, DOCS, 3)).collect()}
    assert got == {
        (5, 3, 5, False), (2, 3, 5, False), (3, 3, 5, True), (7, 3, 5, False), (None, 3, 5, False),
        (4, 9, 2, False), (9, 9, 2, True), (1, 1, 1, True), (8, 8, 2, True)}
    assert e.exact_duplicates(table(rows, DOCS)).count() == len(rows)


def test_no_rows_and_many_slices(table, spark, monkeypatch):
    assert e.exact_duplicates(table([], DOCS)).collect() == []
    monkeypatch.setattr(e, "SLICE_ENTRIES", 8)
    docs = spark.range(0, 300, 1, 5).selectExpr("id as doc_id", "cast(id % 70 as string) as text")
    out = e.exact_duplicates(docs).collect()
    assert all(r.keep_id == r.doc_id % 70 and r.group_size in (4, 5) for r in out)
    assert len(out) == 300


def test_long_texts(table):
    long = "word " * 400_000
    got = {r.doc_id: r.keep_id for r in e.exact_duplicates(
        table([(1, long, "", ""), (2, long + "\n", "", ""), (3, long + "x", "", "")], DOCS)).collect()}
    assert got == {1: 2, 2: 2, 3: 3}
