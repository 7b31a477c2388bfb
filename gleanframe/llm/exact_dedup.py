"""Exact duplicates: counting quotient filters find the candidates, their bytes decide.

1. One pass over the texts gives each document a digest, a fingerprint and its length.
2. Every partition of that table builds one filter per slice of the fingerprint range; the filters
   of a slice are merged by their sorted remainders. A hot fingerprint is one entry in each.
3. Fingerprints with a count above one send their documents to byte verification: a grouping by
   the text itself, combined in every task, so that a group of copies is never gathered.
4. Each group keeps its longest original; the smallest id decides ties.

Texts are equal when they are so without the characters 9 to 13 and 32. Nulls count as empty texts,
and empty texts equal each other. A null id sorts behind all others. Rows that repeat id and text
count as copies, each with the same result. Other columns are not read. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.quotient import QuotientFilter, merged
from gleanframe.llm.tables import id_and_text, shown_id, stored

WHITE = b"\t\n\x0b\x0c\r "
# The filters of a slice together hold about so many entries.
SLICE_ENTRIES = 1 << 17


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, points, sha, fingerprint`` of every row: code points of the text as it is, SHA-256 and
    its first 64 bits of the text without white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            shas = [hashlib.sha256(t.translate(None, WHITE)) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"),
                pc.utf8_length(batch.column("text")).cast(pa.int64()),
                pa.array([s.hexdigest() for s in shas]),
                pa.array([int.from_bytes(s.digest()[:8], "big", signed=True) for s in shas],
                         pa.int64()),
            ], ["id", "points", "sha", "fingerprint"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "id bigint, points bigint, sha string, fingerprint bigint")


def filters(found: DataFrame, slice_bits: int) -> DataFrame:
    """One merged filter per slice of the fingerprints, the slices named by their high bits."""
    value_bits = 64 - slice_bits
    fields = "slice int, quotient_bits int, occupied binary, run_end binary, remainders binary, counts binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [b.column(0).to_numpy().astype(np.uint64) for b in batches]
        values, counts = np.unique(np.concatenate(seen) if seen else np.zeros(0, np.uint64),
                                   return_counts=True)
        slices = (values >> np.uint64(value_bits)).astype(np.int64) if slice_bits else np.zeros(
            len(values), np.int64)
        rest = values & np.uint64(2**value_bits - 1)
        names, firsts = np.unique(slices, return_index=True)
        for name, first, last in zip(names, firsts, [*firsts[1:], len(values)]):
            yield _row(int(name), QuotientFilter.of(
                rest[first:last], counts[first:last], value_bits))

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        one = merged([_filter(r) for r in rows], value_bits)
        return pa.Table.from_batches([_row(rows[0]["slice"], one)])

    return found.select("fingerprint").mapInArrow(build, fields).groupBy("slice").applyInArrow(
        merge, fields)


def _row(name: int, one: QuotientFilter) -> pa.RecordBatch:
    bits, *arrays = one.packed()
    return pa.RecordBatch.from_arrays(
        [pa.array([name], pa.int32()), pa.array([bits], pa.int32()),
         *(pa.array([x], pa.binary()) for x in arrays)],
        ["slice", "quotient_bits", "occupied", "run_end", "remainders", "counts"])


def _filter(row: dict) -> QuotientFilter:
    return QuotientFilter.unpacked(row["quotient_bits"], row["occupied"], row["run_end"],
                                   row["remainders"], row["counts"])


def repeated_fingerprints(merged_filters: DataFrame, slice_bits: int) -> DataFrame:
    """``fingerprint, copies`` of all entries with a count above one."""
    value_bits = 64 - slice_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                one = _filter(r)
                many = one.counts > 1
                high = np.uint64(r["slice"] << value_bits) if slice_bits else np.uint64(0)
                yield pa.RecordBatch.from_arrays([
                    pa.array((one.fingerprints(value_bits)[many] | high).astype(np.int64)),
                    pa.array(one.counts[many])], ["fingerprint", "copies"])

    return merged_filters.mapInArrow(run, "fingerprint bigint, copies bigint")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``keep_id`` (the row of its group that stays), ``group_size``, ``kept`` and
    ``text_sha256`` of the text without white space."""
    found = stored(digests(docs, id_col, text_col), "digests")
    slice_bits = max(0, (found.count() // SLICE_ENTRIES).bit_length())
    repeated = stored(repeated_fingerprints(filters(found, slice_bits), slice_bits), "repeated")
    candidates = stored(found.join(repeated.select("fingerprint"), "fingerprint", "left_semi"),
                        "candidates")
    # one plan at every size: the ids may outgrow a broadcast
    texts = id_and_text(docs, id_col, text_col).join(
        candidates.select("id").distinct().hint("merge"), "id", "left_semi")
    same = texts.groupBy(F.translate("text", WHITE.decode(), "").alias("plain")).agg(
        F.count("*").alias("rows"))
    verified = same.groupBy(F.sha2("plain", 256).alias("sha")).agg(
        F.sum("rows").alias("rows"), F.count("*").alias("texts"))
    groups = candidates.groupBy("sha").agg(
        F.count("*").alias("n"),
        F.max(F.struct("points", (-F.col("id")).alias("least"))).alias("best"))
    # stored, so that both sides of the last join are plain and a hot digest can be split
    groups = stored(groups.join(verified, "sha").select(
        "sha", (-F.col("best.least")).alias("keep"),
        # two texts of one SHA-256 would be no group of copies
        F.when(F.col("texts") == 1, F.col("n")).otherwise(
            F.raise_error(F.lit("different texts share a digest"))).alias("n")), "groups")
    keep = F.coalesce("keep", "id")
    return found.join(groups, "sha", "left").select(
        shown_id("id").alias(id_col), shown_id(keep).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("id") == keep).alias("kept"), F.col("sha").alias("text_sha256"))
