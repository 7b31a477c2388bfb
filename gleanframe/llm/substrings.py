"""Repeated substrings: every byte that a string of ``length`` bytes covers which also starts in a text
with a smaller id.

Suffixes of whole collections do not fit one machine, so the windows of ``length`` bytes are dealt out
by their anchors (see ``repeats.pieces``): equal windows have equal anchors, and a run of windows with
one anchor travels as one piece of at most ``2 * length`` bytes.

1. Texts are dealt into blocks by a hash of their id and stored as a bucketed table, so that the
   later steps read them without another shuffle.
2. Every block sends the hashes of its anchors, each once, to their parts; a part answers which occur
   in more than one text, and which occur in many blocks.
3. Every block sends the pieces of those anchors, equal ones once with their smallest id. Where an
   anchor occurs in many blocks its pieces are sent window by window, each to the part that its own
   hash names, so that no part gets more of one anchor than ``HOT_BLOCKS`` blocks hold.
   A part builds the transform of its collection of pieces column by column, with the common
   prefixes of neighbours (``repeats.earlier``), and answers which windows have a smaller id.
4. Every block marks the bytes that those windows cover.

A null text is empty, a null id sorts behind all others; rows of one id do not remove each other.
Other columns are not read, and no rows give no rows. Texts are judged as they came in, whatever
is removed from others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.repeats import Pieces, earlier, gathered, pieces, windows
from gleanframe.llm.tables import id_and_text, shown_id, stored, storing
from gleanframe.llm.texts import groups, span_hashes, utf8
from gleanframe.session import scratch_path

BLOCK_BYTES = 4 << 20
PART_ANCHORS = 1 << 19
PART_PIECES = 1 << 17
HOT_BLOCKS = 512
ANSWER = "block int, part int, first binary, second binary"
SENT = "part int, block int, lead binary, run binary, owner binary, data binary"


def _blocks(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, int]:
    """The texts as a bucketed table ``block, id, text``, their bytes and the number of blocks."""
    rows = id_and_text(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    name = f"blocks_{uuid.uuid4().hex}"
    with storing(docs.sparkSession):
        (rows.repartition(n, "block").write.bucketBy(n, "block").option("compression", "zstd")
         .option("path", scratch_path(docs.sparkSession, "blocks")).saveAsTable(name))
    return docs.sparkSession.table(name), size, n


def _part_bits(n: int, each: int) -> int:
    return max(0, int(n // each)).bit_length()


def _top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)) if bits else np.zeros(len(hashes), np.uint64)


def _low(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits behind the ones that name the part."""
    return ((hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _each_group(table: pa.Table, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Pieces]]:
    """Ids, bytes, starts and pieces of a block's texts, a bounded part at a time, in order of ids."""
    table = table.sort_by("id") if table.num_rows else table
    for batch in groups(table.to_batches()):
        data, starts = utf8(batch.column("text"))
        yield batch.column("id").to_numpy(), data, starts, pieces(data, starts, length)


def _split(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values."""
    edges = np.flatnonzero(np.diff(values)) + 1
    for first, last in zip([0, *edges], [*edges, len(values)]):
        if last > first:
            yield int(values[first]), slice(first, last)


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [pa.field(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)],
                                schema=pa.schema(fields))


def _anchor_sender(length: int, bits: int) -> Callable[[pa.Table], pa.Table]:
    """Per block: to each part the distinct anchors, and which of them occur in several texts."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        hashes, texts = [], []
        for ids, _, _, some in _each_group(table, length):
            order = np.lexsort((ids[some.text], some.key))
            key, text = some.key[order], ids[some.text][order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
            hashes.append(key[new])
            texts.append(text[new])
        key = np.concatenate(hashes)
        order = np.argsort(key, kind="stable")
        key, text = key[order], np.concatenate(texts)[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(first)
        if len(at):
            several = np.maximum.reduceat(text, at) != np.minimum.reduceat(text, at)
        key = key[at]
        return _rows(SENT_ANCHORS, [
            (part, block, _low(key[s], bits).tobytes(), np.packbits(several[s]).tobytes())
            for part, s in _split(_top(key, bits))])

    return run


SENT_ANCHORS = "part int, block int, low binary, several binary"


def _judge_anchors(table: pa.Table) -> pa.Table:
    """Per part: to each block its anchors that occur in several texts (first) and which of those are
    in many blocks (second)."""
    rows = table.select(["part", "block", "low", "several"]).to_pylist()
    low = [np.frombuffer(r["low"], np.uint32) for r in rows]
    several = [np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(v)) for r, v in zip(rows, low)]
    values, inverse, counts = np.unique(np.concatenate(low), return_inverse=True, return_counts=True)
    shared = (counts > 1) | (np.bincount(inverse, np.concatenate(several), len(values)) > 0)
    hot = counts > HOT_BLOCKS
    out, done = [], 0
    for r, v in zip(rows, low):
        at = inverse[done:done + len(v)]
        done += len(v)
        keep = shared[at]
        if keep.any():
            out.append((r["block"], r["part"], v[keep].tobytes(),
                        np.packbits(hot[at[keep]]).tobytes()))
    return _rows(ANSWER, out)


class _Shared:
    """A block's anchors that occur in several texts."""

    def __init__(self, answers: pa.Table, bits: int):
        keys, hot = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
        for r in answers.to_pylist():
            low = np.frombuffer(r["first"], np.uint32).astype(np.uint64)
            keys.append((np.uint64(r["part"]) << np.uint64(32)) | low)
            hot.append(np.unpackbits(np.frombuffer(r["second"], np.uint8), count=len(low)).astype(bool))
        order = np.argsort(keys := np.concatenate(keys))
        self.keys, self.hot, self.bits = keys[order], np.concatenate(hot)[order], bits

    def wanted(self, some: Pieces, data: np.ndarray, length: int) -> Pieces:
        """The pieces of these anchors; window by window those of hot ones."""
        if not len(self.keys):
            return some.take(np.zeros(0, np.int64))
        key = (_top(some.key, self.bits) << np.uint64(32)) | _low(some.key, self.bits)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        plain = some.take(np.flatnonzero(found & ~self.hot[at]))
        hot = some.take(np.flatnonzero(found & self.hot[at]))
        if not len(hot.start):
            return plain
        begin = np.arange(len(data) - length + 1)
        single = windows(hot, span_hashes(data, begin, begin + length))
        return Pieces(*(np.concatenate(x) for x in zip(plain, single)))


def _distinct(table: pa.Table, shared: _Shared, length: int, part_bits: int):
    """The wanted pieces of a block, equal ones once: their parts, smallest ids and places, and for
    every piece of every group of texts the number of its like."""
    kept: list[tuple] = []
    for ids, data, starts, some in _each_group(table, length):
        some = shared.wanted(some, data, length)
        name = span_hashes(data, some.start, some.start + some.run + length - 1)
        name ^= some.lead.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        kept.append((ids, data, starts, some, name))
    names = np.concatenate([k[4] for k in kept])
    parts = np.concatenate([_top(k[3].key, part_bits) for k in kept])
    owners = np.concatenate([k[0][k[3].text] for k in kept])
    order = np.lexsort((owners, names, parts))
    first = np.ones(len(names), bool)
    first[1:] = (names[order][1:] != names[order][:-1]) | (parts[order][1:] != parts[order][:-1])
    like = np.empty(len(names), np.int64)
    like[order] = np.cumsum(first) - 1
    return kept, like, order[first], parts, owners


def _piece_sender(length: int, bits: int, part_bits: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows or not answers.num_rows:
            return _rows(SENT, [])
        block = texts.column("block")[0].as_py()
        kept, _, at, parts, owners = _distinct(texts, _Shared(answers, bits), length, part_bits)
        lead = np.concatenate([k[3].lead for k in kept])[at].astype(np.uint8)
        size = np.concatenate([k[3].run for k in kept])[at]
        # the bytes of the pieces, from one buffer of all groups
        offset = np.cumsum([0, *(len(k[1]) for k in kept)])
        start = np.concatenate([k[3].start + o for k, o in zip(kept, offset)])[at]
        data = np.concatenate([k[1] for k in kept])
        return _rows(SENT, [
            (part, block, lead[s].tobytes(), size[s].astype(np.uint8).tobytes(),
             owners[at[s]].astype(np.int64).tobytes(),
             gathered(data, start[s], size[s] + length - 1).tobytes())
            for part, s in _split(parts[at])])

    return run


def _piece_judge(length: int):
    """Per part: to each block, which windows of its pieces have a smaller id elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lead, size = (np.concatenate([np.frombuffer(r[c], np.uint8) for r in rows]).astype(np.int64)
                      for c in ("lead", "run"))
        owner = np.concatenate([np.frombuffer(r["owner"], np.int64) for r in rows])
        data = np.concatenate([np.frombuffer(r["data"], np.uint8) for r in rows])
        found = earlier(data, lead, size, owner, length)
        out, done, at = [], 0, 0
        for r in rows:
            n = len(r["run"])
            total = int(size[done:done + n].sum())
            out.append((r["block"], r["part"], np.packbits(found[at:at + total]).tobytes(), None))
            done, at = done + n, at + total
        return _rows(ANSWER, out)

    return run


MARKED = "id bigint, n_bytes bigint, spans array<struct<from:bigint,to:bigint>>, kept binary"
_SPANS = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def _marker(length: int, bits: int, part_bits: int):
    """Per block: its texts with the spans to remove and the bytes that stay."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        fields = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("spans", _SPANS),
                            ("kept", pa.binary())])
        if not texts.num_rows:
            return fields.empty_table()
        is_anchor = pc.is_valid(answers.column("second"))
        kept, like, at, parts, owners = _distinct(
            texts, _Shared(answers.filter(is_anchor), bits), length, part_bits)
        size = np.concatenate([k[3].run for k in kept])
        # answers of all distinct pieces, one behind the other
        said = {r["part"]: r["first"] for r in answers.filter(pc.invert(is_anchor)).to_pylist()}
        bits_of = [np.zeros(0, bool)]
        for part, s in _split(parts[at]):
            n = int(size[at[s]].sum())
            bits_of.append(np.unpackbits(np.frombuffer(said[part], np.uint8), count=n).astype(bool))
        answer = np.concatenate(bits_of)
        first_bit = np.cumsum(size[at]) - size[at]
        out, done = [], 0
        for ids, data, starts, some, _ in kept:
            mine = slice(done, done + len(some.start))
            done += len(some.start)
            each = np.repeat(np.arange(len(some.start)), some.run)
            step = np.arange(len(each)) - np.repeat(np.cumsum(some.run) - some.run, some.run)
            group = like[mine][each]
            # the smallest id of a block's equal pieces removes the others
            gone = answer[first_bit[group] + step] | (owners[at][group] < ids[some.text][each])
            place = (some.start[each] + step)[gone]
            change = np.bincount(place, minlength=len(data) + 1)
            change -= np.bincount(place + length, minlength=len(data) + 1)
            removed = np.cumsum(change)[:-1] > 0
            out.append(_spans(ids, data, starts, removed, fields))
        return pa.concat_tables(out)

    return run


def _spans(ids: np.ndarray, data: np.ndarray, starts: np.ndarray, removed: np.ndarray,
           fields: pa.Schema) -> pa.Table:
    padded = np.concatenate([[False], removed, [False]])
    cut = np.zeros(len(removed) + 1, bool)
    cut[starts] = True  # a span ends with its text
    begin = np.flatnonzero(removed & (~padded[:-2] | cut[:-1]))
    end = np.flatnonzero(removed & (~padded[2:] | cut[1:])) + 1
    text = np.searchsorted(starts, begin, "right") - 1
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(begin, starts), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(begin - starts[text]), pa.array(end - starts[text])], ["from", "to"]))
    left = np.concatenate([[0], np.cumsum(~removed)])[starts]
    stays = pa.BinaryArray.from_buffers(
        pa.binary(), len(ids), [None, pa.py_buffer(left.astype(np.int32).tobytes()),
                                pa.py_buffer(data[~removed].tobytes())])
    return pa.Table.from_arrays([pa.array(ids), pa.array(np.diff(starts)), spans, stays], schema=fields)


def repeated_substrings(docs: DataFrame, length: int = 50, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, ``spans`` (maximal runs of removed bytes, from and to) and ``kept``,
    the bytes that stay."""
    texts, size, _ = _blocks(docs, id_col, text_col)
    bits = _part_bits(size // 16, PART_ANCHORS)
    anchors = texts.groupBy("block").applyInArrow(_anchor_sender(length, bits), SENT_ANCHORS)
    shared = stored(anchors.groupBy("part").applyInArrow(_judge_anchors, ANSWER), "anchors")

    found = (shared.agg(F.sum(F.octet_length("first"))).first()[0] or 0) // 4
    part_bits = _part_bits(found, PART_PIECES)
    sent = texts.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        _piece_sender(length, bits, part_bits), SENT)
    judged = stored(sent.groupBy("part").applyInArrow(_piece_judge(length), ANSWER), "judged")

    marked = texts.groupBy("block").cogroup(shared.union(judged).groupBy("block")).applyInArrow(
        _marker(length, bits, part_bits), MARKED)
    return marked.select(shown_id("id").alias(id_col), "n_bytes", "spans", "kept")
