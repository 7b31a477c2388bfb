"""Near duplicates: MinHash signatures, joined by a multi-index over their chunks.

Signatures hold ``CHUNKS * CHUNK`` values of 16 bits, one per hash function; two sets of similarity s
agree in each with probability s. A signature is split into chunks, and a key is made of every chunk
with each one of its values left out in turn. Two signatures that differ in fewer than 2 * CHUNKS
values have a chunk with at most one difference (pigeonhole), so they share a key: no pair within
that distance is missed. Beyond it a pair of similarity 0.8 is missed with probability 3e-5 (all ten
chunks with two differences or more), one of 0.9 with 1e-10. Pairs that differ in more than
``MAX_DISTANCE`` values are let go before their sets are compared; a pair of similarity 0.8 does so
with probability 2e-5.

Texts with equal sets are one representative from the start, a number in order of their smallest ids, so
that texts that share an id, or have none, are told apart; ids come back at the end. Within the rows of a
key not all pairs are compared, only as many as connected components need:

1. every row with the smallest id of its key;
2. where a key still has rows of several components, those of other components with a row chosen by
   hash, ``STARS`` times;
3. where a key has several components even so, which is how keys look that a frequent line fills with
   texts that are not alike, the texts of such keys are compared exactly: two sets of the wanted
   similarity share one of their first shingles, a fifth of them and one more, in any common order.
   The order puts frequent shingles last, so that few texts meet at each; and shingles that a text has
   alone tell how much it can share at most.

Every pair is confirmed on the full sets. A pair that was passed over lies within one component
already, so components are those of all confirmed candidate pairs. No step gathers the rows of a key
in one task; hot keys are combined before shuffles or split by adaptive joins.

Sets are of shingles of ``words`` words. A-Z count as lower case, words end at the characters 9 to 13
and 32. A text with fewer words is one shingle; without words, or null, it has an empty set and is
linked with nothing. A null id sorts behind all others. Rows that repeat id and text are linked like
any copies; of different texts of one id that are near copies one is kept. Other columns are not read. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanframe.llm.components import components
from gleanframe.llm.tables import id_and_text, shown_id, stored
from gleanframe.llm.texts import LOWER, groups, mix, span_hashes, utf8
from gleanframe.llm.texts import words as words_of

CHUNKS, CHUNK = 10, 6
_RNG = np.random.default_rng(77)
FACTORS = _RNG.integers(0, 2**63, CHUNKS * CHUNK, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _RNG.integers(0, 2**63, CHUNKS * CHUNK, dtype=np.uint64)
KEPT_BYTES = 6  # of the hash of each shingle in stored sets
MAX_DISTANCE = 26
RARE = 48  # a shingle is frequent when more texts have it
STARS = 1


def text_key(text_col: str) -> Column:
    """Tells the texts of one id apart."""
    return F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256))


def shingles(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, and the first of each text (one more for the end)."""
    data, starts = utf8(column)
    data = LOWER[data]
    begin, end, first_word = words_of(data, starts)
    hashes = span_hashes(data, begin, end)
    counts = np.diff(first_word)
    found = np.where(counts == 0, 0, np.maximum(1, counts - words + 1))
    firsts = np.concatenate([[0], np.cumsum(found)])
    # shingle n of a text begins at its word n
    place = np.arange(firsts[-1]) - np.repeat(firsts[:-1] - first_word[:-1], found)
    length = np.repeat(np.minimum(counts, words), found)
    out = np.zeros(firsts[-1], np.uint64)
    for k in range(words):
        inside = k < length
        out[inside] = mix(out[inside] * np.uint64(3) + hashes[place[inside] + k] + np.uint64(k))
    return out, firsts


def _sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending."""
    found, firsts = shingles(column, words)
    sets = []
    for first, last in zip(firsts[:-1], firsts[1:]):
        one = np.sort(found[first:last])
        sets.append(one[np.concatenate([[True], one[1:] != one[:-1]])] if len(one) else one)
    return sets


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, digest, signature, sha``; the digest tells sets apart, an empty set has neither
    it nor a signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            sets = _sets(batch.column("text"), words)
            sizes = np.array([len(s) for s in sets])
            filled = np.flatnonzero(sizes)
            signed: list[bytes | None] = [None] * len(sets)
            if len(filled):
                flat = np.concatenate([sets[n] for n in filled])
                at = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
                least = np.stack([np.minimum.reduceat(flat * a + b, at)
                                  for a, b in zip(FACTORS, TERMS)], axis=1)
                values = (mix(least) >> np.uint64(48)).astype(np.uint16)
                for n, row in zip(filled, values):
                    signed[n] = row.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(sizes, pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                          for s in sets], pa.binary()),
                pa.array(signed, pa.binary()), batch.column("sha")],
                ["id", "n_shingles", "digest", "signature", "sha"])

    return id_and_text(docs, id_col, text_col).withColumn("sha", text_key("text")).mapInArrow(
        run, "id bigint, n_shingles bigint, digest binary, signature binary, sha binary")


def chunk_keys(signed: DataFrame) -> DataFrame:
    """``key, rep``: every chunk of every signature with one of its values left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
            values = values.reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
            ids = batch.column("rep")
            for chunk in range(CHUNKS):
                for left_out in range(CHUNK):
                    key = np.full(len(values), chunk * CHUNK + left_out, np.uint64)
                    for k in range(CHUNK):
                        if k != left_out:
                            key = mix(key * np.uint64(65537) + values[:, chunk, k])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), ids], ["key", "rep"])

    return signed.select("rep", "signature").mapInArrow(run, "key bigint, rep bigint")


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """``id, shingles``: the full set of each of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            packed = [np.ascontiguousarray(s.view(np.uint8).reshape(-1, 8)[:, 8 - KEPT_BYTES:]).tobytes()
                      for s in _sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())],
                                             ["id", "shingles"])

    return texts.mapInArrow(run, "id bigint, shingles binary")


def _unpacked(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // KEPT_BYTES, 8), np.uint8)
    out[:, 8 - KEPT_BYTES:] = np.frombuffer(packed, np.uint8).reshape(-1, KEPT_BYTES)
    return out.reshape(-1).view(np.uint64)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets have 100 * intersection >= percent * union."""
    rows = pairs.join(sets.hint("merge"), F.col("b") == F.col("id")).select(
        "a", "b", F.col("shingles").alias("of_b"))
    rows = rows.join(sets.hint("merge"), F.col("a") == F.col("id")).select(
        "a", "b", F.col("shingles").alias("of_a"), "of_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("of_a"), batch.column("of_b")):
                x, y = _unpacked(one.as_py()), _unpacked(two.as_py())
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "a bigint, b bigint")


def close(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose signatures differ in at most ``MAX_DISTANCE`` values."""
    rows = pairs.join(reps.select(F.col("rep").alias("b"), F.col("signature").alias("of_b")), "b")
    rows = rows.join(reps.select(F.col("rep").alias("a"), F.col("signature").alias("of_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(
                -1, CHUNKS * CHUNK) for c in ("of_a", "of_b"))
            near = (one != two).sum(axis=1) <= MAX_DISTANCE
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return rows.select("a", "b", "of_a", "of_b").mapInArrow(run, "a bigint, b bigint")


def shingle_rows(sets: DataFrame) -> DataFrame:
    """``id, size, shingle``: a row per shingle of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [_unpacked(one.as_py()) for one in part.column("shingles")]
                sizes = np.array([len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column("id").to_numpy(), sizes)),
                     pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(found).view(np.int64))],
                    ["id", "size", "shingle"])

    return sets.select("id", "shingles").mapInArrow(run, "id bigint, size bigint, shingle bigint")


def _exact_pairs(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of texts of different components that may be similar enough, by what they could share.

    Two sets that share a shingle that at most ``RARE`` texts have meet at such a one, as these come first.
    Any others share frequent shingles alone, so the number of those bounds their intersection, and
    all others add to their union. A shingle that no other text has adds to the union in any case. A
    pair is listed at the first shingle that it shares, unless a set has very many before it.
    """
    texts = apart.select(F.col("rep").alias("id"), "component").distinct()
    rows = stored(shingle_rows(sets.join(texts, "id", "left_semi")).join(texts, "id"), "shingles")
    common = rows.groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("n > 1")
    of_text = Window.partitionBy("id")
    in_order = of_text.orderBy("n", "shingle")
    frequent = F.col("n") > RARE
    rows = rows.join(common.hint("merge"), "shingle").withColumns({
        "shared": F.count("*").over(of_text),
        "most": F.when(frequent, F.count_if(frequent).over(of_text)).otherwise(F.count("*").over(of_text)),
        "place": F.row_number().over(in_order),
        "before": F.collect_list("shingle").over(in_order.rowsBetween(-64, -1))})
    # the place among all shingles of the text, its own ones first
    first = F.col("size") - F.col("shared") + F.col("place") <= (
        F.col("size") - F.ceil(F.col("size") * percent / 100) + 1)
    rows = stored(rows.filter(first & (F.col("low") < F.col("high"))).select(
        "shingle", "id", "size", "most", "before", "component"), "first")
    one, two = (rows.select("shingle", F.col("id").alias(n), F.col("size").alias(f"size_{n}"), F.col("most").alias(f"most_{n}"),
                            F.col("before").alias(f"before_{n}"), F.col("component").alias(f"component_{n}"))
                for n in ("a", "b"))
    most = F.least("most_a", "most_b")
    may = 100 * most >= percent * (F.col("size_a") + F.col("size_b") - most)
    return one.join(two, "shingle").filter(
        F.expr("a < b and component_a <> component_b") & may & ~F.arrays_overlap("before_a", "before_b")
    ).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (the smallest id that links lead to, its own
    included) and ``kept`` (whether it is that one)."""
    return near_rows(docs, words, percent, id_col, text_col).drop("sha")


def near_rows(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``near_duplicates`` with the ``text_key`` of each row as ``sha``."""
    signed = stored(signatures(docs, words, id_col, text_col), "signatures")
    found = signed.dropna(subset=["digest"]).groupBy("digest").agg(
        F.min(F.struct("id", "sha")).alias("least"), F.first("signature").alias("signature"))
    reps = stored(found.select("least.id", "least.sha", "digest", "signature").repartitionByRange(
        "id", "digest").sortWithinPartitions("id", "digest").withColumn(
        "rep", F.monotonically_increasing_id()), "sets")
    keys = chunk_keys(reps)
    leads = keys.groupBy("key").agg(F.min("rep").alias("lead"), F.count("*").alias("n")).filter("n > 1")
    shared = stored(keys.join(leads.hint("merge"), "key").select("key", "rep", "lead"), "keys")

    members = stored(reps.join(shared.select("rep").distinct(), "rep", "left_semi").select(
        "id", "sha", "rep"), "members")
    texts = id_and_text(docs, id_col, text_col).withColumn("sha", text_key("text")).join(
        members.hint("merge"), ["id", "sha"]).dropDuplicates(["id", "sha"])
    sets = stored(shingle_sets(texts.select(F.col("rep").alias("id"), "text"), words), "shingles")

    tested = stored(shared.filter("rep <> lead").select(
        F.col("lead").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = stored(confirmed(close(tested, reps), sets, percent), "links")
    labels = components(links)
    for star in range(STARS + 1):
        rows = shared.select("key", "rep").join(labels, F.col("rep") == F.col("node"), "left").select(
            "key", "rep", F.coalesce("component", "rep").alias("component"))
        mixed = rows.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min(F.struct(F.xxhash64("rep", F.lit(star)).alias("h"), "rep", "component")).alias("centre")
        ).filter("low < high").select("key", "centre")
        apart = stored(rows.join(mixed.hint("merge"), "key"), "apart")
        if apart.isEmpty():
            break
        if star < STARS:
            pairs = apart.filter("component <> centre.component").select(
                F.least("rep", "centre.rep").alias("a"), F.greatest("rep", "centre.rep").alias("b"))
        else:
            pairs = _exact_pairs(apart, sets, percent)
        new = stored(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        more = stored(confirmed(close(new, reps), sets, percent), "links")
        if not more.isEmpty():
            links = links.union(more)
            labels = components(links)
        tested = tested.union(new)

    led = reps.join(labels, F.col("rep") == F.col("node"), "left").select(
        "digest", "rep", F.coalesce("component", "rep").alias("lead"))
    leads = reps.select(F.col("rep").alias("lead"), F.col("id").alias("component"))
    named = stored(led.join(leads, "lead").select(
        "digest", "component", (F.col("rep") == F.col("lead")).alias("leads")), "components")
    component = F.coalesce("component", "id")
    return signed.join(named, "digest", "left").select(
        shown_id("id").alias(id_col), "n_shingles", shown_id(component).alias("component_id"),
        ((F.col("id") == component) & F.coalesce("leads", F.lit(True))).alias("kept"), "sha")
