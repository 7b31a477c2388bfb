"""Many phrases at once: all hits of a table of phrases in one pass over the texts.

An automaton of all phrases walks a text once, whatever their number, where a pattern of alternatives or a
join would look at each. Phrases are few beside texts; they go to the tasks in blocks of bounded size, each a pass
of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanframe.session import reach_workers

# Bytes of phrases that one automaton holds.
BLOCK_BYTES = 8 << 20


def automaton(phrases: list[str]):
    import ahocorasick

    built = ahocorasick.Automaton()
    for number, phrase in enumerate(phrases):
        built.add_word(phrase, (number, len(phrase)))
    built.make_automaton()
    return built


def count_hits(built, text: str) -> dict[int, int]:
    """Hits of each phrase from the left, no two of one phrase over each other."""
    counts: dict[int, int] = {}
    ends: dict[int, int] = {}
    for end, (number, length) in built.iter(text):
        if end - length >= ends.get(number, -1):
            counts[number] = counts.get(number, 0) + 1
            ends[number] = end
    return counts


def phrase_blocks(phrases: DataFrame, column: str = "phrase", block_bytes: int = BLOCK_BYTES) -> list[list[str]]:
    """The distinct phrases, lower-cased, without empty ones, in blocks; the driver holds one after the
    other, and together they must fit it, as the automata must fit a task."""
    found = phrases.select(F.lower(column).alias("phrase")).filter("phrase <> ''").distinct().withColumn(
        "size", F.octet_length("phrase"))
    total = found.agg(F.sum("size")).first()[0] or 0
    blocks = total // block_bytes + 1
    out = []
    for number in range(blocks):
        block = found.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == number)
        out.append(sorted(r.phrase for r in block.collect()))
    return [b for b in out if b]


def phrase_hits(texts: DataFrame, phrases: DataFrame, keep: tuple[str, ...] = ("doc_id",), column: str = "text",
                phrase: str = "phrase", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per text and phrase in it: the ``keep`` columns, ``phrase`` (lower-cased) and ``hits``.

    Texts are lower-cased; hits are counted from the left, and hits of one phrase do not overlap, those of
    different phrases may. Null and empty texts and phrases have none. Nothing is shuffled.
    """
    reach_workers(texts.sparkSession)
    schema = T.StructType([*[texts.schema[c] for c in keep], T.StructField("phrase", T.StringType()),
                           T.StructField("hits", T.LongType())])
    source = texts.select(*keep, F.lower(column).alias("_text")).filter("_text <> ''")
    passes = []
    for block in phrase_blocks(phrases, phrase, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            built = automaton(block)
            for batch in batches:
                rows, names, hits = [], [], []
                for row, text in enumerate(batch.column("_text")):
                    for number, n in count_hits(built, text.as_py()).items():
                        rows.append(row)
                        names.append(block[number])
                        hits.append(n)
                kept = batch.select(list(keep)).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(names, pa.string()), pa.array(hits, pa.int64())],
                    [*keep, "phrase", "hits"])

        passes.append(source.mapInArrow(run, schema))
    if not passes:
        return texts.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, passes)
