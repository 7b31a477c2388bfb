"""Benchmark passages in training texts, found by spaced seeds.

A seed is the hash of the words that a mask leaves at one place of a text; a substituted word that
falls on an ignored position does not change it. Seeds of all masks are taken at every word of the
benchmark items and of the documents and joined by hash. Around each hit both texts are compared
word by word along the diagonal of the hit, and the longest stretch is kept in which enough words
agree.

Words are maximal runs of ASCII letters, digits and bytes above 127 of the lower-cased text, so that
neither case nor punctuation hides a passage. Null texts have no words. A document matches an item
when a stretch of at least ``min_words`` words (or the whole item, if it is shorter) agrees in
``min_share`` of its words. Items without words match nothing. Rows that repeat are searched and
reported like any other. Other columns are not read.

The seeds of the items are looked up in an array that goes with the tasks. Its size is bounded: items
are dealt into blocks of about ``BLOCK_BYTES`` of text, and the documents are read once for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.tables import id_and_text, shown_id
from gleanframe.llm.texts import groups, mix, per_text, span_hashes, utf8

# Fixed masks: 1 for a position that counts, 0 for one that is ignored. Every stretch of 13 words with
# two substituted, of 15 or 16 with three and of 20 with four holds a seed of some mask (tried out).
MASKS = ("11111", "110111", "111011", "1111011")
BLOCK_BYTES = 8 << 20
HITS_AT_ONCE = 1 << 19
WORDS_AT_ONCE = 1 << 21
FILTER_BITS = 22
WORD_BYTES = np.zeros(256, bool)
for _first, _last in ((48, 57), (65, 90), (97, 122), (128, 255)):
    WORD_BYTES[_first:_last + 1] = True

HITS = ("id bigint, item_id bigint, doc_from bigint, doc_to bigint, item_from bigint, item_to bigint, "
        "agreeing bigint")


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column of texts, and the first word of each text."""
    data, starts = utf8(pc.utf8_lower(pc.fill_null(column, "")))
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = WORD_BYTES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return span_hashes(data, begin, end), np.searchsorted(begin, starts)


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The seed at every word with enough words behind it (in the array, not in its text)."""
    at = [n for n, bit in enumerate(mask) if bit == "1"]
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, int(mask, 2), np.uint64)
    for k in at:
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n]
    return mix(out)


def whole(firsts: np.ndarray, n: int, span: int) -> np.ndarray:
    """Whether the ``span`` words from each of ``n`` places lie within one text."""
    last = np.repeat(firsts[1:], np.diff(firsts))
    return np.arange(n) + span <= last[:n]


class Items:
    """Words and seeds of a bounded set of benchmark items, ready for look-up."""

    def __init__(self, ids: np.ndarray, words: np.ndarray, firsts: np.ndarray, min_words: int,
                 min_share: float):
        self.ids, self.words, self.firsts = ids, words, firsts
        self.min_words, self.percent = min_words, round(100 * min_share)
        self.owner = per_text(firsts)  # item of each word
        found, places = [], []
        for mask in MASKS:
            values = seeds(words, mask)
            at = np.flatnonzero(whole(firsts, len(values), len(mask)))
            found.append(values[at])
            places.append(at)
        # a short item is cut into one piece more than it may have substitutions
        self.masks = list(MASKS)
        lengths = np.diff(firsts)
        pieces: dict[int, list[int]] = {}
        for text in np.flatnonzero((lengths > 0) & (lengths < min_words)).tolist():
            n = int(lengths[text])
            count = n * (100 - self.percent) // 100 + 1
            for k in range(count):
                pieces.setdefault(n // count, []).append(int(firsts[text]) + k * (n // count))
        for n, at in pieces.items():
            self.masks.append("1" * n)
            found.append(seeds(words, "1" * n)[at])
            places.append(np.array(at))
        order = np.argsort(values := np.concatenate(found), kind="stable")
        self.seeds, self.places = values[order], np.concatenate(places)[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._slot(self.seeds)] = True

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def look_up(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first seed that equals each value, and how many do."""
        low = np.searchsorted(self.seeds, values, "left")
        return low, np.searchsorted(self.seeds, values, "right") - low


def longest_stretches(agree: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end, within each of the runs laid one behind the other, of the longest stretch of which
    at least so many per cent agree, the last among equals. No run is empty."""
    run = np.repeat(np.arange(len(sizes)), sizes + 1)
    first = np.cumsum(sizes + 1) - (sizes + 1)  # place of each run's empty sum
    sums = np.zeros(len(run), np.int64)
    steps = np.ones(len(run), bool)
    steps[first] = False
    sums[steps] = 100 * agree.astype(np.int64) - percent
    # running sums of each run, which lie below each other, so that one ascending row holds their minima
    apart = 400 * int(sizes.max()) + 1
    sums = np.cumsum(sums)
    sums += -sums[first][run] - run * apart
    lowest = np.minimum.accumulate(sums)
    begin = np.searchsorted(-lowest, -sums, "left")  # the first place that is no higher
    lengths = np.arange(len(run)) - begin
    most = np.maximum.reduceat(lengths, first)
    at = np.where(lengths == most[run], np.arange(len(run)), -1)
    end = np.maximum.reduceat(at, first)
    return begin[end] - first, end - first


def _compared(items: Items, words: np.ndarray, firsts: np.ndarray, texts: np.ndarray, one: np.ndarray,
              two: np.ndarray) -> np.ndarray:
    """The passages on diagonals that begin at these words of the texts and of the items: rows of text,
    item, agreeing words, place in the words of the texts, place in those of the items, and length."""
    text, item = texts[one], items.owner[two]
    sizes = np.minimum(firsts[text + 1] - one, items.firsts[item + 1] - two)
    needed = np.minimum(items.min_words, np.diff(items.firsts)[item])
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    agree = words[np.repeat(one, sizes) + at] == items.words[np.repeat(two, sizes) + at]
    sums = np.concatenate([[0], np.cumsum(agree)])
    ends = np.cumsum(sizes)
    # most diagonals hold no more than a common phrase: too few words agree on all of it
    enough = (sizes >= needed) & (100 * (sums[ends] - sums[ends - sizes]) >= items.percent * needed)
    if not enough.any():
        return np.zeros((6, 0), np.int64)
    agree = agree[np.repeat(enough, sizes)]
    text, item, one, two, sizes, needed = (x[enough] for x in (text, item, one, two, sizes, needed))
    begin, end = longest_stretches(agree, sizes, items.percent)
    sums = np.concatenate([[0], np.cumsum(agree)])
    start = np.cumsum(sizes) - sizes
    same = sums[start + end] - sums[start + begin]
    long = end - begin >= needed
    return np.stack([text, item, same, one + begin, two + begin, end - begin])[:, long]


def _best(found: np.ndarray) -> np.ndarray:
    """One passage per text and item: the one with the most agreeing words, then the first in the text
    and in the item."""
    order = np.lexsort((found[4], found[3], -found[2], found[1], found[0]))
    found = found[:, order]
    new = np.ones(found.shape[1], bool)
    new[1:] = (np.diff(found[0]) != 0) | (np.diff(found[1]) != 0)
    return found[:, new]


def search(items: Items, words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Columns of text, item, from, to, item from, item to and agreeing words, the best per text and item.

    A phrase that is frequent on both sides gives many diagonals. Hits are taken a bounded number at a
    time, each diagonal is compared in one pass with all others, and only the best passages are kept
    from one such part to the next."""
    texts = per_text(firsts)
    best = np.zeros((6, 0), np.int64)
    for mask in items.masks:
        values = seeds(words, mask)
        at = np.flatnonzero(items.filter[items._slot(values)] & whole(firsts, len(values), len(mask)))
        low, hits = items.look_up(values[at])
        at, low, hits = at[hits > 0], low[hits > 0], hits[hits > 0]
        ends = np.cumsum(hits)
        done, total = 0, int(ends[-1]) if len(ends) else 0
        while done < total:
            number = np.arange(done, min(done + HITS_AT_ONCE, total))
            done += len(number)
            value = np.searchsorted(ends, number, "right")
            seed = low[value] + number - (ends[value] - hits[value])
            one, two = at[value], items.places[seed]
            # where the diagonals of the hits begin, each once
            back = np.minimum(one - firsts[texts[one]], two - items.firsts[items.owner[two]])
            key = np.unique((one - back) * len(items.words) + two - back)
            one, two = np.divmod(key, len(items.words))
            step = np.cumsum(np.diff(items.firsts)[items.owner[two]]) // WORDS_AT_ONCE
            for part in np.split(np.arange(len(key)), np.flatnonzero(np.diff(step)) + 1):
                found = _compared(items, words, firsts, texts, one[part], two[part])
                if found.size:
                    best = _best(np.concatenate([best, found], axis=1))
    text, item, same, d, i, n = best
    d, i = d - firsts[text], i - items.firsts[item]
    return np.stack([text, item, d, d + n, i, i + n, same])


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, min_words: int,
                min_share: float) -> Iterator[Items]:
    """The items, a bounded part at a time."""
    rows = id_and_text(benchmark, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    for block in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).distinct().toArrow()
        if part.num_rows:
            part = part.combine_chunks()
            words, firsts = word_hashes(part.column("text").combine_chunks())
            yield Items(part.column("id").to_numpy(), words, firsts, min_words, min_share)


def overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 13, min_share: float = 0.8,
             id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text") -> DataFrame:
    """One row per document and item that share a passage: the words of the document and of the item
    (from, to) that the longest agreeing stretch covers, and how many of them agree."""
    names = [f.split()[0] for f in HITS.split(", ")]
    texts = id_and_text(docs, id_col, text_col)
    out = docs.sparkSession.createDataFrame([], HITS)
    for items in item_blocks(benchmark, item_col, item_text_col, min_words, min_share):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in groups(batches):
                words, firsts = word_hashes(batch.column("text"))
                text, item, *rest = search(items, words, firsts)
                if len(text):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(text)), pa.array(items.ids[item]),
                         *(pa.array(c, pa.int64()) for c in rest)], names)

        out = out.unionByName(texts.mapInArrow(run, HITS))
    return out.select(shown_id("id").alias(id_col), shown_id("item_id").alias(item_col), "doc_from",
                      "doc_to", "item_from", "item_to", "agreeing")


def without_overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 13, min_share: float = 0.8,
                     text_col: str = "text", item_col: str = "item_id",
                     item_text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text shares no passage with an item."""
    schema = docs.schema
    for items in item_blocks(benchmark, item_col, item_text_col, min_words, min_share):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in groups(batches, text_col):
                words, firsts = word_hashes(batch.column(text_col))
                clean = np.ones(batch.num_rows, bool)
                clean[search(items, words, firsts)[0]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs
