"""Quality rules: plain counts of a text, and a hashed n-gram log-likelihood ratio between trusted texts
and the whole corpus.

Words and pairs of neighbouring words are hashed into buckets. The trusted multinomial is counted over
labelled texts of good quality, the raw one over every document, scaled to the size of the trusted one;
``pseudo`` is added to each bucket of both. A text's score is the mean over its n-grams of the logarithm of
trusted over raw probability. Logarithms are rounded to 2^-16 and added up as whole numbers, so a score does
not depend on the order of rows or tasks, and a text passes or fails the same way every time.

The threshold lies where the labelled texts that had no part in the trusted counts are told apart best;
losing a trusted text weighs ``TRUST`` times as much as keeping a rejected one.

Every label counts. The half of the texts whose ids may be learnt from is shuffled to the labels, so that no
task holds them all; the other texts stay where they are.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.tables import stored, storing
from gleanframe.llm.texts import groups, per_text, utf8, words
from gleanframe.session import reach_workers

BUCKETS = 1 << 16  # for single words, and as many for pairs
PSEUDO = 20
TRUST = 10
MIN_WORDS = 50
REPEAT_PERCENT = 50
# Scores are whole multiples of 1 / SCALE within a text, and compared in steps of 1 / STEPS.
SCALE, STEPS = 1 << 16, 1 << 10
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_WHITE = " \t\n\v\f\r"
_PAIR_STEP, _PAIR_PRIME = 1_000_003, 4_294_967_291  # two words make one number below 2^32
_KNOWN: dict[bytes, int] = {}  # hashes of words seen by this process, at most _KNOWN_MOST
_KNOWN_MOST = 1 << 17

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def word_hash(word: bytes) -> int:
    """The first 32 bits of a word's MD5."""
    found = _KNOWN.get(word)
    if found is None:
        found = int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:4], "big")
        if len(_KNOWN) < _KNOWN_MOST:
            _KNOWN[word] = found
    return found


class Words:
    """The words of a group of texts: number of the text, and of the distinct word, of each."""

    def __init__(self, column: pa.Array):
        self.data, starts = utf8(column)
        begin, end, self.firsts = words(self.data, starts)
        self.starts, self.n_texts = starts, len(starts) - 1
        self.text = per_text(self.firsts)
        lengths = end - begin
        inside = np.zeros(len(self.data) + 1, np.int8)
        np.add.at(inside, begin, 1)
        np.add.at(inside, end, -1)
        self.inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        offsets = np.zeros(len(begin) + 1, np.int64)
        np.cumsum(lengths, out=offsets[1:])
        spelled = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin),
            [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.data[self.inside]))])
        coded = spelled.dictionary_encode()
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = coded.dictionary.to_pylist()

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and text of each word and of each pair of neighbours."""
        hashes = np.fromiter(map(word_hash, self.distinct), np.int64, len(self.distinct))[self.word]
        together = self.text[1:] == self.text[:-1]
        pairs = ((hashes[:-1] * _PAIR_STEP + hashes[1:]) % _PAIR_PRIME)[together]
        return (np.concatenate([hashes % BUCKETS, BUCKETS + pairs % BUCKETS]),
                np.concatenate([self.text, self.text[1:][together]]))

    def _per_byte(self, marked: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(marked, out=sums[1:])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def word_chars(self) -> np.ndarray:
        return self._per_byte(self.inside & ((self.data & 0xC0) != 0x80))

    def symbols(self) -> np.ndarray:
        return self._per_byte(_IS_SYMBOL[self.data])

    def repeated(self) -> np.ndarray:
        """Words that lie in a window of three words which its text holds twice or more."""
        out = np.zeros(self.n_texts, np.int64)
        windows = np.flatnonzero(self.text[2:] == self.text[:-2]) if len(self.word) > 2 else []
        if not len(windows):
            return out
        n = len(self.distinct)
        pairs = np.unique(self.word[:-1] * n + self.word[1:], return_inverse=True)[1]
        triples = np.unique(pairs[windows] * n + self.word[windows + 2], return_inverse=True)[1]
        _, same, times = np.unique(triples * self.n_texts + self.text[windows],
                                   return_inverse=True, return_counts=True)
        again = windows[times[same] > 1]
        marked = np.zeros(len(self.word), bool)
        for step in range(3):
            marked[again + step] = True
        np.add.at(out, self.text[marked], 1)
        return out


def duplicate_lines(text: str | None) -> int:
    r"""The \n-split lines with a word that equal an earlier line."""
    lines = [line for line in (text or "").split("\n") if line.strip(_WHITE)]
    return len(lines) - len(set(lines))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket and task that has something in it."""
    raw, trusted = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
    for group in groups(batches):
        found = Words(group.column("text"))
        bucket, text = found.grams()
        raw += np.bincount(bucket, minlength=len(raw))
        good = group.column("learn").to_numpy(zero_copy_only=False).astype(bool)
        if good.any():
            trusted += np.bincount(bucket[good[text]], minlength=len(raw))
    used = np.flatnonzero(raw)
    yield pa.record_batch({"bucket": used.astype(np.int32), "raw": raw[used], "trusted": trusted[used]})


def weights(counts: list[tuple[int, int, int]], pseudo: int = PSEUDO) -> np.ndarray | None:
    """Per bucket the rounded logarithm of trusted over raw probability; None without trusted texts."""
    total, good = sum(c[1] for c in counts), sum(c[2] for c in counts)
    if not good:
        return None
    out = np.zeros(2 * BUCKETS, np.int64)
    for bucket, raw, trusted in counts:
        out[bucket] = math.floor(math.log((trusted + pseudo) / (raw * (good / total) + pseudo)) * SCALE + 0.5)
    return out


def _judge(weight: np.ndarray | None):
    """Counts of every text and, with weights, its summed logarithms over its n-grams."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            found = Words(group.column("text"))
            bucket, text = found.grams()
            n_grams = np.bincount(text, minlength=found.n_texts)
            total = np.zeros(found.n_texts, np.int64)
            if weight is not None:
                np.add.at(total, text, weight[bucket])
            rows = {
                "doc_id": group.column("doc_id"),
                "n_words": np.diff(found.firsts).astype(np.int64), "word_chars": found.word_chars(),
                "n_symbols": found.symbols(),
                "n_dup_lines": np.array([duplicate_lines(x.as_py()) for x in group.column("text")], np.int64),
                "n_repeat_words": found.repeated(), "n_grams": n_grams.astype(np.int64), "total": total}
            yield pa.record_batch(rows)
    return judge


def _half(id_col: str) -> Column:
    """Half of the ids, by a hash; not a null one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 2 == 0, F.lit(False))


def label_classes(labels: DataFrame, rows: int | None = None) -> DataFrame:
    """One row per labelled id: ``labelled`` is 1 where all its rows say good quality and none says toxic, 0 where
    all say poor quality; others say nothing. ``learn`` marks half of the trusted ones, by a hash of the id.

    All ids, unless a caller asks for about ``rows`` of them, chosen by a hash.
    """
    per_id = labels.filter("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.min("quality").alias("least"), F.max("quality").alias("most"),
        F.coalesce(F.max("toxic"), F.lit(0)).alias("toxic"))
    kind = F.when((F.col("least") > 0) & (F.col("toxic") == 0), 1).when(F.col("most") <= 0, 0)
    known = per_id.select("_id", kind.alias("labelled")).filter("labelled is not null")
    if rows is not None:
        share = rows / max(rows, known.count())
        place = F.pmod(F.xxhash64("_id"), F.lit(1 << 20))
        known = known.filter(place < math.ceil(share * (1 << 20)))
    return known.withColumn("learn", (F.col("labelled") == 1) & _half("_id"))


def base_failed(min_words: int = MIN_WORDS, repeat_percent: int = REPEAT_PERCENT) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def _step() -> Column:
    """The score in whole steps."""
    return F.floor(F.col("total") / (F.greatest("n_grams", F.lit(1)) * F.lit(SCALE / STEPS)))


def threshold(steps: list[tuple[int, int, int]]) -> int | None:
    """The least step that is kept, from (step, trusted, rejected): half way between the step from which keeping
    costs least (of equal ones the least) and the occupied one below it. None where a side is empty."""
    good, bad = sum(x[1] for x in steps), sum(x[2] for x in steps)
    if not good or not bad:
        return None
    lost, left, best, before = 0, bad, None, None
    for step, trusted, rejected in sorted(steps):
        cost = TRUST * lost * bad + left * good
        if best is None or cost < best[0]:
            best = cost, step if before is None else (step + before + 1) // 2
        lost, left, before = lost + trusted, left - rejected, step
    return best[1]


def _with_learn(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """Every text, and whether it is counted as a trusted one."""
    half = _half("doc_id")
    learn = classes.filter("learn").select("_id", "learn").hint("merge")
    first = texts.filter(half).join(learn, F.col("doc_id") == F.col("_id"), "left").select(
        "text", F.coalesce("learn", F.lit(False)).alias("learn"))
    return first.unionByName(texts.filter(~half).select("text", F.lit(False).alias("learn")))


def judge_documents(docs: DataFrame, labels: DataFrame, rows: int | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``score`` (mean logarithm per n-gram) and ``kept``.

    A null or empty text has no words, fails and scores 0. Rows that share an id are judged each by its own text,
    with the label of the id; a null id has no label. Other columns of either table are not looked at. Without
    trusted or without rejected texts there is no threshold, and every text that passes the base rules stays.
    """
    spark = docs.sparkSession
    reach_workers(spark)
    classes = stored(label_classes(labels, rows), "labels")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with storing(spark):
        counts = _with_learn(texts, classes).mapInArrow(
            _count_grams, "bucket int, raw long, trusted long").groupBy("bucket").agg(
            F.sum("raw"), F.sum("trusted")).collect()  # at most 2 * BUCKETS rows
    judged = stored(texts.mapInArrow(
        _judge(weights([tuple(c) for c in counts])),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, n_grams long, total long"), "quality")
    tested = classes.filter("not learn").select("_id", "labelled").hint("merge")
    steps = judged.filter(~base_failed()).join(tested, F.col("doc_id") == F.col("_id")).groupBy(_step().alias("step")).agg(
        F.count_if(F.col("labelled") == 1), F.count_if(F.col("labelled") == 0)).collect()  # a row per step
    least = threshold([tuple(s) for s in steps])
    passes = F.lit(True) if least is None else _step() >= least
    score = F.when(F.col("n_grams") > 0, F.col("total") / F.col("n_grams") / SCALE).otherwise(0.0)
    return judged.select("doc_id", *COUNTS, base_failed().alias("base_failed"), score.alias("score"),
                         (~base_failed() & passes).alias("kept"))
