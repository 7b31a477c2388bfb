"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1. One binary classifier per bit, a linear one over hashed byte
n-grams, learns to predict that bit; bits that held-out margins show to be unsure weigh less. A text
gets the language whose codeword has the least weighted exponential loss against its margins, and is
flagged as ambiguous where the second is about as near.

Losses compare languages with each other and say little of a text in none of them. So a text that has been
decoded is rejected (``Model.rejects``) for want of evidence: by how many bits a byte n-gram of it is more
likely in its language than by chance, on average. An ambiguous text may be in any language that is about as
near as the nearest. Training texts, each measured without its own share in the counts, have about two bits; a
text with less than ``LEAST`` of their median is in none of the languages. The measure counts as though
``BEFORE`` bytes with the usual evidence stood before each text, so that a word or two do not decide, with no
switch at any size.

Training sees at most ``sample_rows`` labelled texts, the same number of each language, chosen by a
hash of their id. That is all that reaches the driver, as one row of ``DIMENSIONS`` counts each.
Predictions read whole texts and nothing but texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField
from pyspark.sql.window import Window

from gleanframe.llm.tables import id_and_text, id_column, quoted, shown_id, stored, with_fields
from gleanframe.llm.texts import groups, utf8
from gleanframe.session import reach_workers

DIMENSIONS = 1 << 12
GRAMS = (2, 3, 4)
RIDGE = 0.05
UNKNOWN = "und"
LEAST = 0.1  # of the usual evidence is the least of a text in one of the languages
BEFORE = 16
NEAR = 1.25  # times the least loss is about as near
CHANCE = 0.05  # of all n-grams are as likely as any other, in every language
ROWS = 128  # texts whose counts are held at once
# letters of ASCII and all bytes of other characters stay, the rest is one kind of gap
_SEEN = np.full(256, 32, np.uint64)
_SEEN[97:123] = np.arange(97, 123)
_SEEN[128:] = np.arange(128, 256)


def features(column: pa.Array) -> np.ndarray:
    """A row per text: square roots of its n-gram shares, of length one; zeros without n-grams."""
    data, starts = utf8(pc.utf8_lower(pc.fill_null(column, "")))
    seen = _SEEN[data]
    out = np.zeros(len(column) * DIMENSIONS)
    lengths = np.diff(starts)
    text = np.repeat(np.arange(len(column), dtype=np.int64) * DIMENSIONS, lengths)
    left = np.repeat(starts[1:], lengths) - np.arange(len(data))  # bytes of the text from here on
    gram = seen
    for n in range(2, max(GRAMS) + 1):
        gram = (gram[:-1] << np.uint64(8)) | seen[n - 1:] if len(gram) > 1 else gram[:0]
        if n in GRAMS and len(gram):
            slot = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
            use = left[:len(gram)] >= n
            out += np.bincount(text[:len(gram)][use] + slot[use].astype(np.int64), minlength=len(out))
    out = np.sqrt(out.reshape(len(column), DIMENSIONS))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 per language: for up to six all ways to part them into two, beyond that
    random columns of which the best of many draws is taken."""
    if n <= 6:
        columns = [[1] + [1 if cut >> k & 1 else -1 for k in range(n - 1)] for cut in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.float32).reshape(-1, n).T
    rng = np.random.default_rng(n)
    length = 8 * int(np.ceil(np.log2(n)))
    draws = [rng.choice([-1.0, 1.0], (n, length)) for _ in range(50)]
    apart = [(length - (d @ d.T - 2 * length * np.eye(n)).max()) for d in draws]
    return draws[int(np.argmax(apart))].astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # language by bit
    weights: np.ndarray  # dimension by bit
    trust: np.ndarray  # per bit
    scale: float
    likely: np.ndarray  # dimension by language: bits against chance
    usual: float = 0.0  # evidence of a text in one of the languages; nothing is rejected where it is not above 0

    def losses(self, rows: np.ndarray) -> np.ndarray:
        """Weighted loss of each row against each codeword."""
        margins = np.clip(self.scale * (rows @ self.weights), -8, 8)
        return (np.exp(-margins[:, None, :] * self.codes[None]) * self.trust).sum(axis=2)

    def rejects(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Does a text of so many bytes lack evidence of the language it decodes to, and of those about as
        near? One without n-grams is not judged."""
        losses = self.losses(rows)
        least = losses.min(axis=1, keepdims=True)
        decoded = (losses == least) | (losses < NEAR * least)
        evidence = np.where(decoded, np.square(rows) @ self.likely, -np.inf).max(axis=1)
        smooth = (sizes * evidence + BEFORE * self.usual) / (sizes + BEFORE)
        return (smooth < LEAST * self.usual) & rows.any(axis=1) & (self.usual > 0)

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest language, a score from 0 to 1, and whether it is ambiguous."""
        losses = self.losses(rows)
        if len(self.languages) == 1:
            return np.zeros(len(rows), int), np.ones(len(rows)), np.zeros(len(rows), bool)
        order = np.argsort(losses, axis=1, kind="stable")
        least = np.take_along_axis(losses, order[:, :2], 1)
        shares = np.exp(-np.log(losses / least[:, :1]) * 2)  # inverse squares
        return order[:, 0], 1 / shares.sum(axis=1), least[:, 1] < NEAR * least[:, 0]


def bits(counts: np.ndarray) -> np.ndarray:
    """How much likelier each n-gram is than by chance, in bits, from a language's counts."""
    shares = counts / counts.sum()
    return np.log2((1 - CHANCE) * DIMENSIONS * shares + CHANCE)


def evidence_of(rows: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, float]:
    """Bits of each language, and the median evidence of its own texts, each left out of the counts; 0
    where every language has one text only."""
    shares = np.square(rows, dtype=float)
    counts = np.stack([shares[number == k].sum(axis=0) + 1e-9 for k in range(number.max() + 1)])
    texts = np.bincount(number)
    found = [shares[k] @ bits(np.maximum(counts[n] - shares[k], 0))
             for k, n in enumerate(number) if texts[n] > 1 and rows[k].any()]
    return np.stack([bits(c) for c in counts], axis=1).astype(np.float32), float(np.median(found or [0.0]))


def fit(rows: np.ndarray, labels: list[str]) -> Model:
    """Ridge classifiers for all bits, in closed form; margins with each text left out tell how far
    to trust a bit."""
    languages = sorted(set(labels))
    codes = codewords(len(languages))
    number = np.array([languages.index(x) for x in labels])
    evidence = evidence_of(rows, number)
    wanted = codes[number]
    if len(languages) == 1:
        return Model(languages, codes, np.zeros((rows.shape[1], 0), np.float32), np.ones(0), 1.0, *evidence)
    alike = (rows @ rows.T).astype(float)
    alike[np.diag_indices(len(rows))] += RIDGE
    inverse = np.linalg.inv(alike)
    alpha = inverse @ wanted
    left_out = wanted - alpha / np.diag(inverse)[:, None]
    wrong = np.clip((left_out * wanted < 0).mean(axis=0), 0.01, 0.49)
    trust = np.log((1 - wrong) / wrong)
    return Model(languages, codes, rows.T @ alpha.astype(np.float32), trust / trust.sum(),
                 float(2 / max(1e-6, np.abs(left_out).mean())), *evidence)


def learnable(id_col: str = "doc_id") -> Column:
    """Rows to learn from: those whose id, as text, has a CRC-32 that 5 does not divide."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def train(docs: DataFrame, sample_rows: int = 1200, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model | None:
    """From rows with an id that is ``learnable``, a text and a language; None without any."""
    rows = docs.filter(learnable(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    narrow = rows.select(id_column(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"))
    # no more languages than rows to learn from
    languages = stored(narrow.groupBy("lang").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "lang").limit(sample_rows), "languages")
    n_languages = languages.count()
    if not n_languages:
        return None
    each = max(1, sample_rows // n_languages)
    # about twice as many of each by a hash, whatever their number, and of those the first
    few = narrow.join(F.broadcast(languages), "lang").filter(
        F.pmod(F.xxhash64("id", F.lit(5)), F.col("n")) < 2 * each + 64)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = few.withColumn("rank", rank).filter(F.col("rank") <= each).limit(sample_rows)
    texts = id_and_text(rows, id_col, text_col).join(F.broadcast(chosen.select("id", "lang")), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            counts = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("lang"),
                pa.array([x.tobytes() for x in counts], pa.binary())], ["id", "lang", "counts"])

    found = texts.mapInArrow(run, "id bigint, lang string, counts binary").limit(2 * sample_rows).toArrow()
    found = found.sort_by([("id", "ascending"), ("lang", "ascending")])
    if not found.num_rows:
        return None
    counts = np.empty((found.num_rows, DIMENSIONS), np.float32)
    for n, row in enumerate(found.column("counts")):
        counts[n] = np.frombuffer(row.as_buffer(), np.float32)
    labels = found.column("lang").to_pylist()
    del found
    return fit(counts, labels)


def _slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, column):
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _letters(column: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(column, r"\p{L}").to_numpy(zero_copy_only=False)


def identify_rows(rows: DataFrame, model: Model | None, text_col: str = "text",
                  names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous"), reject: bool = False) -> DataFrame:
    """The rows with a language, its score and whether it is ambiguous; columns of the same names are
    replaced. Nothing but the text decides; see ``identify``. With ``reject``, texts that the model rejects are
    of language ``und`` with score 0 too."""
    kept, schema = with_fields(rows, StructField(names[0], StringType()),
                               StructField(names[1], DoubleType()), StructField(names[2], BooleanType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, text_col):
            column = pc.fill_null(batch.column(text_col), "")
            letters = _letters(column)
            n = batch.num_rows
            best, score, unsure = np.zeros(n, int), np.zeros(n), np.zeros(n, bool)
            if model is not None:
                counts = features(column)
                best, score, unsure = model.decode(counts)
                if reject:
                    letters = letters & ~model.rejects(counts, pc.binary_length(column).to_numpy())
            known = letters & (model is not None)
            found = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(found, pa.string()),
                 pa.array(np.where(known, score, 0.0)), pa.array(known & unsure)], schema.names)

    return rows.select(*quoted(kept)).mapInArrow(run, schema)


def with_language(rows: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows in whose text a language is identified that the model does not reject; without a model, those
    whose text holds a letter."""
    if model is None:
        def lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches, text_col):
                yield batch.filter(pa.array(_letters(pc.fill_null(batch.column(text_col), "")), pa.bool_()))

        reach_workers(rows.sparkSession)
        return rows.mapInArrow(lettered, rows.schema)
    mark = "_lang"  # begins the name of no column
    while any(c.lower().startswith(mark) for c in rows.columns):
        mark = f"_{mark}"
    names = (f"{mark}_pred", f"{mark}_score", f"{mark}_ambiguous")
    found = identify_rows(rows, model, text_col, names, reject=True)
    # a language that is known scores more than 0, one named "und" too
    return found.filter(F.col(names[1]) > 0).drop(*names)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out`` (not to be learnt from), ``lang_pred``, ``score`` and ``ambiguous``.

    Texts that are null or hold no letter are of language ``und`` with score 0, as are all where there
    was nothing to learn from. Rows that repeat get the same; a null id is not held out. Other columns
    are not read; no rows give no rows.
    """
    found = identify_rows(id_and_text(docs, id_col, text_col), model)
    found = found.select(shown_id("id").alias(id_col), "lang_pred", "score", "ambiguous")
    return found.select(id_col, F.coalesce(~learnable(id_col), F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "ambiguous")
