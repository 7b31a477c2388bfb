"""Scores of documents by masked pseudo-likelihood.

A small network sees the ``SIDE`` words on either side of a place and predicts the word there. The sum
of the logarithms of these predictions over all places of a document is its score: each word is
judged from both sides, with all others given.

Symbols are the most frequent words of all documents and, for all other words, ``TAILS`` classes by
their last two bytes. There are ``SYMBOLS`` of them or, when the documents have many distinct words, as
many more as the square root of their number demands. The network predicts a symbol; a word of a class
has, besides, its own share of the class: its count by that of all the class's words and one more,
which is what words that were never counted have. Symbols are binned by frequency, and the network
predicts bin and symbol in turn, so that a prediction touches its bin and the list of bins instead of all.

Counts cover all words of all documents, combined in every task, and stay a table. Words of classes meet
their counts there: tasks send the words of a group of texts to the parts of the table, which send back
sums per text. Training goes over every place of every document. Their symbols are stored once, in stretches, and
dealt to shards by a hash of what they hold; how many shards there are follows from the number of words. In each of
``rounds`` passes every shard starts from the same weights, trains on its stretches of that pass in a fixed order, and
the weights are averaged by the words seen, first among groups of shards. The driver gets no more
words than there are symbols, ``TAILS`` counts and ``AVERAGES`` sets of weights.

A word is a run of bytes other than 9 to 13 and 32; A-Z count as lower case. The places before the
first and behind the last word hold a mark. Null texts and texts without words have no places and
score 0. Rows that repeat score alike, and a null id is one like any other. Other columns are not read;
no rows give no rows. How the documents are split into files and tasks makes no difference but for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, isqrt, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.tables import discard, id_and_text, shown_id, stored
from gleanframe.llm.texts import LOWER, groups, mix, per_text, span_hashes, utf8, words

BINS, BIN, TAILS = 32, 32, 256
SYMBOLS = BINS * BIN
EDGE = SYMBOLS  # the mark around a text
SIDE, WIDTH, HIDDEN = 2, 8, 24
BATCH, RATE, AVERAGES = 8192, 0.02, 32  # the rate goes with the root of the batch, LEAST_RATE at least
LEAST_RATE = 0.004
SHARD_WORDS, SHARDS = 1 << 21, 512  # words of a shard; beyond so many shards both grow alike
STRETCH, TAKE = 1 << 18, 1 << 18  # words of a stretch at most; places that are shuffled together
DISTINCT = 32  # a bin for so much of the square root of the distinct words, BINS at least
PART_WORDS, PARTS = 1 << 17, 256  # of the table of counts: words in a part, and parts at least


def shapes(bins: int) -> dict[str, tuple[int, ...]]:
    return {"embed": (bins * BIN + 1, WIDTH), "into": (2 * SIDE * WIDTH, HIDDEN), "shift": (HIDDEN,),
            "bins": (HIDDEN, bins), "bin_bias": (bins,), "words": (bins, HIDDEN, BIN), "word_bias": (bins, BIN)}


def n_weights(bins: int) -> int:
    return sum(int(np.prod(s)) for s in shapes(bins).values())


WEIGHTS = n_weights(BINS)


@dataclass
class Symbols:
    """Hashes of the frequent words, ascending, with their symbols; symbol of each tail class and the
    logarithm of the share that a word without a count has of it; the number of bins."""

    hashes: np.ndarray
    symbols: np.ndarray
    tails: np.ndarray
    tail_logs: np.ndarray
    bins: int = BINS

    @property
    def edge(self) -> int:
        return self.bins * BIN

    def of(self, hashes: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each word, and what its choice among the words of its class costs if it has no count."""
        if not len(self.hashes):
            return self.tails[tails], self.tail_logs[tails]
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        return (np.where(known, self.symbols[at], self.tails[tails]),
                np.where(known, 0.0, self.tail_logs[tails]))


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and tail class of every word, and the first word of each text."""
    data, starts = utf8(column)
    data = LOWER[data]
    begin, end, firsts = words(data, starts)
    last = data[end - 1].astype(np.uint64)
    before = np.where(end - begin > 1, data[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    tails = (mix(before * np.uint64(256) + last) % np.uint64(TAILS)).astype(np.int64)
    return span_hashes(data, begin, end), tails, firsts


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, tail, n`` of every distinct word (its hash) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, size=8 << 20):
            hashes, tails, _ = _words(batch.column("text"))
            found, first, n = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(tails[first].astype(np.int32)), pa.array(n)],
                ["word", "tail", "n"])

    found = id_and_text(docs, id_col, text_col).select("text").mapInArrow(
        run, "word bigint, tail int, n bigint")
    return found.groupBy("word", "tail").agg(F.sum("n").alias("n"))


def choose_symbols(counts: DataFrame) -> Symbols:
    """The most frequent words and the classes of all others, by frequency."""
    classes = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).toPandas()
    bins = max(BINS, isqrt(int(classes["distinct"].sum())) // DISTINCT)
    frequent = counts.orderBy(F.desc("n"), "word").limit(bins * BIN - TAILS).toPandas()
    n = np.zeros(TAILS)
    n[classes["tail"]] = classes["n"]
    np.subtract.at(n, frequent["tail"], frequent["n"])
    order = np.argsort(-np.concatenate([frequent["n"], n]), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    hashes = frequent["word"].to_numpy(np.int64).view(np.uint64)
    ascending = np.argsort(hashes)
    return Symbols(hashes[ascending], place[:len(hashes)][ascending], place[len(hashes):],
                   -np.log(n + 1), bins)


def n_shards(words: int) -> int:
    """Shards for so many words, whoever reads them."""
    plain = ceil(words / SHARD_WORDS)
    return max(1, plain if plain <= SHARDS else ceil(sqrt(plain * SHARDS)))


_OFFSETS = np.array([k for k in range(-SIDE, SIDE + 1) if k])


def places(column: pa.Array, symbols: Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts with marks around each text, where the words stand in there, their texts
    and their costs without their counts."""
    return _places(*_words(column), symbols)


def _places(hashes: np.ndarray, tails: np.ndarray, firsts: np.ndarray,
            symbols: Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found, cost = symbols.of(hashes, tails)
    text = per_text(firsts)
    at = np.arange(len(found)) + SIDE * (text + 1)
    line = np.full(len(found) + SIDE * (len(firsts) + 1), symbols.edge, np.int64)
    line[at] = found
    return line, at, text, cost


class Network:
    """Weights as one vector, with a view for each part."""

    def __init__(self, vector: np.ndarray):
        self.vector, start = vector, 0
        self.n_bins = (len(vector) - n_weights(0)) // (n_weights(1) - n_weights(0))
        for name, shape in shapes(self.n_bins).items():
            size = int(np.prod(shape))
            setattr(self, name, vector[start:start + size].reshape(shape))
            start += size

    @classmethod
    def fresh(cls, bins: int = BINS) -> Network:
        rng = np.random.default_rng(11)
        new = cls(np.zeros(n_weights(bins), np.float32))
        new.embed[:] = rng.normal(0, 0.3, new.embed.shape)
        for part in (new.into, new.bins, new.words):
            part[:] = rng.normal(0, 1 / np.sqrt(part.shape[-2]), part.shape)
        return new

    def _hidden(self, line: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What stands around each place, as symbols and as vectors, and the hidden layer: a column a place."""
        around = line[at[None, :] + _OFFSETS[:, None]]
        seen = np.ascontiguousarray(self.embed[around].transpose(0, 2, 1)).reshape(-1, len(at))
        return around, seen, np.tanh(self.into.T @ seen + self.shift[:, None])

    def logs(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of the word at each place."""
        order, spans = _in_bins(line[at])
        at = at[order]
        bin_, inner = np.divmod(line[at], BIN)
        _, _, hidden = self._hidden(line, at)
        found = _picked(self.bins.T @ hidden + self.bin_bias[:, None], bin_)
        for b, first, last in spans:
            found[first:last] += _picked(
                self.words[b].T @ hidden[:, first:last] + self.word_bias[b][:, None], inner[first:last])
        out = np.empty(len(at), found.dtype)
        out[order] = found
        return out

    def slope(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Gradient of the mean negative logarithm."""
        n = len(at)
        down = Network(np.zeros_like(self.vector, np.float32))
        order, spans = _in_bins(line[at])
        at = at[order]
        bin_, inner = np.divmod(line[at], BIN)
        around, seen, hidden = self._hidden(line, at)
        off = _soft(self.bins.T @ hidden + self.bin_bias[:, None])
        off[bin_, np.arange(n)] -= 1
        off /= n
        down.bins[:], down.bin_bias[:] = hidden @ off.T, off.sum(axis=1)
        back = self.bins @ off
        for b, first, last in spans:
            part = hidden[:, first:last]
            off = _soft(self.words[b].T @ part + self.word_bias[b][:, None])
            off[inner[first:last], np.arange(last - first)] -= 1
            off /= n
            down.words[b], down.word_bias[b] = part @ off.T, off.sum(axis=1)
            back[:, first:last] += self.words[b] @ off
        back *= 1 - hidden * hidden
        down.into[:], down.shift[:] = seen @ back.T, back.sum(axis=1)
        at_embed = (self.into @ back).reshape(2 * SIDE, WIDTH, n)
        which = around.reshape(-1)
        for k in range(WIDTH):
            down.embed[:, k] = np.bincount(which, at_embed[:, k].reshape(-1), len(self.embed))
        return down.vector


def _picked(logits: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of each column the logarithm of the share of one row."""
    top = logits.max(axis=0)
    return logits[rows, np.arange(len(rows))] - top - np.log(np.exp(logits - top).sum(axis=0))


def _soft(logits: np.ndarray) -> np.ndarray:
    """Shares of the rows in each column."""
    out = np.exp(logits - logits.max(axis=0))
    out /= out.sum(axis=0)
    return out


def _in_bins(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by bins, and each bin that occurs with its begin and end in it."""
    order = np.argsort((symbols // BIN).astype(np.uint16), kind="stable")
    found = symbols[order] // BIN
    edges = np.flatnonzero(np.diff(found, prepend=-1, append=-1))
    return order, [(int(found[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]


def _by_bin(bins: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bins.astype(np.uint16), kind="stable")
    found = bins[order]
    edges = np.flatnonzero(np.diff(found, prepend=-1, append=-1))
    for first, last in zip(edges[:-1], edges[1:]):
        yield int(found[first]), order[first:last]


class Trainer:
    """Adam on shuffled places."""

    def __init__(self, network: Network, batch: int = BATCH):
        self.network, self.batch, self.steps = network, batch, 0
        self.rate = max(LEAST_RATE, RATE * sqrt(batch / BATCH))
        self.mean, self.square = (np.zeros(len(network.vector), np.float32) for _ in range(2))

    def take(self, line: np.ndarray, at: np.ndarray) -> None:
        order = np.random.default_rng(len(at)).permutation(at)
        for start in range(0, len(order), self.batch):
            slope = self.network.slope(line, order[start:start + self.batch])
            self.steps += 1
            self.mean += 0.1 * (slope - self.mean)
            self.square += 0.01 * (slope * slope - self.square)
            rate = self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
            self.network.vector -= rate * self.mean / (np.sqrt(self.square) + 1e-6)


@dataclass
class Model:
    symbols: Symbols
    weights: np.ndarray
    counts: DataFrame  # of every word


def _symbol_type(symbols: Symbols) -> type:
    return np.uint16 if symbols.edge < 1 << 16 else np.uint32


def stretches(docs: DataFrame, symbols: Symbols, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The symbols of all texts, in pieces of at most STRETCH words with their neighbours or marks on both
    sides: ``id, place, line``, ``place`` counting the pieces of a text."""
    kind = _symbol_type(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            line, at, text, _ = places(batch.column("text"), symbols)
            line, ids = line.astype(kind), batch.column("id").to_pylist()
            # the first place of each text, and of each further piece
            n = np.bincount(text, minlength=batch.num_rows)
            rows = []
            for number, (first, size) in enumerate(zip(np.cumsum(n) - n, n)):
                for place, start in enumerate(range(0, int(size), STRETCH)):
                    begin = at[first + start]
                    end = begin + min(STRETCH, size - start)
                    rows.append((ids[number], place, line[begin - SIDE:end + SIDE].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                ["id", "place", "line"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "id bigint, place bigint, line binary")


_WEIGHTS = "shard int, n bigint, weights binary"


def _weight_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary()))],
        ["shard", "n", "weights"])


def _trained(weights: np.ndarray, batch_places: int, kind: type):
    """Weights of each shard, from stretches in the order of shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, trainer, n, held, size = None, None, 0, [], 0

        def take() -> None:
            if held:
                lines = [np.frombuffer(x, kind) for x in held]
                ends = np.cumsum([len(x) for x in lines])
                inside = [np.arange(end - len(x) + SIDE, end - SIDE) for x, end in zip(lines, ends)]
                trainer.take(np.concatenate(lines).astype(np.int64), np.concatenate(inside))
                held.clear()

        for batch in batches:
            for number, line in zip(batch.column("shard").to_pylist(), batch.column("line").to_pylist()):
                if number != shard:
                    if trainer:
                        take()
                        yield _weight_rows([(shard, n, trainer.network.vector.tobytes())])
                    shard, trainer, n, size = number, Trainer(Network(weights.copy()), batch_places), 0, 0
                words = len(line) // np.dtype(kind).itemsize - 2 * SIDE
                held.append(line)
                n, size = n + words, size + words
                if size >= TAKE:
                    take()
                    size = 0
        if trainer:
            take()
            yield _weight_rows([(shard, n, trainer.network.vector.tobytes())])

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One set of weights of a group of shards, in their order."""
    total, n, first = 0.0, 0, None
    for batch in batches:
        for shard, size, weights in zip(*(batch.column(c).to_pylist() for c in ("shard", "n", "weights"))):
            first = shard if first is None else first
            total = total + size * np.frombuffer(weights, np.float32).astype(float)
            n += size
    if n:
        yield _weight_rows([(first, n, (total / n).astype(np.float32).tobytes())])


def train(docs: DataFrame, rounds: int = 2, epochs: int = 1, batch_places: int = BATCH,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Symbols and weights from all documents, each of which is seen ``epochs`` times."""
    counts = stored(count_words(docs, id_col, text_col), "words")
    symbols = choose_symbols(counts)
    shards = n_shards(counts.agg(F.sum("n")).first()[0] or 0)
    dealt = F.xxhash64("id", "place", "line")
    lines = stored(stretches(docs, symbols, id_col, text_col).select(
        dealt.alias("dealt"), F.pmod(dealt, F.lit(shards)).cast("int").alias("shard"), "line"), "symbols")
    weights = Network.fresh(symbols.bins).vector
    for number in range(rounds * epochs):
        share = lines.filter(F.pmod(F.xxhash64("dealt", F.lit(7)), F.lit(rounds)) == number % rounds)
        trained = share.repartition(shards, "shard").sortWithinPartitions("shard", "dealt").select(
            "shard", "line").mapInArrow(_trained(weights, batch_places, _symbol_type(symbols)), _WEIGHTS)
        found = trained.withColumn("_group", F.pmod("shard", F.lit(AVERAGES))).repartition(
            AVERAGES, "_group").sortWithinPartitions("_group", "shard").drop("_group").mapInArrow(
            _averaged, _WEIGHTS).toPandas().sort_values("shard")
        if len(found):
            weights = np.average(np.stack([np.frombuffer(w, np.float32) for w in found["weights"]]),
                                 axis=0, weights=found["n"]).astype(np.float32)
    discard(docs.sparkSession, lines)
    return Model(symbols, weights, counts)


# Parcels between texts and parts of the table of counts: to a part come its counts (words and their
# logarithms), then words with their texts, then heads of groups (ids, numbers of words, sums so far).
# From it go the heads (part -1) and sums (texts and sums). A group is named by two numbers.
_COUNTS, _ASKED, _HEAD = 0, 1, 2
_PARCELS = "part int, kind int, task int, number int, a binary, b binary, c binary"
_FIELDS = [f.split()[0] for f in _PARCELS.split(", ")]


def _parcel(part: int, kind: int, task: int, number: int, *arrays: np.ndarray) -> tuple:
    return (part, kind, task, number, *(x.tobytes() for x in (*arrays, np.zeros(0))[:3]))


def _parcels(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32()] * 4 + [pa.binary()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _FIELDS)


def _by_part(hashes: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    return _by_bin((mix(hashes) % np.uint64(parts)).astype(np.int64))


def _count_parcels(counts: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("word").to_numpy().view(np.uint64)
            logs = np.log(batch.column("n").to_numpy())
            rows = [_parcel(part, _COUNTS, 0, 0, hashes[at], logs[at]) for part, at in _by_part(hashes, parts)]
            if rows:
                yield _parcels(rows)

    # a count of one adds nothing
    return counts.filter("n > 1").select("word", "n").mapInArrow(run, _PARCELS)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In order of parts and kinds: heads as they are, and what the counts of words add to texts."""
    current, hashes, logs = None, [], []
    for batch in batches:
        rows = []
        for part, kind, task, number, *data in zip(*(c.to_pylist() for c in batch.columns)):
            if part != current:
                current, hashes, logs, known = part, [], [], None
            if kind == _COUNTS:
                hashes.append(np.frombuffer(data[0], np.uint64))
                logs.append(np.frombuffer(data[1], np.float64))
            elif kind == _HEAD:
                rows.append((-1, kind, task, number, *data))
            elif hashes:
                if known is None:
                    known, costs = np.concatenate(hashes), np.concatenate(logs)
                    order = np.argsort(known)
                    known, costs = known[order], costs[order]
                asked, texts = np.frombuffer(data[0], np.uint64), np.frombuffer(data[1], np.int32)
                at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                same = known[at] == asked
                if same.any():
                    low = int(texts[0])  # texts ascend
                    sums = np.bincount(texts[same] - low, costs[at[same]])
                    some = np.flatnonzero(sums)
                    rows.append(_parcel(part, kind, task, number, (some + low).astype(np.int32), sums[some]))
        if rows:
            yield _parcels(rows)


_SCORES = "id bigint, n_words bigint, log_likelihood double, per_word double"


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group its head, then sums in the order of the parts."""
    head = None

    def scores() -> pa.RecordBatch:
        ids, n, total = head
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1))],
            [f.split()[0] for f in _SCORES.split(", ")])

    for batch in batches:
        for kind, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("kind", "a", "b", "c"))):
            if kind == _HEAD:
                if head:
                    yield scores()
                head = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), np.frombuffer(c).copy()
            else:
                head[2][np.frombuffer(a, np.int32)] += np.frombuffer(b)
    if head:
        yield scores()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``log_likelihood`` (the sum over all places, natural logarithms) and
    ``per_word``, its mean; 0 without words."""

    parts = max(PARTS, model.counts.count() // PART_WORDS + 1)
    symbols, weights = model.symbols, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        network, task = Network(weights.copy()), TaskContext.get().partitionId()
        for number, batch in enumerate(groups(batches)):
            hashes, tails, firsts = _words(batch.column("text"))
            line, at, text, cost = _places(hashes, tails, firsts, symbols)
            logs = np.concatenate([np.zeros(0), *(
                network.logs(line, at[k:k + 2 * BATCH]) for k in range(0, len(at), 2 * BATCH))]) + cost
            n = np.bincount(text, minlength=batch.num_rows).astype(np.int64)
            total = np.bincount(text, logs, batch.num_rows).astype(float)
            asked = np.flatnonzero(cost)
            hashes, text = hashes[asked], text[asked].astype(np.int32)
            rows = [_parcel(part, _ASKED, task, number, hashes[some], text[some])
                    for part, some in _by_part(hashes, parts)]
            rows.append(_parcel((task + number) % parts, _HEAD, task, number,
                                batch.column("id").to_numpy(), n, total))
            yield _parcels(rows)

    sent = id_and_text(docs, id_col, text_col).mapInArrow(run, _PARCELS)
    found = _count_parcels(model.counts, parts).unionByName(sent).repartition("part").sortWithinPartitions(
        "part", "kind").mapInArrow(_answers, _PARCELS)
    found = found.repartition("task", "number").sortWithinPartitions("task", "number", "part").mapInArrow(
        _totals, _SCORES)
    return found.select(shown_id("id").alias(id_col), "n_words", "log_likelihood", "per_word")
