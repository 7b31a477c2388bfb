"""Encoding and decoding with a SentencePiece model, many words at a time.

The text is cut into words: a run of spaces with what follows up to the next space. No piece holds a
space behind another character, so words are encoded alone, and equal words once, as long as they are remembered.
Words of one length advance together: at each end, the substrings of all lengths are looked up by
their hashes in the sorted keys of the pieces, and the best predecessor is stored as a back pointer.

Each end keeps the best sum of scores of a path to it. In a unigram model a step scores as its piece does,
in the library's precision; of equal sums the longest last piece wins. The library adds up from the begin of
the text and not of the word, so it may order the pieces of equally good paths otherwise.

In a BPE model a path is as good as it is possible: a piece may follow another only if merging the text of
both, by score and from the left, ends in just these two. Such a step scores 0, any other minus infinity.
Merges of other words' parts do not interfere, so the encoding of a word is the path all of whose neighbours
may follow each other; each end has one such predecessor. Whether two pieces may is found by merging
their text, again for many pairs at once, and remembered.

That also lets a long word without spaces be cut: windows of it that overlap are encoded like words of one
length, and joined at a piece that both have in the same place. All neighbours in the joined path may
follow each other, so it is the encoding of the whole. Where two windows share no piece, the windows from there
on are laid anew from an end of a piece of the first; where that fails, the word is encoded at one go. So are long
words in unigram models, whose best path may depend on text far away.

A model's file is read where the plan is made; the tables made from it (a few MB) travel with the
tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField

from gleanframe.llm.tables import id_and_text, quoted, shown_id, with_fields
from gleanframe.llm.texts import BASE, INVERSE, groups, mix

SPACE = 0x2581  # the sign that stands for a space
GROUP = 1 << 20
GROUPS_LEARNT = 12  # whose new words are encoded together
FILTER_BITS = 22
MEMORY_BITS = 21  # of the table of pairs that were tried
WORDS_AT_ONCE = 1 << 14
STEP = 720  # of the windows of a long word: a multiple of the lengths of most pieces, for runs of one character
OVERLAP = 96
WORDS_KEPT = 1 << 20  # words whose pieces are remembered; with more the memory starts afresh


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial along each row, one column more than the rows."""
    sums = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    np.cumsum(_values(rows) * _powers(rows.shape[1], BASE), axis=1, out=sums[:, 1:])
    return sums


def _values(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64) + np.uint64(1))


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """Powers of a base, kept for the next call."""
    if len(_POWERS.get(base, ())) < n:
        steps = np.full(max(n, GROUP), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps)
    return _POWERS[base][:n]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Vocabulary:
    """The pieces of a model, as sorted arrays."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        norm = model.normalizer_spec
        kind, known = model.trainer_spec.model_type, proto.TrainerSpec
        if kind not in (known.BPE, known.UNIGRAM) or norm.precompiled_charsmap or (
                norm.remove_extra_whitespaces or not norm.escape_whitespaces):
            raise ValueError("only BPE and unigram models that keep their text as it is")
        kinds = proto.ModelProto.SentencePiece
        self.merges = kind == known.BPE
        if not self.merges and any(piece.type == kinds.USER_DEFINED for piece in model.pieces):
            raise ValueError("a unigram model with pieces of the user's own")
        self.prefix = norm.add_dummy_prefix
        self.surface: list[bytes] = []
        self.bytes = np.full(256, -1, np.int32)
        self.unknown = 0
        names: dict[str, int] = {}
        score: list[float] = []
        for number, piece in enumerate(model.pieces):
            surface = piece.piece.replace(chr(SPACE), " ").encode()
            if piece.type == kinds.BYTE:
                value = int(piece.piece[3:5], 16)
                self.bytes[value], surface = number, bytes([value])
            elif piece.type == kinds.UNKNOWN:
                self.unknown, surface = number, " ⁇ ".encode()
            elif piece.type == kinds.CONTROL:
                surface = b""
            else:
                names[piece.piece] = number
            self.surface.append(surface)
            score.append(piece.score)
        if any(chr(SPACE) in name.lstrip(chr(SPACE)) for name in names):
            raise ValueError("a piece spans a space")
        if not self.merges and not set("".join(names)) <= set(names):
            raise ValueError("a unigram model with a character that is no piece")
        self.longest = max(map(len, names))
        self.scores = np.array(score, np.float32)
        ids = np.array(list(names.values()))
        # sorted keys of the pieces
        keys = np.array([_word_hash(_points(name)) for name in names], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], ids[order].astype(np.int32)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        # rank of each piece by score, best first; equal scores share a rank
        best = sorted({-score[i] for i in ids})
        ranks = {s: n for n, s in enumerate(best)}
        self.rank = np.full(len(score), 2**30, np.int64)
        for i in ids:
            self.rank[i] = ranks[-score[i]]
        # all ways to put a piece together from two
        joins = sorted((names[name[:k]] << 32 | names[name[k:]], number) for name, number in names.items()
                       for k in range(1, len(name)) if name[:k] in names and name[k:] in names)
        self.join_keys = np.array([k for k, _ in joins], np.int64)
        self.join_ids = np.array([i for _, i in joins], np.int32)
        self.characters = np.array(sorted(ord(name) for name in names if len(name) == 1), np.uint32)
        # characters of every piece, one behind the other
        text = [""] * len(score)
        for name, number in names.items():
            text[number] = name
        self.lengths = np.array([len(t) for t in text])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.symbols = self.find(_hash_each(_points("".join(text))))
        # pieces that merging their own characters gives
        self.alone = np.zeros(len(score), bool)
        self.alone[ids] = _merges_to(self, ids[:, None])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 where there is none."""
        out = np.full(hashes.shape, -1, np.int32)
        flat, into = hashes.reshape(-1), out.reshape(-1)
        maybe = np.flatnonzero(self.filter[(flat >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, flat[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == flat[maybe]
        into[maybe[hit]] = self.ids[at[hit]]
        return out


def _word_hash(points: np.ndarray) -> np.uint64:
    return mix(_hash_rows(points[None])[:, -1])[0]


def _hash_each(points: np.ndarray) -> np.ndarray:
    """The hash of each single character."""
    return mix(_values(points))


def _merges_to(vocabulary: Vocabulary, wanted: np.ndarray) -> np.ndarray:
    """Does merging the text of each row of pieces, best score first and from the left, end in just
    these pieces?"""
    lengths = vocabulary.lengths[wanted].sum(axis=1)
    out = np.zeros(len(wanted), bool)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        flat = wanted[rows].reshape(-1)
        size = vocabulary.lengths[flat]
        at = np.repeat(vocabulary.starts[flat] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        now = vocabulary.symbols[at].reshape(len(rows), n).astype(np.int64)
        busy = np.arange(len(rows))
        final = np.full((len(rows), n), -1, np.int64)
        while len(busy):
            key = (now[:, :-1] << 32) | np.maximum(now[:, 1:], 0)
            found = np.minimum(np.searchsorted(vocabulary.join_keys, key), len(vocabulary.join_keys) - 1)
            can = (vocabulary.join_keys[found] == key) & (now[:, 1:] >= 0) if key.size else np.zeros(key.shape, bool)
            joined = np.where(can, vocabulary.join_ids[found], 0) if key.size else key
            rank = np.where(can, vocabulary.rank[joined], 2**31)
            going = can.any(axis=1)
            final[busy[~going], :now.shape[1]] = now[~going]
            now, joined, rank, busy = now[going], joined[going], rank[going], busy[going]
            if not len(busy):
                break
            at = np.argmin(rank, axis=1)
            row = np.arange(len(busy))
            now[row, at] = joined[row, at]
            # close the gap behind the merged symbol
            column = np.arange(now.shape[1])[None]
            source = np.minimum(column + (column > at[:, None]), now.shape[1] - 1)
            moved = np.take_along_axis(now, source, 1)
            moved[:, -1] = -1
            now = moved
        k = wanted.shape[1]
        whole = np.ones(len(rows), bool) if k >= n else (final[:, k:] < 0).all(axis=1)
        out[rows] = whole & (final[:, :k] == wanted[rows]).all(axis=1) if k <= n else False
    return out


class _Words:
    """Pieces of words met before, by the hash of the word."""

    def __init__(self):
        self.names = np.zeros(0, np.uint64)  # ascending
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each name, and whether it is there."""
        if not len(self.names):
            return np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return at, self.names[at] == names

    def add(self, names: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """New names, ascending."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(self.used + 2 * len(ids), np.int32)])
        self.ids[self.used:self.used + len(ids)] = ids
        place = np.searchsorted(self.names, names)
        self.names = np.insert(self.names, place, names)
        self.start = np.insert(self.start, place, self.used + np.cumsum(counts) - counts)
        self.count = np.insert(self.count, place, counts)
        self.used += len(ids)


class Encoder:
    """Encodes words; remembers their pieces and which pieces may follow each other."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known_words = _Words()
        self.pairs = np.full(1 << MEMORY_BITS, -1, np.int64)
        self.answers = np.zeros(1 << MEMORY_BITS, bool)

    def may_follow(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        pair = (one.astype(np.int64) << 32) | two
        slot = (mix(pair.astype(np.uint64)) >> np.uint64(64 - MEMORY_BITS)).astype(np.int64)
        out = self.answers[slot]
        new = np.flatnonzero(self.pairs[slot] != pair)
        if len(new):
            values, first, inverse = np.unique(pair[new], return_index=True, return_inverse=True)
            answers = _merges_to(self.vocabulary, np.stack([values >> 32, values & 0xFFFFFFFF], axis=1))
            out[new] = answers[inverse]
            self.pairs[slot[new[first]]] = values
            self.answers[slot[new[first]]] = answers
        return out

    def words(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of one length, a row of characters each: the ids, one word behind the
        other, and how many each word has. All characters must be pieces."""
        vocabulary = self.vocabulary
        n, length = rows.shape
        sums, inverse = np.ascontiguousarray(_hash_rows(rows).T), _powers(length, INVERSE)
        best = np.full((length + 1, n), -np.inf, np.float32)  # sum of scores of the path to each end
        best[0] = 0
        last = np.full((length + 1, n), -1, np.int32)  # its last piece
        back = np.zeros((length + 1, n), np.int32)  # and the length of that
        every = np.arange(n)
        for end in range(1, length + 1):
            low = max(0, end - vocabulary.longest)  # the longest piece comes first
            piece = vocabulary.find(mix((sums[end] - sums[low:end]) * inverse[low:end, None]))
            score = np.full(piece.shape, -np.inf, np.float32)
            begin, row = np.nonzero((piece >= 0) & (best[low:end] > -np.inf))
            found = piece[begin, row]
            if vocabulary.merges:
                fits = vocabulary.alone[found]
                begin, row, found = begin[fits], row[fits], found[fits]
                fits = begin + low == 0
                inner = np.flatnonzero(~fits)
                fits[inner] = self.may_follow(last[begin[inner] + low, row[inner]], found[inner])
                score[begin[fits], row[fits]] = 0
            else:
                score[begin, row] = best[begin + low, row] + vocabulary.scores[found]
            top = np.argmax(score, axis=0)
            best[end] = score[top, every]
            last[end] = piece[top, every]
            back[end] = end - low - top
        # follow the back pointers of all words at once
        ids = np.full((n, length), -1, np.int32)
        at = np.full(n, length)
        for step in range(length - 1, -1, -1):
            live = np.flatnonzero(at > 0)
            if not len(live):
                break
            ids[live, step] = last[at[live], live]
            at[live] -= back[at[live], live]
        used = ids >= 0
        return ids[used], used.sum(axis=1)

    def long_words(self, words: list[np.ndarray], again: int = 0) -> list[np.ndarray]:
        """Pieces of each of the words, which are longer than a window; ``again`` counts how often a
        word's windows have been laid anew."""
        if not self.vocabulary.merges:
            return [self.words(word[None])[0] for word in words]
        size = STEP + OVERLAP
        begins = [np.append(np.arange(0, len(word) - size, STEP), len(word) - size) for word in words]
        windows = [(word, begin) for word, at in zip(words, begins) for begin in at.tolist()]
        parts: list[np.ndarray] = []
        for k in range(0, len(windows), 1024):
            ids, counts = self.words(np.stack([word[at:at + size] for word, at in windows[k:k + 1024]]))
            parts += np.split(ids, np.cumsum(counts)[:-1])
        own = iter(parts)
        return [self._joined(word, at.tolist(), [next(own) for _ in at], again) for word, at in zip(words, begins)]

    def _places(self, ids: np.ndarray, begin: int) -> np.ndarray:
        """Where each piece begins."""
        size = self.vocabulary.lengths[ids]
        return begin + np.cumsum(size) - size

    def _joined(self, word: np.ndarray, begins: list[int], parts: list[np.ndarray], again: int) -> np.ndarray:
        """The encoding of a word from those of its windows."""
        out = []
        ids, at = parts[0], self._places(parts[0], begins[0])
        for begin, more in zip(begins[1:], parts[1:]):
            there = self._places(more, begin)
            _, one, two = np.intersect1d(at, there, assume_unique=True, return_indices=True)
            same = np.flatnonzero(ids[one] == more[two])
            if not len(same):
                rest = self._laid_anew(word, ids, at, begin, again)
                return self.words(word[None])[0] if rest is None else np.concatenate([*out, rest])
            out.append(ids[:one[same[0]]])
            ids, at = more[two[same[0]]:], there[two[same[0]]:]
        return np.concatenate([*out, ids])

    def _laid_anew(self, word: np.ndarray, ids: np.ndarray, at: np.ndarray, begin: int,
                   again: int) -> np.ndarray | None:
        """The pieces from the first of these on, where the window from ``begin`` shares none with them:
        the windows of what is left begin at an end of one of them. None if no end serves."""
        for k in np.flatnonzero((at >= begin) & (at > at[0]))[::-1].tolist() if again < 3 else ():
            rest = word[at[k]:]
            if self.may_follow(ids[k - 1:k], self.words(rest[None, :STEP + OVERLAP])[0][:1])[0]:
                rest = self.long_words([rest], again + 1)[0] if len(rest) > 2 * STEP else self.words(rest[None])[0]
                if self.may_follow(ids[k - 1:k], rest[:1])[0]:
                    return np.concatenate([ids[:k], rest])
        return None

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Characters of the texts, which of them are pieces, and where texts and words begin."""
        vocabulary = self.vocabulary
        marked = [(chr(SPACE) if vocabulary.prefix else "") + t.replace(" ", chr(SPACE)) if t else "" for t in texts]
        points = _points("".join(marked))
        firsts = np.concatenate([[0], np.cumsum([len(t) for t in marked])]).astype(np.int64)
        at = np.minimum(np.searchsorted(vocabulary.characters, points), len(vocabulary.characters) - 1)
        known = vocabulary.characters[at] == points
        space = points == SPACE
        begins = np.ones(len(points), bool)
        begins[1:] = (space[1:] & ~space[:-1]) | ~known[1:] | ~known[:-1]
        begins[firsts[:-1][np.diff(firsts) > 0]] = True
        begin = np.flatnonzero(begins)
        size = np.diff(np.append(begin, len(points)))
        sums = _hash_rows(points[None])[0]
        name = mix((sums[begin + size] - sums[begin]) * _powers(len(points) + 1, INVERSE)[begin])
        return points, known, firsts, begin, size, name

    def learn(self, groups_of_texts: Iterator[list[str]]) -> None:
        """Encode the new words of several groups of texts at one go."""
        names, sizes, letters, flags = [np.zeros(0, np.uint64)], [], [], []
        for texts in groups_of_texts:
            points, known, _, begin, size, name = self._cut(texts)
            found, first = np.unique(name, return_index=True)
            new = ~self.known_words.find(found)[1]
            found, first = found[new], first[new]
            at = np.repeat(begin[first] - (np.cumsum(size[first]) - size[first]), size[first])
            at += np.arange(len(at))
            names.append(found)
            sizes.append(size[first])
            letters.append(points[at])
            flags.append(known[at])
        found, first = np.unique(np.concatenate(names), return_index=True)
        if not len(found):
            return
        if len(self.known_words.names) + len(found) > WORDS_KEPT:
            self.known_words = _Words()
        size = np.concatenate(sizes)
        begin = np.cumsum(size) - size
        ids, counts = self._distinct(np.concatenate(letters), np.concatenate(flags), begin[first], size[first])
        self.known_words.add(found, ids, counts)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and how many each has."""
        points, known, firsts, begin, size, name = self._cut(texts)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        # equal words once
        names, first, word = np.unique(name, return_index=True, return_inverse=True)
        if len(self.known_words.names) + len(names) > 2 * WORDS_KEPT:
            self.known_words = _Words()
        kept = self.known_words
        new = np.flatnonzero(~kept.find(names)[1])
        if len(new):
            ids, counts = self._distinct(points, known, begin[first[new]], size[first[new]])
            kept.add(names[new], ids, counts)
        at, _ = kept.find(names)
        n, start = kept.count[at][word], kept.start[at][word]
        out = kept.ids[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        ends = np.concatenate([[0], np.cumsum(n)])
        return out, np.diff(ends[np.searchsorted(begin, firsts)])

    def _distinct(self, points: np.ndarray, known: np.ndarray, begin: np.ndarray,
                  size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each of the words, one behind the other, and how many each has."""
        counts = np.zeros(len(begin), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(size, kind="stable")
        edges = np.flatnonzero(np.diff(size[order])) + 1
        for group in np.split(order, edges) if len(order) else []:
            length = int(size[group[0]])
            if length == 1:
                for w in group[~known[begin[group]]]:
                    ids = self._fallback(int(points[begin[w]]))
                    counts[w] = len(ids)
                    parts.append((np.array([w]), ids))
                group = group[known[begin[group]]]
            if length > 2 * STEP:
                found = self.long_words([points[begin[w]:begin[w] + length] for w in group])
                counts[group] = [len(ids) for ids in found]
                parts.append((group, np.concatenate(found)))
                continue
            step = max(1, WORDS_AT_ONCE * 8 // length)
            for part in (group[k:k + step] for k in range(0, len(group), step)):
                ids, n = self.words(points[begin[part][:, None] + np.arange(length)])
                counts[part] = n
                parts.append((part, ids))
        # back in the order of the words
        start = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for part, ids in parts:
            n = counts[part]
            out[np.repeat(start[part] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, counts

    def _fallback(self, point: int) -> np.ndarray:
        ids = self.vocabulary.bytes[list(chr(point).encode("utf-8", "replace"))]
        return ids if (ids >= 0).all() else np.array([self.vocabulary.unknown], np.int32)


class Decoder:
    """Puts the surfaces of pieces together."""

    def __init__(self, vocabulary: Vocabulary):
        self.size = np.array([len(s) for s in vocabulary.surface])
        self.start = np.cumsum(self.size) - self.size
        self.surface = np.frombuffer(b"".join(vocabulary.surface), np.uint8)
        self.prefix = vocabulary.prefix

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that are no UTF-8 become replacement characters."""
        n = self.size[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        data = self.surface[at].tobytes()
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        texts = [data[low:high].decode("utf-8", "replace") for low, high in zip(ends[:-1], ends[1:])]
        return [t[1:] if self.prefix and t[:1] == " " else t for t in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(model_file: str, vocabulary: Vocabulary) -> Encoder:
    """The encoder of this process: what it has learnt serves the next task."""
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = Encoder(vocabulary)
    return _ENCODERS[model_file]


def encode_rows(rows: DataFrame, model_file: str, text_col: str = "text", into: str = "ids",
                checked: str | None = None, drop_text: bool = False) -> DataFrame:
    """The rows with ``ids``, the pieces of their text; none for a null or empty text. Characters that
    are no pieces become the pieces of their bytes, or the unknown piece where a model has none. Rows
    that repeat get the same; no rows give no rows. A column of the name of the new one is replaced.

    ``checked`` names a column for whether the ids decode to the text; ``drop_text`` leaves the text
    out of the result."""
    vocabulary = Vocabulary(model_file)
    added = [StructField(into, ArrayType(IntegerType()))]
    if checked:
        added.append(StructField(checked, BooleanType()))
    kept, schema = with_fields(rows.drop(text_col) if drop_text else rows, *added)
    read = list(dict.fromkeys([*kept, text_col]))

    def learnt(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups of rows; the words of several groups are learnt before the first of them."""
        parts = groups(batches, text_col, GROUP)
        while several := list(islice(parts, GROUPS_LEARNT)):
            encoder.learn(pc.fill_null(p.column(text_col), "").to_pylist() for p in several)
            yield from several

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = encoder_of(model_file, vocabulary), Decoder(vocabulary)
        for batch in learnt(encoder, batches):
            texts = pc.fill_null(batch.column(text_col), "").to_pylist()
            ids, counts = encoder.texts(texts)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            arrays = [*(batch.column(c) for c in kept), pa.ListArray.from_arrays(offsets, pa.array(ids))]
            if checked:
                arrays.append(pa.array([a == b for a, b in zip(decoder.texts(ids, counts), texts)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.select(*quoted(read)).mapInArrow(run, schema)


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
           checked: str | None = None) -> DataFrame:
    """Per row: id and ``ids``, see ``encode_rows``. Other columns are not read."""
    found = encode_rows(id_and_text(docs, id_col, text_col), model_file, checked=checked, drop_text=True)
    return found.select(shown_id("id").alias(id_col), "ids", *([checked] if checked else []))


def decode(rows: DataFrame, model_file: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the text of their pieces. A null list is an empty text. No id may lie outside the
    model."""
    vocabulary = Vocabulary(model_file)
    kept, schema = with_fields(rows, StructField(into, StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            texts: list[str] = []
            for at in range(0, batch.num_rows, 256):
                part = batch.column(ids_col).slice(at, 256)
                counts = pc.fill_null(pc.list_value_length(part), 0).to_numpy()
                texts += decoder.texts(part.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string())], schema.names)

    return rows.select(*quoted(kept)).mapInArrow(run, schema)
