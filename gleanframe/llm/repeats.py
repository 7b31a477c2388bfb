"""Arrays behind ``substrings``: pieces of text around anchors, and the transform of a collection of
pieces that is built column by column."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from gleanframe.llm.texts import mix

GRAM = 16  # bytes of an anchor


class Pieces(NamedTuple):
    """Runs of windows that share their anchor. All are arrays with an entry per piece."""

    start: np.ndarray  # first window, a place in the data
    lead: np.ndarray  # bytes before the anchor
    run: np.ndarray  # number of windows, each one byte further
    key: np.ndarray  # 64-bit hash of the anchor and the bytes beside it that all of them hold
    text: np.ndarray  # number of the text

    def take(self, at: np.ndarray) -> Pieces:
        return Pieces(*(x[at] for x in self))


def pieces(data: np.ndarray, starts: np.ndarray, length: int) -> Pieces:
    """All windows of ``length`` bytes within a text, by anchor: the gram with the least hash, the
    first among equals. Equal windows have equal anchors at equal places.

    Windows that hold at least half of what is left of the length before their anchor, and the
    others, are pieces of their own: the ones have that half before the anchor in common, the others
    that half behind it. So keys are hashes of more than an anchor, and agree by chance less often.
    """
    n = len(data) - length + 1
    if n <= 0:
        nothing = np.zeros(0, np.int64)
        return Pieces(nothing, nothing, nothing, nothing.astype(np.uint64), nothing)
    eights = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))
    hashes = eights[:-8] * np.uint64(0x9E3779B97F4A7C15)
    hashes += eights[8:]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    # the place below the hash makes the first of equal hashes the least
    least = hashes & np.uint64(0xFFFFFFFF00000000)
    least |= np.arange(len(hashes), dtype=np.uint64)
    width, reach = length - GRAM + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
    anchor = least[:n].astype(np.uint32).astype(np.int64)
    half = (length - GRAM) // 2
    place = np.arange(n)
    before = anchor - place >= half
    # the first window of every run, and whether it is a window at all
    first = np.ones(n, bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (before[1:] != before[:-1])
    filled = np.flatnonzero(np.diff(starts))
    edges = np.concatenate([starts[filled], np.maximum(starts[filled], starts[filled + 1] - length + 1)])
    first[edges[edges < n]] = True
    at = np.flatnonzero(first)
    run = np.diff(np.append(at, n))
    text = np.searchsorted(starts, at, "right") - 1
    inside = at + length <= starts[text + 1]
    at, run, text = at[inside], run[inside], text[inside]
    centre = anchor[at]
    early = before[at]
    key = np.empty(len(at), np.uint64)
    for side, steps in ((True, [*range(-half, 0, GRAM), 0]), (False, [*range(0, half, GRAM), half])):
        mine = np.flatnonzero(early == side)
        total = np.full(len(mine), int(side), np.uint64)
        for step in steps:
            total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[centre[mine] + step]
        key[mine] = mix(total)
    return Pieces(at, centre - at, run, key, text)


def windows(some: Pieces, keys: np.ndarray) -> Pieces:
    """Each window of the pieces as a piece of its own; ``keys`` has a hash of every place's window."""
    at = np.repeat(some.start, some.run) + _counting(some.run)
    return Pieces(at, np.zeros(len(at), np.int64), np.ones(len(at), np.int64), keys[at],
                  np.repeat(some.text, some.run))


def _counting(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the lengths, one behind the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of spans of the data, one behind the other."""
    return data[np.repeat(start, size) + _counting(size)]


def _interval_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low..high] (both ends included) for each pair."""
    level = np.frexp((high - low + 1).astype(float))[1] - 1
    out = np.empty(len(low), values.dtype)
    table, reach = values, 1
    for k in range(int(level.max()) + 1 if len(level) else 0):
        if k:
            table, reach = np.minimum(table[:-reach], table[reach:]), 2 * reach
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[low[at]], table[high[at] - reach + 1])
    return out


def earlier(data: np.ndarray, lead: np.ndarray, run: np.ndarray, owner: np.ndarray,
            length: int) -> np.ndarray:
    """For every window of every piece, one behind the other: does it occur in a piece of a smaller
    owner?

    The pieces are laid out in columns with their anchors below each other. From the last column to
    the first, each round puts one symbol before every piece's suffix and carries on the order of the
    suffixes (a stable sort by the new symbol: the collection's Burrows-Wheeler transform, one column
    at a time) and the common prefixes of neighbours (one more than the least between their former
    places, if the symbols agree). Windows that begin in a column are equal where neighbours share
    ``length`` symbols. All arrays of a round are read and written front to back.
    """
    n = len(lead)
    out = np.zeros(int(run.sum()), bool)
    if not n:
        return out
    size = run + length - 1
    width = length - GRAM + 1  # columns before the anchor, at most width - 1, come first
    first = width - 1 - lead  # column of the first byte
    end = first + size
    at = np.cumsum(size) - size - first  # data[at + column]
    answer = np.cumsum(run) - run - first
    order = np.arange(n)
    shared = np.zeros(n, np.uint8)  # with the neighbour before
    for column in range(int(end.max()) - 1, int(first.min()) - 1, -1):
        gone = first[order] > column
        if gone.any():  # pieces that began further right
            left = np.flatnonzero(~gone)
            shared = _interval_min(shared, np.concatenate([[0], left[:-1] + 1]), left)
            order = order[left]
        inside = end[order] > column
        symbol = np.full(len(order), 256, np.uint16)
        symbol[inside] = data[at[order[inside]] + column]
        place = np.argsort(symbol, kind="stable")
        before, symbol = place[:-1], symbol[place]
        common = np.zeros(len(order), np.uint8)
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] < 256))
        low, high = before[same] + 1, place[same + 1]
        next_ = low == high
        common[same[next_] + 1] = shared[high[next_]] + 1
        far = ~next_
        common[same[far] + 1] = _interval_min(shared, low[far], high[far]) + 1
        order, shared = order[place], common
        begin = np.flatnonzero(shared < length)
        least = np.minimum.reduceat(owner[order], begin)
        found = np.repeat(least, np.diff(np.append(begin, len(order)))) < owner[order]
        here = end[order] - column >= length
        out[answer[order[here]] + column] = found[here]
    return out
