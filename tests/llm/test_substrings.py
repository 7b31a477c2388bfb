import random

import numpy as np
import pytest

from gleanframe.llm import repeats
from gleanframe.llm import substrings as s

DOCS = "doc_id bigint, text string, block string, id string"


def brute(rows, length=50):
    """Spans and bytes that stay, string by string."""
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in order:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            first.setdefault(data[k:k + length], doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if first[data[k:k + length]] != doc_id:
                gone[k:k + length] = b"\1" * length
        spans, k = [], 0
        while k < len(data):
            end = k
            while end < len(data) and gone[end] == gone[k]:
                end += 1
            if gone[k]:
                spans.append((k, end))
            k = end
        out.append((doc_id, len(data), tuple(spans), bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


def found(table, rows, parts=3, **more):
    out = s.repeated_substrings(table([(*r, "", "") for r in rows], DOCS, parts), **more)
    return sorted(((r.doc_id, r.n_bytes, tuple((x["from"], x["to"]) for x in r.spans), bytes(r.kept))
                   for r in out.collect()), key=str)


def corpus(seed, n=60, alphabet="abcdefgh é\n"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(400))) for _ in range(9)]
    rows = []
    for doc_id in rng.sample(range(1000), n):
        text = ""
        for _ in range(rng.randrange(5)):
            b = rng.choice(base)
            at = rng.randrange(len(b) + 1)
            text += b[at:at + rng.randrange(220)] + "".join(rng.choice(alphabet) for _ in range(rng.randrange(9)))
        rows.append((doc_id, text))
    return rows


@pytest.mark.parametrize("alphabet", ["abcdefgh é\n", "ab", "a"])
def test_equals_brute_force(table, monkeypatch, alphabet):
    monkeypatch.setattr(s, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(s, "PART_ANCHORS", 100)
    monkeypatch.setattr(s, "PART_PIECES", 50)
    rows = corpus(3, alphabet=alphabet)
    assert found(table, rows) == brute(rows)


def test_hot_anchors_are_sent_by_window(table, monkeypatch):
    monkeypatch.setattr(s, "BLOCK_BYTES", 700)
    monkeypatch.setattr(s, "HOT_BLOCKS", 2)
    rows = corpus(5)
    assert found(table, rows) == brute(rows)
    assert found(table, rows, length=30) == brute(rows, 30)


def test_nulls_short_texts_and_repeats(table):
    long = "0123456789" * 5
    rows = [(5, long), (None, "x" + long), (3, "é" + long[:-1]), (4, None), (2, ""), (9, "1" + long + "é"),
            (9, "1" + long + "é")]
    assert found(table, rows) == brute(rows)
    assert found(table, []) == [] and found(table, [(1, None)]) == [(1, 0, (), b"")]


def test_one_long_text(table):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdef ") for _ in range(100_000))
    rows = [(2, "start " + passage * 12), (1, passage[30_000:30_080])]
    got = found(table, rows)
    want = [(6 + 30_000 + k * 100_000, 6 + 30_080 + k * 100_000) for k in range(12)]
    assert list(got[1][2]) == want and got[0][2] == ()


def test_common_prefixes_of_columns():
    """Against a plain search, over many pieces with anchors below each other."""
    rng = np.random.default_rng(2)
    length, out = 20, []
    rows = [rng.integers(97, 99, 24, dtype=np.uint8) for _ in range(200)] + [np.full(24, 97, np.uint8)] * 5
    lead = np.array([int(rng.integers(0, 5)) for _ in rows])
    run = np.full(len(rows), 24 - length + 1)
    owner = rng.permutation(len(rows))
    got = repeats.earlier(np.concatenate(rows), lead, run, owner, length)
    for n, row in enumerate(rows):
        for k in range(run[n]):
            place = k - lead[n]
            out.append(any(owner[m] < owner[n] and 0 <= place + lead[m] < run[m] and
                           (other[place + lead[m]:place + lead[m] + length] == row[k:k + length]).all()
                           for m, other in enumerate(rows)))
    assert (got == np.array(out)).all()
