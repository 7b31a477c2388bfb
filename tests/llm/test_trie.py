import hashlib
import random
import re
import zlib

import pytest

from gleanframe.llm import trie as t

TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, path string, head string"
COLUMNS = [c.split()[0] for c in t.NODE.split(", ")]


def by_hand(rows):
    """The nodes of the trie, from a dictionary of all prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    members = {}
    for c, turns in own.items():
        taken = zlib.crc32(str(c).encode()) % 4
        family = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        seq = tuple(own.get(family, [])[:taken] + turns[taken:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append((c, d == len(seq)))
    kids = {}
    for seq in members:
        if seq:
            kids.setdefault(seq[:-1], []).append(seq)

    out = []

    def visit(seq):
        leaves, saved = 0, 0
        for kid in kids.get(seq, []):
            below = visit(kid)
            leaves, saved = leaves + below[0], saved + below[1]
        leaves = leaves or 1
        saved += (len(members[seq]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", seq[-1][1])) if seq else 0)
        ends = ",".join(str(c) for c, last in sorted(members[seq]) if last)
        above = min(members[seq[:-1]])[0] if seq else None
        out.append((min(members[seq])[0], len(seq), above, len(members[seq]), len(kids.get(seq, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if own:
        visit(())
    return sorted(out, key=repr)


def found(table, rows, limit, parts=3):
    turns = table([(*row, 1, "x", "y") for row in rows], TURNS, parts)
    return sorted((tuple(r) for r in t.conversation_trie(turns, limit).select(COLUMNS).collect()), key=repr)


def corpus(n=60, seed=3):
    """Conversations of few words, so that many begin alike, and copies of one of them."""
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        same = conv % 3 == 0
        turns = [["a b", "c", "a b"][k % 3] for k in range(5)] if same else [
            rng.choice(["a b", "c", "", "d  e\nf"]) for _ in range(rng.randrange(0, 7))]
        rows += [(conv, k, "user" if k % 2 else "assistant", text) for k, text in enumerate(turns)]
    return rows


@pytest.mark.parametrize("limit", [6, 10_000])
def test_equals_plain_loops(table, limit):
    rows = corpus()
    assert found(table, rows, limit) == by_hand(rows)


def test_nulls_repeats_and_absent_first_conversations(table):
    rows = [(None, 0, "user", "x")] * 3 + [(21, None, None, None), (21, 1, "", ""), (22, 3, "u", "b"), (22, 2, "u", "a")]
    rows += [(45, 0, "user", "q")] * 4 + [(40, 0, "user", "p p")] + [(-7, 0, "user", "p p"), (-7, 1, None, "r")]
    rows += [(61, 0, "user", "z")] + [(62, None, "user", "z")]
    for limit in (1, 10_000):
        assert found(table, rows, limit) == by_hand(rows)


def test_long_shared_beginnings_burst_at_once(table):
    """Conversations that part after a hundred turns, one that ends there, and one long text."""
    start = [("user", f"turn {k}") for k in range(100)]
    rows = []
    for conv in range(0, 200, 20):
        turns = start + ([("user", f"end {conv}"), ("user", "x " * 50_000)] if conv else [])
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
    assert found(table, rows, 50) == by_hand(rows)
    turns = table([(*row, 1, "x", "y") for row in rows], TURNS)
    containers, rounds = t.burst(t.sequences(t.rebuilt(turns)), 50)
    assert len(rounds) == 1 and rounds[0].first()["depth"] == 100


def test_one_long_conversation_is_no_reason_to_burst(table):
    rows = [(0, k, "user", str(k % 7)) for k in range(400)]
    assert found(table, rows, 10) == by_hand(rows)


def test_many_copies_in_pieces(table, monkeypatch):
    rows = [(20 * n, 0, "user", "same words") for n in range(3000)]
    monkeypatch.setattr(t, "PIECE", 100)
    assert found(table, rows, 10, parts=5) == by_hand(rows)


def test_no_rows(table):
    assert found(table, [], 10) == []
    assert found(table, [(None, 1, "user", "x")], 10) == []
