import random

import pytest

from gleanframe.llm import near_dedup as n

DOCS = "doc_id bigint, text string, component_id string, id string"


def brute(rows, words, percent):
    def shingles(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0d]+", low) if x]
        return {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def found(table, rows, words, percent=80, parts=3):
    out = n.near_duplicates(table([(*r, "x", "y") for r in rows], DOCS, parts), words, percent)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect()}


def corpus(seed, groups, copies, length=40, edits=4):
    """Groups of texts of which each comes from another one of its group by a few edits."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        family = [[f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, length))]]
        for _ in range(rng.randrange(copies)):
            copy = list(rng.choice(family))
            for _ in range(rng.randrange(edits)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(300)}"
            family.append(copy)
        texts += [" ".join(t) for t in family]
    rng.shuffle(texts)
    return [(3 * k + 1, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("words", [2, 5])
def test_equals_brute_force(table, words):
    rows = corpus(words, 25, 12)
    assert found(table, rows, words) == brute(rows, words, 80)


def test_a_large_family_of_drifting_copies(table):
    rows = corpus(9, 1, 200, length=60, edits=5)
    assert found(table, rows, 2) == brute(rows, 2, 80)


def test_nulls_empty_ties_and_repeats(table):
    rows = [(4, "One two"), (2, "one\ttwo "), (9, None), (8, " \n"), (7, "one"), (5, "ONE"), (6, "É x y"),
            (3, "é x y")]
    assert found(table, rows, 2) == brute(rows, 2, 80) | {9: (0, 9, True), 8: (0, 8, True)}
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d")]
    out = n.near_duplicates(table([(*r, "", "") for r in rows], DOCS), 2)
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in out.collect()) == [
        (0, 1, False), (1, 1, True), (1, 1, True)]
    assert found(table, [], 2) == {}


def test_long_text(table):
    long = " ".join(f"k{i}" for i in range(150_000))
    got = found(table, [(1, long), (2, long + " more"), (3, long[:400_000])], 5)
    assert {i: v[1] for i, v in got.items()} == {1: 1, 2: 1, 3: 3}


def test_texts_that_share_a_line_and_little_else(table, monkeypatch):
    """Such texts meet under the keys of the line's shingles; they are told apart by their own."""
    rng = random.Random(6)
    line = " ".join(f"l{k}" for k in range(9))
    rows = [(k, line + " " + " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(2, 9))))
            for k in range(300)]
    rows += [(1000 + k, rows[3 * k][1] + " end") for k in range(40)]
    tested = []
    confirmed = n.confirmed
    monkeypatch.setattr(n, "confirmed", lambda pairs, *more: tested.append(pairs.count()) or confirmed(pairs, *more))
    assert found(table, rows, 2) == brute(rows, 2, 80)
    assert sum(tested) < 8000


def test_texts_that_share_an_id_or_have_none(table):
    clean, one, two = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(None, clean), (None, one + " end"), (3, one), (5, two), (5, two + " more"), (5, clean + " not alike " + one),
            (7, two), (7, "all else")]
    out = n.near_duplicates(table([(*r, "", "") for r in rows], DOCS, 3), 2, 80).collect()
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in out)
    assert [r for r in got if r[0] in (0, 3)] == [(0, 39, 0, True), (0, 40, 3, False), (3, 39, 3, True)]
    assert sum(r[3] for r in got if r[0] == 5 and r[1] < 50) == 1 and {r[2] for r in got if r[0] == 5} == {5}
    assert [r for r in got if r[0] == 7] == [(7, 1, 7, True), (7, 39, 5, False)]
    assert [r[3] for r in got if r[0] == 5 and r[1] > 50] == [True]
