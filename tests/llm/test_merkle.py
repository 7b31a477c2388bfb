import hashlib
import zlib

import pytest

from gleanframe.llm import merkle as m

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, i int, n int, path string, digest string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [row[0], row[1], row[2], row[3], text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def climb(nodes):
    """All levels of a tree, from its leaves to the top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][k:k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 3 * 3
        out.append((level[run:at], level[at + 1:run + 3]))
        at //= 3
    return out


def by_hand(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        order = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[source] = order, climb([leaf(r, r[4]) for r in order])
    top = climb([trees[s][1][-1][0] for s in sources])
    out = []
    for place, source in enumerate(sources):
        order, levels = trees[source]
        for at, row in enumerate(order):
            path = siblings(levels, at) + siblings(top, place)
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(row, text)
            for left, right in path:
                node = digest(*left, node, *right)
            proof = digest(*[x for left, right in path for x in [*left, *right]])
            out.append((row[0], leaf(row, row[4]), levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def found(table, rows, depth, parts=3):
    docs = table([(*row, 7, 8, "x", "y") for row in rows], DOCS, parts)
    return sorted((tuple(r) for r in m.manifest(docs, depth).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("depth", [1, 2, 5])
def test_equals_plain_loops(table, depth):
    rows = [(n, None if n % 11 == 0 else f"s{n % 5 if n % 2 else 0}", ["en", None, ""][n % 3], n if n % 4 else None,
             None if n % 7 == 0 else f"Zeile {n}\nß" * (n % 3)) for n in range(60)]
    rows += [(1000, "alone", "en", 1, "a\nb")]
    assert found(table, rows, depth) == by_hand(rows)


def test_ties_repeats_and_null_ids(table):
    rows = [(None, "s", None, None, "a\nb")] * 3 + [(4, "s", None, None, "x\ny"), (4, "s", None, None, "q")]
    rows += [(4, "s", None, None, "x\ny")] * 40 + [(None, None, None, None, None), (2, "", "", 0, "")]
    assert found(table, rows, 2) == by_hand(rows)


def test_long_text_and_single_row(table):
    rows = [(8, "s", "en", 9, "wort\n" * 200_000)]
    (got,) = found(table, rows, 5)
    assert [got] == by_hand(rows)
    assert got[4] == hashlib.sha256(b"").hexdigest() and got[1] == got[2] == got[3]


def test_tampering_shows(table):
    rows = [(n, "s", "en", 1, "a\nb" if n % 2 else "ab") for n in range(30)]
    verified = {r[0]: r[6] for r in found(table, rows, 2)}
    assert verified == {n: not (n % 2 and zlib.crc32(str(n).encode()) % 2 == 0) for n in range(30)}
    assert set(verified.values()) == {True, False}


def test_no_rows(table):
    assert found(table, [], 3) == []


def test_native_plan(table):
    docs = table([(1, "s", "en", 1, "a", 1, 1, "", "")], DOCS)
    plan = m.manifest(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
