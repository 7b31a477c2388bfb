import random
import time

import numpy as np
import pyarrow as pa

from gleanframe.llm import decontaminate as d

DOCS = "doc_id bigint, text string, item_id string, id string"
ITEMS = "item_id bigint, text string, doc_id string"


def brute(doc, item, min_words=13, share=0.8):
    """Best score over all diagonals, word by word."""
    def words(t):
        return "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()

    a, b = words(doc), words(item)
    best = 0
    for shift in range(-len(b) + 1, len(a)):
        agree = [a[i + shift] == b[i] for i in range(len(b)) if 0 <= i + shift < len(a)]
        for i in range(len(agree)):
            for j in range(i + 1, len(agree) + 1):
                n, same = j - i, sum(agree[i:j])
                if n >= min(min_words, len(b)) and same >= share * n:
                    best = max(best, same)
    return best


def found(table, docs, items, **more):
    out = d.overlaps(table([(*x, "", "") for x in docs], DOCS), table([(*x, "") for x in items], ITEMS), **more)
    return {(r.doc_id, r.item_id): r for r in out.collect()}


def test_substitutions_case_and_punctuation(table):
    rng = random.Random(4)
    vocabulary = [f"w{n}é" for n in range(400)]
    item = [rng.choice(vocabulary) for _ in range(40)]
    docs, want = [], {}
    for n in range(24):
        copy = item[:]
        for k in rng.sample(range(40), n % 12):
            copy[k] = "other"
        start = rng.randrange(0, 20)
        text = [rng.choice(vocabulary) for _ in range(30)] + copy[start:start + 8 + n] + ["end"] * n
        docs.append((n, ", ".join(text).title() + "."))
    got = found(table, docs, [(1, " ".join(item)), (2, None), (3, "?!")])
    want = {n for n, text in docs if brute(text, " ".join(item))}
    assert {n for n, _ in got} == want and {i for _, i in got} == {1}
    assert 5 < len(want) < 24


def test_short_items_nulls_and_repeats(table):
    docs = [(1, "x answer is 42 y"), (2, None), (3, ""), (4, "answer is 43"), (1, "x answer is 42 y"),
            (None, "The ANSWER is: 42!")]
    got = found(table, docs, [(7, "Answer is 42"), (None, "nothing like it")])
    assert set(got) == {(1, 7), (None, 7)}
    row = got[1, 7]
    assert (row.doc_from, row.doc_to, row.item_from, row.item_to, row.agreeing) == (1, 4, 0, 3, 3)


def test_empty_tables(table):
    assert found(table, [], [(1, "a b c")]) == {} and found(table, [(1, "a b c")], []) == {}


def test_blocks_of_items(table, monkeypatch):
    items = [(n, " ".join(f"t{n}x{k}" for k in range(15))) for n in range(20)]
    docs = [(n, "before " + items[n % 20][1] + " after") for n in range(40)]
    monkeypatch.setattr(d, "BLOCK_BYTES", 400)
    assert set(found(table, docs, items)) == {(n, n % 20) for n in range(40)}


def test_long_text(table):
    item = " ".join(f"q{k}" for k in range(30))
    got = found(table, [(1, "pad " * 300_000 + item)], [(5, item)])
    assert got[1, 5].doc_from == 300_000


def hashed(texts):
    return d.word_hashes(pa.array(texts))


def test_a_frequent_phrase_on_both_sides():
    rng = random.Random(8)
    phrase = "which of the following is the most"
    own = [" ".join(f"i{n}w{rng.randrange(10**6)}" for _ in range(12)) for n in range(4000)]
    words, firsts = hashed([f"{phrase} {x}" for x in own])
    items = d.Items(np.arange(4000), words, firsts, 13, 0.8)
    pad = [" ".join(f"p{rng.randrange(10**6)}" for _ in range(9)) for _ in range(100)]
    text = " ".join(f"{x} {phrase}" for x in pad)
    start = time.perf_counter()
    assert not d.search(items, *hashed([text])).size
    assert time.perf_counter() - start < 3
    got = d.search(items, *hashed([text + " " + own[17] + " end", None, own[3]]))
    assert got[:2].T.tolist() == [[0, 17]] and got[6].tolist() == [19]


def test_hits_in_parts_give_the_same(monkeypatch):
    rng = random.Random(9)
    words = [f"v{n}" for n in range(6)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in range(20)]
    benchmark = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 30))) for _ in range(30)]
    hashes, firsts = hashed(benchmark)
    items = d.Items(np.arange(30), hashes, firsts, 13, 0.8)
    whole = d.search(items, *hashed(texts)).T.tolist()
    assert len(whole) > 15
    for text, item, low, high, item_low, item_high, same in whole:
        a, b = texts[text].split()[low:high], benchmark[item].split()[item_low:item_high]
        assert same == sum(x == y for x, y in zip(a, b, strict=True)) >= 0.8 * len(a)
        assert len(a) >= min(13, len(benchmark[item].split()))
    monkeypatch.setattr(d, "HITS_AT_ONCE", 7)
    monkeypatch.setattr(d, "WORDS_AT_ONCE", 50)
    assert d.search(items, *hashed(texts)).T.tolist() == whole


def test_longest_stretches_equal_plain_loops():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 40, 300)
    agree = rng.random(sizes.sum()) < np.repeat(rng.random(300), sizes)
    begin, end = d.longest_stretches(agree, sizes, 80)
    for low, n, b, e in zip(np.cumsum(sizes) - sizes, sizes, begin, end):
        run = agree[low:low + n]
        fine = [(j - i, j) for i in range(n) for j in range(i, n + 1) if run[i:j].sum() * 100 >= 80 * (j - i)]
        most = max(fine)[0]
        assert e - b == most and (not most or run[b:e].sum() * 100 >= 80 * most)
