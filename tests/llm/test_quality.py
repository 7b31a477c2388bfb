import math
import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa

from gleanframe.llm import quality as q

DOCS = "doc_id bigint, text string, labelled int, learn boolean, n_words string, total string"
LABELS = "doc_id bigint, quality int, toxic int, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """The five counts of a text, by plain loops."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    marked = {k + s for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for s in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(marked))


def grams(text):
    words = WORD.findall(text or "")
    hashes = [q.word_hash(w.encode()) for w in words]
    return [h % q.BUCKETS for h in hashes] + [
        q.BUCKETS + (a * 1_000_003 + b) % 4_294_967_291 % q.BUCKETS for a, b in zip(hashes, hashes[1:])]


def by_hand(docs, labels):
    says = {}
    for n, good, toxic in labels:
        if n is not None and good is not None:
            says.setdefault(n, []).append((good, toxic or 0))
    trusted = {n for n, s in says.items() if all(g > 0 for g, _ in s) and max(t for _, t in s) == 0}
    rejected = {n for n, s in says.items() if all(g <= 0 for g, _ in s)}
    learn = {n for n in trusted if zlib.crc32(str(n).encode()) % 2 == 0}
    raw, good = Counter(), Counter()
    for n, text in docs:
        raw.update(grams(text))
        if n in learn:
            good.update(grams(text))
    share = sum(good.values()) / max(1, sum(raw.values()))
    weight = {b: math.floor(math.log((good[b] + 20) / (raw[b] * share + 20)) * 65536 + 0.5) for b in raw}
    rows, steps = [], {}
    for n, text in docs:
        base = counts(text)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        mine = grams(text)
        total = sum(weight[b] for b in mine) if good else 0
        rows.append((n, base, failed, total, len(mine)))
        if not failed and (n in rejected or n in trusted - learn):
            step = steps.setdefault(total // (64 * len(mine)), [0, 0])
            step[n in rejected] += 1
    least = None
    if sum(s[0] for s in steps.values()) and sum(s[1] for s in steps.values()):
        n_good, n_bad = (sum(s[k] for s in steps.values()) for k in (0, 1))
        cost = {c: 10 * n_bad * sum(s[0] for x, s in steps.items() if x < c)
                + n_good * sum(s[1] for x, s in steps.items() if x >= c) for c in steps}
        best = min(sorted(steps), key=cost.get)
        below = [x for x in steps if x < best]
        least = (best + max(below) + 1) // 2 if below else best
    return sorted(((n, *base, failed, total / size / 65536 if size else 0.0,
                    not failed and (least is None or total // (64 * size) >= least))
                   for n, base, failed, total, size in rows), key=repr)


def found(table, docs, labels, **more):
    rows = table([(n, text, 5, True, "x", "y") for n, text in docs], DOCS, 3)
    marks = table([(*x, "z") for x in labels], LABELS, 2)
    return sorted((tuple(r) for r in q.judge_documents(rows, marks, **more).select(
        "doc_id", *q.COUNTS, "base_failed", "score", "kept").collect()), key=repr)


def corpus():
    """Plain texts, and texts of words that hardly occur in them."""
    random.seed(5)
    plain, odd = [f"w{k}" for k in range(60)], [f"*x{k}|" for k in range(400)]
    docs = [(n, " ".join(random.choices(plain, k=60 + n % 50)) + "\nZeile é\n" * (n % 4)) for n in range(120)]
    docs += [(n, " ".join(random.choices(odd, k=80)) + " " + " ".join(random.choices(plain, k=20)))
             for n in range(120, 160)]
    labels = [(n, 1, n % 17 == 0) for n in range(60)] + [(n, 0, 0) for n in range(120, 140)]
    return docs, [(n, good, int(toxic)) for n, good, toxic in labels]


def test_equals_plain_loops(table):
    docs, labels = corpus()
    docs += [(None, docs[0][1]), (None, None), (7, docs[130][1]), (500, ""), (501, " \n\n"), (502, "a b c " * 40),
             (503, docs[3][1]), (503, docs[3][1])]
    labels += [(None, 1, 0), (3, None, 1), (5, 0, 0), (60, 1, None), (900, 1, 0), (121, 1, 0), (8, 1, 0), (8, 1, 0)]
    assert found(table, docs, labels) == by_hand(docs, labels)


def test_odd_texts_go_and_plain_ones_stay(table):
    docs, labels = corpus()
    kept = {r[0]: r[-1] for r in found(table, docs, labels)}
    assert kept == {n: n < 120 for n, _ in docs}


def test_without_labels_or_rows(table):
    docs, labels = corpus()
    only_good = [x for x in labels if x[1]]
    for some in ([], only_good, [x for x in labels if not x[1]]):
        got = found(table, docs, some)
        assert got == by_hand(docs, some) and all(r[-1] == (not r[-3]) for r in got)
    assert found(table, [], labels) == []


def test_bounded_labels(table):
    docs, labels = corpus()
    classes = q.label_classes(table([(*x, "") for x in labels], LABELS), rows=30)
    assert 10 < classes.count() < 55
    assert len(found(table, docs, labels, rows=30)) == len(docs)


def test_every_label_counts(spark, table):
    """Labels of 2.3 million ids that no document has; half of the labels went where they were bounded."""
    docs, labels = corpus()
    more = spark.range(10**6, 33 * 10**5).selectExpr("id as doc_id", "1 as quality", "0 as toxic", "'z' as text")
    all_labels = table([(*x, "z") for x in labels], LABELS, 2).unionByName(more)
    assert q.label_classes(more).count() == 23 * 10**5
    rows = table([(n, text, 5, True, "x", "y") for n, text in docs], DOCS, 3)
    got = q.judge_documents(rows, all_labels).select("doc_id", *q.COUNTS, "base_failed", "score", "kept").collect()
    assert sorted((tuple(r) for r in got), key=repr) == by_hand(docs, labels)


def test_long_texts(table):
    text = "x" * 300_000 + " " + " ".join(f"a{k}" for k in range(150_000)) + "\n#\n#\n"
    got = found(table, [(1, text), (2, "é" * 100_000)], [])
    assert [r[1:6] for r in got] == [counts(text), counts("é" * 100_000)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é#\n\t\r |", max_size=60)), max_size=6))
def test_counts_of_any_text(texts):
    found = q.Words(pa.array(texts, pa.string()))
    got = list(zip(map(int, found.firsts[1:] - found.firsts[:-1]), map(int, found.word_chars()),
                   map(int, found.symbols()), map(q.duplicate_lines, texts), map(int, found.repeated())))
    assert got == [counts(t) for t in texts]
