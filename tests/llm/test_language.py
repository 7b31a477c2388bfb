import random
import zlib

import numpy as np
import pytest

from gleanframe.llm import language as la
from gleanframe.llm.queries import op4_language_id

DOCS = "doc_id bigint, text string, lang string, score string, id string"
SAMPLES = {"xx": "the of and to in that with for was", "yy": "der die und das ist nicht mit für über",
           "zz": "le la les des que est pour dans être", "vv": "el los que por para con una niño"}


def rows(seed=1, n=240):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        lang = rng.choice(list(SAMPLES))
        words = SAMPLES[lang].split()
        out.append((k, " ".join(rng.choice(words) for _ in range(rng.randrange(4, 30))), lang))
    return out


def docs(table, rows):
    return table([(*r, "", "") for r in rows], DOCS)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 7, 40])
def test_codewords_differ(n):
    codes = la.codewords(n)
    assert codes.shape[0] == n and set(np.unique(codes)) <= {-1, 1}
    apart = [(codes[a] != codes[b]).sum() for a in range(n) for b in range(a)]
    assert n == 1 or min(apart) >= (1 if n == 2 else 2)


def test_held_out_texts_get_their_language(table):
    data = rows()
    table_ = docs(table, data)
    got = {r.doc_id: r for r in la.identify(table_, la.train(table_)).collect()}
    assert len(got) == len(data)
    held = [k for k, *_ in data if zlib.crc32(str(k).encode()) % 5 == 0]
    assert {k for k, r in got.items() if r.held_out} == set(held) and len(held) > 20
    assert sum(got[k].lang_pred == lang for k, _, lang in data if k in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_a_single_wrong_bit_is_corrected():
    data = rows(3)
    import pyarrow as pa

    model = la.fit(la.features(pa.array([t for _, t, _ in data])), [x for *_, x in data])
    model.weights[:, 2] *= -1
    best, _, _ = model.decode(la.features(pa.array([t for _, t, _ in rows(4)])))
    assert np.mean([model.languages[b] == x for b, (*_, x) in zip(best, rows(4))]) > 0.9


def test_mixed_texts_are_ambiguous(table):
    model = la.train(docs(table, rows()))
    mixed = SAMPLES["xx"] + " " + SAMPLES["zz"]
    got = {r.doc_id: r for r in la.identify(docs(table, [(1, mixed, None), (2, SAMPLES["xx"], None)]), model).collect()}
    assert got[1].score < got[2].score and not got[2].ambiguous


def test_nothing_to_read_or_to_learn(table):
    data = [(1, None, "xx"), (2, "", "xx"), (3, "12 !?", "xx"), (None, "the of", None), (4, "the", None), (4, "the", None)]
    for model in (None, la.train(docs(table, rows()))):
        got = [tuple(r) for r in la.identify(docs(table, data), model).collect()]
        assert len(got) == 6
        assert sorted((r[2], r[3]) for r in got if r[0] in (1, 2, 3)) == [("und", 0.0)] * 3
    assert la.train(docs(table, [])) is None and la.train(docs(table, data[4:])) is None
    assert la.identify(docs(table, []), None).collect() == []
    one = la.train(docs(table, [(k, "one tongue", "xx") for k in range(9)]))
    assert {r.lang_pred for r in la.identify(docs(table, data), one).collect()} == {"xx", "und"}


def test_whole_texts_count(table):
    model = la.train(docs(table, rows()))
    long = SAMPLES["xx"] + (" " + SAMPLES["yy"]) * 40_000
    assert la.identify(docs(table, [(1, long, None)]), model).first().lang_pred == "yy"


def test_accuracy_on_the_documents(spark):
    out = op4_language_id(spark, "/root/testdata/sf0.01").filter("held_out")
    docs_ = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = out.join(docs_, "doc_id").filter("lang is not null").selectExpr(
        "avg(cast(lang = lang_pred as int)) as share", "count(*) as n").first()
    assert got.n > 100 and got.share > 0.98


def test_texts_in_no_language_are_rejected(table):
    data = rows(5, 400)
    model = la.train(docs(table, data))
    strange = [(1000, "qwx zkj vvqh jxz kwq zzx qjk wvx hqz " * 4, None), (1001, "съешь ещё этих мягких булок " * 4, None)]
    short = [(1002, "qx zk", None), (1003, "the", None), (1004, "1 2", None), (1005, None, None)]
    kept = {r.doc_id for r in la.with_language(docs(table, data + strange + short), model).collect()}
    assert kept == {k for k, *_ in data} | {1002, 1003}


HELD_OUT = {  # sentences in languages and scripts that no document has
    "pl": "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem",
    "fi": "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki",
    "ru": "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
    "ar": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق وقد وهبوا عقلا وضميرا",
    "ja": "すべての人間は 生まれながらにして 自由であり かつ 尊厳と 権利とについて 平等である"}


def test_unseen_languages_go_and_labelled_texts_stay(spark):
    docs_ = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = la.train(docs_)
    rng = random.Random(6)
    strange = [" ".join(rng.choices(t.split(), k=k)) for t in HELD_OUT.values() for k in (40, 120, 600)]
    strange += [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(k))
                for k in (10, 40, 120, 600)]
    odd = docs_.limit(0).unionByName(spark.createDataFrame(
        [(10**9 + n, t, None, "s", len(t)) for n, t in enumerate(strange)], docs_.schema))
    assert la.with_language(odd, model).count() == 0
    labelled = docs_.filter("lang is not null and text rlike '[[:alpha:]]'".replace("[[:alpha:]]", "\\\\p{L}"))
    assert la.with_language(labelled, model).count() == labelled.count() > 500


def test_a_word_or_two_is_not_rejected(table):
    model = la.train(docs(table, rows(5, 400)))
    few = [(n, t, None) for n, t in enumerate(["the", "nicht", "qx zk", "x"])]
    assert la.with_language(docs(table, few), model).count() == 4


def test_one_text_of_each_language_bounds_nothing(table):
    model = la.train(docs(table, [(2, "the of and", "xx"), (3, "der die das", "yy"), (1, "le la", "zz")]))
    assert la.with_language(docs(table, [(1, "qqq www zzz " * 9, None)]), model).count() == 1


def test_a_text_is_judged_by_the_language_it_decodes_to(table):
    data = [x for x in rows(5, 400) if len(x[1]) > 60]
    model = la.train(docs(table, data))
    clear = [r.doc_id for r in la.identify(docs(table, data), model).filter("not ambiguous and score > 0.9").collect()]
    assert len(clear) > 100
    model.likely = np.roll(model.likely, 1, axis=1)  # now each shows evidence of another language only
    left = {r.doc_id for r in la.with_language(docs(table, data), model).collect()}
    assert not left & set(clear)


def test_rejected_texts_have_no_language(table):
    data = rows(5, 400)
    model = la.train(docs(table, data))
    more = [(1000, "qwx zkj vvqh jxz kwq zzx qjk wvx hqz " * 4, None), (1001, "12 !?", None), (1002, None, None)]
    got = {r.doc_id: r for r in la.identify_rows(docs(table, data + more), model, reject=True).collect()}
    plain = {r.doc_id: r for r in la.identify(docs(table, data + more), model).collect()}
    assert all((got[k].lang_pred, got[k].score, got[k].ambiguous) == ("und", 0.0, False) for k in (1000, 1001, 1002))
    assert plain[1000].lang_pred in SAMPLES
    assert all(got[k][-3:] == plain[k][-3:] for k, *_ in data)


def test_a_language_may_be_called_und(table):
    data = [(k, t, "und" if lang == "xx" else lang) for k, t, lang in rows(5, 400)]
    assert la.with_language(docs(table, data), la.train(docs(table, data))).count() == 400
