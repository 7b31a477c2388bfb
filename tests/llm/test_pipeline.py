import random
import re

import pytest
import sentencepiece

import corpus_pipeline as c
from gleanframe.llm.queries import piece_model
from tests.llm import test_decontaminate, test_language, test_near_dedup

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string"


def corpus():
    """Texts of four languages with copies, near copies, passages of the benchmark and junk."""
    rng = random.Random(12)
    items = [(n, " ".join(f"item{rng.randrange(400)}" for _ in range(30))) for n in range(5)]
    rows = []
    for k in range(220):
        lang = rng.choice(list(test_language.SAMPLES))
        words = [rng.choice(test_language.SAMPLES[lang].split()) for _ in range(rng.randrange(8, 60))]
        words = [w + str(rng.randrange(40)) if rng.random() < 0.5 else w for w in words]
        rows.append((" ".join(words), lang))
    for _ in range(60):
        text, lang = rng.choice(rows)
        words = text.split(" ")
        kind = rng.randrange(4)
        if kind == 0:
            words = [w + " " for w in words]
        elif kind == 1:
            words[rng.randrange(len(words))] = "changed"
        elif kind == 2:
            words[3:3] = rng.choice(items)[1].split()[5:25]
        rows.append((" ".join(words), lang))
    rows += [(None, None), ("", "xx"), ("12 !? 3", "yy")]
    rng.shuffle(rows)
    return [(2 * n + 1, t, lang, "s", len(t or ""), "x") for n, (t, lang) in enumerate(rows)], items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows, items = corpus()
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def plain(rows, items):
    """The stages as loops over all pairs; every text with letters has a language here."""
    kept = {r[0]: r[1] for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])}
    groups = {}
    for doc_id, text in kept.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", text), []).append((-len(text), doc_id))
    kept = {i: kept[i] for i in (min(g)[1] for g in groups.values())}
    near = test_near_dedup.brute(list(kept.items()), 5, 80)
    kept = {i: t for i, t in kept.items() if near[i][2]}
    kept = {i: t for i, t in kept.items() if not any(test_decontaminate.brute(t, b) for _, b in items)}
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    return {i: library.encode(t) for i, t in kept.items()}


def test_equals_plain_loops(spark, folder):
    rows, items = corpus()
    got = c.run(spark, folder).collect()
    want = plain(rows, items)
    assert {r.doc_id: r.ids for r in got} == want and len(got) == len(want)
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in got)
    assert 100 < len(want) < 230


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = [docs.count()]
    for _, stage in c.STAGES[:-1]:
        docs = c.stored(stage(spark, docs, folder), "stage")
        assert docs.columns == [f.split()[0] for f in DOCS.split(", ")]
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and len(set(counts)) == len(counts)


def test_stages_on_nulls_repeats_and_nothing(spark, folder):
    rows = [(None, "the of and", None, None, None, None), (3, "the of and", "xx", "s", 1, None),
            (3, "the of and", "xx", "s", 1, None), (3, "der die das", "yy", "s", 1, None), (4, None, None, None, None, None)]
    for data, left in ((rows, {"language_id": 4, "exact_dedup": 2, "near_dedup": 2, "decontamination": 2}), ([], {})):
        docs = spark.createDataFrame(data, DOCS)
        for name, stage in c.STAGES[:-1]:
            docs = c.stored(stage(spark, docs, folder), "stage")
            assert docs.count() == left.get(name, 0), name
        assert c.encode_documents(spark, docs, folder).count() == left.get("decontamination", 0)


def test_names_of_helpers_may_be_taken(spark, folder):
    names = ["lang_pred", "lang_score", "staying", "_staying", "sha", "ids", "component_id", "kept", "digest"]
    docs = spark.createDataFrame([(k, t, lang, *names) for k, t, lang in test_language.rows(7, 30)],
                                 ["doc_id", "text", "lang", *names])
    for _, stage in c.STAGES[:-1]:
        docs = c.stored(stage(spark, docs, folder), "stage")
        assert docs.columns == ["doc_id", "text", "lang", *names]
        assert all(tuple(r)[3:] == tuple(names) for r in docs.collect())
    assert c.encode_documents(spark, docs, folder).count() == docs.count() > 20


def test_a_null_id_stays(spark, folder):
    docs = spark.createDataFrame([(None, "the of and to", "xx", "s", 1, None)] + [
        (k, t, lang, "s", 1, None) for k, t, lang in test_language.rows(5, 40)], DOCS)
    for _, stage in c.STAGES[:-1]:
        docs = c.stored(stage(spark, docs, folder), "stage")
        assert docs.filter("doc_id is null").count() == 1


def test_copies_without_an_id_go_and_clean_texts_stay(spark, folder):
    clean, one = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(None, clean), (None, one + " end"), (3, one), (4, "another " + one), (4, "one more text")]
    docs = spark.createDataFrame([(*r, None, None, None, None) for r in rows], DOCS)
    left = c.remove_near_copies(spark, docs, folder).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, clean), (3, one), (4, "one more text")]


def test_the_classifier_decides_and_its_lack_deletes_nothing(spark, folder):
    rows = [(k, t, lang, "s", 1, None) for k, t, lang in test_language.rows(5, 400)]
    junk = [(1000, "qwx zkj vvqh jxz kwq zzx qjk wvx hqz " * 4, None, "s", 1, None)]
    left = c.identify_language(spark, spark.createDataFrame(rows + junk, DOCS), folder)
    assert {r.doc_id for r in left.collect()} == {r[0] for r in rows}
    unlabelled = [(*r[:2], None, *r[3:]) for r in rows[:20]] + [(2000, "12 !?", None, "s", 1, None)]
    assert c.identify_language(spark, spark.createDataFrame(unlabelled, DOCS), folder).count() == 20


def test_the_first_stage_decodes(spark, folder, monkeypatch):
    """A model whose codewords point at languages that the texts show nothing of keeps none of them."""
    train = c.language.train

    def turned(docs, **more):
        model = train(docs, **more)
        model.codes = c.language.np.roll(model.codes, 1, axis=0)
        return model

    docs = spark.createDataFrame([(k, t, lang, "s", 1, None) for k, t, lang in test_language.rows(5, 400) if len(t) > 60], DOCS)
    n = docs.count()
    assert n > 100 and c.identify_language(spark, docs, folder).count() == n
    monkeypatch.setattr(c.language, "train", turned)
    assert c.identify_language(spark, docs, folder).count() < 0.1 * n
