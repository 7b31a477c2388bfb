"""Random inputs against plain versions."""

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanframe.llm import html_text, pieces, repeats
from gleanframe.llm.queries import piece_model
from gleanframe.llm.quotient import QuotientFilter, merged
from gleanframe.llm.texts import span_hashes, utf8, words

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=piece_model())
ENCODER = pieces.Encoder(pieces.Vocabulary(piece_model()))
DECODER = pieces.Decoder(ENCODER.vocabulary)
MARKUP = st.lists(st.sampled_from(
    ["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "<!--", "-->", "<script>", "</script>", "text ",
     "&amp;", "<a href=\"", "'", '"', ">", "<", "<br>", "<nav>", "</nav>", "é", "\n"]), max_size=40).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=8))
def test_pieces_equal_the_library(texts):
    ids, counts = ENCODER.texts(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == LIBRARY.encode(texts)
    plain = [t for t in texts if "▁" not in t]
    ids, counts = ENCODER.texts(plain) if plain else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    assert DECODER.texts(ids, counts) == plain


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text("ab cé", max_size=12), max_size=6), max_size=4))
def test_learning_ahead_changes_nothing(groups):
    encoder = pieces.Encoder(ENCODER.vocabulary)
    encoder.learn(iter(groups))
    for texts in groups:
        ids, counts = encoder.texts(texts)
        assert counts.tolist() == [len(x) for x in LIBRARY.encode(texts)] and len(ids) == counts.sum()


@settings(max_examples=200, deadline=None)
@given(MARKUP)
def test_main_text_is_clean(page):
    text = html_text.main_text(page)
    assert text == "\n".join(" ".join(line.split()) for line in text.split("\n"))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=30), min_size=1, max_size=5))
def test_merged_filters_list_every_fingerprint(parts):
    filters = [QuotientFilter.of(np.array(p, np.uint64), np.ones(len(p), np.int64), 64) for p in parts]
    one = merged([QuotientFilter.unpacked(*f.packed()) for f in filters], 64)
    want, counts = np.unique(np.array(sum(parts, []), np.uint64), return_counts=True)
    assert (one.fingerprints(64) == want).all() and (one.counts == counts).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab \n\x0bé", max_size=40), min_size=1, max_size=6))
def test_words_and_their_hashes(texts):
    import pyarrow as pa

    data, starts = utf8(pa.array(texts))
    begin, end, firsts = words(data, starts)
    plain = [w for t in texts for w in t.encode().split()]
    assert [data[b:e].tobytes() for b, e in zip(begin, end)] == plain
    assert np.diff(firsts).tolist() == [len(t.encode().split()) for t in texts]
    hashes = span_hashes(data, begin, end)
    assert len(set(hashes.tolist())) == len(set(plain))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=90), min_size=1, max_size=5), st.integers(17, 40))
def test_windows_that_occur_earlier(texts, length):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    some = repeats.pieces(data, starts, length)
    got = repeats.earlier(repeats.gathered(data, some.start, some.run + length - 1), some.lead, some.run, some.text, length)
    seen, want = {}, []
    for number, text in enumerate(texts):
        for k in range(len(text) - length + 1):
            want.append(seen.setdefault(text[k:k + length], number) < number)
    assert got.tolist() == want
