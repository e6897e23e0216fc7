import gc
import os
import random
import tracemalloc

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from salesloom.llm import lang_id, ngram_join
from salesloom.llm.common import forget_others
from salesloom.llm.sp_codec import MODEL, SPACE, Codec, Vocabulary, _encoder, decode, encode

pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary")
TEXTS = [
    "", " ", "  ", "a", "Hello  world ", "one\ntwo\tthree\r\n\n", "naïve café — 漢字 🙂 ́", "x" * 300,
    "\0 end", "The quick brown fox jumps over the lazy dog. " * 20,
]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load()


def test_without_dropout_as_the_library(vocabulary):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    codec = Codec(vocabulary, dropout=0.0)
    for text in TEXTS:
        assert codec.encode(text) == model.encode(text), text


@settings(max_examples=200, deadline=None)
@given(st.text(), st.integers(0, 3))
def test_round_trip(text, variant):
    for dropout in (0.0, 0.3, 1.0):
        codec = _codec(dropout)
        assert codec.decode(codec.encode(text, variant)) == text


_codecs = {}


def _codec(dropout):
    if dropout not in _codecs:
        _codecs[dropout] = Codec(Vocabulary.load(), dropout)
    return _codecs[dropout]


def test_signs_of_the_vocabulary_in_a_text(vocabulary):
    codec = Codec(vocabulary)
    for text in (SPACE, f" {SPACE} a{SPACE}b", "<0x41><s></s><unk>", f"{SPACE}{SPACE}\n {SPACE}"):
        assert codec.decode(codec.encode(text)) == text


def test_dropout_varies_and_repeats(vocabulary):
    text = "Segmentations of international organisations vary considerably"
    cuts = {tuple(Codec(vocabulary, 0.3, seed).encode(text)) for seed in range(12)}
    assert len(cuts) > 6
    assert Codec(vocabulary, 0.3, 5).encode(text, 2) == Codec(vocabulary, 0.3, 5).encode(text, 2)
    assert len(Codec(vocabulary, 1.0).encode("abc")) == 4  # no merge at all
    plain = len(Codec(vocabulary, 0.0).encode(text))
    assert all(len(c) >= plain for c in cuts)


def test_skips_follow_the_rate(vocabulary):
    codec = Codec(vocabulary, 0.25)
    rng = random.Random(1)
    words = {"".join(rng.choices("etaoin", k=2)) for _ in range(400)}
    pairs = [w for w in words if w in vocabulary.scores]
    skipped = sum(len(codec._cut(w, v)) == 2 for w in pairs for v in range(40))
    assert abs(skipped / (40 * len(pairs)) - 0.25) < 0.05


def test_operator(spark, vocabulary):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(90, None, None), (90, None, None), (None, "a", "y")]
    rows.append((91, "word " * 200_000, "z"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, `Ids` string")
    out = encode(docs, vocabulary)
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "lossless"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    assert all(r.ids is None and r.n_tokens == 0 for r in got if r.text is None)
    assert all(len(r.ids) == r.n_tokens for r in got if r.text is not None)
    back = decode(out.drop("text"), vocabulary).collect()
    assert sorted((str(r.doc_id), r.text) for r in back if r.text is not None) == sorted(
        (str(r[0]), r[1]) for r in rows if r[1] is not None
    )
    again = encode(docs.repartition(7), vocabulary).collect()
    assert sorted((str(r.doc_id), r.ids or []) for r in again) == sorted((str(r.doc_id), r.ids or []) for r in got)
    assert encode(docs.limit(0), vocabulary).count() == 0


def test_words_cut_together_and_alone_are_cut_alike(vocabulary):
    rng = random.Random(3)
    words = ["".join(rng.choices("▁▁aeinorstlé#.漢\0", k=rng.randint(1, 40))) for _ in range(1500)]
    for dropout in (0.0, 0.2, 0.6, 1.0):
        codec = Codec(vocabulary, dropout)
        found = codec._cut_all(words, 1)
        assert all(found[w] == codec._cut(w, 1) for w in words)


def test_what_is_remembered_changes_nothing(vocabulary, monkeypatch):
    from salesloom.llm import sp_codec

    texts = [t * 3 for t in TEXTS] * 2
    plain = [Codec(vocabulary).encode(t, i % 3) for i, t in enumerate(texts)]
    monkeypatch.setattr(sp_codec, "REMEMBERED", 4)
    codec = Codec(vocabulary)
    assert [codec.encode(t, i % 3) for i, t in enumerate(texts)] == plain
    assert Codec(vocabulary).encode_all(texts, [i % 3 for i in range(len(texts))]) == plain


def test_each_occurrence_is_drawn_anew(vocabulary):
    codec = Codec(vocabulary)
    word = " considerably"
    cuts = {tuple(codec._cut_all([SPACE + word[1:]], v).values()) for v in range(2000)}
    ids = codec.encode(word[1:] + word * 5000)
    plain = Codec(vocabulary, dropout=0.0).encode(word[1:])
    pieces, found = [], set()
    for i in ids:
        if vocabulary.pieces[i].startswith(SPACE) and pieces:
            found.add(tuple(pieces))
            pieces = []
        pieces.append(i)
    assert len(found) > 8 and tuple(plain) in found and len(cuts) > 8
    other = codec.encode(word[1:] + word * 4999)
    assert ids[:3000] != other[:3000]  # another text is another key
    assert ids == Codec(vocabulary).encode(word[1:] + word * 5000)


def test_what_a_worker_remembers_goes_when_another_call_begins(spark, vocabulary, monkeypatch):
    """Spark hands workers on to other jobs: decisions must not lie beside the memory of those."""
    handed = []
    kind = type(spark.range(1))
    given = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, run, *a, **k: handed.append(run) or given(df, run, *a, **k))
    docs = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    encode(docs, vocabulary)
    lang_id.identify(docs, None)
    ngram_join.jaccard_components(docs)
    encoder, *others = handed
    assert len(others) >= 3
    rows = pa.StructArray.from_arrays([pa.array([1])], ["doc_id"])
    batch = pa.record_batch([rows, pa.array(["some words of a text"])], names=["_row", "_text"])

    def codecs():
        gc.collect()
        return {id(x) for x in gc.get_objects() if isinstance(x, Codec)}

    before = codecs()
    for other in others:
        assert [b.num_rows for b in encoder(iter([batch]))] == [1]
        kept = codecs() - before
        assert len(kept) == 1
        list(encoder(iter([batch])))
        assert codecs() - before == kept  # a later task of the same call goes on with it
        list(other(iter([])))
        assert not codecs() - before


def test_memory_of_a_batch_is_bounded(vocabulary):
    """A batch of many texts is cut in slices: one of four times the characters takes hardly more."""
    rng = random.Random(8)
    words = ["".join(rng.choices("aeioulnrstdm", k=rng.randint(2, 9))) for _ in range(3000)]
    peaks = []
    for count in (250, 1000):
        texts = [" ".join(rng.choices(words, k=300)) for _ in range(count)]
        rows = pa.StructArray.from_arrays([pa.array(range(count))], ["doc_id"])
        batch = pa.record_batch([rows, pa.array(texts)], names=["_row", "_text"])
        run = _encoder(vocabulary, 0.1, 17, "test")
        tracemalloc.start()
        assert sum(out.num_rows for out in run(iter([batch]))) == count
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
        forget_others(None)
    assert peaks[1] < 1.5 * peaks[0]
