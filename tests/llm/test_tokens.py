"""Ids by remembered words against the tokenizers library on whole texts."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from landfall.llm.orc_tokens import _of_bytes
from landfall.llm.tokens import Encoder

PARTS = [
    "a", "the", "Der", "don't", "'s", "'", "''", "$$$", "...", ".", "!", "_", "-", "~", "`", "^", "\\", '"', "|", "12", "a1", "\n", "\n\n", " ", "  ", "\t", "\r\n",
    "\x0b", "\x0c", "\x1c", "\x00", "\x85", "\xa0", " ", "​", "́", "é", "é", "ß", "ǅ", "K", "ﬁ", "Σ", "ΑΣ",
    "ς", "ό", "İ", "日本", "\U0001f642", "<", "</w>", "<s>", "[UNK]",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_whole_text(name):
    encoder, rng = Encoder(public_tokenizers.path(name)), random.Random(4)
    assert encoder.ids(None) == encoder.ids("") == b""
    for _ in range(8000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 10)))
        assert encoder.ids(text) == encoder.whole(text), repr(text)
    long = " ".join(rng.choice(PARTS) for _ in range(20_000))
    assert encoder.ids(long) == encoder.whole(long)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_many_texts_are_those_of_each(name):
    encoder, rng = Encoder(public_tokenizers.path(name)), random.Random(5)
    texts = ["".join(rng.choice([*PARTS, ",", ",", "A", "Ñ"]) for _ in range(rng.randrange(10))) for _ in range(4000)]
    # Composed only without capitals; decomposed by normalisation, so that a mark stands before the comma; capitals without small letters.
    texts += [None, "", "J\u030c, j\u030c.", "a\u0958,b\u0958.", "\u0130, a.", "ΑΣ, ΑΣ.", "a_,b %,. ,,. 1,000.5", "DON'T, THEY'LL.", "\u1e9e,\u01c5."]
    for at in range(0, len(texts), 500):
        few = texts[at : at + 500]
        for text, ids in zip(few, encoder.many(few), strict=True):
            assert ids == (encoder.whole(text) if text else b""), repr(text)
    assert encoder.many([]) == []


def test_capitals_and_stops_make_no_more_words():
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.words.forget()
    met = []
    encoder.words.work_out = lambda before, word, f=encoder._work_out: met.append(word) or f(before, word)
    texts = ["Thering wasoft.", "thering, WASOFT\nthering.", "THERING. Wasoft"]
    assert encoder.many(texts) == [encoder.whole(t) for t in texts]
    assert sorted(met) == [",", ".", "thering", "wasoft"]
    assert encoder.many(texts) == [encoder.whole(t) for t in texts] and len(met) == 4


def test_slices_hold_all_rows_in_order():
    texts = ["a" * 9, None, "é" * 30, "", "b", "c" * 200, "d" * 5, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    for most in (1, 10, 64, 1000):
        slices = list(_of_bytes(batch, most))
        assert [t for s in slices for t in s.column(1).to_pylist()] == texts
        for s in slices:
            sizes = [len((t or "").encode()) for t in s.column(1).to_pylist()]
            assert sum(sizes) <= most + max(sizes)
    assert list(_of_bytes(batch.slice(0, 0), 10)) == []
