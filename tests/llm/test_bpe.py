from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from pacewise.llm import bpe, lexicon
from pacewise.llm.queries import token_digests, tokenizer

PIECES = [
    *"abcXYZ '’\t\n\x1c\x0b\x85 　éÉßÄöΣσςİıǅ１２٣漢字กہि́̈ﬁÅΩ</w>|0123!?\x00😀‍",
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "don't", " the ", "</w>",
]


def check(got, texts):
    library = Tokenizer.from_file(tokenizer())
    for r in got:
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want, texts[r.doc_id]
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_equals_the_library(documents):
    pick = random.Random(4)
    texts = ["".join(pick.choices(PIECES, k=pick.randint(0, 60))) for _ in range(800)]
    texts += [None, "", " \n", "x" * 5000, "word " * 30_000, "the the THE", "é" * 300]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    for words in (1, 40):  # the size of the lexicon must not matter
        got = bpe.encode(documents(rows), tokenizer(), lexicon_words=words).collect()
        assert len(got) == len(rows)
        check(got, texts)


def test_repeated_rows_and_missing_ids(documents):
    got = bpe.encode(documents([(None, "a b", "s"), (1, "c", "s"), (1, "c", "s")]), tokenizer())
    digests = token_digests(got).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in digests) == [(False, 1)] * 2 + [(True, 2)]


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_nothing_to_encode(documents, rows):
    got = bpe.encode(documents(rows), tokenizer()).collect()
    assert [(r.ids, r.decoded) for r in got] == [([], "")] * len(rows)


def test_lexicon_knows_its_words_only(tmp_path):
    pick = random.Random(1)
    words = {
        bytes(pick.choices(b"abcd\xff", k=pick.randint(1, 7))): [pick.randint(0, 9)] * pick.randint(1, 3)
        for _ in range(900)
    }
    lexicon.compile_lexicon(words, str(tmp_path / "l"))
    found = lexicon.Lexicon(str(tmp_path / "l"))
    asked = [*words, *(w + b"x" for w in words), b"", b"abcdabcdabcd", b"\x00"]
    for word, place in zip(asked, found.places(asked).tolist()):
        assert (place >= 0) == (word in words)
        if place >= 0:
            a, b = found.offsets[place : place + 2]
            assert found.ids[a:b].tolist() == words[word]


def test_endings_are_shared(tmp_path):
    words = {f"{a}{b}ing".encode(): [1] for a in "abcdefgh" for b in "xyz"}
    lexicon.compile_lexicon(words, str(tmp_path / "l"))
    # Minimal: the start, one state after any first letter, and the ending's four.
    assert len(set(lexicon.Lexicon(str(tmp_path / "l")).keys >> 8)) == 5


@pytest.mark.parametrize("alphabet", ["ab", "etaoin", "é漢字a", "0123456789"])
def test_long_words_merge_as_short_ones_do(monkeypatch, alphabet):
    vocabulary, pick = bpe.Vocabulary(tokenizer()), random.Random(2)
    for n in (2, 3, 64, 65, 300, 3000):
        word = "".join(pick.choices(alphabet, k=n)).encode()
        monkeypatch.setattr(bpe, "SHORT_BYTES", 10**9)
        want = vocabulary.merge(word)
        monkeypatch.setattr(bpe, "SHORT_BYTES", 0)
        assert vocabulary.merge(word) == want


def test_a_word_of_many_letters_is_merged_at_once(documents):
    pick = random.Random(3)
    texts = ["".join(pick.choices("etaoinshrdlu", k=200_000)), "漢字かな交じり文" * 20_000]
    check(bpe.encode(documents([(i, t, "s") for i, t in enumerate(texts)]), tokenizer()).collect(), texts)


def test_memory_is_bounded_by_characters(tmp_path, monkeypatch):
    lexicon.compile_lexicon({}, str(tmp_path / "l"))
    encoder = bpe.Encoder(bpe.Vocabulary(tokenizer()), lexicon.Lexicon(str(tmp_path / "l")))
    monkeypatch.setattr(bpe, "REMEMBERED_CHARS", 50_000)
    pick = random.Random(5)
    for _ in range(40):
        encoder.encode(["".join(pick.choices("abcdefgh", k=10_000)) for _ in range(2)])
        assert encoder.chars <= 70_000 and len(encoder.ids) <= 70_000
    assert not encoder.merged  # long words aren't remembered


def test_an_encoder_stays_small_over_ever_new_words(tmp_path, monkeypatch):
    path = str(tmp_path / "lexicon.bin")
    vocabulary = bpe.Vocabulary(tokenizer())
    lexicon.compile_lexicon({b"the": vocabulary.merge(b"the")}, path)
    encoder = bpe.Encoder(vocabulary, lexicon.Lexicon(path))
    monkeypatch.setattr(bpe, "MERGED", 1000)
    pick = random.Random(6)
    for _ in range(3):
        words = ["".join(pick.choices("abcdefgh", k=9)) for _ in range(4000)]
        ids, offsets, decoded = encoder.encode([" ".join(words), "the"])
        assert ids.tolist() == [i for w in [*words, "the"] for i in vocabulary.merge(w.encode())]
        assert len(encoder.merged) <= 1000
    # What a slice takes at a time is little beside an executor's memory for Python.
    text = " ".join("".join(pick.choices("abcdefgh", k=9)) for _ in range(300_000))
    assert len(max(bpe._slices([text[i : i + 2000] for i in range(0, len(text), 2000)], bpe.SLICE_CHARS), key=len)) <= 500
