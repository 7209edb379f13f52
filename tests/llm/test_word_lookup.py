"""Words are looked up many at a time, and windows of whole texts scored without masks, with the same results."""

import numpy as np
import pytest

from homespan.llm import attention_lm as lm
from homespan.llm.queries import WORD_PIECES
from homespan.llm.subwords import LetterRuns, ShortWords, WordCache


class OneByOne(LetterRuns):
    words = WordCache.words


class Asked(dict):
    asked = 0

    def get(self, *key):
        Asked.asked += 1
        return super().get(*key)


def texts():
    draw = np.random.default_rng(6)
    words = [b"a" * n for n in range(1, 40)] + ["é".encode() * n for n in range(1, 10)]
    words += [b"b" * n + bytes([c]) for n in (0, 7, 8, 15, 16) for c in (33, 127, 128, 255, 14, 8)]
    gaps = [b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b"  "]
    mixed = [b"".join(words[i] + gaps[i % 7] for i in draw.integers(0, len(words), n)) for n in (0, 1, 400, 900)]
    return [b"", *mixed, b" ", b"Ab aB AB", b" lead", b"trail ", b"x" * 3000]


@pytest.mark.parametrize("zero", [b"", b"a\0 a a\0\0"])
@pytest.mark.parametrize("most", [400_000, 20])
def test_words_have_the_ids_that_they_have_one_by_one(monkeypatch, zero, most):
    monkeypatch.setattr(LetterRuns, "most_words", most)
    many, single = LetterRuns(WORD_PIECES), OneByOne(WORD_PIECES)
    many.short = ShortWords(bits=3)
    for part in ([], [b""], texts(), [zero, *texts()[::-1]], [b"ab cd", b"ab"]):
        (at, first), (other, starts) = many.words(part), single.words(part)
        assert np.array_equal(first, starts) and np.array_equal(many.sizes_at(at), single.sizes_at(other))
        assert all(np.array_equal(a, b) for a, b in zip(many.ids_at(at, first), single.ids_at(other, starts), strict=True))


def test_short_words_that_are_held_are_not_asked_for_one_by_one():
    coder = LetterRuns(WORD_PIECES)
    coder.words([b"the cat sat on the mat " * 100])
    coder.place, Asked.asked = Asked(coder.place), 0
    coder.words([b"the cat sat on the mat " * 100, b"the dog"])
    assert Asked.asked == 1


@pytest.mark.parametrize("size", [1, 40])
def test_a_text_has_the_chances_of_its_windows(size):
    draw = np.random.default_rng(7)
    pairs = draw.integers(0, 5, (13, 13)).astype(np.float32)
    model = lm.AttentionModel(lm.Counts(1, 1, 1, np.arange(12), np.arange(12), np.arange(12), np.arange(14), pairs))
    model.weights["rows"][:-1, : lm.VALUE.stop] *= np.float32(size)
    model.ready()
    assert model.small == (size == 1)
    sizes = [0, 1, 22, 23, 24, 25, 47, 48, 700, 0, *draw.integers(0, 90, 90)]
    ids = draw.integers(0, 14, sum(sizes))
    read, told, begins = lm.sequences(ids, np.append(0, np.cumsum(sizes)), 13)
    places, valid, owner = lm.cut_windows(begins)
    wanted = np.zeros(len(sizes))
    for p, v, whose in zip(places, valid, owner, strict=True):
        got = model.log_chances(model.place[read[p]][None], v[None], told[p[lm.OVERLAP :]][None])[0]
        wanted[whose] += got[v[lm.OVERLAP :]].sum()
    assert np.allclose(lm.score_stream(model, read, told, begins), wanted / np.log(10), rtol=1e-5, atol=1e-5)
