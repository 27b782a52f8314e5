import gc
import random
import re
import weakref

import numpy as np
import pyarrow as pa
import pytest

from vitalgrid.llm.common import Texts, chain, slices, suffix_order, windows

WORD = re.compile("[^\x20\x09-\x0d]+")
TEXTS = ["a b  c", None, "", " \n", "one", "é ü\tß\x0bx", "a b  c", "日本 語 z", "x" * 300]


@pytest.fixture(autouse=True)
def wrap():
    with np.errstate(over="ignore"):
        yield


def test_words_are_the_pattern_s_words():
    texts = Texts.of(pa.array(TEXTS))
    words = texts.words
    for i, text in enumerate(TEXTS):
        mine = slice(words.first[i], words.first[i + 1])
        got = [texts.data[a:b].tobytes().decode() for a, b in zip(words.start[mine], words.end[mine])]
        assert got == WORD.findall(text or "")


def test_hash_depends_on_content_alone():
    words = Texts.of(pa.array(["aa b aa", "b aa", "aaa", "aab", "\x01", "\x01\x01"])).words
    spelled = [words.texts.data[a:b].tobytes() for a, b in zip(words.start, words.end)]
    by = {}
    for s, h in zip(spelled, words.hash.tolist()):
        assert by.setdefault(s, h) == h
    assert len(set(by.values())) == len(by)


def test_texts_and_words_are_freed_without_the_collector():
    gc.disable()
    try:
        texts = Texts.of(pa.array(TEXTS))
        words, alive = texts.words, [weakref.ref(texts), weakref.ref(texts.words), weakref.ref(texts.words.texts)]
        assert len(words.hash) and words.texts.hashes(words.start, words.end).tolist() == texts.hashes(words.start, words.end).tolist()
        del texts, words
        assert [r() for r in alive] == [None] * 3
    finally:
        gc.enable()


def test_sliced_arrays():
    whole = pa.array(TEXTS)
    assert Texts.of(whole.slice(3, 4)).words.per_text.tolist() == [0, 1, 4, 3]
    assert len(Texts.of(whole.slice(0, 0))) == 0


def test_windows_stay_in_their_text():
    words = Texts.of(pa.array(["a b c", "d", "a b"])).words
    at, value = words.grams(2)
    assert at.tolist() == [0, 1, 4]
    assert value[0] == value[2] == chain(words.hash[:2])
    assert not len(windows(words.hash, words.doc, 9)[0])


def test_short_texts_are_one_shingle():
    doc, value = Texts.of(pa.array(["a b", "", "a b c d e f", "a b"])).words.shingles(5)
    assert doc.tolist() == [0, 2, 2, 3]
    assert value[0] == value[3]


@pytest.mark.parametrize("depth", [1, 3, 6, 16])
def test_suffix_order(depth):
    random.seed(depth)
    for kinds in (2, 50):
        tokens = [random.randrange(kinds) for _ in range(200)]
        want = sorted(range(200), key=lambda i: (tokens[i : i + depth], i))
        assert suffix_order(np.array(tokens), depth).tolist() == want
        big = np.array(tokens, np.uint64) + np.uint64(1 << 60)
        assert suffix_order(big, depth).tolist() == want


def test_slices_are_bounded_and_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10] * 9 + [None, "y" * 100])], names=["t"])
    parts = list(slices(batch, "t", 25))
    assert sum(p.num_rows for p in parts) == 11
    assert all(p.num_rows <= 4 for p in parts)
    assert not list(slices(batch.slice(0, 0), "t"))
