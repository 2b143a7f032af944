"""All words of a batch against one search per text."""

import random
import re

import pytest

from clicktrail.llm import words
from tests.llm.helpers import EDGE_TEXTS, ascii_lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(texts):
    return [(word.encode(), n) for n, text in enumerate(texts) for word in WORD.findall(ascii_lower(text))]


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 22])
def test_windows_have_all_words_once(monkeypatch, window):
    monkeypatch.setattr(words, "WINDOW_BYTES", window)
    rng = random.Random(window)
    parts = ["a", "Bc", "9", " ", "\n", "-", "é", "日本", "\x00", "_", "[", "`", "{", "\x7f", "😀", "Ä"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(200)] + [t or "" for t in EDGE_TEXTS]
    found = [
        (word, number)
        for some, text in words.word_windows([text.encode() for text in texts])
        for word, number in zip(some, text.tolist(), strict=True)
    ]
    assert found == plain(texts)


@pytest.mark.parametrize("texts", [[], [b""], [b"", b"", b"  "], [b"", b"a", b"", b"b", b""]])
def test_empty_texts(texts):
    found = [(word, n) for some, text in words.word_windows(texts) for word, n in zip(some, text.tolist(), strict=True)]
    assert found == [(text, n) for n, text in enumerate(texts) if text.strip()]
