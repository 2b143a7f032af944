"""All words of a batch of texts in one regular-expression pass.

A word is a longest run of ASCII letters and digits and of any characters beyond
ASCII; A-Z become a-z. The texts are joined by a byte that no UTF-8 text has and
no word holds, one pass over the whole finds all words, and a search of their
places among the texts' offsets tells which text each is from.

Long batches are handled in windows that end between two words, so what a task
holds beside the texts doesn't grow with them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

SENTINEL = b"\xff"
WINDOW_BYTES = 4 << 20

WORD = re.compile(rb"[0-9a-z\x80-\xfe]+")
BETWEEN = re.compile(rb"[^0-9a-z\x80-\xfe]")
IN_WORD = np.array([bool(WORD.match(bytes([byte]))) for byte in range(256)])


def word_windows(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The words of all texts in order, window by window, and the number of each word's text."""
    if not texts:
        return
    data = SENTINEL.join(texts).lower()
    offsets = np.cumsum([0, *(len(text) + 1 for text in texts[:-1])])
    start = 0
    while start < len(data):
        gap = BETWEEN.search(data, start + WINDOW_BYTES)
        end = gap.start() if gap else len(data)
        words = WORD.findall(data, start, end)
        inside = IN_WORD[np.frombuffer(data, np.uint8, end - start, start)]
        inside[1:] &= ~inside[:-1]
        yield words, np.searchsorted(offsets, start + np.flatnonzero(inside), side="right") - 1
        start = end
