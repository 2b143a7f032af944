"""Numbers for the parts that texts are cut into, by whole arrays of bytes.

Equal parts get the same number. The first bytes of all parts are taken as two
words at once, which Numpy hashes and compares; only parts longer than the words
are also hashed and compared byte by byte. Every part is compared with the one
that got its number, so a clash of hashes is found and settled by the bytes
themselves.
"""

from __future__ import annotations

import os
import sys
from itertools import chain
from types import ModuleType

import numpy as np
import pandas as pd

PLACES = 64  # the hash repeats its values for bytes further in
WORD = 8
HEAD = 2 * WORD  # bytes of a part in its two words
# By the number of a word's bytes that belong to the part, from the first on.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(WORD + 1)], np.uint64)


class Parts:
    """Parts seen so far, numbered from 0."""

    def __init__(self):
        random = np.random.default_rng(1)
        self.values = random.integers(0, 1 << 64, PLACES * 256, np.uint64)
        self.factors = random.integers(0, 1 << 63, 3, np.uint64) * np.uint64(2) + np.uint64(1)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.blob, self.starts, self.sizes = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.heads = np.zeros((0, 2), np.uint64)
        self.clashes: dict[bytes, int] = {}

    def __len__(self) -> int:
        return len(self.sizes)

    def part(self, number: int) -> bytes:
        return self.blob[self.starts[number] : self.starts[number] + self.sizes[number]].tobytes()

    def _add(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Numbers for new parts."""
        first = len(self)
        self.starts = np.concatenate([self.starts, len(self.blob) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.heads = np.concatenate([self.heads, heads])
        self.blob = np.concatenate([self.blob, data[_spread(starts, sizes)]])
        return np.arange(first, first + len(sizes))

    def _hashes(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, heads: np.ndarray) -> np.ndarray:
        hashes = heads[:, 0] * self.factors[0] + heads[:, 1] * self.factors[1] + sizes.astype(np.uint64) * self.factors[2]
        long = np.flatnonzero(sizes > HEAD)
        if len(long):
            sizes = sizes[long]
            begin = np.cumsum(sizes) - sizes
            place = (np.arange(sizes.sum()) - np.repeat(begin, sizes)) & PLACES - 1
            hashes[long] += np.add.reduceat(self.values[place << 8 | data[_spread(starts[long], sizes)]], begin)
        return hashes

    def number(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The numbers of data[start:end]. Parts aren't empty."""
        if not len(starts):
            return np.zeros(0, np.int64)
        sizes = ends - starts
        heads = _heads(data, starts, sizes)
        which, found = pd.factorize(self._hashes(data, starts, sizes, heads))
        first = np.empty(len(found), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        # In the order of the hashes, since looking up sorted values is faster.
        order = np.argsort(found)
        found, first = found[order], first[order]
        at = np.minimum(np.searchsorted(self.hashes, found), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == found if len(self.hashes) else np.zeros(len(found), bool)
        numbers = np.empty(len(found), np.int64)
        numbers[known] = self.numbers[at[known]]
        new = first[~known]
        if len(new):
            numbers[~known] = self._add(data, starts[new], sizes[new], heads[new])
            to = np.searchsorted(self.hashes, found[~known])
            self.hashes = np.insert(self.hashes, to, found[~known])
            self.numbers = np.insert(self.numbers, to, numbers[~known])
        by_place = np.empty(len(found), np.int64)
        by_place[order] = numbers
        numbers = by_place[which]
        for at in self._wrong(data, starts, sizes, heads, numbers).tolist():
            value = data[starts[at] : ends[at]].tobytes()
            if value not in self.clashes:
                one = slice(at, at + 1)
                self.clashes[value] = int(self._add(data, starts[one], sizes[one], heads[one])[0])
            numbers[at] = self.clashes[value]
        return numbers

    def _wrong(
        self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, heads: np.ndarray, numbers: np.ndarray
    ) -> np.ndarray:
        """Which parts aren't, byte by byte, what their number stands for."""
        kept = self.heads.take(numbers, axis=0)
        other = (self.sizes[numbers] != sizes) | (kept[:, 0] != heads[:, 0]) | (kept[:, 1] != heads[:, 1])
        long = np.flatnonzero((sizes > HEAD) & ~other)
        if len(long):
            rest = sizes[long] - HEAD
            stored = _spread(self.starts[numbers[long]] + HEAD, rest)
            differs = np.flatnonzero(data[_spread(starts[long] + HEAD, rest)] != self.blob[stored])
            other[long[np.searchsorted(np.cumsum(rest), differs, side="right")]] = True
        return np.flatnonzero(other)


def _heads(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first bytes of each part as two words, 0 behind the part's end."""
    padded = np.concatenate([data, np.zeros(HEAD, np.uint8)])
    heads = np.lib.stride_tricks.sliding_window_view(padded, HEAD)[starts].view("<u8")
    heads[:, 0] &= MASKS[np.minimum(sizes, WORD)]
    heads[:, 1] &= MASKS[np.clip(sizes - WORD, 0, WORD)]
    return heads


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges that begin at `starts`, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


SENTINEL = b"\xff"  # in no UTF-8 text; stands between texts

# Bytes of plain words: ASCII letters, and letters of two bytes from À to ſ but × and ÷;
# and the marks that join no letter behind them.
LETTER, MARK, LEAD, OTHER = 0, 1, 2, 3
KINDS = np.full(256, OTHER, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = LETTER
KINDS[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = MARK
KINDS[[0xC3, 0xC4, 0xC5]] = LEAD


class LibraryEncoder:
    """Ids of texts by the tokenizers library, of which each distinct part is encoded once.

    A subclass says where texts are cut. A part of plain letters, with or without a
    space before and marks behind, is one or two pre-tokens, which go to the
    library's model at once; any other part goes through the whole library. `rows`
    are the ids of what was encoded; a part has one row or two.
    """

    lead_space = False
    not_plain: tuple[bytes, ...] = (b"\xc3\x97", b"\xc3\xb7")

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        self.model = self.library.model
        self.added = {token.content.encode() for token in self.library.get_added_tokens_decoder().values() if token.content}
        self.parts, self.units = Parts(), Parts()
        self.forget()

    def forget(self) -> None:
        self.parts.forget()
        self.units.forget()
        self.first = self.second = self.unit_rows = np.zeros(0, np.int64)
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def cut(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the parts of the texts data[start:end] begin and end; between them are gaps only."""
        raise NotImplementedError

    def symbols(self, units: bytes) -> str:
        """Pre-tokens, one after the other, in the characters of the library's model: one for each byte."""
        raise NotImplementedError

    def whole(self, part: bytes) -> bool:
        """Whether a part must go through the library though its letters are plain."""
        return part in self.added

    def _plain(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Bytes before the marks of parts that are letters and marks, 0 for other parts. Parts have no gaps."""
        kind = KINDS[data]
        lead = np.flatnonzero(kind == LEAD)
        after = np.minimum(lead + 1, len(data) - 1)
        pair = data[lead].astype(np.int64) << 8 | data[after]
        good = (data[after] & 0xC0 == 0x80) & ~np.isin(pair, [int.from_bytes(x, "big") for x in self.not_plain])
        kind[lead[good]] = kind[after[good]] = LETTER
        kind[lead[~good]] = OTHER
        spaced = np.zeros(len(starts), bool)
        if self.lead_space:
            spaced = data[starts] == 32
            kind[starts[spaced]] = LETTER
        turned = np.zeros(len(data), bool)
        turned[1:] = (kind[1:] == LETTER) & (kind[:-1] == MARK)
        turned[starts] = False
        letters = np.add.reduceat((kind == LETTER).astype(np.int64), starts)
        bad = np.add.reduceat((turned | (kind == OTHER)).astype(np.int64), starts) > 0
        first_mark = kind[starts] == MARK
        return np.where(bad | first_mark | (letters <= spaced), 0, letters)

    def _keep(self, encoded: list[list[int]]) -> np.ndarray:
        """New rows of ids."""
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), np.uint32, int(sizes.sum()))
        first = len(self.sizes)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
        return np.arange(first, first + len(encoded))

    def _unit_ids(self, known: int) -> list[list[int]]:
        """Ids of all units but the first `known`, by the library's model."""
        if known == len(self.units):
            return []
        tokenize, offset = self.model.tokenize, int(self.units.starts[known])
        symbols = self.symbols(self.units.blob[offset:].tobytes())
        starts = self.units.starts[known:] - offset
        bounds = zip(starts.tolist(), (starts + self.units.sizes[known:]).tolist(), strict=True)
        return [[made.id for made in tokenize(symbols[start:end])] for start, end in bounds]

    def _learn(self) -> None:
        """Encode the parts that are new since the last call."""
        known = len(self.first)
        if known == len(self.parts):
            return
        sizes = self.parts.sizes[known:]
        data = self.parts.blob[self.parts.starts[known] :]
        starts = np.cumsum(sizes) - sizes
        plain = self._plain(data, starts, sizes)
        for at in np.flatnonzero(np.isin(sizes, [len(x) for x in self.added]) & (plain > 0)).tolist():
            if self.whole(data[starts[at] : starts[at] + sizes[at]].tobytes()):
                plain[at] = 0
        first, second = np.full(len(sizes), -1), np.full(len(sizes), -1)
        simple = np.flatnonzero(plain)
        if len(simple):
            # The letters and the marks of each simple part, one after the other.
            packed = data[_spread(starts[simple], sizes[simple])]
            begin = np.cumsum(sizes[simple]) - sizes[simple]
            marked = plain[simple] < sizes[simple]
            cuts = np.sort(np.concatenate([begin, (begin + plain[simple])[marked]]))
            numbers = self.units.number(packed, cuts, np.r_[cuts[1:], len(packed)])
            self.unit_rows = np.concatenate([self.unit_rows, self._keep(self._unit_ids(len(self.unit_rows)))])
            at = np.searchsorted(cuts, begin)
            first[simple] = self.unit_rows[numbers[at]]
            second[simple[marked]] = self.unit_rows[numbers[at[marked] + 1]]
        rest = np.flatnonzero(plain == 0)
        texts = [data[starts[at] : starts[at] + sizes[at]].tobytes().decode() for at in rest.tolist()]
        first[rest] = self._keep([made.ids for made in self.library.encode_batch_fast(texts, add_special_tokens=False)])
        self.first, self.second = np.concatenate([self.first, first]), np.concatenate([self.second, second])

    def encoded(self, texts: list[bytes], most_parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and where each text's end. Beyond `most_parts`, parts are forgotten first."""
        if len(self.parts) > most_parts:
            self.forget()
        data = np.frombuffer(SENTINEL.join(texts) + SENTINEL, np.uint8)
        ends = np.cumsum([len(text) + 1 for text in texts]) - 1
        part_starts, part_ends = self.cut(data, np.r_[0, ends[:-1] + 1], ends)
        numbers = self.parts.number(data, part_starts, part_ends)
        self._learn()
        rows = np.stack([self.first[numbers], self.second[numbers]], axis=1)
        per_text = np.searchsorted(part_starts, ends)
        used = rows >= 0
        last_row = np.r_[0, np.cumsum(used.sum(axis=1))][per_text]
        rows = rows[used]
        sizes = self.sizes[rows]
        return self.flat[_spread(self.starts[rows], sizes)], np.r_[0, np.cumsum(sizes)][last_row]


def kept_encoder(kind: type[LibraryEncoder], tokenizer: str) -> LibraryEncoder:
    """The encoder of this worker process, which keeps its parts from task to task."""
    kept = sys.modules.setdefault("clicktrail_kept_encoders", ModuleType("clicktrail_kept_encoders")).__dict__
    key = f"{kind.__name__} {tokenizer}"
    if key not in kept:
        kept[key] = kind(tokenizer)
    return kept[key]
