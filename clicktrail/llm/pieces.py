"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

How: texts are cut into words at every change from other characters to the
space mark, since no piece crosses such a change. The distinct words of a slice
of texts are merged together, as one flat array of symbols: each round finds
the best pair rank of every word, merges that pair wherever it stands (from the
left, without overlap) and compacts the array, until no word has a pair left.
The model's file gives the pieces; only identity-normalised BPE models with
byte fallback are taken.

Two cases make a round merge one place only, the leftmost: pieces that share
their score with another one, and pieces that a better piece could grow out of
at once. Words that are unfinished after `ROUNDS` rounds, such as very long
runs, are finished one by one with a heap, by the same order of merges.

Rules: a NULL or empty text has no ids and decodes to the empty text. Whole
texts are encoded; a long one is cut at words into segments whose ids follow
each other.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import Numbering, batch_of, byte_texts, others, text_slices

SPACE = "▁"
WORD = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
SLICE_ROWS = 4096  # texts whose words are merged together, at most
SLICE_BYTES = 2 << 20  # bytes of such texts, at most, beyond one text
SEGMENT = 1 << 19  # characters of a text that are cut into words at a time
ROUNDS = 64
NONE = np.iinfo(np.int64).max


class PieceModel:
    """Merges of a SentencePiece BPE model as sorted arrays."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        kinds = [self.library.is_control, self.library.is_unknown, self.library.is_byte, self.library.is_unused]
        reserved = [any(kind(i) for kind in kinds) for i in range(size)]
        names = [self.library.id_to_piece(i) for i in range(size)]
        ids = {name: i for i, name in enumerate(names) if not reserved[i]}
        self.bytes = np.array([self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        if any(not self.library.is_byte(int(i)) for i in self.bytes):
            raise ValueError(f"{path} has no byte pieces")

        # Characters without a piece stand for themselves above the ids and never merge.
        self.size = size
        self.chars = np.full(0x110000, -1, np.int64)
        for name, i in ids.items():
            if len(name) == 1:
                self.chars[ord(name)] = i

        scores = {i: self.library.get_score(i) for i in ids.values()}
        order = sorted(set(scores.values()), reverse=True)
        rank_of = {score: rank for rank, score in enumerate(order)}
        ranks = {i: rank_of[score] for i, score in scores.items()}
        pairs = {}
        best_growth: dict[int, int] = {}
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = ids.get(name[:cut]), ids.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * size + right] = i
                    for part in (left, right):
                        best_growth[part] = min(best_growth.get(part, ranks[i]), ranks[i])
        sharing = Counter(ranks[i] for i in set(pairs.values()))
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[key] for key in self.keys.tolist()], np.int64)
        self.ranks = np.array([ranks[i] for i in self.merged.tolist()], np.int64)
        # Whether a round may merge only the leftmost place of this rank in a word.
        self.single = np.zeros(len(order), bool)
        for i in set(pairs.values()):
            if sharing[ranks[i]] > 1 or best_growth.get(i, NONE) <= ranks[i]:
                self.single[ranks[i]] = True
        self.pairs = {key: (ranks[i], i) for key, i in pairs.items()}

    def pair_index(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index into `merged` and `ranks` of each pair of symbols, -1 for none."""
        key = np.where((left < self.size) & (right < self.size), left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words after merging, flat, and the number of each word's."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.chars[points]
        symbols = np.where(symbols < 0, points + self.size, symbols)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        word = np.repeat(np.arange(len(words)), sizes)
        for _ in range(ROUNDS):
            if len(symbols) < 2:
                break
            same = word[1:] == word[:-1]
            at = np.where(same, self.pair_index(symbols[:-1], symbols[1:]), -1)
            rank = np.append(np.where(at >= 0, self.ranks[at], NONE), NONE)
            starts = np.flatnonzero(np.r_[True, ~same])
            least = np.minimum.reduceat(rank, starts)
            active = least != NONE
            lengths = np.diff(np.r_[starts, len(symbols)])
            if not active.all():
                over = np.repeat(~active, lengths)
                done.append((symbols[over], word[over]))
                symbols, word, rank, at = symbols[~over], word[~over], rank[~over], np.append(at, -1)[~over]
                lengths, least = lengths[active], least[active]
                starts = np.cumsum(lengths) - lengths
            if not len(symbols):
                break
            chosen = np.flatnonzero(rank == np.repeat(least, lengths))
            of = word[chosen]
            first = np.r_[True, of[1:] != of[:-1]]
            # In a run of overlapping places every second one merges, from the left.
            head = np.r_[True, (chosen[1:] != chosen[:-1] + 1) | first[1:]]
            place = np.arange(len(chosen))
            even = (place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0
            chosen = chosen[even & (first | ~self.single[rank[chosen]])]
            symbols = symbols.copy()
            symbols[chosen] = self.merged[at[chosen]]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            symbols, word = symbols[keep], word[keep]
        if len(symbols):
            edges = np.flatnonzero(np.r_[True, word[1:] != word[:-1], True])
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                left = np.array(self._finish(symbols[start:end].tolist()), np.int64)
                done.append((left, np.full(len(left), word[start])))
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        flat, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return flat[order], np.bincount(word, minlength=len(words))

    def _finish(self, symbols: list[int]) -> list[int]:
        """The same merges on one word: best rank first, then leftmost, from a heap."""
        size, pairs, n = self.size, self.pairs, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def add(i: int) -> None:
            j = after[i] if i >= 0 else n
            if 0 <= i and j < n and symbols[i] < size and symbols[j] < size:
                found = pairs.get(symbols[i] * size + symbols[j])
                if found:
                    heapq.heappush(heap, (found[0], i, found[1], symbols[i], symbols[j]))

        for i in range(n - 1):
            add(i)
        while heap:
            _, i, merged, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = merged, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            add(before[i])
            add(i)
        return [symbol for symbol in symbols if symbol >= 0]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and the number of each word's."""
        symbols, sizes = self.merge_words(words)
        unknown = symbols >= self.size
        if not unknown.any():
            return symbols.astype(np.int32), sizes
        word = np.repeat(np.arange(len(words)), sizes)
        width = np.ones(len(symbols), np.int64)
        points = symbols[unknown] - self.size
        width[unknown] = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        ids = np.repeat(symbols, width)
        encoded = points.astype("<u4").tobytes().decode("utf-32-le").encode()
        ids[np.repeat(unknown, width)] = self.bytes[np.frombuffer(encoded, np.uint8)]
        return ids.astype(np.int32), np.bincount(np.repeat(word, width), minlength=len(words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and the number of each text's."""
        seen = Numbering()
        order: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            for segment in _segments(text):
                words = WORD.findall(segment)
                order.extend(map(seen.__getitem__, words))
                counts[i] += len(words)
        ids, sizes = self.encode_words(list(seen))
        starts = np.cumsum(sizes) - sizes
        order = np.array(order, np.int64)
        size = sizes[order]
        total = np.cumsum(size)
        at = np.arange(total[-1] if len(total) else 0) - np.repeat(total - size, size) + np.repeat(starts[order], size)
        per_text = np.add.reduceat(np.r_[size, 0], np.cumsum(counts) - counts) if len(texts) else counts
        return ids[at], np.where(counts > 0, per_text, 0)


def _segments(text: str) -> Iterator[str]:
    """The text with space marks, in parts that begin where a word begins."""
    if not text:
        return
    marked = SPACE + text.replace(" ", SPACE)
    start = 0
    while len(marked) - start > SEGMENT:
        end = start + SEGMENT
        while end < len(marked) and not (marked[end] == SPACE and marked[end - 1] != SPACE):
            end += 1
        yield marked[start:end]
        start = end
    yield marked[start:]


def encode_pieces(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: doc_id, ids (array of int), decoded (text of the ids), rest.

    `model` is the path of a SentencePiece model that every executor can read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), others(docs, id_col, text_col)
    )
    rest = rows.schema["rest"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel(model)
        for batch in batches:
            for start, end in text_slices(batch.column(1), SLICE_ROWS, SLICE_BYTES):
                texts = [t.decode() for t in byte_texts(batch.column(1), start, end)]
                ids, counts = pieces.encode(texts)
                offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
                lists = ids.tolist()
                decoded = [
                    pieces.library.decode(lists[i:j]) if i < j else ""
                    for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                ]
                yield batch_of(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                        pa.array(decoded, pa.string()),
                        batch.column(2).slice(start, end - start),
                    ],
                    ["doc_id", "ids", "decoded", "rest"],
                )

    return rows.mapInArrow(encode, f"doc_id long, ids array<int>, decoded string, rest {rest}")
