"""Unigram token counts by dynamic programming over a shared trie.

The best segmentation of a word is found by a forward pass: the best score of a prefix is the best, over the
vocabulary pieces that end there, of the score before the piece plus the piece's own. New words of a batch stand in
a trie; the forward score of a prefix and the number of its pieces are computed once for all words that share
it, and the count at a word's end is kept. There is no shuffle; memory is bounded by a batch and the cache.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from filings_audit.llm.common import WHITE_SPACE, map_texts, once
from filings_audit.llm.trie import Suffixes, levels

# Words kept per task. A full cache is emptied; results don't depend on it.
CACHE_WORDS = 400_000
# Scores are whole numbers of this part of a nat, so sums and ties don't depend on the order of additions.
UNIT = 1 << 20
# Fixed value: the sign that stands for the space before a word in the vocabulary file.
SPACE = "▁"
UNKNOWN_BYTE = -60 * UNIT
NONE = np.iinfo(np.int64).min // 4


def piece_scores(path: str) -> dict[bytes, int]:
    """Pieces of a sentencepiece file with unigram scores: the file lists them by rank, and by Zipf's law a
    piece's log probability is minus the logarithm of its rank. Control and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {model.id_to_piece(i).encode(): -round(math.log(rank + 2) * UNIT) for rank, i in enumerate(plain)}


class Counter:
    """The vocabulary's automaton and the forward pass over a set of words."""

    def __init__(self, scores: dict[bytes, int]):
        self.suffixes = Suffixes(list(scores))
        self.score = np.array(list(scores.values()) + [0], np.int64)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word's best segmentation; of equal ones the shortest. ``words`` are sorted."""
        table = self.suffixes
        lengths = np.array(list(map(len, words)), np.int64)
        width = int(lengths.max(initial=0))
        best = np.full((width + 1, len(words)), NONE)
        count = np.zeros((width + 1, len(words)), np.int64)
        best[0] = 0
        for depth, active, first, below, state in levels(words, lengths, table):
            top, number = np.full(len(first), NONE), np.zeros(len(first), np.int64)
            left, place = np.arange(len(first)), table.ends[state]
            left, place = left[place > 0], place[place > 0]
            while len(left):
                before, word = depth - table.depth[place], first[left]
                now, pieces = best[before, word] + self.score[table.entry[place]], count[before, word] + 1
                better = (now > top[left]) | ((now == top[left]) & (pieces < number[left]))
                top[left[better]], number[left[better]] = now[better], pieces[better]
                place = table.ends[table.fail[place]]
                left, place = left[place > 0], place[place > 0]
            # A character that no piece covers falls back to its bytes.
            for size in range(1, min(4, depth) + 1):
                whole = np.flatnonzero((top < NONE // 2) & self._is_character(words, first, depth, size))
                word = first[whole]
                now = best[depth - size, word] + size * UNKNOWN_BYTE
                fits = best[depth - size, word] > NONE // 2
                top[whole[fits]], number[whole[fits]] = now[fits], (count[depth - size, word] + size)[fits]
            best[depth, active], count[depth, active] = top[below], number[below]
        return count[lengths, np.arange(len(words))]

    @staticmethod
    def _is_character(words: list[bytes], first: np.ndarray, depth: int, size: int) -> np.ndarray:
        """Whether the ``size`` bytes before ``depth`` are one whole UTF-8 character."""
        starts = np.array([words[w][depth - size] for w in first.tolist()], np.int64)
        expected = np.select([starts < 0x80, starts >= 0xF0, starts >= 0xE0, starts >= 0xC0], [1, 4, 3, 2], 0)
        return expected == size


def _counts(path: str) -> Callable[[], Callable[[list], list]]:
    def make():
        counter = once(("unigram", path), lambda: Counter(piece_scores(path)))
        words_of = re.compile(f"[^{WHITE_SPACE}]+").findall
        known: dict[str, int] = {}

        def count(texts: list) -> list:
            if len(known) > CACHE_WORDS:
                known.clear()
            found = [words_of(text) if text else [] for text in texts]
            by_size: dict[int, list[tuple[bytes, str]]] = {}
            for word in set().union(*found).difference(known):
                content = (SPACE + word).encode()
                by_size.setdefault((len(content) // 32).bit_length(), []).append((content, word))
            for group in by_size.values():
                group.sort()
                counts = counter.count([content for content, _ in group])
                known.update(zip((word for _, word in group), counts.tolist()))
            n_tokens = [sum(map(known.__getitem__, words)) for words in found]
            return [pa.array(list(map(len, found)), pa.int64()), pa.array(n_tokens, pa.int64())]

        return count

    return make


def count_tokens(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, ``n_words`` and ``n_tokens`` of each whole text.

    ``path`` names a sentencepiece file that every executor can open. Words are what stands between white space, each
    with the space sign before it; texts are not normalised. Null and empty texts count 0. Repeated rows are
    counted each.
    """
    return map_texts(docs, keep, text, "n_words long, n_tokens long", _counts(path), ("unigram", path))
