"""BPE encoding and decoding with prefix sharing.

The encoding of a text's prefix is decided by its last token: the one token that ends there and forms a valid
pair with the last token of the prefix before it. New words of a batch go into a trie, and one depth-first walk
carries these last tokens downwards, so a prefix shared by many words is encoded once. Words are kept in a
cache of bounded size. There is no shuffle, and memory is bounded by a batch and the cache.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from filings_audit.llm.common import WHITE_SPACE, map_texts, once
from filings_audit.llm.trie import Suffixes, levels

# Words kept per task. A full cache is emptied; results don't depend on it.
CACHE_WORDS = 200_000
DEEP = 32

# Fixed value: how the byte-level vocabulary splits text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others take the letters from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level vocabulary: encodes sets of words through a trie."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        to_byte = {letter: b for b, letter in byte_letters().items()}
        as_bytes = {token: bytes(map(to_byte.__getitem__, token)) for token in content["model"]["vocab"]}
        self.token = {i: as_bytes[token] for token, i in content["model"]["vocab"].items()}
        self.id = {content: i for i, content in self.token.items()}
        size = max(self.token) + 1
        # For each token the merge that makes it (-1 for a byte) and its two parts.
        self.made, self.parts = np.full(size, -1), np.zeros((2, size), np.int64)
        pairs = np.empty(len(content["model"]["merges"]), np.int64)
        self.rank = {}
        for rank, pair in enumerate(content["model"]["merges"]):
            left, right = (self.id[as_bytes[x]] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            new = self.id[self.token[left] + self.token[right]]
            self.rank[left, right] = rank, new
            pairs[rank] = left << 32 | right
            if self.made[new] < 0:
                self.made[new], self.parts[:, new] = rank, (left, right)
        self.pair_rank = np.argsort(pairs)
        self.pair_key = pairs[self.pair_rank]
        self.alone = np.full(size, -1, np.int8)
        self.suffixes = Suffixes(list(self.id))
        self.entry = np.array([*self.id.values(), -1], np.int64)[self.suffixes.entry]  # of states: the token that ends
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.token |= {i: text.encode() for text, i in self.special.items()}
        self.split = regex.compile(SPLIT).findall
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def merged(self, content: bytes) -> list[int]:
        """The plain rule on a short string: merge the pair of lowest rank, leftmost first, until none is left."""
        ids = [self.id[content[i : i + 1]] for i in range(len(content))]
        while len(ids) > 1:
            found = [(self.rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank]
            if not found:
                break
            (_, new), at = min(found)
            ids[at : at + 2] = [new]
        return ids

    def starts(self, tokens: np.ndarray) -> np.ndarray:
        """Whether each token encodes to itself, so that a word may begin with it."""
        for token in set(tokens[self.alone[tokens] < 0].tolist()):
            self.alone[token] = self.merged(self.token[token]) == [token]
        return self.alone[tokens] == 1

    def follows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each two tokens, side by side, are an encoding.

        Takes their merges back, latest first. At no time may the two groups of letters at the border have a merge
        that comes earlier than the one just taken back; on the left side a merge of equal rank comes first.
        """
        ok, at = np.ones(len(left), bool), np.arange(len(left))
        limit = np.full(len(left), np.iinfo(np.int64).max)
        while len(at):
            key = left << 32 | right
            found = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            bad = (self.pair_key[found] == key) & (self.pair_rank[found] < limit)
            ok[at[bad]] = False
            on_left, on_right = self.made[left], self.made[right]
            take_left = on_left > on_right
            limit = np.where(take_left, on_left, on_right + 1)
            go = ~bad & ((on_left >= 0) | (on_right >= 0))
            left, right = np.where(take_left, self.parts[1][left], left), np.where(take_left, right, self.parts[0][right])
            at, left, right, limit = at[go], left[go], right[go], limit[go]
        return ok

    def encode_words(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Encode every word, walking the trie of all of them once, all its branches side by side.

        At each depth the last token of every node is found once and handed to the words below it. Long words get
        tries of their own, by length, so that one long word doesn't widen the tables of all.
        """
        out: dict[bytes, bytes] = {b"": b""}
        by_size: dict[int, list[bytes]] = {}
        for word in words:
            by_size.setdefault(max(0, (len(word) - 1) // DEEP).bit_length(), []).append(word)
        for group in by_size.values():
            out.update(zip(group := sorted(group), self._encode_sorted(group)))
        return out

    def _encode_sorted(self, words: list[bytes]) -> list[bytes]:
        table = self.suffixes
        lengths = np.array(list(map(len, words)))
        width, n = int(lengths.max(initial=0)), len(words)
        token, size = np.full((width + 1, n), -1, np.int32), np.zeros((width + 1, n), np.int32)
        for depth, active, first, below, state in levels(words, lengths, table):
            chosen, left, place = np.zeros(len(first), np.int64), np.arange(len(first)), table.ends[state]
            while len(left):
                candidate, length = self.entry[place], table.depth[place]
                word = first[left]
                before = token[depth - length, word].astype(np.int64)
                fits, starting = np.zeros(len(left), bool), length == depth
                fits[starting] = self.starts(candidate[starting])
                fits[~starting] = self.follows(before[~starting], candidate[~starting])
                chosen[left[fits]] = place[fits]
                left, place = left[~fits], table.ends[table.fail[place[~fits]]]
            token[depth, active], size[depth, active] = self.entry[chosen][below], table.depth[chosen][below]
        # Read the tokens off backwards.
        at, row, found = lengths.copy(), np.arange(n), []
        while len(row):
            found.append((row, token[at, row]))
            at = at - size[at, row]
            row, at = row[at > 0], at[at > 0]
        rows, ids = (np.concatenate([f[i] for f in found][::-1]) for i in (0, 1))
        order = np.argsort(rows, kind="stable")
        packed, ends = ids[order].astype("<u4").tobytes(), np.cumsum(np.bincount(rows, minlength=n)) * 4
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def pieces(self, chunk: str) -> list[bytes | int]:
        """Words of a chunk as bytes; a special token as its id."""
        if chunk[0] == " ":  # the usual cases: a space and letters, with or without a mark after them
            if chunk[1:].isalpha():
                return [chunk.encode()]
            if chunk[-1] in ".,!" and chunk[1:-1].isalpha():
                return [chunk[:-1].encode(), chunk[-1].encode()]
        parts = self.special_split.split(chunk) if self.special_split and "<" in chunk else [chunk]
        if len(parts) == 1:
            return [word.encode() for word in self.split(chunk)]
        out: list[bytes | int] = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            else:
                out.extend(word.encode() for word in self.split(part))
        return out


def _encoder(path: str) -> Callable[[], Callable[[list], list]]:
    def make():
        bpe = once(("bpe", path), lambda: ByteBpe(path))
        # White space and the word after it never share a token with what stands before, so chunks are independent.
        chunks = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+").findall
        cache: dict[str, bytes] = {}
        words: dict[bytes, bytes] = {}

        def encode(texts: list) -> list:
            if len(cache) > CACHE_WORDS:
                cache.clear()
                words.clear()
            found = [chunks(text) if text else [] for text in texts]
            new = {chunk: bpe.pieces(chunk) for chunk in set().union(*found).difference(cache)}
            ids = bpe.encode_words({p for pieces in new.values() for p in pieces if isinstance(p, bytes)}.difference(words))
            words.update(ids)
            for chunk, pieces in new.items():
                if len(pieces) == 1 and isinstance(pieces[0], bytes):
                    cache[chunk] = words[pieces[0]]
                    continue
                cache[chunk] = b"".join([words[p] if isinstance(p, bytes) else p.to_bytes(4, "little") for p in pieces])
            return [[b"".join(map(cache.__getitem__, text)) for text in found]]

        return encode

    return make


def _decoder(path: str) -> Callable[[], Callable[[list], list]]:
    def make():
        token = once(("bpe", path), lambda: ByteBpe(path)).token

        def decode(packed: list) -> list:
            parts = [map(token.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()) for ids in packed]
            return [[b"".join(part).decode("utf-8", errors="replace") for part in parts]]

        return decode

    return make


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``ids``: the ids of each whole text as little-endian unsigned 32-bit integers.

    ``path`` names a byte-level BPE file that every executor can open. Special tokens inside a text become their
    ids. A null or empty text has no ids. Repeated rows are encoded each; other columns are not touched.
    """
    return map_texts(docs, keep, text, "ids binary", _encoder(path), ("bpe", path))


def decode(encoded: DataFrame, path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """``keep`` and ``text``: the text of packed ids; null ids give an empty text, broken UTF-8 the replacement sign."""
    return map_texts(encoded, keep, ids, "text string", _decoder(path), ("bpe", path))
