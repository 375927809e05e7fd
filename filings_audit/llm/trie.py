"""A trie of words walked level by level, next to the automaton of a vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Suffixes:
    """After each letter, the vocabulary's entries that end there, longest first.

    ``step`` moves on by a letter; ``ends[state]`` is the nearest state along the suffixes where an entry ends (0:
    none), ``entry`` its number, ``depth`` its length, and ``ends[fail[...]]`` the next shorter one.
    """

    def __init__(self, entries: list[bytes]):
        child: dict[int, int] = {}
        depth, entry = [0], [-1]
        for number, content in enumerate(entries):
            state = 0
            for letter in content:
                key = state << 8 | letter
                following = child.get(key)
                if following is None:
                    following = child[key] = len(depth)
                    depth.append(depth[state] + 1)
                    entry.append(-1)
                state = following
            entry[state] = number
        self.depth, self.entry = np.array(depth), np.array(entry)
        keys = np.fromiter(child, np.int64, len(child))
        order = np.argsort(keys)
        self.child_key, self.child = keys[order], np.fromiter(child.values(), np.int64, len(child))[order]
        self.fail = np.zeros(len(depth), np.int64)
        parent, letter = np.zeros(len(depth), np.int64), np.zeros(len(depth), np.int64)
        parent[self.child], letter[self.child] = self.child_key >> 8, self.child_key & 255
        self.ends = np.where(self.entry >= 0, np.arange(len(depth)), 0)
        for level in range(1, int(self.depth.max()) + 1):
            here = np.flatnonzero(self.depth == level)
            if level > 1:
                self.fail[here] = self.step(self.fail[parent[here]], letter[here])
            none = here[self.entry[here] < 0]
            self.ends[none] = self.ends[self.fail[none]]

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        out, left = np.zeros_like(state), np.arange(len(state))
        while len(left):
            key = state << 8 | letter
            at = np.minimum(np.searchsorted(self.child_key, key), len(self.child_key) - 1)
            hit = self.child_key[at] == key
            out[left[hit]] = self.child[at[hit]]
            again = ~hit & (state > 0)
            left, state, letter = left[again], self.fail[state[again]], letter[again]
        return out


def levels(words: list[bytes], lengths: np.ndarray, table: Suffixes) -> Iterator[tuple]:
    """The nodes of the trie of sorted ``words``, depth by depth.

    In sorted order the words below a node are neighbours, so a node is a run of words. Yields the depth, the words that
    reach it, the first word of each node, each word's node, and each node's state in the automaton.
    """
    width, n = int(lengths.max(initial=0)), len(words)
    letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
    state, node = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for depth in range(1, width + 1):
        active = np.flatnonzero(lengths >= depth)
        above, letter = node[active], letters[active, depth - 1].astype(np.int64)
        new = np.ones(len(active), bool)
        new[1:] = (above[1:] != above[:-1]) | (letter[1:] != letter[:-1])
        first, below = active[new], np.cumsum(new) - 1
        now = table.step(state[first], letter[new])
        yield depth, active, first, below, now
        state[active], node[active] = now[below], below
