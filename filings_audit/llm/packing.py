"""Bulk-synchronous best-fit packing of token pieces into sequences.

Supersteps: pieces and gaps stand sorted by size. All pieces of the longest waiting length look for their successor,
the smallest gap that holds them. Where several want the same gaps, rank decides: the first of the pieces take one
gap each. Gaps shrink by what they took, and the next superstep begins. Pieces longer than every gap open sequences.

Equal sizes are interchangeable, so a superstep moves runs (a size and a range of ranks), not rows. There are at most
``capacity`` sizes, whatever the number of rows: Spark counts the sizes, the sweeps run over these counts, and
the rows are ranked within their length and looked up in the runs in one pass. A length that a third of all
rows share is ranked in parts, so it costs no task more than its share.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filings_audit.llm.common import WHITE_SPACE, lean, once
from filings_audit.session import materialize

# Words kept per Python worker, from task to task. A full cache is emptied; results don't depend on it.
CACHE_WORDS = 500_000
TEXTS = 100  # cut at a time


# Letters and digits among the lower-case Latin-1 characters, as regex class bodies.
LATIN_LETTERS, LATIN_DIGITS = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
LETTERS_AND_SPACE = bytes(c for c in range(256) if re.match(f"[{LATIN_LETTERS}{WHITE_SPACE}]", chr(c)))
MARKS = bytes(not re.match(f"[{LATIN_LETTERS}{LATIN_DIGITS}{WHITE_SPACE}]", chr(c)) for c in range(256))
# Marks that no replacement sets apart: ``str.split`` takes them for white space, an apostrophe may begin an ending.
SPECIAL = set(b"\x1c\x1d\x1e\x1f'")


class Words:
    """Ids of words, packed.

    The tokenizer lower-cases a text and cuts it into letters, single digits, marks and endings after an apostrophe, all
    of which it encodes one by one. Where every character is Latin-1 the same cut is made here, so few different words
    are left; other texts, and texts with special tokens, are cut at white space only. Letters end in one token with
    the end sign, so many of them are encoded in one call and told apart by it. Lower-case Latin-1 letters need no
    normalizing, so ``plain``, a tokenizer with the same model that only cuts at spaces, gives their ids in less time.
    """

    def __init__(self, tokenizer, plain=None):
        self.tokenizer, self.plain = tokenizer, plain or tokenizer
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}
        latin = f"[{LATIN_LETTERS}]+|[{LATIN_DIGITS}]|[^{LATIN_LETTERS}{LATIN_DIGITS}{WHITE_SPACE}]+"
        self.latin = re.compile(latin).findall
        self.latin_endings = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|{latin}").findall
        self.lowered = re.compile(f"[{LATIN_LETTERS}]+").fullmatch
        self.any = re.compile(f"[^{WHITE_SPACE}]+").findall

    def of(self, text: str | None) -> list[str]:
        if not text:
            return []
        lowered = text.lower()
        try:
            packed = lowered.encode("latin-1")
        except UnicodeEncodeError:
            return self.any(text)
        if "<|" in lowered:
            return self.any(text)
        single = set(packed.translate(None, LETTERS_AND_SPACE))
        if single.isdisjoint(SPECIAL) and b"\1\1" not in packed.translate(MARKS):
            # Digits and marks stand alone: the same cut, without a search.
            for c in map(chr, single):
                lowered = lowered.replace(c, f" {c} ")
            return lowered.split()
        return self.latin_endings(lowered) if "'" in lowered else self.latin(lowered)

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Encode the words not known yet; returns all known ones."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = words.difference(self.known)
        letters = {word for word in new if word.isalpha()}
        lowered = set(filter(self.lowered, letters))
        self._letters(lowered, self.plain)
        self._letters(letters.difference(lowered), self.tokenizer)
        self.known.update(self._each(list(new.difference(letters))))
        return self.known

    def _each(self, words: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return {word: np.array(one.ids, "<u4").tobytes() for word, one in zip(words, found)}

    def _letters(self, words: set[str], tokenizer) -> None:
        ordered = sorted(words)
        for at in range(0, len(ordered), 1000):
            some = ordered[at : at + 1000]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) != len(some):  # not what plain letters should give
                self.known.update(self._each(some))
                continue
            packed = ids.tobytes()
            self.known.update(zip(some, (packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()))))


def load_words(path: str) -> Words:
    """The words of a tokenizers file."""
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    plain = Tokenizer(tokenizer.model)  # both share one model in memory
    plain.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return Words(tokenizer, plain)


def cut(docs: DataFrame, path: str, capacity: int, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids``: the ids of each whole text, in pieces of ``capacity`` ids.

    ``path`` names a tokenizers file whose words end at white space. Each text's ids are followed by ``end_id``; a null
    or empty text is ``end_id`` alone. ``ids`` holds little-endian unsigned 32-bit integers. Repeated rows are cut
    each. A word is encoded once per Python worker as long as its cache holds it.
    """
    kept = ("packing words", path)
    chosen = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = once(kept, lambda: load_words(path))
        end, step = end_id.to_bytes(4, "little"), 4 * capacity
        # The words of all texts of a batch would take several times its size, so few texts are cut at a time.
        for batch in (batch.slice(at, TEXTS) for batch in batches for at in range(0, batch.num_rows, TEXTS)):
            texts = [words.of(text) for text in batch.column(1).to_pylist()]
            known = words.learn(set().union(*texts))
            rows: list[tuple] = []
            for name, found in zip(batch.column(0).to_pylist(), texts):
                ids = b"".join(map(known.__getitem__, found)) + end
                rows.extend(
                    (name, i, i * capacity, len(piece) // 4, piece)
                    for i, piece in enumerate(ids[at : at + step] for at in range(0, len(ids), step))
                )
                if len(rows) >= 1000:
                    yield _pieces(rows, batch.schema.field(0).type)
                    rows = []
            if rows:
                yield _pieces(rows, batch.schema.field(0).type)

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(lean(run, kept), f"doc_id {kind}, piece int, start long, length long, ids binary")


def _pieces(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = {"doc_id": kind, "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary()}
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """The supersteps over counts of lengths. Rows: length, first rank, number, first sequence, place in the sequence."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences that have it
    sizes: list[int] = []  # the gaps, sorted
    opened, moves = 0, []

    def leave(gap: int, first: int, n: int) -> None:
        if gap and gap not in gaps:
            insort(sizes, gap)
        if gap:
            gaps.setdefault(gap, []).append((first, n))

    for length in sorted(counts, reverse=True):
        waiting, rank = counts[length], 0
        while waiting:
            successor = bisect_left(sizes, length)
            if successor == len(sizes):
                more = -(-waiting // (capacity // length))
                leave(capacity, opened, more)
                opened += more
                continue
            # One superstep: the gaps of the successor's size take a piece each, in the order of their ranks.
            gap = sizes.pop(successor)
            for first, n in gaps.pop(gap):
                took = min(n, waiting)
                if took:
                    moves.append((length, rank, took, first, capacity - gap))
                    leave(gap - length, first, took)
                    rank, waiting = rank + took, waiting - took
                if took < n:
                    leave(gap, first + took, n - took)
    return np.array(sorted(moves), np.int64).reshape(-1, 5)


# What ``pack`` adds to its rows, at the end or on the way.
MADE = ("sequence_id", "offset", "__length", "__part", "__local", "__n", "__base", "__rank")


def pack(pieces: DataFrame, capacity: int, keep: list[str], length: str = "length") -> DataFrame:
    """``keep``, ``length``, ``sequence_id`` and ``offset``: a place for every row in sequences of ``capacity``.

    ``length`` must lie between 1 and ``capacity``. Equal rows get a place each; an empty table stays empty. The
    rows are written to the shared folder, as given and ranked, so later steps see the same order. The driver receives
    one count per length. No column of ``keep`` may be named like a made one, whatever its case.
    """
    clashing = {c.lower() for c in keep if c != length} & {length.lower(), *MADE}
    if clashing:
        raise ValueError(f"columns to keep are named like results: {sorted(clashing)}")
    chosen = pieces.select(*[pieces[c] for c in keep if c != length], pieces[length].cast("long").alias("__length"))
    names = [c for c in keep if c != length]
    kept = "".join(f"`{c}` {chosen.schema[c].dataType.simpleString()}, " for c in names)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rank the rows of each length within this task."""
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = batch.column(len(names)).to_numpy(zero_copy_only=False)
            if len(sizes) and not (sizes.min() >= 1 and sizes.max() <= capacity):
                raise ValueError(f"lengths must lie between 1 and {capacity}")
            order = np.argsort(sizes, kind="stable")
            ranked = sizes[order]
            first = np.searchsorted(ranked, ranked)
            local = np.empty(len(sizes), np.int64)
            local[order] = np.arange(len(sizes)) - first + seen[ranked]
            seen += np.bincount(sizes, minlength=capacity + 1)
            extra = [pa.array(np.full(len(sizes), part, np.int64)), pa.array(local)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "__part", "__local"])

    # Written first: in the tasks that make the rows, a second Python worker would stand beside the one of ``cut``.
    chosen = materialize(chosen, "lengths")
    numbered = materialize(chosen.mapInArrow(number, f"{kept}__length long, __part long, __local long"), "pieces")
    in_part = numbered.groupBy("__part", "__length").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = in_part.select("__part", "__length", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    counted = numbered.groupBy("__length").agg(F.count("*").alias("n")).collect()
    moves = plan({row["__length"]: row["n"] for row in counted}, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(moves)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = shared.value
        keys = moves[:, 0] << 44 | moves[:, 1]
        for batch in batches:
            *others, sizes, ranks = (batch.column(i) for i in range(len(names) + 2))
            sizes, ranks = sizes.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
            run = np.searchsorted(keys, sizes << 44 | ranks, side="right") - 1
            sequence = moves[run, 3] + ranks - moves[run, 1]
            made = [pa.array(x) for x in (sizes, sequence, moves[run, 4])]
            yield pa.RecordBatch.from_arrays([*others, *made], names=[*names, length, "sequence_id", "offset"])

    ranked = numbered.join(base, ["__part", "__length"]).select(
        *names, "__length", (F.col("__base") + F.col("__local")).alias("__rank")
    )
    return ranked.mapInArrow(place, f"{kept}`{length}` long, sequence_id long, offset long")
