"""Language identification: words first, then ever shorter character n-grams for words not seen before.

A word that the model knows adds, for each language, the logarithm of its relative frequency there. For another
word the n-grams of its letters are tried from the longest order down; the first order of which the model knows
any adds the mean over those it knows. The model holds a bounded number of words and n-grams per language.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filings_audit.llm.common import held_out, map_texts, pieces
from filings_audit.session import materialize

UNDETERMINED = "und"
ORDERS = (5, 4, 3, 2, 1)
# Words kept per task, and numbers in their rows. A full cache is emptied; results don't depend on it.
CACHE_WORDS, CACHE_NUMBERS = 300_000, 6_000_000
SLICE = 8192


@dataclass(frozen=True)
class Limits:
    """What bounds the model. ``documents``: about so many labelled rows are learnt from, chosen by hash in each language.

    A language has at most ``words`` words and ``grams`` n-grams of each order, and fewer where all languages together would
    exceed ``entries``, of which three eighths may be words.
    """

    documents: int = 20_000
    words: int = 30_000
    grams: int = 10_000
    entries: int = 1_000_000

    def of_each(self, languages: int) -> tuple[int, int]:
        """The words of a language, and its n-grams of one order."""
        share = self.entries // max(1, languages)
        return max(1, min(self.words, share * 3 // 8)), max(1, min(self.grams, share // 8))


class Table(NamedTuple):
    """Log frequencies of entries: what a language scores that lacks the entry, and the others of each entry in a row."""

    lacking: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    values: np.ndarray


class Model(NamedTuple):
    """Sorted languages; words and n-grams by their numbers in a table each."""

    languages: list[str]
    words: dict[str, int]
    word_table: Table
    grams: dict[str, int]
    gram_table: Table


def _log_frequencies(counts: pa.Table, totals: dict[str, int], languages: list[str]) -> tuple[dict[str, int], Table]:
    """Entries by number, and their table; a language that lacks the entry counts half an occurrence."""
    totalled = np.log([totals[language] + 1.0 for language in languages])
    order = {language: i for i, language in enumerate(languages)}
    place = np.array([order[language] for language in counts["lang"].to_pylist()], np.int32)
    entries = counts["word"].to_pylist()
    index = {entry: i for i, entry in enumerate(sorted(set(entries)))}
    number = np.array([index[entry] for entry in entries], np.int64)
    sort = np.lexsort((place, number))
    starts = np.searchsorted(number[sort], np.arange(len(index) + 1))
    values = np.log(counts["n"].to_numpy()[sort].astype(float)) - totalled[place[sort]] if len(sort) else np.zeros(0)
    return index, Table(np.log(0.5) - totalled, starts, place[sort], values)


def _quota(sizes: list[tuple[int, int]], most: int) -> float | None:
    """The rows that each language may give, so that all give ``most`` and small ones all they have; none: no bound is
    needed. ``sizes``: a number of rows, and how many languages have it."""
    languages = sum(k for _, k in sizes)
    for rows, k in sorted(sizes):
        if rows * languages > most:
            return most / languages
        most, languages = most - rows * k, languages - k
    return None


def _sample(usable: DataFrame, most: int) -> DataFrame:
    """All rows if there are at most ``most``, else about so many: those of small languages, and of others equally many."""
    sizes = materialize(usable.groupBy("lang").agg(F.count("*").alias("rows")), "language-sizes")
    quota = _quota([tuple(r) for r in sizes.groupBy("rows").count().collect()], most)
    if quota is None:
        return usable
    place = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000))
    return usable.join(sizes, "lang").where(place * F.col("rows") < 1_000_000 * quota)


def train(docs: DataFrame, limits: Limits = Limits(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from the rows that are not held out and have text and language. No such row: a model without languages."""
    usable = docs.select(docs[doc_id].alias("id"), docs[text].alias("text"), docs[lang].alias("lang")).where(
        ~held_out(F.col("id")) & F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    chosen = _sample(usable, limits.documents)
    # Runs of letters, as letters_of cuts them below.
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("word")
    counted = materialize(chosen.select("lang", word).groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    letters = F.sum(F.col("n") * (F.length("word") + 2)).alias("letters")
    sums = counted.groupBy("lang").agg(F.sum("n").alias("n"), letters).collect()
    padded = F.concat(F.lit("_"), "word", F.lit("_"))
    grams = None
    for order in ORDERS:
        some = counted.where(F.length(padded) >= order).select(
            "lang", F.lit(order).alias("size"), F.explode(_cut(padded, order)).alias("word"), "n"
        )
        grams = some if grams is None else grams.unionByName(some)
    grams = grams.groupBy("lang", "size", "word").agg(F.sum("n").alias("n"))
    languages = sorted(r["lang"] for r in sums)
    of_words, of_letters = ({r["lang"]: r[name] for r in sums} for name in ("n", "letters"))
    most_words, most_grams = limits.of_each(len(languages))
    words, word_table = _log_frequencies(_most_frequent(counted.where("n > 1"), ["lang"], most_words), of_words, languages)
    found = _most_frequent(grams, ["lang", "size"], most_grams)
    return Model(languages, words, word_table, *_log_frequencies(found, of_letters, languages))


def _cut(text: Column, order: int) -> Column:
    """All n-grams of a text."""
    return F.transform(F.sequence(F.lit(1), F.length(text) - order + 1), lambda at: F.substr(text, at, F.lit(order)))


def _most_frequent(counts: DataFrame, group: list[str], most: int) -> pa.Table:
    """The ``most`` most frequent entries of each group, ties by the entry. The limits bound them in all."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("n"), "word"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "word", "n").toArrow()


_words = re.compile(r"[^\W\d_]+").findall


def letters_of(word: str) -> list[str]:
    """The runs of letters, the characters of Unicode's categories L, in what the pattern takes for a word: it also takes
    numerals such as halves and Roman ones."""
    return "".join(c if c.isalpha() else " " for c in word).split()


def _row(table: Table | tuple, entry: int) -> np.ndarray:
    lacking, starts, places, values = table
    out = lacking.copy()
    some = slice(starts[entry], starts[entry + 1])
    out[places[some]] = values[some]
    return out


def _rows(table: Table | tuple):
    """A function from numbers of entries to their rows; a table that is small when written out is written out."""
    lacking, starts, places, values = table
    n = len(starts) - 1
    if n * len(lacking) > CACHE_NUMBERS:
        return lambda entries: np.stack([_row(table, entry) for entry in entries])
    whole = np.tile(lacking, (n, 1))
    whole[np.repeat(np.arange(n), np.diff(starts)), places] = values
    return lambda entries: whole[entries]


def word_scores(model: Model | tuple, word: str, read: tuple | None = None) -> np.ndarray:
    """Log frequency of a word in each language, by the backoff. ``read``: ``_rows`` of both tables, if at hand."""
    languages, words, word_table, grams, gram_table = model
    read_words, read_grams = read or (_rows(word_table), _rows(gram_table))
    known = words.get(word)
    if known is not None:
        return read_words([known])[0]
    padded = f"_{word}_"
    for order in ORDERS:
        cut = [padded[i : i + order] for i in range(len(padded) - order + 1)] if order > 1 else word  # "_" tells nothing
        entries = [grams[g] for g in cut if g in grams]
        if entries:
            return read_grams(entries).mean(axis=0)
    return np.zeros(len(languages))


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text", evidence: int = 20) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` of each whole text.

    The score is the share of the best language when the mean word counts as ``evidence`` words, or as the text's own
    number if that is smaller. Ties go to the first language in order. ``und`` with score 0 for null
    texts, texts without a letter, and a model without languages.
    """
    # Plain tuples: an executor need not know the classes of the model.
    plain = model._replace(word_table=tuple(model.word_table), gram_table=tuple(model.gram_table))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(plain))

    def make():
        model = shared.value
        languages, read = model[0], (_rows(model[2]), _rows(model[4]))
        most = max(2048, min(CACHE_WORDS, CACHE_NUMBERS // max(1, len(languages))))
        scores = np.empty((most + SLICE, max(1, len(languages))))
        place: dict[str, int] = {}

        def total(words: list[str]) -> tuple[int, np.ndarray]:
            """How many words there are, and the sum of their scores, some at a time."""
            n, out = 0, np.zeros(len(languages))
            for at in range(0, len(words), SLICE):
                some = words[at : at + SLICE]
                if len(place) > most:
                    place.clear()
                new = set(some).difference(place)
                cut = {word: letters_of(word) for word in new if not word.isalpha()}
                if cut:  # such words have no scores themselves, so they are always new
                    some = [part for word in some for part in cut.get(word, (word,))]
                    new = set(some).difference(place)
                for word in new:
                    scores[len(place)] = word_scores(model, word, read)
                    place[word] = len(place)
                rows = np.fromiter(map(place.__getitem__, some), np.intp, len(some))
                n, out = n + len(some), out + scores.take(rows, axis=0).sum(axis=0)
            return n, out

        def classify(texts: list) -> list:
            names, shares = [], []
            for text in texts:
                n, sums = 0, 0.0
                for piece in pieces(text or "") if languages else ():
                    more, part = total(_words(piece.lower()))
                    n, sums = n + more, sums + part
                if not n:
                    names.append(UNDETERMINED)
                    shares.append(0.0)
                    continue
                mean = sums / n
                weight = np.exp((mean - mean.max()) * min(n, evidence))
                best = int(np.argmax(weight))
                names.append(languages[best])
                shares.append(float(weight[best] / weight.sum()))
            return [pa.array(names, pa.string()), pa.array(shares, pa.float64())]

        return classify

    return map_texts(docs, keep, text, "lang_pred string, score double", make)


def identify(
    docs: DataFrame, keep: list[str], limits: Limits = Limits(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Train on ``docs`` and predict every row of it. See ``train`` and ``predict``."""
    return predict(docs, train(docs, limits, doc_id, text, lang), keep, text)

