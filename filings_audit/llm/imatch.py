"""I-Match fingerprints, with DataFrame functions only.

The lexicon holds the words whose document frequency lies within a band of shares of all documents. A fingerprint hashes
the sorted distinct lexicon words of a text, once whole and once for each of several random subsets of the
lexicon, so that a few changed words leave some of the hashes as they were.

The lower edge of the band bounds the lexicon: with w distinct words per document on average at most w / share words
can reach it, however many documents there are. So it is broadcast once its size is checked.

Documents are dealt into parts by ranges of their ids. All that follows, the neighbour's text, the words, and the
fingerprints, is computed within a part: texts are shuffled once.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filings_audit.session import materialize

# Broadcast only a lexicon of at most so many words; a longer one is joined by shuffle.
BROADCAST_WORDS = 1_000_000
# Stands in every text, so that texts without lexicon words keep a row.
MARK = " "
LOWEST = -(2**63)


@dataclass(frozen=True)
class Band:
    """Shares of documents between which a word belongs to the lexicon; the random subsets keep half of it each.

    A hash over fewer than ``fewest`` words would agree by chance: the hash of the whole text stands in its place.
    """

    lowest: float = 0.002
    highest: float = 0.2
    subsets: int = 7
    fewest: int = 3
    rows_per_part: int = 1000
    most_parts: int = 200_000


def words(text: Column) -> Column:
    """Distinct words of a text in lower case: runs of letters and digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")


def lexicon(docs: DataFrame, total: int, band: Band = Band(), text: str = "text") -> DataFrame:
    """``word``, ``code`` (its hash) and ``subsets`` (a bit for each random subset): the words within the band.

    Counted over all documents, ``total`` of them; repeated rows and rows without text are documents, too.
    """
    counts = docs.select(F.explode(words(docs[text])).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    kept = counts.where(F.col("n").between(total * band.lowest, total * band.highest))
    bits = [F.when(F.pmod(F.xxhash64("word", F.lit(k)), F.lit(2)) == 0, 1 << k).otherwise(0) for k in range(band.subsets)]
    return kept.select("word", F.xxhash64("word").alias("code"), sum(bits[1:], bits[0]).alias("subsets"))


def _hashes(codes: Column, whole: Column, band: Band) -> Column:
    """The hashes of a fingerprint from its sorted lexicon words, as an array of hex strings."""

    def one(chosen: Column) -> Column:
        return F.hex(F.when(F.size(chosen) < band.fewest, whole).otherwise(F.xxhash64(chosen)))

    def only(k: int) -> Column:
        member = F.filter(codes, lambda c: c["subsets"].bitwiseAND(F.lit(1 << k)) != 0)
        return F.transform(member, lambda c: c["code"])

    return F.array(one(F.transform(codes, lambda c: c["code"])), *[one(only(k)) for k in range(band.subsets)])


def likeness(left: Column, right: Column) -> Column:
    """The share of equal hashes of two fingerprints."""
    same = F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda equal: equal)
    return F.size(same) / F.size(left)


def _in_parts(docs: DataFrame, total: int, band: Band) -> DataFrame:
    """``part`` for each row of ``id`` and ``text``: ranges of ids of about equal numbers of rows.

    The row after a part's last one, that is the first row of the next part, is added to the part as a guest; after the
    lowest id of all comes the highest one.
    """
    wanted = min(band.most_parts, -(-total // band.rows_per_part))
    bounds: list[int] = []
    if wanted > 1:
        places = F.from_json(F.lit(json.dumps([i / wanted for i in range(1, wanted)])), "array<double>")
        bounds = sorted(set(docs.agg(F.percentile_approx("id", places, 4 * wanted)).first()[0] or []))
    # Two short lists are searched for a row, not one long list.
    step = max(1, round(len(bounds) ** 0.5))
    coarse, fine = bounds[step - 1 :: step], [bounds[i : i + step] for i in range(0, len(bounds) + 1, step)]
    lists = F.from_json(F.lit(json.dumps([coarse, *fine])), "array<array<bigint>>")

    def below(number: Column) -> Column:
        return F.size(F.filter(F.element_at(lists, number), lambda bound: bound <= F.col("id")))

    parted = docs.withColumn("block", below(F.lit(1))).withColumn("part", F.col("block") * step + below(F.col("block") + 2))
    # One row per part, so at most band.most_parts rows.
    tops = materialize(parted.groupBy("part").agg(F.max("id").alias("top")), "part-tops")
    over = Window.orderBy("part")
    every = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hosts = tops.select("top", F.lead("part").over(over).alias("host"), F.min("part").over(every).alias("lowest"))
    wraps = F.col("host").isNull()
    # Of repeated rows with the top id the first in order is the neighbour.
    guests = (
        parted.join(F.broadcast(hosts), parted["id"] == hosts["top"]).groupBy("host", "lowest", "id").agg(F.min("text").alias("text"))
        .select(
            F.coalesce("host", "lowest").alias("part"), F.when(wraps, F.lit(LOWEST)).otherwise(F.col("id")).alias("id"),
            "text", F.lit(True).alias("guest"),
        )
    )
    return parted.select("part", "id", "text", F.lit(False).alias("guest")).unionByName(guests)


def fingerprints(docs: DataFrame, band: Band = Band(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited text.

    Columns: doc_id, n_chars, edited (the edited text's bytes as SHA-256), hashes, edited_hashes, next_hashes. The edited
    text has its last floor(n_chars / 2) characters replaced by as many of the first of the next document, in
    descending order of ids; after the lowest id comes the highest. A null text is empty. A null id is
    below all others. Of rows with one id the order is that of their texts. A text without lexicon words has the
    hash of the whole text in every place; equal texts always have equal fingerprints.
    """
    session = docs.sparkSession
    session.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "200000")
    chosen = docs.select(
        F.coalesce(docs[doc_id].cast("long"), F.lit(LOWEST)).alias("id"), F.coalesce(docs[text], F.lit("")).alias("text")
    )
    total = chosen.count()
    kept = materialize(lexicon(chosen, total, band), "lexicon")
    mark = session.range(1).select(F.lit(MARK).alias("word"), F.lit(0).cast("long").alias("code"), F.lit(0).alias("subsets"))
    known = kept.unionByName(mark)
    if kept.count() <= BROADCAST_WORDS:
        known = F.broadcast(known)
    order = Window.partitionBy("part").orderBy(F.desc("id"), "guest", F.col("text"))
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    following = F.substr(F.coalesce(F.lead("text").over(order), F.lit("")), F.lit(1), half)
    rows = _in_parts(chosen, total, band).select(
        "part", F.row_number().over(order).alias("place"), "id", "guest", "text",
        F.concat(F.substr("text", F.lit(1), n - half), following).alias("edited"),
    )
    facts = F.struct(
        "id", "guest", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited"),
        F.xxhash64("text").alias("whole"), F.xxhash64("edited").alias("whole_edited"),
    )

    def entries(column: str, edited: bool) -> Column:
        empty = F.lit(None).cast("struct<id:bigint,guest:boolean,n_chars:bigint,edited:string,whole:bigint,whole_edited:bigint>")
        return F.transform(words(F.col(column)), lambda w: F.struct(w.alias("word"), F.lit(edited).alias("of"), empty.alias("facts")))

    marked = F.array(F.struct(F.lit(MARK).alias("word"), F.lit(False).alias("of"), facts.alias("facts")))
    entry = F.explode(F.concat(marked, entries("text", False), entries("edited", True))).alias("entry")
    exploded = rows.select("part", "place", entry).select("part", "place", "entry.*")
    found = exploded.join(known, "word")
    code = F.struct("code", "subsets")
    grouped = found.groupBy("part", "place").agg(
        F.max("facts").alias("facts"),
        F.sort_array(F.collect_list(F.when((F.col("word") != MARK) & ~F.col("of"), code))).alias("codes"),
        F.sort_array(F.collect_list(F.when(F.col("of"), code))).alias("edited_codes"),
    )
    hashed = grouped.select(
        "part", "place", "facts.*",
        _hashes(F.col("codes"), F.col("facts.whole"), band).alias("hashes"),
        _hashes(F.col("edited_codes"), F.col("facts.whole_edited"), band).alias("edited_hashes"),
    )
    follow = F.lead("hashes").over(Window.partitionBy("part").orderBy("place"))
    return hashed.withColumn("next_hashes", follow).where("NOT guest").select(
        F.when(F.col("id") != LOWEST, F.col("id")).alias("doc_id"), "n_chars", "edited", "hashes", "edited_hashes", "next_hashes"
    )
