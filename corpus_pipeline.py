"""Documents to training sequences: filter, clean, deduplicate and pack a corpus in five stages.

Every stage works on all rows that the one before has kept, and its result is written as Parquet before the next one
reads it. All stages but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filings_audit.llm import langid, linededup, neardup, packing, quality
from filings_audit.llm.common import table, use_small_batches
from filings_audit.llm.queries import LINE_PAGES, LINE_SHARE
from filings_audit.session import materialize

LOWEST_QUALITY = 0.3
LOWEST_LANGUAGE_SHARE = 0.4
CAPACITY = 4096
END_OF_TEXT = 1


def _filtered(docs: DataFrame, score, keep) -> DataFrame:
    """Rows that pass ``keep`` after ``score`` has added its columns; the given columns go by numbers meanwhile, so
    their names can't clash."""
    use_small_batches(docs.sparkSession)
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scored = score(numbered, numbered.columns, f"c{docs.columns.index('text')}")
    return scored.where(keep).select(numbered.columns).toDF(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at least 0.3. Without labels of both kinds all stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _filtered(docs, lambda d, names, text: quality.score(d, model, names, text), F.col("score") >= LOWEST_QUALITY)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with a share of at least 0.4. Without a model all stay."""
    model = langid.train(docs)
    if not model.languages:
        return docs
    known = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LOWEST_LANGUAGE_SHARE)
    return _filtered(docs, lambda d, names, text: langid.predict(d, model, names, text), known)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate on their host; n_chars follows the text. Of a text with many
    copies one stays whole."""
    cleaned = linededup.drop_boilerplate_keeping_texts(docs, LINE_SHARE, LINE_PAGES)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; of several rows of the group with that id one.
    Texts without words and rows without id stay."""
    use_small_batches(spark)
    found = materialize(neardup.labelled(docs, neardup.Settings(), "doc_id", "text"), "near-duplicates")
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("__id")).distinct()
    again = found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).count().where("count > 1")
    again = materialize(again.select("__id"), "repeated-ids")
    if again.isEmpty():  # no id stands in two rows: spares reading and joining the texts twice
        return docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")
    either = gone.unionByName(again)
    once = docs.join(either, docs["doc_id"] == either["__id"], "left_anti")
    # Rows that share an id are told apart by their texts.
    several = docs.join(again, docs["doc_id"] == again["__id"], "left_semi")
    numbered = several.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    several = materialize(neardup.with_digest(numbered, f"c{docs.columns.index('text')}"), "rows-of-repeated-ids")
    own = F.col(f"c{docs.columns.index('doc_id')}")
    stay = found.where("doc_id = component_id AND digest IS NOT NULL").groupBy(F.col("doc_id").alias("__id"), "root")
    stay = stay.agg(F.min("digest").alias("__digest"))
    kept = several.join(stay, (own == F.col("__id")) & (F.col("digest") == F.col("__digest")), "left_semi")
    kept = kept.dropDuplicates([f"c{docs.columns.index('doc_id')}", "digest"]).unionByName(several.where("digest IS NULL"))
    return once.unionByName(kept.select(numbered.columns).toDF(*docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids in pieces of at most 4096, each with a place in a sequence."""
    use_small_batches(spark)
    pieces = packing.cut(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY, END_OF_TEXT)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests, CAPACITY, ["doc_id", "piece", "start", "length", "ids_crc32"])


STAGES = [
    ("quality", drop_low_quality),
    ("language", drop_unknown_language),
    ("lines", drop_boilerplate_lines),
    ("near duplicates", keep_one_of_each_group),
    ("packing", pack_sequences),
]
# A fitted network can't be written in SQL; the tests check every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
