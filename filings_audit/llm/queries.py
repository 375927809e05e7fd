"""The registered queries of the subpackage: thin views over its operators, as their contracts say."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filings_audit.llm import ann, bpe, imatch, langid, linededup, neardup, packing, quality, repair, resample, tokencount, topk, warc
from filings_audit.llm.common import held_out, table
from filings_audit.session import new_dir

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = (function, sql)
        return function

    return register


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, ["doc_id"])
    digests = encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids"
    )
    decoded = bpe.decode(digests, path, ["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


@query("op1_minhash")
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Settings(words=3, percent=85))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


# On more than a tenth of a host's distinct pages; a line of a single page is no repeat.
LINE_SHARE, LINE_PAGES = 0.1, 2


@query(
    "op2_line_dedup",
    "SELECT doc_id, text, length(text) AS n_chars FROM ("
    + linededup.SQL.format(docs="documents", share=LINE_SHARE, pages=LINE_PAGES) + ")",
)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.drop_boilerplate(table(spark, sf_dir, "documents"), LINE_SHARE, LINE_PAGES)
    return cleaned.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"))


@query("op3_imatch")
def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = imatch.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.col("edited").alias("edited_sha256"),
        F.array_join("hashes", "-").alias("fingerprint"), F.array_join("edited_hashes", "-").alias("edited_fingerprint"),
        imatch.likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        imatch.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])


@query(
    "op7_topk",
    """
    WITH v AS (
      SELECT vec_id, min([floor(256 * x::DOUBLE)::BIGINT for x in embedding]) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
      GROUP BY vec_id
    ),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]), 0)::BIGINT AS score
      FROM v q JOIN v c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ),
    ranked AS (
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(rows, rows.where(F.col("id") % 50 == 0), 5)


# Base 32 of a SHA-1 in DuckDB: every five bits of each ten hex digits pick a letter.
_BASE32 = " || ".join(
    f"substr('{warc.BASE32_TO}', CAST((CAST('0x' || substr(h, {10 * i + 1}, 10) AS BIGINT) >> {35 - 5 * k}) & 31 AS INTEGER) + 1, 1)"
    for i in range(4) for k in range(8)
)


@query(
    "op8_warc",
    f"""
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
    )
    SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
      CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> first THEN first END AS refers_to FROM p
    """,
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)

    def page(name: str):
        return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    return warc.read(spark, path).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.when(F.col("type") == "revisit", page("refers_to")).alias("refers_to"),
    )


@query("op9_langid")
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 4096, 1)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.pack(digests, 4096, ["doc_id", "piece", "start", "length", "ids_crc32"])
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op13_resample", resample.SQL)
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_ann")
def op12_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return ann.nearest(rows, rows.where(F.col("id") % 50 == 0), 5)


@query("op11_repair")
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found, pieces = repair.repair(repair.damaged(rows))
    hashed = repair.digests(pieces).withColumnRenamed("conv_id", "__id")
    found = found.join(hashed, found["conv_id"].eqNullSafe(hashed["__id"])).drop("__id")
    # Conversations whose rows were all dropped.
    ids = rows.select(F.col("conv_id").alias("__id")).distinct()
    gone = ids.join(found.select("conv_id"), F.col("__id").eqNullSafe(F.col("conv_id")), "left_anti")
    zeros = [F.lit(0).cast("long").alias(c) for c in repair.COUNTS]
    empty = gone.select(F.col("__id").alias("conv_id"), *zeros, F.lit("").alias("audit"), F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256"))
    return found.unionByName(empty)
