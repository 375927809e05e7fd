"""Filings, facts and logs seen in a retail star schema (orders, customer, lineitem, documents, events).

The money columns of that schema are small, so cash flow is read as millions and revenue as ten thousands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filings_audit.operators.keyed import attach_facts, previous_value
from filings_audit.session import configure

# Form type by the first character of the order priority.
FORM_BY_PRIORITY = {"1": "8-K", "2": "10-Q", "3": "10-K", "4": "S-1", "5": "DEF14A"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _cik(key: Column) -> Column:
    return F.lpad(key.cast("string"), 10, "0")


def _form_type() -> Column:
    first = F.substring("o_orderpriority", 1, 1)
    chain = F
    for digit, form in FORM_BY_PRIORITY.items():
        chain = chain.when(first == digit, F.lit(form))
    return chain


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per cik: company, cash flow and segment."""
    return table(spark, sf_dir, "customer").select(
        _cik(F.col("c_custkey")).alias("cik"),
        F.col("c_name").alias("company_name"),
        (F.col("c_acctbal") * 1e6).cast("decimal(20,2)").alias("operating_cash_flow"),
        F.col("c_mktsegment").alias("segment"),
    )


def submissions(spark: SparkSession, sf_dir: str, growth: bool = False) -> DataFrame:
    """Filings before the facts are attached. ``growth`` adds revenue growth over the company's previous one."""
    orders = table(spark, sf_dir, "orders")
    if growth:
        orders = orders.withColumn("day", F.to_date("o_orderdate"))
        orders = previous_value(orders, "o_custkey", "day", "o_orderkey", "o_totalprice", "previous")
    columns = [
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderkey").cast("string").alias("id"),
        _cik(F.col("o_custkey")).alias("cik"),
        _form_type().alias("form_type"),
        F.to_date("o_orderdate").alias("filing_date"),
        (F.col("o_totalprice") * 1e4).cast("decimal(20,2)").alias("revenue_usd"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("Exec "), F.col("o_custkey"))).alias("executive_name"),
        F.col("o_orderstatus").alias("filing_state"),
        F.timestamp_add("SECOND", (F.col("o_orderkey") % 86400).cast("int"), F.col("o_orderdate"))
        .cast("timestamp").alias("created_at"),
    ]
    if growth:
        columns.append((F.col("o_totalprice") / F.col("previous") - 1).alias("revenue_growth"))
    return orders.select(*columns)


def filings(spark: SparkSession, sf_dir: str, growth: bool = True) -> DataFrame:
    """Filings with company name and cash flow."""
    return attach_facts(submissions(spark, sf_dir, growth), facts(spark, sf_dir))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings in the raw intake schema, with the document of the same number as internal notes."""
    text = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("order_key"), F.col("text").alias("internal_notes"))
    return filings(spark, sf_dir, growth=False).join(text, "order_key", "left").select(
        F.col("id").alias("filing_id"), "form_type", "filing_date", "company_name", "cik", "executive_name",
        F.when(F.col("executive_name").isNotNull(), F.lit("Officer")).alias("executive_title"),
        "revenue_usd", "internal_notes",
        F.concat(F.lit("<filing>"), "id", F.lit("</filing>")).alias("raw_submission_xml"),
        F.concat(F.lit("filer"), "cik", F.lit("@example.org")).alias("submitter_email"),
    )


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings as rows of the quarterly index."""
    return filings(spark, sf_dir, growth=False).select(
        "company_name", "form_type", "cik",
        F.date_format("filing_date", "yyyy-MM-dd").alias("date_filed"),
        F.concat(F.lit("edgar/data/"), "id", F.lit(".txt")).alias("filename"),
        F.date_format("filing_date", "yyyy").alias("edgar_year"),
        F.concat(F.lit("QTR"), F.quarter("filing_date").cast("string")).alias("edgar_quarter"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of the event log; event types map to log types."""
    kind = F.col("event_type")
    mapped = (
        F.when(kind == "view", F.lit("INGEST")).when(kind == "click", F.lit("MASK"))
        .when(kind == "purchase", F.lit("EXPORT")).otherwise(F.lit("VALIDATE"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("log_id"),
        F.col("user_id").cast("string").alias("filing_id"),
        mapped.alias("event_type"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.lit(None).cast("string").alias("executive_name_hash"),
        F.element_at(F.array(*[F.lit(f) for f in FORM_BY_PRIORITY.values()]), (F.col("user_id") % 5 + 1).cast("int")).alias("form_type"),
        (F.col("value") * 1e4).cast("decimal(20,2)").alias("revenue_usd"),
        F.lit("sha256-v1").alias("masking_version"),
        F.concat(F.lit("run-"), F.date_format("ts", "yyyyMMdd")).alias("pipeline_run_id"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )
