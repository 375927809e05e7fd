"""Index files to bronze to silver to gold, in Spark from end to end.

Each layer is a table, so a lost executor or a restarted run resumes from files. The driver receives only
the model's trees and scalar results.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from filings_audit.functions.identity import filing_uuid
from filings_audit.operators import cleaning, detection, explain, forest, keyed, masking
from filings_audit.operators.masking import MaskingConfig
from filings_audit.schemas import BRONZE, SILVER, TRIAGE, conform
from filings_audit.sinks import audit_log, gold, layers
from filings_audit.sources import index_files
from filings_audit.sources.tables import read_typed

LIVE_FEATURES = ["revenue_growth_norm", "operating_cash_flow_norm"]


@dataclass(frozen=True)
class LiveConfig:
    """Settings of a live run. ``contamination`` and the forest size are the live defaults."""

    root: str
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))  # P19
    contamination: float = 0.08
    forest: forest.ForestParams = forest.ForestParams()
    masking: MaskingConfig = MaskingConfig(mode="live")
    forms: tuple[str, ...] = cleaning.TARGET_FORMS
    features: tuple[str, ...] = tuple(LIVE_FEATURES)
    partitions: int = 200  # a gz file is read by one task; its rows are dealt to so many
    keep_silver: bool = True

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def work(self, name: str) -> str:
        """Tables between the steps of this run; other runs have their own."""
        return f"{self.root}/runs/{self.run_id}/{name}"


@dataclass
class RunResult:
    silver: DataFrame
    gold: DataFrame
    pii_log: DataFrame
    written: gold.Written
    events: DataFrame


def ingest_bronze(
    spark: SparkSession, index_path: str, facts: DataFrame, config: LiveConfig, watch: layers.Watch = layers.unwatched
) -> DataFrame:
    """Read index files, attach the facts of each company, write the quarters they hold and return these quarters.

    Damaged lines go to a table of their own. The read counts them, so the files are read again only where there are any.
    """
    lines = index_files.read_lines(spark, index_path)
    classified = index_files.classify_lines(lines.repartition(config.partitions))
    seen = Observation()
    index = index_files.entries(classified.observe(seen, F.count_if(F.col("kind") == "damaged").alias("damaged")), config.forms)
    layers.write_bronze(keyed.attach_facts(index.drop("operating_cash_flow"), facts), config.path("bronze"), watch)
    if seen.get["damaged"]:
        rows = index_files.damaged_lines(classified).hint("rebalance", "edgar_year", "edgar_quarter")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("edgar_year", "edgar_quarter").parquet(config.path("index_damaged"))
    touched = index_files.quarters(spark, index_path)
    wanted = F.lit(False)
    for year, quarter in touched:
        wanted = wanted | ((F.col("edgar_year") == year) & (F.col("edgar_quarter") == quarter))
    return read_typed(spark, config.path("bronze"), BRONZE).filter(wanted)


def clean(bronze: DataFrame, config: LiveConfig) -> DataFrame:
    """Typed, masked rows, one per filing id, with the masking trace."""
    typed = cleaning.clean_bronze(bronze, "edgar_year", "edgar_quarter").withColumn(
        "id", filing_uuid(F.col("cik"), F.col("filing_date"), F.col("form_type"))
    )
    # Values are compared before masking: the same row must win under any salt.
    single = keyed.latest_per_key(
        typed, "id", F.desc("revenue_usd"), F.desc("operating_cash_flow"), F.desc("revenue_growth"),
        F.desc("company_name"), F.desc("executive_name"),
    )
    return masking.mask(single, config.masking)


def detect(cleaned: DataFrame, config: LiveConfig) -> DataFrame:
    """Fit, score and flag. ``cleaned`` must be a table: the fit reads its feature columns several times.

    Scoring is the costly step, so scored rows are written once and the threshold is read from there.
    """
    vector = forest.feature_vector(list(config.features))
    features = detection.with_features(cleaned).withColumn("vector", vector)
    scored, _ = forest.fit_and_score(features, "id", "vector", config.forest)
    scored.drop("vector").write.mode("overwrite").parquet(config.work("scored"))
    return detection.live_flags(cleaned.sparkSession.read.parquet(config.work("scored")), config.contamination)


def run_batch(
    spark: SparkSession, index_path: str, facts: DataFrame, config: LiveConfig, as_of: Column | None = None
) -> RunResult:
    """One run: ingest, clean, mask, detect, explain, re-scan, then write silver, gold and the audit log."""
    as_of = F.current_timestamp() if as_of is None else as_of
    steps = {name: audit_log.Step(name, config.forms) for name in ("INGEST", "MASK", "VALIDATE", "EXPORT")}  # X10
    bronze = ingest_bronze(spark, index_path, facts, config, steps["INGEST"].watch)
    steps["MASK"].watch(clean(bronze, config)).write.mode("overwrite").parquet(config.work("cleaned"))
    cleaned = spark.read.parquet(config.work("cleaned"))
    entries = masking.audit_entries(cleaned, config.run_id, as_of, config.masking.mode)

    explained = explain.with_root_cause(detect(cleaned.drop(masking.HITS), config))
    masking.mask_messages(explained, config.masking).write.mode("overwrite").parquet(config.work("rescanned"))  # M7
    rescanned = spark.read.parquet(config.work("rescanned"))
    if config.keep_silver:
        layers.write_silver(rescanned, config.path("silver"), steps["EXPORT"].watch)
    post = masking.audit_entries(rescanned, masking.post_rca(config.run_id), as_of, config.masking.mode)
    audit_log.write_pii_log(entries.unionByName(post), config.path("pii_log"))  # U1

    silver = conform(rescanned, SILVER)
    written = gold.upsert(silver, config.path("gold"), as_of, unique=True, watch=steps["VALIDATE"].watch, stored=True)
    done = [step for name, step in steps.items() if name != "EXPORT" or config.keep_silver]
    audit_log.write_run_events(spark, done, config.run_id, cleaning.MASKING_VERSION, as_of, config.path("events"))
    return RunResult(
        silver, gold.read_gold(spark, config.path("gold")),
        audit_log.read_pii_log(spark, config.path("pii_log")), written, audit_log.read_run_events(spark, config.path("events")),
    )


def mask_intake(raw: DataFrame, config: MaskingConfig = MaskingConfig(), as_of: Column | None = None) -> DataFrame:
    """The intake variant: minimise, hash executives, add lineage. Lazy, one projection over the source."""
    slim = cleaning.minimize_columns(raw)
    return cleaning.with_lineage(masking.mask_values(slim, config), as_of)


def load_intake(
    raw: DataFrame, root: str, run_id: str, as_of: Column, config: MaskingConfig = MaskingConfig()
) -> gold.Written:
    """The intake variant that ends in gold: rename, mask, upsert, audit."""
    masked = masking.mask(cleaning.to_triage_names(raw), config)
    entries = masking.audit_entries(masked, run_id, as_of, config.mode)
    written = gold.upsert(conform(masked.withColumn("created_at", as_of), TRIAGE), f"{root}/gold", as_of)
    audit_log.write_pii_log(entries, f"{root}/pii_log")
    return written
