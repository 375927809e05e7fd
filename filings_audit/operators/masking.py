"""Two-pass masking of personal data, with a per-row trace and a per-run audit.

The first pass hashes whole-value columns. The second scans text columns, one type after another in
registry order, each on the text the previous type left. Row hits travel with the row as a small array,
so the audit is one aggregate over that array and the text is matched once per type.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filings_audit.functions.identity import salted_sha256, uuid5_url
from filings_audit.functions.patterns import (
    DEFAULT_TYPES, NAME_HINTS, PII_PATTERNS, PiiPattern, active_patterns, contains_pii, redact,
)
from filings_audit.schemas import PII_LOG, conform

HITS = "pii_hits"
HASHED_TYPE = "EXECUTIVE_NAME"


@dataclass(frozen=True)
class MaskingConfig:
    """M6."""

    salt: str = "gdpr-salt-v1"
    mode: str = "mock"
    hash_columns: tuple[str, ...] = ("executive_name",)
    scan_columns: tuple[str, ...] = ("root_cause_message", "internal_notes")
    types: tuple[str, ...] = DEFAULT_TYPES
    registry: dict[str, PiiPattern] = field(default_factory=lambda: PII_PATTERNS)


def _hit(column: str, pii_type: str, method: str) -> Column:
    return F.struct(F.lit(column).alias("field"), F.lit(pii_type).alias("pii_type"), F.lit(method).alias("method"))


def mask(df: DataFrame, config: MaskingConfig | None = None, suffix: str = "") -> DataFrame:
    """M4: mask ``df`` and add ``pii_hits``. Absent columns are skipped.

    With ``suffix`` (X9) the masked columns are renamed, e.g. ``executive_name_masked``.
    """
    config = config or MaskingConfig()
    hashed = [c for c in config.hash_columns if c in df.columns]
    scanned = [c for c in config.scan_columns if c in df.columns and c not in hashed]
    patterns = active_patterns(config.types, config.registry)
    hits = [F.when(F.col(c).isNotNull(), _hit(c, HASHED_TYPE, "sha256")) for c in hashed]

    # One projection per type: stage k redacts what stage k-1 left, for all text columns together.
    state = {c: c for c in scanned}
    out = df
    for step, (pii_type, pattern) in enumerate(patterns.items()):
        if not scanned:
            break
        after = {c: f"__{c}_{step}" for c in scanned}
        out = out.withColumns({after[c]: redact(F.col(state[c]), pii_type, pattern) for c in scanned})
        # A placeholder never equals what it replaced, so a changed text is a hit.
        hits += [
            F.when(F.col(after[c]) != F.col(state[c]), _hit(c, pii_type, "regex_redact")) for c in scanned
        ]
        state = after

    def masked(name: str) -> Column:
        if name in hashed:
            # The column says how it was masked.
            return salted_sha256(F.col(name).cast("string"), config.salt).alias(
                name + suffix, metadata={"pii": True, "masking": "sha256"}
            )
        if name in scanned:
            return F.col(state[name]).alias(name + suffix, metadata={"pii": True, "masking": "regex_redact"})
        return F.col(name)

    kind = "array<struct<field:string,pii_type:string,method:string>>"
    trace = F.array_compact(F.array(*hits)) if hits else F.array()
    return out.select(*[masked(c) for c in df.columns], trace.cast(kind).alias(HITS))


def mask_values(df: DataFrame, config: MaskingConfig | None = None, suffix: str = "") -> DataFrame:
    """``mask`` without the trace."""
    return mask(df, config, suffix).drop(HITS)


def _exploded(masked: DataFrame, *columns: Column) -> DataFrame:
    """One row per hit. The outer form keeps Spark from deriving a filter that repeats the whole scan."""
    return masked.select(*columns, F.explode_outer(HITS).alias("hit")).filter(F.col("hit").isNotNull())


def audit_entries(masked: DataFrame, source_file_id: str, as_of: Column, mode: str = "mock") -> DataFrame:
    """M5: one row per (field, type) with at least one hit. Holds names and counts, never values (M8)."""
    counts = (
        _exploded(masked)
        .groupBy(
            F.col("hit.field").alias("field_name"),
            F.col("hit.pii_type").alias("pii_type"),
            F.col("hit.method").alias("masking_method"),
        )
        .agg(F.count("*").alias("record_count"))
    )
    name = F.concat_ws(":", F.lit(source_file_id), "field_name", "pii_type")
    return conform(
        counts.withColumns(
            {
                "id": uuid5_url(name),
                "source_file_id": F.lit(source_file_id),
                "detection_ts": as_of,
                "pipeline_mode": F.lit(mode),
            }
        ),
        PII_LOG,
    )


def row_hits(masked: DataFrame, record_id: str) -> DataFrame:
    """X11: one row per record, field and type that was masked."""
    return _exploded(masked, F.col(record_id).alias("record_id")).select(
        "record_id", F.col("hit.field").alias("field_name"), F.col("hit.pii_type").alias("pii_type"),
        F.col("hit.method").alias("masking_method"),
    )


def mask_messages(df: DataFrame, config: MaskingConfig, column: str = "root_cause_message") -> DataFrame:
    """M7: scan texts written after detection. Their audit uses the source id from ``post_rca``."""
    return mask(df, MaskingConfig(config.salt, config.mode, (), (column,), config.types, config.registry))


def post_rca(source_file_id: str) -> str:
    return f"{source_file_id}:post-rca"


def pattern_counts(df: DataFrame, columns: list[str], types, registry=None) -> DataFrame:
    """A4, A5: for every column and type the rows that match, and the non-null rows, in one pass."""
    patterns = active_patterns(types, registry)
    cells = [(c, t, p) for c in columns for t, p in patterns.items()]
    totals = df.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.count_if(contains_pii(F.col(c), p)).alias(f"h_{i}") for i, (c, _, p) in enumerate(cells)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("field_name"), F.lit(t).alias("pii_type"),
                F.col(f"h_{i}").alias("rows_hit"), F.col(f"n_{columns.index(c)}").alias("rows_present"),
            )
            for i, (c, t, _) in enumerate(cells)
        ]
    )
    return totals.select(F.inline(rows))


def detect_pii_columns(df: DataFrame, types=tuple(PII_PATTERNS), min_rate: float = 0.0) -> DataFrame:
    """String columns that look personal, by match rate or by name."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    rate = F.when(F.col("rows_present") > 0, F.col("rows_hit") / F.col("rows_present")).otherwise(0.0)
    hinted = reduce(
        lambda a, b: a | b, [F.lower("field_name").contains(hint) for hint in NAME_HINTS]
    )
    return (
        pattern_counts(df, columns, types)
        .withColumns({"hit_rate": F.round(rate, 6), "name_hint": hinted})
        .filter((F.col("hit_rate") > min_rate) | F.col("name_hint"))
    )


def remask(raw: DataFrame, config: MaskingConfig, new_salt: str, version: str) -> DataFrame:
    """M9: mask the raw rows again under a new salt; ``masking_version`` tells the runs apart."""
    rotated = MaskingConfig(
        new_salt, config.mode, config.hash_columns, config.scan_columns, config.types, config.registry
    )
    return mask_values(raw, rotated).withColumn("masking_version", F.lit(version))
