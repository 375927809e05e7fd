"""Writing and streaming into the stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from filings_audit.functions.identity import filing_uuid
from filings_audit.operators import detection, forest, models
from filings_audit.operators.cleaning import strip_cik
from filings_audit.plans import medallion, standing
from filings_audit.schemas import TRIAGE, TRIAGE_REQUIRED, conform
from filings_audit.session import configure, materialize, new_dir
from filings_audit.sinks import constraints, gold
from filings_audit.sources import index_files, star_schema
from filings_audit.streaming import jobs
from filings_audit.workload import fixture, oracle, privacy
from filings_audit.workload.fixture import as_of
from filings_audit.workload.intake import _UUID, FORMS, INDEX, write_index
from filings_audit.workload.registry import query


def _keyed(spark, sf_dir):
    uuid = filing_uuid(strip_cik(F.col("cik")), F.col("filing_date"), F.col("form_type"))
    return star_schema.filings(spark, sf_dir, growth=False).withColumn("id", uuid)


def _revised(spark, sf_dir):
    """Filings whose goods have shipped: the last shipment is their new date, so most change their month.

    Some lack a company and some the id. Each comes again as an older row, which must lose.
    """
    shipped = star_schema.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").cast("timestamp").alias("shipped"), F.sum("l_quantity").alias("quantity"))
    rows = star_schema.filings(spark, sf_dir, growth=False).join(shipped, F.col("order_key") == F.col("l_orderkey"))
    older = F.timestamp_add("DAY", F.lit(-1), "shipped")
    times = F.array(  # both rows from one join
        F.struct(F.to_date("shipped").alias("day"), F.col("shipped").alias("at")),
        F.struct(F.lit("2001-01-01").cast("date").alias("day"), older.cast("timestamp").alias("at")))
    return rows.withColumns({
        "id": F.when(F.col("order_key") % 13 != 0, F.col("id")),
        "company_name": F.when(F.col("order_key") % 7 != 0, F.col("company_name")),
        "operating_cash_flow": (F.col("quantity") * 1e6).cast("decimal(20,2)"),
        "__time": F.explode(times)}).withColumns({"filing_date": F.col("__time.day"), "created_at": F.col("__time.at")}).drop("__time")


def _order():
    return [F.desc("created_at"), F.desc("operating_cash_flow"), F.desc("company_name")]


_STATE = "strftime(filing_date, '%Y-%m-%d') AS filing_date, CAST(cash AS DOUBLE) AS operating_cash_flow, strftime(happened, '%Y-%m-%d %H:%M:%S') AS created_at"


@query("upsert_gold", f"""
WITH {oracle.FILINGS},
first AS (SELECT id, company_name, filing_date, operating_cash_flow AS cash, created_at AS happened FROM filings WHERE filing_state <> 'O'),
shipped AS (SELECT l_orderkey, CAST(max(l_shipdate) AS TIMESTAMP) AS happened, CAST(sum(l_quantity) * 1e6 AS DECIMAL(20,2)) AS cash
  FROM lineitem GROUP BY l_orderkey),
revised AS (
  SELECT CASE WHEN order_key % 13 <> 0 THEN id END AS id, CASE WHEN order_key % 7 <> 0 THEN company_name END AS company_name,
    CAST(s.happened AS DATE) AS filing_date, s.cash, s.happened FROM filings JOIN shipped s ON order_key = l_orderkey),
later AS (SELECT * FROM revised WHERE id IS NOT NULL AND company_name IS NOT NULL),
refused AS (SELECT * FROM revised WHERE id IS NULL OR company_name IS NULL
  UNION SELECT id, company_name, DATE '2001-01-01', cash, happened - INTERVAL 1 DAY FROM revised WHERE id IS NULL OR company_name IS NULL)
SELECT 'stored' AS place, id, company_name, {_STATE} FROM (
  SELECT * FROM later UNION ALL SELECT * FROM first WHERE id NOT IN (SELECT id FROM later))
UNION ALL SELECT 'refused', id, company_name, {_STATE} FROM refused""")
def upsert_gold(spark, sf_dir):
    """K3, K6: filed records first, then twice the same batch of revisions: what is stored and what was refused."""
    root = new_dir(configure(spark), "gold")
    gold.initialise(spark, root)
    gold.upsert(star_schema.filings(spark, sf_dir, growth=False).filter("filing_state <> 'O'"), root, order=_order())
    revised = materialize(conform(_revised(spark, sf_dir), TRIAGE), "batch")
    gold.upsert(revised, root, order=_order())
    gold.upsert(revised, root, order=_order())
    stored = gold.read_gold(spark, root).withColumn("place", F.lit("stored"))
    refused = gold.read_rejected(spark, root).drop("violations").withColumn("place", F.lit("refused"))
    return stored.unionByName(refused).select(
        "place", "id", "company_name", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"),
        F.col("operating_cash_flow").cast("double").alias("operating_cash_flow"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@query("append_gold", f"""
WITH {oracle.FILINGS}, batches AS (
  SELECT 1 AS step, id, company_name, filing_date FROM filings WHERE filing_state = 'F'
  UNION ALL SELECT 2, id, company_name, filing_date FROM filings WHERE filing_state IN ('F', 'O')
  UNION ALL SELECT 3, id, CASE WHEN order_key % 5 <> 0 THEN company_name END, filing_date FROM filings WHERE filing_state = 'P')
SELECT id, company_name, false AS known_rule_violation, false AS ml_anomaly_flag, CASE
  WHEN company_name IS NULL THEN 'company_name'
  WHEN step = 2 AND id IN (SELECT id FROM batches WHERE step = 1) THEN 'repeated id' ELSE '' END AS violations FROM batches""")
def append_gold(spark, sf_dir):
    """K4, K6: all filings in three appends; the second brings the first once more, the third lacks some names.

    Columns the batch lacks take their defaults, columns the table lacks are ignored. Kept rows and refused ones.
    """
    root = new_dir(configure(spark), "gold")
    rows = star_schema.filings(spark, sf_dir, growth=False).drop("created_at")
    gold.append(rows.filter("filing_state = 'F'"), root, as_of())
    gold.append(rows.filter("filing_state IN ('F', 'O')"), root, as_of())
    nameless = F.when(F.col("order_key") % 5 != 0, F.col("company_name"))
    gold.append(rows.filter("filing_state = 'P'").withColumn("company_name", nameless), root, as_of())
    kept = gold.read_gold(spark, root).withColumn("violations", F.array().cast("array<string>"))
    return kept.unionByName(gold.read_rejected(spark, root)).select(
        "id", "company_name", "known_rule_violation", "ml_anomaly_flag", F.array_join("violations", ",").alias("violations"))


def _imperfect(spark, sf_dir):
    """Keyed filings that go by their executive's name, which some lack."""
    return constraints.with_defaults(_keyed(spark, sf_dir).withColumn("company_name", F.col("executive_name")), as_of())


@query("constraint_check", f"""
WITH {oracle.FILINGS}, keyed AS (SELECT *, {_UUID} AS uuid FROM filings),
per_key AS (SELECT uuid, count(*) AS n FROM keyed GROUP BY uuid)
SELECT CAST((SELECT sum(n) FROM per_key) AS BIGINT) AS records,
  (SELECT count(*) FROM per_key WHERE n > 1) AS duplicate_keys,
  (SELECT count(*) FROM keyed WHERE executive_name IS NULL) AS null_company_name,
  0::BIGINT AS null_id, 0::BIGINT AS null_filing_date, 0::BIGINT AS null_known_rule_violation,
  0::BIGINT AS null_ml_anomaly_flag, 0::BIGINT AS null_created_at""")
def constraint_check(spark, sf_dir):
    return constraints.constraint_report(_imperfect(spark, sf_dir))


@query("quarantine_rows", f"""
WITH {oracle.FILINGS}
SELECT {_UUID} AS id, 'company_name' AS violations FROM filings WHERE executive_name IS NULL""")
def quarantine_rows(spark, sf_dir):
    """K6: what an upsert refuses is kept, with the reason."""
    root = new_dir(configure(spark), "gold")
    gold.upsert(_imperfect(spark, sf_dir), root, as_of())
    return gold.read_rejected(spark, root).select("id", F.array_join("violations", ",").alias("violations"))


_FATE = """
SELECT 'refused' AS place, id, company_name, CASE WHEN order_key % 3 = 0 THEN 'company_name' ELSE violations END AS violations FROM told
  WHERE order_key % 3 = 0 OR violations <> ''
UNION ALL SELECT 'stored', id, company_name, '' FROM told WHERE order_key % 3 <> 0 AND violations = ''"""


def _fate(spark, root):
    """Every row that a table was given: stored, or refused with its reasons."""
    stored = gold.read_gold(spark, root).select(F.lit("stored").alias("place"), "id", "company_name", F.lit("").alias("violations"))
    refused = gold.read_rejected(spark, root).select(F.lit("refused").alias("place"), "id", "company_name", F.array_join("violations", ",").alias("violations"))
    return stored.unionByName(refused)


def _nameless(spark, sf_dir):
    """Filings; a third of them lack the name."""
    return conform(star_schema.filings(spark, sf_dir, growth=False).withColumn(
        "company_name", F.when(F.col("order_key") % 3 != 0, F.col("company_name"))), TRIAGE)


@query("rejected_batches", f"""
WITH {oracle.FILINGS}, told AS (
  SELECT order_key, id, CASE WHEN order_key % 3 <> 0 THEN company_name END AS company_name, '' AS violations FROM filings
  UNION ALL SELECT order_key, id, company_name, 'repeated id' FROM filings WHERE order_key % 3 = 1)
{_FATE}""")
def rejected_batches(spark, sf_dir):
    """K3, K4, K6: a batch without a valid row first, then one without a fault, then an append of stored ids only."""
    root = new_dir(configure(spark), "gold")
    rows = _nameless(spark, sf_dir)
    gold.upsert(rows.filter("company_name IS NULL"), root, as_of())
    gold.upsert(rows.filter("company_name IS NOT NULL"), root, as_of())
    gold.append(rows.filter("company_name IS NOT NULL AND CAST(id AS BIGINT) % 3 = 1"), root, as_of())
    return _fate(spark, root)


@query("required_columns", f"""
WITH {oracle.FILINGS}, told AS (
  SELECT id, CASE WHEN order_key % 3 <> 0 THEN company_name END AS company_name FROM filings)
SELECT unnest({sorted(TRIAGE_REQUIRED)!r}) AS lacking, 'refused' AS verdict, true AS named, 0::BIGINT AS stored, 0::BIGINT AS rejected
UNION ALL SELECT 'nothing', 'taken', false, count(company_name), count(*) - count(company_name) FROM told""")
def required_columns(spark, sf_dir):
    """K5: a batch that lacks a required column is refused as a whole, names the column, and leaves no row behind; then one that has all."""
    rows = _nameless(spark, sf_dir)
    out = None
    for lacking in [*sorted(TRIAGE_REQUIRED), "nothing"]:
        root, verdict, named = new_dir(configure(spark), "gold"), "taken", False
        try:
            gold.upsert(rows.drop(lacking), root, as_of())
        except ValueError as error:
            verdict, named = "refused", f"'{lacking}'" in str(error)
        fate = _fate(spark, root).agg(
            F.lit(lacking).alias("lacking"), F.lit(verdict).alias("verdict"), F.lit(named).alias("named"),
            F.count_if(F.col("place") == "stored").alias("stored"), F.count_if(F.col("place") == "refused").alias("rejected"))
        out = fate if out is None else out.unionByName(fate)
    return out


# Counts per month ---------------------------------------------------------------------------------

def _flagged(rows, rule: int, ml: int, steps: int):
    """Flags and scores by the order's number."""
    key = F.col("order_key")
    return rows.withColumns({
        "known_rule_violation": key % rule == 0, "ml_anomaly_flag": key % ml == 0,
        "ml_anomaly_score": F.when(key % 11 != 0, (key % steps) / 1000)})


def _flags_sql(rule: int, ml: int, steps: int) -> str:
    return (f"order_key % {rule} = 0 AS rule, order_key % {ml} = 0 AS ml, "
            f"CASE WHEN order_key % 11 <> 0 THEN CAST((order_key % {steps}) / 1000 AS DECIMAL(10,4)) END AS score")


def _changed(spark, sf_dir) -> str:
    """A table after three batches: filings, the rest of them, and revisions that move most of them to other months."""
    root = new_dir(configure(spark), "gold")
    rows = _flagged(star_schema.filings(spark, sf_dir, growth=False), 3, 4, 1000)
    gold.upsert(rows.filter("filing_state = 'F'"), root, order=_order())
    gold.append(rows.filter("filing_state = 'P'"), root)
    gold.upsert(_flagged(_revised(spark, sf_dir), 2, 5, 500), root, order=_order())
    return root


_CHANGED = f"""
WITH {oracle.FILINGS},
first AS (SELECT id, company_name, created_at AS happened, {_flags_sql(3, 4, 1000)} FROM filings WHERE filing_state <> 'O'),
shipped AS (SELECT l_orderkey, CAST(max(l_shipdate) AS TIMESTAMP) AS happened FROM lineitem GROUP BY l_orderkey),
later AS (SELECT id, company_name, s.happened, {_flags_sql(2, 5, 500)} FROM filings JOIN shipped s ON order_key = l_orderkey
  WHERE order_key % 13 <> 0 AND order_key % 7 <> 0 AND company_name IS NOT NULL),
stored AS (SELECT * FROM later UNION ALL SELECT * FROM first WHERE id NOT IN (SELECT id FROM later))"""


@query("summary_kept", f"""{_CHANGED}
SELECT count(*) AS total, count(*) FILTER (WHERE rule) AS violations, count(*) FILTER (WHERE ml) AS anomalies,
  count(*) FILTER (WHERE NOT rule AND NOT ml) AS healthy, round(CAST(sum(score) AS DOUBLE) / count(score), 6) AS average_score FROM stored""")
def summary_kept(spark, sf_dir):
    """A1, A2, X2 from the counts per month, after rows were added, replaced, and moved to other months; no record is read."""
    return standing.summary(spark, _changed(spark, sf_dir), with_average=True)


@query("newest_kept", f"""{_CHANGED}
SELECT id, company_name, rule AS known_rule_violation, strftime(happened, '%Y-%m-%d %H:%M:%S') AS created_at FROM stored
ORDER BY happened DESC, id LIMIT 1000""")
def newest_kept(spark, sf_dir):
    """S5, T1 from the months that can hold the newest rows."""
    return standing.newest(spark, _changed(spark, sf_dir), 1000).select(
        "id", "company_name", "known_rule_violation", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


# Streams ------------------------------------------------------------------------------------------

_FILE_ROWS = 500_000


def _stream(spark, path, schema, files=1000):
    return configure(spark).readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _table_stream(spark, sf_dir, name):
    """A stored table as a stream: its files are copied into a folder of their own first."""
    work = new_dir(configure(spark), f"stream-{name}")
    rows = star_schema.table(spark, sf_dir, name)
    rows.write.parquet(work)
    return _stream(spark, work, rows.schema)


@query("stream_ingest", f"""
WITH {INDEX}
SELECT company_name, form_type, ltrim(cik, '0') AS cik, date_filed, filename, edgar_year, edgar_quarter
FROM index_rows WHERE form_type IN {FORMS}""")
def stream_ingest(spark, sf_dir):
    """ST1; the second run finds nothing new."""
    work = new_dir(configure(spark), "stream-ingest")
    index = write_index(spark, sf_dir)
    for _ in range(2):
        jobs.ingest_index(spark, index, f"{work}/bronze", f"{work}/checkpoint")
    fields = [*index_files.LAYOUT, "edgar_year", "edgar_quarter"]
    return spark.read.schema(", ".join(f"{f} string" for f in fields)).parquet(f"{work}/bronze")


@query("stream_mask", f"{privacy._AUDIT} SELECT field_name, pii_type, masking_method, record_count FROM audit")
def stream_mask(spark, sf_dir):
    """ST2: audit over all micro-batches."""
    work = new_dir(configure(spark), "stream-mask")
    stream = _table_stream(spark, sf_dir, "documents").select("doc_id", "source", "text")
    jobs.mask_stream(stream, f"{work}/masked", f"{work}/audit", f"{work}/checkpoint", "run-1", as_of(), privacy.DOCUMENTS)
    return jobs.read_stream_audit(spark, f"{work}/audit").groupBy("field_name", "pii_type", "masking_method").agg(
        F.sum("record_count").alias("record_count"))


@query("stream_upsert", f"""
WITH {oracle.GOLD} SELECT id, company_name, known_rule_violation, ml_anomaly_flag, root_cause_message FROM gold""")
def stream_upsert(spark, sf_dir):
    """ST3: flagged filings into gold, in several micro-batches."""
    work = new_dir(configure(spark), "stream-upsert")
    rows = materialize(fixture.triage_table(spark, sf_dir), "rows")
    files = max(1, -(-rows.count() // (3 * _FILE_ROWS)))  # of a third; one task writes a file
    rows.repartitionByRange(3 * files, "filing_date").write.parquet(f"{work}/in")
    jobs.upsert_stream(_stream(spark, f"{work}/in", TRIAGE, files=files), f"{work}/gold", f"{work}/checkpoint")
    return gold.read_gold(spark, f"{work}/gold").select(
        "id", "company_name", "known_rule_violation", "ml_anomaly_flag", "root_cause_message")


@query("stream_rejects", f"""
WITH {oracle.FILINGS}, told AS (
  SELECT order_key, id, CASE WHEN order_key % 3 <> 0 THEN company_name END AS company_name, '' AS violations FROM filings)
{_FATE}""")
def stream_rejects(spark, sf_dir):
    """ST3, K6: one of the micro-batches holds nothing but rejects, another none; each input row is found once."""
    work = new_dir(configure(spark), "stream-rejects")
    rows = materialize(_nameless(spark, sf_dir), "nameless")
    for some in (rows.filter("company_name IS NULL"), rows.filter("company_name IS NOT NULL"), None):  # the last run finds nothing new
        if some is not None:
            some.write.mode("append").parquet(f"{work}/in")
        jobs.upsert_stream(_stream(spark, f"{work}/in", TRIAGE), f"{work}/gold", f"{work}/checkpoint", as_of())
    return _fate(spark, f"{work}/gold")


@query("stream_score")
def stream_score(spark, sf_dir):
    """ST4: a model fitted once and stored scores the stream."""
    work = new_dir(configure(spark), "stream-score")
    features = detection.with_features(star_schema.filings(spark, sf_dir)).select("id", *medallion.LIVE_FEATURES)
    features.write.parquet(f"{work}/in")
    stored = spark.read.parquet(f"{work}/in")
    vector = forest.feature_vector(medallion.LIVE_FEATURES)
    forest.fit(stored.withColumn("vector", vector), "id", "vector").write.parquet(f"{work}/model")
    trees = spark.read.parquet(f"{work}/model")
    jobs.score_stream(_stream(spark, f"{work}/in", stored.schema), trees, vector, f"{work}/out", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out").select("id", "ml_raw_score")


@query("stream_models", """
SELECT CAST(o_orderkey % 2 AS BIGINT) AS epoch, 1 + CAST(o_orderkey % 2 AS BIGINT) AS model_version, count(*) AS records,
  count(*) AS scored_by_it FROM orders GROUP BY ALL""")
def stream_models(spark, sf_dir):
    """ST4: a newer fit is stored between two micro-batches.

    Per micro-batch: the version its rows name, and how many have the score that this version gives them in batch.
    """
    work = new_dir(configure(spark), "stream-models")
    features = detection.with_features(star_schema.filings(spark, sf_dir)).select("id", "order_key", *medallion.LIVE_FEATURES)
    vector = forest.feature_vector(medallion.LIVE_FEATURES)
    fits = [forest.ForestParams(trees=40, seed=seed) for seed in (1, 2)]
    stored = materialize(features, "features")
    halves = [stored.filter(F.col("order_key") % 2 == half) for half in (0, 1)]
    for version, (half, fit) in enumerate(zip(halves, fits), 1):
        half.write.mode("append").parquet(f"{work}/in")
        models.publish(forest.fit(stored.withColumn("vector", vector), "id", "vector", fit), f"{work}/models", version, fit)
        stream = _stream(spark, f"{work}/in", stored.schema)
        jobs.score_by_newest(stream, f"{work}/models", vector, f"{work}/out", f"{work}/checkpoint")
    scored = jobs.read_scored(spark, f"{work}/out", stored.schema)
    again = None
    for version in (1, 2):
        batch = forest.score(stored, models.load(spark, f"{work}/models", version), vector, "expected")
        batch = batch.select("id", "expected", F.lit(version).cast("long").alias("model_version"))
        again = batch if again is None else again.unionByName(batch)
    same = F.abs(F.col("expected") - F.col("ml_raw_score")) < 1e-12
    return scored.join(again, ["id", "model_version"]).groupBy("epoch", "model_version").agg(
        F.count("*").alias("records"), F.count_if(same).alias("scored_by_it"))


@query("stream_dedupe", """
SELECT DISTINCT user_id, event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour FROM events""")
def stream_dedupe(spark, sf_dir):
    """ST5: one event per user, type and hour. The events come in four files without any order in time, file by file."""
    work = new_dir(configure(spark), "stream-dedupe")
    events = star_schema.table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_id")
    events.repartition(4, "event_id").write.parquet(f"{work}/in")
    stream = _stream(spark, f"{work}/in", events.schema, files=1)
    jobs.deduplicate_stream(stream, ["user_id", "event_type", "hour"], "ts", f"{work}/out", f"{work}/checkpoint")
    return jobs.read_deduplicated(spark, f"{work}/out", events.schema).select("user_id", "event_type", "hour")
