"""Rule, thresholds, scores, forest and messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filings_audit.operators import detection, explain, forest, keyed
from filings_audit.plans import medallion
from filings_audit.session import configure, materialize, new_dir
from filings_audit.sinks import audit_log
from filings_audit.sources import star_schema
from filings_audit.workload import fixture, oracle
from filings_audit.workload.intake import _UUID, FORMS, INDEX, write_index
from filings_audit.workload.registry import query


@query("revenue_zscore", f"""
WITH {oracle.SCORED} SELECT id, round(z, 6) AS growth_z, round(cf, 6) AS cash_flow FROM scored""")
def revenue_zscore(spark, sf_dir):
    return detection.with_features(star_schema.filings(spark, sf_dir)).select(
        "id", F.round("revenue_growth_norm", 6).alias("growth_z"), F.round("operating_cash_flow_norm", 6).alias("cash_flow"))


@query("growth_statistics", f"""
WITH {oracle.SCORED}
SELECT count(*) AS filings, count(revenue_growth) AS with_growth, round(avg(revenue_growth), 6) AS mean,
  round(stddev_samp(revenue_growth), 6) AS std, min(raw) AS low, max(raw) + 0.0 AS high FROM scored""")
def growth_statistics(spark, sf_dir):
    return fixture.scored(spark, sf_dir).agg(
        F.count("*").alias("filings"), F.count("revenue_growth").alias("with_growth"),
        F.round(F.avg("revenue_growth"), 6).alias("mean"), F.round(F.stddev_samp("revenue_growth"), 6).alias("std"),
        F.min("ml_raw_score").alias("low"), (F.max("ml_raw_score") + 0.0).alias("high"))


@query("rule_violation", f"WITH {oracle.FILINGS} SELECT id, {oracle.RULE} AS known_rule_violation FROM filings")
def rule_violation(spark, sf_dir):
    return detection.with_rule(star_schema.filings(spark, sf_dir)).select("id", "known_rule_violation")


@query("score_quantiles", f"WITH {oracle.SCORED} " + " UNION ALL ".join(
    f"SELECT '{name}' AS of, CAST({q} AS DOUBLE) AS share, round(quantile_cont(CAST({column} AS DOUBLE), {q}), 6) AS threshold FROM scored"
    for name, column in (("ml_raw_score", "raw"), ("revenue_usd", "revenue_usd")) for q in ("0.01", "0.08", "0.5")))
def score_quantiles(spark, sf_dir):
    """A8 over the scores, and over revenues, nearly all of which are distinct."""
    rows = fixture.scored(spark, sf_dir)
    found = [
        detection.quantile(rows, column, share).select(F.lit(column).alias("of"), F.lit(share).alias("share"), F.round("threshold", 6).alias("threshold"))
        for column in ("ml_raw_score", "revenue_usd") for share in (0.01, 0.08, 0.5)
    ]
    return reduce(DataFrame.unionByName, found)


@query("quarter_quantiles", f"""
WITH {oracle.FILINGS}, v AS (
  SELECT year(filing_date) * 4 + quarter(filing_date) AS q, CAST(revenue_usd AS DOUBLE) / 7 AS v FROM filings),
steps AS (SELECT DISTINCT q AS upto FROM v WHERE q >= (SELECT max(q) - 1 FROM v))
""" + " UNION ALL ".join(
    f"SELECT upto - (SELECT max(q) FROM v) AS step, {q}::DOUBLE AS share, quantile_cont(v, {q}) AS threshold FROM steps, v WHERE q <= upto GROUP BY upto"
    for q in ("0.01", "0.5", "0.999")))
def quarter_quantiles(spark, sf_dir):
    """A8 over a table that grows by a quarter: its sketches are stored, and the new quarter's is made from itself alone."""
    path = new_dir(configure(spark), "quarters")
    rows = star_schema.filings(spark, sf_dir, growth=False).select(
        (F.year("filing_date") * 4 + F.quarter("filing_date")).alias("quarter"), (F.col("revenue_usd").cast("double") / 7).alias("v"))
    rows = materialize(rows, "values")
    last = rows.agg(F.max("quarter")).first()[0]
    found = []
    for step in (-1, 0):
        upto = last + step
        new = rows.filter(F.col("quarter") <= upto if step else F.col("quarter") == upto)
        detection.sketches(new, "v", ["quarter"]).write.mode("append").parquet(path)
        stored = spark.read.parquet(path)
        for share in (0.01, 0.5, 0.999):
            one = detection.quantile(rows.filter(F.col("quarter") <= upto), "v", share, stored)
            found.append(one.select(F.lit(step).cast("long").alias("step"), F.lit(share).alias("share"), "threshold"))
    return reduce(DataFrame.unionByName, found)


@query("threshold_flag", f"""
WITH {oracle.triage(0.08)} SELECT id, ml_anomaly_flag FROM triage""")
def threshold_flag(spark, sf_dir):
    return detection.flag_below_quantile(fixture.scored(spark, sf_dir), contamination=0.08).select("id", "ml_anomaly_flag")


@query("dual_layer_priority", f"""
WITH {oracle.triage(0.01)}
SELECT id, known_rule_violation, ml_anomaly_flag,
  known_rule_violation::INTEGER + ml_anomaly_flag::INTEGER AS triage_priority FROM triage""")
def dual_layer_priority(spark, sf_dir):
    return detection.dual_layer(fixture.scored(spark, sf_dir), 0.01).select(
        "id", "known_rule_violation", "ml_anomaly_flag", "triage_priority")


@query("score_minmax", f"WITH {oracle.triage()} SELECT id, ml_anomaly_score FROM triage")
def score_minmax(spark, sf_dir):
    return detection.normalise_scores(fixture.scored(spark, sf_dir)).select("id", "ml_anomaly_score")


@query("detection_summary", f"""
WITH {oracle.triage()}
SELECT count(*) AS records, count(*) FILTER (WHERE known_rule_violation) AS rule_violations,
  count(*) FILTER (WHERE ml_anomaly_flag) AS ml_anomalies FROM triage""")
def detection_summary(spark, sf_dir):
    return detection.detection_summary(detection.live_flags(fixture.scored(spark, sf_dir), fixture.CONTAMINATION))


@query("root_cause", f"WITH {oracle.GOLD} SELECT id, root_cause_message FROM gold")
def root_cause(spark, sf_dir):
    return fixture.triage_rows(spark, sf_dir).select("id", "root_cause_message")


def _forest_input(spark, sf_dir):
    rows = detection.with_features(star_schema.filings(spark, sf_dir)).select(
        "id", "revenue_growth", "operating_cash_flow", "revenue_growth_norm", "operating_cash_flow_norm",
        forest.feature_vector(medallion.LIVE_FEATURES).alias("vector"))
    return materialize(rows, "features")  # the fit reads it several times


def _scored(spark, sf_dir):
    scored, model = forest.fit_and_score(_forest_input(spark, sf_dir), "id", "vector")
    return materialize(scored, "scored"), model


@query("iforest_trees")
def iforest_trees(spark, sf_dir):
    """R2: the nodes of the fitted trees."""
    return forest.fit(_forest_input(spark, sf_dir), "id", "vector")


@query("iforest_scores")
def iforest_scores(spark, sf_dir):
    scored, _ = forest.fit_and_score(_forest_input(spark, sf_dir), "id", "vector")
    return scored.select("id", "ml_raw_score")


@query("iforest_flags")
def iforest_flags(spark, sf_dir):
    """R6 with messages: the live detector end to end."""
    scored, _ = _scored(spark, sf_dir)
    return explain.with_root_cause(detection.live_flags(scored, fixture.CONTAMINATION)).select(
        "id", "known_rule_violation", "ml_anomaly_flag", "ml_anomaly_score", "root_cause_message")


@query("iforest_live_check", f"""
WITH {oracle.FILINGS}
SELECT count(*) AS records, count(*) FILTER (WHERE {oracle.RULE}) AS violations, true AS share_kept, 0::BIGINT AS flagged_below_unflagged,
  0::BIGINT AS scores_out_of_range, 0::BIGINT AS flags_without_message, 0::BIGINT AS messages_without_flag FROM filings""")
def iforest_live_check(spark, sf_dir):
    """What must hold for the live composite over all filings, whatever forest was fitted.

    The rule doesn't depend on the model; the flagged share follows the contamination up to equal scores; no unflagged record
    scores above a flagged one; exactly the records with a flag have a message.
    """
    scored, _ = _scored(spark, sf_dir)
    told = materialize(explain.with_root_cause(detection.live_flags(scored, fixture.CONTAMINATION)), "live-flags")
    score, flag = F.col("ml_anomaly_score"), F.col("ml_anomaly_flag")
    # Scores are rounded, so the first flagged and the last unflagged record may show the same one.
    least = told.filter(flag).agg(F.min(score)).scalar()
    equal = told.join(told.filter(flag).agg(F.max("ml_raw_score").alias("at")), F.col("ml_raw_score") == F.col("at"), "left_semi")
    either = F.col("known_rule_violation") | flag
    allowed = fixture.CONTAMINATION * F.count("*")
    return told.agg(
        F.count("*").alias("records"), F.count_if("known_rule_violation").alias("violations"),
        ((F.count_if(flag) <= allowed + 1) & (F.count_if(flag) + equal.agg(F.count("*")).scalar() >= allowed - 1)).alias("share_kept"),
        F.count_if(~flag & (score > least)).alias("flagged_below_unflagged"),
        F.count_if(score.isNull() | (score < 0) | (score > 1)).alias("scores_out_of_range"),
        F.count_if(either & F.col("root_cause_message").isNull()).alias("flags_without_message"),
        F.count_if(~either & F.col("root_cause_message").isNotNull()).alias("messages_without_flag"))


@query("iforest_depths")
def iforest_depths(spark, sf_dir):
    """X12 for every flagged record."""
    scored, model = _scored(spark, sf_dir)
    flagged = detection.flag_below_quantile(scored, contamination=0.01).filter("ml_anomaly_flag")
    return forest.tree_depths(flagged, "id", model, "vector")


@query("iforest_check", """
SELECT count(*) AS records, 0::BIGINT AS without_score, 0::BIGINT AS out_of_range, 150::BIGINT AS trees, true AS nodes_in_bounds,
  true AS flagged_share_kept, 0::BIGINT AS depths_that_differ, 0::BIGINT AS scores_that_depend_on_partitions FROM orders""")
def iforest_check(spark, sf_dir):
    """What must hold for any forest over all filings.

    The flagged share follows the contamination up to equal scores; the mean depth over the trees gives each score back;
    the model and the scores don't depend on how the rows are dealt.
    """
    rows = _forest_input(spark, sf_dir)
    scored, model = forest.fit_and_score(rows, "id", "vector")
    scored = materialize(scored, "scored")
    dealt, _ = forest.fit_and_score(rows.repartition(7, "revenue_growth"), "id", "vector")
    both = scored.select("id", F.col("ml_raw_score").alias("one")).join(dealt.select("id", F.col("ml_raw_score").alias("two")), "id")
    mean = F.aggregate("depths", F.lit(0.0), lambda a, x: a + x) / F.size("depths")
    near = F.abs(F.col("ml_raw_score") + F.pow(F.lit(2.0), -mean / model.scale)) <= 1e-9
    back = forest.depths(scored, model, "vector").filter(~F.coalesce(near, F.lit(False)))
    nodes = forest.fit(rows, "id", "vector").groupBy("tree").count().agg(F.count("*").alias("trees"), F.max("count").alias("most"))
    flagged = detection.flag_below_quantile(scored, contamination=0.08)
    wanted = detection.quantile(scored, "ml_raw_score", 0.08)
    low = wanted.scalar()
    raw = F.col("ml_raw_score")
    counts = flagged.agg(
        F.count("*").alias("records"), F.count_if(raw.isNull()).alias("without_score"),
        F.count_if((raw <= -1) | (raw >= 0)).alias("out_of_range"),
        ((F.count_if("ml_anomaly_flag") <= 0.08 * F.count("*") + 1) & (F.count_if(raw <= low) >= 0.08 * F.count("*") - 1)).alias("flagged_share_kept"))
    return counts.select(
        "records", "without_score", "out_of_range", nodes.select("trees").scalar().alias("trees"),
        (nodes.select("most").scalar() <= 2 * 256 - 1).alias("nodes_in_bounds"), "flagged_share_kept",
        back.agg(F.count("*")).scalar().alias("depths_that_differ"),
        both.filter("one != two").agg(F.count("*")).scalar().alias("scores_that_depend_on_partitions"))


@query("iforest_contributions", """
SELECT count(*) + 2 AS records, 0::BIGINT AS sums_that_differ, 2::BIGINT AS planted_found, true AS flagged_are_shallower FROM orders""")
def iforest_contributions(spark, sf_dir):
    """F17, T8 from the model: contributions add up to the difference in depth; of two planted records each leads by its own feature."""
    rows = _forest_input(spark, sf_dir).select("id", "vector")
    mean = rows.agg(F.avg(F.col("vector")[0]).alias("a"), F.avg(F.col("vector")[1]).alias("b"), F.max(F.abs(F.col("vector")[0])).alias("x"),
                    F.max(F.abs(F.col("vector")[1])).alias("y"))
    planted = mean.select(F.explode(F.array(
        F.struct(F.lit(medallion.LIVE_FEATURES[0]).alias("id"), F.array(F.col("x") * 3 + 1, F.col("b")).alias("vector")),
        F.struct(F.lit(medallion.LIVE_FEATURES[1]).alias("id"), F.array(F.col("a"), F.col("y") * 3 + 1).alias("vector")))).alias("r"))
    rows = materialize(rows.unionByName(planted.select("r.id", "r.vector")), "planted")
    scored, model = forest.fit_and_score(rows, "id", "vector")
    told = materialize(forest.contributions(scored, model, "vector", medallion.LIVE_FEATURES), "contributions")
    total = F.aggregate(F.map_values("contributions"), F.lit(0.0), lambda a, x: a + x)
    depth = -F.log2(-F.col("ml_raw_score")) * model.scale
    leading = forest.leading_feature(F.col("contributions"))
    flagged = detection.flag_below_quantile(told, contamination=0.01)
    return flagged.agg(
        F.count("*").alias("records"), F.count_if(F.abs(total - (depth - model.mean_depth)) > 1e-9).alias("sums_that_differ"),
        F.count_if(F.col("id") == leading).alias("planted_found"),
        (F.max(F.when(F.col("ml_anomaly_flag"), total)) < 0).alias("flagged_are_shallower"))


@query("iforest_embeddings")
def iforest_embeddings(spark, sf_dir):
    """As many features as the vectors have."""
    vectors = star_schema.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    scored, _ = forest.fit_and_score(vectors, "id", "vector")
    scores = materialize(scored.select("id", "ml_raw_score"), "scored")
    return detection.normalise_scores(detection.flag_below_quantile(scores, contamination=0.08))


@query("iforest_features_check", """
SELECT count(*) AS records, CAST(max(len(embedding)) AS BIGINT) AS features, true AS all_features_split, 0::BIGINT AS splits_out_of_range,
  0::BIGINT AS scores_out_of_range, 0::BIGINT AS changed_by_naming, 0::BIGINT AS changed_by_constants FROM embeddings""")
def iforest_features_check(spark, sf_dir):
    """What must hold for any number of features, named or not.

    Splits use the features there are, and all of them; features picked by name give the scores of the same vector; constant
    ones after them can't split, so the ranges of the trees are those of the features that vary.
    """
    vectors = star_schema.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    vectors = materialize(vectors, "vectors")
    wide = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    scored, _ = forest.fit_and_score(vectors, "id", "vector")
    scored = materialize(scored.select("id", "ml_raw_score"), "scored")
    trees = materialize(forest.fit(vectors, "id", "vector"), "trees")
    named = vectors.select("id", *[F.col("vector")[i].alias(f"f{i}") for i in range(wide)])
    again = named.select("id", forest.feature_vector([f"f{i}" for i in range(wide)]).alias("vector"))
    again, _ = forest.fit_and_score(again, "id", "vector")
    padded = forest.fit(vectors.withColumn("vector", F.concat("vector", F.array(F.lit(1.0), F.lit(0.0)))), "id", "vector")
    raw = F.col("ml_raw_score")
    both = scored.join(again.select("id", raw.alias("again")), "id")
    split = trees.filter("left != node")  # a leaf leads to itself
    return scored.agg(
        F.count("*").alias("records"), F.lit(wide).cast("long").alias("features"),
        (split.agg(F.count_distinct("feature")).scalar() == wide).alias("all_features_split"),
        split.filter((F.col("feature") < 0) | (F.col("feature") >= wide)).agg(F.count("*")).scalar().alias("splits_out_of_range"),
        F.count_if(raw.isNull() | (raw <= -1) | (raw >= 0)).alias("scores_out_of_range"),
        both.filter(F.abs(raw - F.col("again")) > 1e-12).agg(F.count("*")).scalar().alias("changed_by_naming"),
        padded.filter((F.col("left") != F.col("node")) & (F.col("feature") >= wide)).agg(F.count("*")).scalar().alias("changed_by_constants"))


def _facts(spark, sf_dir):
    """One row per company. Filings are grouped before the cash flow is attached, so that is done once per company."""
    filed = star_schema.submissions(spark, sf_dir, growth=True).groupBy("cik").agg(
        F.max("revenue_usd").alias("revenue_usd"), F.max_by("revenue_growth", "order_key").alias("revenue_growth"),
        F.max("executive_name").alias("executive_name"))
    cash = star_schema.facts(spark, sf_dir).groupBy("cik").agg(F.max("operating_cash_flow").alias("operating_cash_flow"))
    return keyed.attach_facts(filed, cash).select(
        F.regexp_replace("cik", "^0+", "").alias("cik"), "revenue_usd", "operating_cash_flow", "revenue_growth", "executive_name")


@query("live_batch")
def live_batch(spark, sf_dir):
    """Index files to gold in one run."""
    config = medallion.LiveConfig(root=new_dir(configure(spark), "live"), run_id="run-1")
    return medallion.run_batch(spark, write_index(spark, sf_dir), _facts(spark, sf_dir), config, fixture.as_of()).gold


def _two_runs(spark, sf_dir):
    index, facts = write_index(spark, sf_dir), materialize(_facts(spark, sf_dir), "facts")
    root = new_dir(configure(spark), "live")
    results = []
    for run, years in (("run-1", "199[2-6]"), ("run-2", "{199[7-9],20*}")):
        config = medallion.LiveConfig(root=root, run_id=run, forest=forest.ForestParams(trees=20))
        results.append(medallion.run_batch(spark, f"{index}/edgar_year={years}", facts, config, fixture.as_of()))
    return results


@query("live_runs", f"""
WITH {INDEX},
facts AS (
  SELECT ltrim(cik, '0') AS cik, max(operating_cash_flow) AS cash, arg_max_null(revenue_growth, order_key) AS growth,
    max(executive_name) AS executive FROM filings GROUP BY 1),
listed AS (
  SELECT DISTINCT {_UUID} AS id, company_name, form_type, ltrim(cik, '0') AS cik, strftime(filing_date, '%Y-%m-%d') AS day,
    CASE WHEN year(filing_date) < 1997 THEN 'run-1' ELSE 'run-2' END AS run
  FROM filings WHERE form_type IN {FORMS}),
known AS (SELECT * FROM listed LEFT JOIN facts USING (cik))
SELECT 'filing' AS kind, id AS name, company_name || '|' || form_type || '|' || cik || '|' || day AS detail,
  CAST(coalesce(growth, 0) > 0.2 AND coalesce(cash, 0) < 0 AS BIGINT) AS number FROM known
UNION ALL SELECT 'audit', run, 'executive_name', count(*) FROM known WHERE executive IS NOT NULL GROUP BY run""")
def live_runs(spark, sf_dir):
    """Two runs, each over the index files of some years: what does not come from the model, and each run's own audit."""
    result = _two_runs(spark, sf_dir)[-1]
    detail = F.concat_ws("|", "company_name", "form_type", "cik", F.date_format("filing_date", "yyyy-MM-dd"))
    filings = result.gold.select(
        F.lit("filing").alias("kind"), F.col("id").alias("name"), detail.alias("detail"), F.col("known_rule_violation").cast("long").alias("number"))
    audit = result.pii_log.filter("field_name = 'executive_name'")
    return filings.unionByName(audit.select(
        F.lit("audit").alias("kind"), F.col("source_file_id").alias("name"), F.col("field_name").alias("detail"), F.col("record_count").alias("number")))


@query("run_events", f"""
WITH {INDEX},
listed AS (
  SELECT {_UUID} AS id, form_type, CASE WHEN year(filing_date) < 1997 THEN 'run-1' ELSE 'run-2' END AS run
  FROM filings WHERE form_type IN {FORMS}),
counted AS (SELECT run, form_type, count(*) AS lines, count(DISTINCT id) AS records FROM listed GROUP BY run, form_type)
SELECT run AS pipeline_run_id, form_type, 'INGEST' AS event_type, lines AS record_count FROM counted
UNION ALL SELECT run, form_type, step, records FROM counted, (VALUES ('MASK'), ('VALIDATE'), ('EXPORT')) AS steps(step)
UNION ALL SELECT 'filtered', form_type, 'MASK', records FROM counted WHERE run = 'run-2' AND form_type = '10-K'""")
def run_events(spark, sf_dir):
    """What each step of two runs has written, by form, and one filter over it. The writes have counted."""
    log = _two_runs(spark, sf_dir)[-1].events
    wanted = audit_log.query_events(log, audit_log.EventFilter("MASK", "10-K")).filter("pipeline_run_id = 'run-2'")
    columns = ["pipeline_run_id", "form_type", "event_type", "record_count"]
    return log.select(columns).unionByName(wanted.withColumn("pipeline_run_id", F.lit("filtered")).select(columns))
