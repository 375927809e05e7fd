"""Sources, projections, typing, keyed joins and identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from filings_audit.functions import identity, scores
from filings_audit.operators import cleaning, keyed
from filings_audit.operators.masking import MaskingConfig
from filings_audit.plans import medallion
from filings_audit.schemas import RAW
from filings_audit.session import configure, file_system, new_dir
from filings_audit.sinks import layers
from filings_audit.sources import index_files, star_schema, storage, tables
from filings_audit.workload import oracle
from filings_audit.workload.fixture import as_of
from filings_audit.workload.registry import query

INDEX = oracle.FILINGS + """,
index_rows AS (
  SELECT company_name, form_type, cik, strftime(filing_date, '%Y-%m-%d') AS date_filed,
    'edgar/data/' || id || '.txt' AS filename,
    strftime(filing_date, '%Y') AS edgar_year, 'QTR' || quarter(filing_date) AS edgar_quarter
  FROM filings)"""
HEADS = ["Description:           Index of filings", "Company Name".ljust(62) + "Form Type".ljust(12) + "CIK", "-" * 120, " "]
FORMS = oracle.in_list(cleaning.TARGET_FORMS)
SALT = MaskingConfig().salt
_DAY = "strftime(filing_date, '%Y-%m-%d')"


def _day(name: str = "filing_date"):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


@query("minimize_columns", f"""
WITH {oracle.FILINGS}
SELECT id AS filing_id, form_type, {_DAY} AS filing_date, company_name, cik, executive_name,
  CASE WHEN executive_name IS NOT NULL THEN 'Officer' END AS executive_title,
  CAST(revenue_usd AS DOUBLE) AS revenue_usd FROM filings""")
def minimize_columns(spark, sf_dir):
    slim = cleaning.minimize_columns(star_schema.raw_records(spark, sf_dir))
    return slim.withColumns({"filing_date": _day(), "revenue_usd": F.col("revenue_usd").cast("double")})


@query("triage_names", f"""
WITH {oracle.FILINGS}
SELECT id, company_name, CAST(revenue_usd AS DOUBLE) AS operating_cash_flow FROM filings""")
def triage_names(spark, sf_dir):
    renamed = cleaning.to_triage_names(star_schema.raw_records(spark, sf_dir))
    return renamed.select("id", "company_name", F.col("operating_cash_flow").cast("double").alias("operating_cash_flow"))


@query("form_filter", f"""
WITH {INDEX}
SELECT company_name, form_type, cik, date_filed, filename FROM index_rows WHERE form_type IN {FORMS}""")
def form_filter(spark, sf_dir):
    return cleaning.only_forms(star_schema.index_rows(spark, sf_dir)).drop("edgar_year", "edgar_quarter")


@query("drop_null_keys", f"""
WITH {oracle.FILINGS}
SELECT id, executive_name AS company_name, cik FROM filings WHERE executive_name IS NOT NULL AND cik IS NOT NULL""")
def drop_null_keys(spark, sf_dir):
    # Executives are the one name that is missing in places.
    rows = star_schema.submissions(spark, sf_dir).select("id", F.col("executive_name").alias("company_name"), "cik")
    return cleaning.drop_null_keys(rows)


@query("record_cap", f"""
WITH {INDEX}
SELECT cik, date_filed, filename, form_type FROM index_rows WHERE form_type IN {FORMS}
ORDER BY cik, date_filed, filename LIMIT {cleaning.RECORD_CAP}""")
def record_cap(spark, sf_dir):
    rows = cleaning.only_forms(star_schema.index_rows(spark, sf_dir))
    return cleaning.cap_records(rows.select("cik", "date_filed", "filename", "form_type"))


@query("lineage_columns", f"""
WITH {oracle.FILINGS}
SELECT id, 'sha256-v1' AS masking_version, true AS pii_masked FROM filings""")
def lineage_columns(spark, sf_dir):
    return cleaning.with_lineage(star_schema.submissions(spark, sf_dir).select("id"), as_of()).drop("ingestion_ts")


@query("lineage_struct", f"""
WITH {oracle.FILINGS}
SELECT id, 'orders' AS source, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS ingestion_ts,
  'sha256-v1' AS masking_version FROM filings""")
def lineage_struct(spark, sf_dir):
    rows = cleaning.with_lineage_struct(star_schema.submissions(spark, sf_dir), "orders", F.col("created_at"))
    return rows.select("id", "data_lineage.source",
                       F.date_format("data_lineage.ingestion_ts", "yyyy-MM-dd HH:mm:ss").alias("ingestion_ts"),
                       "data_lineage.masking_version")


@query("batch_tags", f"""
WITH {oracle.FILINGS}
SELECT id, '2024' AS edgar_year, 'QTR1' AS edgar_quarter, 'run-1' AS source_file_id FROM filings""")
def batch_tags(spark, sf_dir):
    rows = cleaning.with_batch_tags(star_schema.submissions(spark, sf_dir).select("id"), "2024", "QTR1")
    return cleaning.with_run_id(rows, "run-1")


@query("money_cents", """
SELECT event_id, CAST(CAST(CASE WHEN event_type <> 'error' THEN value / 3 END AS DECIMAL(20,2)) AS DOUBLE) AS amount
FROM events""")
def money_cents(spark, sf_dir):
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value") / 3)
    return star_schema.table(spark, sf_dir, "events").select(
        "event_id", cleaning.money(value).cast("double").alias("amount"))


@query("cik_normalise", f"""
WITH {oracle.FILINGS} SELECT id, ltrim(cik, '0') AS cik FROM filings""")
def cik_normalise(spark, sf_dir):
    padded = F.concat(F.lit("  "), "cik", F.lit(" "))
    return star_schema.submissions(spark, sf_dir).select("id", cleaning.strip_cik(padded).alias("cik"))


@query("company_default", f"""
WITH {oracle.FILINGS} SELECT id, coalesce(executive_name, 'Unknown') AS company_name FROM filings""")
def company_default(spark, sf_dir):
    spaced = F.concat(F.lit(" "), "executive_name", F.lit("  "))
    return star_schema.submissions(spark, sf_dir).select("id", cleaning.company_or_unknown(spaced).alias("company_name"))


@query("date_default", f"""
WITH {oracle.FILINGS}
SELECT id, strftime(coalesce(CASE WHEN filing_state = 'P' THEN CASE WHEN order_key % 3 = 0 THEN filing_date END
  WHEN filing_state = 'O' AND order_key % 2 = 0 THEN TRY_CAST(strftime(filing_date, '%Y-%m') || '-31' AS DATE)
  ELSE filing_date END, DATE '1900-01-01'), '%Y-%m-%d') AS filing_date FROM filings""")
def date_default(spark, sf_dir):
    state, key = F.col("filing_state"), F.col("order_key")
    dirty = (
        F.when((state == "P") & (key % 3 == 0), F.date_format("filing_date", "yyyyMMdd"))
        .when((state == "P") & (key % 3 == 1), F.date_format("filing_date", "yyyy"))
        .when(state == "P", F.lit("n/a"))
        .when((state == "O") & (key % 2 == 0), F.concat(F.date_format("filing_date", "yyyy-MM"), F.lit("-31")))
        .when((state == "O") & (key % 3 == 0), F.date_format("filing_date", "MM/dd/yyyy"))
        .when(state == "O", F.date_format("filing_date", "MMM d, yyyy"))
        .otherwise(F.date_format("filing_date", "yyyy-MM-dd"))
    )
    rows = star_schema.submissions(spark, sf_dir).select("id", cleaning.parse_date(dirty).alias("filing_date"))
    return rows.withColumn("filing_date", _day())


@query("numeric_coerce", """
SELECT event_id, CASE WHEN event_type NOT IN ('error', 'signup') AND event_id % 3 <> 0 THEN value END AS amount FROM events""")
def numeric_coerce(spark, sf_dir):
    kind = F.col("event_type")
    bad = F.element_at(F.array(*map(F.lit, ("1d", "2f", "Infinity", "-Infinity", "0x1p3"))), (F.col("event_id") % 5 + 1).cast("int"))
    dirty = F.when(kind == "error", "n/a").when(kind == "signup", "NaN").when(F.col("event_id") % 3 == 0, bad)
    dirty = dirty.otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    return star_schema.table(spark, sf_dir, "events").select("event_id", cleaning.to_number(dirty).alias("amount"))


@query("facts_join", f"""
WITH {oracle.FILINGS}
SELECT id, cik, company_name, segment, CAST(operating_cash_flow AS DOUBLE) AS operating_cash_flow FROM filings""")
def facts_join(spark, sf_dir):
    rows = keyed.attach_facts(
        star_schema.submissions(spark, sf_dir).select("id", "cik"), star_schema.facts(spark, sf_dir))
    return rows.withColumn("operating_cash_flow", F.col("operating_cash_flow").cast("double"))


@query("exec_hash", f"""
WITH {oracle.FILINGS} SELECT id, {oracle.sha256('executive_name', SALT)} AS executive_hash FROM filings""")
def exec_hash(spark, sf_dir):
    return star_schema.submissions(spark, sf_dir).select(
        "id", identity.salted_sha256(F.col("executive_name"), SALT).alias("executive_hash"))


@query("masked_join", f"""
WITH {oracle.FILINGS},
people AS (SELECT {oracle.sha256("'Exec ' || c_custkey", SALT)} AS person_hash, c_mktsegment AS person_segment FROM customer)
SELECT id, person_hash, person_segment FROM filings
JOIN people ON {oracle.sha256('executive_name', SALT)} = person_hash""")
def masked_join(spark, sf_dir):
    # Two pipelines mask the same names on their own; equal names still meet on the hash.
    left = star_schema.submissions(spark, sf_dir).select(
        "id", identity.salted_sha256(F.col("executive_name"), SALT).alias("executive_hash"))
    name = F.concat(F.lit("Exec "), F.col("c_custkey"))
    right = star_schema.table(spark, sf_dir, "customer").select(
        identity.salted_sha256(name, SALT).alias("person_hash"), F.col("c_mktsegment").alias("person_segment"))
    return keyed.join_on_masked(left, right, "executive_hash", "person_hash").drop("executive_hash")


_UUID = oracle.uuid5("ltrim(cik, '0') || ':' || strftime(filing_date, '%Y-%m-%d') || ':' || form_type")


@query("filing_uuid", f"WITH {oracle.FILINGS} SELECT id, {_UUID} AS filing_uuid FROM filings")
def filing_uuid(spark, sf_dir):
    uuid = identity.filing_uuid(cleaning.strip_cik(F.col("cik")), F.col("filing_date"), F.col("form_type"))
    return star_schema.submissions(spark, sf_dir).select("id", uuid.alias("filing_uuid"))


@query("dedupe_ids", f"""
WITH {oracle.FILINGS}, keyed AS (SELECT *, {_UUID} AS filing_uuid FROM filings),
ranked AS (SELECT *, row_number() OVER (PARTITION BY filing_uuid ORDER BY created_at DESC, order_key DESC) AS rn FROM keyed)
SELECT filing_uuid, id, CAST(revenue_usd AS DOUBLE) AS revenue_usd FROM ranked WHERE rn = 1""")
def dedupe_ids(spark, sf_dir):
    uuid = identity.filing_uuid(cleaning.strip_cik(F.col("cik")), F.col("filing_date"), F.col("form_type"))
    rows = star_schema.submissions(spark, sf_dir).withColumn("filing_uuid", uuid)
    single = keyed.latest_per_key(rows, "filing_uuid", F.desc("created_at"), F.desc("order_key"))
    return single.select("filing_uuid", "id", F.col("revenue_usd").cast("double").alias("revenue_usd"))


@query("index_scan", f"""
WITH {INDEX}
SELECT company_name, form_type, ltrim(cik, '0') AS cik, date_filed, filename, edgar_year, edgar_quarter
FROM index_rows WHERE form_type IN {FORMS}""")
def index_scan(spark, sf_dir):
    return index_files.read_index(spark, write_index(spark, sf_dir))


def write_index(spark, sf_dir, one_file: bool = False) -> str:
    """Filings as gz index files, one folder per quarter; in it as many files as suit its size, or one."""
    path = new_dir(configure(spark), "index")
    lines = index_files.format_lines(star_schema.index_rows(spark, sf_dir))
    quarter = ["edgar_year", "edgar_quarter"]
    dealt = lines.repartition(spark.sparkContext.defaultParallelism, *quarter) if one_file else lines.hint("rebalance", *quarter)
    dealt.write.partitionBy(*quarter).option("compression", "gzip").text(path)
    return path


@query("index_stored", f"""
WITH {INDEX}
SELECT 'all' AS asked, edgar_year, edgar_quarter, count(*) AS records, count(DISTINCT ltrim(cik, '0')) AS ciks, max(filename) AS last
FROM index_rows WHERE form_type IN {FORMS} GROUP BY ALL
UNION ALL SELECT 'year', edgar_year, edgar_quarter, count(*), count(DISTINCT ltrim(cik, '0')), max(filename)
FROM index_rows WHERE form_type IN {FORMS} AND edgar_year = '1996' GROUP BY ALL
UNION ALL SELECT 'quarter', edgar_year, edgar_quarter, count(*), count(DISTINCT ltrim(cik, '0')), max(filename)
FROM index_rows WHERE form_type IN {FORMS} AND edgar_quarter = 'QTR2' GROUP BY ALL""")
def index_stored(spark, sf_dir):
    """The index as storage keeps it, one gz file per quarter below a full address, read whole, by year and by quarter."""
    fs, path = file_system(spark, write_index(spark, sf_dir, one_file=True))
    root = fs.makeQualified(path).toString()  # with scheme
    parse = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for found in fs.globStatus(parse(f"{root}/edgar_year=*/edgar_quarter=*/*.gz")):
        folder = found.getPath().getParent()
        year, quarter = (x.getName().split("=")[1] for x in (folder.getParent(), folder))
        target = parse(storage.index_path(root, year, quarter))
        fs.mkdirs(target.getParent())
        fs.rename(found.getPath(), target)
    out = None
    for asked, chosen in (("all", {}), ("year", {"year": "1996"}), ("quarter", {"quarter": "QTR2"})):
        rows = index_files.read_index(spark, storage.index_path(root, **chosen)).groupBy("edgar_year", "edgar_quarter").agg(
            F.lit(asked).alias("asked"), F.count("*").alias("records"), F.count_distinct("cik").alias("ciks"), F.max("filename").alias("last"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("index_damaged", f"""
WITH {INDEX}
SELECT CASE WHEN order_key % 7 = 3 THEN 'damaged' ELSE 'entry' END AS kind, edgar_year, edgar_quarter, count(*) AS lines,
  count(DISTINCT f.id) AS filings
FROM filings f JOIN index_rows ON filename = 'edgar/data/' || f.id || '.txt' GROUP BY ALL
UNION ALL SELECT 'header', edgar_year, edgar_quarter, count(*) * 3, 0 FROM (SELECT DISTINCT edgar_year, edgar_quarter FROM index_rows) GROUP BY ALL
UNION ALL SELECT 'blank', edgar_year, edgar_quarter, count(*), 0 FROM (SELECT DISTINCT edgar_year, edgar_quarter FROM index_rows) GROUP BY ALL""")
def index_damaged(spark, sf_dir):
    """S3: every line of the index files is an entry, a header, blank, or damaged; damaged ones keep their text."""
    path = new_dir(configure(spark), "index")
    rows = star_schema.index_rows(spark, sf_dir)
    key = F.regexp_extract("filename", r"(\d+)\.txt$", 1).cast("long")
    broken = F.when(key % 7 == 3, F.concat(F.lit("x"), F.substring("cik", 2, 20))).otherwise(F.col("cik"))
    lines = index_files.format_lines(rows.withColumn("cik", broken))
    quarters = rows.select("edgar_year", "edgar_quarter").distinct()
    heads = quarters.select(F.explode(F.array(*[F.lit(x) for x in HEADS])).alias("value"), "edgar_year", "edgar_quarter")
    lines.unionByName(heads).write.partitionBy("edgar_year", "edgar_quarter").option("compression", "gzip").text(path)
    found = index_files.classify_lines(index_files.read_lines(spark, path))
    named = F.regexp_extract("line", r"edgar/data/(\d+)\.txt", 1)
    return found.groupBy("kind", "edgar_year", "edgar_quarter").agg(
        F.count("*").alias("lines"), F.count_distinct(F.nullif(named, F.lit(""))).alias("filings"))


@query("bronze_quarters", f"""
WITH {INDEX}
SELECT ltrim(cik, '0') AS cik, company_name, form_type, date_filed, filename, edgar_year, edgar_quarter
FROM index_rows""")
def bronze_quarters(spark, sf_dir):
    """K1: a second write of some quarters leaves the others alone."""
    path = new_dir(configure(spark), "bronze")
    rows = star_schema.index_rows(spark, sf_dir).withColumn("cik", cleaning.strip_cik(F.col("cik")))
    layers.write_bronze(rows, path)
    layers.write_bronze(rows.filter(F.col("edgar_quarter") == "QTR2"), path)
    return spark.read.schema(medallion.BRONZE).parquet(path).select(
        "cik", "company_name", "form_type", "date_filed", "filename", "edgar_year", "edgar_quarter")


@query("raw_source", f"""
WITH {oracle.FILINGS}
SELECT id AS filing_id, form_type, {_DAY} AS filing_date, cik, CAST(revenue_usd AS DOUBLE) AS revenue_usd,
  'filer' || cik || '@example.org' AS submitter_email FROM filings""")
def raw_source(spark, sf_dir):
    """A stored source with extra fields, read in the declared schema."""
    path = new_dir(configure(spark), "raw")
    star_schema.raw_records(spark, sf_dir).withColumn("status", F.lit("Pending")).write.json(path)
    rows = tables.filings_source(spark, "intake", intake=path, fmt="json")
    assert rows.columns == RAW.names
    return rows.select("filing_id", "form_type", _day(), "cik",
                       F.col("revenue_usd").cast("double").alias("revenue_usd"), "submitter_email")


@query("masked_layout", f"""
WITH {oracle.FILINGS}
SELECT id AS filing_id, {oracle.sha256('executive_name', SALT)} AS executive_name, form_type,
  strftime(filing_date, '%Y-%m') AS filing_month
FROM filings WHERE form_type = '10-K' AND strftime(filing_date, '%Y-%m') BETWEEN '1996-01' AND '1998-12'""")
def masked_layout(spark, sf_dir):
    """Masked output by form and month; the read back touches only the wanted folders."""
    path = new_dir(configure(spark), "masked")
    raw = star_schema.raw_records(spark, sf_dir)
    layers.write_by_form_and_month(medallion.mask_intake(raw, as_of=as_of()), path)
    schema = "filing_id string, executive_name string, form_type string, filing_month string"
    rows = spark.read.schema(schema).parquet(path)
    return rows.filter((F.col("form_type") == "10-K") & F.col("filing_month").between("1996-01", "1998-12"))


@query("scaled_cash_flow", f"""
WITH {oracle.FILINGS} SELECT id, round(coalesce(CAST(operating_cash_flow AS DOUBLE), 0) / 1e10, 9) AS scaled FROM filings""")
def scaled_cash_flow(spark, sf_dir):
    return star_schema.filings(spark, sf_dir, growth=False).select(
        "id", F.round(scores.scaled_cash_flow(F.col("operating_cash_flow")), 9).alias("scaled"))


@query("late_filing", """
WITH filed AS (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS filed FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS order_key, strftime(filed, '%Y-%m-%d') AS filed,
  datediff('day', CAST(o_orderdate AS DATE), filed) > 60 AS late
FROM orders JOIN filed ON o_orderkey = l_orderkey""")
def late_filing(spark, sf_dir):
    from filings_audit.operators.detection import late_filing as is_late

    filed = star_schema.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.to_date("l_shipdate")).alias("filed"))
    ends = star_schema.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.to_date("o_orderdate").alias("period_end"))
    rows = ends.join(filed, F.col("order_key") == F.col("l_orderkey"))
    return rows.select("order_key", _day("filed"), is_late(F.col("period_end"), F.col("filed"), 60).alias("late"))
