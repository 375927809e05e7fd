"""The fixed-width filing index, as a batch or as a stream of files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filings_audit.operators.cleaning import TARGET_FORMS, drop_null_keys, only_forms, strip_cik

# First column (from 1) and width of each field; the last runs to the end of the line.
LAYOUT = {
    "company_name": (1, 62),
    "form_type": (63, 12),
    "cik": (75, 12),
    "date_filed": (87, 12),
    "filename": (99, None),
}
ENCODING = "ISO-8859-1"
# How the lines before the entries begin, and the titles of the columns.
HEADER = r"^\s*(Description|Last Data Received|Comments|Anonymous FTP|Cloud HTTP):|^Company Name\s+Form Type\s"
# Both .../2024/QTR1/company.gz and .../edgar_year=2024/edgar_quarter=QTR1/part.gz name their quarter.
_FOLDERS_IN_PATH = r"/(?:edgar_year=)?(\d{4}/(?:edgar_quarter=)?QTR[1-4])/[^/]+$"
_QUARTER_IN_PATH = r"/(?:edgar_year=)?(\d{4})/(?:edgar_quarter=)?(QTR[1-4])/[^/]+$"


def _cut(line: Column, start: int, width: int | None) -> Column:
    return F.trim(F.substring(line, start, width if width else 2**31 - 1 - start))


def read_lines(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """Lines and the path they came from. Spark unpacks gz and follows any Hadoop URI."""
    reader = spark.readStream if streaming else spark.read
    for name, value in {"recursiveFileLookup": "true", **options}.items():
        reader = reader.option(name, value)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("path"))


def classify_lines(lines: DataFrame) -> DataFrame:
    """S3: every line with its fields and what it is: ``blank``, ``header``, ``entry`` or ``damaged``.

    Headers are told by content, not by position, so a file may be split or joined at will. An entry has a number as its
    cik; any other line that is no header is damaged. The text source hands lines over as raw bytes, so they are
    decoded here.
    """
    fields = {name: _cut(F.col("line"), *span) for name, span in LAYOUT.items()}
    # The two folders are found once, at the short end of the path: year first, quarter last.
    folders = F.regexp_extract(F.substring_index("path", "/", -4), _FOLDERS_IN_PATH, 1)
    decoded = lines.select(F.decode(F.col("value").cast("binary"), ENCODING).alias("line"), "path", folders.alias("folders"))
    # Every header has one of these, few entries do: the expression runs on those lines alone.
    possible = F.col("line").contains(":") | F.col("line").startswith("Company Name")
    kind = (
        F.when(F.trim("line") == "", "blank")
        .when(F.col("line").startswith("---") | (possible & F.col("line").rlike(HEADER)), "header")
        .when(F.coalesce(F.col("cik").rlike(r"^\d+$"), F.lit(False)), "entry")
        .otherwise("damaged")
    )
    rows = decoded.select(
        "line",
        *[F.nullif(expr, F.lit("")).alias(name) for name, expr in fields.items()],
        F.substring("folders", 1, 4).alias("edgar_year"),
        F.substring("folders", -4, 4).alias("edgar_quarter"),
        "path",
    )
    return rows.withColumn("kind", kind)


def entries(classified: DataFrame, forms=TARGET_FORMS) -> DataFrame:
    """Typed-as-text index rows tagged with their quarter; ``forms=None`` keeps every form."""
    year = F.when(F.col("edgar_year") != "", F.col("edgar_year")).otherwise(
        F.raise_error(F.concat(F.lit("no quarter in the path "), "path")))
    rows = classified.filter("kind = 'entry'").withColumn("edgar_year", year).drop("path", "line", "kind")
    rows = drop_null_keys(rows).withColumn("cik", strip_cik(F.col("cik")))
    return only_forms(rows, forms) if forms else rows


def parse_lines(lines: DataFrame, forms=TARGET_FORMS) -> DataFrame:
    return entries(classify_lines(lines), forms)


def damaged_lines(classified: DataFrame) -> DataFrame:
    """S3: lines that can be no header and have no number as their cik, as they were found."""
    return classified.filter("kind = 'damaged'").select("line", "cik", "path", "edgar_year", "edgar_quarter")


def read_index(spark: SparkSession, path: str, forms=TARGET_FORMS, partitions: int | None = None) -> DataFrame:
    """Index rows under ``path``. A gz file is one task; ``partitions`` spreads the rows for later stages."""
    lines = read_lines(spark, path)
    return parse_lines(lines.repartition(partitions) if partitions else lines, forms)


def quarters(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """The quarters of the files under ``path``, from their names alone."""
    files = spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()
    return sorted({found.groups() for file in files if (found := re.search(_QUARTER_IN_PATH, file))})


def format_lines(df: DataFrame) -> DataFrame:
    """The reverse of ``parse_lines``: one ``value`` column in the index layout."""
    padded = [
        F.rpad(F.coalesce(F.col(name), F.lit("")), width, " ") if width else F.col(name)
        for name, (_, width) in LAYOUT.items()
    ]
    line = F.encode(F.concat(*padded), ENCODING).cast("string")
    return df.select(line.alias("value"), *[c for c in ("edgar_year", "edgar_quarter") if c in df.columns])
