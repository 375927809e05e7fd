"""Structured Streaming jobs. Each drains what is there and stops, so it can be scheduled or left running."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filings_audit.operators import forest as forest_ops
from filings_audit.operators import masking, models
from filings_audit.operators.keyed import latest_per_key
from filings_audit.operators.masking import MaskingConfig
from filings_audit.schemas import PII_LOG
from filings_audit.session import path_exists
from filings_audit.sinks import gold
from filings_audit.sources import index_files
from filings_audit.sources.tables import read_or_empty


def drain(writer, path: str, checkpoint: str) -> None:
    """Run a streaming write over everything available."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (query.start(path) if path else query.start()).awaitTermination()


def ingest_index(
    spark: SparkSession, index_path: str, out: str, checkpoint: str,
    forms=index_files.TARGET_FORMS, files_per_batch: int = 1000,
) -> None:
    """ST1: new index files to bronze. Each file is read once, also after a restart."""
    lines = index_files.read_lines(spark, index_path, streaming=True, maxFilesPerTrigger=files_per_batch)
    rows = index_files.parse_lines(lines, forms)
    drain(rows.writeStream.format("parquet").partitionBy("edgar_year", "edgar_quarter"), out, checkpoint)


def mask_stream(
    stream: DataFrame, out: str, audit: str, checkpoint: str, source: str, as_of: Column,
    config: MaskingConfig = MaskingConfig(),
) -> None:
    """ST2: masked rows and their audit, one folder per micro-batch, so that a replayed batch replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        target = f"{out}/epoch={epoch}"
        masking.mask(batch, config).write.mode("overwrite").parquet(target)
        stored = batch.sparkSession.read.parquet(target)
        entries = masking.audit_entries(stored, f"{source}:{epoch}", as_of, config.mode)
        entries.write.mode("overwrite").parquet(f"{audit}/epoch={epoch}")

    drain(stream.writeStream.foreachBatch(write), "", checkpoint)


def read_stream_audit(spark: SparkSession, audit: str) -> DataFrame:
    return read_or_empty(spark, audit, PII_LOG).select(*PII_LOG.names)


def upsert_stream(stream: DataFrame, root: str, checkpoint: str, as_of: Column | None = None) -> None:
    """ST3: micro-batches into gold. Ids make a replay harmless."""

    def write(batch: DataFrame, _epoch: int) -> None:
        gold.upsert(batch, root, as_of)

    drain(stream.writeStream.foreachBatch(write), "", checkpoint)


def score_stream(
    stream: DataFrame, trees: DataFrame, vector: Column, out: str, checkpoint: str,
    params: forest_ops.ForestParams = forest_ops.ForestParams(),
) -> None:
    """ST4: score new rows with a stored model. The model is read once, when the job starts."""
    model = forest_ops.Forest.collect(trees, params.sample_size)
    drain(forest_ops.score(stream, model, vector).writeStream.format("parquet"), out, checkpoint)


_CHOICE = T.StructType([T.StructField("model_version", T.LongType()), T.StructField("epoch", T.LongType())])


def score_by_newest(stream: DataFrame, models_root: str, vector: Column, out: str, checkpoint: str) -> None:
    """ST4 with a model that may change: each micro-batch takes the newest fit that is stored when it begins, so a job picks
    up a new one without a restart, and each row names the ``model_version`` that scored it.

    The choice is stored before the batch is scored: a batch that is replayed keeps its model and replaces its own rows.
    Without any model the stream stops and its rows wait.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, epoch: int) -> None:
        chosen = read_or_empty(spark, f"{out}/models", _CHOICE).filter(F.col("epoch") == epoch).first()
        version = chosen.model_version if chosen else models.newest(spark, models_root)
        if version is None:
            raise LookupError(f"no model is stored below {models_root}")
        if not chosen:
            row = spark.createDataFrame([(version,)], "model_version long")
            row.coalesce(1).write.mode("overwrite").parquet(f"{out}/models/epoch={epoch}")
        scored = forest_ops.score(batch, models.load(spark, models_root, version), vector)
        scored.withColumn("model_version", F.lit(version).cast("long")).write.mode("overwrite").parquet(f"{out}/rows/epoch={epoch}")

    drain(stream.writeStream.foreachBatch(write), "", checkpoint)


def read_scored(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """What ``score_by_newest`` has scored so far; ``schema`` is that of the stream. ``epoch`` is the micro-batch."""
    extra = [("ml_raw_score", T.DoubleType()), ("model_version", T.LongType()), ("epoch", T.LongType())]
    return read_or_empty(spark, f"{out}/rows", T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in extra]]))


def deduplicate_stream(
    stream: DataFrame, key: list[str], time: str, out: str, checkpoint: str, days: int = 1
) -> None:
    """ST5: one row of each key and day of ``time``; the first that arrives stays, however late it is.

    Rows in time, no more than ``days`` older than the newest row of earlier micro-batches, pass through a state store that
    forgets a key when the watermark has passed it; a day of a key is over by then. Late rows, and rows without time,
    are compared with the stored rows of their own days instead, so nothing is lost; a micro-batch without any reads no
    stored row. Repeats within a batch go first, in every map task before the shuffle, so a key that fills a third of
    the stream costs one row per task. A replayed batch replaces its own folders.
    """
    if days < 1:
        raise ValueError("a key must be remembered for a day at least")
    spark = stream.sparkSession
    names, moment = [*key, "__day"], F.unix_micros(F.col(time).cast("timestamp"))

    def put(rows: DataFrame, path: str, *folders: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*folders).parquet(path)

    def split(batch: DataFrame, epoch: int) -> None:
        seen = read_or_empty(spark, f"{out}/newest", _NEWEST).filter(F.col("__epoch") < epoch)
        newest = seen.agg(F.max("moment")).first()[0]  # one number per micro-batch
        late = moment <= newest - days * 86_400_000_000 if newest is not None else F.lit(False)
        rows = batch.withColumn("__day", F.coalesce(F.to_date(time).cast("string"), F.lit("none")))
        single = latest_per_key(rows, names, F.asc(time), *[F.asc(c) for c in batch.columns if c not in (*key, time)])
        single = single.withColumns({"__late": F.coalesce(late, F.lit(True)) | F.col(time).isNull(), "__epoch": F.lit(epoch).cast("long")})
        met = Observation()
        put(single.observe(met, F.count_if("__late").alias("late"), F.max(moment).alias("newest")), f"{out}/arrived", "__late", "__epoch", "__day")
        if met.get["late"]:
            arrived = read_or_empty(spark, f"{out}/arrived", _stored(batch.schema, "__late"))
            fresh = arrived.filter(F.col("__late") & (F.col("__epoch") == epoch)).drop("__late")
            wanted = [r["__day"] for r in fresh.select("__day").distinct().collect()]  # calendar days
            before = arrived.filter(~F.col("__late") & (F.col("__epoch") <= epoch)).select(*names)
            stored = _late(spark, out, batch.schema).filter(F.col("__epoch") != epoch).select(*names)
            put(_without(fresh, before.unionByName(stored).filter(F.col("__day").isin(wanted)), names), f"{out}/late", "__epoch", "__day")
        row = spark.createDataFrame([(epoch, met.get["newest"])], _NEWEST)
        put(row, f"{out}/newest", "__epoch")

    def keep(batch: DataFrame, epoch: int) -> None:
        rows = batch.drop("__epoch").withColumn("__epoch", F.lit(epoch).cast("long"))
        if path_exists(spark, f"{out}/late"):  # a late row may have come before the first in time
            rows = _without(rows, _late(spark, out, stream.schema), names)
        put(rows, f"{out}/kept", "__epoch", "__day")

    drain(stream.writeStream.foreachBatch(split), "", f"{checkpoint}/split")
    if path_exists(spark, f"{out}/arrived/__late=false"):
        source = spark.readStream.schema(_stored(stream.schema)).option("maxFilesPerTrigger", 1000)
        in_time = source.parquet(f"{out}/arrived/__late=false").withWatermark(time, f"{days} days")
        drain(in_time.dropDuplicatesWithinWatermark(names).writeStream.foreachBatch(keep), "", f"{checkpoint}/state")


_NEWEST = T.StructType([T.StructField("__epoch", T.LongType()), T.StructField("moment", T.LongType())])


def _stored(schema: T.StructType, *flags: str) -> T.StructType:
    extra = [T.StructField("__day", T.StringType()), T.StructField("__epoch", T.LongType())]
    return T.StructType([*schema.fields, *extra, *(T.StructField(f, T.BooleanType()) for f in flags)])


def _without(rows: DataFrame, known: DataFrame, names: list[str]) -> DataFrame:
    other = known.select(*[F.col(c).alias(f"__known{i}") for i, c in enumerate(names)])
    same = [rows[c].eqNullSafe(other[f"__known{i}"]) for i, c in enumerate(names)]
    return rows.join(other, same, "left_anti")


def _late(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(spark, f"{out}/late", _stored(schema))


def read_deduplicated(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """What ``deduplicate_stream`` has kept so far."""
    kept = read_or_empty(spark, f"{out}/kept", _stored(schema))
    return kept.unionByName(_late(spark, out, schema)).select(*schema.names)
