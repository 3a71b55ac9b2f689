"""Raw tables from landing directories: each file once, nothing changed, provenance attached."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import Config, IngestSpec
from tidemark.functions.calendar import partition_month
from tidemark.streaming.rescue import SOURCE_FILE, parse_json_rescued, read_csv_rescued
from tidemark.streaming.schemas import load_or_create_schema

BATCH = "_batch_id"
PARTITION_MONTH = "_partition_date"
EVENT_DAY = "_event_date"
_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


class IngestError(RuntimeError):
    """Raised once, after every dataset had its turn."""


def add_audit_cols(df: DataFrame, run_id: str, path: str | None = None) -> DataFrame:
    """Adds _ingested_at, _source_file and _pipeline_run_id.

    ``path`` names a column that already holds the file; by default Spark's file metadata is used.
    """
    return df.withColumns({
        "_ingested_at": F.current_timestamp(),
        SOURCE_FILE: F.col(path) if path else F.col("_metadata.file_path"),
        "_pipeline_run_id": F.lit(run_id),
    })


def _with_month(df: DataFrame, paths: list[str]) -> DataFrame:
    """Adds the month that the path of a row's file stands for, worked out once per file of the batch.

    A row whose file is named differently in the list has its own path looked at.
    """
    files = df.sparkSession.createDataFrame([(p,) for p in paths], "_path string")
    months = files.select("_path", partition_month("_path").alias("_month"))
    return (
        df.join(F.broadcast(months), F.col(SOURCE_FILE) == F.col("_path"), "left")
        .withColumn(PARTITION_MONTH, F.when(F.col("_path").isNotNull(), F.col("_month")).otherwise(partition_month(SOURCE_FILE)))
        .drop("_path", "_month")
    )


def _finish(df: DataFrame, spec: IngestSpec, run_id: str, paths: list[str] | None = None) -> DataFrame:
    out = add_audit_cols(df, run_id, SOURCE_FILE)
    if spec.month_from_path:
        out = _with_month(out, paths) if paths else out.withColumn(PARTITION_MONTH, partition_month(SOURCE_FILE))
    if spec.day_from:
        # The day of the event, not of its delivery; null where the time does not parse.
        out = out.withColumn(EVENT_DAY, F.try_to_timestamp(spec.day_from).cast("date"))
    return out


def start_append(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Drains what is available into a parquet table, exactly once, then stops."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True))
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def ingest_json(spark: SparkSession, spec: IngestSpec, cfg: Config, run_id: str) -> None:
    """JSON lines: one plain streaming query, no driver work per batch.

    With ``day_from`` rows go to the directory of their own day, late ones too.
    """
    schema = load_or_create_schema(spark, spec, cfg.schema_path(spec))
    lines = (
        spark.readStream.format("text").option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", cfg.max_files_per_batch).load(spec.source)
        .select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))
    )
    rows = _finish(parse_json_rescued(lines, schema), spec, run_id)
    days = (EVENT_DAY,) if spec.day_from else ()
    start_append(rows, cfg.table_path("bronze", spec.table), cfg.checkpoint_path(spec), days).awaitTermination()


def ingest_csv(spark: SparkSession, spec: IngestSpec, cfg: Config, run_id: str) -> None:
    """CSV: the stream discovers files; each batch reads its files grouped by header.

    Spark binds CSV columns by position, so files must be told apart by header before they are
    read. A batch overwrites its own ``_batch_id`` directory, hence repeating it changes nothing.
    """
    schema = load_or_create_schema(spark, spec, cfg.schema_path(spec))
    table = cfg.table_path("bronze", spec.table)
    # Only paths are selected, so file contents are not read here.
    files = (
        spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", cfg.max_files_per_batch).load(spec.source).select("path")
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        # At most max_files_per_batch names.
        paths = sorted(row.path for row in batch.collect())
        if not paths:
            return
        rows = _finish(read_csv_rescued(batch.sparkSession, paths, schema), spec, run_id, paths)
        writer = rows.write.mode("overwrite")
        if spec.month_from_path:
            writer = writer.partitionBy(PARTITION_MONTH)
        writer.parquet(f"{table}/{BATCH}={batch_id}")

    (files.writeStream.foreachBatch(load).option("checkpointLocation", cfg.checkpoint_path(spec))
     .trigger(availableNow=True).start().awaitTermination())


def ingest(spark: SparkSession, spec: IngestSpec, cfg: Config, run_id: str) -> None:
    if spec.fmt == "csv":
        ingest_csv(spark, spec, cfg, run_id)
    elif spec.fmt == "json":
        ingest_json(spark, spec, cfg, run_id)
    else:
        raise ValueError(f"{spec.name}: unknown format {spec.fmt!r}")


def bronze(spark: SparkSession, spec: IngestSpec, cfg: Config) -> DataFrame:
    """The raw table of a dataset."""
    # Months such as 2024-01 must stay text.
    path = cfg.table_path("bronze", spec.table)
    df = spark.read.parquet(path)
    return df.withColumn(PARTITION_MONTH, F.col(PARTITION_MONTH).cast("string")) if PARTITION_MONTH in df.columns else df


def ingest_all(spark: SparkSession, cfg: Config, run_id: str | None = None, strict: bool = True) -> DataFrame:
    """Ingests every dataset in order and returns (dataset, status, error).

    A failure does not stop the others; with ``strict`` it is raised when all have run.
    """
    run_id = run_id or f"local-{uuid.uuid4()}"
    outcome: list[tuple[str, str, str | None]] = []
    causes: list[Exception] = []
    for spec in cfg.specs:
        try:
            ingest(spark, spec, cfg, run_id)
            outcome.append((spec.name, "OK", None))
        except Exception as error:  # isolation is the point: the next dataset must still run
            causes.append(error)
            outcome.append((spec.name, "FAILED", str(error) or type(error).__name__))
    failed = [f"{name} ({error})" for name, status, error in outcome if status == "FAILED"]
    if failed and strict:
        raise IngestError(f"ingestion {run_id} completed with failures: {'; '.join(failed)}") from ExceptionGroup("ingestion", causes)
    return spark.createDataFrame(outcome, "dataset string, status string, error string")
