"""Incremental landing -> processed table with Structured Streaming.

The file source remembers which CSV files it has committed in the checkpoint,
so re-running picks up only files that arrived since the last run. Each batch
is cleaned and audited like the batch job and written straight into the
partitioned table that the batch job writes as well, under a name of its own.
A batch that died is repeated by Spark and then replaces itself, so no row is
lost or doubled.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pricelake.operators.clean import clean_with_observation, observed_audit
from pricelake.schema import Config
from pricelake.session import path_exists
from pricelake.sources.csv import RAW_SCHEMA_WITH_CORRUPT, csv_options, split_malformed
from pricelake.sources.parquet import write_processed


def raw_csv_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of every ``*.csv`` file below ``landing``, read as the batch job reads them."""
    reader = spark.readStream.schema(RAW_SCHEMA_WITH_CORRUPT).options(**csv_options())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(landing)


def batch_name(spark: SparkSession, checkpoint: str, batch: int) -> str:
    """The name of a stream's batch in the table: that of its query, which a new checkpoint changes, and the batch's number."""
    metadata = f"{checkpoint.rstrip('/')}/metadata"
    query = json.loads(spark.read.text(metadata, wholetext=True).first()["value"])["id"] if path_exists(spark, metadata) else checkpoint
    return f"stream-{hashlib.sha1(query.encode()).hexdigest()[:16]}-{batch}"


def land_batch(raw: DataFrame, batch: int, processed: str, checkpoint: str, cfg: Config, quarantine: str | None = None) -> dict:
    """Clean one batch of raw rows into the table; repeating a batch adds nothing. Returns the batch's audit counts.

    Table, quarantine and audit are written in this order and each replaces what the same batch left there; the audit
    file marks the batch as finished.
    """
    spark = raw.sparkSession
    audit = f"{checkpoint.rstrip('/')}/audit/batch={batch}"
    if not path_exists(spark, f"{audit}/_SUCCESS"):
        cleaned, seen = clean_with_observation(raw, cfg, f"batch-{batch}")
        write_processed(cleaned, processed, mode="append", batch=batch_name(spark, checkpoint, batch))
        if quarantine:
            split_malformed(raw)[1].write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={batch}")
        spark.createDataFrame([(json.dumps(observed_audit(seen, raw, cfg)),)], "value string").coalesce(1).write.mode("overwrite").text(audit)
    return json.loads(spark.read.text(audit).first()["value"])


def start_clean_stream(
    spark: SparkSession,
    landing: str,
    processed: str,
    checkpoint: str,
    cfg: Config,
    max_files_per_trigger: int | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Clean every new landed file and add it to the partitioned Parquet table.

    ``trigger(availableNow=True)``: process everything present now (in as many
    batches as ``maxFilesPerTrigger`` allows), then stop.
    """

    def each(batch_df: DataFrame, batch: int) -> None:
        land_batch(batch_df, batch, processed, checkpoint, cfg, quarantine)

    return (
        raw_csv_stream(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_clean_stream(spark: SparkSession, landing: str, processed: str, checkpoint: str, cfg: Config, **kw) -> dict:
    """Run :func:`start_clean_stream` to completion; audit counts summed over all batches of the checkpoint."""
    q = start_clean_stream(spark, landing, processed, checkpoint, cfg, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    totals: dict = {}
    audits = f"{checkpoint.rstrip('/')}/audit"
    if path_exists(spark, audits):
        # One short line per batch.
        for row in spark.read.option("recursiveFileLookup", "true").text(audits).toLocalIterator():
            for k, v in json.loads(row["value"]).items():
                totals[k] = totals.get(k, 0) + (v or 0)
    return totals
