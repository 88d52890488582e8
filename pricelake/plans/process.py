"""Batch job: landed raw CSV -> cleaned, partitioned Parquet table (+ audit, + quarantine)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from pricelake.operators.clean import clean_with_observation, observed_audit
from pricelake.schema import Config
from pricelake.sources.csv import read_raw_csv_with_corrupt, split_malformed
from pricelake.sources.parquet import write_processed


@dataclass
class ProcessResult:
    processed_path: str
    metrics: dict

    @property
    def dropped_pct(self) -> float:
        raw = self.metrics.get("raw_count", 0)
        return 100.0 * (raw - self.metrics.get("kept", 0)) / max(raw, 1)


def run_process(
    spark: SparkSession,
    raw_path: str,
    processed_path: str,
    cfg: Config,
    quarantine_path: str | None = None,
    sample_fraction: float | None = None,
    seed: int = 42,
    dynamic_overwrite: bool = False,
) -> ProcessResult:
    """Clean every landed CSV row and write the processed table.

    The audit counts (raw rows, rows per reject reason, kept rows, modal price
    outside [min, max]) are observed during the write itself -- one scan of
    the raw files. Malformed rows are optionally written to
    ``quarantine_path`` with their raw text (a second, filtered scan).

    ``sample_fraction`` keeps a seeded random share of the rows for a smoke
    run; it must then not write over a full table, so the caller names a
    separate output.
    """
    raw = read_raw_csv_with_corrupt(spark, raw_path)
    if sample_fraction is not None:
        raw = raw.sample(fraction=sample_fraction, seed=seed)
    cleaned, obs = clean_with_observation(raw, cfg)
    write_processed(cleaned, processed_path, dynamic_overwrite=dynamic_overwrite)
    metrics = observed_audit(obs, raw, cfg)
    if quarantine_path:
        split_malformed(raw)[1].write.mode("overwrite").parquet(quarantine_path)
    return ProcessResult(processed_path, metrics)
