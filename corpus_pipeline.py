"""The corpus pipeline: documents in, a mixed training order out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the driver,
or ``run``, writes it as Parquet and reads it back as the next one's ``docs``.
All but the last return the columns of ``documents``. When a stage begins, the scratch
tables of the one before are dropped, so ``docs`` must be a table that is written.

- toxicity: documents that the model predicts toxic go.
- minhash: one document of each near-duplicate component stays.
- suffix: strings of 200 bytes that start anywhere else are cut out of the texts.
- decontamination: documents that a benchmark item leaks into go.
- mixing: every document gets its place in the mix of sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import decontam, minhash, mixing, suffix, toxicity
from pricelake.llm.common import keep_where, table, written
from pricelake.session import drop_paths, scratch_scope

_held: list[str] = []  # tables that the last stage's result reads


def _staged(stage):
    """``stage`` with its scratch tables dropped when the next stage begins: its result is a table by then."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_paths(spark, _held)
        with scratch_scope(spark, drop=False) as paths:
            out = stage(spark, docs, sf_dir)
        _held.extend(paths)
        return out

    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return keep_where(docs, lambda: lambda texts: (model.scores(texts) < 0.5).tolist())


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = suffix.without_repeats(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", _staged(toxicity_stage)),
    ("minhash", _staged(minhash_stage)),
    ("suffix", _staged(suffix_stage)),
    ("decontamination", _staged(decontamination_stage)),
    ("mixing", _staged(mixing_stage)),
]

# A trained model, suffix sorts and a schedule are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
