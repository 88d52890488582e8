"""Minimum-support-price checks: violations per state and commodity, and monthly compliance."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.constants import MSP_2024
from pricelake.functions import normalise, round_half_up


def msp_frame(spark: SparkSession, pairs: Iterable[tuple[str, float]] = MSP_2024) -> DataFrame:
    """(commodity, msp) with the commodity normalised like cleaned data (``Tur (Arhar)`` -> ``Tur (arhar)``)."""
    raw = spark.createDataFrame([(c, float(v)) for c, v in pairs], "commodity string, msp double")
    return raw.select(normalise("commodity").alias("commodity"), "msp")


def _with_msp(df: DataFrame, msp: DataFrame) -> DataFrame:
    # No hint: Catalyst broadcasts a list it knows to be small and joins any other by shuffle.
    m = msp.select(normalise("commodity").alias("commodity"), "msp")
    return df.filter(F.col("modal_price") > 0).join(m, "commodity", "inner").withColumn(
        "_below", F.col("modal_price") < F.col("msp")
    )


def msp_violations(df: DataFrame, msp: DataFrame) -> DataFrame:
    """Per (state, commodity) with a reference price: rows, violations, share, mean shortfall."""
    j = _with_msp(df, msp)
    viol = F.count_if("_below")
    return (
        j.groupBy("state", "commodity", "msp")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            viol.alias("violations"),
            round_half_up(viol * F.lit(100.0) / F.count(F.lit(1))).alias("violation_pct"),
            round_half_up(F.avg(F.when(F.col("_below"), F.col("msp") - F.col("modal_price")))).alias("avg_shortfall"),
        )
        .orderBy(F.desc("violation_pct"), F.asc_nulls_first("state"), F.asc("commodity"))
    )


def msp_compliance_monthly(df: DataFrame, msp: DataFrame) -> DataFrame:
    """Per commodity and month, the share of records priced below the reference price."""
    j = _with_msp(df, msp)
    viol = F.count_if("_below")
    return (
        j.groupBy("commodity", "year", "month")
        .agg(F.count(F.lit(1)).alias("record_count"), viol.alias("violations"))
        .select(
            "commodity",
            F.format_string("%04d-%02d", F.col("year"), F.col("month")).alias("year_month"),
            "record_count",
            "violations",
            round_half_up(F.col("violations") * F.lit(100.0) / F.col("record_count")).alias("violation_pct"),
        )
        .orderBy("commodity", "year_month")
    )
