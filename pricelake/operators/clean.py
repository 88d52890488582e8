"""Cleaning of raw price records (critical fields, prices, dates, text, years).

Each step is a ``DataFrame -> DataFrame`` function; :func:`clean_records`
chains them into one projection and one filter, so Catalyst pushes the
predicates to the scan and the whole step runs inside one codegen stage.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pricelake.functions import blank_to_null, is_blank, normalise, parse_arrival_date
from pricelake.schema import CLEAN_COLUMNS, CORRUPT_COLUMN, CRITICAL_FIELDS, PRICE_FIELDS, TEXT_FIELDS, Config

# Reject reasons, in the order the rules are applied; a row is charged to the first rule it fails.
MALFORMED = "malformed"
MISSING_CRITICAL = "missing_critical"
INVALID_PRICE = "invalid_price"
NON_FINITE_PRICE = "non_finite_price"
BAD_DATE = "bad_date"
YEAR_OUT_OF_RANGE = "year_out_of_range"
KEPT = "kept"
REJECT_REASONS = (MALFORMED, MISSING_CRITICAL, INVALID_PRICE, NON_FINITE_PRICE, BAD_DATE, YEAR_OUT_OF_RANGE)


# ----------------------------------------------------------------------------- predicates

def critical_present() -> Column:
    """Commodity, market, arrival date and modal price are all present and non-blank."""
    cond = F.lit(True)
    for name in CRITICAL_FIELDS:
        if name in PRICE_FIELDS:
            cond = cond & F.col(name).isNotNull()
        else:
            cond = cond & ~is_blank(name)
    return cond


def prices_valid() -> Column:
    """All three prices positive and ``min <= max`` (modal may lie outside [min, max])."""
    mn, mx, md = (F.col(c).try_cast("double") for c in PRICE_FIELDS)
    return (mn > 0) & (mx > 0) & (md > 0) & (mn <= mx)


def prices_finite() -> Column:
    """NaN and +infinity pass ``> 0``; they are rejected separately.

    Spark orders NaN above +infinity, so ``x < +inf`` is false for both; -inf
    already fails ``> 0``.
    """
    cond = F.lit(True)
    for c in PRICE_FIELDS:
        cond = cond & (F.col(c).try_cast("double") < F.lit(float("inf")))
    return cond


def year_allowed(year: Column, cfg: Config) -> Column:
    """Year within [min_year, max_year], written as a set test so the date is parsed once per row."""
    return year.isin(list(range(cfg.min_year, cfg.max_year + 1)))


def reject_reason(cfg: Config, has_corrupt: bool = False) -> Column:
    """First failing rule for a raw row, null for a row that is kept."""
    parsed = parse_arrival_date("arrival_date", cfg.date_format)
    expr = (
        F.when(~critical_present(), F.lit(MISSING_CRITICAL))
        .when(~F.coalesce(prices_valid(), F.lit(False)), F.lit(INVALID_PRICE))
        .when(~prices_finite(), F.lit(NON_FINITE_PRICE))
        .when(parsed.isNull(), F.lit(BAD_DATE))
        .when(~year_allowed(F.year(parsed), cfg), F.lit(YEAR_OUT_OF_RANGE))
    )
    if has_corrupt:
        expr = F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(MALFORMED)).otherwise(expr)
    return expr


# ----------------------------------------------------------------------------- single steps

def critical_filter(df: DataFrame) -> DataFrame:
    """Drop rows with a null or blank critical field."""
    return df.filter(critical_present())


def valid_prices(df: DataFrame) -> DataFrame:
    """P2+P3: prices as double, positive, finite and ``min <= max``."""
    return df.select(
        *[F.col(c) for c in df.columns if c not in PRICE_FIELDS],
        *[F.col(c).try_cast("double").alias(c) for c in PRICE_FIELDS],
    ).select(*df.columns).filter(prices_valid() & prices_finite())


def parse_dates(df: DataFrame, fmt: str = "dd/MM/yyyy") -> DataFrame:
    """``arrival_date`` string -> date; rows that fail to parse are dropped."""
    cols = [parse_arrival_date("arrival_date", fmt).alias("arrival_date") if c == "arrival_date" else F.col(c) for c in df.columns]
    return df.select(*cols).filter(F.col("arrival_date").isNotNull())


def normalise_text(df: DataFrame) -> DataFrame:
    """Trim + initcap the six text fields; a blank state becomes null.

    A blank partition value reads back as null from a partitioned table, so
    the in-memory frame uses null too.
    """
    cols = []
    for c in df.columns:
        if c == "state":
            cols.append(blank_to_null(normalise("state")).alias("state"))
        elif c in TEXT_FIELDS:
            cols.append(normalise(c).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


# ----------------------------------------------------------------------------- whole job

def _keep(cfg: Config) -> Column:
    parsed = parse_arrival_date("arrival_date", cfg.date_format)
    return (
        critical_present()
        & F.coalesce(prices_valid(), F.lit(False))
        & prices_finite()
        & year_allowed(F.year(parsed), cfg)
    )


def _clean_projection(cfg: Config) -> list[Column]:
    parsed = parse_arrival_date("arrival_date", cfg.date_format)
    return [
        blank_to_null(normalise("state")).alias("state"),
        *[normalise(c).alias(c) for c in TEXT_FIELDS if c != "state"],
        parsed.alias("arrival_date"),
        *[F.col(c).try_cast("double").alias(c) for c in PRICE_FIELDS],
        F.year(parsed).alias("year"),
        F.month(parsed).alias("month"),
    ]


def clean_records(df: DataFrame, cfg: Config) -> DataFrame:
    """P1-P7 as one filter plus one projection; output columns ``CLEAN_COLUMNS``."""
    src = df.filter(F.col(CORRUPT_COLUMN).isNull()) if CORRUPT_COLUMN in df.columns else df
    return src.filter(_keep(cfg)).select(*_clean_projection(cfg)).select(*CLEAN_COLUMNS)


def with_reject_reason(df: DataFrame, cfg: Config) -> DataFrame:
    """Raw rows plus ``reject_reason`` (null = kept)."""
    return df.withColumn("reject_reason", reject_reason(cfg, CORRUPT_COLUMN in df.columns))


def clean_audit(df: DataFrame, cfg: Config) -> DataFrame:
    """One pass over the raw rows -> (reject_reason, record_count).

    Kept rows appear as ``kept``; the counts add up to the raw row count. The
    group key has at most seven values, so this is a map-side combined count.
    """
    tagged = with_reject_reason(df, cfg)
    return tagged.groupBy(F.coalesce(F.col("reject_reason"), F.lit(KEPT)).alias("reject_reason")).agg(
        F.count(F.lit(1)).alias("record_count")
    )


def audit_totals(audit: DataFrame) -> DataFrame:
    """Raw / clean / dropped counts and dropped percentage from an audit frame."""
    return audit.agg(
        F.sum("record_count").alias("raw_count"),
        F.coalesce(F.sum(F.when(F.col("reject_reason") == KEPT, F.col("record_count"))), F.lit(0)).cast("long").alias("clean_count"),
    ).select(
        "raw_count",
        "clean_count",
        (F.col("raw_count") - F.col("clean_count")).alias("dropped_count"),
        (F.lit(100.0) * (F.col("raw_count") - F.col("clean_count")) / F.greatest(F.col("raw_count"), F.lit(1))).alias("dropped_pct"),
    )


def clean_with_observation(df: DataFrame, cfg: Config, name: str = "clean_audit") -> tuple[DataFrame, Observation]:
    """Cleaned rows plus an :class:`Observation` that fills in the audit counts.

    The reject reason is computed once per row as a column; the counts are
    collected by the same job that consumes the cleaned frame (for example the
    Parquet write), and the kept rows are those with no reason -- the raw data
    is read once and every rule is evaluated once.
    """
    obs = Observation(name)
    tagged = df.withColumn("_reason", reject_reason(cfg, CORRUPT_COLUMN in df.columns))
    reason = F.col("_reason")
    metrics = [F.count(F.lit(1)).alias("raw_count")]
    metrics += [F.count_if(reason == F.lit(r)).alias(r) for r in REJECT_REASONS]
    metrics.append(F.count_if(reason.isNull()).alias(KEPT))
    # Warning only: modal price outside [min, max] is kept.
    outside = (F.col("modal_price") < F.col("min_price")) | (F.col("modal_price") > F.col("max_price"))
    metrics.append(F.count_if(reason.isNull() & outside).alias("modal_outside_range"))
    kept = tagged.observe(obs, *metrics).filter(reason.isNull())
    return kept.select(*_clean_projection(cfg)).select(*CLEAN_COLUMNS), obs


def observed_audit(obs: Observation, df: DataFrame, cfg: Config) -> dict[str, int]:
    """The counts of :func:`clean_with_observation` after its job has run.

    When not one row was kept, AQE replaces the finished stage by an empty
    relation and its metrics are lost; the audit of ``df`` then counts again.
    """
    try:
        return dict(obs.get)
    except Py4JJavaError:
        audit = {r["reject_reason"]: r["record_count"] for r in clean_audit(df, cfg).collect()}
        if audit.get(KEPT):
            raise
        counts = {"raw_count": sum(audit.values()), KEPT: 0, "modal_outside_range": 0}
        return counts | {r: audit.get(r, 0) for r in REJECT_REASONS}


__all__ = [
    "BAD_DATE",
    "INVALID_PRICE",
    "KEPT",
    "MALFORMED",
    "MISSING_CRITICAL",
    "NON_FINITE_PRICE",
    "REJECT_REASONS",
    "YEAR_OUT_OF_RANGE",
    "audit_totals",
    "clean_audit",
    "clean_records",
    "clean_with_observation",
    "critical_filter",
    "normalise_text",
    "observed_audit",
    "parse_dates",
    "reject_reason",
    "valid_prices",
    "with_reject_reason",
]
