"""Record layouts and run parameters shared by every stage."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT_FIELDS = ("state", "district", "market", "commodity", "variety", "grade")
PRICE_FIELDS = ("min_price", "max_price", "modal_price")
RAW_FIELDS = TEXT_FIELDS + ("arrival_date",) + PRICE_FIELDS
# Fields whose absence makes a price record useless (checked before anything else).
CRITICAL_FIELDS = ("commodity", "market", "arrival_date", "modal_price")
CLEAN_COLUMNS = RAW_FIELDS + ("year", "month")
CORRUPT_COLUMN = "_corrupt_record"

RAW_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in TEXT_FIELDS]
    + [T.StructField("arrival_date", T.StringType(), True)]
    + [T.StructField(f, T.DoubleType(), True) for f in PRICE_FIELDS]
)

CLEAN_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in TEXT_FIELDS]
    + [T.StructField("arrival_date", T.DateType(), True)]
    + [T.StructField(f, T.DoubleType(), True) for f in PRICE_FIELDS]
    + [T.StructField("year", T.IntegerType(), True), T.StructField("month", T.IntegerType(), True)]
)

# Layout of the processed table on disk: partition columns come last.
PARTITION_COLUMNS = ("year", "state")
# Innermost partition: the write that brought the rows.
BATCH_COLUMN = "ingest_batch"

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("state", T.StringType(), False),
        T.StructField("rows", T.LongType(), True),
        T.StructField("completed_at", T.TimestampType(), True),
    ]
)


def _next_year() -> int:
    return _dt.date.today().year + 1


@dataclass(frozen=True)
class Config:
    """Every knob the cleaning job and the market questions take.

    ``max_year`` defaults to next calendar year (read once, when the config is
    built) so that a test can pin the clock by passing it explicitly.
    """

    min_year: int = 2013
    max_year: int = field(default_factory=_next_year)
    date_format: str = "dd/MM/yyyy"
    trailing_months: int = 12
    top_commodities_k: int = 10
    top_states_k: int = 5
    volatility_k: int = 20
    inefficiency_k: int = 20
    arbitrage_k: int = 30
    min_records: int = 1
    # Price-shock rule: trailing window in days (ending the day before), minimum
    # number of trailing trading days, and |z| threshold.
    shock_window_days: int = 30
    shock_min_days: int = 5
    shock_z: float = 3.0
