"""pricelake: Spark-native cleaning and market analytics for commodity price records.

Every function below takes and returns DataFrames; nothing runs until an
action or a write.
"""

from pricelake.operators.arbitrage import arbitrage_signal, daily_prices, national_average
from pricelake.operators.clean import clean_audit, clean_records, clean_with_observation
from pricelake.operators.feeds import arbitrage_matrix, state_labels, volatility_feed
from pricelake.operators.ingest import pending_partitions
from pricelake.operators.msp import msp_compliance_monthly, msp_frame, msp_violations
from pricelake.operators.regions import region_map_frame, region_rename, region_summary, unmatched_regions
from pricelake.operators.shocks import price_shocks
from pricelake.operators.summaries import (
    all_states_summary,
    dataset_profile,
    market_inefficiency,
    price_volatility,
    top_commodities,
    top_states,
)
from pricelake.operators.trends import monthly_price_by_commodity, monthly_price_trend, trailing_window
from pricelake.schema import CLEAN_SCHEMA, RAW_SCHEMA, Config
from pricelake.session import build_session
from pricelake.sources.csv import land_raw_csv, read_raw_csv, read_raw_csv_with_corrupt
from pricelake.sources.geo import region_names, unnamed_features
from pricelake.sources.pages import flatten_pages, split_pages
from pricelake.sources.parquet import read_anchor, read_processed, register_view, write_processed

__all__ = [
    "CLEAN_SCHEMA",
    "Config",
    "RAW_SCHEMA",
    "all_states_summary",
    "arbitrage_matrix",
    "arbitrage_signal",
    "build_session",
    "clean_audit",
    "clean_records",
    "clean_with_observation",
    "daily_prices",
    "dataset_profile",
    "flatten_pages",
    "land_raw_csv",
    "market_inefficiency",
    "monthly_price_by_commodity",
    "monthly_price_trend",
    "msp_compliance_monthly",
    "msp_frame",
    "msp_violations",
    "national_average",
    "pending_partitions",
    "price_shocks",
    "price_volatility",
    "read_anchor",
    "read_processed",
    "read_raw_csv",
    "read_raw_csv_with_corrupt",
    "region_map_frame",
    "region_names",
    "region_rename",
    "region_summary",
    "register_view",
    "split_pages",
    "state_labels",
    "top_commodities",
    "top_states",
    "trailing_window",
    "unmatched_regions",
    "unnamed_features",
    "volatility_feed",
    "write_processed",
]
