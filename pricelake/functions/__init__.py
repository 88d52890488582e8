"""Column expressions (all built-in Spark functions, no UDFs)."""

from pricelake.functions.dates import parse_arrival_date
from pricelake.functions.labels import fixed1, money_label, pct_label
from pricelake.functions.numeric import round_half_up
from pricelake.functions.text import blank_to_null, is_blank, normalise

__all__ = [
    "blank_to_null",
    "fixed1",
    "is_blank",
    "money_label",
    "normalise",
    "parse_arrival_date",
    "pct_label",
    "round_half_up",
]
