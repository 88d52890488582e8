"""Fixed values that must equal the source system's for results to line up.

Everything below is data, not logic: names and numbers published by the
price source, kept verbatim and in their natural order.
"""

from __future__ import annotations

# --- Fixed values: state / union-territory partition names used by the source API.
STATES = (
    "Andaman and Nicobar",
    "Andhra Pradesh",
    "Arunachal Pradesh",
    "Assam",
    "Bihar",
    "Chandigarh",
    "Chhattisgarh",
    "Dadra and Nagar Haveli",
    "Daman and Diu",
    "Delhi",
    "Goa",
    "Gujarat",
    "Haryana",
    "Himachal Pradesh",
    "Jammu and Kashmir",
    "Jharkhand",
    "Karnataka",
    "Kerala",
    "Ladakh",
    "Lakshadweep",
    "Madhya Pradesh",
    "Maharashtra",
    "Manipur",
    "Meghalaya",
    "Mizoram",
    "Nagaland",
    "Odisha",
    "Puducherry",
    "Punjab",
    "Rajasthan",
    "Sikkim",
    "Tamil Nadu",
    "Telangana",
    "Tripura",
    "Uttar Pradesh",
    "Uttarakhand",
    "West Bengal",
)

# --- Fixed values: price-data state name -> region-shape name, for known mismatches.
REGION_RENAME = (
    ("Odisha", "Orissa"),
    ("Uttarakhand", "Uttaranchal"),
    ("Puducherry", "Pondicherry"),
    ("Delhi", "NCT of Delhi"),
    ("Andaman and Nicobar", "Andaman & Nicobar Island"),
    ("Dadra and Nagar Haveli", "Dadra & Nagar Haveli"),
    ("Daman and Diu", "Daman & Diu"),
    ("Jammu and Kashmir", "Jammu & Kashmir"),
)

# --- Fixed values: minimum support prices 2024-25, Rs/quintal.
MSP_2024 = (
    ("Paddy", 2300.0),
    ("Wheat", 2275.0),
    ("Jowar", 3371.0),
    ("Bajra", 2625.0),
    ("Maize", 2090.0),
    ("Tur (Arhar)", 7550.0),
    ("Moong", 8682.0),
    ("Urad", 7400.0),
    ("Cotton", 7121.0),
    ("Groundnut", 6783.0),
    ("Sunflower", 7280.0),
)

# --- Fixed values: GeoJSON feature properties that may hold the region name, in preference order.
REGION_NAME_KEYS = ("NAME_1", "ST_NM", "st_nm", "state_name", "STATE_NAME", "State", "state")

# --- Fixed values: money-label thresholds and suffixes.
MONEY_SYMBOL = "₹"
MONEY_UNITS = ((1e9, "B"), (1e6, "M"))

# --- Fixed values: legacy result column accepted in place of price_index_sum.
LEGACY_PRICE_INDEX_COLUMN = "total_price_sum"
