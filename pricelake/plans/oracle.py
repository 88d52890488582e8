"""Independent SQL for every registered query, runnable by DuckDB on the raw test tables.

Each string is self-contained: the derived price records are rebuilt as CTEs
from ``lineitem``, ``part``, ``supplier``, ``nation`` and ``region``. DuckDB
has no ``initcap`` and its ``strptime`` accepts one-digit days, so both are
spelled out (title-casing word by word, a regex guard on the date).
Rounding goes through ``DECIMAL(38,10)`` exactly as the Spark side does.
"""

from __future__ import annotations

from pricelake.sources.fixtures import FIXTURE_MAX_YEAR, FIXTURE_MIN_YEAR, FIXTURE_MSP, FIXTURE_REGION_MAP, ONE_COMMODITY


def IC(x: str) -> str:
    return f"array_to_string(list_transform(string_split(trim({x}),' '), lambda w: upper(w[1])||lower(w[2:])),' ')"


def R(x: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)),{places}) AS DOUBLE)"


def F1(x: str) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(38,10)) AS DECIMAL(38,1)) AS VARCHAR)"


def YM(y: str = "year", m: str = "month") -> str:
    return f"lpad(CAST({y} AS VARCHAR),4,'0')||'-'||lpad(CAST({m} AS VARCHAR),2,'0')"


RAW_COLS = "state, district, market, commodity, variety, grade, arrival_date, min_price, max_price, modal_price"

RAW_K = """raw_k AS (
  SELECT k, n_name,
    CASE WHEN k%113=0 THEN '  ' WHEN k%7=0 THEN '  '||lower(n_name)||' ' ELSE n_name END AS state,
    lower(r_name) AS district, s_name AS market,
    CASE WHEN k%101=0 THEN NULL WHEN k%103=0 THEN '   ' WHEN k%5=0 THEN upper(p_name)||' ' ELSE p_name END AS commodity,
    p_type AS variety, l_returnflag AS grade,
    CASE WHEN k%97=0 THEN '2000-01-31' WHEN k%107=0 THEN '31/02/2000' WHEN k%109=0 THEN NULL
         ELSE lpad(CAST(day(l_shipdate) AS VARCHAR),2,'0')||'/'||lpad(CAST(month(l_shipdate) AS VARCHAR),2,'0')||'/'||CAST(year(l_shipdate) AS VARCHAR) END AS arrival_date,
    CASE WHEN k%89=0 THEN CAST(-1.0 AS DOUBLE) WHEN k%83=0 THEN l_extendedprice*(1+l_tax)+1 ELSE l_extendedprice*(1-l_discount) END AS min_price,
    l_extendedprice*(1+l_tax) AS max_price,
    CASE WHEN k%79=0 THEN NULL ELSE l_extendedprice END AS modal_price
  FROM (SELECT *, l_orderkey*10+l_linenumber AS k FROM lineitem) l
  JOIN part ON l_partkey=p_partkey JOIN supplier ON l_suppkey=s_suppkey
  JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey
)"""

# Without the lines that :func:`pricelake.sources.fixtures.malformed_lines` breaks.
RAW_K_WELL_FORMED = RAW_K.rstrip(")").rstrip() + "\n  WHERE NOT (k%61=0 OR k%67=0 OR k%71=0)\n)"

RAW_RECORDS = f"raw_records AS (SELECT {RAW_COLS} FROM raw_k)"

RAW_D = r"""raw_d AS (
  SELECT *, CAST(CASE WHEN regexp_full_match(arrival_date,'\d{2}/\d{2}/\d{4}') THEN try_strptime(arrival_date,'%d/%m/%Y') END AS DATE) AS d
  FROM raw_records
)"""

CRITICAL_OK = (
    "commodity IS NOT NULL AND trim(commodity)<>'' AND market IS NOT NULL AND trim(market)<>'' "
    "AND arrival_date IS NOT NULL AND trim(arrival_date)<>'' AND modal_price IS NOT NULL"
)
PRICES_OK = "min_price>0 AND max_price>0 AND modal_price>0 AND min_price<=max_price"
FINITE_OK = "isfinite(min_price) AND isfinite(max_price) AND isfinite(modal_price)"
YEARS_OK = f"year(d) BETWEEN {FIXTURE_MIN_YEAR} AND {FIXTURE_MAX_YEAR}"

CLEAN = f"""clean_records AS (
  SELECT nullif({IC('state')},'') AS state, {IC('district')} AS district, {IC('market')} AS market,
         {IC('commodity')} AS commodity, {IC('variety')} AS variety, {IC('grade')} AS grade,
         d AS arrival_date, min_price, max_price, modal_price,
         CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month
  FROM raw_d
  WHERE {CRITICAL_OK} AND {PRICES_OK} AND {FINITE_OK} AND d IS NOT NULL AND {YEARS_OK}
)"""

BASE = [RAW_K, RAW_RECORDS, RAW_D, CLEAN]

CUTOFF = "(SELECT MAX(arrival_date) - INTERVAL 12 MONTH FROM clean_records)"

TOP10 = """top10 AS (
  SELECT commodity FROM clean_records WHERE commodity IS NOT NULL
  GROUP BY commodity ORDER BY COUNT(*) DESC, commodity LIMIT 10
)"""

STATE_SUMMARY = f"""state_summary AS (
  SELECT state, COUNT(*) AS record_count, {R('AVG(modal_price)')} AS avg_modal_price,
         {R('SUM(modal_price)', 0)} AS price_index_sum,
         COUNT(DISTINCT market) AS unique_markets, COUNT(DISTINCT commodity) AS unique_commodities
  FROM clean_records WHERE state IS NOT NULL GROUP BY state
)"""

TOP_STATES = "top_states AS (SELECT * FROM state_summary ORDER BY price_index_sum DESC, state LIMIT 5)"

VOLATILITY = f"""volatility AS (
  SELECT commodity, COUNT(*) AS record_count, {R('AVG(modal_price)')} AS avg_modal_price,
         {R('COALESCE(STDDEV_SAMP(modal_price), 0.0)')} AS stddev_modal_price,
         {R('COALESCE(STDDEV_SAMP(modal_price) / AVG(modal_price) * 100, 0.0)')} AS coeff_variation_pct,
         {R('MIN(modal_price)')} AS min_price_ever, {R('MAX(modal_price)')} AS max_price_ever
  FROM clean_records WHERE commodity IS NOT NULL AND modal_price > 0
  GROUP BY commodity HAVING COUNT(*) >= 1
  ORDER BY stddev_modal_price DESC, commodity LIMIT 20
)"""

NATIONAL = """national AS (
  SELECT *, AVG(modal_price) OVER (PARTITION BY commodity, arrival_date) AS nat
  FROM clean_records WHERE commodity IS NOT NULL AND modal_price > 0
)"""

ARBITRAGE = f"""arbitrage AS (
  SELECT state, commodity, COUNT(*) AS record_count, {R('AVG(modal_price)')} AS avg_state_price,
         {R('AVG(nat)')} AS avg_national_price, {R('AVG(dev)')} AS avg_deviation_pct, {R('MAX(dev)')} AS max_deviation_pct
  FROM (SELECT *, (modal_price - nat) / nat * 100 AS dev FROM national)
  GROUP BY state, commodity HAVING COUNT(*) >= 1
  ORDER BY avg_deviation_pct DESC, state ASC NULLS FIRST, commodity LIMIT 30
)"""


def _values(rows, types) -> str:
    def lit(v, t):
        if t == "double":
            return f"CAST({float(v)!r} AS DOUBLE)"
        return "'" + str(v).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)


REGIONS = """regions AS (
  SELECT CASE WHEN n_nationkey IN (1,2) THEN 'Old Nation '||CAST(n_nationkey AS VARCHAR)
              ELSE 'Nation_'||CAST(n_nationkey AS VARCHAR) END AS name
  FROM nation WHERE n_nationkey < 23
)"""
REGION_MAP = f"region_map AS (SELECT {IC('state')} AS state, name FROM (VALUES {_values(FIXTURE_REGION_MAP, ('s', 's'))}) AS t(state, name))"
RENAMED = """renamed AS (
  SELECT CASE WHEN NOT EXISTS (SELECT 1 FROM regions r WHERE r.name = s.state) AND m.name IS NOT NULL
              THEN m.name ELSE s.state END AS state,
         s.record_count, s.avg_modal_price, s.price_index_sum, s.unique_markets, s.unique_commodities
  FROM state_summary s LEFT JOIN region_map m ON s.state = m.state
)"""

MSP = f"msp AS (SELECT {IC('commodity')} AS commodity, msp FROM (VALUES {_values(FIXTURE_MSP, ('s', 'double'))}) AS t(commodity, msp))"
MSP_ROWS = """msp_rows AS (
  SELECT c.*, m.msp, c.modal_price < m.msp AS below
  FROM clean_records c JOIN msp m ON c.commodity = m.commodity WHERE c.modal_price > 0
)"""


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _money(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 1e9 THEN '₹'||{F1(x + ' / 1e9')}||'B' "
        f"WHEN {x} >= 1e6 THEN '₹'||{F1(x + ' / 1e6')}||'M' "
        f"ELSE '₹'||format('{{:,}}', CAST({x} AS BIGINT)) END"
    )


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_records"] = _with(BASE, "SELECT * FROM clean_records")
    q["clean_audit"] = _with(
        [RAW_K, RAW_RECORDS, RAW_D],
        f"""SELECT reject_reason, COUNT(*) AS record_count FROM (
  SELECT CASE WHEN NOT ({CRITICAL_OK}) THEN 'missing_critical'
              WHEN NOT coalesce({PRICES_OK}, false) THEN 'invalid_price'
              WHEN NOT ({FINITE_OK}) THEN 'non_finite_price'
              WHEN d IS NULL THEN 'bad_date'
              WHEN NOT ({YEARS_OK}) THEN 'year_out_of_range'
              ELSE 'kept' END AS reject_reason
  FROM raw_d) GROUP BY reject_reason""",
    )
    q["critical_filter"] = _with([RAW_K, RAW_RECORDS], f"SELECT * FROM raw_records WHERE {CRITICAL_OK}")
    q["valid_prices"] = _with([RAW_K, RAW_RECORDS], f"SELECT * FROM raw_records WHERE {PRICES_OK} AND {FINITE_OK}")
    q["parse_dates"] = _with(
        [RAW_K, RAW_RECORDS, RAW_D],
        "SELECT state, district, market, commodity, variety, grade, d AS arrival_date, min_price, max_price, modal_price "
        "FROM raw_d WHERE d IS NOT NULL",
    )
    q["normalise_text"] = _with(
        [RAW_K, RAW_RECORDS],
        f"SELECT nullif({IC('state')},'') AS state, {IC('district')} AS district, {IC('market')} AS market, "
        f"{IC('commodity')} AS commodity, {IC('variety')} AS variety, {IC('grade')} AS grade, "
        "arrival_date, min_price, max_price, modal_price FROM raw_records",
    )
    q["trailing_window"] = _with(BASE, f"SELECT * FROM clean_records WHERE arrival_date >= {CUTOFF}")
    q["top_commodities"] = _with(
        BASE,
        f"""SELECT commodity, COUNT(*) AS record_count, {R('AVG(modal_price)')} AS avg_modal_price,
       {R('MIN(modal_price)')} AS min_modal_price, {R('MAX(modal_price)')} AS max_modal_price
FROM clean_records WHERE commodity IS NOT NULL GROUP BY commodity
ORDER BY record_count DESC, commodity LIMIT 10""",
    )
    q["monthly_price_trend"] = _with(
        BASE,
        f"""SELECT year, month, {YM()} AS year_month, {R('AVG(modal_price)')} AS avg_modal_price, COUNT(*) AS record_count
FROM clean_records WHERE arrival_date >= {CUTOFF}
GROUP BY year, month ORDER BY year_month""",
    )
    q["monthly_price_by_commodity"] = _with(
        BASE + [TOP10],
        f"""SELECT commodity, {YM()} AS year_month, {R('AVG(modal_price)')} AS avg_modal_price, COUNT(*) AS record_count
FROM clean_records WHERE arrival_date >= {CUTOFF} AND commodity IN (SELECT commodity FROM top10)
GROUP BY commodity, year, month ORDER BY commodity, year_month""",
    )
    q["top_states"] = _with(BASE + [STATE_SUMMARY, TOP_STATES], "SELECT * FROM top_states")
    q["all_states_summary"] = _with(BASE + [STATE_SUMMARY], "SELECT * FROM state_summary ORDER BY price_index_sum DESC, state")
    q["price_volatility"] = _with(BASE + [VOLATILITY], "SELECT * FROM volatility")
    q["market_inefficiency"] = _with(
        BASE,
        f"""SELECT state, market, COUNT(*) AS record_count, {R('AVG(max_price - min_price)')} AS avg_price_spread,
       {R('AVG((max_price - min_price) / modal_price * 100)')} AS avg_spread_pct, {R('AVG(modal_price)')} AS avg_modal_price
FROM clean_records WHERE min_price > 0 AND max_price > 0 AND modal_price > 0
GROUP BY state, market HAVING COUNT(*) >= 1
ORDER BY avg_spread_pct DESC, state ASC NULLS FIRST, market ASC NULLS FIRST LIMIT 20""",
    )
    q["national_average"] = _with(
        BASE + [NATIONAL],
        f"""SELECT state, market, commodity, arrival_date, modal_price, {R('nat')} AS national_avg,
       {R('(modal_price - nat) / nat * 100')} AS deviation_pct FROM national""",
    )
    q["arbitrage_signal"] = _with(BASE + [NATIONAL, ARBITRAGE], "SELECT * FROM arbitrage")

    def n_distinct(c: str) -> str:
        return f"COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"

    q["dataset_profile"] = _with(
        BASE,
        f"""SELECT COUNT(*) AS total_records, MIN(arrival_date) AS min_arrival_date, MAX(arrival_date) AS max_arrival_date,
       {n_distinct('commodity')} AS unique_commodities, {n_distinct('state')} AS unique_states,
       {n_distinct('market')} AS unique_markets
FROM clean_records""",
    )
    region_ctes = BASE + [STATE_SUMMARY, REGIONS, REGION_MAP, RENAMED]
    q["region_rename"] = _with(region_ctes, "SELECT * FROM renamed")
    q["unmatched_regions"] = _with(
        region_ctes, "SELECT state FROM renamed s WHERE NOT EXISTS (SELECT 1 FROM regions r WHERE r.name = s.state)"
    )
    q["region_summary"] = _with(
        region_ctes,
        """SELECT r.name AS region, s.record_count, s.avg_modal_price, s.price_index_sum
FROM (SELECT DISTINCT name FROM regions) r LEFT JOIN renamed s ON r.name = s.state""",
    )
    q["arbitrage_matrix"] = _with(
        BASE + [NATIONAL, ARBITRAGE],
        """SELECT s.state, c.commodity, coalesce(avg(a.avg_deviation_pct), 0.0) AS avg_deviation_pct
FROM (SELECT DISTINCT state FROM arbitrage) s CROSS JOIN (SELECT DISTINCT commodity FROM arbitrage) c
LEFT JOIN arbitrage a ON a.state IS NOT DISTINCT FROM s.state AND a.commodity = c.commodity
GROUP BY s.state, c.commodity""",
    )
    q["legacy_state_labels"] = _with(
        BASE + [STATE_SUMMARY, TOP_STATES],
        f"SELECT state, price_index_sum, {_money('price_index_sum')} AS price_label FROM top_states",
    )
    q["result_roundtrip"] = q["all_states_summary"]
    q["region_names"] = "SELECT DISTINCT c_name AS name FROM customer WHERE c_custkey % 25 <> 5"
    q["inefficiency_feed"] = f"SELECT state, market, avg_modal_price, avg_spread_pct, avg_price_spread, record_count FROM ({q['market_inefficiency']})"
    q["price_trend_feed"] = f"SELECT year_month, avg_modal_price FROM ({q['monthly_price_trend']}) ORDER BY year_month"
    q["top_commodities_feed"] = f"SELECT * FROM ({q['top_commodities']}) ORDER BY record_count, commodity"
    q["state_labels"] = _with(
        BASE + [STATE_SUMMARY, TOP_STATES],
        f"SELECT state, price_index_sum, {_money('price_index_sum')} AS price_label FROM top_states",
    )
    q["state_activity_long"] = _with(
        BASE + [STATE_SUMMARY, TOP_STATES],
        """SELECT state, 'unique_markets' AS metric, unique_markets AS value FROM top_states
UNION ALL SELECT state, 'unique_commodities' AS metric, unique_commodities AS value FROM top_states""",
    )
    q["volatility_feed"] = _with(
        BASE + [VOLATILITY],
        f"SELECT *, {F1('coeff_variation_pct')}||'%' AS cv_label FROM volatility ORDER BY coeff_variation_pct, commodity",
    )

    def price_text(c: str) -> str:
        return f"CAST(CAST(floor({c}) AS BIGINT) AS VARCHAR)"

    q["flatten_pages"] = _with(
        [RAW_K],
        f"""SELECT coalesce(state,'') AS state, coalesce(district,'') AS district, coalesce(market,'') AS market,
       coalesce(commodity,'') AS commodity, coalesce(variety,'') AS variety, coalesce(grade,'') AS grade,
       coalesce(arrival_date,'') AS arrival_date,
       CASE WHEN k%4=0 THEN '' ELSE coalesce({price_text('min_price')},'') END AS min_price,
       coalesce({price_text('max_price')},'') AS max_price,
       CASE WHEN k%7=0 THEN '' ELSE coalesce({price_text('modal_price')},'') END AS modal_price
FROM raw_k""",
    )
    no_record = ", ".join(f"NULL AS {c}" for c in RAW_COLS.split(", "))
    q["record_quarantine"] = (
        f"SELECT {RAW_COLS}, NULL AS odd FROM ({q['flatten_pages']}) UNION ALL "
        f"SELECT {no_record}, '7' AS odd FROM (SELECT DISTINCT (l_orderkey * 10 + l_linenumber) // 100 AS p FROM lineitem) WHERE p % 3 = 0"
    )
    landed = ", ".join(f"CAST(nullif({c}, '') AS {'DOUBLE' if c.endswith('_price') else 'VARCHAR'}) AS {c}" for c in RAW_COLS.split(", "))
    q["land_pages"] = f"SELECT {landed} FROM ({q['flatten_pages']})"
    q["landing_inventory"] = _with(
        [RAW_K],
        """SELECT 'src_state=' || coalesce(s, '__HIVE_DEFAULT_PARTITION__') AS partition,
  CASE WHEN s = 'NATION_X' THEN CAST(NULL AS BIGINT) ELSE n END AS lines_before,
  CASE WHEN s = 'NATION_1' THEN CAST(NULL AS BIGINT) WHEN s = 'NATION_2' THEN n + thirds ELSE n END AS lines_after,
  CASE s WHEN 'NATION_1' THEN 'missing' WHEN 'NATION_2' THEN 'grown' WHEN 'NATION_3' THEN 'changed' WHEN 'NATION_X' THEN 'extra' ELSE 'equal' END AS status,
  coalesce(s, '') NOT IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_X') AS matches
FROM (SELECT s, count(*) AS n, count(*) FILTER (k % 3 = 0) AS thirds FROM (
    SELECT k, nullif(upper(trim(state)), '') AS s FROM raw_k UNION ALL SELECT k, 'NATION_X' FROM raw_k WHERE upper(trim(state)) = 'NATION_4') GROUP BY s)""",
    )
    unbound = "CASE WHEN k%4=3 THEN 'unknown_header' WHEN k%4=0 AND (k%61=0 OR k%67=0 OR k%71=0) THEN 'malformed_line' END"
    bound = ", ".join(f"CASE WHEN ({unbound}) IS NULL THEN {c} END AS {c}" for c in RAW_COLS.split(", "))
    q["read_mixed_headers"] = _with([RAW_K], f"SELECT {bound}, {unbound} AS reason FROM raw_k")
    q["commodity_lookup"] = _with(BASE, f"SELECT * FROM clean_records WHERE commodity = {IC(repr(ONE_COMMODITY))}")
    q["rollup_states_summary"] = q["all_states_summary"]
    q["rollup_profile"] = q["dataset_profile"]
    q["rollup_top_commodities"] = q["sql_top_commodities"] = q["top_commodities"]
    q["rollup_volatility"] = q["price_volatility"]
    q["sql_monthly_trend"] = q["monthly_price_trend"]
    q["sql_trailing_prices"] = q["trailing_window"]
    q["sql_arbitrage"] = q["arbitrage_signal"]
    q["sql_view"] = _with(
        BASE, "SELECT state, year, COUNT(*) AS record_count, MAX(modal_price) AS top_price FROM clean_records GROUP BY state, year"
    )
    q["audit_totals"] = _with(
        BASE,
        """SELECT r AS raw_count, c AS clean_count, r - c AS dropped_count, 100.0::DOUBLE * (r - c) / greatest(r, 1) AS dropped_pct
FROM (SELECT (SELECT COUNT(*) FROM raw_records) AS r, (SELECT COUNT(*) FROM clean_records) AS c)""",
    )
    q["page_quarantine"] = (
        "SELECT count(DISTINCT (l_orderkey * 10 + l_linenumber) // 100) AS good_pages, count(*) AS records, true AS has_bad_pages FROM lineitem"
    )
    q["pending_partitions"] = _with(
        [RAW_K, RAW_RECORDS],
        """SELECT state, COUNT(*) AS raw_rows FROM (SELECT nullif(upper(trim(state)),'') AS state FROM raw_records) l
WHERE state IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey % 3 = 0 AND n.n_name = l.state)
GROUP BY state""",
    )
    q["read_raw_csv"] = _with([RAW_K, RAW_RECORDS], "SELECT * FROM raw_records")
    bad = "(k%61=0 OR k%67=0 OR k%71=0)"
    nulled = ", ".join(f"CASE WHEN {bad} THEN NULL ELSE {c} END AS {c}" for c in RAW_COLS.split(", "))
    q["malformed_quarantine"] = _with([RAW_K], f"SELECT {nulled}, {bad} AS is_malformed FROM raw_k")
    q["processed_roundtrip"] = _with(BASE, "SELECT * FROM clean_records")
    well_formed = BASE.copy()
    well_formed[0] = RAW_K_WELL_FORMED
    q["stream_ingest"] = _with(well_formed, "SELECT * FROM clean_records")
    q["batch_then_stream"] = _with(BASE, "SELECT * FROM clean_records")
    q["msp_violations"] = _with(
        BASE + [MSP, MSP_ROWS],
        f"""SELECT state, commodity, msp, COUNT(*) AS record_count, COUNT(*) FILTER (WHERE below) AS violations,
       {R('CAST(COUNT(*) FILTER (WHERE below) AS DOUBLE) * 100.0 / COUNT(*)')} AS violation_pct,
       {R('AVG(CASE WHEN below THEN msp - modal_price END)')} AS avg_shortfall
FROM msp_rows GROUP BY state, commodity, msp
ORDER BY violation_pct DESC, state ASC NULLS FIRST, commodity""",
    )
    q["msp_compliance_monthly"] = _with(
        BASE + [MSP, MSP_ROWS],
        f"""SELECT commodity, {YM()} AS year_month, COUNT(*) AS record_count, COUNT(*) FILTER (WHERE below) AS violations,
       {R('CAST(COUNT(*) FILTER (WHERE below) AS DOUBLE) * 100.0 / COUNT(*)')} AS violation_pct
FROM msp_rows GROUP BY commodity, year, month ORDER BY commodity, year_month""",
    )
    daily = """daily AS (
  SELECT commodity, arrival_date, AVG(modal_price) AS daily_avg, COUNT(*) AS record_count
  FROM clean_records WHERE commodity IS NOT NULL AND modal_price > 0 GROUP BY commodity, arrival_date
)"""
    trailing = """trailing_stats AS (
  SELECT *, AVG(daily_avg) OVER w AS trailing_avg, STDDEV_SAMP(daily_avg) OVER w AS trailing_sd,
         COUNT(daily_avg) OVER w AS trailing_days
  FROM daily
  WINDOW w AS (PARTITION BY commodity ORDER BY arrival_date
               RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)
)"""
    scored = """scored AS (
  SELECT *, (daily_avg - trailing_avg) / trailing_sd AS zz FROM trailing_stats WHERE trailing_days >= 5 AND trailing_sd > 0
)"""
    q["price_shocks"] = _with(
        BASE + [daily, trailing, scored],
        f"""SELECT commodity, arrival_date, record_count, {R('daily_avg')} AS daily_avg_price,
       {R('trailing_avg')} AS trailing_avg_price, {R('trailing_sd')} AS trailing_stddev, trailing_days,
       {R('zz')} AS z_score, CASE WHEN zz > 0 THEN 'spike' ELSE 'drop' END AS direction
FROM scored WHERE abs(zz) > 3 ORDER BY commodity, arrival_date""",
    )
    return q


ORACLE_SQL = build()
