"""The market questions as SQL table functions with parameters, over the view that SQL users query.

``SELECT * FROM top_commodities(10)`` and the like; each is a temporary SQL function whose body Spark inlines into the
query, so predicates on its result are pushed down as in a written-out query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _rounded(x: str, places: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def _first(k: str, order: str, columns: str, body: str) -> str:
    """The first k rows of ``body`` in ``order``; as k is a parameter, by rank (Spark cuts each partition to k rows first)."""
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS _place FROM ({body})) WHERE _place <= {k} ORDER BY _place"


def function_definitions(view: str = "price_records") -> dict[str, str]:
    """``CREATE`` statements by function name."""
    # Parameters are not seen inside a scalar subquery; the predicate on year prunes directories.
    cutoff = f"add_months((SELECT max(arrival_date) FROM {view}), -months)"
    recent = f"{view} WHERE arrival_date >= {cutoff} AND year >= year({cutoff})"
    bodies = {
        "trailing_prices": (
            "months INT",
            "state STRING, district STRING, market STRING, commodity STRING, variety STRING, grade STRING, arrival_date DATE, "
            "min_price DOUBLE, max_price DOUBLE, modal_price DOUBLE, year INT, month INT",
            f"SELECT state, district, market, commodity, variety, grade, arrival_date, min_price, max_price, modal_price, year, month FROM {recent}",
        ),
        "monthly_trend": (
            "months INT",
            "year INT, month INT, year_month STRING, avg_modal_price DOUBLE, record_count BIGINT",
            f"SELECT year, month, date_format(arrival_date, 'yyyy-MM') AS year_month, {_rounded('avg(modal_price)')} AS avg_modal_price, "
            f"count(*) AS record_count FROM {recent} GROUP BY year, month, date_format(arrival_date, 'yyyy-MM') ORDER BY year_month",
        ),
        "top_commodities": (
            "k INT",
            "commodity STRING, record_count BIGINT, avg_modal_price DOUBLE, min_modal_price DOUBLE, max_modal_price DOUBLE",
            _first(
                "k",
                "record_count DESC, commodity",
                "commodity, record_count, avg_modal_price, min_modal_price, max_modal_price",
                f"SELECT commodity, count(*) AS record_count, {_rounded('avg(modal_price)')} AS avg_modal_price, "
                f"{_rounded('min(modal_price)')} AS min_modal_price, {_rounded('max(modal_price)')} AS max_modal_price "
                f"FROM {view} WHERE commodity IS NOT NULL GROUP BY commodity",
            ),
        ),
        # Rows are reduced to days first, as in operators/arbitrage.py: no (commodity, day) meets as raw rows.
        "arbitrage": (
            "k INT",
            "state STRING, commodity STRING, record_count BIGINT, avg_state_price DOUBLE, avg_national_price DOUBLE, avg_deviation_pct DOUBLE, max_deviation_pct DOUBLE",
            _first(
                "k",
                "avg_deviation_pct DESC, state NULLS FIRST, commodity",
                "state, commodity, record_count, avg_state_price, avg_national_price, avg_deviation_pct, max_deviation_pct",
                f"""SELECT state, commodity, sum(n) AS record_count, {_rounded('sum(s) / sum(n)')} AS avg_state_price,
  {_rounded('sum(n * nat) / sum(n)')} AS avg_national_price,
  {_rounded('sum((s - n * nat) / nat * 100) / sum(n)')} AS avg_deviation_pct, {_rounded('max((top - nat) / nat * 100)')} AS max_deviation_pct
FROM (SELECT *, sum(s) OVER (PARTITION BY commodity, arrival_date) / sum(n) OVER (PARTITION BY commodity, arrival_date) AS nat
  FROM (SELECT state, commodity, arrival_date, count(*) AS n, sum(modal_price) AS s, max(modal_price) AS top
    FROM {view} WHERE commodity IS NOT NULL AND modal_price > 0 GROUP BY state, commodity, arrival_date))
GROUP BY state, commodity""",
            ),
        ),
    }
    return {
        name: f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}"
        for name, (parameters, columns, body) in bodies.items()
    }


def register_functions(spark: SparkSession, view: str = "price_records") -> list[str]:
    """Create the functions in the session; the view must be there. Their names."""
    definitions = function_definitions(view)
    for statement in definitions.values():
        spark.sql(statement)
    return list(definitions)
