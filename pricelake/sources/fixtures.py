"""Price records and dimensions derived from the order/line-item test tables.

The source system ships no test inputs, so raw price records are derived from
``lineitem`` joined to its part, supplier, nation and region: nation = state,
supplier = market, part name = commodity. Every row of ``lineitem`` becomes one
price record; a deterministic rule on the record key ``k`` injects one defect
class per modulus (blank and padded states, null/blank commodities, bad dates,
null modal price, non-positive and inverted prices).

The joins are left to Catalyst: the dimension scans carry size statistics, so
small ones are broadcast and large ones (``part`` grows with the data) fall
back to a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.schema import PRICE_FIELDS, RAW_FIELDS

# Year range of the generated dates (1995-2001); the reference window starts in 2013.
FIXTURE_MIN_YEAR = 1996
FIXTURE_MAX_YEAR = 2001


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(n: int) -> Column:
    return (F.col("k") % F.lit(n)) == F.lit(0)


def _ddmmyyyy(c: str) -> Column:
    """``dd/MM/yyyy`` text from the calendar fields (no time-zone conversion of the timestamp)."""
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat_ws("/", two(F.dayofmonth(c)), two(F.month(c)), F.year(c).cast("string"))


def raw_with_key(spark: SparkSession, sf_dir: str, share: tuple[int, int] | None = None) -> DataFrame:
    """Raw price records with their key ``k`` and the clean nation name; with ``share`` ``(i, n)`` those with ``k % n = i``."""
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"),
        "l_partkey",
        "l_suppkey",
        "l_returnflag",
        "l_shipdate",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    )
    if share:
        i, n = share
        li = li.where(F.col("k") % n == i)  # before the joins
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (
        li.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    gross = F.col("l_extendedprice") * (F.lit(1) + F.col("l_tax"))
    fields = F.struct(
        "k",
        "n_name",
        F.when(_k(113), F.lit("  "))
        .when(_k(7), F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
        .otherwise(F.col("n_name"))
        .alias("state"),
        F.lower("r_name").alias("district"),
        F.col("s_name").alias("market"),
        F.when(_k(101), F.lit(None).cast("string"))
        .when(_k(103), F.lit("   "))
        .when(_k(5), F.concat(F.upper("p_name"), F.lit(" ")))
        .otherwise(F.col("p_name"))
        .alias("commodity"),
        F.col("p_type").alias("variety"),
        F.col("l_returnflag").alias("grade"),
        F.when(_k(97), F.lit("2000-01-31"))
        .when(_k(107), F.lit("31/02/2000"))
        .when(_k(109), F.lit(None).cast("string"))
        .otherwise(_ddmmyyyy("l_shipdate"))
        .alias("arrival_date"),
        F.when(_k(89), F.lit(-1.0))
        .when(_k(83), gross + F.lit(1))
        .otherwise(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")))
        .alias("min_price"),
        gross.alias("max_price"),
        F.when(_k(79), F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")).alias("modal_price"),
    )
    # A row's fields leave a generator, so each is computed once: a filter on plain columns would be pushed below them with
    # every rule spelled out again for each mention, in a method too long for the JVM to compile (it runs 4x slower).
    return j.select(F.inline(F.array(fields)))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten raw fields only, as a landed CSV would hold them."""
    return raw_with_key(spark, sf_dir).select(*RAW_FIELDS)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region-shape names: two old spellings, two nations without a shape."""
    n = table(spark, sf_dir, "nation")
    return n.filter(F.col("n_nationkey") < 23).select(
        F.when(F.col("n_nationkey").isin(1, 2), F.concat(F.lit("Old Nation "), F.col("n_nationkey").cast("string")))
        .otherwise(F.concat(F.lit("Nation_"), F.col("n_nationkey").cast("string")))
        .alias("name")
    )


# A state that the page-landing query lands by itself first.
ONE_STATE = "NATION_7"
# A commodity that is looked up, as a user might type it.
ONE_COMMODITY = " red widget"

# Test dimension tables (small, fixed): region-name map and reference prices.
FIXTURE_REGION_MAP = (
    ("Nation_1", "Old Nation 1"),
    ("Nation_2", "Old Nation 2"),
    ("Nation_3", "Never Used"),
    ("Nation_24", "Gone"),
)
FIXTURE_MSP = (("Red Widget", 30000.0), ("Blue Bolt", 50000.0))


def done_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions whose landing finished in an earlier run (every third nation)."""
    n = table(spark, sf_dir, "nation")
    return n.filter((F.col("n_nationkey") % 3) == 0).select(F.col("n_name").alias("state"))


def pages_from_records(raw_k: DataFrame, page_size: int = 100, odd_every: int | None = None) -> DataFrame:
    """API-style JSON pages built from keyed raw records (column ``value``).

    Records with consecutive keys share a page (at most ``page_size`` keys per
    page). Prices are whole-rupee strings, as the API serves them. Key
    variants follow ``k``: the arrival date under its alias ``arrivaldate``
    (k % 3), ``min_price`` present as null next to its alias (k % 4), an extra
    key (k % 5), and no modal price at all (k % 7). With ``odd_every``, every so manieth page ends in a list element
    that is a number.
    """

    def price(c: str) -> Column:
        return F.floor(F.col(c)).cast("bigint")

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    def only(where: Column, key: str, value: Column) -> Column:
        return F.when(where, F.create_map(F.lit(key), value)).otherwise(F.create_map().cast("map<string,string>"))

    always = [x for f in ("state", "district", "market", "commodity", "variety", "grade") for x in (F.lit(f), F.col(f))]
    always += [F.when(_k(3), F.lit("arrivaldate")).otherwise(F.lit("arrival_date")), F.col("arrival_date")]
    always += [F.lit("min_price"), F.when(_k(4), F.lit(None).cast("string")).otherwise(text("min_price"))]
    record = F.map_concat(
        F.create_map(*always),
        only(_k(4), "minprice", text("min_price")),
        F.create_map(F.lit("max_price"), text("max_price")),
        only(~_k(7), "modal_price", text("modal_price")),
        only(_k(5), "extra", F.lit("x")),
    )
    page = F.floor(F.col("k") / F.lit(page_size))
    # Rows move as they are and become JSON where their page is made; a shuffle of made records would be far wider.
    rows = raw_k.withColumn("page_id", page).withColumns({c: price(c) for c in PRICE_FIELDS}).repartition("page_id")
    records = F.concat_ws(",", F.collect_list("record"))
    pages = (
        rows.select("page_id", F.to_json(record).alias("record"))
        .groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("total"), records.alias("records"))
        .select("page_id", F.concat(F.lit('{"total":'), F.col("total").cast("string"), F.lit(',"records":['), "records", F.lit("]}")).alias("value"))
    )
    if odd_every is None:
        return pages.select("value")
    odd = F.regexp_replace("value", r"\]\}$", ",7]}")
    return pages.select(F.when(F.col("page_id") % odd_every == 0, odd).otherwise(F.col("value")).alias("value"))


def broken_pages(pages: DataFrame) -> DataFrame:
    """Pages with every fifth (by number) followed by a copy cut short, and every seventh by one without a record list."""
    n = F.regexp_extract("value", r'"total":(\d+)', 1).cast("int") + F.length("value")
    cut = F.expr("substring(value, 1, length(value) - 3)")
    empty = F.to_json(F.struct(F.md5("value").alias("message")))
    none = F.array().cast("array<string>")
    copies = F.concat(F.array("value"), F.when(n % 5 == 0, F.array(cut)).otherwise(none), F.when(n % 7 == 0, F.array(empty)).otherwise(none))
    return pages.select(F.explode(copies).alias("value"))  # one pass over the pages


def region_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-delimited GeoJSON features, one per customer, named by it (column ``value``).

    Of every 25, one has an ``id`` and another name property only, two more
    have a blank usual name beside another one, and one has no name at all.
    """
    n = table(spark, sf_dir, "customer")
    name, key = F.col("c_name"), F.col("c_custkey") % 25
    usual = F.when(key == 0, None).when(key.isin(3, 4), F.lit("  ")).when(key == 5, None).otherwise(F.concat(F.lit(" "), name))
    other = F.when(key == 5, None).when(key.isin(0, 3, 4), name)
    properties = F.struct(F.col("c_custkey").cast("string").alias("id"), F.lit("Land").alias("NAME_0"), usual.alias("NAME_1"), other.alias("st_name_x"))
    return n.select(F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"))).alias("value"))


def second_landing(raw_k: DataFrame) -> DataFrame:
    """Keyed raw records as a second landing might hold them: one state missing, one with lines twice, one with other
    grades in lines of the same length, and one more state."""
    state = F.upper(F.trim("state"))
    kept = raw_k.where(~state.eqNullSafe(F.lit("NATION_1")))
    twice = kept.where((state == "NATION_2") & _k(3))
    more = kept.where(state == "NATION_4").withColumn("state", F.lit("NATION_X"))
    changed = F.when(state == "NATION_3", F.translate("grade", "ANR", "NRA")).otherwise(F.col("grade"))
    return kept.unionByName(twice).unionByName(more).withColumn("grade", changed)


def malformed_lines(raw_k: DataFrame) -> DataFrame:
    """Raw records as headerless CSV text lines, some deliberately broken.

    k % 61: unparsable modal price; k % 67: a token short; k % 71: a token extra.
    """
    from pricelake.sources.csv import raw_csv_lines

    tokens = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_FIELDS]
    defect = (
        F.when(_k(61), F.concat_ws(",", *tokens[:-1], F.lit("abc")))
        .when(_k(67), F.concat_ws(",", *tokens[:-1]))
        .when(_k(71), F.concat_ws(",", *tokens, F.lit("x")))
    )
    return raw_csv_lines(raw_k, defect)


def landing_key() -> Column:
    """Partition directory value for landed raw rows: the upper-cased trimmed state, blank -> null."""
    return F.nullif(F.upper(F.trim(F.col("state"))), F.lit(""))
