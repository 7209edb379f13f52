"""The star-schema test tables seen as a market feed, place rows, and labour points.

One feed row per line item, with the customer's nation as city and the part's type as
property type. Only nation and region have a fixed size; whether the other sides are
broadcast is left to Spark's size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homespan.functions.text import MISSING
from homespan.schemas import MARKET_COLUMNS

FEED_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")

_footers: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stored table. The schema in its footer is read once per process, not once per query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _footers:
        _footers[path] = spark.read.parquet(path).schema
    return spark.read.schema(_footers[path]).parquet(path)


Years = tuple[int, int | None]


def _orders(spark: SparkSession, sf_dir: str, years: Years | None) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if years is None:
        return orders
    first, last = years
    orders = orders.filter(f"o_orderdate >= timestamp_ntz '{first}-01-01 00:00:00'")
    return orders if last is None else orders.filter(f"o_orderdate < timestamp_ntz '{last + 1}-01-01 00:00:00'")


CENTS = "cast(rint(l_extendedprice * 100) AS bigint)"

LINE_EXPRESSIONS = (
    "l_orderkey",
    "l_partkey",
    "l_linenumber",
    "l_extendedprice",
    "cast(l_quantity AS int) AS HOMES_SOLD",
    "NOT (l_returnflag = 'R' AND l_linenumber = 1) AS has_price",
    "NOT (l_returnflag = 'A' AND l_linenumber = 2) AS has_area",
)

MARKET_EXPRESSIONS = (
    "n_name AS CITY",
    "r_name AS STATE",
    "r_name AS STATE_CODE",
    "c_mktsegment AS PARENT_METRO_REGION",
    "cast(o_orderdate AS date) AS PERIOD_END",
    "p_type AS PROPERTY_TYPE",
    "CASE WHEN has_price THEN l_extendedprice END AS MEDIAN_SALE_PRICE",
    f"CASE WHEN has_price THEN ({CENTS} * 101 div 100) / 100.0D END AS MEDIAN_LIST_PRICE",
    f"CASE WHEN has_area THEN ({CENTS} div HOMES_SOLD) / 100.0D END AS MEDIAN_PPSF",
    "HOMES_SOLD",
    "p_size AS INVENTORY",
    "cast((l_orderkey + 7 * l_linenumber) % 120 AS int) AS MEDIAN_DOM",
)


def market_values(spark: SparkSession, sf_dir: str, years: Years | None = None) -> DataFrame:
    """Feed rows with measures still typed and missing cells null; ``years`` reaches the order scan.

    Line items shrink to what the measures need before the joins; derived prices, which
    compress badly, are worked out after the last shuffle.
    Part joins first, so that a property-type filter cuts line items before they move to
    meet their orders; orders meet their city before they meet line items.
    """
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    dated = _orders(spark, sf_dir, years).join(places, F.expr("o_custkey = c_custkey"))
    lines = table(spark, sf_dir, "lineitem").selectExpr(*LINE_EXPRESSIONS)
    typed_lines = lines.join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    return typed_lines.join(dated, F.expr("l_orderkey = o_orderkey")).selectExpr(*MARKET_EXPRESSIONS)


def market_silver(spark: SparkSession, sf_dir: str, years: Years | None = None) -> DataFrame:
    """What cleaning ``market_feed`` yields, without the way through text: typed and priced rows."""
    values = market_values(spark, sf_dir, years).filter("MEDIAN_SALE_PRICE IS NOT NULL")
    return values.withColumnRenamed("PERIOD_END", "PERIOD_END_DATE")


def market_feed(spark: SparkSession, sf_dir: str, years: Years | None = None) -> DataFrame:
    """The feed as it would be read from a delimited file: all text, missing cells marked."""
    cells = [f"coalesce(cast({c} AS string), '{MISSING}') AS {c}" for c in MARKET_COLUMNS]
    return market_values(spark, sf_dir, years).selectExpr(*cells)


DAMAGED = {
    "PERIOD_END": "CASE WHEN MEDIAN_DOM % 13 = 5 THEN date_format(PERIOD_END, 'dd/MM/yyyy') ELSE cast(PERIOD_END AS string) END",
    "HOMES_SOLD": """CASE MEDIAN_DOM % 17 WHEN 3 THEN 'many' WHEN 4 THEN concat(HOMES_SOLD, '.5')
                     ELSE cast(HOMES_SOLD AS string) END""",
    "MEDIAN_SALE_PRICE": "CASE WHEN MEDIAN_DOM % 19 = 7 THEN 'on request' ELSE cast(MEDIAN_SALE_PRICE AS string) END",
}


def damaged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed with dates, volumes and prices of some rows in a text that cannot be read, or read in part."""
    cells = [f"coalesce({DAMAGED.get(c, f'cast({c} AS string)')}, '{MISSING}') AS {c}" for c in MARKET_COLUMNS]
    return market_values(spark, sf_dir).selectExpr(*cells)


def place_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One place per nation with the payload's variable names, all text; customers fold before the join.

    Nation 7 carries the negative income placeholder, nation 9 a suffix that is not listed.
    """
    folded = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.expr("sum(cast(rint(c_acctbal * 100) AS bigint)) / 100.0D / count(c_acctbal) * 10 AS INCOME"),
        F.expr("max(c_acctbal) * 100 AS HOME_VALUE"),
        F.expr("count(*) AS PEOPLE"),
        F.expr("count_if(c_mktsegment = 'BUILDING') AS DEGREES"),
        F.expr("count_if(c_acctbal > 0) AS ADULTS"),
        F.expr("count_if(c_mktsegment = 'MACHINERY') AS MAJORITY"),
    )
    return folded.join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey")).selectExpr(
        """n_name || CASE WHEN n_nationkey = 9 THEN ' village, Texas' WHEN n_nationkey % 3 = 0 THEN ' city, Texas'
                          WHEN n_nationkey % 3 = 1 THEN ' town, Texas' ELSE ' CDP, Texas' END AS NAME""",
        "CASE WHEN n_nationkey = 7 THEN '-666666666' ELSE cast(INCOME AS string) END AS B19013_001E",
        "cast(HOME_VALUE AS string) AS B25077_001E",
        "cast(PEOPLE AS string) AS B01003_001E",
        "cast(DEGREES AS string) AS B15003_022E",
        "cast(ADULTS AS string) AS B15003_001E",
        "cast(PEOPLE AS string) AS B03002_001E",
        "cast(MAJORITY AS string) AS B03002_003E",
        "lpad(cast(n_regionkey AS string), 2, '0') AS state",
        "lpad(cast(n_nationkey AS string), 5, '0') AS place",
    )


def place_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array-of-arrays payload per customer: a header row and one data row, in two header orders."""
    return table(spark, sf_dir, "customer").selectExpr(
        """to_json(CASE WHEN c_mktsegment = 'BUILDING'
            THEN array(array('place', 'NAME', 'B19013_001E'),
                       array(cast(c_custkey AS string), c_name || ' city, Texas', cast(c_acctbal AS string)))
            ELSE array(array('NAME', 'B19013_001E', 'place'),
                       array(c_name || ' city, Texas', cast(c_acctbal AS string), cast(c_custkey AS string)))
            END) AS PAYLOAD"""
    )


def labour_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed labour points: one per event, with the event type as metro."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_type AS METRO_AREA",
        "year(ts) AS YEAR",
        "date_format(ts, 'MMMM') AS MONTH",
        "value AS UNEMPLOYMENT_RATE",
    )


def labour_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested response per event: a single series, named by event type, with a single point."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """to_json(named_struct('Results', named_struct('series', array(named_struct(
            'seriesID', event_type,
            'data', array(named_struct(
                'year', date_format(ts, 'yyyy'), 'period', 'M' || date_format(ts, 'MM'),
                'periodName', date_format(ts, 'MMMM'), 'value', cast(value AS string)))))))) AS PAYLOAD""",
    )


PLACE_HEADER = "array('NAME', 'B19013_001E', 'state', 'place')"


def place_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed table responses of up to 40 customers each, every customer in at least one.

    A third of them landed again with other names, and that once more in a further file; beside some lies a response
    cut short, one without rows, or one whose header lacks a column.
    """
    cells = "cast(c_acctbal AS string), lpad(cast(c_nationkey AS string), 2, '0'), cast(c_custkey AS string)"
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey div 40 AS block",
        f"struct(c_custkey, array(c_name || ' city, Texas', {cells}) AS cells) AS first",
        f"struct(c_custkey, array(c_name || ' town, Texas', {cells}) AS cells) AS second",
    )
    listed = "to_json(concat(array({h}), transform(array_sort(collect_list({c})), r -> r.cells))) AS {c}"
    blocks = rows.groupBy("block").agg(*[F.expr(listed.format(h=PLACE_HEADER, c=c)) for c in ("first", "second")])
    return blocks.selectExpr(
        "block",
        f"""inline(filter(array(
            named_struct('landing', 1, 'kind', 'all', 'PAYLOAD', first),
            named_struct('landing', 2, 'kind', IF(block % 3 = 0, 'again', null), 'PAYLOAD', second),
            named_struct('landing', 2, 'kind', IF(block % 3 = 0, 'again, copied', null), 'PAYLOAD', second),
            named_struct('landing', 3, 'kind', IF(block % 7 = 3, 'cut', null), 'PAYLOAD', substr(first, 1, length(first) div 2)),
            named_struct('landing', 3, 'kind', IF(block % 7 = 5, 'empty', null), 'PAYLOAD', to_json(array({PLACE_HEADER}))),
            named_struct('landing', 3, 'kind', IF(block % 7 = 6, 'narrow', null), 'PAYLOAD', replace(second, '"place"', '"PLACE_NO"'))
        ), l -> l.kind IS NOT NULL))""",
    ).selectExpr(
        "concat_ws('/', block, landing, kind) AS PAYLOAD_FILE",
        "timestamp_seconds(1700000000 + landing) AS LANDED_AT",
        "PAYLOAD",
    )


def labour_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed series responses of 50 events each: a series per event type, a point per event; a quarter came again, raised by one."""
    point = """struct(event_id, named_struct('year', date_format(ts, 'yyyy'), 'period', 'E' || event_id, 'periodName',
               date_format(ts, 'MMMM'), 'value', cast(value + {raised} AS string)) AS p) AS {name}"""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id div 50 AS block", "event_type", point.format(raised=0, name="first"), point.format(raised=1, name="second")
    )
    listed = "transform(array_sort(collect_list({c})), x -> x.p) AS {c}"
    series = events.groupBy("block", "event_type").agg(*[F.expr(listed.format(c=c)) for c in ("first", "second")])
    body = """to_json(named_struct('status', 'REQUEST_SUCCEEDED', 'Results', named_struct('series', array_sort(collect_list(
              named_struct('seriesID', event_type, 'data', {c})))))) AS {c}"""
    blocks = series.groupBy("block").agg(*[F.expr(body.format(c=c)) for c in ("first", "second")])
    return blocks.selectExpr(
        "block",
        """inline(filter(array(named_struct('landing', 1, 'PAYLOAD', first),
            named_struct('landing', 2, 'PAYLOAD', IF(block % 4 = 1, second, null))), l -> l.PAYLOAD IS NOT NULL))""",
    ).selectExpr("concat_ws('/', block, landing) AS PAYLOAD_FILE", "timestamp_seconds(1700000000 + landing) AS LANDED_AT", "PAYLOAD")
