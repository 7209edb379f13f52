"""The same queries in plain SQL, written for another engine over the same tables.

Written on their own: self-joins where the library folds, plain windows where it orders
in ranges, decimals where it sums whole cents.
"""

from __future__ import annotations

MARKET = """
market AS (
    SELECT n_name AS CITY, r_name AS STATE, r_name AS STATE_CODE, c_mktsegment AS PARENT_METRO_REGION,
           CAST(o_orderdate AS DATE) AS PERIOD_END, p_type AS PROPERTY_TYPE,
           CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL ELSE l_extendedprice END AS MEDIAN_SALE_PRICE,
           CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL
                ELSE (CAST(round(l_extendedprice * 100) AS BIGINT) * 101 // 100) / 100.0::DOUBLE END AS MEDIAN_LIST_PRICE,
           CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN NULL
                ELSE (CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS INTEGER)) / 100.0::DOUBLE
           END AS MEDIAN_PPSF,
           CAST(l_quantity AS INTEGER) AS HOMES_SOLD, p_size AS INVENTORY,
           CAST((l_orderkey + 7 * l_linenumber) % 120 AS INTEGER) AS MEDIAN_DOM
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
)"""

FEED = (
    MARKET
    + """,
feed AS (
    SELECT CITY, STATE, STATE_CODE, PARENT_METRO_REGION, CAST(PERIOD_END AS VARCHAR) AS PERIOD_END, PROPERTY_TYPE,
           coalesce(CAST(MEDIAN_SALE_PRICE AS VARCHAR), 'NA') AS MEDIAN_SALE_PRICE,
           coalesce(CAST(MEDIAN_LIST_PRICE AS VARCHAR), 'NA') AS MEDIAN_LIST_PRICE,
           coalesce(CAST(MEDIAN_PPSF AS VARCHAR), 'NA') AS MEDIAN_PPSF,
           CAST(HOMES_SOLD AS VARCHAR) AS HOMES_SOLD, CAST(INVENTORY AS VARCHAR) AS INVENTORY,
           CAST(MEDIAN_DOM AS VARCHAR) AS MEDIAN_DOM
    FROM market
)"""
)

GOLD = (
    MARKET
    + """,
gold AS (
    SELECT CITY, CAST(year(PERIOD_END) AS INTEGER) AS YEAR, PROPERTY_TYPE,
           CAST(sum(CAST(MEDIAN_SALE_PRICE AS DECIMAL(18, 2))) AS DOUBLE) / count(MEDIAN_SALE_PRICE) AS AVG_SALE_PRICE,
           CAST(sum(CAST(MEDIAN_PPSF AS DECIMAL(18, 2))) AS DOUBLE) / count(MEDIAN_PPSF) AS AVG_PRICE_PER_SQFT,
           CAST(sum(HOMES_SOLD) AS BIGINT) AS TOTAL_HOMES_SOLD,
           avg(MEDIAN_DOM) AS AVG_DAYS_ON_MARKET, avg(INVENTORY) AS AVG_INVENTORY
    FROM market
    WHERE MEDIAN_SALE_PRICE IS NOT NULL
    GROUP BY ALL
)"""
)

LABOUR = """
labour AS (
    SELECT CAST(year(ts) AS INTEGER) AS YEAR, value AS UNEMPLOYMENT_RATE FROM events WHERE event_type = 'error'
),
rate AS (
    SELECT YEAR, CAST(sum(CAST(UNEMPLOYMENT_RATE AS DECIMAL(18, 2))) AS DOUBLE) / count(UNEMPLOYMENT_RATE)
           AS AVG_UNEMPLOYMENT_RATE
    FROM labour WHERE YEAR = 2024 GROUP BY YEAR
)"""

PLACES = """
place AS (
    SELECT n_name || CASE WHEN n_nationkey = 9 THEN ' village, Texas' WHEN n_nationkey % 3 = 0 THEN ' city, Texas'
                          WHEN n_nationkey % 3 = 1 THEN ' town, Texas' ELSE ' CDP, Texas' END AS CITY_NAME,
           CASE WHEN n_nationkey = 7 THEN -666666666.0::DOUBLE
                ELSE CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) / count(*) * 10 END AS MEDIAN_INCOME,
           max(c_acctbal) * 100 AS MEDIAN_HOME_VALUE,
           count(*) AS POPULATION,
           count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS BACHELORS_DEGREE,
           count(*) FILTER (WHERE c_acctbal > 0) AS POPULATION_25PLUS,
           count(*) AS TOTAL_POP_RACE,
           count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS WHITE_NON_HISPANIC,
           lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS STATE_CODE,
           lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS PLACE_CODE
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_nationkey, n_name, n_regionkey
),
profile AS (
    SELECT *, regexp_replace(CITY_NAME, ' (city|town|CDP), Texas$', '') AS CITY,
           round_even((1 - WHITE_NON_HISPANIC::DOUBLE / TOTAL_POP_RACE) * 100 * 10, 0) / 10 AS DIVERSITY_PCT,
           round_even(BACHELORS_DEGREE::DOUBLE / POPULATION_25PLUS * 100 * 10, 0) / 10 AS BACHELORS_PCT
    FROM place
)"""

COMBINED = f"""
{GOLD}, {LABOUR}, {PLACES},
combined AS (
    SELECT p.*, g.AVG_SALE_PRICE, g.AVG_PRICE_PER_SQFT, g.TOTAL_HOMES_SOLD, g.AVG_DAYS_ON_MARKET,
           (SELECT AVG_UNEMPLOYMENT_RATE FROM rate) AS UNEMPLOYMENT_RATE
    FROM profile p JOIN gold g ON p.CITY = g.CITY
    WHERE g.YEAR = 2000 AND g.PROPERTY_TYPE = 'ECONOMY'
)"""


def _scored(source: str, weights: tuple[float, float, float, float, float]) -> str:
    def up(metric: str) -> str:
        return f"(c.{metric} - m.lo_{metric}) / (m.hi_{metric} - m.lo_{metric}) * 100"

    def down(metric: str) -> str:
        return f"(1 - (c.{metric} - m.lo_{metric}) / (m.hi_{metric} - m.lo_{metric})) * 100"

    metrics = ("MEDIAN_INCOME", "BACHELORS_PCT", "DIVERSITY_PCT", "AVG_SALE_PRICE", "AVG_DAYS_ON_MARKET")
    extremes = ", ".join(f"min({m}) AS lo_{m}, max({m}) AS hi_{m}" for m in metrics)
    names = ("INCOME_SCORE", "EDUCATION_SCORE", "DIVERSITY_SCORE", "AFFORDABILITY_SCORE", "MARKET_SPEED_SCORE")
    total = " + ".join(f"{n} * {w}::DOUBLE" for n, w in zip(names, weights, strict=True))
    return f"""
{COMBINED},
usable AS ({source}),
extremes AS (SELECT {extremes} FROM usable),
parts AS (
    SELECT c.*, {up(metrics[0])} AS INCOME_SCORE, {up(metrics[1])} AS EDUCATION_SCORE,
           {up(metrics[2])} AS DIVERSITY_SCORE, {down(metrics[3])} AS AFFORDABILITY_SCORE,
           {down(metrics[4])} AS MARKET_SPEED_SCORE
    FROM usable c CROSS JOIN extremes m
),
totals AS (SELECT *, {total} AS OVERALL_SCORE FROM parts),
ranked AS (
    SELECT *, CAST(floor(rank() OVER (ORDER BY OVERALL_SCORE DESC)
                         + (count(*) OVER (PARTITION BY OVERALL_SCORE) - 1) / 2.0) AS INTEGER) AS RANK
    FROM totals
)"""


SCORED_B = _scored("SELECT * FROM combined WHERE MEDIAN_INCOME > 0", (0.30, 0.25, 0.15, 0.15, 0.15))
SCORED_A = _scored("SELECT * FROM combined", (0.25, 0.20, 0.15, 0.25, 0.15))

PAIR = f"""
{GOLD}, {LABOUR},
cur AS (
    SELECT CITY, AVG_SALE_PRICE AS Current_Price, AVG_DAYS_ON_MARKET AS Days_On_Market, TOTAL_HOMES_SOLD AS Sales_Volume
    FROM gold WHERE PROPERTY_TYPE = 'ECONOMY' AND YEAR = 2000 AND TOTAL_HOMES_SOLD >= 1400
),
bas AS (
    SELECT CITY, AVG_SALE_PRICE AS Base_Price FROM gold WHERE PROPERTY_TYPE = 'ECONOMY' AND YEAR = 1995
)"""

APPRECIATION = """round(CASE WHEN Base_Price > 0 THEN (Current_Price - Base_Price) / Base_Price * 100 END, {places})"""
ANNUALIZED = "CASE WHEN Base_Price > 0 THEN (power(Current_Price / Base_Price, 1.0::DOUBLE / 5) - 1) * 100 END"

BENCHMARK = """
benchmark(POSITION, CITY) AS (VALUES
    (1, 'NATION_2'), (2, 'NATION_5'), (3, 'NATION_7'), (4, 'NATION_8'), (5, 'NATION_11'), (6, 'NATION_13'),
    (7, 'NATION_17'), (8, 'NATION_18'), (9, 'NATION_21'), (10, 'NATION_24')
),
ours AS (SELECT CITY FROM ranked ORDER BY RANK ASC NULLS LAST, CITY LIMIT 12)"""

LISTING = "SELECT RANK, CITY, OVERALL_SCORE, MEDIAN_INCOME, AVG_SALE_PRICE, BACHELORS_PCT FROM ranked"

PANEL = """PROPERTY_TYPE = 'ECONOMY' AND CITY IN ('NATION_1', 'NATION_4', 'NATION_9', 'NATION_16', 'NATION_23')"""


def _ultimate(share: str) -> str:
    return f"""
WITH {PAIR},
tops AS (SELECT max(Current_Price) AS mp, max(Days_On_Market) AS md, max(Sales_Volume) AS mv FROM cur)
SELECT CITY, Current_Price, Days_On_Market, Sales_Volume, Base_Price,
       {APPRECIATION.format(places=1)} AS Appreciation_Pct,
       (SELECT AVG_UNEMPLOYMENT_RATE FROM rate) AS Unemployment_Rate,
       round(Current_Price / mp * 25 + Days_On_Market / md * 20 + (1 - {share}) * 15
             + CASE WHEN Base_Price > 0 THEN (1 - (Current_Price - Base_Price) / Base_Price) * 25 ELSE 25 END
             + (SELECT AVG_UNEMPLOYMENT_RATE FROM rate) / 10 * 15, 6) AS Ultimate_Score
FROM cur LEFT JOIN bas USING (CITY) CROSS JOIN tops
WHERE Base_Price IS NOT NULL
ORDER BY Ultimate_Score ASC NULLS FIRST, CITY LIMIT 20"""


def _cleaning_counts() -> str:
    measures = ("MEDIAN_SALE_PRICE", "MEDIAN_LIST_PRICE", "MEDIAN_PPSF", "HOMES_SOLD", "INVENTORY", "MEDIAN_DOM")
    return f"WITH {FEED}\n" + "\nUNION ALL\n".join(
        f"""SELECT '{m}' AS MEASURE, count({m}) AS PRESENT, count(*) FILTER (WHERE {m} = 'NA') AS MARKED_MISSING,
       count(*) FILTER (WHERE {m} <> 'NA' AND TRY_CAST({m} AS DOUBLE) IS NULL) AS UNREADABLE FROM feed"""
        for m in measures
    )


DAMAGED = f"""
{MARKET},
damaged AS (
    SELECT * REPLACE (
        CASE WHEN MEDIAN_DOM % 13 = 5 THEN strftime(PERIOD_END, '%d/%m/%Y') ELSE PERIOD_END::VARCHAR END AS PERIOD_END,
        CASE WHEN MEDIAN_DOM % 17 = 3 THEN 'many' WHEN MEDIAN_DOM % 17 = 4 THEN HOMES_SOLD || '.5'
             ELSE HOMES_SOLD::VARCHAR END AS HOMES_SOLD,
        CASE WHEN MEDIAN_DOM % 19 = 7 THEN 'on request' ELSE coalesce(MEDIAN_SALE_PRICE::VARCHAR, 'NA') END AS MEDIAN_SALE_PRICE,
        coalesce(MEDIAN_LIST_PRICE::VARCHAR, 'NA') AS MEDIAN_LIST_PRICE, coalesce(MEDIAN_PPSF::VARCHAR, 'NA') AS MEDIAN_PPSF,
        INVENTORY::VARCHAR AS INVENTORY, MEDIAN_DOM::VARCHAR AS MEDIAN_DOM)
    FROM market
)"""


def _feed_audit() -> str:
    grains = ("national", "state", "metro", "county", "city", "zip", "neighborhood")
    columns = ("MEDIAN_SALE_PRICE", "MEDIAN_LIST_PRICE", "MEDIAN_PPSF", "HOMES_SOLD", "INVENTORY", "MEDIAN_DOM", "PERIOD_END")
    lines = [
        f"""SELECT 'city' AS SOURCE, TRUE AS LANDED, '{c}' AS COLUMN_NAME, count(*) AS ROW_COUNT, count({c}) AS PRESENT,
       count(*) FILTER (WHERE {c} = 'NA') AS MARKED_MISSING,
       count(*) FILTER (WHERE {c} <> 'NA' AND TRY_CAST({c} AS {'DATE' if c == 'PERIOD_END' else 'DOUBLE'}) IS NULL)
           AS UNREADABLE FROM damaged"""
        for c in columns
    ]
    lines += [f"SELECT '{g}', FALSE, '{c}', 0, 0, 0, 0" for g in grains if g != "city" for c in columns]
    return f"WITH {DAMAGED}\n" + "\nUNION ALL\n".join(lines)


METRO_GOLD = f"""
{MARKET},
gold AS (
    SELECT CITY, PARENT_METRO_REGION, CAST(year(PERIOD_END) AS INTEGER) AS YEAR, PROPERTY_TYPE,
           CAST(sum(CAST(MEDIAN_SALE_PRICE AS DECIMAL(18, 2))) AS DOUBLE) / count(MEDIAN_SALE_PRICE) AS AVG_SALE_PRICE,
           CAST(sum(HOMES_SOLD) AS BIGINT) AS TOTAL_HOMES_SOLD, avg(MEDIAN_DOM) AS AVG_DAYS_ON_MARKET
    FROM market WHERE MEDIAN_SALE_PRICE IS NOT NULL GROUP BY ALL
)"""

ORACLE_SQL: dict[str, str] = {
    "place_landings": """
SELECT c_name || CASE WHEN c_custkey // 40 % 3 = 0 THEN ' town, Texas' ELSE ' city, Texas' END AS "NAME",
       c_acctbal::VARCHAR AS B19013_001E, lpad(c_nationkey::VARCHAR, 2, '0') AS state, c_custkey::VARCHAR AS place
FROM customer""",
    "payload_rejects": """
WITH blocks AS (SELECT c_custkey // 40 AS b, count(*) AS n FROM customer GROUP BY 1),
told AS (
    SELECT 'usable' AS REASON, n FROM blocks
    UNION ALL SELECT 'usable', n FROM blocks WHERE b % 3 = 0
    UNION ALL SELECT 'usable', n FROM blocks WHERE b % 3 = 0
    UNION ALL SELECT 'unreadable', 0 FROM blocks WHERE b % 7 = 3
    UNION ALL SELECT 'no rows', 0 FROM blocks WHERE b % 7 = 5
    UNION ALL SELECT 'header lacks columns', 0 FROM blocks WHERE b % 7 = 6)
SELECT REASON, count(*) AS PAYLOADS, sum(n)::BIGINT AS ROW_COUNT FROM told GROUP BY REASON""",
    "labour_landings": """
SELECT event_type AS "seriesID", strftime(ts, '%Y') AS year, 'E' || event_id AS period, monthname(ts) AS "periodName",
       CASE WHEN event_id // 50 % 4 = 1 THEN value + 1 ELSE value END AS value
FROM events""",
    "feed_audit": _feed_audit(),
    "bronze_to_gold": f"""
WITH {DAMAGED},
silver AS (
    SELECT CITY, TRY_CAST(PERIOD_END AS DATE) AS PERIOD_END, PROPERTY_TYPE,
           TRY_CAST(MEDIAN_SALE_PRICE AS DECIMAL(18, 2)) AS price, TRY_CAST(MEDIAN_PPSF AS DECIMAL(18, 2)) AS ppsf,
           trunc(TRY_CAST(HOMES_SOLD AS DOUBLE)) AS sold, MEDIAN_DOM::INTEGER AS dom, INVENTORY::INTEGER AS stock
    FROM damaged WHERE STATE_CODE = 'ASIA')
SELECT CITY, year(PERIOD_END)::INTEGER AS YEAR, PROPERTY_TYPE, sum(price)::DOUBLE / count(price) AS AVG_SALE_PRICE,
       sum(ppsf)::DOUBLE / count(ppsf) AS AVG_PRICE_PER_SQFT, sum(sold)::BIGINT AS TOTAL_HOMES_SOLD,
       avg(dom) AS AVG_DAYS_ON_MARKET, avg(stock) AS AVG_INVENTORY
FROM silver WHERE price IS NOT NULL GROUP BY ALL""",
    "appreciation_by_metro": f"""
WITH {METRO_GOLD}
SELECT c.CITY, c.PARENT_METRO_REGION, c.AVG_SALE_PRICE AS Current_Price, c.AVG_DAYS_ON_MARKET AS Days_On_Market,
       c.TOTAL_HOMES_SOLD AS Sales_Volume, b.AVG_SALE_PRICE AS Base_Price,
       round((c.AVG_SALE_PRICE - b.AVG_SALE_PRICE) / b.AVG_SALE_PRICE * 100, 6) AS Appreciation_Pct,
       round((power(c.AVG_SALE_PRICE / b.AVG_SALE_PRICE, 1.0::DOUBLE / 5) - 1) * 100, 6) AS Annualized_Return_Pct
FROM gold c JOIN gold b USING (CITY, PARENT_METRO_REGION)
WHERE c.PROPERTY_TYPE = 'ECONOMY' AND b.PROPERTY_TYPE = 'ECONOMY' AND c.YEAR = 2000 AND b.YEAR = 1995""",
    "yoy_change_by_metro": f"""
WITH {METRO_GOLD},
kept AS (
    SELECT *, lag(AVG_SALE_PRICE) OVER (PARTITION BY CITY, PARENT_METRO_REGION ORDER BY YEAR) AS before
    FROM gold WHERE {PANEL} AND YEAR >= 1996)
SELECT CITY, PARENT_METRO_REGION, YEAR, round(AVG_SALE_PRICE, 0) AS AVG_PRICE,
       round(AVG_SALE_PRICE - before, 0) AS PRICE_CHANGE, round((AVG_SALE_PRICE - before) / before * 100, 1) AS PCT_CHANGE
FROM kept""",
    "source_row_audit": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS SOURCE, count(*) AS ROW_COUNT FROM {t}"
        for t in ("region", "nation", "customer", "part", "orders", "lineitem", "events")
    ),
    "cleaning_audit": _cleaning_counts(),
    "json_payload_extract": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "labour_payload_points": """
SELECT event_id, event_type AS "seriesID", strftime(ts, '%Y') AS year, 'M' || strftime(ts, '%m') AS period,
       monthname(ts) AS "periodName", CAST(value AS VARCHAR) AS value FROM events""",
    "labour_typed": """
SELECT CASE WHEN event_type = 'error' THEN 'Dallas-Fort Worth' ELSE event_type END AS METRO_AREA,
       CAST(year(ts) AS INTEGER) AS YEAR, monthname(ts) AS MONTH, count(*) AS POINTS,
       min(value) AS LOWEST_RATE, max(value) AS HIGHEST_RATE
FROM events GROUP BY 1, 2, 3""",
    "place_payload_rows": """
SELECT c_name || ' city, Texas' AS NAME, CAST(c_acctbal AS VARCHAR) AS B19013_001E,
       CAST(c_custkey AS VARCHAR) AS place FROM customer""",
    "bronze_state": f"WITH {FEED} SELECT * FROM feed WHERE STATE_CODE = 'ASIA'",
    "metro_slice": f"""
WITH {FEED} SELECT CITY, STATE, PARENT_METRO_REGION, MEDIAN_SALE_PRICE, PERIOD_END
FROM feed WHERE PARENT_METRO_REGION LIKE '%BUILD%'""",
    "metro_cities": f"""
WITH {MARKET} SELECT DISTINCT CITY FROM market
WHERE PARENT_METRO_REGION LIKE '%BUILD%' AND MEDIAN_SALE_PRICE IS NOT NULL""",
    "silver_clean": f"""
WITH {MARKET} SELECT * REPLACE (CAST(PERIOD_END AS VARCHAR) AS PERIOD_END), PERIOD_END AS PERIOD_END_DATE
FROM market WHERE MEDIAN_SALE_PRICE IS NOT NULL""",
    "gold_summary": f"WITH {GOLD} SELECT * FROM gold",
    "gold_preview": f"""
WITH {GOLD} SELECT * FROM gold
ORDER BY CITY NULLS FIRST, YEAR NULLS FIRST, PROPERTY_TYPE NULLS FIRST LIMIT 10""",
    "price_ranges": f"""
WITH {GOLD} SELECT PROPERTY_TYPE, max(AVG_SALE_PRICE) AS HighestAvgPrice, min(AVG_SALE_PRICE) AS LowestAvgPrice,
       round(avg(AVG_SALE_PRICE), 4) AS OverallAvgPrice, count(*) AS TotalRecords
FROM gold WHERE AVG_SALE_PRICE IS NOT NULL GROUP BY PROPERTY_TYPE""",
    "price_extremes": f"""
WITH {GOLD}, ordered AS (
    SELECT *, row_number() OVER (PARTITION BY PROPERTY_TYPE ORDER BY AVG_SALE_PRICE DESC, CITY, YEAR) AS from_top,
           row_number() OVER (PARTITION BY PROPERTY_TYPE ORDER BY AVG_SALE_PRICE ASC, CITY, YEAR) AS from_bottom
    FROM gold WHERE AVG_SALE_PRICE IS NOT NULL
)
SELECT 'HIGHEST' AS "PriceCategory", PROPERTY_TYPE, CITY, YEAR, AVG_SALE_PRICE, TOTAL_HOMES_SOLD
FROM ordered WHERE from_top = 1
UNION ALL
SELECT 'LOWEST', PROPERTY_TYPE, CITY, YEAR, AVG_SALE_PRICE, TOTAL_HOMES_SOLD FROM ordered WHERE from_bottom = 1""",
    "top_cities_report": f"""
WITH {GOLD} SELECT CITY, round(avg(AVG_SALE_PRICE), 0) AS AVG_PRICE, round(avg(AVG_DAYS_ON_MARKET), 0) AS AVG_DOM,
       CAST(sum(TOTAL_HOMES_SOLD) AS BIGINT) AS TOTAL_SOLD
FROM gold WHERE YEAR = 2000 AND PROPERTY_TYPE = 'ECONOMY' GROUP BY CITY
ORDER BY AVG_PRICE DESC NULLS LAST, CITY LIMIT 10""",
    "city_yearly_trend": f"""
WITH {GOLD} SELECT YEAR, round(avg(AVG_SALE_PRICE), 0) AS AVG_PRICE,
       CAST(sum(TOTAL_HOMES_SOLD) AS BIGINT) AS TOTAL_SOLD
FROM gold WHERE CITY = 'NATION_3' AND PROPERTY_TYPE = 'ECONOMY' AND YEAR >= 1996 GROUP BY YEAR""",
    "city_year_panel": f"""
WITH {GOLD} SELECT CITY, YEAR, round(AVG_SALE_PRICE, 0) AS AVG_PRICE,
       round(AVG_DAYS_ON_MARKET, 0) AS DAYS_ON_MARKET
FROM gold WHERE {PANEL} AND YEAR >= 1997""",
    "yoy_change": f"""
WITH {GOLD} SELECT CITY, YEAR, round(AVG_SALE_PRICE, 0) AS AVG_PRICE,
       round(AVG_SALE_PRICE - lag(AVG_SALE_PRICE) OVER w, 0) AS PRICE_CHANGE,
       round((AVG_SALE_PRICE - lag(AVG_SALE_PRICE) OVER w) / lag(AVG_SALE_PRICE) OVER w * 100, 1) AS PCT_CHANGE
FROM gold WHERE {PANEL} AND YEAR >= 1996
WINDOW w AS (PARTITION BY CITY ORDER BY YEAR)""",
    "top_cities_latest_year": f"""
WITH {GOLD} SELECT CITY, YEAR, AVG_SALE_PRICE, AVG_PRICE_PER_SQFT, TOTAL_HOMES_SOLD
FROM gold WHERE PROPERTY_TYPE = 'ECONOMY' AND YEAR = (SELECT max(YEAR) FROM gold) AND AVG_SALE_PRICE IS NOT NULL
ORDER BY AVG_SALE_PRICE DESC, CITY LIMIT 10""",
    "top_cities_min_volume": f"""
WITH {GOLD} SELECT CITY, PROPERTY_TYPE, YEAR, AVG_SALE_PRICE, AVG_PRICE_PER_SQFT, TOTAL_HOMES_SOLD
FROM gold WHERE PROPERTY_TYPE = 'ECONOMY' AND TOTAL_HOMES_SOLD >= 1400 AND YEAR = 2000 AND AVG_SALE_PRICE IS NOT NULL
ORDER BY AVG_SALE_PRICE DESC, CITY LIMIT 10""",
    "deal_score": f"""
WITH {GOLD} SELECT CITY, YEAR, PROPERTY_TYPE, AVG_SALE_PRICE, AVG_DAYS_ON_MARKET, TOTAL_HOMES_SOLD,
       AVG_PRICE_PER_SQFT,
       AVG_SALE_PRICE / 1000000.0::DOUBLE + AVG_DAYS_ON_MARKET / 100.0::DOUBLE - TOTAL_HOMES_SOLD / 100.0::DOUBLE
       AS "DealScore"
FROM gold WHERE PROPERTY_TYPE = 'ECONOMY' AND YEAR = 2000 AND TOTAL_HOMES_SOLD >= 1400
  AND AVG_DAYS_ON_MARKET IS NOT NULL AND AVG_SALE_PRICE IS NOT NULL
ORDER BY "DealScore" ASC, CITY LIMIT 20""",
    "appreciation": f"""
WITH {PAIR} SELECT CITY, Current_Price, Days_On_Market, Sales_Volume, Base_Price,
       {APPRECIATION.format(places=6)} AS Appreciation_Pct, round({ANNUALIZED}, 6) AS Annualized_Return_Pct
FROM cur LEFT JOIN bas USING (CITY) WHERE Base_Price IS NOT NULL""",
    "unemployment_year": f"WITH {LABOUR} SELECT * FROM rate",
    "investment_score": f"""
WITH {PAIR} SELECT CITY, Current_Price, Days_On_Market, Sales_Volume, Base_Price,
       AVG_UNEMPLOYMENT_RATE AS Unemployment_Rate,
       {APPRECIATION.format(places=6)} AS Appreciation_Pct, round({ANNUALIZED}, 6) AS Annualized_Return_Pct,
       round(Current_Price / 100000.0::DOUBLE * 0.3::DOUBLE + (100 - coalesce({ANNUALIZED}, 0)) * 0.5::DOUBLE
             + AVG_UNEMPLOYMENT_RATE * 0.2::DOUBLE, 6) AS Investment_Score
FROM cur LEFT JOIN bas USING (CITY) CROSS JOIN rate
WHERE Base_Price IS NOT NULL AND Current_Price < 53000
ORDER BY Investment_Score ASC NULLS FIRST, CITY LIMIT 20""",
    "ultimate_score": _ultimate("Sales_Volume::DOUBLE / mv"),
    "ultimate_score_intdiv": _ultimate("Sales_Volume // mv"),
    "city_profile": f"WITH {PLACES} SELECT * FROM profile",
    "largest_places": f"""
WITH {PLACES} SELECT CITY, POPULATION, MEDIAN_INCOME, MEDIAN_HOME_VALUE, DIVERSITY_PCT, BACHELORS_PCT
FROM profile ORDER BY POPULATION DESC NULLS LAST, CITY LIMIT 20""",
    "city_semi_match": f"""
WITH {MARKET}, {PLACES} SELECT * FROM profile
WHERE CITY IN (SELECT CITY FROM market WHERE PARENT_METRO_REGION LIKE '%BUILD%' AND MEDIAN_SALE_PRICE IS NOT NULL)""",
    "city_search": f"""
WITH {GOLD}, {PLACES}
SELECT 'census' AS SOURCE, CITY FROM profile WHERE contains(lower(CITY), 'nation_1')
UNION ALL
SELECT 'market', CITY FROM gold
WHERE YEAR = 2000 AND PROPERTY_TYPE = 'ECONOMY' AND contains(lower(CITY), 'nation_1')""",
    "city_combined": f"WITH {COMBINED} SELECT * FROM combined",
    "city_scores": f"WITH {SCORED_B} SELECT * FROM ranked",
    "city_scores_profile_a": f"WITH {SCORED_A} SELECT * FROM ranked",
    "ranking_head": f"WITH {SCORED_B} {LISTING} ORDER BY RANK ASC NULLS LAST, CITY LIMIT 10",
    "ranking_tail": f"WITH {SCORED_B} {LISTING} ORDER BY RANK DESC NULLS FIRST, CITY DESC LIMIT 10",
    "benchmark_overlap": f"WITH {SCORED_B}, {BENCHMARK} SELECT POSITION, CITY FROM benchmark SEMI JOIN ours USING (CITY)",
    "benchmark_agreement": f"""
WITH {SCORED_B}, {BENCHMARK}
SELECT count(o.CITY) AS MATCHES, count(*) AS BENCHMARK_SIZE, count(o.CITY)::DOUBLE / count(*) AS MATCH_SHARE,
       coalesce(string_agg(o.CITY, ', ' ORDER BY POSITION), '') AS MATCHED_CITIES
FROM benchmark b LEFT JOIN ours o ON b.CITY = o.CITY""",
    "benchmark_lookup": f"""
WITH {SCORED_B}, asked(POSITION, CITY) AS (VALUES (1, 'NATION_2'), (2, 'NATION_7'), (3, 'NATION_24'))
SELECT POSITION, a.CITY, RANK, OVERALL_SCORE,
       CASE WHEN r.CITY IS NULL THEN 'not in dataset' ELSE 'ranked' END AS STATUS
FROM asked a LEFT JOIN ranked r ON a.CITY = r.CITY""",
    "price_trend": f"""
WITH {GOLD} SELECT YEAR, PROPERTY_TYPE, round(avg(AVG_SALE_PRICE), 4) AS AVG_PRICE
FROM gold WHERE YEAR BETWEEN 1995 AND 2000 GROUP BY YEAR, PROPERTY_TYPE""",
    "property_types": f"WITH {GOLD} SELECT DISTINCT PROPERTY_TYPE FROM gold",
    "city_metrics": f"WITH {GOLD} SELECT * FROM gold WHERE PROPERTY_TYPE = 'ECONOMY'",
    "kpi_cards": f"""
WITH {GOLD} SELECT CAST(sum(TOTAL_HOMES_SOLD) AS BIGINT) AS TOTAL_HOMES_SOLD,
       round(avg(AVG_SALE_PRICE), 4) AS AVG_PRICE FROM gold""",
    "customer_ranks": """
WITH s AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 10)::DOUBLE END AS "OVERALL_SCORE" FROM customer)
SELECT *, CASE WHEN "OVERALL_SCORE" IS NOT NULL THEN CAST(
    count("OVERALL_SCORE") OVER (ORDER BY "OVERALL_SCORE" DESC NULLS LAST RANGE UNBOUNDED PRECEDING)
    - count(*) OVER (PARTITION BY "OVERALL_SCORE") + 1
    + (count(*) OVER (PARTITION BY "OVERALL_SCORE") - 1) // 2 AS INTEGER) END AS "RANK"
FROM s""",
}
