"""Input views over the driver tables, as SQL text both engines run unchanged.

The driver tables are generic, so every query starts from views that give them
the shape of the engine's contracts.  The views are inputs, not results; the
operators under test are written twice, in ``spark_queries`` and in
``oracles``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from partyard import rules

AS_OF = "2024-02-14 00:00:00"
ORDERS_AS_OF = "2001-08-02 00:00:00"
SITE = "https://market.example"


def pick(index: str, values: list[str | None]) -> str:
    """The text at a zero-based integer index; one compact expression."""
    joined = ";".join("~" if v is None else v for v in values).replace("'", "''")
    return f"NULLIF(split_part('{joined}', ';', CAST({index} AS INT) + 1), '~')"


# Raw spellings of the ten searched vehicles; several need an alias.
MAKES = ["Ford", "chevy", "Ram", "Toyota", "Honda", "TOYOTA", "Honda", "Toyota", "Honda", "Nissan"]
MODELS = [
    "F-150", "Silverado 1500", "1500", "Camry", "Accord",
    "Corolla", "Civic", "RAV4", "crv", "Rogue",
]
PARTS = rules.SEARCH_PARTS


def _money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(12,2)) AS STRING)"


def _vehicle_key(key: str) -> str:
    return (
        f"CAST(2012 + {key} % 9 AS STRING) || '|' || {pick(f'{key} % 10', MAKES)} || '|' || "
        f"{pick(f'{key} % 10', MODELS)} || ' ' || CAST({key} AS STRING)"
    )


_CELL = f"""
    CAST(2012 + l_orderkey % 3 AS INT) AS search_year,
    CASE WHEN l_suppkey % 10 = 9 AND l_orderkey % 4 = 0 THEN NULL
         ELSE {pick("l_suppkey % 10", MAKES)} END AS search_make,
    {pick("l_suppkey % 10", MODELS)} AS search_model,
    {pick("l_partkey % 31", PARTS)} AS search_part
"""

VIEWS: dict[str, str] = {}

VIEWS["listing_cells"] = f"""
SELECT *, {_CELL} FROM lineitem
"""

VIEWS["listings"] = f"""
SELECT
    'run-' || l_returnflag AS run_id,
    CAST(l_shipdate AS STRING) AS scrape_ts,
    CASE l_linestatus WHEN 'F' THEN 'sold' ELSE 'all' END AS pass_type,
    search_year, search_make, search_model, search_part,
    '{SITE}/sch/' || CAST(l_partkey % 31 AS STRING) AS search_url,
    CAST(1 + l_linenumber % 2 AS INT) AS search_page,
    CASE l_orderkey % 97 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Shop on eBay'
         WHEN 3 THEN 'SPONSORED ' || search_part
         ELSE CAST(search_year AS STRING) || '  ' || COALESCE(search_make, 'lexus') || ' '
              || search_model || ' ' || search_part
              || {pick("l_orderkey % 11", [" OEM Used", " New ", " Reman 12345-67890", " 2012-2015 OEM", " bulb", "", " ECM TCM set", " headlamp alternator", " fits 2500 super duty 2014/2016", " A2045 AB123456", " not working trim"])}
    END AS title,
    CASE l_linenumber
         WHEN 6 THEN '$' || {_money("l_extendedprice")} || ' to $' || {_money("l_extendedprice + 10")}
         WHEN 7 THEN NULL
         WHEN 5 THEN 'US $' || CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS STRING) || ','
              || lpad({_money("l_extendedprice - floor(l_extendedprice / 1000) * 1000")}, 6, '0')
         ELSE '$' || {_money("l_extendedprice")} END AS price_raw,
    {pick("l_partkey % 4", [None, "Free shipping", "Pre-Owned ", ""])} AS subtitle,
    CASE l_orderkey % 13 WHEN 0 THEN '' WHEN 1 THEN NULL
         ELSE '{SITE}/itm/' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
              || '?hash=' || CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS listing_url,
    search_part || {pick("l_suppkey % 7", [" Sold Jan 5, 2025", " Free  shipping", " local PICKUP only", " $12.50 shipping  Sold  Dec 15, 2024", "", " refurbished open box", " remanufactured for parts"])} AS raw_text,
    (l_suppkey % 10) * 93 + (l_orderkey % 3) * 31 + l_partkey % 31 AS grid_position,
    l_orderkey AS position_in_page
FROM listing_cells
"""

VIEWS["sold_listings"] = "SELECT * FROM listings WHERE pass_type = 'sold'"

VIEWS["market"] = """
SELECT search_year, search_make, search_model, search_part,
       COUNT(*) AS result_count, CAST(MAX(l_shipdate) AS STRING) AS scrape_ts
FROM listing_cells
WHERE l_linestatus = 'O'
GROUP BY search_year, search_make, search_model, search_part
"""

VIEWS["sold_history"] = f"""
SELECT CAST(search_year AS STRING) || '|' || search_make || '|' || search_model AS vehicle_key,
       search_year, search_make, search_model, search_part,
       'Used ' || search_part AS title,
       CASE WHEN event_id % 50 = 0 THEN 'call' ELSE '$' || {_money("value")} END AS price_raw,
       '{SITE}/itm/' || CAST(event_id AS STRING) AS listing_url,
       CAST(scraped_at AS DATE) AS sold_date,
       scraped_at, event_id
FROM (
    SELECT event_id, value, ts AS scraped_at,
           CAST(2012 + user_id % 3 AS INT) AS search_year,
           {pick("user_id % 10", MAKES)} AS search_make,
           {pick("user_id % 10", MODELS)} AS search_model,
           {pick("event_id % 31", PARTS)} AS search_part
    FROM events
) AS placed
"""

# One landed page holds at most 60 cards, the page size of the searched site.
VIEWS["cards"] = f"""
SELECT p_partkey AS card_id,
       CAST(floor(p_partkey / 60) AS BIGINT) AS page_id,
       p_name || ' & ' || p_type AS title,
       '$' || {_money("p_retailprice")} AS price_raw,
       CASE p_partkey % 9 WHEN 0 THEN '' ELSE '{SITE}/itm/' || CAST(p_partkey AS STRING)
            || '?a=1&b=2' END AS listing_url,
       CAST(1 + p_partkey % 28 AS STRING) AS sold_day,
       p_partkey % 12 AS shape
FROM part
"""

VIEWS["card_html"] = """
SELECT card_id, page_id,
       CASE shape
         WHEN 1 THEN '<li class="s-card"><div class="s-card__title">Shop on eBay</div><span class="s-card__price">$1.00</span></li>'
         WHEN 2 THEN '<li class="s-card s-card--wide" id="c"><div class="s-card__title"></div><span class="s-card__price">$2.00</span></li>'
         WHEN 3 THEN '<li class="s-card"><div class="s-card__title">' || replace(title, '&', '&amp;') || '</div><span class="s-card__price">Best offer</span></li>'
         WHEN 6 THEN '<!-- <li class="s-card"><div class="s-card__title">Hidden</div><span class="s-card__price">$3</span></li> --><li class=s-card><div class="s-card__title"><div>New</div><div> ' || replace(title, '&', '&#00000038;') || '</div></div>'
              || '<span class="s-card__price"><span>$</span>' || substr(price_raw, 2) || '</span></li><span class="s-card__price">$9</span>'
         WHEN 7 THEN '<li class="s-card"><div class="s-card__title">' || replace(title, '&', '&check; &amp &#150;') || '</div></li><span class="s-card__price">$9</span>'
         WHEN 8 THEN '<li class="s-card"><div class="s-card__title">' || replace(title, '&', '&check; &amp &#150;') || '</div><span class="s-card__price">' || price_raw || '</span></li>'
         ELSE '<li data-x="1' || CASE shape WHEN 9 THEN ' > 0 </li>" title=''<b class="s-card__title">'' ' ELSE '" ' END
              || 'class="big s-card"><div class="s-card__title"><span> '
              || replace(title, '&', '</span><b>&amp;</b><span>') || ' </span></div><ul><li>nested</li></ul>'
              || CASE shape WHEN 10 THEN '<script>var x = "</li><span class=s-card__price>$8</span>";</script><style>li > b</style>' ELSE '' END
              || '<span class="a s-card__price">' || CASE shape WHEN 4 THEN '<b>' || price_raw || '</b>' ELSE price_raw END || '</span>'
              || '<div class="s-card__caption"><span>Sold  '
              || CASE shape WHEN 5 THEN 'Foo ' ELSE 'Jan ' END || sold_day || ', 2024</span></div>'
              || CASE listing_url WHEN '' THEN '' ELSE '<a target="_blank" class="s-card__link" href="' || replace(listing_url, '&', '&amp;') || '">x</a>' END
              || CASE shape WHEN 11 THEN '<ol><li class="s-card--row"><b class="s-card__title">Inner<!-- - -->' || title
                   || '</b><span class=s-card__price>$1.<i>50</i></span></ol>' ELSE '' END
              || '</li>'
       END AS card
FROM cards
"""

VIEWS["vin_wide"] = f"""
SELECT CASE WHEN p_partkey % 17 = 0 THEN 'short' ELSE '' END || ' 1hg' || lpad(CAST(p_partkey AS STRING), 14, '0') AS vin,
       CASE WHEN p_partkey % 23 = 0 THEN '' ELSE CAST(2000 + p_size % 20 AS STRING) END AS model_year,
       {pick("p_partkey % 10", [m + " " for m in MAKES])} AS make,
       {pick("p_partkey % 10", MODELS)} AS model,
       CASE WHEN p_size % 5 = 0 THEN 'Not Applicable' ELSE p_type END AS trim_name,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS series,
       {pick("p_partkey % 7", ["Sport Utility Vehicle (SUV)/Multi-Purpose Vehicle (MPV)", "Pickup", "Sedan/Saloon", "Wagon", "Truck-Tractor (heavy)", "", "Cargo Van"])} AS body_class,
       {pick("p_partkey % 6", ["AWD/All-Wheel Drive", "4x4", "FWD/Front-Wheel Drive", "Rear wheel", " 6x2 ", None])} AS drive_type,
       {pick("p_size % 6", ["V-Shaped", "In-Line", "Horizontally opposed (boxer)", "Rotary", "W", None])} AS engine_layout,
       {pick("p_partkey % 4", ["4", " 6 ", "8", None])} AS cylinders,
       {pick("p_partkey % 5", ["3.6", "2.25", "1.95", "unknown", None])} AS displacement,
       {pick("p_partkey % 8", ["Gasoline", "Diesel", "Electric", "Plug-in Hybrid", "Hybrid", "Compressed Natural Gas (CNG)", "Flexible Fuel (E85)", " Steam "])} AS fuel,
       p_brand AS plant
FROM part
"""

VIEWS["result_sets"] = f"""
SELECT o_orderkey AS id,
       {_vehicle_key("o_custkey")} AS vehicle_key,
       CASE WHEN o_orderkey % 5 = 0 THEN 30 ELSE 90 END AS window_days,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running'
            ELSE 'pending' END AS status,
       o_orderdate AS scraped_at,
       o_orderdate + INTERVAL '14' DAY AS cache_expires_at
FROM orders
"""

VIEWS["vehicles"] = f"""
SELECT {_vehicle_key("c_custkey")} AS vehicle_key,
       CAST(2012 + c_custkey % 9 AS INT) AS year,
       {pick("c_custkey % 10", MAKES)} AS make,
       {pick("c_custkey % 10", MODELS)} || ' ' || CAST(c_custkey AS STRING) AS model,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS trim,
       CAST(NULL AS STRING) AS series,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '2.0L I4' END AS engine,
       CAST(NULL AS STRING) AS body_class,
       CAST(NULL AS STRING) AS drive_type,
       CASE WHEN c_custkey % 5 = 0 THEN 'Gas' ELSE NULL END AS fuel_type,
       CAST('1992-01-01 00:00:00' AS TIMESTAMP) AS created_at
FROM customer
"""

VIEWS["grid_vehicles"] = f"""
SELECT {pick("c_custkey % 10", MAKES)} AS make,
       {pick("c_custkey % 10", MODELS)} || ' ' || CAST(c_custkey AS STRING) AS model,
       c_custkey AS position
FROM customer
"""

VIEWS["searched_models"] = """
SELECT DISTINCT COALESCE(search_make, 'lexus') AS make, search_model AS model
FROM listing_cells
"""

VIEWS["completed_searches"] = f"""
SELECT DISTINCT CAST(2012 + o_orderkey % 2 AS STRING) || '|' || {pick("o_custkey % 10", MAKES)} || '|'
       || {pick("o_custkey % 10", MODELS)} || ' ' || CAST(o_custkey AS STRING) || '|'
       || {pick("o_orderkey % 31", PARTS)} || '|sold' AS execution_key
FROM orders
"""

# Search cell of each landed page; a third of the pages ask for a part that the
# history does not know.
VIEWS["landed_pages"] = f"""
SELECT page_id,
       CAST(2012 + page_id % 3 AS STRING) || '|' || {pick("page_id % 10", MAKES)} || '|'
           || {pick("page_id % 10", MODELS)} AS vehicle_key,
       CAST(2012 + page_id % 3 AS INT) AS search_year,
       {pick("page_id % 10", MAKES)} AS search_make,
       {pick("page_id % 10", MODELS)} AS search_model,
       CASE WHEN page_id % 3 = 0 THEN 'turbo' ELSE {pick("page_id % 31", PARTS)} END AS search_part,
       CAST('2024-02-01 12:00:00' AS TIMESTAMP) AS scraped_at
FROM (SELECT DISTINCT page_id FROM cards) AS numbered
"""

VIEWS["stored_profiles"] = """
SELECT __PART__ AS part_name, COUNT(*) AS asked FROM part GROUP BY __PART__
""".replace("__PART__", pick("p_partkey % 20", PARTS[:15] + ["radio", "bed liner", "visor", "hinge", "spoiler"]))

VIEWS["seeded_vehicles"] = """
SELECT CAST(2000 + c_custkey % 20 AS STRING) || '|' || make || '|' || model AS vehicle_key
FROM (SELECT c_custkey, __MAKE__ AS make, __MODEL__ AS model FROM customer) AS seeded
""".replace("__MAKE__", pick("c_custkey % 51", [m for m, _ in rules.SEED_VEHICLES])).replace(
    "__MODEL__", pick("c_custkey % 51", [m for _, m in rules.SEED_VEHICLES])
)

VIEWS["catalog_entries"] = """
SELECT CASE p_size % 3 WHEN 0 THEN 'makes' WHEN 1 THEN 'models' ELSE 'trims' END AS cache_type,
       CASE p_size % 3 WHEN 0 THEN NULL ELSE p_brand END AS make,
       CASE p_size % 3 WHEN 2 THEN p_type ELSE NULL END AS model,
       CASE p_size % 3 WHEN 0 THEN NULL ELSE CAST(2012 + p_size % 4 AS INT) END AS year,
       p_name AS first_name, p_type AS second_name, p_partkey AS seq
FROM part
"""

VIEWS["vehicle_delta"] = f"""
SELECT {_vehicle_key("o_custkey * 2")} AS vehicle_key,
       CAST(2012 + o_custkey * 2 % 9 AS INT) AS year,
       {pick("o_custkey * 2 % 10", MAKES)} AS make,
       {pick("o_custkey * 2 % 10", MODELS)} || ' ' || CAST(o_custkey * 2 AS STRING) AS model,
       CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS trim,
       CASE WHEN o_orderkey % 3 = 0 THEN 'S' || CAST(o_orderkey % 10 AS STRING) ELSE NULL END AS series,
       CAST(NULL AS STRING) AS engine,
       {pick("o_orderkey % 4", ["SUV", None, "Sedan", None])} AS body_class,
       {pick("o_orderkey % 3", ["AWD", None, None])} AS drive_type,
       CAST(NULL AS STRING) AS fuel_type,
       o_orderdate AS created_at,
       o_orderkey AS seq
FROM orders
"""

VIEWS["crawl_status"] = f"""
SELECT vehicle_key, MAX(o_orderdate) AS last_crawled_at,
       COUNT(DISTINCT o_orderpriority) AS parts_scraped,
       COUNT(*) AS total_listings, MAX(o_orderdate) AS updated_at
FROM (SELECT {_vehicle_key("o_custkey * 2")} AS vehicle_key, o_orderdate, o_orderpriority
      FROM orders) AS crawled
GROUP BY vehicle_key
"""

VIEWS["crawl_delta"] = f"""
SELECT {_vehicle_key("o_custkey * 3")} AS vehicle_key,
       o_orderdate AS last_crawled_at, o_orderkey % 31 AS parts_scraped,
       o_orderkey % 500 AS total_listings, o_orderdate AS updated_at
FROM orders
"""

VIEWS["catalog_rows"] = """
SELECT CASE WHEN p_partkey % 41 = 0 THEN '' ELSE p_brand END AS make,
       CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_name END AS model,
       CASE WHEN p_size % 4 = 0 THEN NULL
            WHEN p_brand = 'Brand#7' THEN NULL
            ELSE CAST(2012 + p_size % 3 AS INT) END AS year,
       CASE p_partkey % 11 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE p_type END AS trim,
       p_partkey
FROM part
"""

# Which views a view reads, so that only the needed ones are set up.
_NAMES = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _sources(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\bFROM\s+([a-z_]+)", sql)))


def with_views(body: str) -> str:
    """``body`` for the SQL engine, preceded by the views it reads."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in _NAMES.findall(sql):
            if name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(body)
    steps = [f"{name} AS ({VIEWS[name].strip()})" for name in needed]
    if not steps:
        return body
    text = body.strip()
    if text[:4].upper() == "WITH":
        return "WITH " + ",\n".join(steps) + ",\n" + text[4:].lstrip()
    return "WITH " + ",\n".join(steps) + "\n" + text


class Inputs:
    """The driver tables and the views over them, as Spark DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name not in VIEWS:
            raise AttributeError(name)
        sql = VIEWS[name]
        sources = _sources(sql)
        for source in sources:
            sql = re.sub(rf"\bFROM\s+{source}\b", "FROM {" + source + "}", sql)
        return self.spark.sql(sql, **{source: getattr(self, source) for source in sources})
