"""The same results in plain SQL, written apart from the Spark operators.

Shared steps are named queries; ``compose`` puts the needed ones, and the input
views below them, in front of a body.
"""

from __future__ import annotations

import re

from partyard import rules
from queryset.views import AS_OF, ORDERS_AS_OF, with_views

HISTORY_AS_OF = "2024-02-05 00:00:00"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def half_even(x: str, digits: int) -> str:
    """Half-even rounding of the scaled value."""
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


def exact(x: str, digits: int) -> str:
    """Correct rounding of the binary value, through decimal printing."""
    return f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"


def arms(column: str, table: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {text(a)} THEN {text(b)}" for a, b in table.items())
    return f"CASE {column} {whens} END"


def clean(x: str) -> str:
    return rf"NULLIF(trim(regexp_replace({x}, '\s+', ' ', 'g')), '')"


def token(x: str) -> str:
    return rf"COALESCE(lower(trim(regexp_replace({x}, '\s+', ' ', 'g'))), '')"


def any_of(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {text(w)})" for w in words) + ")" if words else "false"


def first_price(x: str) -> str:
    return (
        rf"TRY_CAST(replace(NULLIF(regexp_extract(replace({x}, '$', ''), '[\d,]+\.?\d*'), ''), ',', '') AS DOUBLE)"
    )


def _set_id(key: str) -> str:
    return f"('0x' || substr(md5({key} || '|{AS_OF}'), 1, 15))::BIGINT"


def median_of(rows: str, keys: list[str], value: str) -> str:
    """Query for the mean of the two middle values of each key."""
    names = ", ".join(keys)
    return f"""
    SELECT {names}, AVG(v) FILTER (rn IN ((n + 1) // 2, (n + 2) // 2)) AS median, MAX(n) AS n
    FROM (SELECT {names}, {value} AS v,
                 row_number() OVER (PARTITION BY {names} ORDER BY {value}) AS rn,
                 COUNT(*) OVER (PARTITION BY {names}) AS n
          FROM {rows}) AS numbered
    GROUP BY {names}"""


def part_std(x: str) -> str:
    return f"CASE WHEN {token(x)} = '' THEN NULL ELSE COALESCE({arms(token(x), rules.PART_ALIASES)}, {token(x)}) END"


def aliased(x: str, table: dict[str, str]) -> str:
    return f"CASE WHEN {token(x)} = '' THEN NULL ELSE COALESCE({arms(token(x), table)}, trim({x})) END"


def word_case(words: list[str]) -> str:
    return (
        "CASE "
        + " ".join(
            rf"WHEN regexp_matches(_lower, '\b{re.escape(w)}\b') THEN {text(w.title())}" for w in words
        )
        + " END"
    )


STEPS: dict[str, str] = {}

_condition = " ".join(
    f"WHEN regexp_matches(_lower, {text(p)}) THEN {text(label)}" for label, p in rules.CONDITION_PATTERNS
)
_number = ", ".join(
    f"NULLIF(regexp_extract(_text, {text('(?i)' + p)}), '')" for p in rules.PART_NUMBER_PATTERNS
)
_parts = ", ".join(
    f"CASE WHEN regexp_matches(_lower, {text(chr(92) + 'b(' + '|'.join(map(re.escape, words)) + ')' + chr(92) + 'b')}) THEN {text(part)} END"
    for part, words in rules.GUESS_PARTS.items()
)
STEPS["cleansed"] = rf"""
SELECT * EXCLUDE (_text, _lower, _numbers, _parts, _years),
    CASE WHEN len(_numbers) >= 2 AND (contains(lower(price_raw), ' to ') OR contains(price_raw, '-'))
         THEN NULL ELSE TRY_CAST(_numbers[1] AS DOUBLE) END AS price_clean,
    CASE {_condition} END AS condition_guess,
    NULLIF(regexp_extract(raw_text, '\b(?:Sold\s+)?([A-Z][a-z]{{2}}\s+\d{{1,2}},\s+\d{{4}})\b', 1), '') AS sold_date_guess,
    {clean(r"regexp_extract(raw_text, '(?i)(Free shipping|Local pickup|(?:\$\d+(?:\.\d{1,2})?)\s+shipping)', 1)")} AS shipping_text,
    NULLIF(concat_ws(' ', {word_case(rules.GUESS_MAKES)}, {word_case(rules.GUESS_MODELS)}), '') AS vehicle_guess,
    CASE WHEN len(_parts) > 1 THEN 'ambiguous' ELSE _parts[1] END AS part_guess,
    upper(COALESCE({_number})) AS part_number_guess,
    NULLIF(regexp_replace(regexp_extract(_text, '\b(?:19|20)\d{{2}}\s*[-/]\s*(?:19|20)\d{{2}}\b'), '\s*[-/]\s*', '-'), '') AS year_range_guess,
    NULLIF(array_to_string(list_sort(list_distinct(_years)), ', '), '') AS years_found
FROM (
    SELECT *, regexp_extract_all(lower(replace(price_raw, ',', '')), '\$?(\d+(?:\.\d{{1,2}})?)', 1) AS _numbers,
           list_filter([{_parts}], lambda x: x IS NOT NULL) AS _parts,
           regexp_extract_all(_text, '\b(19\d{{2}}|20\d{{2}})\b', 1) AS _years
    FROM (
        SELECT *, lower(_text) AS _lower
        FROM (
            SELECT *, trim(COALESCE(title, '') || ' | ' || COALESCE(subtitle, '') || ' | ' || COALESCE(raw_text, ''), ' |') AS _text
            FROM (
                SELECT * REPLACE ({clean("title")} AS title, {clean("subtitle")} AS subtitle,
                    {clean("listing_url")} AS listing_url, {clean("raw_text")} AS raw_text,
                    {clean("price_raw")} AS price_raw)
                FROM listings
            ) AS c1
        ) AS c2
    ) AS c3
) AS c4
"""

_class = " ".join(
    f"WHEN {any_of('_token', c.include)} AND NOT {any_of('_token', c.exclude)} THEN {text(c.name)}"
    for c in rules.CATEGORIES
)
STEPS["standardized"] = rf"""
SELECT * EXCLUDE (_token) REPLACE (regexp_replace(listing_url, '\?.*$', '') AS listing_url),
    {aliased("search_make", rules.MAKE_ALIASES)} AS search_make_std,
    {aliased("search_model", rules.MODEL_ALIASES)} AS search_model_std,
    {part_std("search_part")} AS search_part_std,
    {part_std("part_guess")} AS part_guess_std,
    {arms(part_std("search_part"), rules.PART_CATEGORIES)} AS search_part_category,
    {arms(part_std("part_guess"), rules.PART_CATEGORIES)} AS part_guess_category,
    CASE WHEN {any_of("_token", rules.ECM_TERMS)} AND {any_of("_token", rules.TCM_TERMS)}
         THEN 'Engine Control Module' {_class} END AS part_category_from_text
FROM (
    SELECT *, {token("trim(COALESCE(title, '') || ' | ' || COALESCE(subtitle, '') || ' | ' || COALESCE(raw_text, ''), ' |')")} AS _token
    FROM cleansed WHERE pass_type = 'sold'
) AS s
"""

_key = """NULLIF(listing_url, ''),
    CASE WHEN NULLIF(listing_url, '') IS NULL THEN title END,
    CASE WHEN NULLIF(listing_url, '') IS NULL THEN search_make_std END,
    CASE WHEN NULLIF(listing_url, '') IS NULL THEN search_model_std END,
    CASE WHEN NULLIF(listing_url, '') IS NULL THEN search_part_std END"""
STEPS["normalized"] = f"""
SELECT * EXCLUDE (grid_position, position_in_page, _rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {_key}
        ORDER BY grid_position, search_page, position_in_page, run_id, scrape_ts, pass_type,
            search_year, search_make NULLS LAST, search_model, search_part, search_url,
            title NULLS LAST, price_raw NULLS LAST, subtitle NULLS LAST, raw_text NULLS LAST) AS _rn
    FROM standardized
) AS d WHERE _rn = 1
"""

_cell = "search_year, search_make, search_model, search_part_std"
STEPS["sold_cells"] = f"""
SELECT b.search_year AS year, b.search_make AS make, b.search_model AS model, b.search_part_std AS part,
       b.sold_count, t.median AS median_sold_price, t.mean AS mean_sold_price,
       b.lowest AS min_sold_price, b.highest AS max_sold_price, b.seen AS sold_timestamp
FROM (
    SELECT {_cell}, COUNT(price_clean) AS sold_count, MIN(price_clean) AS lowest, MAX(price_clean) AS highest,
           MAX(CAST(scrape_ts AS TIMESTAMP)) FILTER (price_clean IS NOT NULL) AS seen
    FROM normalized GROUP BY {_cell}
) AS b
LEFT JOIN (
    SELECT {_cell}, AVG(v) FILTER (rn IN ((n + 1) // 2, (n + 2) // 2)) AS median, AVG(v) AS mean
    FROM (
        SELECT {_cell}, price_clean AS v,
               row_number() OVER (PARTITION BY {_cell} ORDER BY price_clean) AS rn,
               COUNT(*) OVER (PARTITION BY {_cell}) AS n
        FROM (
            SELECT *, COUNT(*) OVER (PARTITION BY {_cell}) AS priced,
                   quantile_cont(price_clean, 0.05) OVER (PARTITION BY {_cell}) AS p05,
                   quantile_cont(price_clean, 0.95) OVER (PARTITION BY {_cell}) AS p95
            FROM normalized WHERE price_clean IS NOT NULL
        ) AS bounded
        WHERE priced < 20 OR (price_clean >= p05 AND price_clean <= p95)
    ) AS numbered GROUP BY {_cell}
) AS t
ON b.search_year IS NOT DISTINCT FROM t.search_year AND b.search_make IS NOT DISTINCT FROM t.search_make
   AND b.search_model IS NOT DISTINCT FROM t.search_model AND b.search_part_std IS NOT DISTINCT FROM t.search_part_std
"""

STEPS["converted"] = """
SELECT * REPLACE (price_clean * CAST(search_year AS DOUBLE) / 2187e0 AS price_clean) FROM normalized"""
STEPS["converted_cells"] = STEPS["sold_cells"].replace("FROM normalized", "FROM converted")


def summary(market_part: str) -> str:
    scored = f"""
    SELECT *, {half_even("COALESCE(median_sold_price, 0) * str * confidence_score", 4)} AS opportunity_score
    FROM (
        SELECT *, sold_count + active_count AS total_count,
            {half_even("COALESCE(sold_count / NULLIF(sold_count + active_count, 0), 0)", 4)} AS str,
            {half_even("least(1e0, sold_count / 10e0) * 7e-1 + least(1e0, active_count / 10e0) * 3e-1", 4)} AS confidence_score,
            abs(epoch_us(sold_timestamp) - epoch_us(active_timestamp)) / 3.6e9 AS time_diff_hours
        FROM (
            SELECT s.*, COALESCE(m.result_count, 0) AS active_count, CAST(m.scrape_ts AS TIMESTAMP) AS active_timestamp
            FROM sold_cells AS s LEFT JOIN market AS m
            ON s.year IS NOT DISTINCT FROM m.search_year AND s.make IS NOT DISTINCT FROM m.search_make
               AND s.model IS NOT DISTINCT FROM m.search_model AND s.part IS NOT DISTINCT FROM {market_part}
        ) AS j
    ) AS sc"""
    return scored


STEPS["scored"] = summary("m.search_part")
STEPS["scored_matched"] = summary(part_std("m.search_part"))

STEPS["ranked"] = """
SELECT year, make, model, vehicle_key, part, median_sold_price, str, sold_count, active_count,
       confidence_score, opportunity_score,
       row_number() OVER (PARTITION BY vehicle_key ORDER BY opportunity_score DESC NULLS LAST,
           active_count DESC NULLS LAST, median_sold_price DESC NULLS LAST, part NULLS LAST) AS vehicle_rank
FROM (SELECT *, CAST(year AS STRING) || ' ' || COALESCE(trim(make), 'nan') || ' ' || COALESCE(trim(model), 'nan') AS vehicle_key
      FROM scored) AS k
"""

_profiles = ", ".join(
    "(" + ", ".join(text(c) if isinstance(c, str) else repr(c) for c in row) + ")"
    for row in rules.PULL_PROFILES
)
STEPS["profiles"] = f"""
SELECT * FROM (VALUES {_profiles}) AS p({", ".join(n for n, _ in rules.PROFILE_FIELDS)})
"""


def valued(fee: str, rate: str, pull_net: str, pull_str: str, maybe_net: str) -> str:
    net = (
        f"m - m * {fee} - COALESCE(p.estimated_shipping_cost, 0)::DOUBLE - "
        f"COALESCE(p.estimated_yard_cost, 0)::DOUBLE - COALESCE(p.estimated_pull_minutes, 0) / 60e0 * {rate}"
    )
    return f"""
    SELECT * EXCLUDE (m),
        CASE WHEN estimated_net_value IS NULL THEN 'Skip'
             WHEN estimated_net_value >= {pull_net} AND COALESCE(str, 0) >= {pull_str} THEN 'Pull'
             WHEN estimated_net_value >= {maybe_net} THEN 'Maybe' ELSE 'Skip' END AS recommendation
    FROM (
        SELECT r.*, CASE WHEN m IS NOT NULL THEN {exact(net, 2)} END AS estimated_net_value,
               p.estimated_pull_minutes, p.difficulty_score, p.shipping_class
        FROM (SELECT *, NULLIF(median_sold_price, 0) AS m FROM ranked) AS r
        LEFT JOIN profiles AS p ON p.part_name = lower(trim(r.part))
    ) AS v"""


STEPS["valued"] = valued("13e-2", "25e0", "75", "5e-1", "25")

STEPS["trend_rows"] = f"""
SELECT CAST(search_year AS STRING) || '|' || lower(trim(search_make)) || '|' || lower(trim(search_model)) AS vehicle_key,
       {part_std("search_part")} AS search_part,
       scraped_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AS recent,
       {first_price("price_raw")} AS price
FROM sold_history WHERE scraped_at >= TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY
"""
STEPS["trend_medians"] = median_of(
    "trend_rows WHERE price > 0", ["vehicle_key", "search_part", "recent"], "price"
)
STEPS["trends"] = f"""
SELECT vehicle_key, search_part,
    CASE WHEN pct > 5 THEN 'up' WHEN pct < -5 THEN 'down' WHEN pct IS NOT NULL THEN 'neutral' ELSE 'new' END AS direction,
    CASE WHEN pct IS NOT NULL THEN {exact("pct", 1)} END AS pct_change,
    CASE WHEN cur IS NOT NULL THEN {exact("cur", 2)} END AS current_avg,
    CASE WHEN pct IS NOT NULL THEN {exact("pri", 2)} END AS prior_avg
FROM (
    SELECT *, CASE WHEN cur IS NOT NULL AND pri > 0 THEN (cur - pri) / pri * 100e0 END AS pct
    FROM (
        SELECT k.vehicle_key, k.search_part,
            MAX(m.median) FILTER (m.recent AND m.n >= 3) AS cur,
            MAX(m.median) FILTER (NOT m.recent AND m.n >= 3) AS pri
        FROM (SELECT DISTINCT vehicle_key, search_part FROM trend_rows) AS k
        LEFT JOIN trend_medians AS m USING (vehicle_key, search_part)
        GROUP BY k.vehicle_key, k.search_part
    ) AS w
) AS x
"""
STEPS["trend_rows_exact"] = f"""
SELECT vehicle_key, search_part, scraped_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AS recent,
       {first_price("price_raw")} AS price
FROM sold_history WHERE scraped_at >= TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY
"""
STEPS["trend_medians_exact"] = median_of(
    "trend_rows_exact WHERE price > 0", ["vehicle_key", "search_part", "recent"], "price"
)
STEPS["trends_exact"] = STEPS["trends"].replace("trend_rows", "trend_rows_exact").replace(
    "trend_medians", "trend_medians_exact"
)
STEPS["trends_noon"] = STEPS["trends"].replace("trend_rows", "trend_rows_noon").replace(
    "trend_medians", "trend_medians_noon"
)
STEPS["trend_rows_noon"] = STEPS["trend_rows"].replace(AS_OF, "2024-02-14 12:00:00")
STEPS["trend_medians_noon"] = STEPS["trend_medians"].replace("trend_rows", "trend_rows_noon")
STEPS["enriched"] = """
SELECT v.*, COALESCE(t.direction, 'new') AS trend_direction, t.pct_change AS trend_pct
FROM valued AS v LEFT JOIN trends AS t
ON t.search_part = v.part
   AND t.vehicle_key = CAST(v.year AS STRING) || '|' || lower(trim(COALESCE(v.make, ''))) || '|' || lower(trim(COALESCE(v.model, '')))
WHERE v.vehicle_rank <= 10
"""

STEPS["good_cards"] = """
SELECT page_id, card_id % 60 + card_id % 60 // 12 AS position_in_page,
       CASE shape WHEN 6 THEN 'New ' || title WHEN 8 THEN replace(title, '&', chr(10003) || ' & ' || chr(8211))
            ELSE title END AS title,
       price_raw, CASE WHEN shape IN (6, 8) THEN '' ELSE listing_url END AS listing_url,
       CASE WHEN shape IN (5, 6, 8) THEN NULL ELSE '2024-01-' || lpad(sold_day, 2, '0') END AS sold_date
FROM cards WHERE shape NOT IN (1, 2, 3, 7)
UNION ALL
SELECT page_id, card_id % 60 + card_id % 60 // 12 + 1, 'Inner ' || title, '$1.50', '', NULL
FROM cards WHERE shape = 11
"""
STEPS["page_listing_rows"] = """
SELECT p.*, c.* EXCLUDE (page_id) FROM good_cards AS c JOIN landed_pages AS p USING (page_id)
"""

STEPS["pair_rows"] = """
SELECT CAST(year AS STRING) || '|' || COALESCE(make || '|', '') || model AS vehicle_key, a, b, a - b AS diff
FROM (
    SELECT year, make, model, MAX(str) FILTER (part = 'alternator') AS a, MAX(str) FILTER (part = 'headlight') AS b
    FROM scored GROUP BY year, make, model
) AS w WHERE a IS NOT NULL AND b IS NOT NULL
"""


STEPS["pair_summary"] = f"""
SELECT COUNT(*) AS n_pairs, {half_even("AVG(a)", 9)} AS mean_a, {half_even("AVG(b)", 9)} AS mean_b,
       {half_even("AVG(diff)", 9)} AS mean_diff, {half_even("quantile_cont(diff, 0.5)", 9)} AS median_diff,
       {half_even("AVG(CASE WHEN diff > 0 THEN 1e0 ELSE 0e0 END)", 9)} AS positive_rate
FROM pair_rows
"""
STEPS["rank_test"] = f"""
WITH sizes AS (
    SELECT diff, COUNT(*) OVER (PARTITION BY abs(diff)) AS t,
           rank() OVER (ORDER BY abs(diff)) AS r
    FROM pair_rows WHERE diff <> 0
), sums AS (
    SELECT COUNT(*) AS n_used, SUM(CASE WHEN diff > 0 THEN r + (t - 1) / 2e0 ELSE 0e0 END) AS statistic,
           SUM((t * t * t - t) / t::DOUBLE) AS ties FROM sizes
), scores AS (
    SELECT *, (statistic - n_used * (n_used + 1) / 4e0)
        / sqrt(n_used * (n_used + 1) * (2 * n_used + 1) / 24e0 - ties / 48e0) AS z FROM sums
)
SELECT n_used, statistic, {half_even("z", 9)} AS z,
    {half_even('''0.5 - sign(z) * exp(-z * z / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 80),
        lambda k: abs(z) ** (2 * k + 1) / list_aggregate(list_transform(range(0, k + 1), lambda j: 2e0 * j + 1), 'product')))''', 9)} AS p_value
FROM scores
"""
STEPS["pair_grains"] = """
SELECT vehicle_key, diff, CAST(round(diff / 1e-12) AS BIGINT) AS grains FROM pair_rows
"""
STEPS["permuted"] = """
WITH sizes AS (
    SELECT abs(grains) AS size, COUNT(*) AS n FROM pair_grains WHERE grains <> 0 GROUP BY abs(grains)
), words AS (
    SELECT size, word, least(n - word * 60, 60) AS bits
    FROM (SELECT size, n, unnest(range(0, (n - 1) // 60 + 1)) AS word FROM sizes) AS w
), flips AS (
    SELECT draw, size * (2 * bit_count((('0x' || substr(md5('42|' || CAST(size AS STRING) || '|' || CAST(draw AS STRING)
           || '|' || CAST(word AS STRING)), 1, 15))::BIGINT) >> (60 - bits)) - bits) AS signed
    FROM words, (SELECT unnest(range(0, 100000)) AS draw) AS d
), totals AS (SELECT draw, SUM(signed) AS total FROM flips GROUP BY draw)
SELECT (SELECT AVG(diff) FROM pair_rows) AS statistic,
       AVG(CASE WHEN total >= (SELECT SUM(grains) FROM pair_grains) THEN 1e0 ELSE 0e0 END) AS p_value,
       COUNT(*) AS draws FROM totals
"""
POISSON_STEPS = [
    0.36787944117, 0.73575888234, 0.91969860293, 0.98101184312, 0.99634015317,
    0.99940581518, 0.99991675885, 0.99998975080, 0.99999887480, 0.99999988857,
]
_weight = " + ".join(f"CAST(word >= {int(p * 2**32)} AS BIGINT)" for p in POISSON_STEPS)
STEPS["bootstrapped"] = f"""
WITH slots AS (
    SELECT h.block * 4 + p.place AS draw, grains, ('0x' || substr(h.hex, p.place * 8 + 1, 8))::BIGINT AS word
    FROM (SELECT grains, block, md5('42|' || vehicle_key || '|' || CAST(block AS STRING)) AS hex
          FROM pair_grains, (SELECT unnest(range(0, 2500)) AS block) AS bl) AS h,
         (SELECT unnest(range(0, 4))::INT AS place) AS p
), means AS (
    SELECT draw, CAST(SUM(w * grains) AS DOUBLE) / NULLIF(CAST(SUM(w) AS DOUBLE), 0) AS mean
    FROM (SELECT draw, grains, {_weight} AS w FROM slots) AS weighted GROUP BY draw
)
SELECT quantile_cont(mean, 0.025) * 1e-12 AS ci_low, quantile_cont(mean, 0.975) * 1e-12 AS ci_high,
       COUNT(*) AS draws FROM means
"""


def compose(body: str, only: str = "") -> str:
    """The body with the steps it reads; ``only`` narrows the listings."""
    names = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_]+)")
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in names.findall(sql):
            if name in STEPS and name not in needed:
                visit(STEPS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return with_views(body)
    bodies = {n: STEPS[n].strip().replace("pass_type = 'sold'", "pass_type = 'sold'" + only) for n in needed}
    steps = ",\n".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in bodies.items())
    body = body.strip()
    body = ", " + body[4:].lstrip() if body.upper().startswith("WITH") else body
    return with_views(f"WITH {steps}\n{body}")


def grid_sql(vehicles: str, first: int, last: int, scope: str, order: str) -> str:
    query = "CAST(y.year AS STRING) || ' ' || v.make || ' ' || v.model || ' ' || p.part"
    flags = (rules.SOLD_URL_FLAGS if scope == "sold" else "") + rules.USED_URL_FLAG
    key = "CAST(y.year AS STRING) || '|' || v.make || '|' || v.model"
    return f"""
    SELECT y.year AS search_year, v.make AS search_make, v.model AS search_model, p.part AS search_part,
        {key} || '|' || p.part AS search_key,
        {key} || '|' || p.part || '|{scope}' AS execution_key,
        '{rules.SEARCH_URL_BASE}?_nkw=' || replace(url_encode({query}), '%20', '+') || '{flags}' AS search_url,
        CAST(y.year AS STRING) || '|' || lower(trim(v.make)) || '|' || lower(trim(v.model)) AS lookup_key,
        {key} AS history_key,
        CAST(y.year AS STRING) || ' ' || v.make || ' ' || v.model AS rank_key,
        ({order} * {last - first + 1} + y.year - {first}) * 31 + p.place - 1 AS grid_position
    FROM {vehicles} AS v,
        (SELECT unnest(range({first}, {last + 1})) AS year) AS y,
        (SELECT unnest([{", ".join(map(text, rules.SEARCH_PARTS))}]) AS part, unnest(range(1, 32)) AS place) AS p
    """


_GRID = grid_sql("grid_vehicles", 2012, 2013, "sold", "v.position")

_ITEM = """part AS part_name, sold_count, active_count, {share} AS sell_through_rate,
    {median} AS median_price, opportunity_score, estimated_net_value, recommendation, confidence_score,
    vehicle_rank, estimated_pull_minutes, difficulty_score, shipping_class, trend_direction, trend_pct"""
_EXPORT = f"""year, make, model, part, sold_count, active_count, total_count,
    median_sold_price AS median_price, {half_even("mean_sold_price", 4)} AS avg_price,
    min_sold_price AS min_price, max_sold_price AS max_price, str, confidence_score, opportunity_score,
    CAST(sold_timestamp AS STRING) AS sold_timestamp, CAST(active_timestamp AS STRING) AS active_timestamp,
    time_diff_hours, COALESCE(time_diff_hours > 48, false) AS stale_snapshot_flag,
    sold_count < 5 AS low_sample_flag, sold_count < 3 AS very_low_sold_flag"""

_raw = """run_id, '{ts}' AS scrape_ts, 'sold' AS pass_type, search_year, search_make, search_model, search_part,
    {url} AS search_url, 1 AS search_page, title, price_raw, CAST(NULL AS STRING) AS subtitle,
    COALESCE(listing_url, '') AS listing_url, title AS raw_text"""

_fuel = """CASE trim(fuel) WHEN 'Gasoline' THEN 'Gas' WHEN 'Compressed Natural Gas (CNG)' THEN 'CNG'
    WHEN 'Flexible Fuel (E85)' THEN 'Flex Fuel' ELSE trim(fuel) END"""

_best_set = """
    SELECT vehicle_key, id, scraped_at, cache_expires_at, fresh FROM (
        SELECT *, row_number() OVER (PARTITION BY vehicle_key
                   ORDER BY fresh DESC, scraped_at DESC NULLS FIRST, id DESC) AS rn
        FROM (SELECT *, cache_expires_at > TIMESTAMP '{as_of}' AS fresh FROM result_sets
              WHERE status = 'completed' AND window_days = 90) AS c
    ) AS o WHERE rn = 1
"""

_NEWEST_CRAWLS = f"""
        SELECT '2015|Ford|' || CAST(p_partkey % 5 AS STRING) AS vehicle_key, '{AS_OF}' AS last_crawled_at,
               COUNT(DISTINCT p_partkey % 4) AS parts_scraped, COUNT(*) AS total_listings, '{AS_OF}' AS updated_at
        FROM part WHERE p_partkey % 7 = 0 GROUP BY p_partkey % 5"""

ORACLES: dict[str, str] = {
    "search_grid": _GRID,
    "pending_searches": f"""
        SELECT execution_key FROM ({_GRID}) AS g
        WHERE execution_key NOT IN (SELECT execution_key FROM completed_searches)""",
    "page_cards": """
        SELECT * REPLACE (CAST(scraped_at AS STRING) AS scraped_at) FROM page_listing_rows""",
    "foreign_pages": """
        SELECT page_id, 'Page ' || CAST(page_id AS STRING) AS title,
               '$' || CAST(page_id + 1 AS STRING) AS price_raw, '' AS listing_url FROM pages""",
    "recent_listings": f"""
        SELECT * REPLACE (CAST(scraped_at AS STRING) AS scraped_at, CAST(sold_date AS STRING) AS sold_date)
        FROM sold_history WHERE scraped_at >= TIMESTAMP '{HISTORY_AS_OF}' - INTERVAL 14 DAY""",
    "listing_history": """
        SELECT vehicle_key, search_part, price_raw, CAST(scraped_at AS STRING) AS scraped_at,
               CAST(sold_date AS STRING) AS sold_date
        FROM sold_history WHERE scraped_at >= TIMESTAMP '2024-03-10' - INTERVAL 60 DAY""",
    "history_first": f"""
        WITH recent_rows AS (
            SELECT * FROM sold_history WHERE scraped_at >= TIMESTAMP '{HISTORY_AS_OF}' - INTERVAL 14 DAY
        )
        SELECT 'run-h' AS {_raw.format(ts="2024-02-05T00:00:00", url="'(db_cache)'")} FROM recent_rows
        UNION ALL
        SELECT 'run-h' AS {_raw.format(ts="2024-02-05T00:00:00", url="''")} FROM page_listing_rows AS p
        WHERE NOT EXISTS (SELECT 1 FROM recent_rows AS r
                          WHERE r.vehicle_key = p.vehicle_key AND r.search_part = p.search_part)""",
    "active_snapshot": f"""
        SELECT 'run-a' AS run_id, '2024-02-14T00:00:00' AS scrape_ts, 'all' AS pass_type, g.search_key,
               g.execution_key, 'all' AS search_scope, g.search_year, g.search_make, g.search_model,
               g.search_part, '{rules.COUNT_API_URL}' AS search_url,
               COALESCE(m.result_count, 0) AS result_count, 1 AS page_count_observed
        FROM ({grid_sql("searched_models", 2012, 2015, "all", "0")}) AS g
        LEFT JOIN market AS m ON m.search_year = g.search_year AND m.search_make = g.search_make
            AND m.search_model = g.search_model AND m.search_part = g.search_part""",
    "page_stream": f"""
        SELECT '2015|Ford|' || p_brand AS vehicle_key, 2015 AS search_year, 'Ford' AS search_make,
               p_brand AS search_model, p_type AS search_part, p_name AS title,
               '$' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) AS price_raw,
               '/itm/' || CAST(p_partkey % 1500 AS STRING) || '?hash=' || CAST(p_partkey AS STRING) AS listing_url,
               CAST(NULL AS STRING) AS sold_date, '{AS_OF}' AS scraped_at
        FROM part""",
    "page_stream_status": f"""
        SELECT '2015|Ford|' || p_brand AS vehicle_key, '{AS_OF}' AS last_crawled_at,
               COUNT(DISTINCT p_type) AS parts_scraped, COUNT(*) AS total_listings, '{AS_OF}' AS updated_at
        FROM part GROUP BY p_brand""",
    "page_stream_unique": """
        SELECT DISTINCT '2015|Ford|' || CAST(p_partkey % 5 AS STRING) AS vehicle_key,
               'part ' || CAST(p_partkey % 4 AS STRING) AS search_part,
               '/itm/' || CAST(p_partkey % 400 AS STRING) AS address
        FROM part""",
    "page_stream_crawls": _NEWEST_CRAWLS,
    "page_stream_totals": _NEWEST_CRAWLS,
    "stored_history": f"""
        SELECT * EXCLUDE (event_id) REPLACE (CAST(scraped_at AS STRING) AS scraped_at, CAST(sold_date AS STRING) AS sold_date)
        FROM sold_history WHERE scraped_at >= TIMESTAMP '{HISTORY_AS_OF}' - INTERVAL 14 DAY""",
    "stored_trend": "SELECT * FROM trends",
    "price_trend_days": "SELECT * FROM trends",
    "price_trend_midday": "SELECT * FROM trends_noon",
    "repeated_run": """
        SELECT * EXCLUDE (event_id, rn)
               REPLACE (CAST(scraped_at AS STRING) AS scraped_at, CAST(sold_date AS STRING) AS sold_date)
        FROM (
            SELECT * REPLACE ('/itm/' || CAST(event_id % 5000 AS STRING) || '?v=' || CAST(event_id AS STRING) AS listing_url),
                   row_number() OVER (PARTITION BY vehicle_key, search_part, event_id % 5000 ORDER BY scraped_at, event_id) AS rn
            FROM sold_history
        ) AS repeated WHERE rn = 1""",
    "vehicle_listings": f"""
        SELECT * EXCLUDE (event_id)
               REPLACE (CAST(scraped_at AS STRING) AS scraped_at, CAST(sold_date AS STRING) AS sold_date)
        FROM sold_history WHERE scraped_at >= TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY
             AND vehicle_key = '2012|Ford|F-150' AND search_part = 'alternator'""",
    "stored_ranking": "SELECT * FROM ranked",
    "cleanse_listings": "SELECT * FROM cleansed",
    "junk_titles": f"""
        SELECT position_in_page, search_page, title FROM listings
        WHERE title IS NULL OR title = '' OR {any_of("lower(title)", rules.JUNK_TITLE_MARKERS)}""",
    "heavy_duty_filter": f"""
        SELECT position_in_page, search_make, title FROM listings
        WHERE NOT COALESCE({" OR ".join(
            f"({aliased('search_make', rules.MAKE_ALIASES)} = {text(make)} AND {any_of('lower(title)', words)})"
            for make, words in rules.HEAVY_DUTY_TERMS.items())}, false)""",
    "normalize_listings": "SELECT * FROM normalized",
    "dedup_stats": """
        SELECT a.n AS before_count, b.n AS after_count, a.n - b.n AS removed_count,
               (a.n - b.n) / a.n AS removed_rate
        FROM (SELECT COUNT(*) AS n FROM standardized) AS a, (SELECT COUNT(*) AS n FROM normalized) AS b""",
    "sold_summary": f"""
        SELECT * REPLACE ({half_even("mean_sold_price", 4)} AS mean_sold_price,
                          CAST(sold_timestamp AS STRING) AS sold_timestamp) FROM sold_cells""",
    "converted_summary": f"""
        SELECT * REPLACE ({half_even("mean_sold_price", 4)} AS mean_sold_price,
                          CAST(sold_timestamp AS STRING) AS sold_timestamp) FROM converted_cells""",
    "analysis_summary": f"SELECT {_EXPORT} FROM scored",
    "analysis_summary_matched": f"SELECT {_EXPORT} FROM scored_matched",
    "ranked_parts": "SELECT * FROM ranked",
    "top_parts": "SELECT * FROM ranked WHERE vehicle_rank <= 3",
    "vehicle_analysis": """
        SELECT * FROM ranked WHERE vehicle_rank <= 10""",
    "net_value": "SELECT * FROM valued",
    "net_value_cautious": valued("1e-1", "40e0", "100", "6e-1", "50"),
    "net_value_bold": valued("13e-2", "25e0", "50", "35e-2", "15"),
    "price_trend": "SELECT * FROM trends",
    "price_trend_exact": "SELECT * FROM trends_exact",
    "enriched_parts": "SELECT * FROM enriched",
    "result_items": f"""
        SELECT {_set_id("CAST(year AS STRING) || '|' || lower(trim(COALESCE(make, ''))) || '|' || lower(trim(COALESCE(model, '')))")} AS result_set_id,
               {_ITEM.format(share="NULLIF(str, 0)", median="NULLIF(median_sold_price, 0)")} FROM enriched""",
    "result_set_lookup": f"""
        SELECT {_set_id("'2013|ford|f-150'")} AS result_set_id,
               {_ITEM.format(share="str", median="median_sold_price")} FROM enriched
        WHERE vehicle_key = '2013 Ford F-150' ORDER BY vehicle_rank""",
    "result_headers": f"""
        SELECT DISTINCT {_set_id("vehicle_key")} AS id, vehicle_key,
               90 AS window_days, 'ebay' AS source, 'completed' AS status, '{AS_OF}' AS scraped_at,
               '{AS_OF}' AS created_at,
               CAST(TIMESTAMP '{AS_OF}' + INTERVAL 14 DAY AS STRING) AS cache_expires_at, '1.0' AS part_profile_version
        FROM vehicles""",
    "result_headers_pending": f"""
        SELECT id, vehicle_key, 90 AS window_days, 'ebay' AS source,
               CASE WHEN id % 2 = 0 THEN 'completed' ELSE 'pending' END AS status,
               CASE WHEN id % 2 = 0 THEN '2024-02-15 06:00:00' END AS scraped_at, '{AS_OF}' AS created_at,
               CASE WHEN id % 2 = 0 THEN '2024-02-29 06:00:00' END AS cache_expires_at, '1.0' AS part_profile_version
        FROM (SELECT DISTINCT {_set_id("vehicle_key")} AS id, vehicle_key FROM vehicles) AS v""",
    "seed_missing": f"""
        SELECT CAST(y.year AS STRING) || '|' || s.make || '|' || s.model AS vehicle_key, y.year, s.make, s.model
        FROM (VALUES {", ".join(f"({text(a)}, {text(b)})" for a, b in rules.SEED_VEHICLES)}) AS s(make, model),
             (SELECT unnest(range(2000, 2025)) AS year) AS y
        WHERE CAST(y.year AS STRING) || '|' || s.make || '|' || s.model
              NOT IN (SELECT vehicle_key FROM seeded_vehicles)""",
    "seed_profiles": """
        SELECT * FROM profiles WHERE part_name NOT IN (SELECT part_name FROM stored_profiles)""",
    "vehicle_upsert": """
        SELECT COALESCE(v.vehicle_key, d.vehicle_key) AS vehicle_key,
               COALESCE(v.year, d.year) AS year, COALESCE(v.make, d.make) AS make,
               COALESCE(v.model, d.model) AS model, COALESCE(d.trim, v.trim) AS trim,
               COALESCE(d.series, v.series) AS series, COALESCE(d.engine, v.engine) AS engine,
               COALESCE(d.body_class, v.body_class) AS body_class,
               COALESCE(d.drive_type, v.drive_type) AS drive_type,
               COALESCE(d.fuel_type, v.fuel_type) AS fuel_type,
               CAST(COALESCE(v.created_at, d.created_at) AS STRING) AS created_at
        FROM vehicles AS v FULL JOIN (
            SELECT vehicle_key, arg_min(year, seq) AS year, arg_min(make, seq) AS make,
                   arg_min(model, seq) AS model, arg_min(created_at, seq) AS created_at,
                   arg_max(trim, seq) FILTER (trim IS NOT NULL) AS trim,
                   arg_max(series, seq) FILTER (series IS NOT NULL) AS series,
                   arg_max(engine, seq) FILTER (engine IS NOT NULL) AS engine,
                   arg_max(body_class, seq) FILTER (body_class IS NOT NULL) AS body_class,
                   arg_max(drive_type, seq) FILTER (drive_type IS NOT NULL) AS drive_type,
                   arg_max(fuel_type, seq) FILTER (fuel_type IS NOT NULL) AS fuel_type
            FROM vehicle_delta GROUP BY vehicle_key
        ) AS d ON v.vehicle_key = d.vehicle_key""",
    "crawl_upsert": """
        SELECT vehicle_key, CAST(last_crawled_at AS STRING) AS last_crawled_at, parts_scraped,
               total_listings, CAST(updated_at AS STRING) AS updated_at
        FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_key ORDER BY fresh DESC, updated_at DESC,
                     last_crawled_at DESC, parts_scraped DESC, total_listings DESC) AS rn
              FROM (SELECT *, 0 AS fresh FROM crawl_status UNION ALL SELECT *, 1 AS fresh FROM crawl_delta) AS u
        ) AS o WHERE rn = 1""",
    "crawl_totals": """
        SELECT a.vehicle_key, '2024-02-01 12:00:00' AS last_crawled_at, a.parts_scraped,
               COALESCE(l.total_listings, 0) AS total_listings, '2024-02-01 12:00:00' AS updated_at
        FROM (SELECT vehicle_key, COUNT(DISTINCT search_part) AS parts_scraped FROM landed_pages GROUP BY vehicle_key) AS a
        LEFT JOIN (SELECT vehicle_key, COUNT(*) AS total_listings FROM page_listing_rows GROUP BY vehicle_key) AS l
        USING (vehicle_key)""",
    "crawl_queue": f"""
        SELECT v.vehicle_key, v.year, v.make, v.model, CAST(s.last_crawled_at AS STRING) AS last_crawled_at
        FROM vehicles AS v LEFT JOIN crawl_status AS s ON s.vehicle_key = v.vehicle_key
        WHERE s.last_crawled_at IS NULL OR s.last_crawled_at < TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 14 DAY
        ORDER BY s.last_crawled_at NULLS FIRST, v.vehicle_key LIMIT 50""",
    "recent_searches": """
        SELECT v.year, v.make, v.model, v.trim, v.vehicle_key, r.id AS result_set_id,
               CAST(r.scraped_at AS STRING) AS scraped_at, CAST(r.cache_expires_at AS STRING) AS cache_expires_at
        FROM vehicles AS v JOIN (
            SELECT *, row_number() OVER (PARTITION BY vehicle_key ORDER BY scraped_at DESC NULLS FIRST, id DESC) AS rn
            FROM result_sets WHERE status = 'completed'
        ) AS r ON r.vehicle_key = v.vehicle_key AND r.rn = 1
        ORDER BY r.scraped_at DESC NULLS FIRST, r.id DESC LIMIT 15""",
    "cache_status": f"""
        SELECT v.vehicle_key,
               CASE WHEN b.fresh THEN 'fresh' WHEN b.scraped_at IS NULL THEN 'missing'
                    WHEN floor((epoch_us(TIMESTAMP '{ORDERS_AS_OF}') - epoch_us(b.scraped_at)) / 86400000000) <= 30
                    THEN 'usable_stale' ELSE 'expired' END AS cache_status,
               b.id AS result_set_id, CAST(b.scraped_at AS STRING) AS scraped_at,
               CAST(b.cache_expires_at AS STRING) AS cache_expires_at
        FROM vehicles AS v LEFT JOIN ({_best_set.format(as_of=ORDERS_AS_OF)}) AS b USING (vehicle_key)""",
    "latest_crawls": """
        SELECT vehicle_key, CAST(last_crawled_at AS STRING) AS last_crawled_at, parts_scraped, total_listings
        FROM crawl_status ORDER BY crawl_status.last_crawled_at DESC NULLS LAST, vehicle_key LIMIT 10""",
    "latest_sold": """
        SELECT vehicle_key, search_part, price_raw, CAST(sold_date AS STRING) AS sold_date,
               CAST(scraped_at AS STRING) AS scraped_at
        FROM sold_history ORDER BY sold_history.scraped_at DESC NULLS LAST, event_id LIMIT 10""",
    "table_counts": """
        SELECT 'vehicles' AS table_name, COUNT(*) AS row_count FROM vehicles
        UNION ALL SELECT 'sold_listings', COUNT(*) FROM sold_history
        UNION ALL SELECT 'crawl_status', COUNT(*) FROM crawl_status
        UNION ALL SELECT 'result_sets', COUNT(*) FROM result_sets""",
    "catalog_store": f"""
        SELECT cache_type, make, model, year, CAST(to_json([first_name, second_name]) AS STRING) AS data,
               '{AS_OF}' AS cached_at, CAST(TIMESTAMP '{AS_OF}' + INTERVAL 30 DAY AS STRING) AS expires_at
        FROM (SELECT *, row_number() OVER (PARTITION BY cache_type, make, model, year ORDER BY seq DESC) AS rn
              FROM catalog_entries) AS o WHERE rn = 1""",
    "catalog_lookup": """
        SELECT cache_type, make, model, year, first_name || '|' || second_name AS names
        FROM (SELECT *, row_number() OVER (PARTITION BY cache_type, make, model, year ORDER BY seq DESC) AS rn
              FROM catalog_entries WHERE year = 2012 OR year IS NULL) AS o WHERE rn = 1""",
    "make_list": "SELECT DISTINCT make FROM catalog_rows WHERE make <> '' ORDER BY make",
    "model_lists": """
        SELECT a.make, a.year,
               COALESCE(array_to_string(o.names, '|'), array_to_string(g.names, '|'), '') AS models
        FROM (SELECT DISTINCT make, COALESCE(year, 2013) AS year FROM catalog_rows) AS a
        LEFT JOIN (SELECT make, year, list_sort(list_distinct(list(model))) AS names FROM catalog_rows
                   WHERE year IS NOT NULL AND model IS NOT NULL GROUP BY make, year) AS o
            ON o.make = a.make AND o.year = a.year
        LEFT JOIN (SELECT make, list_sort(list_distinct(list(model))) AS names FROM catalog_rows
                   WHERE year IS NULL AND model IS NOT NULL GROUP BY make) AS g ON g.make = a.make""",
    "trim_lists": """
        SELECT make, model, year, array_to_string(list_sort(list_distinct(list(catalog_rows.trim))), '|') AS trims
        FROM catalog_rows WHERE catalog_rows.trim IS NOT NULL AND catalog_rows.trim <> ' '
        GROUP BY make, model, year""",
    "model_pages": """
        WITH own AS (
            SELECT make, year, (row_number() OVER (PARTITION BY make, year ORDER BY model) - 1) // 2 AS page, model
            FROM (SELECT DISTINCT make, year, model FROM catalog_rows
                  WHERE year IS NOT NULL AND model IS NOT NULL AND model <> '') AS d),
        generic AS (
            SELECT make, (row_number() OVER (PARTITION BY make ORDER BY model) - 1) // 2 AS page, model
            FROM (SELECT DISTINCT make, model FROM catalog_rows
                  WHERE year IS NULL AND model IS NOT NULL AND model <> '') AS d),
        asked AS (SELECT DISTINCT make, COALESCE(year, 2013) AS year FROM catalog_rows)
        SELECT a.make, a.year, o.page, string_agg(o.model, '|' ORDER BY o.model) AS models
        FROM asked AS a JOIN own AS o ON o.make = a.make AND o.year = a.year GROUP BY a.make, a.year, o.page
        UNION ALL
        SELECT a.make, a.year, COALESCE(g.page, 0) AS page,
               COALESCE(string_agg(g.model, '|' ORDER BY g.model), '') AS models
        FROM asked AS a LEFT JOIN generic AS g ON g.make = a.make
        WHERE NOT EXISTS (SELECT 1 FROM own AS o WHERE o.make = a.make AND o.year = a.year)
        GROUP BY a.make, a.year, COALESCE(g.page, 0)""",
    "trim_pages": """
        SELECT make, model, year, page, string_agg(name, '|' ORDER BY name) AS trims
        FROM (SELECT make, model, year, name,
                     (row_number() OVER (PARTITION BY make, model, year ORDER BY name) - 1) // 2 AS page
              FROM (SELECT DISTINCT make, model, year, catalog_rows.trim AS name FROM catalog_rows
                    WHERE catalog_rows.trim IS NOT NULL AND catalog_rows.trim <> ' ') AS d) AS numbered
        GROUP BY make, model, year, page""",
    "vin_profile": f"""
        SELECT upper(trim(vin)) AS vin, CAST(model_year AS INT) AS year, trim(make) AS make, trim(model) AS model,
            NULLIF(trim_name, 'Not Applicable') AS trim, series,
            CASE p_body WHEN 0 THEN 'SUV' WHEN 1 THEN 'Pickup' WHEN 2 THEN 'Sedan' WHEN 3 THEN 'Wagon'
                        WHEN 4 THEN 'Truck-Tractor' WHEN 6 THEN 'Cargo Van' END AS body_class,
            CASE p_drive WHEN 0 THEN 'AWD' WHEN 1 THEN '4WD' WHEN 2 THEN 'FWD' WHEN 3 THEN 'RWD' WHEN 4 THEN '6x2' END AS drive_type,
            NULLIF(concat_ws(' ',
                CASE displacement WHEN '3.6' THEN '3.6L' WHEN '2.25' THEN '2.2L' WHEN '1.95' THEN '1.9L' ELSE displacement END,
                CASE WHEN cylinders IS NULL THEN NULL
                     WHEN engine_layout IS NULL OR engine_layout = 'W' THEN trim(cylinders) || '-cyl'
                     WHEN engine_layout = 'Rotary' THEN 'Rotary'
                     ELSE CASE engine_layout WHEN 'V-Shaped' THEN 'V' WHEN 'In-Line' THEN 'I' ELSE 'H' END || trim(cylinders) END
            ), '') AS engine,
            {_fuel} AS fuel_type
        FROM (SELECT *, CAST(substr(trim(vin), 4) AS BIGINT) % 7 AS p_body, CAST(substr(trim(vin), 4) AS BIGINT) % 6 AS p_drive
              FROM vin_wide WHERE length(trim(vin)) = 17 AND model_year <> '') AS w""",
    "part_pairs": f"SELECT vehicle_key, a, b, {half_even('diff', 9)} AS diff FROM pair_rows",
    "paired_summary": "SELECT * FROM pair_summary",
    "signed_rank": "SELECT n_used, statistic, z, p_value FROM rank_test",
    "permutation_test": f"""
        SELECT {half_even("statistic", 9)} AS statistic, p_value, draws FROM permuted""",
    "bootstrap_ci": f"""
        SELECT {half_even("ci_low", 9)} AS ci_low, {half_even("ci_high", 9)} AS ci_high, draws FROM bootstrapped""",
    "compare_parts": f"""
        SELECT 'alternator' AS part_a, 'headlight' AS part_b, 'str' AS metric, 0.05 AS alpha,
               'greater' AS alternative, s.*, 'paired_permutation' AS permutation_test_name,
               {half_even("p.statistic", 9)} AS permutation_statistic, p.p_value AS permutation_p_value,
               100000 AS permutation_count, 'wilcoxon_signed_rank' AS wilcoxon_test_name,
               w.statistic AS wilcoxon_statistic, w.p_value AS wilcoxon_p_value,
               'bootstrap_percentile_mean_diff' AS ci_method, 0.95 AS ci_confidence_level,
               {half_even("b.ci_low", 9)} AS ci_low, {half_even("b.ci_high", 9)} AS ci_high,
               10000 AS ci_bootstrap_iterations, p.p_value < 0.05 AS reject_null
        FROM pair_summary AS s CROSS JOIN permuted AS p CROSS JOIN bootstrapped AS b CROSS JOIN rank_test AS w""",
}

# The stored forms of the upserts give what the plain ones give.
ORACLES |= {"vehicle_merge": ORACLES["vehicle_upsert"], "crawl_merge": ORACLES["crawl_upsert"]}

# A vehicle lookup sees the listings of its own vehicle only.
NARROWED = {"vehicle_analysis": " AND search_year = 2013 AND search_model = 'Accord'"}


def all_oracles() -> dict[str, str]:
    return {name: compose(body, NARROWED.get(name, "")) for name, body in ORACLES.items()}
