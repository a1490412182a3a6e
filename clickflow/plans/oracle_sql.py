"""Independent DuckDB SQL for every SQL-expressible query of the catalog.

Each statement runs on the driver tables registered as views and restates
the adapter (``ev``, ``us``, ``pr``, ``op``) inline. The SQL is written in
the direct form of each metric (e.g. ``count(DISTINCT ...)``), not as a
transcription of the Spark plan, so it checks the plan rewrites too.
"""

from __future__ import annotations

# Adapter views (fixed values shared with clickflow.sources.tables).
ADAPTER = """
ev AS (
  SELECT e.event_id, e.ts AS event_time, e.user_id,
         CASE e.event_type WHEN 'click' THEN 'cart' ELSE e.event_type END AS event_type,
         TRY_CAST(regexp_extract(e.props, '[0-9]+', 0) AS BIGINT) AS product_id,
         p.p_type AS category_code, p.p_brand AS brand,
         CAST(e.value AS DECIMAL(18,2)) AS price
  FROM events e
  LEFT JOIN part p ON p.p_partkey = TRY_CAST(regexp_extract(e.props, '[0-9]+', 0) AS BIGINT)
),
us AS (
  SELECT c_custkey AS user_id, c_name AS name,
         make_date(CAST(1950 + c_custkey % 56 AS INT), CAST(1 + c_custkey % 12 AS INT),
                   CAST(1 + c_custkey % 28 AS INT)) AS birth_date,
         n_name AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
pr AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category_id,
         p_type AS category_name, p_type AS category_code, p_brand AS brand,
         p_retailprice AS price
  FROM part
),
op AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS event_id, o.o_orderdate AS event_time,
         o.o_custkey AS user_id, 'purchase' AS event_type, l.l_partkey AS product_id,
         p.p_type AS category_code, p.p_brand AS brand,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
)"""

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF_DATE = "DATE '2024-02-01'"


def with_adapter(*ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return "WITH " + ADAPTER.strip() + extra + "\n"


RUN_ID = "20240201_000000"
LOOKBACK_START = "TIMESTAMP '2024-01-30 00:00:00'"
LOOKBACK_END = "TIMESTAMP '2024-01-31 00:00:00'"


def secs(c: str) -> str:
    return f"CAST(floor(epoch({c})) AS BIGINT)"


def touch_sql(src: str = "ev") -> str:
    return f"""tp AS (
  SELECT user_id, product_id, category_code, brand,
         min(CASE WHEN event_type = 'view' THEN event_time END) AS view_time,
         min(CASE WHEN event_type = 'cart' THEN event_time END) AS cart_time,
         min(CASE WHEN event_type = 'purchase' THEN event_time END) AS purchase_time,
         CAST(count(DISTINCT CASE WHEN event_type = 'view' THEN 1 END) AS INT) AS has_view,
         CAST(count(DISTINCT CASE WHEN event_type = 'cart' THEN 1 END) AS INT) AS has_cart,
         CAST(count(DISTINCT CASE WHEN event_type = 'purchase' THEN 1 END) AS INT) AS has_purchase
  FROM {src} GROUP BY user_id, product_id, category_code, brand
),
tpd AS (
  SELECT *,
    CASE WHEN cart_time IS NOT NULL AND view_time IS NOT NULL
         THEN {secs('cart_time')} - {secs('view_time')} END AS view_to_cart_seconds,
    CASE WHEN purchase_time IS NOT NULL AND cart_time IS NOT NULL
         THEN {secs('purchase_time')} - {secs('cart_time')} END AS cart_to_purchase_seconds,
    CASE WHEN purchase_time IS NOT NULL AND view_time IS NOT NULL
         THEN {secs('purchase_time')} - {secs('view_time')} END AS view_to_purchase_seconds
  FROM tp
)"""


def funnel_sql(key: str, where: str = "", name: str = "fr") -> str:
    return f"""{name}_a AS (
  SELECT {key},
    count(DISTINCT CASE WHEN has_view > 0 THEN user_id END) AS users_viewed,
    count(DISTINCT CASE WHEN has_cart > 0 THEN user_id END) AS users_added_to_cart,
    count(DISTINCT CASE WHEN has_purchase > 0 THEN user_id END) AS users_purchased,
    avg(view_to_cart_seconds) AS avg_view_to_cart_seconds,
    avg(cart_to_purchase_seconds) AS avg_cart_to_purchase_seconds,
    avg(view_to_purchase_seconds) AS avg_view_to_purchase_seconds
  FROM tpd {where} GROUP BY {key}
),
{name} AS (
  SELECT *,
    CASE WHEN users_viewed > 0 THEN users_added_to_cart / users_viewed ELSE 0.0 END AS view_to_cart_rate,
    CASE WHEN users_added_to_cart > 0 THEN users_purchased / users_added_to_cart ELSE 0.0 END AS cart_to_purchase_rate,
    CASE WHEN users_viewed > 0 THEN users_purchased / users_viewed ELSE 0.0 END AS view_to_purchase_rate,
    CASE WHEN users_viewed > 0 THEN 1 - users_added_to_cart / users_viewed ELSE 0.0 END AS view_to_cart_dropoff,
    CASE WHEN users_added_to_cart > 0 THEN 1 - users_purchased / users_added_to_cart ELSE 0.0 END AS cart_to_purchase_dropoff
  FROM {name}_a
)"""


SQL: dict[str, str] = {}

# --- funnel -----------------------------------------------------------------
SQL["funnel_user_product"] = with_adapter(touch_sql()) + "SELECT * FROM tpd"
SQL["funnel_by_category"] = with_adapter(touch_sql(), funnel_sql("category_code")) + "SELECT * FROM fr"
SQL["funnel_by_brand"] = (with_adapter(touch_sql(), funnel_sql("brand", "WHERE brand IS NOT NULL"))
                          + "SELECT * FROM fr")
SQL["funnel_lookback"] = (with_adapter(
    f"evl AS (SELECT * FROM ev WHERE event_time BETWEEN {LOOKBACK_START} AND {LOOKBACK_END})",
    touch_sql("evl"), funnel_sql("brand", "WHERE brand IS NOT NULL")) + "SELECT * FROM fr")

_rates = ["view_to_cart_rate", "cart_to_purchase_rate", "view_to_purchase_rate",
          "view_to_cart_dropoff", "cart_to_purchase_dropoff"]
_durs = ["avg_view_to_cart_seconds", "avg_cart_to_purchase_seconds", "avg_view_to_purchase_seconds"]
SQL["funnel_union"] = with_adapter(
    touch_sql(), funnel_sql("category_code", "", "fc"),
    funnel_sql("brand", "WHERE brand IS NOT NULL", "fb"),
    """u AS (
  SELECT 'category' AS type, coalesce(nullif(category_code, ''), 'unknown') AS name, * EXCLUDE (category_code) FROM fc
  UNION ALL
  SELECT 'brand' AS type, brand AS name, * EXCLUDE (brand) FROM fb
)""") + f"""SELECT '{RUN_ID}_' || type || '_' || name AS row_key, type, name,
  users_viewed, users_added_to_cart, users_purchased,
  {", ".join(f"coalesce(round({c}, 4), 0.0) AS {c}" for c in _rates)},
  {", ".join(f"coalesce(CAST(trunc({c}) AS BIGINT), 0) AS {c}" for c in _durs)},
  TIMESTAMP '2024-02-01 00:00:00' AS created_at
FROM u"""

# --- recommendations --------------------------------------------------------


def band_a(age: str) -> str:
    return (f"CASE WHEN {age} < 25 THEN '18-24' WHEN {age} < 35 THEN '25-34' "
            f"WHEN {age} < 45 THEN '35-44' WHEN {age} < 55 THEN '45-54' ELSE '55+' END")


SEGMENTS = f"""sa AS (
  SELECT user_id, city,
         CAST(floor(date_diff('day', birth_date, {AS_OF_DATE}) / 365.25) AS INT) AS age
  FROM us
),
sg AS (SELECT user_id, city, age, {band_a('age')} AS age_group FROM sa)"""

JOINED = "j AS (SELECT ev.*, sg.age_group FROM ev JOIN sg ON ev.user_id = sg.user_id)"

SPS = """sps AS (
  SELECT *, views + 2 * add_to_cart + 5 * purchases AS recommendation_score FROM (
    SELECT age_group, product_id,
      count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS views,
      count(DISTINCT CASE WHEN event_type = 'cart' THEN user_id END) AS add_to_cart,
      count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS purchases,
      CAST(sum(CASE WHEN event_type = 'purchase' THEN price END) AS DOUBLE) AS total_revenue
    FROM j GROUP BY age_group, product_id)
)"""

RECS = """rk AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY age_group
           ORDER BY recommendation_score DESC, product_id ASC NULLS LAST) AS INT) AS rank
  FROM sps QUALIFY rank <= 10
),
recs AS (
  SELECT rk.age_group, rk.rank, rk.product_id, rk.views, rk.add_to_cart, rk.purchases,
         rk.total_revenue, rk.recommendation_score, pr.product_name, pr.category_name, pr.brand
  FROM rk LEFT JOIN pr ON rk.product_id = pr.product_id
)"""

SQL["segment_activity"] = (with_adapter(SEGMENTS, JOINED)
                           + "SELECT age_group, count(*) AS events_count FROM j GROUP BY age_group")
SQL["segment_product_stats"] = with_adapter(SEGMENTS, JOINED, SPS) + "SELECT * FROM sps"
SQL["recs_top10"] = with_adapter(SEGMENTS, JOINED, SPS, RECS) + "SELECT * FROM recs"

_wide_fields = [("product_id", "product_id"), ("product_name", "coalesce(product_name, 'Unknown')"),
                ("score", "recommendation_score"), ("views", "views"),
                ("add_to_cart", "add_to_cart"), ("purchases", "purchases")]
SQL["recs_wide"] = with_adapter(SEGMENTS, JOINED, SPS, RECS) + (
    f"SELECT '{RUN_ID}_segment_' || age_group AS row_key, age_group, "
    "'demographic' AS segment_type, TIMESTAMP '2024-02-01 00:00:00' AS created_at, "
    + ", ".join(f"max(CASE WHEN rank = {i} THEN {expr} END) AS rank_{i}_{f}"
                for i in range(1, 11) for f, expr in _wide_fields)
    + " FROM recs GROUP BY age_group")

# --- brands -----------------------------------------------------------------

BAM = f"""ba AS (
  SELECT user_id, CAST(floor(date_diff('day', birth_date, {AS_OF_DATE}) / 365.25) AS INT) AS age FROM us
),
bj AS (
  SELECT e.*, {band_a('ba.age')} AS age_group
  FROM {{src}} e LEFT JOIN ba ON e.user_id = ba.user_id WHERE e.brand IS NOT NULL
),
bm AS (
  SELECT *, CASE WHEN total_views > 0 THEN total_purchases / total_views ELSE 0.0 END
            AS overall_conversion_rate
  FROM (
    SELECT brand, age_group, count(DISTINCT user_id) AS unique_users,
      CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS total_views,
      CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS total_purchases,
      CAST(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS DOUBLE) AS total_revenue
    FROM bj GROUP BY brand, age_group)
)"""

TOP100 = """top AS (
  SELECT brand FROM bm GROUP BY brand
  ORDER BY sum(total_revenue) DESC NULLS LAST, brand LIMIT 100
)"""

SQL["brand_age_metrics"] = with_adapter(BAM.format(src="ev")) + "SELECT * FROM bm"
SQL["order_brand_age_metrics"] = with_adapter(BAM.format(src="op")) + "SELECT * FROM bm"
SQL["brand_top100"] = (with_adapter(BAM.format(src="ev"), TOP100)
                       + "SELECT * FROM bm WHERE brand IN (SELECT brand FROM top)")
SQL["brand_records"] = with_adapter(BAM.format(src="ev"), TOP100) + f"""SELECT
  '{RUN_ID}_' || brand || '_' || age_group AS row_key, brand, age_group, unique_users,
  total_views, total_purchases, round(total_revenue, 2) AS total_revenue,
  round(overall_conversion_rate, 4) AS conversion_rate,
  TIMESTAMP '2024-02-01 00:00:00' AS created_at
FROM bm WHERE brand IN (SELECT brand FROM top)"""
SQL["brand_top10_revenue"] = (with_adapter(BAM.format(src="ev"))
                              + "SELECT * FROM bm ORDER BY total_revenue DESC NULLS LAST, "
                                "brand, age_group LIMIT 10")

BUM = """uj AS (SELECT ev.*, sg.age_group FROM ev JOIN sg ON ev.user_id = sg.user_id
           WHERE ev.brand IS NOT NULL),
um AS (
  SELECT brand, count(DISTINCT user_id) AS unique_users,
    count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS viewers,
    count(DISTINCT CASE WHEN event_type = 'cart' THEN user_id END) AS cart_users,
    count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers,
    count(CASE WHEN event_type = 'view' THEN 1 END) AS total_views,
    count(CASE WHEN event_type = 'cart' THEN 1 END) AS total_cart_adds,
    count(CASE WHEN event_type = 'purchase' THEN 1 END) AS total_purchases,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN price END) AS DOUBLE) AS total_revenue
  FROM uj GROUP BY brand
),
dom AS (
  SELECT brand, age_group, events_count FROM (
    SELECT brand, age_group, count(*) AS events_count FROM uj GROUP BY brand, age_group)
  QUALIFY row_number() OVER (PARTITION BY brand ORDER BY events_count DESC, age_group) = 1
),
bu AS (
  SELECT um.*,
    CASE WHEN viewers > 0 THEN cart_users / viewers ELSE 0.0 END AS view_to_cart_rate,
    CASE WHEN cart_users > 0 THEN buyers / cart_users ELSE 0.0 END AS cart_to_purchase_rate,
    CASE WHEN viewers > 0 THEN buyers / viewers ELSE 0.0 END AS overall_conversion_rate,
    dom.age_group
  FROM um LEFT JOIN dom ON um.brand = dom.brand
)"""

SQL["brand_user_metrics"] = with_adapter(SEGMENTS, BUM) + "SELECT * FROM bu"
SQL["brand_dominant_age"] = with_adapter(SEGMENTS, BUM) + "SELECT * FROM dom"
SQL["brand_top3_records"] = with_adapter(SEGMENTS, BUM) + f"""SELECT
  '{RUN_ID}_brand_' || brand AS row_key, brand, unique_users, total_views, total_purchases,
  round(coalesce(total_revenue, 0.0), 2) AS total_revenue,
  round(overall_conversion_rate, 4) AS conversion_rate,
  coalesce(age_group, 'Unknown') AS dominant_age_group,
  TIMESTAMP '2024-02-01 00:00:00' AS created_at, '7days' AS period, 'active' AS status
FROM bu ORDER BY total_revenue DESC NULLS LAST, brand LIMIT 3"""

# --- dimensions -------------------------------------------------------------

SQL["user_demographics"] = with_adapter() + """SELECT city,
  CASE WHEN age < 26 THEN '18-25' WHEN age < 36 THEN '26-35' WHEN age < 51 THEN '36-50'
       ELSE '50+' END AS age_group,
  count(*) AS users_count
FROM (SELECT city, CAST(year(DATE '2024-02-01') - year(birth_date) AS INT) AS age FROM us)
GROUP BY ALL"""
SQL["distinct_categories"] = (with_adapter()
                              + "SELECT DISTINCT category_code AS category_id, category_code FROM ev")
SQL["first_per_product"] = with_adapter() + """SELECT product_id, category_code, brand, event_id
FROM ev QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_id) = 1"""
SQL["clean_products"] = (with_adapter()
                         + "SELECT * FROM pr WHERE price IS NOT NULL AND category_code IS NOT NULL")
SQL["zip_join"] = with_adapter(
    """za AS (SELECT user_id, row_number() OVER (ORDER BY user_id ASC NULLS FIRST) AS pos
        FROM (SELECT DISTINCT user_id FROM ev)),
zb AS (SELECT name, city, birth_date, user_id AS profile_key,
              row_number() OVER (ORDER BY user_id ASC NULLS FIRST) AS pos FROM us)""") + """SELECT
  za.user_id, zb.name, zb.city, zb.birth_date, zb.profile_key
FROM za FULL OUTER JOIN zb ON za.pos = zb.pos"""
SQL["extend_ids"] = with_adapter(
    """ids AS (SELECT DISTINCT user_id FROM ev),
st AS (SELECT max(user_id) AS mx, count(*) AS n, (SELECT count(*) FROM customer) AS target FROM ids)""") + """
SELECT user_id FROM ids
UNION ALL
SELECT CAST(unnest(generate_series(mx + 1, mx + (target - n))) AS BIGINT) AS user_id FROM st"""

# --- profiles ---------------------------------------------------------------

SQL["event_type_distribution"] = (with_adapter()
                                  + "SELECT event_type, count(*) AS event_count FROM ev GROUP BY 1")
SQL["events_per_day"] = (with_adapter()
                         + "SELECT CAST(event_time AS DATE) AS day, count(*) AS event_count "
                           "FROM ev GROUP BY 1")
SQL["events_per_hour"] = (with_adapter()
                          + "SELECT CAST(hour(event_time) AS INT) AS hour, count(*) AS event_count "
                            "FROM ev GROUP BY 1")
SQL["distinct_counts"] = with_adapter() + """SELECT count(DISTINCT product_id) AS products,
  count(DISTINCT category_code) AS categories, count(DISTINCT user_id) AS users,
  count(DISTINCT brand) AS brands, count(*) AS events FROM ev"""
SQL["events_lookback"] = with_adapter() + f"""SELECT event_type, count(*) AS event_count
FROM ev WHERE event_time >= {LOOKBACK_START} GROUP BY 1"""
SQL["recent_purchases"] = with_adapter() + f"""SELECT count(*) AS purchase_count,
  min(event_time) AS min_time, max(event_time) AS max_time
FROM ev WHERE event_type = 'purchase' AND event_time >= {LOOKBACK_START}"""

# --- sliding windows ----------------------------------------------------------
# Every 5-minute window sliding by 1 minute that holds an event starts at the
# event's minute or one of the four minutes before it.

WIN = """w AS (
  SELECT x.*, x.m - to_minutes(CAST(x.i AS BIGINT)) AS window_start,
         x.m - to_minutes(CAST(x.i AS BIGINT)) + INTERVAL 5 MINUTE AS window_end
  FROM (SELECT ev.*, date_trunc('minute', event_time) AS m, unnest([0, 1, 2, 3, 4]) AS i FROM ev) x
)"""

SQL["sliding_active_users"] = with_adapter(WIN) + """SELECT window_start, window_end,
  count(DISTINCT user_id) AS active_users, count(*) AS total_events
FROM w GROUP BY window_start, window_end"""

PV = """pv AS (
  SELECT window_start, window_end, product_id, brand, category_code, count(*) AS view_count,
         CAST(sum(price) AS DOUBLE) / count(price) AS avg_price
  FROM w WHERE event_type = 'view'
  GROUP BY window_start, window_end, product_id, brand, category_code
)"""
SQL["sliding_product_views"] = with_adapter(WIN, PV) + "SELECT * FROM pv"
SQL["sliding_top_products"] = with_adapter(WIN, PV) + """SELECT *,
  CAST(row_number() OVER (PARTITION BY window_start ORDER BY view_count DESC,
       product_id ASC NULLS LAST, brand ASC NULLS LAST, category_code ASC NULLS LAST) AS INT) AS rank
FROM pv QUALIFY rank <= 10"""
SQL["sliding_purchases"] = with_adapter(WIN) + """SELECT window_start, window_end,
  count(*) AS purchase_count, CAST(sum(price) AS DOUBLE) AS total_revenue,
  CAST(sum(price) AS DOUBLE) / count(price) AS avg_basket_value,
  count(DISTINCT user_id) AS purchasing_users
FROM w WHERE event_type = 'purchase' GROUP BY window_start, window_end"""
SQL["sliding_event_distribution"] = with_adapter(WIN) + """SELECT window_start, window_end,
  event_type, count(*) AS event_count
FROM w GROUP BY window_start, window_end, event_type"""
BA = """ba2 AS (
  SELECT window_start, window_end, brand, event_type, count(*) AS event_count,
         CAST(sum(price) AS DOUBLE) AS total_value
  FROM w WHERE brand IS NOT NULL GROUP BY window_start, window_end, brand, event_type
)"""
SQL["sliding_brand_activity"] = with_adapter(WIN, BA) + "SELECT * FROM ba2"
SQL["sliding_top_brands"] = with_adapter(WIN, BA) + """SELECT *,
  CAST(row_number() OVER (PARTITION BY window_start ORDER BY event_count DESC,
       brand ASC NULLS LAST, event_type ASC NULLS LAST) AS INT) AS rank
FROM ba2 QUALIFY rank <= 10"""

# --- reports ------------------------------------------------------------------
# Metric tables as CTEs, then the report statements over their report
# windows (start minute divisible by 5).

AU = """au AS (
  SELECT window_start, window_end, count(DISTINCT user_id) AS active_users, count(*) AS total_events
  FROM w GROUP BY window_start, window_end
)"""
PU = """pu AS (
  SELECT window_start, window_end, count(*) AS purchase_count,
         CAST(sum(price) AS DOUBLE) AS total_revenue,
         CAST(sum(price) AS DOUBLE) / count(price) AS avg_basket_value,
         count(DISTINCT user_id) AS purchasing_users
  FROM w WHERE event_type = 'purchase' GROUP BY window_start, window_end
)"""
ED = """ed AS (
  SELECT window_start, window_end, event_type, count(*) AS event_count
  FROM w GROUP BY window_start, window_end, event_type
)"""
TPW = """tpw AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY view_count DESC,
         product_id ASC NULLS LAST, brand ASC NULLS LAST, category_code ASC NULLS LAST) AS INT) AS rank
  FROM pv QUALIFY rank <= 10
)"""
TBW = """tbw AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY event_count DESC,
         brand ASC NULLS LAST, event_type ASC NULLS LAST) AS INT) AS rank
  FROM ba2 QUALIFY rank <= 10
)"""
RW = "time_bucket(INTERVAL 5 MINUTE, window_start) = window_start"
XS = f"xs AS (SELECT CAST(active_users AS DOUBLE) AS x FROM au WHERE {RW})"

SQL["active_user_summary"] = with_adapter(WIN, AU) + f"""SELECT count(*) AS windows,
  avg(active_users) AS mean_users, max(active_users) AS max_users, min(active_users) AS min_users,
  CAST(median(active_users) AS DOUBLE) AS median_users,
  round(stddev_samp(active_users), 6) AS std_users,
  CAST(sum(total_events) AS BIGINT) AS total_events,
  CAST(sum(total_events) AS DOUBLE) / sum(active_users) AS events_per_user
FROM au WHERE {RW}"""

SQL["active_user_boxplot"] = with_adapter(WIN, AU, XS, """q AS (
  SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3,
         quantile_cont(x, 0.25) - 1.5 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) AS lo,
         quantile_cont(x, 0.75) + 1.5 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) AS hi
  FROM xs
)""") + """SELECT round((SELECT q1 FROM q), 6) AS q1, round((SELECT med FROM q), 6) AS median,
  round((SELECT q3 FROM q), 6) AS q3,
  min(CASE WHEN x >= (SELECT lo FROM q) THEN x END) AS lower_whisker,
  max(CASE WHEN x <= (SELECT hi FROM q) THEN x END) AS upper_whisker,
  count(CASE WHEN x < (SELECT lo FROM q) OR x > (SELECT hi FROM q) THEN 1 END) AS outliers
FROM xs"""

SQL["active_user_histogram"] = with_adapter(WIN, AU, XS, """mm AS (
  SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
         CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM xs
),
hc AS (
  SELECT CAST(least(floor((x - (SELECT lo FROM mm)) * 10 / ((SELECT hi FROM mm) - (SELECT lo FROM mm))), 9) AS INT) AS bin,
         count(*) AS cnt
  FROM xs GROUP BY 1
),
hb AS (
  SELECT CAST(range AS INT) AS bin,
         (SELECT lo FROM mm) + CAST(range AS INT) * (((SELECT hi FROM mm) - (SELECT lo FROM mm)) / 10) AS lower,
         CASE WHEN range = 9 THEN (SELECT hi FROM mm)
              ELSE (SELECT lo FROM mm) + (CAST(range AS INT) + 1) * (((SELECT hi FROM mm) - (SELECT lo FROM mm)) / 10)
         END AS upper
  FROM range(10)
)""") + """SELECT hb.bin, lower, upper, (lower + upper) / 2 AS center,
  CAST(CAST(trunc(lower) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(trunc(upper) AS BIGINT) AS VARCHAR) AS label,
  CAST(coalesce(cnt, 0) AS BIGINT) AS count
FROM hb LEFT JOIN hc ON hb.bin = hc.bin"""

BSNAP = f"""bsnap AS (
  SELECT * FROM ba2 WHERE {RW}
  QUALIFY row_number() OVER (PARTITION BY brand, event_type ORDER BY window_start DESC) = 1
)"""
SQL["latest_snapshot"] = with_adapter(WIN, BA, BSNAP) + "SELECT * FROM bsnap"
SQL["brand_totals_top3"] = with_adapter(WIN, BA, BSNAP) + """SELECT brand,
  CAST(sum(event_count) AS BIGINT) AS event_count, round(sum(total_value), 2) AS total_value,
  round(round(sum(total_value), 2) / sum(event_count), 6) AS value_per_event
FROM bsnap GROUP BY brand ORDER BY total_value DESC, brand LIMIT 3"""

SQL["stage_conversion"] = with_adapter(WIN, ED, f"""st AS (
  SELECT CAST(coalesce(sum(CASE WHEN event_type = 'view' THEN event_count END), 0) AS BIGINT) AS view_events,
         CAST(coalesce(sum(CASE WHEN event_type = 'cart' THEN event_count END), 0) AS BIGINT) AS cart_events,
         CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN event_count END), 0) AS BIGINT) AS purchase_events
  FROM ed WHERE {RW}
)""") + """SELECT *,
  CAST(cart_events AS DOUBLE) / nullif(view_events, 0) * 100 AS view_to_cart_pct,
  CAST(purchase_events AS DOUBLE) / nullif(cart_events, 0) * 100 AS cart_to_purchase_pct,
  CAST(purchase_events AS DOUBLE) / nullif(view_events, 0) * 100 AS view_to_purchase_pct
FROM st"""

SQL["purchase_totals"] = with_adapter(WIN, PU) + f"""SELECT count(*) AS windows,
  round(sum(total_revenue), 2) AS total_revenue, CAST(sum(purchase_count) AS BIGINT) AS purchase_count,
  round(avg(avg_basket_value), 6) AS mean_basket_value
FROM pu WHERE {RW}"""
SQL["purchase_series"] = with_adapter(WIN, PU) + f"SELECT * FROM pu WHERE {RW}"

SQL["top_products_latest"] = with_adapter(WIN, PV, f"""psnap AS (
  SELECT * FROM pv WHERE {RW}
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY window_start DESC) = 1
)""") + "SELECT * FROM psnap ORDER BY view_count DESC, product_id LIMIT 10"

# funnel records as a CTE
REC = f"""rec AS (
  SELECT '{RUN_ID}_' || type || '_' || name AS row_key, type, name,
    users_viewed, users_added_to_cart, users_purchased,
    {", ".join(f"coalesce(round({c}, 4), 0.0) AS {c}" for c in _rates)},
    {", ".join(f"coalesce(CAST(trunc({c}) AS BIGINT), 0) AS {c}" for c in _durs)}
  FROM u
)"""
UREC = """u AS (
  SELECT 'category' AS type, coalesce(nullif(category_code, ''), 'unknown') AS name, * EXCLUDE (category_code) FROM fc
  UNION ALL
  SELECT 'brand' AS type, brand AS name, * EXCLUDE (brand) FROM fb
)"""
FREC = [touch_sql(), funnel_sql("category_code", "", "fc"),
        funnel_sql("brand", "WHERE brand IS NOT NULL", "fb"), UREC, REC]
ACTIVE = "(users_viewed > 0 OR users_added_to_cart > 0 OR users_purchased > 0)"
BF = f"""bft AS (
  SELECT *, CAST(users_added_to_cart AS DOUBLE) / nullif(users_viewed, 0) * 100 AS v2c_rate,
            CAST(users_purchased AS DOUBLE) / nullif(users_added_to_cart, 0) * 100 AS c2p_rate
  FROM (
    SELECT name, CAST(sum(users_viewed) AS BIGINT) AS users_viewed,
           CAST(sum(users_added_to_cart) AS BIGINT) AS users_added_to_cart,
           CAST(sum(users_purchased) AS BIGINT) AS users_purchased
    FROM rec WHERE {ACTIVE} AND type = 'brand' GROUP BY name
    ORDER BY users_viewed DESC, name LIMIT 15)
)"""
SQL["brand_funnel_top15"] = with_adapter(*FREC, BF) + "SELECT * FROM bft"
SQL["funnel_totals"] = with_adapter(*FREC, f"""ft AS (
  SELECT CAST(sum(users_viewed) AS BIGINT) AS users_viewed,
         CAST(sum(users_added_to_cart) AS BIGINT) AS users_added_to_cart,
         CAST(sum(users_purchased) AS BIGINT) AS users_purchased
  FROM rec WHERE {ACTIVE}
)""") + """SELECT *,
  CASE WHEN users_viewed > 0 THEN CAST(users_added_to_cart AS DOUBLE) / users_viewed * 100 ELSE 0.0 END AS view_to_cart_pct,
  CASE WHEN users_added_to_cart > 0 THEN CAST(users_purchased AS DOUBLE) / users_added_to_cart * 100 ELSE 0.0 END AS cart_to_purchase_pct
FROM ft"""
SQL["view_to_cart_time"] = with_adapter(*FREC, """vt AS (
  SELECT name, avg(avg_view_to_cart_seconds) AS avg_view_to_cart_seconds,
         CAST(sum(users_viewed) AS BIGINT) AS users_viewed,
         CAST(sum(users_added_to_cart) AS BIGINT) AS users_added_to_cart
  FROM rec WHERE type = 'brand' AND avg_view_to_cart_seconds > 0
  GROUP BY name
)""") + """SELECT * FROM vt
ORDER BY avg_view_to_cart_seconds DESC, name LIMIT 10"""
SQL["high_conversion_brands"] = with_adapter(*FREC, BF) + """SELECT * FROM bft
WHERE users_viewed >= 20 ORDER BY v2c_rate DESC NULLS LAST, name LIMIT 5"""
SQL["rate_distribution"] = with_adapter(*FREC, BF) + """SELECT round(avg(v2c_rate), 6) AS mean_v2c,
  round(median(v2c_rate), 6) AS median_v2c, max(v2c_rate) AS max_v2c, min(v2c_rate) AS min_v2c FROM bft"""

# wide recommendation rows as a CTE
WIDE = ("wide AS (SELECT age_group, "
        + ", ".join(f"max(CASE WHEN rank = {i} THEN {expr} END) AS rank_{i}_{f}"
                    for i in range(1, 11) for f, expr in _wide_fields)
        + " FROM recs GROUP BY age_group)")
WREC = [SEGMENTS, JOINED, SPS, RECS, WIDE]


def rank_rows(fields: list[str], ranks: range) -> str:
    return " UNION ALL ".join(
        f"SELECT age_group, {i} AS rank, " + ", ".join(f"rank_{i}_{f} AS {f}" for f in fields) + " FROM wide"
        for i in ranks)


SQL["most_recommended"] = with_adapter(*WREC, f"e AS ({rank_rows(['product_name'], range(1, 11))})") + """
SELECT product_name, count(*) AS times, substring(product_name, 1, 40) AS label
FROM e WHERE product_name IS NOT NULL GROUP BY product_name
ORDER BY times DESC, product_name LIMIT 20"""
RPT = f"""rpt AS (
  SELECT rank, CAST(coalesce(sum(views), 0) AS BIGINT) AS views,
         CAST(coalesce(sum(add_to_cart), 0) AS BIGINT) AS add_to_cart,
         CAST(coalesce(sum(purchases), 0) AS BIGINT) AS purchases
  FROM ({rank_rows(['views', 'add_to_cart', 'purchases'], range(1, 11))}) GROUP BY rank
)"""
SQL["rank_position_totals"] = with_adapter(*WREC, RPT) + "SELECT * FROM rpt"
SQL["rank_decay"] = with_adapter(*WREC, RPT) + """SELECT
  f.views AS views_rank1, l.views AS views_rank10,
  CAST(l.views AS DOUBLE) / nullif(f.views, 0) * 100 AS views_decay_pct,
  f.add_to_cart AS cart_rank1, l.add_to_cart AS cart_rank10,
  CAST(l.add_to_cart AS DOUBLE) / nullif(f.add_to_cart, 0) * 100 AS cart_decay_pct
FROM (SELECT * FROM rpt WHERE rank = 1) f JOIN (SELECT * FROM rpt WHERE rank = 10) l ON TRUE"""
SQL["age_group_top3"] = with_adapter(*WREC, f"e AS ({rank_rows(['product_name'], range(1, 6))})") + """
SELECT c.age_group, c.product_name, c.times, c.position, s.segments FROM (
  SELECT age_group, product_name, count(*) AS times,
         CAST(row_number() OVER (PARTITION BY age_group ORDER BY count(*) DESC, product_name) AS INT) AS position
  FROM e WHERE product_name IS NOT NULL GROUP BY age_group, product_name
  QUALIFY position <= 3) c
LEFT JOIN (SELECT age_group, count(*) AS segments FROM wide GROUP BY age_group) s ON c.age_group = s.age_group"""
SQL["rank_ctr"] = with_adapter(*WREC, RPT, """ct AS (
  SELECT rank, coalesce(CAST(add_to_cart AS DOUBLE) / nullif(views, 0) * 100, 0.0) AS ctr FROM rpt
)""") + """SELECT round(avg(CASE WHEN rank <= 3 THEN ctr END), 6) AS ctr_top3,
  round(avg(CASE WHEN rank >= 8 THEN ctr END), 6) AS ctr_bottom3,
  round(avg(CASE WHEN rank <= 3 THEN ctr END) - avg(CASE WHEN rank >= 8 THEN ctr END), 6) AS ctr_diff
FROM ct"""

# brand records as a CTE
BREC = [BAM.format(src="ev"), """brec AS (
  SELECT brand, age_group, unique_users, total_views, total_purchases,
         round(total_revenue, 2) AS total_revenue, round(overall_conversion_rate, 4) AS conversion_rate
  FROM bm WHERE brand IS NOT NULL
)""", """bro AS (
  SELECT brand, CAST(sum(total_views) AS BIGINT) AS total_views,
         CAST(sum(total_purchases) AS BIGINT) AS total_purchases,
         round(sum(total_revenue), 2) AS total_revenue,
         CAST(sum(unique_users) AS BIGINT) AS unique_users,
         round(avg(conversion_rate), 6) AS conversion_rate
  FROM brec GROUP BY brand
)"""]
SQL["brand_rollup"] = with_adapter(*BREC) + "SELECT * FROM bro"
SQL["brand_top10_by"] = with_adapter(*BREC) + """SELECT brand, metric, value,
  CAST(row_number() OVER (PARTITION BY metric ORDER BY value DESC, brand) AS INT) AS position
FROM (""" + " UNION ALL ".join(
    f"SELECT brand, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM bro"
    for m in ("total_revenue", "total_views", "conversion_rate", "total_purchases")) + """)
QUALIFY position <= 10"""
SQL["brand_arpu"] = with_adapter(*BREC) + """SELECT *,
  round(coalesce(total_revenue / nullif(unique_users, 0), 0.0), 6) AS arpu
FROM bro ORDER BY arpu DESC, brand LIMIT 15"""
SQL["brand_grand_totals"] = with_adapter(*BREC) + """SELECT count(*) AS brands,
  round(sum(total_revenue), 2) AS total_revenue, CAST(sum(total_views) AS BIGINT) AS total_views,
  CAST(sum(total_purchases) AS BIGINT) AS total_purchases,
  round(avg(conversion_rate), 6) AS mean_conversion_rate FROM bro"""
SQL["high_traffic_brands"] = with_adapter(*BREC) + """SELECT count(*) AS brands,
  round(avg(conversion_rate), 6) AS mean_conversion_rate
FROM bro WHERE total_views > (SELECT quantile_cont(total_views, 0.75) FROM bro)"""

SQL["window_summary"] = with_adapter(WIN, AU, PU, ED, PV, TPW, BA, TBW) + """SELECT
  au.window_start, au.window_end, au.active_users, au.total_events,
  coalesce(CAST(au.total_events AS DOUBLE) / nullif(au.active_users, 0), 0.0) AS events_per_user,
  coalesce(pu.purchase_count, 0) AS purchase_count, coalesce(pu.total_revenue, 0.0) AS total_revenue,
  pu.avg_basket_value, coalesce(pu.purchasing_users, 0) AS purchasing_users,
  coalesce(e.view_events, 0) AS view_events, coalesce(e.cart_events, 0) AS cart_events,
  coalesce(e.purchase_events, 0) AS purchase_events,
  b.top_brand, b.top_brand_event_type, b.top_brand_events,
  coalesce(b.top_list_brands, 0) AS top_list_brands,
  p.product_id AS top_product_id, p.view_count AS top_product_views,
  CAST(e.cart_events AS DOUBLE) / nullif(e.view_events, 0) AS view_to_cart_ratio,
  CAST(e.purchase_events AS DOUBLE) / nullif(e.cart_events, 0) AS cart_to_purchase_ratio
FROM au
LEFT JOIN pu ON au.window_start = pu.window_start
LEFT JOIN (SELECT window_start,
             CAST(sum(CASE WHEN event_type = 'view' THEN event_count END) AS BIGINT) AS view_events,
             CAST(sum(CASE WHEN event_type = 'cart' THEN event_count END) AS BIGINT) AS cart_events,
             CAST(sum(CASE WHEN event_type = 'purchase' THEN event_count END) AS BIGINT) AS purchase_events
           FROM ed GROUP BY window_start) e ON au.window_start = e.window_start
LEFT JOIN (SELECT window_start, count(DISTINCT brand) AS top_list_brands,
             arg_min(brand, rank) AS top_brand, arg_min(event_type, rank) AS top_brand_event_type,
             arg_min(event_count, rank) AS top_brand_events
           FROM tbw GROUP BY window_start) b ON au.window_start = b.window_start
LEFT JOIN (SELECT * FROM tpw WHERE rank = 1) p ON au.window_start = p.window_start"""

# --- stream replay and archive ------------------------------------------------
SQL["stream_event_distribution"] = SQL["sliding_event_distribution"]
SQL["archive_partition_rows"] = with_adapter() + """SELECT CAST(year(event_time) AS INT) AS year,
  CAST(month(event_time) AS INT) AS month, CAST(day(event_time) AS INT) AS day,
  CAST(hour(event_time) AS INT) AS hour, count(*) AS rows
FROM ev GROUP BY 1, 2, 3, 4"""
SQL["archive_lookback"] = with_adapter() + f"""SELECT event_type, count(*) AS event_count
FROM ev WHERE event_time >= {LOOKBACK_START} AND event_time < {LOOKBACK_END} GROUP BY 1"""

SQL["funnel_top10_categories"] = (with_adapter(touch_sql(), funnel_sql("category_code"))
                                  + "SELECT * FROM fr ORDER BY users_viewed DESC, "
                                    "category_code ASC NULLS LAST LIMIT 10")
SQL["funnel_top10_brands"] = (with_adapter(touch_sql(), funnel_sql("brand", "WHERE brand IS NOT NULL"))
                              + "SELECT * FROM fr ORDER BY users_viewed DESC, brand ASC NULLS LAST LIMIT 10")
SQL["segment_ranked_list"] = (with_adapter(SEGMENTS, JOINED, SPS, RECS)
                              + "SELECT * FROM recs ORDER BY age_group, rank")

SQL["raw_log_day_counts"] = with_adapter() + """SELECT CAST(day(event_time) AS INT) AS day,
  count(*) AS event_count, count(*) AS parsed, count(brand) AS with_brand
FROM ev WHERE strftime(event_time, '%Y-%m') = '2024-01' GROUP BY 1"""
SQL["remap_time"] = with_adapter("""rm AS (
  SELECT CASE WHEN day(event_time) >= 27
              THEN make_date(2024, 12, CAST(day(event_time) AS INT))
              ELSE make_date(2025, 1, CAST(day(event_time) AS INT)) END AS mapped_day,
         event_time - date_trunc('day', event_time) AS tod
  FROM ev
)""") + """SELECT mapped_day, count(*) AS event_count,
  min(CAST(mapped_day AS TIMESTAMP) + tod) AS first_mapped
FROM rm GROUP BY mapped_day"""

SQL["stream_brand_activity"] = with_adapter(WIN, BA) + "SELECT * REPLACE (round(total_value, 2) AS total_value) FROM ba2"
SQL["stream_top_products"] = (f"SELECT * REPLACE (round(avg_price, 6) AS avg_price) FROM ({SQL['sliding_top_products']})")

# --- event-time look-backs, log slice, archive tables -----------------------------
SQL["archive_funnel_24h"] = SQL["funnel_lookback"]
SQL["archive_brand_7d"] = with_adapter("e7 AS (SELECT * FROM ev WHERE event_time >= TIMESTAMP '2024-01-24 00:00:00')",
                                       BAM.format(src="e7")) + "SELECT * FROM bm"
DAY = "event_time >= TIMESTAMP '2024-01-15 00:00:00' AND event_time < TIMESTAMP '2024-01-16 00:00:00'"
SQL["log_slice_types"] = with_adapter() + f"SELECT event_type, count(*) AS event_count FROM ev WHERE {DAY} GROUP BY 1"
SQL["archive_columns"] = (with_adapter()
                          + "SELECT event_type, brand, count(*) AS event_count FROM ev GROUP BY 1, 2")
SQL["archive_day_purchases"] = with_adapter() + f"""SELECT CAST(hour(event_time) AS INT) AS hour,
  count(*) AS purchases, CAST(sum(price) AS DOUBLE) AS revenue
FROM ev WHERE event_type = 'purchase' AND {DAY} GROUP BY 1"""
SQL["event_table_days"] = with_adapter() + """SELECT CAST(year(event_time) AS INT) AS year,
  CAST(month(event_time) AS INT) AS month, CAST(day(event_time) AS INT) AS day, event_type,
  count(*) AS event_count FROM ev GROUP BY 1, 2, 3, 4"""
SQL["event_table_partitions"] = with_adapter() + """SELECT DISTINCT CAST(year(event_time) AS INT) AS year,
  CAST(month(event_time) AS INT) AS month, CAST(day(event_time) AS INT) AS day,
  CAST(hour(event_time) AS INT) AS hour FROM ev"""
SQL["event_table_added_hour"] = with_adapter() + f"""SELECT event_type, count(*) AS event_count
FROM ev WHERE {DAY} AND hour(event_time) = 12 GROUP BY 1"""

# --- sinks read back ----------------------------------------------------------------
SQL["users_csv_readback"] = with_adapter() + """SELECT *,
  lpad(CAST(user_id % 100000 AS VARCHAR), 5, '0') AS zip_code FROM us"""
SQL["users_parquet_readback"] = with_adapter() + "SELECT * FROM us"
SQL["products_readback"] = SQL["clean_products"]
SQL["product_csv_table"] = with_adapter() + """SELECT brand, count(*) AS products,
  max(product_id) AS last_product_id FROM pr GROUP BY 1"""
SQL["serving_prefix_scan"] = with_adapter(WIN) + """SELECT strftime(window_start, '%Y%m%d_%H%M') || '_event_'
    || coalesce(replace(event_type, '_', '\\_'), '\\N') AS row_key,
  window_start, window_end, event_type, count(*) AS event_count
FROM w WHERE CAST(window_start AS DATE) = DATE '2024-01-15' GROUP BY window_start, window_end, event_type"""
SQL["window_key_events"] = with_adapter(WIN) + """SELECT strftime(k.s, '%Y%m%d_%H%M') AS window_key,
  count(w.event_id) AS total_events
FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-31 23:55:00',
                                    INTERVAL 5 MINUTE)) AS s) k
LEFT JOIN w ON w.window_start = k.s GROUP BY k.s"""

# --- normalisation, naming, lists ------------------------------------------------------
SQL["normalised_events"] = with_adapter() + """SELECT date_trunc('second', event_time) AS event_timestamp,
  event_type, product_id, category_code, brand, coalesce(CAST(price AS DOUBLE), 0.0) AS price, user_id FROM ev"""
SQL["coerced_numbers"] = with_adapter() + """SELECT event_type, CAST(sum(product_id) AS DOUBLE) AS product_ids,
  count(TRY_CAST(brand AS DOUBLE)) AS numeric_brands, sum(coalesce(TRY_CAST(brand AS DOUBLE), 1.0)) AS defaults
FROM ev GROUP BY 1"""
SQL["named_products"] = with_adapter() + "SELECT product_id, category_id, brand, category_name, product_name FROM pr"
SQL["recommended_items"] = (with_adapter(SEGMENTS, JOINED, SPS, RECS)
                            + "SELECT DISTINCT product_id, product_name FROM recs")
SQL["views_top10"] = with_adapter(WIN, PV) + """SELECT *, CAST(row_number() OVER (ORDER BY view_count DESC,
  window_start, product_id ASC NULLS LAST, brand ASC NULLS LAST, category_code ASC NULLS LAST) AS INT) AS rank
FROM pv QUALIFY rank <= 10"""
SQL["first_events"] = with_adapter() + """SELECT event_id, event_time, user_id, event_type, product_id, price
FROM ev ORDER BY event_id LIMIT 10"""
SQL["order_daily_top_products"] = with_adapter() + """SELECT *, CAST(row_number() OVER (PARTITION BY day
  ORDER BY lines DESC, product_id ASC NULLS LAST) AS INT) AS rank
FROM (SELECT CAST(event_time AS DATE) AS day, product_id, count(*) AS lines FROM op GROUP BY 1, 2)
QUALIFY rank <= 10"""
SQL["order_daily_top_brands"] = with_adapter() + """SELECT *, CAST(row_number() OVER (PARTITION BY day
  ORDER BY revenue DESC, brand) AS INT) AS rank
FROM (SELECT CAST(event_time AS DATE) AS day, brand, CAST(sum(price) AS DOUBLE) AS revenue
      FROM op WHERE brand IS NOT NULL GROUP BY 1, 2)
QUALIFY rank <= 10"""
SQL["order_brand_top5"] = with_adapter(BAM.format(src="op")) + """SELECT * FROM bm WHERE brand IN (
  SELECT brand FROM bm GROUP BY brand ORDER BY sum(total_revenue) DESC NULLS LAST, brand LIMIT 5)"""

# --- estimates with a bound, zone map, live runs that are cut, late, failing or several ---
# an estimate itself depends on the sketch; that it lies in its bound doesn't
SQL["sliding_active_users_approx"] = f"SELECT *, true AS estimate_in_bound FROM ({SQL['sliding_active_users']})"
SQL["stream_active_users"] = SQL["sliding_active_users_approx"]
SQL["stream_purchases"] = with_adapter(WIN, PU) + """SELECT window_start, window_end, purchase_count,
  round(total_revenue, 2) AS total_revenue, round(avg_basket_value, 6) AS avg_basket_value, purchasing_users,
  true AS estimate_in_bound FROM pu"""

SQL["archive_zone_map"] = with_adapter("""arrived AS (
  SELECT *, event_time + to_hours(CASE event_id % 50 WHEN 0 THEN 26 WHEN 1 THEN -24 ELSE 0 END) AS broker_time
  FROM ev)""") + """
SELECT CAST(year(broker_time) AS INT) AS year, CAST(month(broker_time) AS INT) AS month,
  CAST(day(broker_time) AS INT) AS day, CAST(hour(broker_time) AS INT) AS hour, count(*) AS rows,
  min(event_time) AS low, max(event_time) AS high
FROM arrived GROUP BY 1, 2, 3, 4"""

SQL["stream_restarted"] = SQL["sliding_event_distribution"]
SQL["stream_reconciled"] = SQL["sliding_event_distribution"]

# batches of five days, every tenth message two batches late; late rows of a batch are told by the watermark
# that the batch before it started with, ten minutes behind the latest event until then in whole milliseconds
SQL["stream_late_events"] = with_adapter("""sent AS (
  SELECT *, (day(event_time) - 1) // 5 + CASE WHEN event_id % 10 = 3 THEN 2 ELSE 0 END AS batch FROM ev),
latest AS (SELECT batch, max(event_time) AS latest FROM sent GROUP BY batch),
mark AS (SELECT batch, date_trunc('milliseconds', max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
  AND 2 PRECEDING)) - INTERVAL 10 MINUTE AS mark FROM latest),
held AS (SELECT s.batch, s.event_type, date_trunc('minute', s.event_time) - to_minutes(CAST(x.i AS BIGINT)) AS window_start,
    m.mark FROM sent s JOIN mark m USING (batch), (SELECT unnest([0, 1, 2, 3, 4]) AS i) x),
told AS (SELECT *, coalesce(window_start + INTERVAL 5 MINUTE <= mark, false) AS dropped FROM held)""") + """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS event_count
FROM told WHERE NOT dropped GROUP BY window_start, event_type
UNION ALL
SELECT NULL, NULL, 'dropped', count(*) FROM (SELECT DISTINCT batch, window_start, event_type FROM told WHERE dropped)"""

# the last of the batches of ten days updates the windows that its views touch; counts are of the whole log
SQL["stream_top10"] = with_adapter(WIN) + """SELECT CAST(row_number() OVER (ORDER BY view_count DESC, window_start, product_id,
    brand NULLS LAST, category_code NULLS LAST) AS INT) AS rank, window_start, product_id, brand, category_code, view_count
FROM (SELECT window_start, product_id, brand, category_code, count(*) AS view_count,
        max((day(event_time) - 1) // 10) AS batch FROM w WHERE event_type = 'view' GROUP BY ALL)
WHERE batch = (SELECT max((day(event_time) - 1) // 10) FROM ev WHERE event_type = 'view')
ORDER BY rank LIMIT 10"""

SQL["stream_two_metrics"] = with_adapter(WIN) + """SELECT window_start, count(*) AS events,
  nullif(count(brand), 0) AS branded_events FROM w GROUP BY window_start"""

SQL["renamed_profiles"] = with_adapter() + """SELECT name, upper(name) AS surname, CAST(birth_date AS VARCHAR) AS birth_date,
  city, CAST(user_id AS VARCHAR) AS zip_code, 'Street' AS street_name, '1' AS house_number FROM us"""
SQL["segment_regions"] = with_adapter(SEGMENTS) + """SELECT 'Poland' AS region, age_group, count(*) AS users
FROM sg GROUP BY age_group"""
SQL["row_key_kinds"] = with_adapter(WIN) + """SELECT kind, count(*) AS keys FROM (
  SELECT DISTINCT 'active_users' AS kind, window_start, NULL AS a, NULL AS b, NULL AS c FROM w
  UNION ALL SELECT DISTINCT 'purchases', window_start, NULL, NULL, NULL FROM w WHERE event_type = 'purchase'
  UNION ALL SELECT DISTINCT CASE WHEN event_type IN ('view', 'cart', 'purchase') THEN 'event_' || event_type END,
    window_start, event_type, NULL, NULL FROM w
  UNION ALL SELECT DISTINCT 'top_view', window_start, CAST(product_id AS VARCHAR), brand, category_code FROM w
    WHERE event_type = 'view'
  UNION ALL SELECT DISTINCT 'brand', window_start, brand, event_type, NULL FROM w WHERE brand IS NOT NULL)
GROUP BY kind"""
SQL["users_csv_mixed"] = with_adapter() + "SELECT user_id, name, birth_date, city FROM us"
