"""For each registered query, the same result as SQL for an independent engine (DuckDB).

Averages of integers are rounded in whole numbers here, so no floating-point rounding rule is shared with the
Spark side.
"""

from __future__ import annotations

from ..functions.measures import DELIVERY_WEIGHTS
from ..operators.builders import EMAIL_DOMAINS, GENDERS, SEGMENTS
from .queries import NEXT_RUN_DATE, RUN_DATE, SCAN_MONTH


def _hash(key: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{salt}'), 1, 15) AS BIGINT)"


def _int(key: str, salt: str, low: int, high: int | str) -> str:
    return f"({low} + {_hash(key, salt)} % (({high}) - {low} + 1))"


def _pick(key: str, salt: str, choices: list[str]) -> str:
    listed = ", ".join(f"'{c}'" for c in choices)
    return f"([{listed}])[{_hash(key, salt)} % {len(choices)} + 1]"


def _weighted(key: str, salt: str, weights: dict[str, int]) -> str:
    total, branches = 0, []
    for choice, weight in weights.items():
        total += weight
        branches.append((choice, total))
    slot = f"{_hash(key, salt)} % {total}"
    return "CASE " + " ".join(f"WHEN {slot} < {bound} THEN '{choice}'" for choice, bound in branches) + " END"


def _uuid(key: str) -> str:
    digest = f"md5(CAST({key} AS VARCHAR))"
    groups = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {at}, {width})" for at, width in groups)


def _moment(key: str, salt: str) -> str:
    return f"(TIMESTAMP '2023-01-01 00:00:00' + to_seconds({_hash(key, salt)} % 31536000))"


def _mean(total: str, count: str) -> str:
    """total / count rounded half up to two decimals, for a total ≥ 0."""
    return f"(((200 * ({total}) + ({count})) // (2 * ({count}))) / 100.0)"


_SIZE_CLASS = "CASE WHEN p_size < 17 THEN 'SMALL' WHEN p_size < 34 THEN 'MEDIUM' ELSE 'LARGE' END"
_ACTUAL = (
    "CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN 0 "
    "ELSE CAST(floor(p_retailprice) AS BIGINT) END"
)
_DISCOUNT = (
    f"CASE WHEN p_partkey % 37 = 0 THEN {_ACTUAL} WHEN p_size % 11 = 0 THEN NULL "
    f"ELSE (({_ACTUAL}) * (100 - p_size % 11)) // 100 END"
)
_IMAGE = (
    "CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN 'http://img.example.com/' || p_partkey "
    "ELSE 'https://img.example.com/' || p_partkey END"
)
_LINK = "CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE 'https://shop.example.com/p/' || p_partkey END"
_TENTHS = "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE 10 + p_partkey % 41 END"
_COUNT = "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_partkey * 37 % 20000 END"

_PRODUCT = f"""
product AS (
  SELECT p_partkey AS id, p_name AS product_name, p_type AS category, {_SIZE_CLASS} AS "type",
         {_ACTUAL} AS actual_price, {_DISCOUNT} AS discount_price, {_TENTHS} AS tenths,
         {_COUNT} AS no_of_ratings, {_LINK} AS link, {_IMAGE} AS image,
         CAST(50 + p_partkey * 7919 % 9950 AS INTEGER) AS inv_quantity,
         CAST(50 + (p_partkey * 104729 + p_size) % 9950 AS INTEGER) AS quantity_sold
  FROM part)"""

_EMAIL = f"split_part(c_name, ' ', 1) || '_' || {_int('c_custkey', 'email', 100, 500)} || '@' || " + _pick(
    "c_custkey", "domain", EMAIL_DOMAINS
)

_STATUS = (
    "CASE WHEN l_returnflag = 'R' THEN 'Undelivered' WHEN l_returnflag = 'A' THEN 'Delivered' "
    "WHEN l_linestatus = 'F' THEN 'Shipped' ELSE 'Preparing' END"
)
_SHIPPED = "CAST(CAST(o_orderdate AS DATE) + CAST(1 + l_linenumber % 7 AS INTEGER) AS TIMESTAMP)"

_JOINED = f"""{_PRODUCT},
joined AS (
  SELECT p.id AS product_id, product_name, category, "type", actual_price, discount_price, tenths,
         tenths / 10.0 AS ratings, no_of_ratings, p.id AS inventory_id, inv_quantity, quantity_sold, link, image,
         c_custkey AS customer_id, c_name AS customer_name, {_pick('c_custkey', 'gender', GENDERS)} AS gender,
         {_EMAIL} AS email, {_STATUS} AS delivery_status, c_mktsegment AS segment,
         CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city, r_name AS state, 'United States' AS country,
         l_orderkey AS order_id, o_orderdate AS order_date, {_SHIPPED} AS ship_date, o_orderdate AS "timestamp",
         {_uuid('l_orderkey')} AS timeuuid, CAST(quarter(o_orderdate) AS INTEGER) AS "quarter"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN product p ON l_partkey = p.id
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

_WIDE = f"""{_JOINED},
wide AS (
  SELECT * REPLACE (coalesce(discount_price, 0) AS discount_price, coalesce(tenths, 0) AS tenths,
                    coalesce(ratings, 0) AS ratings, coalesce(no_of_ratings, 0) AS no_of_ratings)
  FROM joined
  WHERE image LIKE 'https://_%' AND link LIKE 'https://_%' AND actual_price <> 0
    AND coalesce(discount_price, 0) < actual_price),
measured AS (
  SELECT *, CAST(month(ship_date) AS INTEGER) AS "month", CAST(year(ship_date) AS INTEGER) AS "year",
         CASE WHEN discount_price <> 0 THEN discount_price ELSE actual_price END AS price
  FROM wide)"""

_INCOME = "CASE WHEN delivery_status = 'Delivered' THEN price * quantity_sold ELSE 0 END"
_PROJECTED = "CASE WHEN delivery_status IN ('Shipped', 'Preparing') THEN price ELSE 0 END"
_SPENDING = (
    "CASE WHEN discount_price = 0 AND delivery_status <> 'Undelivered' THEN actual_price ELSE discount_price END"
)
_RATE = (
    "CASE WHEN discount_price <> 0 THEN (actual_price - discount_price) / CAST(actual_price AS DOUBLE) * 100 "
    "ELSE 0.0 END"
)

_REVENUE = f"""
SELECT category, "type", city, state, "month", "quarter", "year",
       ((20 * sum(tenths) + count(*)) // (2 * count(*))) / 100.0 AS ratings,
       CAST(sum(no_of_ratings) AS BIGINT) AS no_of_ratings,
       {_mean('sum(discount_price)', 'count(*)')} AS avg_disc_price,
       {_mean('sum(actual_price)', 'count(*)')} AS avg_act_price,
       CAST(ceil(round(CAST(sum(CAST({_RATE} AS DECIMAL(26, 12))) AS DOUBLE) / count(*), 9)) AS BIGINT) AS avg_disc_rate,
       CAST(sum(quantity_sold) AS BIGINT) AS quantity_sold,
       CAST(sum({_PROJECTED}) AS BIGINT) AS projected_income,
       CAST(sum({_INCOME}) AS BIGINT) AS income,
       CAST(sum(inv_quantity) AS BIGINT) AS inv_quantity,
       CAST(sum(price * inv_quantity) AS BIGINT) AS inv_value
FROM measured GROUP BY ALL"""

# In the builders a listing's own key, and a product's, are texts.
def _natural_key(*columns: str) -> str:
    return "(" + " || ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in columns) + ")"


_TRIPLE_KEY = _natural_key("product_name", "category", '"type"')
_LISTING_KEY = _natural_key("product_name", "category", '"type"', "link")

_FIRST_NUMBER = r"[0-9][0-9,]*(\.[0-9]+)?"


def _price(text: str) -> str:
    number = f"replace(regexp_extract({text}, '{_FIRST_NUMBER}'), ',', '')"
    return f"CAST(floor(TRY_CAST({number} AS DECIMAL(28, 10)) + 0.5) AS BIGINT)"


_LISTINGS = f"""
listings AS (
  SELECT p_name AS name, p_type AS main_category, {_SIZE_CLASS} AS sub_category, {_IMAGE} AS image, {_LINK} AS link,
         CAST(({_TENTHS}) // 10 AS VARCHAR) || '.' || CAST(({_TENTHS}) % 10 AS VARCHAR) AS ratings,
         format('{{:,}}', {_COUNT}) AS no_of_ratings,
         '₹' || format('{{:,}}', {_DISCOUNT}) AS discount_price,
         CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN ''
              ELSE '₹' || format('{{:,.2f}}', p_retailprice) END AS actual_price
  FROM part)"""

_CATALOG = f"""{_LISTINGS},
catalog AS (
  SELECT name AS product_name, main_category AS category, sub_category AS "type", image, link,
         TRY_CAST(ratings AS DOUBLE) AS ratings,
         TRY_CAST(replace(no_of_ratings, ',', '') AS BIGINT) AS no_of_ratings,
         {_price('discount_price')} AS discount_price,
         {_price('actual_price')} AS actual_price,
         TRY_CAST(regexp_replace(actual_price, '[^0-9]', '', 'g') AS BIGINT) AS actual_digits
  FROM listings),
numbered AS (
  SELECT row_number() OVER (ORDER BY product_name, category, "type") AS id, product_name, category, "type"
  FROM (SELECT DISTINCT product_name, category, "type" FROM catalog))"""

_ORDER_LINES = f"""
order_lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id, o_orderdate AS order_date,
         {_SHIPPED} AS ship_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_LAST_PER_USER = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


def _wide(select: str) -> str:
    return f"WITH {_WIDE} {select}"


def _catalog(select: str) -> str:
    return f"WITH {_CATALOG} {select}"


_STOCK = (
    f"CAST({_int(_TRIPLE_KEY, 'inv_quantity', 50, 9999)} AS INTEGER) AS inv_quantity, "
    f"CAST({_int(_TRIPLE_KEY, 'quantity_sold', 50, 9999)} AS INTEGER) AS quantity_sold"
)

_ORDER_MOMENT = _moment(_TRIPLE_KEY, "timestamp")
_ORDER_DATE = _moment(_TRIPLE_KEY, "order_date")


def oracle_sql() -> dict[str, str]:
    columns = (
        "product_id, product_name, category, \"type\", actual_price, discount_price, ratings, no_of_ratings, "
        "inventory_id, inv_quantity, quantity_sold, link, image, customer_id, customer_name, gender, email, "
        "delivery_status, segment, city_id, city, state, country, order_id, order_date, ship_date, \"timestamp\", "
        "timeuuid, \"quarter\""
    )
    return {
        "wide_sales": f"WITH {_JOINED} SELECT {columns} FROM joined",
        "quality_filter": _wide(f"SELECT {columns} FROM wide"),
        "fill_nulls": f"""WITH {_PRODUCT}
            SELECT id, coalesce(discount_price, 0) AS discount_price, coalesce(tenths, 0) / 10.0 AS ratings,
                   coalesce(no_of_ratings, 0) AS no_of_ratings, actual_price FROM product""",
        "revenue_measures": _wide(
            f"""SELECT order_id, product_id, delivery_status, actual_price, discount_price,
                {_PROJECTED} AS projected_income, {_INCOME} AS income, price * inv_quantity AS inv_value FROM measured"""
        ),
        "wide_sales_stored": f"WITH {_JOINED} SELECT {columns} FROM joined",
        "revenue_report": _wide(_REVENUE),
        "report_loads": _wide(_REVENUE),
        "dim_history": f"""WITH {_PRODUCT},
            raised AS (SELECT * REPLACE (actual_price + 1 AS actual_price) FROM product
                       WHERE id % 13 = 0 AND actual_price IS NOT NULL),
            versions AS (
                SELECT p.*, DATE '{RUN_DATE}' AS valid_from, CASE WHEN r.id IS NOT NULL THEN DATE '{NEXT_RUN_DATE}' END AS valid_to
                FROM product p LEFT JOIN raised r USING (id)
                UNION ALL SELECT *, DATE '{NEXT_RUN_DATE}', NULL FROM raised)
            SELECT id, product_name, actual_price, discount_price, tenths / 10.0 AS ratings, link, valid_from, valid_to
            FROM versions""",
        "order_report": _wide(
            f"""SELECT order_id, city, state, "month", "quarter", "year",
                {_mean(f'sum({_SPENDING})', 'count(*)')} AS avg_spending,
                {_mean("sum(date_diff('day', CAST(order_date AS DATE), CAST(ship_date AS DATE)))", 'count(*)')}
                  AS processing_time,
                count(*) FILTER (delivery_status = 'Undelivered') AS canceled_order,
                count(*) AS total_order,
                {_mean("100 * count(*) FILTER (delivery_status = 'Undelivered')", 'count(*)')} AS cancellation_rate
                FROM measured GROUP BY ALL"""
        ),
        "customer_report": _wide(
            """SELECT customer_id, gender, segment, city, state, "month", "quarter", "year",
               CASE WHEN count(*) > 1 THEN 'True' ELSE 'False' END AS loyal_customer, count(*) AS total_orders
               FROM measured GROUP BY ALL"""
        ),
        "fact_order": _wide(
            """SELECT row_number() OVER (ORDER BY product_id, customer_id, city_id, timeuuid) AS id,
               product_id, customer_id, city_id, timeuuid
               FROM (SELECT DISTINCT product_id, customer_id, city_id, timeuuid FROM wide)"""
        ),
        "dim_product": _wide(
            """SELECT DISTINCT product_id AS id, product_name, category, "type", actual_price, discount_price,
               ratings, no_of_ratings, link, image, quantity_sold, inv_quantity, delivery_status FROM wide"""
        ),
        "dim_customer": _wide(
            "SELECT DISTINCT customer_id AS id, customer_name, gender, email, segment FROM wide"
        ),
        "dim_location": _wide("SELECT DISTINCT city_id AS id, city, state, country FROM wide"),
        "dim_date": _wide(
            """SELECT DISTINCT timeuuid, "year", "quarter", 'Q' || "quarter" AS quarter_name, "month",
               strftime(ship_date, '%B') AS month_name, CAST(day(ship_date) AS INTEGER) AS "day",
               strftime(ship_date, '%A') AS weekday_name FROM measured"""
        ),
        "preview_topn": _wide(
            f"""SELECT * FROM ({_REVENUE}) ORDER BY "month", category, "type", city, state, "quarter", "year"
                LIMIT 10"""
        ),
        "distinct_triples": _catalog('SELECT DISTINCT product_name, category, "type" FROM catalog'),
        "surrogate_key": f"""WITH {_ORDER_LINES}
            SELECT row_number() OVER (ORDER BY product_id, customer_id, ship_date) AS id, * FROM
              (SELECT DISTINCT product_id, customer_id, ship_date FROM order_lines)""",
        "incremental_ids": _catalog(
            """, keys AS (SELECT product_name, category, "type", "type" = 'LARGE' AS late FROM numbered)
               SELECT row_number() OVER (ORDER BY late, product_name, category, "type") AS id,
                      product_name, category, "type" FROM keys"""
        ),
        "new_keys": _catalog("""SELECT DISTINCT product_name, category, "type" FROM catalog WHERE "type" = 'LARGE'"""),
        "join_using_keys": _catalog(
            """, copies AS (SELECT product_name, category, "type", count(*) AS copies,
                                   min(actual_price) AS lowest_price FROM catalog GROUP BY ALL)
               SELECT link, product_name, category, "type", actual_price, copies, lowest_price
               FROM catalog JOIN copies USING (product_name, category, "type")"""
        ),
        "customer_places": """SELECT DISTINCT o_custkey AS customer_id, CAST(c_nationkey AS BIGINT) AS address_id
            FROM orders JOIN customer ON o_custkey = c_custkey""",
        "union_sources": """SELECT 'customer' AS party, c_custkey AS party_id, c_name AS name, c_mktsegment AS segment
            FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""",
        "collect_set_names": """SELECT r_name, string_agg(n_name, ',' ORDER BY n_name) AS nations
            FROM (SELECT DISTINCT r_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey) GROUP BY r_name""",
        "high_water_mark": """SELECT event_id, ts, user_id, event_type, value, props FROM events
            WHERE event_id > (SELECT coalesce(max(event_id), 0) FROM events
                              WHERE ts < (SELECT date_trunc('day', max(ts)) FROM events))""",
        "catalog_clean": _catalog("SELECT * FROM catalog"),
        "quarter_bucket": """SELECT o_orderkey, CAST(month(known) AS INTEGER) AS "month",
                CAST(coalesce(quarter(known), 4) AS INTEGER) AS "quarter",
                month(known) BETWEEN 4 AND 9 AS mid_year
            FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS known FROM orders)""",
        "ship_date": f"""WITH {_ORDER_LINES}
            SELECT order_id, product_id, order_date, ship_date,
                   CAST(date_diff('day', CAST(order_date AS DATE), CAST(ship_date AS DATE)) AS INTEGER)
                     AS processing_days FROM order_lines""",
        "customer_email": f"""SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word,
                CASE WHEN p_partkey % 19 <> 0 THEN split_part(p_name, ' ', 1) || '_' ||
                  {_int('p_partkey', 'email', 100, 500)} || '@' || {_pick('p_partkey', 'domain', EMAIL_DOMAINS)} END
                  AS email FROM part""",
        "address_pack": """SELECT c_custkey,
                concat_ws(' - ', c_custkey, n_name, CASE WHEN c_custkey % 7 <> 0 THEN r_name END) AS address,
                c_custkey AS id, n_name AS city, CASE WHEN c_custkey % 7 <> 0 THEN r_name END AS state
            FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "parse_timestamp": """SELECT o_orderkey, written, TRY_CAST(written AS TIMESTAMP) AS parsed,
                strftime(TRY_CAST(written AS TIMESTAMP), '%A') AS weekday_name
            FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'not a date' WHEN o_orderkey % 11 <> 0
                    THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS written FROM orders)""",
        "keyed_pick": f"""SELECT c_custkey, {_pick('c_custkey', 'gender', GENDERS)} AS gender,
                {_pick('c_custkey', 'segment', SEGMENTS)} AS segment, drawn, n_name AS nation
            FROM (SELECT c_custkey, {_hash('c_custkey', 'nation')} % (SELECT count(*) FROM nation) AS drawn
                  FROM customer) JOIN nation ON drawn = n_nationkey""",
        "keyed_int": f"""SELECT o_orderkey, {_hash('o_orderkey', 'days')} AS hash,
                {_int('o_orderkey', 'days', 1, 7)} AS days,
                {_int('o_orderkey', 'quantity_sold', 50, 9999)} AS quantity FROM orders""",
        "keyed_weighted_pick": f"""SELECT o_orderkey, {_weighted('o_orderkey', 'status', DELIVERY_WEIGHTS)}
                AS delivery_status FROM orders""",
        "keyed_timestamp": f"SELECT o_orderkey, {_moment('o_orderkey', 'timestamp')} AS moment FROM orders",
        "stable_uuid": f"SELECT o_orderkey, {_uuid('o_orderkey')} AS timeuuid FROM orders",
        "build_inventory": _catalog(f"SELECT id, {_STOCK} FROM numbered"),
        "build_product": _catalog(
            """SELECT id, product_name, category, "type", actual_price, discount_price, ratings, no_of_ratings,
               link, image, id AS inventory_id, id AS order_id
               FROM catalog JOIN numbered USING (product_name, category, "type")"""
        ),
        "build_customer": _catalog(
            f""", names AS (SELECT row_number() OVER (ORDER BY name) AS id, name
                            FROM (SELECT DISTINCT c_name AS name FROM customer)),
               drawn AS (SELECT DISTINCT {_int(_LISTING_KEY, 'name', 1, '(SELECT count(*) FROM names)')} AS id,
                  {_pick(_LISTING_KEY, 'gender', GENDERS)} AS gender,
                  {_int(_LISTING_KEY, 'email', 100, 500)} AS number,
                  {_pick(_LISTING_KEY, 'domain', EMAIL_DOMAINS)} AS domain,
                  {_pick(_LISTING_KEY, 'segment', SEGMENTS)} AS segment FROM catalog),
               buyers AS (SELECT DISTINCT name AS customer_name, gender,
                  split_part(name, ' ', 1) || '_' || number || '@' || domain AS email, segment
                  FROM drawn JOIN names USING (id))
               SELECT row_number() OVER (ORDER BY customer_name, gender, email, segment) AS id, * FROM buyers"""
        ),
        "build_address": """SELECT row_number() OVER (ORDER BY city, state) AS id, city, state,
                'United States' AS country
            FROM (SELECT DISTINCT n_name AS city, r_name AS state FROM customer
                  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
        "build_order": _catalog(
            f"""SELECT id, {_int(_TRIPLE_KEY, 'customer', 1, '(SELECT count(*) FROM customer)')} AS customer_id,
                {_ORDER_DATE} AS order_date,
                CAST(CAST({_ORDER_DATE} AS DATE) + CAST({_int(_TRIPLE_KEY, 'days', 1, 7)} AS INTEGER) AS TIMESTAMP)
                  AS ship_date,
                {_ORDER_MOMENT} AS "timestamp", {_uuid(_TRIPLE_KEY)} AS timeuuid,
                CAST(quarter({_ORDER_MOMENT}) AS INTEGER) AS "quarter",
                {_weighted(_TRIPLE_KEY, 'status', DELIVERY_WEIGHTS)} AS delivery_status,
                {_int(_TRIPLE_KEY, 'city', 1, '(SELECT count(*) FROM nation)')} AS city_id FROM numbered"""
        ),
        # A CSV file does not tell an empty text from a missing one: both come back as NULL.
        "scan_csv_union": f"""WITH {_LISTINGS}
            SELECT * REPLACE (nullif(actual_price, '') AS actual_price) FROM listings""",
        "envelope_encode": f"""WITH {_PRODUCT}
            SELECT CAST(id AS VARCHAR) AS key, 'b1' AS batch, id, product_name, actual_price, discount_price,
                   tenths / 10.0 AS ratings, link,
                   CAST(5 + (actual_price IS NOT NULL)::INT + (discount_price IS NOT NULL)::INT
                     + 2 * (tenths IS NOT NULL)::INT + (link IS NOT NULL)::INT + (image IS NOT NULL)::INT AS INTEGER)
                     AS fields FROM product""",
        "envelope_roundtrip": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "lake_roundtrip": f"""SELECT event_id, ts, user_id, event_type, value, props,
                {RUN_DATE.year} AS load_year, {RUN_DATE.month} AS load_month, {RUN_DATE.day} AS load_day FROM events""",
        "month_scan": f"SELECT * FROM orders WHERE month(o_orderdate) = {SCAN_MONTH}",
        "upsert_latest": _LAST_PER_USER,
        "envelope_stream": _LAST_PER_USER,
    }
