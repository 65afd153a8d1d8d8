"""Common table expressions and snippets the oracle statements are put together from."""

from __future__ import annotations

# The parameters the registered queries run with.
AS_OF = "DATE '2026-01-01'"
SALT = "salt"
SEED = "seed"

ORDERS = """orders_flat AS (
WITH b AS (
  SELECT o_orderkey AS o, c_custkey AS k, o_orderdate, o_totalprice, o_orderpriority,
    (['Ana','Liam','Greta','Louis','Carmen','Daan','Niamh','Oscar'])[k % 8 + 1] AS first_name,
    (['Keller','Murphy','Garcia','Dupont','Visser','Smith','Weber'])[k % 7 + 1] AS last_name,
    (['United Kingdom','Ireland','Germany','France','Spain','Netherlands'])[c_nationkey % 6 + 1] AS country
  FROM orders JOIN customer ON o_custkey = c_custkey),
f AS (
  SELECT printf('ORD-%07d', o) AS order_id, printf('CUST-%06d', k) AS customer_id,
    first_name || ' ' || last_name AS full_name,
    CASE k % 25 WHEN 0 THEN 'a@x.example' WHEN 1 THEN 'no-at-sign' WHEN 2 THEN NULL
      ELSE lower(first_name) || '.' || lower(last_name) || k::VARCHAR || '@mail.example' END AS email,
    CASE WHEN k % 40 = 7 THEN '123' WHEN k % 40 = 9 THEN NULL
      WHEN k % 3 = 0 THEN '+34 9' || printf('%08d', (k * 7919) % 100000000)
      WHEN k % 3 = 1 THEN '(0174)-' || printf('%06d', (k * 7919) % 1000000)
      ELSE '255.901.' || printf('%04d', k % 10000) END AS phone,
    CASE WHEN k % 60 <> 11 THEN DATE '1951-01-01' + ((k * 7919) % 20820)::INTEGER END AS birth_date,
    (['M','F','Other'])[k % 3 + 1] AS gender, country, country || ' City ' || (k % 7)::VARCHAR AS city,
    CASE WHEN k % 70 = 13 THEN NULL
      WHEN country = 'United Kingdom' THEN 'SW' || (k % 20)::VARCHAR || 'A 1AA'
      WHEN country = 'Ireland' THEN 'N' || printf('%02d', k % 90) || ' 7NYE'
      WHEN country = 'Netherlands' THEN printf('%04d', (1000 + k * 37) % 10000) || 'LD'
      ELSE printf('%05d', (1000 + k * 311) % 100000) END AS postal_code,
    (1 + k % 200)::VARCHAR || ' Main Street' AS street_address,
    (1000 + (o * 31) % 9000)::VARCHAR AS card_last4,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Visa' WHEN '2-HIGH' THEN 'Mastercard' WHEN '3-MEDIUM' THEN 'PayPal'
      WHEN '4-NOT SPECIFIED' THEN 'Apple Pay' ELSE 'Klarna' END AS payment_method,
    o_orderdate + to_hours((o % 24)::INTEGER) AS order_date,
    (['Apparel','Home & Living','Electronics','Beauty','Sports','Books','Toys','Accessories'])[(o * 7919 + k) % 8 + 1]
      AS product_category,
    CAST((CAST(round(o_totalprice * 100) AS BIGINT) % 49000 + 1000) / 100.0 AS DECIMAL(10,2)) AS order_value_eur,
    CASE WHEN o % 10 < 6 THEN 'mobile' WHEN o % 10 < 9 THEN 'desktop' ELSE 'tablet' END AS device_type,
    concat_ws('.', 1 + o % 223, (o * 13) % 256, (o * 29) % 256, 1 + o % 254) AS ip_address,
    CASE WHEN k % 10 < 5 THEN 'New' WHEN k % 10 < 9 THEN 'Regular' ELSE 'VIP' END AS customer_segment, o, k,
    (['Ana','Liam','Greta','Louis','Carmen','Daan','Niamh','Oscar'])[(k + 1) % 8 + 1] AS next_first,
    (['Keller','Murphy','Garcia','Dupont','Visser','Smith','Weber'])[(k + 1) % 7 + 1] AS next_last
  FROM b)
SELECT * EXCLUDE (o, k, next_first, next_last),
  CASE o % 16
    WHEN 0 THEN 'Customer ' || full_name || ' called from ' || coalesce(phone, 'an unknown number') || ' about '
      || order_id || '.' || chr(10) || 'Reply to ' || coalesce(email, 'no address') || '; ship to '
      || street_address || '.'
    WHEN 2 THEN 'Hello, my name is ' || full_name || ', born ' || coalesce(birth_date::VARCHAR, 'unknown') || '. Customer '
      || customer_id || ', order ' || order_id || ' placed on ' || strftime(order_date, '%Y-%m-%d') || '.'
    WHEN 6 THEN 'Passport number ' || printf('%09d', (o * 7919) % 1000000000) || ' checked, card 4465 7583 8288 ' || card_last4
      || ', login from ' || ip_address || ', build 10.2.3.'
    WHEN 10 THEN 'Deliver to Calle de Mayor ' || (1 + o % 90)::VARCHAR || ' or Hauptstraße ' || (1 + o % 300)::VARCHAR
      || ', not to 12 Pieces.'
    WHEN 12 THEN 'Order ' || order_id || ' shipped 2024-04-28, delivered 2024-05-01, version 3.10.2; invoice 1234567, 3 boxes.'
    WHEN 14 THEN 'Date of birth of the customer, as in the passport shown: ' || coalesce(birth_date::VARCHAR, 'unknown')
      || '. 3 February 1980 is the date of birth of the partner. Delivered 2024-05-01, birthday gift; order of 2020-01-01 was for'
      || ' the birth of a child.'
    WHEN 13 THEN 'Parcel taken by the neighbour ' || next_first || ' ' || next_last || ', ' || lower(next_first) || '.'
      || lower(next_last) || (k + 1)::VARCHAR || '@mail.example; signed ' || next_first || ' ' || left(next_last, 2)
      || substr(next_last, 4) || '.'
    WHEN 8 THEN 'The product quality was excellent, will buy again!'
    WHEN 4 THEN '' END AS customer_notes
FROM f)"""


def draw(key: str, salt: str = SALT, slot: int = 0) -> str:
    return f"('0x' || substr(md5('{salt}' || {key}), {1 + 8 * slot}, 8))::BIGINT"


def age(birth: str = "birth_date") -> str:
    """Completed years at AS_OF, counted in whole calendar terms."""
    return (
        f"(year({AS_OF}) - year({birth}) - CASE WHEN (month({AS_OF}), day({AS_OF})) < (month({birth}), day({birth}))"
        " THEN 1 ELSE 0 END)"
    )


def age_range(birth: str = "birth_date") -> str:
    decade = f"({age(birth)} // 10 * 10)"
    return f"({decade}::VARCHAR || '-' || ({decade} + 9)::VARCHAR)"


MASKED_EMAIL = """CASE WHEN email NOT LIKE '%@%' THEN '***'
  WHEN instr(email, '@') <= 3 THEN '***' || substr(email, instr(email, '@'))
  ELSE left(email, 2) || repeat('*', instr(email, '@') - 3) || substr(email, instr(email, '@')) END"""
MASKED_PHONE = "repeat('*', CASE WHEN length(phone) <= 4 THEN length(phone) ELSE length(phone) - 4 END)" + (
    " || CASE WHEN length(phone) <= 4 THEN '' ELSE right(phone, 4) END"
)
GENERAL_POSTAL = "left(postal_code, 2) || repeat('*', greatest(length(postal_code) - 2, 0))"
NETWORK = "regexp_extract(ip_address, '^([0-9]{1,3}[.][0-9]{1,3})[.][0-9]{1,3}[.][0-9]{1,3}$', 1) || '.0.0'"
NOISED = f"""CAST((CAST(order_value_eur * 100 AS BIGINT) * (950000 + {draw("order_id")} % 100001) + 500000) // 1000000
  / 100.0 AS DECIMAL(12,2))"""

ANON = f"""anon AS (
  SELECT order_id, sha256(customer_id) AS customer_id_hashed, {MASKED_EMAIL} AS email_masked,
    {MASKED_PHONE} AS phone_masked, {age_range()} AS age_range, {GENERAL_POSTAL} AS postal_code_general,
    {NETWORK} AS ip_truncated, {NOISED} AS order_value_random, gender, country, city, payment_method, order_date,
    product_category, device_type, customer_segment, customer_notes
  FROM orders_flat)"""


def mean(x: str, scale: int = 2) -> str:
    return f"CAST(round(CAST(avg({x}) AS DECIMAL(28,10)), {scale}) AS DOUBLE)"


def number(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def percent(part: str, whole: str) -> str:
    return f"CAST(round(CAST(({part}) * 100.0 / nullif({whole}, 0) AS DECIMAL(28,10)), 2) AS DOUBLE)"


def percent_raw(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) * 100 / nullif(CAST({whole} AS DOUBLE), 0)"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def moment(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


VIEWS = {
    "geo": """geo AS (
  SELECT country, city, postal_code_general AS region, product_category, order_value_random AS order_value,
    order_date, device_type, payment_method FROM anon)""",
    "behavior": """behavior AS (
  SELECT customer_id_hashed AS customer_hash, customer_segment, count(*) AS total_orders,
    round(CAST(avg(order_value_random) AS DECIMAL(28,10)), 2) AS avg_order_value,
    sum(order_value_random) AS total_spent, min(order_date) AS first_order, max(order_date) AS last_order,
    date_diff('day', min(order_date)::DATE, max(order_date)::DATE) AS customer_lifespan_days
  FROM anon GROUP BY ALL)""",
    "demographic": """demographic AS (
  SELECT gender, country, age_range, product_category, count(*) AS n_orders,
    round(CAST(avg(order_value_random) AS DECIMAL(28,10)), 2) AS avg_order_value,
    sum(order_value_random) AS total_revenue
  FROM anon GROUP BY ALL)""",
    "product": """product AS (
  SELECT product_category, device_type, payment_method, count(*) AS n_orders,
    round(CAST(avg(order_value_random) AS DECIMAL(28,10)), 2) AS avg_order_value,
    min(order_value_random) AS min_order_value, max(order_value_random) AS max_order_value,
    sum(order_value_random) AS total_revenue
  FROM anon GROUP BY ALL)""",
}


def on_orders(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([ORDERS, *ctes]) + "\n" + body


def on_anon(body: str, *ctes: str) -> str:
    return on_orders(body, ANON, *ctes)


def on_view(view: str, body: str, *ctes: str) -> str:
    return on_anon(body, VIEWS[view], *ctes)
