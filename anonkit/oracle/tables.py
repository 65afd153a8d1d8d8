"""Oracle statements for sources, sinks, catalog, increments and profiles."""

from __future__ import annotations

from anonkit.oracle.base import AS_OF, SEED, VIEWS, day, draw, moment, number, on_anon, on_orders

ALL_COLUMNS = f"""* REPLACE ({day("birth_date")} AS birth_date, {moment("order_date")} AS order_date,
  {number("order_value_eur")} AS order_value_eur)"""
_ALL = on_orders(f"SELECT {ALL_COLUMNS} FROM orders_flat")
_ANON = on_anon(
    f"""SELECT * REPLACE ({number("order_value_random")} AS order_value_random, {moment("order_date")} AS order_date)
FROM anon"""
)

# Spark's names for the types of the described view.
_GEO_TYPES = {
    "country": "string",
    "city": "string",
    "region": "string",
    "product_category": "string",
    "order_value": "decimal(12,2)",
    "order_date": "timestamp_ntz",
    "device_type": "string",
    "payment_method": "string",
}
_DESCRIBE = "\nUNION ALL\n".join(
    f"""SELECT {i}::BIGINT AS position, '{name}' AS col_name, '{kind}' AS data_type,
  if(count(*) > count({name}), 'YES', 'NO') AS has_nulls FROM geo"""
    for i, (name, kind) in enumerate(_GEO_TYPES.items())
)


def _gen(part: str, slot: int) -> str:
    return draw("o::VARCHAR", f"{SEED}/{part}/", slot)


_PICK = "(['{}'])[{} % {} + 1]"
_CATEGORIES = "Apparel','Home & Living','Electronics','Beauty','Sports','Books','Toys','Accessories"
_PAYMENTS = "Visa','Mastercard','PayPal','Apple Pay','Klarna"
_GENERATED = f"""WITH placed AS (
  SELECT c_custkey AS k, c_nationkey AS n, unnest(range(1, 1 + CAST(floor(
    -ln(({draw("c_custkey::VARCHAR", SEED)} + 1) / 4294967296.0::DOUBLE) * (10.0::DOUBLE / 3)) AS BIGINT))) AS seq
  FROM customer),
b AS (
  SELECT k, k * 1000 + seq AS o,
    (['Ana','Liam','Greta','Louis','Carmen','Daan','Niamh','Oscar'])[k % 8 + 1] AS first_name,
    (['Keller','Murphy','Garcia','Dupont','Visser','Smith','Weber'])[k % 7 + 1] AS last_name,
    (['United Kingdom','Ireland','Germany','France','Spain','Netherlands'])[n % 6 + 1] AS country,
    CASE WHEN k % 10 < 5 THEN 'New' WHEN k % 10 < 9 THEN 'Regular' ELSE 'VIP' END AS customer_segment
  FROM placed)
SELECT printf('ORD-%07d', o) AS order_id, printf('CUST-%06d', k) AS customer_id,
  first_name || ' ' || last_name AS full_name,
  CASE k % 25 WHEN 0 THEN 'a@x.example' WHEN 1 THEN 'no-at-sign' WHEN 2 THEN NULL
    ELSE lower(first_name) || '.' || lower(last_name) || k::VARCHAR || '@mail.example' END AS email,
  CASE WHEN k % 40 = 7 THEN '123' WHEN k % 40 = 9 THEN NULL
    WHEN k % 3 = 0 THEN '+34 9' || printf('%08d', (k * 7919) % 100000000)
    WHEN k % 3 = 1 THEN '(0174)-' || printf('%06d', (k * 7919) % 1000000)
    ELSE '255.901.' || printf('%04d', k % 10000) END AS phone,
  CASE WHEN k % 60 <> 11 THEN strftime(DATE '1951-01-01' + ((k * 7919) % 20820)::INTEGER, '%Y-%m-%d') END AS birth_date,
  (['M','F','Other'])[k % 3 + 1] AS gender, country, country || ' City ' || (k % 7)::VARCHAR AS city,
  CASE WHEN k % 70 = 13 THEN NULL
    WHEN country = 'United Kingdom' THEN 'SW' || (k % 20)::VARCHAR || 'A 1AA'
    WHEN country = 'Ireland' THEN 'N' || printf('%02d', k % 90) || ' 7NYE'
    WHEN country = 'Netherlands' THEN printf('%04d', (1000 + k * 37) % 10000) || 'LD'
    ELSE printf('%05d', (1000 + k * 311) % 100000) END AS postal_code,
  (1 + k % 200)::VARCHAR || ' Main Street' AS street_address,
  ({_gen("when", 2)} % 9000 + 1000)::VARCHAR AS card_last4,
  {_PICK.format(_PAYMENTS, _gen("what", 1), 5)} AS payment_method,
  strftime({AS_OF}::TIMESTAMP - to_hours(CAST({_gen("when", 0)} % 730 * 24 + 24 + {_gen("when", 1)} % 24 AS INTEGER)),
    '%Y-%m-%d %H:%M:%S') AS order_date,
  {_PICK.format(_CATEGORIES, _gen("what", 2), 8)} AS product_category,
  CAST(CASE customer_segment WHEN 'VIP' THEN 8000 + {_gen("what", 0)} % 42001
    WHEN 'Regular' THEN 2500 + {_gen("what", 0)} % 17501 ELSE 1000 + {_gen("what", 0)} % 7001 END / 100.0 AS DOUBLE)
    AS order_value_eur,
  CASE WHEN {_gen("what", 3)} % 10 < 6 THEN 'mobile' WHEN {_gen("what", 3)} % 10 < 9 THEN 'desktop' ELSE 'tablet' END
    AS device_type,
  concat_ws('.', 11 + {_gen("where", 0)} % 89, {_gen("where", 1)} % 256, {_gen("where", 2)} % 256,
    1 + {_gen("where", 3)} % 254) AS ip_address,
  customer_segment, '' AS customer_notes
FROM b"""

_PROFILE = """SELECT 'rows' AS metric, '' AS item, count(*) AS value FROM orders_flat
UNION ALL SELECT 'columns', '', 20
UNION ALL SELECT 'customers', '', count(DISTINCT customer_id) FROM orders_flat
UNION ALL SELECT * FROM (SELECT 'top customer', customer_id, count(*) AS n FROM orders_flat GROUP BY ALL
  ORDER BY n DESC, customer_id LIMIT 5)
UNION ALL SELECT 'country', country, count(*) FROM orders_flat GROUP BY country"""

SQL = {
    "src_csv_multiline": _ALL,
    "src_csv_split": _ALL,
    "src_table": _ALL,
    "sink_full_refresh": _ALL,
    "sink_refresh_table": _ALL,
    "src_null_normalize": on_orders(
        """SELECT order_id, email, phone, postal_code, nullif(customer_notes, '') AS customer_notes FROM orders_flat"""
    ),
    "src_fillna_notes": on_orders("SELECT order_id, coalesce(customer_notes, '') AS customer_notes FROM orders_flat"),
    "sink_reconcile": on_orders(
        """SELECT count(*) AS expected_rows, count(*) AS loaded_rows, 0::BIGINT AS difference FROM orders_flat"""
    ),
    "sink_csv": on_orders("SELECT order_id, full_name, customer_notes FROM orders_flat"),
    "sink_ctas": _ANON,
    "cat_use_db": on_anon("SELECT customer_segment, count(*) AS orders FROM anon GROUP BY ALL"),
    "cat_add_column": on_anon("SELECT order_id, CAST(NULL AS VARCHAR) AS customer_notes_anonymized FROM anon"),
    "cat_describe": on_anon(_DESCRIBE, VIEWS["geo"]),
    "inc_pending": on_orders(
        f"""SELECT order_id, customer_notes FROM orders_flat
WHERE customer_notes <> '' AND {draw("order_id", SEED)} % 1000000 >= 500000"""
    ),
    "inc_pick": on_orders(
        f"""SELECT order_id, customer_id FROM orders_flat
WHERE coalesce(customer_notes, '') = '' AND {draw("order_id", SEED)} % 1000000 < 60000"""
    ),
    "preview_sample": on_orders(
        f"""SELECT order_id, full_name, country, customer_notes FROM orders_flat WHERE customer_notes <> ''
ORDER BY md5('{SEED}' || order_id), order_id LIMIT 3"""
    ),
    "profile_dataset": on_orders(_PROFILE),
    "profile_notes_fill": on_orders(
        "SELECT count(*) FILTER (customer_notes <> '') AS notes_filled, count(*) AS total_rows FROM orders_flat"
    ),
    "gen_orders": _GENERATED,
}
