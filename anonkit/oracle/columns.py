"""Oracle statements for the column functions and the anonymized tables."""

from __future__ import annotations

from anonkit.oracle.base import (
    GENERAL_POSTAL,
    MASKED_EMAIL,
    MASKED_PHONE,
    NETWORK,
    NOISED,
    SALT,
    age,
    age_range,
    day,
    draw,
    moment,
    number,
    on_anon,
    on_orders,
)

_DECADE = f"({age()} // 10 * 10)"
_SIGMA_PPM = 25000
_UNIT = "({} + 1) / 4294967296.0::DOUBLE"
_NORMAL = (
    f"sqrt(-2.0::DOUBLE * ln({_UNIT.format(draw('order_id'))}))"
    f" * cos(6.283185307179586::DOUBLE * {_UNIT.format(draw('order_id', slot=1))})"
)


def _column(name: str, value: str, source: str) -> str:
    """``order_id``, the input column and the output column for all orders."""
    return on_orders(f"SELECT order_id, {source}, {value} AS {name} FROM orders_flat")


_VALUE = f"{number('order_value_eur')} AS order_value_eur"
_BIRTH = f"{day('birth_date')} AS birth_date"

SQL = {
    "mask_email_raw": _column(
        "masked_email",
        """left(email, 2) || repeat('*', greatest(instr(email, '@') - 3, 0))
  || CASE WHEN instr(email, '@') > 0 THEN substr(email, instr(email, '@')) ELSE '' END""",
        "email",
    ),
    "mask_email": _column("masked_email", MASKED_EMAIL, "email"),
    "mask_phone_raw": _column(
        "masked_phone",
        "CASE WHEN length(phone) < 4 THEN '' ELSE repeat('*', length(phone) - 4) || right(phone, 4) END",
        "phone",
    ),
    "mask_phone": _column("masked_phone", MASKED_PHONE, "phone"),
    "hash_id": _column("hashed_id", "sha256(customer_id)", "customer_id"),
    "hash_id_salted": _column("hashed_id", f"sha256('{SALT}' || customer_id)", "customer_id"),
    "age_exact": _column("age", age(), _BIRTH),
    "age_decade_start": _column("decade_start", _DECADE, _BIRTH),
    "age_range": _column("age_range", age_range(), _BIRTH),
    "generalize_postal": _column("general_postal", GENERAL_POSTAL, "postal_code"),
    "postal_prefix": _column("postal_prefix", "left(postal_code, 2)", "postal_code"),
    "postal_prefix_1": _column("postal_prefix", "left(postal_code, 1)", "postal_code"),
    "noise_uniform": _column("noised_value", number(NOISED), _VALUE),
    "noise_gaussian": _column(
        "noised_value",
        f"""CAST((CAST(order_value_eur * 100 AS BIGINT)
  * (1000000 + CAST(round({_NORMAL} * {_SIGMA_PPM}) AS BIGINT)) + 500000) // 1000000 / 100.0 AS DOUBLE)""",
        _VALUE,
    ),
    "noise_diff_pct": on_orders(
        f"""SELECT order_id, {number("v")} AS order_value_eur, {number("n")} AS noised_value,
  CAST(round(CAST((n - v) * 100.0 / v AS DECIMAL(28,10)), 2) AS DOUBLE) AS difference_percent
FROM (SELECT order_id, order_value_eur AS v, {NOISED} AS n FROM orders_flat)"""
    ),
    "truncate_ip_prefix": _column(
        "ip_prefix", "regexp_extract(ip_address, '^([0-9]+[.][0-9]+)', 1)", "ip_address"
    ),
    "truncate_ip": _column("ip_truncated", NETWORK, "ip_address"),
    "generalize_order_month": _column(
        "order_month", "strftime(order_date, '%Y-%m-01')", f"{moment('order_date')} AS order_date"
    ),
    "suppress_columns": on_orders(
        f"""SELECT * EXCLUDE (full_name, street_address, card_last4) REPLACE ({day("birth_date")} AS birth_date,
  {moment("order_date")} AS order_date, {number("order_value_eur")} AS order_value_eur) FROM orders_flat"""
    ),
    "anonymize_orders": on_anon(
        f"""SELECT * REPLACE ({number("order_value_random")} AS order_value_random,
  {moment("order_date")} AS order_date) FROM anon"""
    ),
    "suppress_unique_prefix": on_orders(
        """SELECT order_id, postal_code, CASE WHEN left(postal_code, 2) NOT IN (
    SELECT left(postal_code, 2) FROM orders_flat WHERE postal_code IS NOT NULL
    GROUP BY 1 HAVING count(DISTINCT postal_code) = 1) THEN left(postal_code, 2) END AS postal_prefix
FROM orders_flat"""
    ),
    "suppress_small_groups": on_orders(
        f"""SELECT * FROM (
  SELECT order_id, customer_id, gender, country, {age_range()} AS age_range FROM orders_flat) AS o
WHERE NOT EXISTS (SELECT 1 FROM (
    SELECT gender, country, {age_range()} AS age_range FROM orders_flat GROUP BY ALL
    HAVING count(DISTINCT customer_id) < 5) AS s
  WHERE s.gender = o.gender AND s.country = o.country AND s.age_range IS NOT DISTINCT FROM o.age_range)"""
    ),
}
