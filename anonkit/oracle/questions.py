"""Oracle statements for the views, the questions asked of them, and the audits."""

from __future__ import annotations

from itertools import product

from anonkit.oracle.base import (
    AS_OF,
    GENERAL_POSTAL,
    MASKED_PHONE,
    NETWORK,
    NOISED,
    VIEWS,
    age,
    age_range,
    day,
    mean,
    moment,
    number,
    on_anon,
    on_orders,
    on_view,
    percent,
    percent_raw,
)

_VIEWS = {
    "view_geo_analysis": on_view(
        "geo",
        f"""SELECT country, city, region, product_category, {number("order_value")} AS order_value,
  {moment("order_date")} AS order_date, device_type, payment_method FROM geo""",
    ),
    "view_customer_behavior": on_view(
        "behavior",
        f"""SELECT customer_hash, customer_segment, total_orders, {number("avg_order_value")} AS avg_order_value,
  {number("total_spent")} AS total_spent, {moment("first_order")} AS first_order, {moment("last_order")} AS last_order,
  customer_lifespan_days FROM behavior""",
    ),
    "view_demographic_analysis": on_view(
        "demographic",
        f"""SELECT gender, country, age_range, product_category, n_orders, {number("avg_order_value")} AS avg_order_value,
  {number("total_revenue")} AS total_revenue FROM demographic""",
    ),
    "view_product_performance": on_view(
        "product",
        f"""SELECT product_category, device_type, payment_method, n_orders,
  {number("avg_order_value")} AS avg_order_value, {number("min_order_value")} AS min_order_value,
  {number("max_order_value")} AS max_order_value, {number("total_revenue")} AS total_revenue FROM product""",
    ),
}

_BEHAVIOR = {
    "cb01_customers": "SELECT count(DISTINCT customer_hash) AS customers FROM behavior",
    "cb02_per_segment": """SELECT customer_segment, count(*) AS customers FROM behavior
WHERE customer_segment = 'New' OR customer_segment = 'Regular' GROUP BY ALL""",
    "cb03_avg_spend": f"SELECT {mean('total_spent', 3)} AS avg_total_spent FROM behavior",
    "cb04_top5": f"""SELECT customer_hash, {number("sum(total_spent)")} AS total_spent FROM behavior
GROUP BY customer_hash ORDER BY sum(total_spent) DESC, customer_hash LIMIT 5""",
    "cb05_gt10_orders": "SELECT count(*) FILTER (total_orders > 10) AS customers FROM behavior",
    "cb06_order_histogram": """SELECT total_orders, count(*) AS customers FROM behavior
GROUP BY total_orders HAVING total_orders > 10 ORDER BY total_orders DESC""",
    "cb07_avg_by_segment": f"""SELECT customer_segment, {mean("avg_order_value")} AS avg_order_value FROM behavior
GROUP BY ALL""",
    "cb08a_segment_share": f"""SELECT customer_segment,
  {percent_raw("count(*)", "(SELECT count(*) FROM behavior)")} AS percent_customers FROM behavior GROUP BY ALL""",
    "cb08b_regular_share": f"""SELECT {percent_raw("count(*) FILTER (customer_segment = 'Regular')", "count(*)")}
  AS percent_regular FROM behavior""",
    "cb09_active_365": f"""SELECT count(*) FILTER (customer_lifespan_days > 365) AS active_customers,
  {percent_raw("count(*) FILTER (customer_lifespan_days > 365)", "count(*)")} AS percent_active FROM behavior""",
    "cb10_best_per_segment": f"""SELECT customer_segment, customer_hash, {number("total_spent")} AS total_spent
FROM behavior QUALIFY row_number() OVER (PARTITION BY customer_segment ORDER BY total_spent DESC, customer_hash) = 1""",
    "cb11_recency_top10": f"""SELECT customer_hash, date_diff('day', last_order::DATE, {AS_OF}) AS days_inactive
FROM behavior ORDER BY days_inactive DESC, customer_hash LIMIT 10""",
}

_DEMOGRAPHIC = {
    "dm01_rows_per_country": "SELECT country, count(*) AS view_rows FROM demographic GROUP BY ALL",
    "dm02_categories": "SELECT product_category, count(*) AS view_rows FROM demographic GROUP BY ALL",
    "dm03_revenue_country": f"SELECT country, {number('sum(total_revenue)')} AS revenue FROM demographic GROUP BY ALL",
    "dm04_revenue_gender": f"SELECT gender, {number('sum(total_revenue)')} AS revenue FROM demographic GROUP BY ALL",
    "dm05_spain_orders": """SELECT 'Spain' AS country, sum(n_orders)::BIGINT AS orders FROM demographic
WHERE country = 'Spain' HAVING count(*) > 0""",
    "dm06_top_category_country": f"""SELECT country, product_category, {number("revenue")} AS revenue FROM
  (SELECT country, product_category, sum(total_revenue) AS revenue FROM demographic GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY country ORDER BY revenue DESC, product_category) = 1""",
    "dm07_category_share": f"""SELECT product_category,
  {percent("sum(total_revenue)", "(SELECT sum(total_revenue) FROM demographic)")} AS percent_revenue
FROM demographic GROUP BY ALL""",
    "dm08_top_age_range": """SELECT age_range, sum(n_orders)::BIGINT AS orders FROM demographic GROUP BY ALL
ORDER BY orders DESC, age_range NULLS LAST LIMIT 1""",
    "dm09_top_gender_country": f"""SELECT country, gender, {number("revenue")} AS revenue FROM
  (SELECT country, gender, sum(total_revenue) AS revenue FROM demographic GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY country ORDER BY revenue DESC, gender) = 1""",
    "dm10_rank_lag": f"""SELECT rank() OVER (ORDER BY revenue) AS ranking, country, {number("revenue")} AS revenue,
  {number("lag(revenue) OVER w")} AS previous_revenue, {number("revenue - lag(revenue) OVER w")} AS difference
FROM (SELECT country, sum(total_revenue) AS revenue FROM demographic GROUP BY ALL)
WINDOW w AS (ORDER BY revenue, country)""",
}

_GEO = {
    "ge01_payment_counts": "SELECT payment_method, count(*) AS orders FROM geo GROUP BY ALL",
    "ge02_avg_device": f"SELECT device_type, {mean('order_value')} AS avg_order_value FROM geo GROUP BY ALL",
    "ge03_spain": "SELECT country, count(*) AS orders FROM geo WHERE country = 'Spain' GROUP BY ALL",
    "ge04_top5_countries": """SELECT rank() OVER (ORDER BY orders DESC) AS ranking, country, orders FROM
  (SELECT country, count(*) AS orders FROM geo GROUP BY ALL) ORDER BY orders DESC, country LIMIT 5""",
    "ge05_uk_mobile": """SELECT country, device_type, count(*) AS orders FROM geo GROUP BY ALL
HAVING country = 'United Kingdom' AND device_type = 'mobile'""",
    "ge06_top3_payment_country": f"""SELECT payment_method, country, {number("sum(order_value)")} AS revenue FROM geo
GROUP BY payment_method, country ORDER BY sum(order_value) DESC, payment_method, country LIMIT 3""",
    "ge07_monthly_revenue": f"""SELECT strftime(order_date, '%Y-%m') AS month, {number("sum(order_value)")} AS revenue
FROM geo GROUP BY ALL ORDER BY month""",
    "ge08_device_share": f"""SELECT device_type, count(*) AS orders, (SELECT count(*) FROM geo) AS all_orders,
  {percent("count(*)", "(SELECT count(*) FROM geo)")} AS percent_orders FROM geo GROUP BY device_type""",
    "ge09_growth_first_last": f"""SELECT a.country, {number("a.revenue")} AS first_month_revenue,
  {number("z.revenue")} AS last_month_revenue, {percent("z.revenue - a.revenue", "a.revenue")} AS growth_percent
FROM monthly a JOIN monthly z USING (country)
WHERE a.month = (SELECT min(month) FROM monthly m WHERE m.country = a.country)
  AND z.month = (SELECT max(month) FROM monthly m WHERE m.country = a.country)""",
    "ge10_city_above_avg": f"""SELECT country, city, {number("city_revenue")} AS city_revenue,
  CAST(round(avg(city_revenue) OVER w, 6) AS DOUBLE) AS country_average
FROM (SELECT country, city, sum(order_value) AS city_revenue FROM geo GROUP BY ALL)
WINDOW w AS (PARTITION BY country) QUALIFY city_revenue > avg(city_revenue) OVER w""",
}
_GEO["ge09_growth_joined"] = _GEO["ge09_growth_first_last"]
_MONTHLY = """monthly AS (SELECT country, strftime(order_date, '%Y-%m') AS month, sum(order_value) AS revenue
  FROM geo GROUP BY ALL)"""

_PRODUCT = {
    "pp01_revenue_category": f"SELECT product_category, {number('sum(total_revenue)')} AS revenue FROM product GROUP BY ALL",
    "pp02_orders_device": "SELECT device_type, sum(n_orders)::BIGINT AS orders FROM product GROUP BY ALL",
    "pp03_minmax_avg": f"""SELECT {number("max(avg_order_value)")} AS highest_avg,
  {number("min(avg_order_value)")} AS lowest_avg FROM product""",
    "pp04_min_gt_30": f"""SELECT product_category, device_type, payment_method, n_orders,
  {number("avg_order_value")} AS avg_order_value, {number("min_order_value")} AS min_order_value,
  {number("max_order_value")} AS max_order_value, {number("total_revenue")} AS total_revenue
FROM product WHERE min_order_value > 30""",
    "pp05_top_payment": f"""SELECT payment_method, {mean("avg_order_value")} AS mean_avg_order_value FROM product
GROUP BY payment_method ORDER BY avg(avg_order_value) DESC, payment_method LIMIT 1""",
    "pp06_combo_share": f"""SELECT product_category, device_type, {number("sum(total_revenue)")} AS revenue,
  {percent("sum(total_revenue)", "(SELECT sum(total_revenue) FROM product)")} AS percent_revenue
FROM product GROUP BY product_category, device_type""",
    "pp07_value_range": f"""SELECT product_category, {number("max(max_order_value)")} AS highest,
  {number("min(min_order_value)")} AS lowest, {number("max(max_order_value) - min(min_order_value)")} AS value_range
FROM product GROUP BY product_category""",
    "pp08_klarna_vs_rest": f"""SELECT if(payment_method = 'Klarna', 'Klarna', 'Resto') AS payment_group,
  {number("sum(total_revenue)")} AS revenue, (SELECT {number("sum(total_revenue)")} FROM product) AS all_revenue,
  {percent("sum(total_revenue)", "(SELECT sum(total_revenue) FROM product)")} AS percent_revenue
FROM product GROUP BY payment_group""",
    "pp09_dense_rank": f"""SELECT device_type, product_category, {number("revenue")} AS revenue,
  dense_rank() OVER (PARTITION BY device_type ORDER BY revenue DESC) AS ranking
FROM (SELECT device_type, product_category, sum(total_revenue) AS revenue FROM product GROUP BY ALL)""",
    "pp10_running_total": f"""SELECT product_category, device_type, payment_method, n_orders,
  {number("total_revenue")} AS total_revenue, {number("sum(total_revenue) OVER w")} AS running_total FROM product
WINDOW w AS (PARTITION BY product_category ORDER BY n_orders DESC, device_type, payment_method
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
}

_AUDITS = {
    "mask_phone_by_country": f"""SELECT phone, country, {MASKED_PHONE} AS masked_phone FROM orders_flat
WHERE phone IS NOT NULL GROUP BY ALL""",
    "audit_phone_short": """SELECT order_id, phone, length(phone) AS phone_length FROM orders_flat
WHERE length(phone) < 4""",
    "audit_phone_leak": f"""SELECT
  count(*) FILTER (length(replace(CASE WHEN length(phone) < 4 THEN '' ELSE repeat('*', length(phone) - 4)
    || right(phone, 4) END, '*', '')) > 4) AS leaky_rows,
  count(*) FILTER (length(replace({MASKED_PHONE}, '*', '')) > 4) AS leaky_rows_guarded FROM orders_flat""",
    "audit_hash_determinism": """SELECT customer_id, count(*) AS orders, sha256(customer_id) AS hashed_id,
  count(DISTINCT sha256(customer_id)) AS hashes FROM orders_flat GROUP BY customer_id HAVING count(*) > 1 ORDER BY orders DESC, customer_id LIMIT 15""",
    "audit_hash_unique": """SELECT count(DISTINCT customer_id) - count(DISTINCT sha256(customer_id)) AS collisions
FROM orders_flat""",
    "audit_hash_length": """SELECT order_id, customer_id, sha256(customer_id) AS hashed_id,
  length(sha256(customer_id)) AS hash_length FROM orders_flat""",
    "audit_hash_avalanche": """SELECT input_01, sha256(input_01) AS hash_01, input_02, sha256(input_02) AS hash_02,
  len(list_filter(range(1, 65), lambda i: sha256(input_01)[i] <> sha256(input_02)[i])) AS changed_characters
FROM (SELECT DISTINCT customer_id AS input_01, printf('CUST-%06d', substr(customer_id, 6)::BIGINT + 1) AS input_02
  FROM orders_flat)""",
    "hash_group_spend": f"""SELECT sha256(customer_id) AS hashed_id, count(*) AS total_orders,
  {number("sum(order_value_eur)")} AS total_spend, {number("min(order_value_eur)")} AS min_value,
  {number("max(order_value_eur)")} AS max_value FROM orders_flat GROUP BY hashed_id HAVING count(*) > 3""",
    "age_distribution": f"""SELECT {age_range()} AS age_range, count(*) AS orders,
  {mean("order_value_eur")} AS avg_order_value FROM orders_flat WHERE birth_date IS NOT NULL GROUP BY ALL""",
    "audit_age_gain": f"""SELECT count(DISTINCT birth_date) AS unique_dates,
  count(DISTINCT {age_range()}) AS unique_ranges FROM orders_flat""",
    "audit_age_rare": f"""SELECT {age_range()} AS age_range, count(*) AS orders,
  {mean("order_value_eur")} AS avg_order_value FROM orders_flat WHERE birth_date IS NOT NULL GROUP BY 1
HAVING count(*) < 10""",
    "audit_age_loss": f"""SELECT {age_range()} AS age_range, count(DISTINCT birth_date) AS unique_dates,
  {day("max(birth_date)")} AS last_date, {day("min(birth_date)")} AS first_date FROM orders_flat
WHERE birth_date IS NOT NULL GROUP BY 1""",
    "postal_distribution": f"""SELECT country, left(postal_code, 2) AS region_prefix, count(*) AS orders,
  {mean("order_value_eur")} AS avg_order_value FROM orders_flat WHERE postal_code IS NOT NULL GROUP BY 1, 2
ORDER BY country, orders DESC, region_prefix LIMIT 20""",
    "audit_postal_gain": """SELECT count(DISTINCT postal_code) AS unique_codes,
  count(DISTINCT left(postal_code, 2)) AS unique_prefixes FROM orders_flat""",
    "audit_postal_rare": """SELECT country, left(postal_code, 2) AS region_prefix, count(customer_id) AS orders,
  count(DISTINCT customer_id) AS people FROM orders_flat GROUP BY 1, 2 HAVING count(customer_id) < 10""",
    "audit_postal_loss": """SELECT left(postal_code, 2) AS region_prefix, count(DISTINCT postal_code) AS unique_codes,
  max(postal_code) AS example_max, min(postal_code) AS example_min FROM orders_flat GROUP BY 1
ORDER BY unique_codes, region_prefix NULLS FIRST LIMIT 15""",
    "noise_utility_total": "\nUNION ALL\n".join(
        f"""SELECT '{series}' AS series, count(v) AS orders, {mean("v")} AS avg_value, {number("max(v)")} AS max_value,
  {number("min(v)")} AS min_value, {number("sum(v)")} AS total_value, median(CAST(v AS DOUBLE)) AS median_value
FROM (SELECT {value} AS v FROM orders_flat)"""
        for series, value in (("original", "order_value_eur"), ("noised", NOISED))
    ),
    **{
        key: f"""SELECT order_id, {number("order_value_eur")} AS order_value_eur, 1::BIGINT AS noised, 1::BIGINT AS within_bound
FROM orders_flat"""
        for key in ("noise_uniform_rand", "noise_gaussian_randn")
    },
    "noise_uniform_rand_bands": """SELECT count(*) AS orders, 1::BIGINT AS within_half, 1::BIGINT AS within_all,
  1::BIGINT AS centered FROM orders_flat""",
    "noise_gaussian_randn_bands": """SELECT count(*) AS orders, 1::BIGINT AS within_1, 1::BIGINT AS within_2,
  1::BIGINT AS within_3, 1::BIGINT AS centered FROM orders_flat""",
    "noise_utility_country": f"""SELECT country, {mean("v")} AS avg_value, {mean("n")} AS avg_noised_value,
  {percent("abs(sum(n) - sum(v))", "sum(v)")} AS deviation_percent
FROM (SELECT country, order_value_eur AS v, {NOISED} AS n FROM orders_flat) GROUP BY country""",
    "audit_ip_gain": f"""SELECT count(ip_address) AS rows_with_ip, count({NETWORK}) AS rows_with_network,
  count(DISTINCT ip_address) AS unique_ips, count(DISTINCT {NETWORK}) AS unique_networks FROM orders_flat""",
    "ip_distribution": f"SELECT {NETWORK} AS network, count(*) AS orders FROM orders_flat GROUP BY 1",
}

_QI = f"""qi AS (SELECT customer_id, gender, country, city, {age_range()} AS age_range,
  left(postal_code, 2) AS postal_prefix, {GENERAL_POSTAL} AS region, product_category, device_type, payment_method,
  order_date, {NOISED} AS order_value, customer_segment,
  count(*) OVER (PARTITION BY customer_id, customer_segment) AS total_orders FROM orders_flat)"""
_QI_SETS = {
    "kanon_2qi": "country, gender",
    "kanon_3qi": "country, gender, age_range",
    "kanon_4qi": "country, gender, age_range, postal_prefix",
}


def _counted(level: str, qis: str) -> str:
    return f"""SELECT '{level}' AS level, '{qis}' AS quasi_identifiers, count(*) AS groups,
  count(*) FILTER (people < 5) AS violating_groups
FROM (SELECT {qis}, count(DISTINCT customer_id) AS people FROM qi GROUP BY {qis})"""


_KANON = {
    key: f"SELECT {qis}, count(DISTINCT customer_id) AS people FROM qi GROUP BY {qis} HAVING people < 5"
    for key, qis in _QI_SETS.items()
}
_KANON["kanon_summary"] = "\nUNION ALL\n".join(
    [
        _counted("2 quasi-identifiers", "gender, country"),
        _counted("3 quasi-identifiers", "gender, country, age_range"),
        _counted("4 quasi-identifiers", "gender, country, age_range, postal_prefix"),
    ]
)
_KANON["kanon_view"] = "\nUNION ALL\n".join(
    [
        _counted("view_geo_analysis", "country, region"),
        _counted("view_geo_analysis with city", "country, city, region"),
        _counted("view_demographic_analysis", "gender, country, age_range"),
        _counted("view_product_performance", "product_category, device_type, payment_method"),
        _counted("view_geo_analysis by order", "country, city, region, order_date, order_value"),
        _counted("view_customer_behavior", "customer_segment, total_orders"),
    ]
)

# Every choice of levels counted by itself; of those that pass, the ones that no other passing choice is finer than.
_LEVELS = {
    "gender": ["gender"],
    "country": ["country"],
    "age": [f"({age()} // 20 * 20)", f"({age()} // 10 * 10)"],
    "postal": ["left(postal_code, 1)", "left(postal_code, 2)"],
}


def _every_choice() -> str:
    parts = []
    for choice in product(*[range(len(steps) + 1) for steps in _LEVELS.values()]):
        used = [_LEVELS[c][n - 1] for c, n in zip(_LEVELS, choice) if n]
        shown = ", ".join(f"{n}::BIGINT AS {c}" for c, n in zip(_LEVELS, choice))
        grouping = f"GROUP BY {', '.join(used)}" if used else ""
        parts.append(
            f"""SELECT {shown}, {sum(choice)}::BIGINT AS levels, count(*) AS groups, count(*) FILTER (people < 5) AS small_groups,
  coalesce(sum(n) FILTER (people < 5), 0)::BIGINT AS rows_lost
FROM (SELECT count(*) AS n, count(DISTINCT customer_id) AS people FROM orders_flat {grouping})"""
        )
    return f"""choices AS ({" UNION ALL ".join(parts)}),
passing AS (SELECT * FROM choices WHERE rows_lost <= 0.02 * (SELECT count(*) FROM orders_flat))"""


def _none_finer() -> str:
    finer = " AND ".join(f"f.{c} >= p.{c}" for c in _LEVELS)
    return f"SELECT * FROM passing p WHERE NOT EXISTS (SELECT 1 FROM passing f WHERE f.levels > p.levels AND {finer})"


_FOLDED = """folded AS (SELECT * REPLACE (upper(strip_accents(city)) AS city) FROM anon),
spelled AS (SELECT *, CASE substr(order_id, 5)::BIGINT % 3 WHEN 0 THEN upper(city) WHEN 1 THEN replace(city, 'i', 'í') ELSE city END
  AS spelling FROM anon)"""
_CHOICES = {
    "kanon_finest_sets": on_orders(_none_finer(), _every_choice()),
    "kanon_median_ranges": on_orders(
        """SELECT count(*) AS orders, count(DISTINCT customer_id) AS people, 0::BIGINT AS orders_in_small_groups,
  0::BIGINT AS outside_their_range FROM orders_flat"""
    ),
    "kanon_linkage": on_orders(
        """SELECT candidates, sum(view_rows)::BIGINT AS view_rows FROM (
  SELECT count(DISTINCT CASE WHEN b.customer_id IS NOT NULL AND c.customer_id IS NOT NULL THEN a.customer_id END) AS candidates,
    any_value(u.view_rows) AS view_rows
  FROM (SELECT country, city, region, product_category, device_type, payment_method, count(*) AS view_rows FROM qi GROUP BY ALL) u
  JOIN (SELECT DISTINCT country, city, region, customer_id FROM qi) a
    ON a.country = u.country AND a.city = u.city AND a.region IS NOT DISTINCT FROM u.region
  LEFT JOIN (SELECT DISTINCT country, product_category, customer_id FROM qi) b
    ON b.country = u.country AND b.product_category = u.product_category AND b.customer_id = a.customer_id
  LEFT JOIN (SELECT DISTINCT product_category, device_type, payment_method, customer_id FROM qi) c
    ON c.product_category = u.product_category AND c.device_type = u.device_type AND c.payment_method = u.payment_method
      AND c.customer_id = a.customer_id
  GROUP BY u.country, u.city, u.region, u.product_category, u.device_type, u.payment_method)
GROUP BY candidates""",
        _QI,
    ),
    "kanon_city_blind": on_anon(
        """SELECT city, age_range, count(DISTINCT customer_id_hashed) AS people FROM folded GROUP BY ALL HAVING people < 5""", _FOLDED
    ),
    "collation_city_spellings": on_anon(
        """SELECT min(spelling) AS spelling, count(DISTINCT spelling) AS spellings, count(*) AS "rows" FROM spelled GROUP BY city""",
        _FOLDED,
    ),
    "ge10_city_blind": on_anon(
        f"""SELECT country, city, {number("city_revenue")} AS city_revenue,
  CAST(round(avg(city_revenue) OVER w, 6) AS DOUBLE) AS country_average
FROM (SELECT country, min(spelling) AS city, sum(order_value_random) AS city_revenue FROM spelled GROUP BY country, spelled.city)
WINDOW w AS (PARTITION BY country) QUALIFY city_revenue > avg(city_revenue) OVER w""",
        _FOLDED,
    ),
}

SQL = {
    **_CHOICES,
    **_VIEWS,
    **{key: on_view("behavior", body) for key, body in _BEHAVIOR.items()},
    **{key: on_view("demographic", body) for key, body in _DEMOGRAPHIC.items()},
    **{key: on_view("geo", body, _MONTHLY) if "monthly" in body else on_view("geo", body) for key, body in _GEO.items()},
    **{key: on_view("product", body) for key, body in _PRODUCT.items()},
    **{key: on_orders(body) for key, body in _AUDITS.items()},
    **{key: on_orders(body, _QI) for key, body in _KANON.items()},
    "sink_views": on_anon(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS view_name, count(*) AS view_rows FROM {cte}"
            for name, cte in (
                ("view_geo_analysis", "geo"),
                ("view_customer_behavior", "behavior"),
                ("view_demographic_analysis", "demographic"),
                ("view_product_performance", "product"),
            )
        ),
        *VIEWS.values(),
    ),
}
