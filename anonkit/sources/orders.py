"""The order table: derived from ``orders`` and ``customer``, or generated from ``customer`` alone.

Attributes are arithmetic on keys, so rows come out the same on every executor.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anonkit.functions.keyed import digest, draw, unit_interval
from anonkit.schema import ORDERS_SCHEMA
from anonkit.sources.tables import read_test_table

# The domains of the order table.
FIRST_NAMES = ("Ana", "Liam", "Greta", "Louis", "Carmen", "Daan", "Niamh", "Oscar")
LAST_NAMES = ("Keller", "Murphy", "Garcia", "Dupont", "Visser", "Smith", "Weber")
COUNTRIES = ("United Kingdom", "Ireland", "Germany", "France", "Spain", "Netherlands")
GENDERS = ("M", "F", "Other")
CATEGORIES = ("Apparel", "Home & Living", "Electronics", "Beauty", "Sports", "Books", "Toys", "Accessories")
PAYMENT_METHODS = ("Visa", "Mastercard", "PayPal", "Apple Pay", "Klarna")
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "Visa",
    "2-HIGH": "Mastercard",
    "3-MEDIUM": "PayPal",
    "4-NOT SPECIFIED": "Apple Pay",
}
SEGMENT_CENTS = {"VIP": (8000, 50000), "Regular": (2500, 20000), "New": (1000, 8000)}
ORDER_DAYS = 730


def _pick(values: tuple[str, ...], index: str) -> str:
    quoted = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({quoted}), cast(({index}) % {len(values)} as int) + 1)"


def _number(prefix: str, expr: str, width: int) -> str:
    # lpad cuts longer numbers, so the width grows with them
    text = f"cast({expr} as string)"
    return f"'{prefix}' || lpad({text}, greatest(length({text}), {width}), '0')"


# Attributes of a customer from its key k and nation n, with its fixed share of
# missing, short and malformed values.
_CUSTOMER_BASE = {
    "_first": _pick(FIRST_NAMES, "k"),
    "_last": _pick(LAST_NAMES, "k"),
    "country": _pick(COUNTRIES, "n"),
}
_CUSTOMER = {
    "customer_id": _number("CUST-", "k", 6),
    "full_name": "_first || ' ' || _last",
    "email": """case k % 25 when 0 then 'a@x.example' when 1 then 'no-at-sign' when 2 then null
        else lower(_first) || '.' || lower(_last) || cast(k as string) || '@mail.example' end""",
    "phone": """case when k % 40 = 7 then '123' when k % 40 = 9 then null
        when k % 3 = 0 then '+34 9' || lpad(cast((k * 7919) % 100000000 as string), 8, '0')
        when k % 3 = 1 then '(0174)-' || lpad(cast((k * 7919) % 1000000 as string), 6, '0')
        else '255.901.' || lpad(cast(k % 10000 as string), 4, '0') end""",
    "birth_date": "case when k % 60 <> 11 then date_add(date'1951-01-01', cast((k * 7919) % 20820 as int)) end",
    "gender": _pick(GENDERS, "k"),
    "country": "country",
    "city": "country || ' City ' || cast(k % 7 as string)",
    "postal_code": """case when k % 70 = 13 then null
        when country = 'United Kingdom' then 'SW' || cast(k % 20 as string) || 'A 1AA'
        when country = 'Ireland' then 'N' || lpad(cast(k % 90 as string), 2, '0') || ' 7NYE'
        when country = 'Netherlands' then lpad(cast((1000 + k * 37) % 10000 as string), 4, '0') || 'LD'
        else lpad(cast((1000 + k * 311) % 100000 as string), 5, '0') end""",
    "street_address": "cast(1 + k % 200 as string) || ' Main Street'",
    "customer_segment": "case when k % 10 < 5 then 'New' when k % 10 < 9 then 'Regular' else 'VIP' end",
}

# Attributes of an order from its key o, its customer key k and the source columns.
_ORDER = {
    "order_id": _number("ORD-", "o", 7),
    "card_last4": "cast(1000 + (o * 31) % 9000 as string)",
    "payment_method": "case o_orderpriority "
    + " ".join(f"when '{p}' then '{m}'" for p, m in PAYMENT_BY_PRIORITY.items())
    + " else 'Klarna' end",
    "order_date": "o_orderdate + make_interval(0, 0, 0, 0, cast(o % 24 as int), 0, 0)",
    "product_category": _pick(CATEGORIES, "o * 7919 + k"),
    "order_value_eur": "cast((cast(round(o_totalprice * 100) as bigint) % 49000 + 1000) * 0.01BD as decimal(10,2))",
    "device_type": "case when o % 10 < 6 then 'mobile' when o % 10 < 9 then 'desktop' else 'tablet' end",
    "ip_address": """cast(1 + o % 223 as string) || '.' || cast((o * 13) % 256 as string) || '.'
        || cast((o * 29) % 256 as string) || '.' || cast(1 + o % 254 as string)""",
}
# The customer with the next key, whom some notes name, once in a misspelt form.
_NEIGHBOUR = {"_next_first": _pick(FIRST_NAMES, "k + 1"), "_next_last": _pick(LAST_NAMES, "k + 1")}
_NOTES = """case o % 16
    when 0 then 'Customer ' || full_name || ' called from ' || coalesce(phone, 'an unknown number') || ' about '
        || order_id || '.\\n' || 'Reply to ' || coalesce(email, 'no address') || '; ship to ' || street_address || '.'
    when 2 then 'Hello, my name is ' || full_name || ', born ' || coalesce(cast(birth_date as string), 'unknown')
        || '. Customer ' || customer_id || ', order ' || order_id || ' placed on ' || date_format(order_date, 'yyyy-MM-dd') || '.'
    when 6 then 'Passport number ' || lpad(cast((o * 7919) % 1000000000 as string), 9, '0') || ' checked, card 4465 7583 8288 '
        || card_last4 || ', login from ' || ip_address || ', build 10.2.3.'
    when 10 then 'Deliver to Calle de Mayor ' || cast(1 + o % 90 as string) || ' or Hauptstraße ' || cast(1 + o % 300 as string)
        || ', not to 12 Pieces.'
    when 12 then 'Order ' || order_id || ' shipped 2024-04-28, delivered 2024-05-01, version 3.10.2; invoice 1234567, 3 boxes.'
    when 14 then 'Date of birth of the customer, as in the passport shown: ' || coalesce(cast(birth_date as string), 'unknown')
        || '. 3 February 1980 is the date of birth of the partner. Delivered 2024-05-01, birthday gift; order of 2020-01-01 was for the birth of a child.'
    when 13 then 'Parcel taken by the neighbour ' || _next_first || ' ' || _next_last || ', ' || lower(_next_first) || '.'
        || lower(_next_last) || cast(k + 1 as string) || '@mail.example; signed ' || _next_first || ' ' || substr(_next_last, 1, 2)
        || substr(_next_last, 4) || '.'
    when 8 then 'The product quality was excellent, will buy again!'
    when 4 then '' end"""


def note_truth() -> dict[str, Column]:
    """How many values of each label the note of an order holds, as the note forms above put them in."""
    form = F.substring(F.col("order_id"), 5, 100).cast("bigint") % 16

    def among(*forms: int, having: str | None = None) -> Column:
        held = form.isin(*forms)
        return (held if having is None else held & F.col(having).isNotNull()).cast("int")

    return {
        "[NAME]": among(0, 2) + among(13) * 2,
        "[EMAIL]": among(0, having="email") + among(13),
        "[PHONE]": among(0, having="phone"),
        "[ADDRESS]": among(0) + among(10) * 2,
        "[DOB]": among(2, 14, having="birth_date") + among(14),
        "[ID]": among(2, 6),
        "[CARD]": among(6),
        "[IP]": among(6),
    }


def _named(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(e).alias(name) for name, e in expressions.items()]


def orders_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20-column order table: one row per order, customer attributes repeated.

    Only the join shuffles, and only where the customers are too large to
    broadcast. AQE splits the partition of a customer that has a large share
    of all orders.
    """
    orders = read_test_table(spark, sf_dir, "orders")
    customer = read_test_table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("o"),
        F.col("c_custkey").alias("k"),
        F.col("c_nationkey").alias("n"),
        "o_orderdate",
        "o_totalprice",
        "o_orderpriority",
    )
    people = joined.select("*", *_named(_CUSTOMER_BASE))
    flat = people.select("o", "k", *_named(_NEIGHBOUR), *_named(_CUSTOMER), *_named(_ORDER))
    return flat.withColumn("customer_notes", F.expr(_NOTES)).select(*ORDERS_SCHEMA.names)


def gen_orders(
    customers: DataFrame,
    as_of: dt.date,
    seed: str,
    orders_per_customer: float = 10 / 3,
) -> DataFrame:
    """Synthetic orders for a table of customers (``c_custkey``, ``c_nationkey``).

    The number of orders of a customer is exponentially distributed, so few
    customers place many; values depend on the segment; dates lie in the 730
    days before ``as_of``. Every draw comes from the keys, and each customer
    makes its orders where it is: no join, no shuffle, no driver loop.
    """
    if not 0 < orders_per_customer <= 40:
        raise ValueError("orders_per_customer must be above 0 and at most 40")
    key = F.col("k").cast("string")
    weight = -F.log(unit_interval(draw(digest(key, seed))))
    placed = (
        customers.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n"))
        .withColumn("_orders", F.floor(weight * F.lit(float(orders_per_customer))))
        .where(F.col("_orders") > 0)
        .withColumn("_seq", F.explode(F.expr("sequence(1, cast(_orders as int))")))
        # a customer has at most 22.2 times the average, below 1000 orders
        .withColumn("o", F.col("k") * 1000 + F.col("_seq"))
    )
    order_key = F.col("o").cast("string")
    drawn = placed.select(
        "*",
        *_named(_CUSTOMER_BASE),
        *[digest(order_key, f"{seed}/{part}/").alias(f"_{part}") for part in ("when", "what", "where")],
    ).select("o", *_named(_CUSTOMER), "_when", "_what", "_where")

    def one_of(part: str, slot: int, count: int) -> Column:
        return draw(F.col(part), slot) % count

    segment = F.col("customer_segment")
    cents = F.lit(None).cast("bigint")
    for name, (low, high) in SEGMENT_CENTS.items():
        cents = F.when(segment == name, one_of("_what", 0, high - low + 1) + low).otherwise(cents)
    device = one_of("_what", 3, 10)
    hours_ago = one_of("_when", 0, ORDER_DAYS) * 24 + 24 + one_of("_when", 1, 24)

    def named(values: tuple[str, ...], index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))

    return drawn.select(
        F.expr(_number("ORD-", "o", 7)).alias("order_id"),
        *_CUSTOMER,
        (one_of("_when", 2, 9000) + 1000).cast("string").alias("card_last4"),
        named(PAYMENT_METHODS, one_of("_what", 1, len(PAYMENT_METHODS))).alias("payment_method"),
        (F.lit(as_of).cast("timestamp_ntz") - F.make_interval(hours=hours_ago.cast("int"))).alias("order_date"),
        named(CATEGORIES, one_of("_what", 2, len(CATEGORIES))).alias("product_category"),
        (cents * F.expr("0.01BD")).cast("decimal(10,2)").alias("order_value_eur"),
        F.when(device < 6, "mobile").when(device < 9, "desktop").otherwise("tablet").alias("device_type"),
        F.concat_ws(
            ".",
            # first octets 11 to 99 hold public networks only
            (one_of("_where", 0, 89) + 11).cast("string"),
            *[one_of("_where", slot, 256).cast("string") for slot in (1, 2)],
            (one_of("_where", 3, 254) + 1).cast("string"),
        ).alias("ip_address"),
        F.lit("").alias("customer_notes"),
    ).select(*ORDERS_SCHEMA.names)
