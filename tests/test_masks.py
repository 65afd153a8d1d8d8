"""Column functions against hand-written pairs and against plain Python on random values."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from anonkit.functions import masks


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "function, pairs",
    [
        (
            masks.mask_email,
            {
                "john@gmail.com": "jo**@gmail.com",
                "a@b.c": "***@b.c",
                "ab@b.c": "***@b.c",
                "abc@b.c": "ab*@b.c",
                "no-at": "***",
                "": "***",
                "@b.c": "***@b.c",
                None: None,
            },
        ),
        (
            masks.mask_email_raw,
            {"john@gmail.com": "jo**@gmail.com", "a@x.example": "a@@x.example", "no-at": "no", None: None},
        ),
        (
            masks.mask_phone,
            {"+34 912 345 678": "*********** 678", "+34 912 345678": "**********5678", "123": "***", "1234": "****", "12345": "*2345", "": "", None: None},
        ),
        (masks.mask_phone_raw, {"12345": "*2345", "1234": "1234", "123": "", None: None}),
        (
            masks.generalize_postal,
            {
                "28045": "28***",
                "2323LD": "23****",
                "N27 7NYE": "N2******",
                "SW1A 1AA": "SW******",
                "12": "12",
                "1": "1",
                None: None,
            },
        ),
        (masks.postal_prefix, {"28045": "28", "1": "1", "": "", None: None}),
        (lambda c: masks.postal_prefix(c, 1), {"28045": "2"}),
        (
            masks.truncate_ip,
            {
                "192.168.45.123": "192.168.0.0",
                "2001:db8::1": None,
                "1.2.3": None,
                "1.2.3.4.5": None,
                "not an address": None,
                "": None,
                None: None,
            },
        ),
        (masks.truncate_ip_prefix, {"192.168.45.123": "192.168", "::ffff:1.2.3.4": None}),
        (lambda c: masks.truncate_ip(c, 3), {"192.168.45.123": "192.168.45.0"}),
        (
            masks.hash_id,
            {"CUST-000001": "c516218ff77d814113d40f4fc7478a2f763de41a9b3aa047752ad0e5516b3619", None: None},
        ),
    ],
)
def test_pairs(spark, function, pairs):
    assert apply(spark, function, list(pairs)) == list(pairs.values())


def test_salt_changes_the_hash(spark):
    plain, salted = (apply(spark, f, ["CUST-000001"])[0] for f in (masks.hash_id, lambda c: masks.hash_id(c, "s")))
    assert plain != salted and len(salted) == 64


def test_age_on_29_february(spark):
    born = [dt.date(2000, 2, 29)]
    for day, age in (
        (dt.date(2001, 2, 28), 0),
        (dt.date(2001, 3, 1), 1),
        (dt.date(2004, 2, 28), 3),
        (dt.date(2004, 2, 29), 4),
    ):
        assert apply(spark, lambda c: masks.age_exact(c, day), born, "date") == [age]


def test_age_range(spark):
    values = [dt.date(1961, 8, 10), None, dt.date(2016, 4, 1), dt.date(2016, 4, 2)]
    day = dt.date(2026, 4, 1)
    assert apply(spark, lambda c: masks.age_range(c, day), values, "date") == ["60-69", None, "10-19", "0-9"]
    assert apply(spark, lambda c: masks.age_range(c, day, 5), values[:1], "date") == ["60-64"]


def test_age_without_day_uses_today(spark):
    today = spark.sql("select current_date()").first()[0]
    assert apply(spark, masks.age_exact, [today], "date") == [0]


def test_order_month(spark):
    assert apply(spark, masks.order_month, [dt.datetime(2024, 3, 31, 23, 59)], "timestamp_ntz") == [dt.date(2024, 3, 1)]


def test_random_values_against_python(spark):
    rng = random.Random(7)
    values = ["".join(rng.choice("aé@.1+* 😀") for _ in range(rng.randrange(0, 14))) for _ in range(600)]

    def email(e):
        at = e.find("@") + 1
        return "***" if at == 0 else "***" + e[at - 1 :] if at <= 3 else e[:2] + "*" * (at - 3) + e[at - 1 :]

    def phone(p):
        return "*" * len(p) if len(p) <= 4 else "*" * (len(p) - 4) + p[-4:]

    assert apply(spark, masks.mask_email, values) == [email(v) for v in values]
    assert apply(spark, masks.mask_phone, values) == [phone(v) for v in values]
    assert apply(spark, masks.generalize_postal, values) == [v[:2] + "*" * (len(v) - 2) for v in values]
