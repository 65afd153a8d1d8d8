"""Schemas of the order table and the policy that says what happens to each column."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("birth_date", T.DateType()),
        T.StructField("gender", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("street_address", T.StringType()),
        T.StructField("card_last4", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        # Local wall-clock time without a zone, as the order systems record it.
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("order_value_eur", T.DecimalType(10, 2)),
        T.StructField("device_type", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("customer_notes", T.StringType()),
    ]
)

# Column -> (treatment, output column). "suppress" has no output.
COLUMN_TREATMENTS = {
    "order_id": ("keep", "order_id"),
    "customer_id": ("hash", "customer_id_hashed"),
    "email": ("mask", "email_masked"),
    "phone": ("mask", "phone_masked"),
    "birth_date": ("generalize", "age_range"),
    "postal_code": ("generalize", "postal_code_general"),
    "ip_address": ("truncate", "ip_truncated"),
    "order_value_eur": ("noise", "order_value_random"),
    "gender": ("keep", "gender"),
    "country": ("keep", "country"),
    "city": ("keep", "city"),
    "payment_method": ("keep", "payment_method"),
    "order_date": ("keep", "order_date"),
    "product_category": ("keep", "product_category"),
    "device_type": ("keep", "device_type"),
    "customer_segment": ("keep", "customer_segment"),
    "customer_notes": ("redact", "customer_notes"),
    "full_name": ("suppress", None),
    "street_address": ("suppress", None),
    "card_last4": ("suppress", None),
}

SUPPRESSED_COLUMNS = [c for c, (treatment, _) in COLUMN_TREATMENTS.items() if treatment == "suppress"]


@dataclass(frozen=True)
class Policy:
    """Parameters of an anonymization run.

    ``noise_salt`` is a secret: whoever knows it can undo the noise. ``as_of``
    is the day ages are counted to; ``None`` means the day the query runs.
    """

    noise_salt: str
    as_of: dt.date | None = None
    id_salt: str | None = None
    noise_ratio: float = 0.05
    age_width: int = 10
    postal_keep: int = 2
    order_date_to_month: bool = False

    def __post_init__(self):
        if not self.noise_salt:
            raise ValueError("noise_salt must be a non-empty secret")
        if self.age_width < 1 or self.postal_keep < 0 or not 0 <= self.noise_ratio < 1:
            raise ValueError("age_width >= 1, postal_keep >= 0 and 0 <= noise_ratio < 1 are required")
