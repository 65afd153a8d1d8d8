"""Anonymize whole order tables.

Everything here is a projection: no shuffle, one pass over the columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anonkit.functions import masks, noise
from anonkit.operators.redact import redacted_note
from anonkit.schema import COLUMN_TREATMENTS, SUPPRESSED_COLUMNS, Policy


def treated_columns(policy: Policy) -> list[Column]:
    """Output columns of the anonymized table in table order, notes still raw."""
    how = {
        "customer_id": lambda c: masks.hash_id(c, policy.id_salt),
        "email": masks.mask_email,
        "phone": masks.mask_phone,
        "birth_date": lambda c: masks.age_range(c, policy.as_of, policy.age_width),
        "postal_code": lambda c: masks.generalize_postal(c, policy.postal_keep),
        "ip_address": masks.truncate_ip,
        "order_value_eur": lambda c: noise.noise_uniform(c, F.col("order_id"), policy.noise_salt, policy.noise_ratio),
    }
    if policy.order_date_to_month:
        how["order_date"] = masks.order_month
    return [
        how.get(column, lambda c: c)(F.col(column)).alias(output)
        for column, (_, output) in COLUMN_TREATMENTS.items()
        if output is not None
    ]


def anonymize_orders(orders: DataFrame, policy: Policy) -> DataFrame:
    """Anonymized order table; ``customer_notes`` is passed on raw for later redaction."""
    return orders.select(*treated_columns(policy))


def export_orders(orders: DataFrame, policy: Policy) -> DataFrame:
    """Anonymized order table with redacted notes and without the raw ones.

    Notes are redacted in the same pass, while the row still knows the name,
    address and numbers of its customer.
    """
    redacted = redacted_note(F.col("customer_notes"), F.col("birth_date")).alias("customer_notes_anonymized")
    return orders.select(*treated_columns(policy), redacted).drop("customer_notes")


def suppress_columns(orders: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return orders.drop(*(SUPPRESSED_COLUMNS if columns is None else columns))
