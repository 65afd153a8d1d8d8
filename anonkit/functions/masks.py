"""Masking, hashing, generalization and truncation of single columns.

NULL stays NULL in all of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters and widths that masked output is made of.
STAR = "*"
HIDDEN_LOCAL_PART = "***"
EMAIL_VISIBLE = 2
PHONE_VISIBLE = 4
IPV4_PATTERN = "^[0-9]{1,3}([.][0-9]{1,3}){3}$"


def _stars(count: Column) -> Column:
    # repeat() gives '' for a count below 1
    return F.repeat(F.lit(STAR), count)


# ---- e-mail -----------------------------------------------------------------


def mask_email(email: Column) -> Column:
    """First two characters, stars, then the domain.

    A local part of one or two characters is hidden whole. A value without
    ``@`` has no domain to show and is hidden whole; ``substr`` from position 0
    would return all of it.
    """
    at = F.instr(email, "@")
    domain = F.substr(email, at)
    return (
        F.when(at == 0, F.lit(HIDDEN_LOCAL_PART))
        .when(at <= EMAIL_VISIBLE + 1, F.concat(F.lit(HIDDEN_LOCAL_PART), domain))
        .otherwise(F.concat(F.substring(email, 1, EMAIL_VISIBLE), _stars(at - (EMAIL_VISIBLE + 1)), domain))
    )


def mask_email_raw(email: Column) -> Column:
    """The same without the guard for short local parts: these stay readable."""
    at = F.instr(email, "@")
    head = F.concat(F.substring(email, 1, EMAIL_VISIBLE), _stars(at - (EMAIL_VISIBLE + 1)))
    return F.when(at == 0, head).otherwise(F.concat(head, F.substr(email, at)))


# ---- phone ------------------------------------------------------------------


def mask_phone(phone: Column) -> Column:
    """Stars but for the last four characters; all stars if there are no more than four."""
    n = F.char_length(phone)
    return F.when(n <= PHONE_VISIBLE, _stars(n)).otherwise(
        F.concat(_stars(n - PHONE_VISIBLE), F.right(phone, F.lit(PHONE_VISIBLE)))
    )


def mask_phone_raw(phone: Column) -> Column:
    """The same without the guard: a value of four characters stays readable, a shorter one becomes empty."""
    n = F.char_length(phone)
    return F.when(n < PHONE_VISIBLE, F.lit("")).otherwise(
        F.concat(_stars(n - PHONE_VISIBLE), F.right(phone, F.lit(PHONE_VISIBLE)))
    )


# ---- identifiers ------------------------------------------------------------


def hash_id(identifier: Column, salt: str | None = None) -> Column:
    """SHA-256 in hex. Without a salt, short ids can be found again by trying all of them."""
    return F.sha2(identifier if salt is None else F.concat(F.lit(salt), identifier), 256)


# ---- age --------------------------------------------------------------------


def as_of_date(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def age_exact(birth_date: Column, as_of: dt.date | None = None) -> Column:
    """Completed years. Someone born on 29 February turns a year older on 1 March of other years."""
    today = as_of_date(as_of)
    birthday_ahead = F.month(today) * 100 + F.dayofmonth(today) < F.month(birth_date) * 100 + F.dayofmonth(birth_date)
    return F.year(today) - F.year(birth_date) - birthday_ahead.cast("int")


def age_group_start(birth_date: Column, as_of: dt.date | None = None, width: int = 10) -> Column:
    age = age_exact(birth_date, as_of)
    return age - F.pmod(age, F.lit(width))


def age_range(birth_date: Column, as_of: dt.date | None = None, width: int = 10) -> Column:
    start = age_group_start(birth_date, as_of, width)
    return F.concat(start.cast("string"), F.lit("-"), (start + (width - 1)).cast("string"))


# ---- place and time ---------------------------------------------------------


def postal_prefix(postal_code: Column, keep: int = 2) -> Column:
    return F.substring(postal_code, 1, keep)


def generalize_postal(postal_code: Column, keep: int = 2) -> Column:
    """First ``keep`` characters, stars for the rest, same length. Shorter codes stay as they are."""
    return F.concat(postal_prefix(postal_code, keep), _stars(F.char_length(postal_code) - keep))


def order_month(order_date: Column) -> Column:
    return F.trunc(order_date.cast("date"), "month")


def truncate_ip_prefix(ip: Column, octets: int = 2) -> Column:
    """Leading octets of an IPv4 address. Anything else becomes NULL instead of passing through."""
    return F.when(ip.rlike(IPV4_PATTERN), F.substring_index(ip, ".", octets))


def truncate_ip(ip: Column, octets: int = 2) -> Column:
    return F.concat(truncate_ip_prefix(ip, octets), F.lit(".0" * (4 - octets)))
