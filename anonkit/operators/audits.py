"""Checks on each anonymization technique: leaks, uniqueness, information loss, utility.

All of them aggregate; what reaches the last task is one row per group. Where
a distinct count is needed, rows are first reduced to the distinct values by a
plain GROUP BY, which combines on the map side and spreads by value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anonkit.functions import masks, money, noise
from anonkit.sources.scratch import fresh_dir

# Fixed value: groups with fewer rows than this are reported as rare.
RARE_BELOW = 10
# Cents in a block of amounts, when the median is looked for.
BLOCK = 10**6


# ---- phone ------------------------------------------------------------------


def audit_phone_short(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Phones too short for a suffix mask."""
    n = F.char_length("phone")
    return orders.where(n < masks.PHONE_VISIBLE).select(key, "phone", n.alias("phone_length"))


def audit_phone_leak(orders: DataFrame) -> DataFrame:
    """Phones whose mask shows more than four characters; must be 0. Both masks are checked."""

    def leaks(masked: Column) -> Column:
        return F.count_if(F.char_length(F.replace(masked, F.lit(masks.STAR), F.lit(""))) > masks.PHONE_VISIBLE)

    phone = F.col("phone")
    return orders.agg(
        leaks(masks.mask_phone_raw(phone)).alias("leaky_rows"),
        leaks(masks.mask_phone(phone)).alias("leaky_rows_guarded"),
    )


def mask_phone_by_country(orders: DataFrame) -> DataFrame:
    """Each phone once per country, with its mask."""
    distinct = orders.where(F.col("phone").isNotNull()).select("phone", "country").distinct()
    return distinct.withColumn("masked_phone", masks.mask_phone(F.col("phone")))


# ---- hash -------------------------------------------------------------------


def audit_hash_determinism(orders: DataFrame, top: int = 15) -> DataFrame:
    """Customers with several orders, their hash, and whether all their rows have the same; most orders first.

    Each row is hashed by itself, so a hash that depends on more than the id would show.
    """
    return (
        orders.select("customer_id", masks.hash_id(F.col("customer_id")).alias("hashed_id"))
        .groupBy("customer_id")
        .agg(F.count("*").alias("orders"), F.min("hashed_id").alias("hashed_id"), F.max("hashed_id").alias("_other"))
        .where(F.col("orders") > 1)
        .orderBy(F.desc("orders"), "customer_id")
        .limit(top)
        .withColumn("hashes", F.when(F.col("hashed_id") == F.col("_other"), 1).otherwise(2).cast("bigint"))
        .drop("_other")
    )


def audit_hash_unique(orders: DataFrame) -> DataFrame:
    """Distinct ids minus distinct hashes; must be 0. Ids are made distinct before they are hashed."""
    ids = orders.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    return ids.agg((F.count("*") - F.countDistinct(masks.hash_id(F.col("customer_id")))).alias("collisions"))


def audit_hash_length(orders: DataFrame) -> DataFrame:
    """Each id with its hash and the hash length."""
    hashed = masks.hash_id(F.col("customer_id"))
    return orders.select("order_id", "customer_id", hashed.alias("hashed_id"), F.char_length(hashed).alias("hash_length"))


def audit_hash_avalanche(orders: DataFrame) -> DataFrame:
    """Hash of each customer id next to that of the following id, and how many of 64 characters differ."""
    number = F.regexp_extract("customer_id", "([0-9]+)$", 1)
    following = (number.cast("bigint") + 1).cast("string")
    width = F.greatest(F.char_length(number), F.char_length(following))
    head = F.regexp_extract("customer_id", "^(.*?)[0-9]+$", 1)
    pairs = (
        orders.select("customer_id")
        .where(F.col("customer_id").rlike("[0-9]$"))
        .distinct()
        .select(
            F.col("customer_id").alias("input_01"),
            masks.hash_id(F.col("customer_id")).alias("hash_01"),
            F.concat(head, F.lpad(following, width, F.lit("0"))).alias("input_02"),
        )
        .withColumn("hash_02", masks.hash_id(F.col("input_02")))
    )
    differs = [(F.substring("hash_01", i, 1) != F.substring("hash_02", i, 1)).cast("int") for i in range(1, 65)]
    return pairs.withColumn("changed_characters", sum(differs[1:], differs[0]))


def hash_group_spend(orders: DataFrame, more_than: int = 3) -> DataFrame:
    """Orders and spend per hashed customer. Grouped by id first: one hash per customer, not per order."""
    value = F.col("order_value_eur")
    return (
        orders.groupBy("customer_id")
        .agg(
            F.count("*").alias("total_orders"),
            money.total(value).alias("total_spend"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
        )
        .where(F.col("total_orders") > more_than)
        .select(
            masks.hash_id(F.col("customer_id")).alias("hashed_id"),
            "total_orders",
            "total_spend",
            "min_value",
            "max_value",
        )
        .orderBy(F.desc("total_spend"), "hashed_id")
    )


# ---- age --------------------------------------------------------------------


def _with_age_range(orders: DataFrame, as_of: dt.date | None) -> DataFrame:
    known = orders.where(F.col("birth_date").isNotNull())
    return known.withColumn("age_range", masks.age_range(F.col("birth_date"), as_of))


def age_distribution(orders: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return (
        _with_age_range(orders, as_of)
        .groupBy("age_range")
        .agg(F.count("*").alias("orders"), money.mean(F.col("order_value_eur")).alias("avg_order_value"))
        .orderBy(F.desc("orders"), "age_range")
    )


def audit_age_gain(orders: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Distinct birth dates against distinct age ranges."""
    dates = orders.select("birth_date").where(F.col("birth_date").isNotNull()).distinct()
    return dates.agg(
        F.count("*").alias("unique_dates"),
        F.countDistinct(masks.age_range(F.col("birth_date"), as_of)).alias("unique_ranges"),
    )


def audit_age_rare(orders: DataFrame, as_of: dt.date | None = None, below: int = RARE_BELOW) -> DataFrame:
    return age_distribution(orders, as_of).where(F.col("orders") < below).orderBy("age_range")


def audit_age_loss(orders: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Per age range: how many birth dates share it, and the outermost two."""
    dates = orders.select("birth_date").distinct()
    return (
        _with_age_range(dates, as_of)
        .groupBy("age_range")
        .agg(
            F.count("*").alias("unique_dates"),
            F.max("birth_date").alias("last_date"),
            F.min("birth_date").alias("first_date"),
        )
        .orderBy(F.desc("age_range"))
    )


# ---- postal code ------------------------------------------------------------


def _prefix(keep: int) -> Column:
    return masks.postal_prefix(F.col("postal_code"), keep).alias("region_prefix")


def postal_distribution(orders: DataFrame, keep: int = 2, top: int = 20) -> DataFrame:
    """Orders and average value per country and prefix; the first ``top`` by country and size."""
    return (
        orders.where(F.col("postal_code").isNotNull())
        .groupBy("country", _prefix(keep))
        .agg(F.count("*").alias("orders"), money.mean(F.col("order_value_eur")).alias("avg_order_value"))
        .orderBy("country", F.desc("orders"), "region_prefix")
        .limit(top)
    )


def audit_postal_gain(orders: DataFrame, keep: int = 2) -> DataFrame:
    codes = orders.select("postal_code").where(F.col("postal_code").isNotNull()).distinct()
    return codes.agg(
        F.count("*").alias("unique_codes"),
        F.countDistinct(masks.postal_prefix(F.col("postal_code"), keep)).alias("unique_prefixes"),
    )


def audit_postal_rare(orders: DataFrame, keep: int = 2, below: int = RARE_BELOW) -> DataFrame:
    """Country and prefix with few orders, and how many people placed them."""
    per_person = orders.groupBy("country", _prefix(keep), "customer_id").agg(F.count("customer_id").alias("n"))
    return (
        per_person.groupBy("country", "region_prefix")
        .agg(F.sum("n").alias("orders"), F.count("customer_id").alias("people"))
        .where(F.col("orders") < below)
        .orderBy("orders", "country", "region_prefix")
    )


def audit_postal_loss(orders: DataFrame, keep: int = 2, top: int = 15) -> DataFrame:
    """Prefixes that hide the fewest codes."""
    codes = orders.select("postal_code").distinct()
    return (
        codes.groupBy(_prefix(keep))
        .agg(
            F.count("postal_code").alias("unique_codes"),
            F.max("postal_code").alias("example_max"),
            F.min("postal_code").alias("example_min"),
        )
        .orderBy("unique_codes", F.asc_nulls_first("region_prefix"))
        .limit(top)
    )


# ---- noise ------------------------------------------------------------------


def _noised(orders: DataFrame, salt: str) -> DataFrame:
    value = F.col("order_value_eur")
    return orders.select(
        "country",
        value.cast(money.MONEY).alias("original"),
        noise.noise_uniform(value, F.col("order_id"), salt).alias("noised"),
    )


def _holds(rank: str) -> Column:
    """Whether the row, the last of the first ``upto`` with ``n`` of its own, holds the rank counted from 0."""
    return (F.col(rank) < F.col("upto")) & (F.col(rank) >= F.col("upto") - F.col("n"))


def _middle_values(counted: DataFrame, blocks: DataFrame) -> DataFrame:
    """The exact median of each series from counts per amount in cents, and these counts per block of ``BLOCK`` cents.

    Running counts over the blocks find those that hold the two middle ranks (one and the same for an odd count), running
    counts inside them the amounts. An amount has twelve digits, so a task never sorts more than a million counts.
    """
    upto = F.sum("n").over(Window.partitionBy("series").orderBy("block"))
    total = F.sum("n").over(Window.partitionBy("series"))
    placed = blocks.select("series", "block", "n", upto.alias("upto"), F.floor((total - 1) / 2).alias("low"), F.floor(total / 2).alias("high"))
    # at most two rows for each of the series
    held = placed.where(_holds("low") | _holds("high")).select("series", "block", "low", "high", (F.col("upto") - F.col("n")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("series", "block").orderBy("cents")) + F.col("before")
    rows = counted.join(F.broadcast(held), ["series", "block"]).withColumn("upto", inside)
    middle = [F.max(F.when(_holds(rank), F.col("cents"))) for rank in ("low", "high")]
    return rows.groupBy("series").agg(((middle[0] + middle[1]) / 2 / 100).alias("median_value"))


def noise_utility_total(orders: DataFrame, salt: str) -> DataFrame:
    """Count, mean, extremes, sum and median before and after the noise.

    One scan: rows are counted per series and amount on the map side into a table, and all statistics are formed
    from the counts.
    """
    values = _noised(orders, salt).selectExpr("stack(2, 'original', original, 'noised', noised) as (series, value)")
    cents = (F.col("value") * 100).cast("bigint")
    counts = values.where(F.col("value").isNotNull()).groupBy("series", "value").agg(F.count("*").alias("n"))
    counted = counts.select("series", "value", "n", cents.alias("cents"), F.floor(cents / BLOCK).alias("block"))
    path = fresh_dir(orders.sparkSession, "amounts")
    counted.write.parquet(path)
    counted = orders.sparkSession.read.schema(counted.schema).parquet(path)
    blocks = counted.groupBy("series", "block").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("value") * F.col("n")).alias("weighted"),
        F.max("value").alias("most"),
        F.min("value").alias("least"),
    )
    sums = blocks.groupBy("series").agg(
        F.sum("n").alias("orders"),
        F.round(F.sum("weighted") / F.sum("n"), 2).alias("avg_value"),
        F.max("most").alias("max_value"),
        F.min("least").alias("min_value"),
        F.sum("weighted").cast("decimal(20,2)").alias("total_value"),
    )
    # a row for each series
    return sums.join(F.broadcast(_middle_values(counted, blocks)), "series")


def noise_drawn(orders: DataFrame, noise_of: Callable[[Column], Column], bound: float) -> DataFrame:
    """Each order's value, whether noise was drawn for it, and whether it lies within ``bound``, for random noise.

    The noised value itself changes when the plan runs again; write it before using it twice.
    """
    value = F.col("order_value_eur").cast("double")
    drawn = orders.select("order_id", value.alias("order_value_eur"), noise_of(F.col("order_value_eur")).cast("double").alias("_noised"))
    change = F.abs(F.col("_noised") - F.col("order_value_eur"))
    return drawn.select(
        "order_id",
        "order_value_eur",
        F.col("_noised").isNotNull().cast("bigint").alias("noised"),
        (change <= F.col("order_value_eur") * bound + 0.0051).cast("bigint").alias("within_bound"),
    )


def noise_bands(orders: DataFrame, noise_of: Callable[[Column], Column], bands: dict[str, tuple[float, float, float]]) -> DataFrame:
    """For each band (relative change, least and greatest share of rows within it) whether the share is as it must be.

    ``centered`` is 1 if the mean change is close to 0. The noise is drawn once per row and used in one aggregation only.
    """
    value = F.col("order_value_eur").cast("double")
    drawn = orders.select(value.alias("value"), noise_of(F.col("order_value_eur")).cast("double").alias("noised"))
    change = (F.col("noised") - F.col("value")) / F.col("value")
    checks = [
        F.count_if(F.abs(change) <= width).between(F.count("*") * least, F.count("*") * most).cast("bigint").alias(name)
        for name, (width, least, most) in bands.items()
    ]
    return drawn.agg(F.count("*").alias("orders"), *checks, (F.abs(F.avg(change)) < 0.005).cast("bigint").alias("centered"))


def noise_utility_country(orders: DataFrame, salt: str) -> DataFrame:
    """Average before and after per country, and the deviation in percent."""
    before, after = F.sum("original"), F.sum("noised")
    return (
        _noised(orders, salt)
        .groupBy("country")
        .agg(
            money.mean(F.col("original")).alias("avg_value"),
            money.mean(F.col("noised")).alias("avg_noised_value"),
            # both averages have the same count, so the sums give their ratio
            money.percent(F.abs(after - before), before).alias("deviation_percent"),
        )
        .orderBy("country")
    )


# ---- network address --------------------------------------------------------


def audit_ip_gain(orders: DataFrame) -> DataFrame:
    """Rows and distinct values before and after truncation.

    Two GROUP BYs, from addresses to networks, leave one row per network.
    """
    addresses = orders.groupBy("ip_address").agg(F.count("ip_address").alias("n"))
    networks = addresses.groupBy(masks.truncate_ip(F.col("ip_address")).alias("network")).agg(
        F.sum("n").alias("n"), F.count("ip_address").alias("addresses")
    )
    return networks.agg(
        F.sum("n").alias("rows_with_ip"),
        F.sum(F.when(F.col("network").isNotNull(), F.col("n")).otherwise(0)).alias("rows_with_network"),
        F.sum("addresses").alias("unique_ips"),
        F.count("network").alias("unique_networks"),
    )


def ip_distribution(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(masks.truncate_ip(F.col("ip_address")).alias("network"))
        .agg(F.count("*").alias("orders"))
        .orderBy(F.desc("orders"), "network")
    )
