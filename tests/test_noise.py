import datetime as dt
import hashlib
import statistics
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from anonkit.functions import money, noise
from anonkit.functions.keyed import bernoulli
from anonkit.operators import audits
from anonkit.schema import Policy

CENT = Decimal("0.01")


def test_uniform_noise_is_the_keyed_formula(spark):
    values = [Decimal(i * 37 % 50000 + 1).scaleb(-2) for i in range(2000)]
    df = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(values)], "k string, v decimal(10,2)")
    got = {r.k: r.n for r in df.select("k", noise.noise_uniform(F.col("v"), F.col("k"), "s").alias("n")).collect()}
    for i, v in enumerate(values):
        ppm = 950000 + int(hashlib.md5(f"sk{i}".encode()).hexdigest()[:8], 16) % 100001
        assert got[f"k{i}"] == (v * ppm / 1_000_000).quantize(CENT, ROUND_HALF_UP)
        assert abs(got[f"k{i}"] - v) <= v * Decimal("0.05") + Decimal("0.005")


def test_keyed_noise_survives_repartitioning(orders):
    value = noise.noise_uniform(F.col("order_value_eur"), F.col("order_id"), "salt").alias("n")
    first = {tuple(r) for r in orders.select("order_id", value).collect()}
    second = {tuple(r) for r in orders.repartition(13, "city").select("order_id", value).collect()}
    assert first == second and len(first) == 1500


def test_salt_decides_the_noise(orders):
    def noised(salt):
        n = noise.noise_uniform(F.col("order_value_eur"), F.col("order_id"), salt)
        return [r[0] for r in orders.orderBy("order_id").select(n).collect()]

    assert sum(a == b for a, b in zip(noised("one"), noised("two"))) < 100


def test_gaussian_noise_has_its_spread(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"), F.lit(Decimal("1000.00")).alias("v"))
    relative = df.select((noise.noise_gaussian(F.col("v"), F.col("k"), "s") / 1000 - 1).cast("double").alias("r"))
    mean, spread = relative.agg(F.avg("r"), F.stddev("r")).first()
    assert abs(mean) < 0.001 and abs(spread - 0.025) < 0.001


def test_difference_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(Decimal("0"), Decimal("0"))], "a decimal(10,2), b decimal(12,2)")
    assert df.select(noise.difference_percent(F.col("a"), F.col("b"))).first()[0] is None


def test_mean_is_exact_where_doubles_are_not(spark):
    # sum of cents above 2**53
    df = spark.range(0, 4, 1, 4).select(F.lit(Decimal("99999999999999.99")).cast("decimal(16,2)").alias("v"))
    df = df.union(spark.range(1).select(F.lit(Decimal("0.04")).cast("decimal(16,2)")))
    assert df.select().count() == 5
    assert df.agg(money.mean(F.col("v"))).first()[0] == Decimal("80000000000000.00")
    assert df.agg(money.total(F.col("v"))).first()[0] == Decimal("400000000000000.00")


def test_percent_of_nothing_is_null(spark):
    df = spark.range(1).select(F.lit(0).alias("a"))
    row = df.select(money.percent(F.col("a"), F.col("a")), money.percent_raw(F.col("a"), F.col("a"))).first()
    assert list(row) == [None, None]


def test_bernoulli_share_and_stability(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    picked = {r.k for r in df.where(bernoulli(F.col("k"), 0.06, "s")).collect()}
    assert 1000 < len(picked) < 1400
    assert picked == {r.k for r in df.repartition(5).where(bernoulli(F.col("k"), 0.06, "s")).collect()}


def test_policy_needs_a_secret():
    with pytest.raises(ValueError):
        Policy(noise_salt="", as_of=dt.date(2026, 1, 1))


@pytest.mark.parametrize(
    "amounts",
    [
        ["12.34"],
        ["0.01", "0.02"],
        ["5.00"] * 4 + [None],
        ["9999.99", "10000.00", "10000.01"],  # over the border of a block
        ["9999.99", "10000.00"],
        ["0.00", "9999999999.99", "9999999999.99", "25000.00", "10000.00", "10000.00"],
        [f"{i * 777 % 40000}.{i % 100:02d}" for i in range(1001)],
        [f"{i * 777 % 40000}.{i % 100:02d}" for i in range(1000)],
    ],
)
def test_the_median_of_all_amounts_is_exact(spark, amounts):
    rows = [(f"O{i}", "NL", a and Decimal(a)) for i, a in enumerate(amounts)]
    orders = spark.createDataFrame(rows, "order_id string, country string, order_value_eur decimal(12,2)")
    got = {r.series: r for r in audits.noise_utility_total(orders, "salt").collect()}
    values = [Decimal(a) for a in amounts if a]
    assert got["original"].median_value == pytest.approx(float(statistics.median(values)), rel=1e-15)
    noised = audits._noised(orders, "salt").where("noised is not null").collect()
    assert got["noised"].median_value == pytest.approx(float(statistics.median(r.noised for r in noised)), rel=1e-15)
    assert got["original"].orders == len(values) and got["original"].total_value == sum(values)
    assert (got["original"].min_value, got["original"].max_value) == (min(values), max(values))
