"""k-anonymity against brute force, with NULL attributes and one group that holds a third of all rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from anonkit.operators import kanon
from anonkit.schema import Policy

QIS = ["gender", "country", "age_range", "postal_prefix"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(6000):
        if i % 3 == 0:
            attributes = ("M", "Spain", "30-39", "28")
        else:
            attributes = (
                rng.choice(["M", "F", "Other"]),
                rng.choice(["Spain", "Ireland"]),
                rng.choice([None, "20-29", "30-39", "80-89"]) if rng.random() > 0.02 else "10-19",
                rng.choice([None, "28", "29", "N2"]),
            )
        # a hot person, and people seen with changing attributes
        person = "C0" if i % 3 == 1 else f"C{rng.randrange(900)}"
        out.append((person, *attributes))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, " + ", ".join(f"{q} string" for q in QIS))


def sizes(rows, count):
    people = defaultdict(set)
    for person, *attributes in rows:
        people[tuple(attributes[:count])].add(person)
    return {group: len(ids) for group, ids in people.items()}


@pytest.mark.parametrize("count", [1, 2, 3, 4])
@pytest.mark.parametrize("k", [5, 40])
def test_violations(table, rows, count, k):
    got = {tuple(r)[:-1]: r.people for r in kanon.k_violations(table, QIS[:count], k=k).collect()}
    assert got == {g: n for g, n in sizes(rows, count).items() if n < k}


def test_summary_equals_single_checks(table, rows):
    levels = {f"first {n}": QIS[:n] for n in (1, 2, 3, 4)} | {"last": QIS[3:], "again": QIS[:2]}
    got = {r.level: (r.groups, r.violating_groups) for r in kanon.k_summary(table, levels, k=40).collect()}
    for n in (1, 2, 3, 4):
        all_sizes = sizes(rows, n)
        assert got[f"first {n}"] == (len(all_sizes), sum(s < 40 for s in all_sizes.values()))
    assert got["again"] == got["first 2"] and got["last"][0] == 4


def test_summary_of_an_empty_table_has_its_rows(table):
    got = kanon.k_summary(table.where("false"), {"one": ["gender"], "two": ["gender", "country"]}).collect()
    assert [(r.level, r.groups, r.violating_groups) for r in got] == [("one", 0, 0), ("two", 0, 0)]


@pytest.mark.parametrize("k", [5, 40, 10_000])
def test_suppression_leaves_a_k_anonymous_table(table, rows, k):
    got = sorted((tuple(r) for r in kanon.suppress_small_groups(table, QIS, k=k).collect()), key=str)
    size = sizes(rows, 4)
    assert got == sorted((r for r in rows if size[tuple(r[1:])] >= k), key=str)


def test_unique_prefixes_are_hidden(spark):
    codes = ["28001", "28002", "28002", "SW1A", "SW1A", None, "9", "N2", "N2"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, postal_code string")

    def prefixes(**options):
        return [r.postal_prefix for r in kanon.suppress_unique_prefix(df, **options).orderBy("i").collect()]

    assert prefixes() == ["28", "28", "28", None, None, None, None, None, None]
    assert prefixes(replacement="REDACTED")[3:6] == ["REDACTED", "REDACTED", None]
    assert prefixes(keep=1) == ["2", "2", "2", None, None, None, None, None, None]


def test_reference_shape(orders):
    import datetime as dt

    qi = kanon.with_quasi_identifiers(orders, Policy(noise_salt="s", as_of=dt.date(2026, 1, 1)))
    counts = [r.violating_groups for r in kanon.k_summary(qi).orderBy("level").collect()]
    assert counts == sorted(counts)
    assert qi.select(F.countDistinct("age_range")).first()[0] > 3
