"""Choices of columns and levels, median cuts, linkage: against brute force on small tables."""

import random
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from anonkit.operators import generalize as G


def rows(n, seed, hot=False):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        person = 0 if hot and i % 3 == 0 else rng.randrange(n // 3)
        own = random.Random(person)
        out.append((person, own.choice("MF"), own.choice(["ES", "FR", None]), own.randrange(18, 76), own.choice(["10115", "10117", "20095", None])))
    return out


SCHEMA = "customer_id int, gender string, country string, age int, postal string"
LEVELS = {"gender": 1, "country": 1, "age": 2, "postal": 2}


def levels():
    age, postal = F.col("age"), F.col("postal")
    return {
        "gender": [F.col("gender")],
        "country": [F.col("country")],
        "age": [F.floor(age / 20), F.floor(age / 10)],
        "postal": [F.substring(postal, 1, 1), F.substring(postal, 1, 4)],
    }


def seen(row, choice):
    _, gender, country, age, postal = row
    cut = lambda n: None if postal is None else postal[:n]
    steps = [[None, gender], [None, country], [None, age // 20, age // 10], [None, cut(1), cut(4)]]
    return tuple(s[n] for s, n in zip(steps, choice))


def brute(data, k, most_lost):
    passed = {}
    for choice in product(*[range(n + 1) for n in LEVELS.values()]):
        people, count = defaultdict(set), Counter()
        for row in data:
            people[seen(row, choice)].add(row[0])
            count[seen(row, choice)] += 1
        small = [g for g in people if len(people[g]) < k]
        lost = sum(count[g] for g in small)
        if lost <= most_lost * len(data):
            passed[choice] = (sum(choice), len(people), len(small), lost)
    finer = lambda a, b: a != b and all(x >= y for x, y in zip(a, b))
    return sorted((*c, *f) for c, f in passed.items() if not any(finer(d, c) for d in passed))


@pytest.mark.parametrize(("n", "k", "most_lost", "hot"), [(400, 5, 0.0, False), (400, 3, 0.05, True), (60, 10, 0.3, False), (12, 50, 0.0, False)])
def test_finest_sets_equal_all_choices(spark, n, k, most_lost, hot):
    data = rows(n, k, hot)
    got = G.finest_sets(spark.createDataFrame(data, SCHEMA), levels(), k=k, most_lost=most_lost)
    assert sorted(tuple(r) for r in got.collect()) == brute(data, k, most_lost)


def people(spark, data):
    return spark.createDataFrame(data, "customer_id int, age int, country int")


@pytest.mark.parametrize("k", [2, 5])
def test_median_groups(spark, k):
    rng = random.Random(k)
    data = [(i, 40 if i % 3 == 0 else rng.randrange(18, 76), rng.choice([1, 2, 3, None])) for i in range(300)]
    groups = {r["customer_id"]: r["group"] for r in G.median_groups(people(spark, data), ["age", "country"], k=k).collect()}
    assert set(groups) == set(range(300))
    sizes = Counter(groups.values())
    assert min(sizes.values()) >= k
    members = defaultdict(list)
    for i, age, country in data:
        members[groups[i]].append((age, country or 0))
    for group in members.values():  # no group could be cut further
        for values in zip(*group):
            for cut in set(values):
                assert min(sum(v <= cut for v in values), sum(v > cut for v in values)) < k
    assert len(sizes) > 300 / (8 * k)


def test_median_groups_of_few_and_equal_people(spark):
    few = G.median_ranges(people(spark, [(1, 20, 1), (2, 30, None)]), ["age", "country"], k=5).collect()
    assert [(r.people, r.age_from, r.age_to, r.country_from) for r in few] == [(2, 20, 30, 1)] * 2
    same = G.median_groups(people(spark, [(i, 20, 1) for i in range(50)]), ["age", "country"], k=5)
    assert {r["group"] for r in same.collect()} == {"1"}
    assert G.median_groups(people(spark, []), ["age"], k=5).count() == 0


def test_linkage_equals_all_pairs(spark):
    rng = random.Random(9)
    data = [(i % 3 and rng.randrange(30), rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice("pqr"), rng.choice("12")) for i in range(200)]
    shared = {"one": ["city"], "two": ["city", "kind"], "three": ["kind", "way"]}
    df = spark.createDataFrame([(p, city, kind, way, n) for p, city, kind, way, n in data], "customer_id int, city string, kind string, way string, n string")
    at = {"city": 1, "kind": 2, "way": 3}
    expected = Counter()
    for row in data:
        fits = [{o[0] for o in data if all(o[at[c]] == row[at[c]] for c in columns)} for columns in shared.values()]
        expected[len(set.intersection(*fits))] += 1
    assert {r.candidates: r.view_rows for r in G.linkage_audit(df, shared).collect()} == expected
