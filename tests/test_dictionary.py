"""Values of all people in all texts, against every pair of value and text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from anonkit.operators import dictionary as D

COLUMNS = (("email", "[EMAIL]"), ("full_name", "[NAME]"), ("phone", "[PHONE]"))
PEOPLE = [
    ("ana.keller7@mail.example", "Ana Keller", "+34 900000007"),
    ("no-at-sign", "Juan Carlos García Núñez", "(0174)-079190"),
    (None, "Juan Carlos", "123"),
    ("a@x.example", "Madonna", None),
    ("", "O'Neill-Smith", "255.901.0007"),
    ("ana.keller7@mail.example", "Ana Keller", "+34 900000007"),
]
TEXTS = {
    "Ana Keller called": "[NAME] called",
    "call Ana Keller, Ana Keller or Ana  Keller": "call [NAME], [NAME] or Ana  Keller",
    "Juan Carlos García Núñez and Juan Carlos": "[NAME] and [NAME]",
    "xAna Keller, Ana Kellers, ana keller, Ana Keller_": "xAna Keller, Ana Kellers, ana keller, Ana Keller_",
    "to ana.keller7@mail.example.": "to [EMAIL].",
    "from +34 900000007 or 34 900000007 or (0174)-079190)": "from [PHONE] or [PHONE] or [PHONE])",
    "123 Madonna 123": "123 [NAME] 123",
    "no-at-sign a@x.example O'Neill-Smith": "[EMAIL] [EMAIL] [NAME]",
    "Juan Carlos García": "[NAME] García",
    "Ana Keller Juan Carlos García Núñez": "[NAME] [NAME]",
    "255.901.0007": "[PHONE]",
    "Ana Keller": "[NAME]",
    "nobody is here": "nobody is here",
    "": "",
    "...": "...",
}


def people(spark, rows=PEOPLE):
    return spark.createDataFrame(rows, "email string, full_name string, phone string")


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, note string")


def redacted(spark, values, table, edits=0):
    df = D.redact_values(texts(spark, values).withColumn("at", F.lit("clash")), "note", ["id"], table, edits=edits)
    return [r.redacted for r in df.orderBy("id").collect()]


def test_values_of_others(spark):
    table = D.value_table(people(spark), COLUMNS)
    assert redacted(spark, [*TEXTS, None], table) == [*TEXTS.values(), None]
    assert redacted(spark, ["Ana Keller"], D.value_table(people(spark, []), COLUMNS)) == ["Ana Keller"]
    assert D.redact_values(texts(spark, []), "note", ["id"], table).count() == 0


def test_repeated_texts_under_one_name(spark):
    table = D.value_table(people(spark), COLUMNS)
    df = spark.createDataFrame([(1, "Ana Keller"), (1, "Ana Keller"), (1, "the Ana Keller"), (None, "Madonna")], "id int, note string")
    got = sorted(r.redacted for r in D.redact_values(df, "note", ["id"], table).collect())
    assert got == ["[NAME]", "[NAME]", "[NAME]", "the [NAME]"]


def brute(values, texts):
    """Every value against every text."""
    word, out = r"[^\W]", {}
    for i, text in enumerate(texts):
        for value in values:
            for m in re.finditer(rf"(?<!{word}){re.escape(value)}(?!{word})", text):
                out.setdefault(i, set()).add((m.start(), value))
    return out


@pytest.mark.parametrize("hot_share", [1000, 3])
def test_equals_all_pairs(spark, monkeypatch, hot_share):
    monkeypatch.setattr(D, "HOT_SHARE", hot_share)  # at 3, the name in a third of the texts is salted
    rng = random.Random(4)
    firsts, lasts = ["Ana", "Liam", "Zoë", "Jean Luc"], ["Keller", "Murphy", "de Vries", "O'Hara"]
    names = [f"{f} {last}" for f in firsts for last in lasts]
    people_rows = [(None, n, None) for n in names[:-3]]
    filler = ["met", "and", "Ana", "Keller", "the", "de", "Vries", "Luc", ",", "O'Hara"]
    values = [" ".join(rng.choice([*filler, rng.choice(names), "Ana Keller" if i % 3 == 0 else "x"]) for _ in range(30)) for i in range(90)]
    table = D.value_table(people(spark, people_rows), COLUMNS)
    found = D.finds(texts(spark, values), "note", ["id"], table)
    got = {}
    for r in found.collect():
        pieces = re.findall(r"\w+|\W+", values[r.id])
        got.setdefault(r.id, set()).add((len("".join(pieces[: r["at"] - 1])), r.found))
    assert got == brute(names[:-3], values)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_one_edit(spark):
    names = ["Ana Keller", "Ana Kellar", "Liam Murphy", "Zoë Smith"]
    table = D.value_table(people(spark, [(None, n, None) for n in names]), COLUMNS)
    said = ["Ana Keller", "Ana Keler", "ana Keller", "Anna Keller", "An Keller", "Ana Kxller", "Ana Kellxr", "Ana Kelelr", "Liam Murphys"]
    said += ["Liam murphy", "Zoe Smith", "Zo Smith", "Ana Smith", "Xliam Murphy", "Lian Murphi", "the Ana Keller"]
    found = D.finds(texts(spark, said), "note", ["id"], table, edits=1).collect()
    got = {(said[r.id], r.found, r.value, r.distance) for r in found}
    runs = {(s, " ".join(p)) for s in said for w in [s.split()] for p in zip(w, w[1:])}
    assert got == {(s, p, n, edit_distance(p, n)) for s, p in runs for n in names if edit_distance(p, n) <= 1}
    assert redacted(spark, ["signed Ana Keler and Zo Smith."], table, edits=1) == ["signed [NAME] and [NAME]."]


def test_native_and_no_pairs(spark):
    table = D.value_table(people(spark), COLUMNS)
    plan = D.redact_values(texts(spark, list(TEXTS)), "note", ["id"], table)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Cartesian", "NestedLoop"):
        assert word not in plan


def test_runs_that_only_look_like_a_value_are_left_out(spark):
    table = D.value_table(people(spark), COLUMNS)
    said = ["Bob Stone met Eve Hill (0175)-079190 eve.stone7@mail.example", "...", "", None, "Ana Keller"]
    got = [(r.id, r["at"], r.until, r.core) for r in D.runs(texts(spark, said), "note", ["id"], table).collect()]
    assert got == [(4, 1, 3, "Ana Keller")]


def test_full_bit_tables_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(D, "BITS", 64)
    table = D.value_table(people(spark), COLUMNS)
    assert redacted(spark, [*TEXTS, None], table) == [*TEXTS.values(), None]


def test_runs_one_edit_away_only(spark):
    table = D.value_table(people(spark, [(None, n, None) for n in ("Ana Keller", "Juan Carlos Núñez", "Madonna")]), COLUMNS)
    said = ["Bob Stone met Eve Hill Hilton", "Ana-Keller", "Juan  Carlos Núñez", "Juna Carlos Nuñez", "Madona"]
    pairs = {r.core for r in D.runs(texts(spark, said[:1]), "note", ["id"], table, edits=1).collect()}
    assert pairs == {"Bob", "Stone", "met", "Eve", "Hill", "Hilton"}  # of one word, where the edit may be anywhere
    found = {(r.found, r.value, r.distance) for r in D.finds(texts(spark, said), "note", ["id"], table, edits=1).collect()}
    assert found == {("Ana-Keller", "Ana Keller", 1), ("Juan  Carlos Núñez", "Juan Carlos Núñez", 1), ("Madona", "Madonna", 1)}


def test_a_find_is_one_row_however_many_forms_it_has(spark, monkeypatch):
    written = {}

    def counted(df, label, as_table=D.as_table):
        out = as_table(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(D, "as_table", counted)
    table = D.value_table(people(spark, [(None, "Ana Keller", None), (None, "Madonna", None)]), COLUMNS)
    said = ["Ana Keller and Ana Keler"] * 5 + ["Ana met Bob Keller"] * 4
    found = D.finds(texts(spark, said), "note", ["id"], table, edits=1).collect()
    assert len(found) == written["runs"] == 10
    assert written["lookups"] == written["near"] == 2
    hot = D.finds(texts(spark, ["Madona", "Maddona", "madonna"] * 3), "note", ["id"], table, edits=1).collect()
    assert {(r.found, r.value) for r in hot} == {("Madona", "Madonna"), ("madonna", "Madonna")} and len(hot) == 6
