"""Birth dates that stand far from their birth word, before it, or without one."""

import time

from pyspark.sql import functions as F

from anonkit.operators import redact

PAIRS = {
    "born in the city of Amsterdam on 1980-02-03": "born in the city of Amsterdam on [DOB]",
    "date of birth (as in the passport shown): 1980-02-03": "date of birth (as in the passport shown): [DOB]",
    "date of birth of [NAME], customer 17, was 03/02/1980.": "date of birth of [NAME], customer 17, was [DOB].",
    "born to a stubborn father on 1980-02-03": "born to a stubborn father on [DOB]",
    "1980-02-03 is my date of birth": "[DOB] is my date of birth",
    "On 3.2.1980 (birthday). Ordered 2024-05-01": "On [DOB] (birthday). Ordered 2024-05-01",
    "Ordered 2024-05-01, born 1980-02-03, sent 2024-05-02": "Ordered 2024-05-01, born [DOB], sent 2024-05-02",
    "Delivered 2024-05-01, birthday gift": "Delivered 2024-05-01, birthday gift",
    "order of 2020-01-01 was for the birth of a child": "order of 2020-01-01 was for the birth of a child",
    "3 February 1980 was her birthday": "[DOB] was her birthday",
    "born on February 3rd, 1980 in Lyon": "born on [DOB] in Lyon",
    "nacida el 3 de febrero de 1980": "nacida el [DOB]",
    "Geb. 03.02.1980, Kunde": "Geb. [DOB], Kunde",
    "née le 1er mars 1980": "née le [DOB]",
    "2024-05-01 (invoice), not a birthday": "2024-05-01 (invoice), not a birthday",
    "1980-02-03: date of birth of Ana Keller.": "[DOB]: date of birth of Ana Keller.",
    "born [DOB], sent 2024-05-02": "born [DOB], sent 2024-05-02",
    "She was born. Ordered 2024-05-01": "She was born. Ordered 2024-05-01",
    "2024-05-01 stubborn, 2024-05-02 reborn": "2024-05-01 stubborn, 2024-05-02 reborn",
}


def redacted(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.r for r in redact.redact_column(df, "t", "r").orderBy("i").collect()]


def test_far_and_reversed_dates(spark):
    once = redacted(spark, list(PAIRS))
    assert once == list(PAIRS.values())
    assert redacted(spark, once) == once


def test_long_sentences_take_linear_time(spark):
    far = "born " + "in a very long sentence " * 20_000
    assert redacted(spark, [far + "on 1980-02-03"]) == [far + "on [DOB]"]
    start = time.monotonic()
    long = ["2024-05-01 born " * 20_000, "born x " * 60_000, "2024-05-01 x " * 30_000 + "born", "1980-02-03 " + "born of " * 50_000]
    redacted(spark, long)
    assert time.monotonic() - start < 60


def test_known_birth_date_in_its_forms(spark):
    notes = ["from 1980-02-03 on", "3.2.1980", "02/03/1980", "03-02-1980", "13.2.1980", "on 1980-02-031", None]
    rows = [(i, n, None, None, None, None) for i, n in enumerate(notes)]
    schema = "i int, customer_notes string, email string, street_address string, full_name string, phone string"
    df = spark.createDataFrame(rows, schema)
    known = df.withColumn("birth_date", F.lit("1980-02-03").cast("date"))
    got = {r.i: r.customer_notes_anonymized for r in redact.redact_notes(known).collect()}
    assert list(got.values()) == ["from [DOB] on", "[DOB]", "[DOB]", "[DOB]", "13.2.1980", "on 1980-02-031", None]
    none = known.withColumn("birth_date", F.lit(None).cast("date"))
    assert redact.redact_notes(none).where("i = 0").first().customer_notes_anonymized == "from 1980-02-03 on"


def test_oracle_has_the_same_rules(spark):
    """The DuckDB rules are written apart, without look-around; both must agree."""
    import duckdb

    from anonkit.oracle.texts import by_rules

    texts = list(PAIRS) + [
        "born.1980-02-03", "born..on 1980-02-03", "Born in St.Gallen on 1980-02-03", "born 1980-02-03 or 1980-02-04",
        "[born 1980-02-03]", "born1980-02-03", "born; 1980-02-03", "reborn 1980-02-03", "1980-02-03birthday", "birthday 1980-02-031",
        "1980-02-03 birthday\n1981-02-03 is my birthday", "dob 1.2.1980 dob 2.2.1980", "1.2.1980 - birthday", "born é1980-02-03",
    ]
    expected = [duckdb.execute(f"SELECT {by_rules('t')} FROM (SELECT ? AS t)", [t]).fetchone()[0] for t in texts]
    assert redacted(spark, texts) == expected
