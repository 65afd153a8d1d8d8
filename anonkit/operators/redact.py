"""Redact free text in tables and measure what is left.

A redaction needs nothing but its own row, so none of these jobs shuffles
before the final counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anonkit.functions.text import (
    KNOWN_VALUE_LABELS,
    LABELS,
    RULES,
    Rule,
    holds_birth_date,
    holds_token,
    labels_in,
    redact_known_birth_date,
    redact_known_values,
    redact_rules,
)


def redact_column(df: DataFrame, column: str, output: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``output``: the whole text of ``column`` after all rules."""
    return df.withColumn(output, redact_rules(F.col(column), rules))


def redacted_note(note: Column, birth_date: Column | None = None) -> Column:
    """The note without the known values of its row, its birth date if given, and without what the rules find.

    NULL for a missing or empty note.
    """
    known = redact_known_values(note)
    return F.when(note != "", redact_rules(known if birth_date is None else redact_known_birth_date(known, birth_date)))


def pending(note: Column, done: Column) -> Column:
    """A note that has text and no result yet."""
    return (note != "") & (done.isNull() | (done == ""))


def redact_notes(orders: DataFrame, note: str = "customer_notes", done: str = "customer_notes_anonymized") -> DataFrame:
    """Redact the pending notes of a table, keep earlier results, drop the raw notes.

    A note whose redaction gives NULL stays pending; its raw text is never
    passed on in its place.
    """
    redacted = redacted_note(F.col(note), F.col("birth_date") if "birth_date" in orders.columns else None)
    if done in orders.columns:
        redacted = F.when(pending(F.col(note), F.col(done)), redacted).otherwise(F.col(done))
    return orders.withColumn(done, redacted).drop(note)


def label_counts(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Per group and label: how often it was put in, and into how many texts.

    Labels that the text held before are not counted. A text that redaction
    left as it was is not searched.
    """
    changed = redact_column(df.select(*by, column), column, "_redacted").select(
        *by, column, "_redacted", (F.col("_redacted") != F.col(column)).alias("_changed")
    )
    found = changed.select(
        *by,
        F.when(F.col("_changed"), labels_in(F.col("_redacted"))).alias("_after"),
        F.when(F.col("_changed"), labels_in(F.col(column))).alias("_before"),
    )

    def count(labels: str, label: str) -> Column:
        return F.coalesce(F.array_size(F.filter(labels, lambda x: x == label)), F.lit(0)).cast("bigint")

    names = [label[1:-1] for label in LABELS]
    hits = found.select(*by, *[(count("_after", lb) - count("_before", lb)).alias(n) for n, lb in zip(names, LABELS)])
    sums = [F.sum(n).alias(f"{n}_hits") for n in names]
    texts = [F.count_if(F.col(n) > 0).alias(f"{n}_texts") for n in names]
    stacked = ", ".join(f"'[{n}]', {n}_hits, {n}_texts" for n in names)
    return (
        hits.groupBy(*by)
        .agg(*sums, *texts)
        .selectExpr(*by, f"stack({len(names)}, {stacked}) as (label, hits, texts)")
    )


def audit_redaction_precision(orders: DataFrame, truth: dict[str, Column], note: str = "customer_notes") -> DataFrame:
    """Per label, for notes of which ``truth`` says how many values each holds: right, missed and false labels.

    A false label stands on something that is not personal, such as an order date or a version.
    """
    notes = orders.where(F.col(note) != "")
    expected = [count.alias(f"e{i}") for i, count in enumerate(truth.values())]
    found = notes.select(*expected, labels_in(redacted_note(F.col(note), F.col("birth_date"))).alias("_found"))

    def times(label: str) -> Column:
        return F.array_size(F.filter("_found", lambda x: x == label))

    measures, stacked = [], []
    for i, label in enumerate(truth):
        e, f = F.col(f"e{i}"), times(label)
        measures += [
            F.sum(e).alias(f"x{i}"),
            F.sum(F.least(e, f)).alias(f"r{i}"),
            F.sum(F.greatest(e - f, F.lit(0))).alias(f"m{i}"),
            F.sum(F.greatest(f - e, F.lit(0))).alias(f"f{i}"),
        ]
        stacked.append(f"'{label}', x{i}, r{i}, m{i}, f{i}")
    return found.agg(*measures).selectExpr(
        f"stack({len(truth)}, {', '.join(stacked)}) as (label, expected, right_labels, missed, false_labels)"
    )


def audit_redaction(orders: DataFrame, note: str = "customer_notes") -> DataFrame:
    """Per label: notes that hold a value of their own row, and how many still show it.

    ``visible_after_rules`` is what the patterns alone would leave; their recall
    is one minus its share. ``visible_after_redaction`` must be 0. Only notes
    that hold a value are redacted, as the others count nowhere.
    """
    shown = {column: (label, lambda text, c=column: holds_token(text, F.col(c))) for column, label in KNOWN_VALUE_LABELS}
    shown["birth_date"] = ("[DOB]", lambda text: holds_birth_date(text, F.col("birth_date")))
    text = orders.where(F.col(note) != "").select(note, *shown)
    text = text.withColumns({f"_in_{column}": holds(F.col(note)) for column, (_, holds) in shown.items()})
    text = text.where(F.array_contains(F.array(*[f"_in_{column}" for column in shown]), True))
    text = redact_column(text, note, "_by_rules").withColumn("_redacted", redacted_note(F.col(note), F.col("birth_date")))
    measures = []
    for column, (_, holds) in shown.items():
        measures += [
            F.count_if(f"_in_{column}").alias(f"{column}_raw"),
            F.count_if(holds(F.col("_by_rules"))).alias(f"{column}_rules"),
            F.count_if(holds(F.col("_redacted"))).alias(f"{column}_done"),
        ]
    stacked = ", ".join(
        f"'{label}', '{column}', {column}_raw, {column}_rules, {column}_done" for column, (label, _) in shown.items()
    )
    return text.agg(*measures).selectExpr(
        f"stack({len(shown)}, {stacked})"
        " as (label, source_column, notes_with_value, visible_after_rules, visible_after_redaction)"
    )
