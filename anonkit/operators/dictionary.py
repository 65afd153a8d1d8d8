"""Redact the values of all people in all texts: a distributed dictionary match.

A text is cut into pieces that alternate between words and what stands between them. Runs of as many words as the values have
are looked up by an equi-join with the table of distinct values, so no text meets a value that it does not hold. Before anything
is shuffled, bit tables of a fixed size leave out runs that start as no value does, and then runs that are no value. Values that make up
more than a thousandth of all finds are dealt out by salts. Finds go back to their texts and are replaced by position.

With one edit allowed, a run and a value meet if they are equal after one sign is left out of each (or of none): any two strings within
one insertion, deletion or replacement share such a form. The edit distance of each meeting is then computed. This is done for each
distinct string among the runs, not for each run; the runs are joined with the outcome as with the values themselves. Edits that
add or remove a whole separator change the number of words and are not found. Any other edit leaves the first or the second word as it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anonkit.sources.scratch import as_table

_WORD = r"[\p{L}\p{N}_]"
_BETWEEN = r"[^\p{L}\p{N}_]"
HOT_SHARE = 1000  # a value with more than this part of all finds is salted; so there are at most as many hot values
SALTS = 64
BITS = 1 << 24  # of each filter before a shuffle: 4 MB at most; more values only let more runs through

# Columns whose values are looked for in all texts, with their label.
VALUE_COLUMNS = (("email", "[EMAIL]"), ("street_address", "[ADDRESS]"), ("full_name", "[NAME]"), ("phone", "[PHONE]"))


def value_table(people: DataFrame, columns: tuple[tuple[str, str], ...] = VALUE_COLUMNS, least_signs: int = 7) -> DataFrame:
    """Distinct values with ``label``, ``core`` (first to last word), ``lead`` (signs before it) and ``words``.

    One-word values of fewer than ``least_signs`` letters and digits are left out: they would stand in texts of all kinds.
    A core that has several labels keeps the first one of ``columns``.
    """
    stacked = people.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(label).alias("label"), F.col(c).alias("value")) for i, (c, label) in enumerate(columns)]))
    )
    cut = stacked.distinct().select(
        "rank",
        "label",
        F.regexp_extract("value", rf"^({_BETWEEN}*)", 1).alias("lead"),
        F.regexp_replace("value", rf"^{_BETWEEN}+|{_BETWEEN}+$", "").alias("core"),
    )
    words = F.regexp_count("core", F.lit(rf"{_WORD}+"))
    kept = cut.withColumn("words", words).where((F.col("words") > 1) | (F.length("core") >= least_signs))
    single = kept.groupBy("core", "words").agg(F.min(F.struct("rank", "label", "lead")).alias("first"))
    return single.select("core", "words", "first.label", "first.lead")


def _cut(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"{_WORD}++|{_BETWEEN}++"), F.lit(0))


def _forms(core: Column) -> Column:
    """The string itself and the string without each of its signs."""
    left_out = F.transform(
        F.sequence(F.lit(1), F.length(core)), lambda i: F.concat(F.left(core, i - 1), F.substring(core, i + 1, F.length(core)))
    )
    return F.array_distinct(F.concat(F.array(core), left_out))


def _slot(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BITS))


def _bits(slots: DataFrame) -> DataFrame:
    """Which values ``slot`` has: 64 bits a row, so at most ``BITS / 64`` rows, however many slots there are."""
    bit = F.expr("shiftleft(1L, cast(slot % 64 as int))")
    return slots.groupBy((F.shiftright("slot", 6)).alias("_row")).agg(F.bit_or(bit).alias("_bits"))


def _looked_up(df: DataFrame, slot: Column, bits: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: whether the bit of ``slot`` is set. It is for all that have it, and for few others while most bits are not."""
    found = df.withColumn("_slot", slot)
    joined = found.join(F.broadcast(bits), F.shiftright("_slot", 6) == F.col("_row"), "left")
    held = F.coalesce(F.getbit("_bits", (F.col("_slot") % 64).cast("int")) == 1, F.lit(False))
    return joined.withColumn(name, held).drop("_slot", "_row", "_bits")


def _starts(first: Column, between: Column, second: Column, edits: int) -> list[Column]:
    """Slots of a run of several words: its first word, separator and kind of second word, or either word if one may be edited."""
    if edits:
        return [_slot(F.lit("first"), first), _slot(F.lit("second"), second)]
    kind = F.ascii(second)
    return [_slot(F.lit("both"), first, F.left(between, F.lit(1)), (kind < 58).cast("int") + (kind < 91).cast("int"))]


def runs(texts: DataFrame, text: str, keys: list[str], values: DataFrame, edits: int = 0) -> DataFrame:
    """Runs of words that may be a value: ``keys``, ``at`` and ``until`` (pieces, from 1), ``core``."""
    lengths = sorted(row["words"] for row in values.select("words").distinct().collect())  # a handful of numbers
    if not lengths:
        return texts.where("false").select(*keys, F.lit(0).alias("at"), F.lit(0).alias("until"), F.lit("").alias("core"))
    seen = values.select("words", _cut(F.col("core")).alias("pieces"))
    starts = F.array(*_starts(*(F.get("pieces", F.lit(i)) for i in range(3)), edits))
    several = seen.where("words > 1").select(F.explode(starts).alias("slot"))
    single = seen.where("words = 1").select(_slot(F.lit("single"), F.get("pieces", F.lit(0))).alias("slot"))
    bits = _bits(several.unionByName(single))

    cut = texts.select(*keys, _cut(F.col(text)).alias("_pieces"))
    first, size = F.when(F.get("_pieces", F.lit(0)).rlike(rf"^{_WORD}"), 0).otherwise(1), F.size("_pieces")
    # a row per word; for an explode of the array itself Spark adds filters that cut the text again
    places = cut.select("*", F.explode(F.when(first < size, F.sequence(first, size - 1, F.lit(2)))).alias("_at"))
    around = [F.get("_pieces", F.col("_at") + i) for i in range(3)]
    of_several, of_one = F.lit(False), F.lit(False)
    if lengths[-1] > 1:
        for i, slot in enumerate(_starts(*around, edits)):
            places = _looked_up(places, slot, bits, f"_held{i}")
            of_several = of_several | F.col(f"_held{i}")
    if lengths[0] == 1 and edits:
        of_one = F.lit(True)  # an edit may be anywhere in the only word
    elif lengths[0] == 1:
        places = _looked_up(places, _slot(F.lit("single"), around[0]), bits, "_single")
        of_one = F.col("_single")
    held = places.where(of_several | of_one).withColumn("_words", F.explode(F.array(*[F.lit(n) for n in lengths])))
    signs = F.col("_words") * 2 - 1
    held = held.where((F.col("_at") + signs <= F.size("_pieces")) & F.when(F.col("_words") > 1, of_several).otherwise(of_one))
    core = F.array_join(F.slice("_pieces", F.col("_at") + 1, signs), "")
    return held.select(*keys, (F.col("_at") + 1).alias("at"), (F.col("_at") + signs).alias("until"), core.alias("core"))


def _form_slot() -> Column:
    return _slot(F.lit("form"), F.col("form"))


def _near_a_value(left: DataFrame, forms: DataFrame) -> DataFrame:
    """``left`` without the words, taken alone, that share no form with a value; all runs of several words stay."""
    several = F.col("until") > F.col("at")
    tried = left.withColumn("form", F.explode(F.when(several, F.array("found")).otherwise(_forms(F.col("found")))))
    return _looked_up(tried, _form_slot(), forms, "_held").where(several | F.col("_held")).drop("form", "_held")


def _near(found: DataFrame, values: DataFrame, forms: DataFrame) -> DataFrame:
    """Each string of ``found`` with the values within one edit. Both are distinct, so few of either share a form."""
    left = found.select("found", F.explode(_forms(F.col("found"))).alias("form"))
    left = _looked_up(left, _form_slot(), forms, "_held").where("_held").drop("_held")
    right = values.select(F.col("core").alias("value"), "label", "lead", F.explode(_forms(F.col("core"))).alias("form"))
    met = left.join(right, "form").drop("form").distinct()
    return met.withColumn("distance", F.levenshtein("found", "value")).where("distance <= 1")


def finds(texts: DataFrame, text: str, keys: list[str], values: DataFrame, edits: int = 0) -> DataFrame:
    """``keys``, ``at``, ``until``, ``found`` and the ``value`` it stands for, with ``label``, ``lead`` and ``distance``."""
    if edits not in (0, 1):
        raise ValueError("edits must be 0 or 1")
    values = as_table(values, "values")
    left = runs(texts, text, keys, values, edits).withColumnRenamed("core", "found")
    right = values.select(F.col("core").alias("found"), F.col("core").alias("value"), "label", "lead", F.lit(0).alias("distance"))
    if edits:
        forms = _bits(values.select(F.explode(_forms(F.col("core"))).alias("form")).select(_form_slot().alias("slot")))
        left = as_table(_near_a_value(left, forms), "candidates")
        right = as_table(_near(left.select("found").distinct(), values, forms), "near")
    slot = _slot(F.lit("found"), F.col("found"))
    left = _looked_up(left, slot, _bits(right.select(slot.alias("slot"))), "_held").where("_held").drop("_held")
    left = as_table(left, "runs")  # texts are cut once
    # how often each string that stands for a value is found: a row per string, however many texts hold it
    counted = as_table(left.groupBy("found").count().join(right.select("found").distinct(), "found", "left_semi"), "lookups")
    total = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    hot = counted.where(F.col("count") * HOT_SHARE > total).select("found", F.lit(True).alias("hot"))  # HOT_SHARE rows at most
    spread = F.pmod(F.xxhash64(*keys, "at"), F.lit(SALTS)).cast("int")
    left = left.join(F.broadcast(hot), "found", "left").withColumn("salt", F.when(F.col("hot"), spread).otherwise(0))
    right = right.join(F.broadcast(hot), "found", "left").withColumn(
        "salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    )
    met = left.drop("hot").join(right.drop("hot"), ["found", "salt"])
    return met.select(*keys, "at", "until", "found", "value", "label", "lead", "distance").distinct()


def redact_values(
    texts: DataFrame, text: str, keys: list[str], values: DataFrame, output: str = "redacted", edits: int = 0
) -> DataFrame:
    """``texts`` with ``output``: the text with every value of the table replaced by its label.

    ``keys`` name a text. Values that overlap are replaced together, by the label of the one that starts first, among these
    of the longest. The signs before a value's first word (such as + or a bracket) go with it. NULL stays NULL.
    """
    marked = texts.withColumn("_h", F.xxhash64(text))  # two texts under one name keep their own finds
    own = [*keys, "_h"]
    hit = F.struct("at", (-F.col("until")).alias("until"), "distance", "label", "lead")
    hits = finds(marked, text, own, values, edits).groupBy(*own).agg(F.sort_array(F.collect_list(hit)).alias("_hits"))
    hits = hits.select("_hits", *[F.col(k).alias(f"_hit_{k}") for k in own])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hit_{k}")) for k in own])
    joined = marked.join(hits, same, "left").select(*texts.columns, "_hits")

    def replaced(pieces: Column) -> Column:
        def join(a: Column, n: Column) -> Column:
            return F.array_join(F.slice(pieces, a, n), "")

        def step(done: Column, h: Column) -> Column:
            until = -h["until"]
            before = join(done["next"], h["at"] - done["next"])
            kept = F.when((h["lead"] != "") & F.endswith(before, h["lead"]), F.left(before, F.length(before) - F.length(h["lead"])))
            added = F.struct(
                F.concat(done["text"], F.coalesce(kept, before), h["label"]).alias("text"), (until + 1).alias("next")
            )
            covered = F.struct(done["text"].alias("text"), F.greatest(done["next"], until + 1).alias("next"))
            return F.when(h["at"] < done["next"], covered).otherwise(added)

        start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))
        return F.aggregate("_hits", start, step, lambda d: F.concat(d["text"], join(d["next"], F.size(pieces))))

    new = F.get(F.transform(F.array(_cut(F.col(text))), replaced), F.lit(0))
    return joined.withColumn(output, F.when(F.col("_hits").isNull(), F.col(text)).otherwise(new)).drop("_hits")
