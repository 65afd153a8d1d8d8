"""Order MinHash fingerprints of whole texts, in native expressions only.

A text is cut into words, and each position starts a k-mer of ``WORDS`` words (shorter at the end). Equal k-mers are
numbered by occurrence, each (k-mer, occurrence) gets a hash, and the hash's leading bits deal it into one of ``BINS``
bins. The ``TUPLE`` least of a bin are put back in text order, and the k-mers in that order are hashed to the bin's
entry. The entries are the signature: two texts agree in a bin only if its least k-mers are the same and stand
in the same order, so that moved blocks and edits count, not only the set of words. (One hash with bins in
place of one hash per entry: each word is hashed once, whatever the number of entries.)

Occurrences are numbered by sorting (hash, position) and counting along each run of equal hashes, in time linear in
the text but for the sort; the position bits are as many as the text needs, the others hold the hash.

The next document is found by ranges of (id, text hash, row number): rows at range borders are also sent to the range
before theirs, marked as guests, and the first one to the last range. So one shuffle of the texts and a
window per range give each row its successor, and no range depends on another.

Defined cases: a null text is empty; empty texts and texts of white space have an empty fingerprint, which is like
another empty one (1) and unlike all others (0). Documents without id come first. Rows of one id follow each
other by the hash of their texts; repeated rows are documents of their own. The only document is its own successor. A
word of more than ``WORD_CHARS`` code points counts as several. An empty table gives no rows. Other columns have no effect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 3
BIN_BITS = 6
TUPLE = 2
WORD_CHARS = 24
SAMPLE_PER_RANGE = 20
MOST_RANGES = 2000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, though lambdas in ``body`` use it for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bin(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - BIN_BITS)


def _numbered(kmers: Column, mask: Column) -> Column:
    """Hash of each (k-mer, occurrence) in its leading bits, position in the bits of ``mask``."""

    def key(kmer: Column, occurrence: Column, place: Column) -> Column:
        return F.xxhash64(kmer, occurrence).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(place)

    once = F.transform(kmers, lambda h, i: key(h, F.lit(1), i.cast("bigint")))

    def repeated(ordered: Column) -> Column:
        def head(x: Column) -> Column:
            return x.bitwiseAND(F.bitwise_not(mask))

        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        starts = F.filter(places, lambda j: (j == 0) | (head(F.get(ordered, j)) != head(F.get(ordered, j - 1))))
        lengths = let(starts, lambda s: F.transform(s, lambda at, j: F.coalesce(F.get(s, j + 1), F.size(ordered)) - at))
        occurrences = F.flatten(F.transform(lengths, lambda n: F.sequence(F.lit(1), n)))

        def renamed(counts: Column) -> Column:
            return F.transform(
                ordered,
                lambda x, j: key(F.get(kmers, x.bitwiseAND(mask).cast("int")), F.get(counts, j), x.bitwiseAND(mask)),
            )

        return let(occurrences, renamed)

    packed = F.transform(kmers, lambda h, i: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("bigint")))
    return F.when(F.size(F.array_distinct(kmers)) == F.size(kmers), once).otherwise(let(F.sort_array(packed), repeated))


def _entries(kmers: Column, mask: Column, chosen: Column) -> Column:
    """One number for each bin that has k-mers: the bin, and 32 bits of the hash of its k-mers in text order."""

    def kmer(x: Column) -> Column:
        return F.get(kmers, x.bitwiseAND(mask).cast("int"))

    def entry(x: Column, j: Column) -> Column:
        before, after = F.get(chosen, j - 1), F.get(chosen, j + 1)

        def made(y: Column) -> Column:
            swapped = y.isNotNull() & (y.bitwiseAND(mask) < x.bitwiseAND(mask))
            value = F.when(swapped, F.xxhash64(kmer(y), kmer(x))).otherwise(F.xxhash64(kmer(x), kmer(y)))
            return F.shiftleft(_bin(x), 32).bitwiseOR(value.bitwiseAND(F.lit(0xFFFFFFFF)))

        first = (j == 0) | (_bin(before) != _bin(x))
        return F.when(first, let(F.when(_bin(after) == _bin(x), after), made))

    return F.filter(F.transform(chosen, entry), lambda e: e.isNotNull())


def signature(text: Column) -> Column:
    """Entries of a text, one for each bin in use, ``array<bigint>``."""
    pattern = f"[^\\x20\\x09-\\x0D]{{1,{WORD_CHARS}}}"
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))

    def of_words(w: Column) -> Column:
        kmers = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, WORDS)]))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(F.size(w)))) - F.lit(1).cast("bigint")

        def of_kmers(h: Column) -> Column:
            def of_mask(m: Column) -> Column:
                def of_sorted(keys: Column) -> Column:
                    least = F.filter(keys, lambda x, j: (j < TUPLE) | (_bin(F.get(keys, j - TUPLE)) != _bin(x)))
                    return let(least, lambda chosen: _entries(h, m, chosen))

                return let(F.sort_array(_numbered(h, m)), of_sorted)

            return let(mask, of_mask)

        return let(kmers, of_kmers)

    return let(words, of_words)


def as_text(entries: Column) -> Column:
    """A signature as a string: two hex digits of the bin and eight of its hash, bin after bin."""
    return F.array_join(F.transform(entries, lambda x: F.lpad(F.hex(x), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins that either signature uses in which both agree; 1 for two empty signatures."""
    bins = F.size(F.array_union(*[F.transform(s, lambda x: F.shiftright(x, 32)) for s in (a, b)]))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / bins)


def borders(rows: DataFrame, ranges: int) -> list[tuple]:
    """Keys (id, text hash, row number) at which ranges start, the least key first. They decide how even ranges are, no result."""
    least = rows.agg(F.min("at").alias("at")).first()["at"]
    if least is None:
        return []
    sample = rows.select("at").orderBy(F.xxhash64("at")).limit(ranges * SAMPLE_PER_RANGE).orderBy("at").collect()
    picked = [tuple(r["at"]) for r in sample[SAMPLE_PER_RANGE::SAMPLE_PER_RANGE]]
    return [tuple(least), *[key for key in picked if key != tuple(least)]]


def with_next(docs: DataFrame, key: str, text: str, *, ranges: int | None = None) -> DataFrame:
    """``id``, ``text`` and ``sig`` of each document, and ``next_text`` and ``next_sig`` of its successor by ``key``."""
    spark = docs.sparkSession
    ranges = min(ranges or int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), whole.alias("text"))
    # the row number keeps repeated rows apart; it needs a table whose rows come in the same tasks when read again
    at = F.struct("id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("n"))
    rows = rows.select("id", "text", at.alias("at"))
    starts = borders(rows, ranges)
    if not starts:
        return rows.where("false").select("id", "text", signature(F.col("text")).alias("sig")).withColumns(
            {"next_text": F.col("text"), "next_sig": F.col("sig")}
        )
    kind = rows.schema["at"].dataType
    fixed = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(s, kind, strict=True)]) for s in starts])
    own = F.size(F.filter(fixed, lambda s: s <= F.col("at"))) - 1
    dealt = rows.select("id", "text", "at", own.alias("range"), signature(F.col("text")).alias("sig"))
    home = F.struct(F.col("range"), F.lit(False).alias("guest"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(starts))).alias("range"), F.lit(True).alias("guest"))
    is_border = F.get(fixed, F.col("range")).eqNullSafe(F.col("at"))
    sent = dealt.select("id", "text", "at", "sig", F.explode(F.when(is_border, F.array(home, before)).otherwise(F.array(home))).alias("to"))
    order = Window.partitionBy("to.range").orderBy("to.guest", "at")
    following = F.lead(F.struct("text", "sig")).over(order)
    seen = sent.withColumn("next", following).where(~F.col("to.guest"))
    missing = F.raise_error(F.lit("a document has no successor: the table's rows changed between two reads"))
    next_text = F.coalesce(F.col("next.text"), missing.cast("string"))
    return seen.select("id", "text", "sig", next_text.alias("next_text"), F.col("next.sig").alias("next_sig"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", *, ranges: int | None = None) -> DataFrame:
    """Fingerprint of each text, of its edited text (last quarter from the next document), and how alike they are."""
    count = F.char_length("text")
    quarter = F.floor(count / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), count - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = with_next(docs, key, text, ranges=ranges).select(
        "id", count.cast("bigint").alias("n_chars"), "sig", "next_sig", edited.alias("edited")
    )
    rows = rows.select("id", "n_chars", "sig", "next_sig", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), signature(F.col("edited")).alias("edited_sig"))
    return rows.select(
        F.col("id").alias(key),
        "n_chars",
        "edited_sha256",
        as_text(F.col("sig")).alias("fingerprint"),
        as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
