"""All queries by name.

Each takes a session and the folder of the test tables, starts from the whole
order table (or the whole texts) and returns a DataFrame. At this boundary
decimals become doubles, integers become bigint, and dates and times become ISO
text, so that results of two engines can be compared value by value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anonkit.functions import masks, noise, text
from anonkit.functions.keyed import bernoulli
from anonkit.operators import anonymize, audits, collation, dictionary, generalize, incremental, kanon, profile, redact, stored
from anonkit.plans import behavior, demographic, geo, product, views
from anonkit.schema import Policy
from anonkit.sources import csv, tables
from anonkit.sources.orders import COUNTRIES, GENDERS, gen_orders, note_truth, orders_flat
from anonkit.sources.scratch import fresh_dir
from anonkit.streaming import jobs

# The parameters of the registered queries.
AS_OF = dt.date(2026, 1, 1)
SALT = "salt"
SEED = "seed"
POLICY = Policy(noise_salt=SALT, as_of=AS_OF)
# One, two and three standard deviations of the Gaussian noise, and the share of draws within them.
SIGMAS = {"within_1": (0.025, 0.65, 0.715), "within_2": (0.05, 0.94, 0.97), "within_3": (0.075, 0.99, 1)}


@dataclass(frozen=True)
class Inputs:
    """The tables a query may start from; each is a plan until an action runs."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return tables.read_test_table(self.spark, self.sf_dir, name)

    def orders(self) -> DataFrame:
        return orders_flat(self.spark, self.sf_dir)

    def anonymized(self) -> DataFrame:
        return anonymize.anonymize_orders(self.orders(), POLICY)

    def view(self, name: str) -> DataFrame:
        return views.ALL_VIEWS[name](self.anonymized())

    def texts(self) -> DataFrame:
        """All free text: documents, conversation turns and order notes."""
        documents = self.table("documents").select(
            F.lit("document").alias("kind"), F.col("doc_id").cast("string").alias("text_id"), "lang", "text"
        )
        turns = self.table("conversations").select(
            F.lit("conversation").alias("kind"),
            F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("text_id"),
            F.lit("unknown").alias("lang"),
            "text",
        )
        # not a filter: Spark would put that below the join as well, and derive each note three times
        some = F.explode(F.when(F.col("customer_notes") != "", F.array("customer_notes")))
        notes = self.orders().select(
            F.lit("note").alias("kind"), F.col("order_id").alias("text_id"), F.lit("en").alias("lang"), some.alias("text")
        )
        return documents.unionByName(turns).unionByName(notes)

    def fresh_dir(self, label: str) -> str:
        return fresh_dir(self.spark, label)


Query = Callable[[Inputs], DataFrame]


def boundary(df: DataFrame) -> DataFrame:
    def shown(field: T.StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


# ---- sources, sinks, catalog ------------------------------------------------


def _csv_round_trip(inputs: Inputs, columns: list[str] | None = None) -> DataFrame:
    orders = inputs.orders() if columns is None else inputs.orders().select(*columns)
    path = inputs.fresh_dir("csv")
    csv.write_csv(orders, path)
    return csv.read_csv(inputs.spark, path, orders.schema)


def _csv_read_split(inputs: Inputs) -> DataFrame:
    """All orders in a file for each core, however large; a file is read by many tasks."""
    path = inputs.fresh_dir("csv")
    csv.write_csv(inputs.orders().coalesce(inputs.spark.sparkContext.defaultParallelism), path, max_records_per_file=0)
    return csv.read_csv_split(inputs.spark, path)


def _refreshed(inputs: Inputs) -> str:
    """Load twice: the second load must replace the first."""
    path = inputs.fresh_dir("refresh")
    tables.full_refresh(inputs.orders(), path)
    tables.full_refresh(inputs.orders(), path)
    return path


def _refreshed_table(inputs: Inputs) -> DataFrame:
    """Load a part, then all: the second load must replace the first."""

    def build() -> DataFrame:
        tables.refresh_table(inputs.orders().where(bernoulli(F.col("order_id"), 0.5, SEED)), "orders_with_notes")
        tables.refresh_table(inputs.orders(), "orders_with_notes")
        return tables.scan(inputs.spark, "orders_with_notes")

    return _in_new_database(inputs, build)


def _added_column(inputs: Inputs) -> DataFrame:
    def build() -> DataFrame:
        tables.create_table_as(inputs.anonymized(), "customers_orders_anonymized")
        for _ in range(2):
            tables.add_stored_column(inputs.spark, "customers_orders_anonymized", "customer_notes_anonymized")
        return tables.scan(inputs.spark, "customers_orders_anonymized").select("order_id", "customer_notes_anonymized")

    return _in_new_database(inputs, build)


def _reconcile(inputs: Inputs) -> DataFrame:
    return tables.reconcile(inputs.orders(), tables.scan(inputs.spark, _refreshed(inputs)))


def _table_scan(inputs: Inputs) -> DataFrame:
    tables.create_views({"customers_orders_with_notes": inputs.orders()})
    return tables.scan(inputs.spark, "customers_orders_with_notes")


def _in_new_database(inputs: Inputs, build: Callable[[], DataFrame]) -> DataFrame:
    """Run ``build`` with a new database current; the session gets its own one back."""
    location = inputs.fresh_dir("database")
    before = inputs.spark.catalog.currentDatabase()
    tables.use_database(inputs.spark, location.rsplit("/", 1)[-1].replace("-", "_"), location)
    try:
        return build()
    finally:
        inputs.spark.catalog.setCurrentDatabase(before)


def _create_table(inputs: Inputs) -> DataFrame:
    def build() -> DataFrame:
        for _ in range(2):
            tables.create_table_as(inputs.anonymized(), "customers_orders_anonymized")
        return tables.scan(inputs.spark, "customers_orders_anonymized")

    return _in_new_database(inputs, build)


def _use_database(inputs: Inputs) -> DataFrame:
    def build() -> DataFrame:
        tables.create_table_as(inputs.anonymized(), "segments")
        return inputs.spark.sql("SELECT customer_segment, count(*) AS orders FROM segments GROUP BY customer_segment")

    return _in_new_database(inputs, build)


def _session_views(inputs: Inputs) -> DataFrame:
    tables.create_views({name: inputs.view(name) for name in views.ALL_VIEWS})
    counts = [f"SELECT '{name}' AS view_name, count(*) AS view_rows FROM {name}" for name in views.ALL_VIEWS]
    return inputs.spark.sql(" UNION ALL ".join(counts))


# ---- increments -------------------------------------------------------------


def _pending(inputs: Inputs) -> DataFrame:
    orders = inputs.orders()
    finished = incremental.pick_rows(orders, 0.5, SEED)
    return incremental.pending_rows(orders, finished=finished).select("order_id", "customer_notes")


def _picked(inputs: Inputs) -> DataFrame:
    without_note = F.coalesce(F.col("customer_notes"), F.lit("")) == ""
    return incremental.pick_rows(inputs.orders(), 0.06, SEED, among=without_note).select("order_id", "customer_id")


def _updated(inputs: Inputs) -> DataFrame:
    orders = inputs.orders()
    updates = jobs.redacted_notes_only(orders).withColumnRenamed("customer_notes_anonymized", "customer_notes")
    base = orders.select("order_id", "customer_segment", "customer_notes")
    return incremental.update_by_key(base, updates, "order_id", ["customer_notes"])


def _order_months(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_month", F.date_format("order_date", "yyyy-MM"))


def _updated_partitions(inputs: Inputs) -> DataFrame:
    """A stored table by month, of which the notes of all orders before 1994 are redacted, twice with the same result."""
    orders, path = _order_months(inputs.orders()), inputs.fresh_dir("by-month")
    orders.select("order_id", "customer_segment", "customer_notes", "order_month").write.partitionBy("order_month").parquet(path)
    early = orders.where((F.col("order_month") < "1994") & (F.col("customer_notes") != ""))
    note = redact.redacted_note(F.col("customer_notes"), F.col("birth_date")).alias("customer_notes")
    for _ in range(2):
        stored.update_stored(inputs.spark, path, early.select("order_id", note), "order_id", ["customer_notes"], ["order_month"])
    return inputs.spark.read.parquet(path).withColumn("order_month", F.col("order_month").cast("string"))


def _updated_by_stream(inputs: Inputs) -> DataFrame:
    """A stored table by month whose column of redacted notes is filled as files of orders arrive."""
    orders = _order_months(inputs.orders())
    source, table, ledger, checkpoint = (inputs.fresh_dir(f"update-{part}") for part in ("source", "table", "ledger", "checkpoint"))
    empty = F.lit(None).cast("string").alias("customer_notes_anonymized")
    orders.select("order_id", empty, "order_month").write.partitionBy("order_month").parquet(table)
    early = bernoulli(F.col("order_id"), 0.5, SEED)
    for batch in (early, ~early):
        inputs.orders().where(batch).write.mode("append").parquet(source)
        jobs.update_notes_stream(inputs.spark, source, table, ledger, checkpoint)
    return inputs.spark.read.parquet(table).select("order_id", "customer_notes_anonymized")


def _arrivals(inputs: Inputs, process: Callable[[str, str, str], object]) -> DataFrame:
    """Let half of the orders arrive, process, let the rest arrive, process twice more."""
    source, sink, checkpoint = (inputs.fresh_dir(f"stream-{part}") for part in ("source", "sink", "checkpoint"))
    orders = inputs.orders()
    early = bernoulli(F.col("order_id"), 0.5, SEED)
    for batch in (orders.where(early), orders.where(~early)):
        batch.write.mode("append").parquet(source)
        process(source, sink, checkpoint)
    process(source, sink, checkpoint)
    return inputs.spark.read.parquet(sink)


def _stream_orders(inputs: Inputs) -> DataFrame:
    return _arrivals(inputs, lambda *dirs: jobs.anonymize_stream(inputs.spark, POLICY, *dirs))


def _stream_notes(inputs: Inputs) -> DataFrame:
    return _arrivals(inputs, lambda *dirs: jobs.redact_notes_stream(inputs.spark, *dirs))


_SOURCES: dict[str, Query] = {
    "src_csv_multiline": _csv_round_trip,
    "src_csv_split": _csv_read_split,
    "src_null_normalize": lambda i: csv.null_if_blank(
        i.orders().select("order_id", "email", "phone", "postal_code", "customer_notes")
    ),
    "src_fillna_notes": lambda i: incremental.fill_notes(i.orders()).select("order_id", "customer_notes"),
    "src_table": _table_scan,
    "sink_full_refresh": lambda i: tables.scan(i.spark, _refreshed(i)),
    "sink_refresh_table": _refreshed_table,
    "sink_reconcile": _reconcile,
    "sink_csv": lambda i: _csv_round_trip(i, ["order_id", "full_name", "customer_notes"]),
    "sink_ctas": _create_table,
    "sink_views": _session_views,
    "cat_describe": lambda i: profile.describe(i.view("view_geo_analysis")),
    "cat_use_db": _use_database,
    "cat_add_column": _added_column,
    "upd_by_key": _updated,
    "upd_by_key_partitions": _updated_partitions,
    "inc_pending": _pending,
    "inc_pick": _picked,
    "inc_checkpoint": _stream_notes,
    "inc_checkpoint_update": _updated_by_stream,
    "preview_sample": lambda i: profile.preview_sample(
        i.orders().where(F.col("customer_notes") != ""), 3, "order_id", SEED
    ).select("order_id", "full_name", "country", "customer_notes"),
    "profile_dataset": lambda i: profile.profile_dataset(i.orders()),
    "profile_notes_fill": lambda i: profile.profile_notes_fill(i.orders()),
    "gen_orders": lambda i: gen_orders(i.table("customer"), AS_OF, SEED),
    "stream_anonymize": _stream_orders,
}

# ---- column functions -------------------------------------------------------


def _column(source: str, name: str, function: Callable[[Column], Column]) -> Query:
    return lambda i: i.orders().select("order_id", source, function(F.col(source)).alias(name))


def _noise_difference(inputs: Inputs) -> DataFrame:
    value = F.col("order_value_eur")
    noised = inputs.orders().select(
        "order_id", value, noise.noise_uniform(value, F.col("order_id"), SALT).alias("noised_value")
    )
    return noised.withColumn("difference_percent", noise.difference_percent(value, F.col("noised_value")))


def _small_groups_removed(inputs: Inputs) -> DataFrame:
    age = masks.age_range(F.col("birth_date"), AS_OF).alias("age_range")
    rows = inputs.orders().select("order_id", "customer_id", "gender", "country", age)
    return kanon.suppress_small_groups(rows, ["gender", "country", "age_range"])


_COLUMNS: dict[str, Query] = {
    "mask_email_raw": _column("email", "masked_email", masks.mask_email_raw),
    "mask_email": _column("email", "masked_email", masks.mask_email),
    "mask_phone_raw": _column("phone", "masked_phone", masks.mask_phone_raw),
    "mask_phone": _column("phone", "masked_phone", masks.mask_phone),
    "mask_phone_by_country": lambda i: audits.mask_phone_by_country(i.orders()),
    "hash_id": _column("customer_id", "hashed_id", masks.hash_id),
    "hash_id_salted": _column("customer_id", "hashed_id", lambda c: masks.hash_id(c, SALT)),
    "age_exact": _column("birth_date", "age", lambda c: masks.age_exact(c, AS_OF)),
    "age_decade_start": _column("birth_date", "decade_start", lambda c: masks.age_group_start(c, AS_OF)),
    "age_range": _column("birth_date", "age_range", lambda c: masks.age_range(c, AS_OF)),
    "generalize_postal": _column("postal_code", "general_postal", masks.generalize_postal),
    "postal_prefix": _column("postal_code", "postal_prefix", masks.postal_prefix),
    "postal_prefix_1": _column("postal_code", "postal_prefix", lambda c: masks.postal_prefix(c, 1)),
    "noise_uniform": _column(
        "order_value_eur", "noised_value", lambda c: noise.noise_uniform(c, F.col("order_id"), SALT)
    ),
    "noise_uniform_rand": lambda i: audits.noise_drawn(i.orders(), lambda c: noise.noise_uniform_random(c, 42), 0.05),
    "noise_uniform_rand_bands": lambda i: audits.noise_bands(
        i.orders(), lambda c: noise.noise_uniform_random(c, 42), {"within_half": (0.025, 0.47, 0.53), "within_all": (0.0506, 1, 1)}
    ),
    "noise_gaussian": _column(
        "order_value_eur", "noised_value", lambda c: noise.noise_gaussian(c, F.col("order_id"), SALT)
    ),
    "noise_gaussian_randn": lambda i: audits.noise_drawn(i.orders(), lambda c: noise.noise_gaussian_random(c, 42), 0.25),
    "noise_gaussian_randn_bands": lambda i: audits.noise_bands(i.orders(), lambda c: noise.noise_gaussian_random(c, 42), SIGMAS),
    "noise_diff_pct": _noise_difference,
    "truncate_ip_prefix": _column("ip_address", "ip_prefix", masks.truncate_ip_prefix),
    "truncate_ip": _column("ip_address", "ip_truncated", masks.truncate_ip),
    "generalize_order_month": _column("order_date", "order_month", masks.order_month),
    "suppress_columns": lambda i: anonymize.suppress_columns(i.orders()),
    "anonymize_orders": lambda i: i.anonymized(),
    "export_orders": lambda i: anonymize.export_orders(i.orders(), POLICY),
    "suppress_unique_prefix": lambda i: kanon.suppress_unique_prefix(i.orders().select("order_id", "postal_code")),
    "suppress_small_groups": _small_groups_removed,
}

# ---- audits -----------------------------------------------------------------


def _violations(level: str) -> Query:
    return lambda i: kanon.k_violations(kanon.with_quasi_identifiers(i.orders(), POLICY), kanon.LEVELS[level])


def _finest_sets(inputs: Inputs) -> DataFrame:
    birth, postal = F.col("birth_date"), F.col("postal_code")
    levels = {
        "gender": [F.col("gender")],
        "country": [F.col("country")],
        "age": [masks.age_range(birth, AS_OF, 20), masks.age_range(birth, AS_OF, 10)],
        "postal": [masks.postal_prefix(postal, 1), masks.postal_prefix(postal, 2)],
    }
    return generalize.finest_sets(inputs.orders(), levels, most_lost=0.02)


def _median_ranges(inputs: Inputs) -> DataFrame:
    """What median cuts leave: nobody is withheld, and no group is small."""
    code = lambda c, names: F.array_position(F.array(*[F.lit(n) for n in sorted(names)]), F.col(c))
    people = inputs.orders().select(
        "customer_id",
        masks.age_exact(F.col("birth_date"), AS_OF).alias("age"),
        code("country", COUNTRIES).alias("country"),
        code("gender", GENDERS).alias("gender"),
    )
    ranges = generalize.median_ranges(people.distinct(), ["age", "country", "gender"])
    own = F.coalesce(F.col("age").between(F.col("age_from"), F.col("age_to")), F.col("age").isNull())
    kept = people.join(ranges, "customer_id")
    return kept.agg(
        F.count("*").alias("orders"),
        F.countDistinct("customer_id").alias("people"),
        F.count_if(F.col("people") < kanon.DEFAULT_K).alias("orders_in_small_groups"),
        F.count_if(~own).alias("outside_their_range"),
    )


def _linkage(inputs: Inputs) -> DataFrame:
    rows = kanon.with_quasi_identifiers(inputs.orders(), POLICY, "product_category", "device_type", "payment_method")
    shared = {
        "view_geo_analysis": ["country", "city", "region"],
        "view_demographic_analysis": ["country", "product_category"],
        "view_product_performance": ["product_category", "device_type", "payment_method"],
    }
    return generalize.linkage_audit(rows, shared)


def _city_spellings(inputs: Inputs) -> DataFrame:
    """The order rows with their city in one of three spellings."""
    form = F.substring("order_id", 5, 100).cast("bigint") % 3
    city = F.when(form == 0, F.upper("city")).when(form == 1, F.translate("city", "i", "í")).otherwise(F.col("city"))
    return inputs.anonymized().withColumn("city", city)


_AUDITS: dict[str, Query] = {
    "audit_phone_short": lambda i: audits.audit_phone_short(i.orders()),
    "audit_phone_leak": lambda i: audits.audit_phone_leak(i.orders()),
    "audit_hash_determinism": lambda i: audits.audit_hash_determinism(i.orders()),
    "audit_hash_unique": lambda i: audits.audit_hash_unique(i.orders()),
    "audit_hash_length": lambda i: audits.audit_hash_length(i.orders()),
    "audit_hash_avalanche": lambda i: audits.audit_hash_avalanche(i.orders()),
    "hash_group_spend": lambda i: audits.hash_group_spend(i.orders()),
    "age_distribution": lambda i: audits.age_distribution(i.orders(), AS_OF),
    "audit_age_gain": lambda i: audits.audit_age_gain(i.orders(), AS_OF),
    "audit_age_rare": lambda i: audits.audit_age_rare(i.orders(), AS_OF),
    "audit_age_loss": lambda i: audits.audit_age_loss(i.orders(), AS_OF),
    "postal_distribution": lambda i: audits.postal_distribution(i.orders()),
    "audit_postal_gain": lambda i: audits.audit_postal_gain(i.orders()),
    "audit_postal_rare": lambda i: audits.audit_postal_rare(i.orders()),
    "audit_postal_loss": lambda i: audits.audit_postal_loss(i.orders()),
    "noise_utility_total": lambda i: audits.noise_utility_total(i.orders(), SALT),
    "noise_utility_country": lambda i: audits.noise_utility_country(i.orders(), SALT),
    "audit_ip_gain": lambda i: audits.audit_ip_gain(i.orders()),
    "ip_distribution": lambda i: audits.ip_distribution(i.orders()),
    "kanon_2qi": _violations("2 quasi-identifiers"),
    "kanon_3qi": _violations("3 quasi-identifiers"),
    "kanon_4qi": _violations("4 quasi-identifiers"),
    "kanon_summary": lambda i: kanon.k_summary(kanon.with_quasi_identifiers(i.orders(), POLICY)),
    "kanon_view": lambda i: views.k_summary_of_views(i.orders(), POLICY),
    "kanon_finest_sets": _finest_sets,
    "kanon_median_ranges": _median_ranges,
    "kanon_linkage": _linkage,
    "kanon_city_blind": lambda i: kanon.k_violations(
        collation.collated(_city_spellings(i), "city"), ["city", "age_range"], "customer_id_hashed"
    ).select(F.upper(F.translate(F.collate("city", "UTF8_BINARY"), "íÍ", "iI")).alias("city"), "age_range", "people"),
    "collation_city_spellings": lambda i: collation.group_spellings(_city_spellings(i), "city"),
}

# ---- free text --------------------------------------------------------------


def _redacted_texts(rules: tuple[text.Rule, ...] = text.RULES) -> Query:
    return lambda i: redact.redact_column(i.texts(), "text", "redacted", rules).select("kind", "text_id", "redacted")


def _unchanged(inputs: Inputs) -> DataFrame:
    redacted = redact.redact_column(inputs.texts(), "text", "redacted")
    return redacted.groupBy("kind").agg(
        F.count("*").alias("texts"), F.count_if(F.col("redacted") == F.col("text")).alias("unchanged")
    )


def _known_values(inputs: Inputs) -> DataFrame:
    notes = inputs.orders().where(F.col("customer_notes") != "")
    return notes.select("order_id", text.redact_known_values(F.col("customer_notes")).alias("note_redacted"))


def _all_values(inputs: Inputs) -> DataFrame:
    values = dictionary.value_table(inputs.orders())
    return dictionary.redact_values(inputs.texts(), "text", ["kind", "text_id"], values).select("kind", "text_id", "redacted")


def _misspelt_names(inputs: Inputs) -> DataFrame:
    names = dictionary.value_table(inputs.orders(), (("full_name", "[NAME]"),))
    found = dictionary.finds(inputs.texts(), "text", ["kind", "text_id"], names, edits=1)
    return found.groupBy("kind", "text_id", F.col("at").cast("bigint").alias("place"), "found").agg(
        F.min("distance").alias("distance"), F.count("*").alias("names_near")
    )


_TEXTS: dict[str, Query] = {
    **{
        f"redact_{kind}": _redacted_texts(text.rules_for(f"[{kind.upper()}]"))
        for kind in ("email", "phone", "card", "id", "dob", "address", "name")
    },
    "redact_card_checked": lambda i: i.texts().select(
        "kind", "text_id", text.redact_valid_cards(F.col("text")).alias("redacted")
    ),
    "redact_documents": _redacted_texts(),
    "redact_unchanged": _unchanged,
    "redact_known_values": _known_values,
    "redact_all_values": _all_values,
    "find_misspelt_names": _misspelt_names,
    "redact_notes": lambda i: redact.redact_notes(i.orders()).select("order_id", "customer_notes_anonymized"),
    "label_counts": lambda i: redact.label_counts(i.texts(), "text", ["kind", "lang"]),
    "audit_redaction": lambda i: redact.audit_redaction(i.orders()),
    "audit_redaction_precision": lambda i: redact.audit_redaction_precision(i.orders(), note_truth()),
}

# ---- views and questions ----------------------------------------------------


def _asked(view: str, question: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda i: question(i.view(view))


_BEHAVIOR = {
    "cb01_customers": behavior.customers,
    "cb02_per_segment": behavior.customers_per_segment,
    "cb03_avg_spend": behavior.average_spend,
    "cb04_top5": behavior.top_spenders,
    "cb05_gt10_orders": behavior.frequent_customers,
    "cb06_order_histogram": behavior.order_histogram,
    "cb07_avg_by_segment": behavior.average_order_by_segment,
    "cb08a_segment_share": behavior.segment_share,
    "cb08b_regular_share": behavior.regular_share,
    "cb09_active_365": behavior.active_longer_than,
    "cb10_best_per_segment": behavior.best_per_segment,
    "cb11_recency_top10": lambda view: behavior.most_inactive(view, AS_OF),
}
_DEMOGRAPHIC = {
    "dm01_rows_per_country": demographic.rows_per_country,
    "dm02_categories": demographic.categories,
    "dm03_revenue_country": demographic.revenue_per_country,
    "dm04_revenue_gender": demographic.revenue_per_gender,
    "dm05_spain_orders": demographic.orders_in_country,
    "dm06_top_category_country": demographic.top_category_per_country,
    "dm07_category_share": demographic.category_share,
    "dm08_top_age_range": demographic.top_age_range,
    "dm09_top_gender_country": demographic.top_gender_per_country,
    "dm10_rank_lag": demographic.country_ranking,
}
_GEO = {
    "ge01_payment_counts": geo.orders_per_payment,
    "ge02_avg_device": geo.average_per_device,
    "ge03_spain": geo.orders_in_country,
    "ge04_top5_countries": geo.top_countries,
    "ge05_uk_mobile": geo.orders_by_device_in_country,
    "ge06_top3_payment_country": geo.top_payment_country,
    "ge07_monthly_revenue": geo.monthly_revenue,
    "ge08_device_share": geo.device_share,
    "ge09_growth_first_last": geo.growth_first_last,
    "ge09_growth_joined": geo.growth_first_last_joined,
    "ge10_city_above_avg": geo.cities_above_average,
}
_PRODUCT = {
    "pp01_revenue_category": product.revenue_per_category,
    "pp02_orders_device": product.orders_per_device,
    "pp03_minmax_avg": product.extreme_averages,
    "pp04_min_gt_30": product.combinations_above,
    "pp05_top_payment": product.top_payment_method,
    "pp06_combo_share": product.combination_share,
    "pp07_value_range": product.value_range,
    "pp08_klarna_vs_rest": product.method_against_rest,
    "pp09_dense_rank": product.category_rank_in_device,
    "pp10_running_total": product.running_total,
}
_QUESTIONS: dict[str, Query] = {
    **{name: (lambda i, name=name: i.view(name)) for name in views.ALL_VIEWS},
    **{key: _asked("view_customer_behavior", q) for key, q in _BEHAVIOR.items()},
    **{key: _asked("view_demographic_analysis", q) for key, q in _DEMOGRAPHIC.items()},
    **{key: _asked("view_geo_analysis", q) for key, q in _GEO.items()},
    **{key: _asked("view_product_performance", q) for key, q in _PRODUCT.items()},
    "ge10_city_blind": lambda i: geo.cities_above_average_blind(views.view_geo_analysis(_city_spellings(i))),
}

QUERIES: dict[str, Query] = {**_SOURCES, **_COLUMNS, **_AUDITS, **_TEXTS, **_QUESTIONS}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary(QUERIES[name](Inputs(spark, sf_dir)))


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, name=name: run(name, spark, sf_dir)) for name in QUERIES}
