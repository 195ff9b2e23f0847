
from __future__ import annotations

import functools
import importlib
import os
import sys
import uuid
from collections.abc import Callable, Iterable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle.queries import texts
from tidemark.functions.risk import risk_tier
from tidemark.operators import customers, orders, segments, staging, training
from tidemark.plans import metrics, quality
from tidemark.plans.analytics import MODELS, Analytics
from tidemark.plans.churn_model import FEATURES, SCORED_COLUMNS
from tidemark.session import shared_dir, stage
from tidemark.sources import csv_load
from tidemark.sources.marts import read_mart, write_mart
from tidemark.sources.raw_tables import row_counts
from tidemark.sources.tpch_shape import raw_tables_from_tpch

# The parts that may be absent together: the corpus operators and the pipeline over them.
CORPUS_PARTS = ("tidemark.llm", "corpus_pipeline")


def _optional(name: str):
    """A module of the corpus operators, or None where that part of the repository is absent."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if any(missing.name == part or f"{missing.name}".startswith(f"{part}.") for part in CORPUS_PARTS):
            return None
        raise


corpus_queries = _optional("tidemark.llm.queries")
corpus_pipeline = _optional("corpus_pipeline")

# Features that tell persons with one order from others, as the label does.
HOLD_THE_LABEL = ("total_orders", "frequency", "customer_tenure_days")

# Gzipped files are read whole by one task each.
CSV_ROWS_PER_FILE = 500_000

SMOKE_DIR = "/root/testdata/sf0.001"

_open: dict[tuple[str, str, bool], Analytics] = {}


def analytics(spark: SparkSession, sf_dir: str, exact: bool = True) -> Analytics:
    """The models over one directory, shared by the queries of a session.

    With exact sums, values can be compared with another engine bit for bit.
    """
    key = (spark.sparkContext.applicationId, sf_dir, exact)
    if key not in _open:
        _open[key] = Analytics(spark, raw_tables_from_tpch(spark, sf_dir), exact)
    return _open[key]


def forget() -> None:
    """Drop the shared models, so that the next query starts from the given tables."""
    _open.clear()


def rule_scored(wide: DataFrame) -> DataFrame:
    """Customers scored by fixed arithmetic on their id, to compare summaries with SQL."""
    score = (F.col("customer_unique_id").cast("long") * 37 % 101).cast("double") / 100
    return (
        wide.withColumn("churn_probability", score)
        .withColumn("churn_prediction", (F.col("churn_probability") > 0.5).cast("int"))
        .withColumn("churn_risk_tier", risk_tier(F.col("churn_probability")))
        .select(*SCORED_COLUMNS)
    )


def entry(spark: SparkSession) -> DataFrame:
    """The wide customer table with scores, behaviour and churn label."""
    return analytics(spark, SMOKE_DIR).customer_360_rows()


def _write_csv_files(models: Analytics, folder: str, tables: Iterable[str]) -> None:
    """Raw tables as CSV, with some rows spoiled by key: bad number, long or broken text."""
    raw = dict(models.raw)
    key = F.col("order_id").cast("long")
    raw["customers"] = raw["customers"].withColumn(
        "customer_state", F.regexp_replace("customer_state", "NATION_", "N")
    )
    raw["geolocation"] = raw["geolocation"].withColumn(
        "geolocation_state", F.regexp_replace("geolocation_state", "NATION_", "N")
    )
    raw["sellers"] = raw["sellers"].withColumn("seller_state", F.substring("seller_state", 1, 5))
    raw["order_payments"] = raw["order_payments"].withColumn(
        "payment_value",
        F.when(key % 89 == 0, "n/a").otherwise(F.col("payment_value").cast("string")),
    )
    raw["orders"] = raw["orders"].withColumn(
        "order_status", F.when(key % 83 == 0, F.repeat("order_status", 5)).otherwise(
            F.col("order_status")
        )
    )
    raw["order_reviews"] = raw["order_reviews"].withColumn(
        "review_score",
        F.when(key % 79 == 0, "five").otherwise(F.col("review_score").cast("string")),
    ).withColumn("review_comment_message", F.concat(F.lit('said "ok",\nthen '), "order_id"))
    for table in tables:
        raw[table].write.mode("overwrite").option("header", True).option("escape", '"').option(
            "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
        ).option("compression", "gzip").option("maxRecordsPerFile", CSV_ROWS_PER_FILE).csv(
            f"{folder}/{csv_load.CSV_FILES[table]}"
        )


def _scratch(models: Analytics, label: str) -> str:
    """The name of a new folder among the application's intermediates."""
    app = models.spark.sparkContext.applicationId
    return f"{shared_dir(models.spark)}/tidemark/{app}/{label}-{uuid.uuid4().hex}"


def csv_folder(models: Analytics, tables: Iterable[str] = tuple(csv_load.CSV_FILES)) -> str:
    """A folder with raw tables as CSV files; each is written once per set of models, when asked for."""
    if not hasattr(models, "csv_folder"):
        models.csv_folder, models.csv_tables = _scratch(models, "csv"), set()
    missing = [table for table in tables if table not in models.csv_tables]
    _write_csv_files(models, models.csv_folder, missing)
    models.csv_tables.update(missing)
    return models.csv_folder


def _loaded_table(models: Analytics, table: str) -> csv_load.LoadResult:
    """One table loaded from its CSV files."""
    path = f"{csv_folder(models, [table])}/{csv_load.CSV_FILES[table]}"
    return csv_load.load_csv(models.spark, table, path, _scratch(models, f"csv-{table}"))


def _write_lines(lines: DataFrame, header: str, folder: str) -> None:
    """Lines as they are, each file with the header first."""
    plain = {"header": True, "sep": "\x01", "quote": "\x02"}  # characters that no line holds
    lines.select(F.explode(F.split("line", "\n")).alias(header)).write.options(**plain).csv(folder)


def _review_blocks(models: Analytics) -> DataFrame:
    """Reviews from files cut in small blocks; every 97th leaves a quote open in its title."""
    spark, folder = models.spark, _scratch(models, "csv-blocks")
    reviews = models.raw["order_reviews"]
    key = F.col("order_id").cast("long")
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    stray = F.concat(F.lit('"open '), F.col("order_id"))
    fields = [text(name) for name in reviews.columns]
    fields[3] = F.when(key % 97 == 0, stray).otherwise(F.lit('"a ""title"""'))
    fields[4] = F.concat(F.lit('"first\nsecond, '), F.col("order_id"), F.lit('\nthird"'))
    fields[5:] = [F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in reviews.columns[5:]]
    line = F.concat_ws(",", *[F.coalesce(field, F.lit("")) for field in fields])
    _write_lines(reviews.select(line.alias("line")), ",".join(reviews.columns), folder)
    sizes = {"spark.sql.files.maxPartitionBytes": str(1 << 18), "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in sizes}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    try:
        records = csv_load.read_text_columns(spark, "order_reviews", folder)
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)
    return csv_load.store_lines(records, "order_reviews", f"{folder}-loaded").rows


def _mixed_headers(models: Analytics) -> csv_load.LoadResult:
    """Payments in two sets of files, the second with other columns in another order."""
    folder = _scratch(models, "csv-mixed")
    payments, key = models.raw["order_payments"], F.col("order_id").cast("long")
    orders = [payments.columns, [*payments.columns[::-1][:-1], "order_id", "batch"]]
    for odd, names in enumerate(orders):
        rows = payments.filter(key % 2 == odd).withColumn("batch", F.lit("second"))
        rows.select(*names).write.mode("append").option("header", True).csv(folder)
    return csv_load.load_csv_as_text(models.spark, folder, f"{folder}-loaded")


def _text_load(models: Analytics) -> csv_load.LoadResult:
    """Order items as text; lines of some orders have a field too many or one too few."""
    folder = _scratch(models, "csv-text")
    items, key = models.raw["order_items"], F.col("order_id").cast("long")
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in items.columns]
    line = F.concat_ws(
        ",",
        F.when(key % 71 == 0, F.concat_ws(",", *fields, F.lit("more")))
        .when(key % 73 == 0, F.concat_ws(",", *fields[:-1]))
        .otherwise(F.concat_ws(",", *fields)),
    )
    _write_lines(items.select(line.alias("line")), ",".join(items.columns), folder)
    return csv_load.load_csv_as_text(models.spark, folder, f"{folder}-loaded")


def _reloaded(models: Analytics) -> DataFrame:
    """Payments loaded twice into one place; the second load replaces the first."""
    path = f"{csv_folder(models, ['order_payments'])}/{csv_load.CSV_FILES['order_payments']}"
    target = _scratch(models, "csv-again")
    for _ in range(2):
        loaded = csv_load.load_csv(models.spark, "order_payments", path, target)
    return loaded.rows


def _mart_roundtrip(models: Analytics) -> DataFrame:
    """The wide customer table written as a mart, rebuilt, and read again."""
    folder = _scratch(models, "marts")
    for _ in range(2):
        write_mart(models.customer_360, folder, "customer_360")
    return read_mart(models.spark, folder, "customer_360")


def _replaced_after_failure(models: Analytics) -> DataFrame:
    """The wide customer table after a rebuild that fails on the way."""
    folder = _scratch(models, "failing")
    wide = models.customer_360
    write_mart(wide, folder, "customer_360")
    late = F.col("customer_unique_id").cast("long") % 5 == 3
    broken = wide.withColumn("state", F.when(late, F.raise_error(F.lit("stop"))).otherwise("new"))
    try:
        write_mart(broken, folder, "customer_360")
    except PySparkException:
        pass
    return read_mart(models.spark, folder, "customer_360")


def _loaded_csv(models: Analytics) -> dict[str, csv_load.LoadResult]:
    if not hasattr(models, "loaded_csv"):
        folder = csv_folder(models)
        models.loaded_csv = csv_load.load_directory(models.spark, folder, f"{folder}-loaded")
    return models.loaded_csv


def _rejected_rows(models: Analytics) -> DataFrame:
    """Rows set aside by the load of the tables keyed by order, with the reason."""
    parts = [
        _loaded_table(models, table).rejects.select(
            F.lit(table).alias("table_name"), "order_id", "reason"
        )
        for table in ("orders", "order_payments", "order_reviews")
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def _check_summary(models: Analytics) -> DataFrame:
    """All checks but those of the fitted model; checked columns of derived models are stored first."""
    ready = {}
    for name in MODELS:
        if name in ("churn_prediction", "churn_segment_summary"):
            continue
        model = getattr(models, name)
        lazy = not name.startswith("stg_") and name not in ("customer_order_summary", "customer_360")
        columns = quality.checked_columns(name)
        ready[name] = stage(model.select(*columns), f"checked-{name}") if lazy else model
    summary = ready["customer_order_summary"]
    return quality.run_checks(ready).unionByName(
        quality.label_completeness(summary, ready["customer_churn_labels"])
    )


def queries(exact: bool = True) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries; ``exact=False`` gives the operators' own double sums."""

    def on_models(build: Callable[[Analytics], DataFrame]):
        return lambda spark, sf_dir: build(analytics(spark, sf_dir, exact))

    def on_rule(build: Callable[[DataFrame], DataFrame]):
        return on_models(lambda m: build(rule_scored(m.customer_360)))

    def on_fit(build: Callable[[DataFrame], DataFrame]):
        return on_models(lambda m: build(m.churn_prediction))

    def comparable(scored: DataFrame) -> DataFrame:
        """Probabilities in the digits that sums in another order do not change."""
        rounded = F.round("churn_probability", 9)
        return scored.withColumn("churn_probability", rounded) if exact else scored

    named = {
        name: on_models(lambda m, name=name: getattr(m, name))
        for name in MODELS
        if name not in ("stg_geolocation", "churn_prediction", "churn_segment_summary")
    }
    named |= {
        "geolocation_by_zip": on_models(lambda m: m.stg_geolocation),
        "order_items_agg": on_models(lambda m: orders.order_items_agg(m.stg_order_items, exact)),
        "order_payments_agg": on_models(
            lambda m: orders.order_payments_agg(m.stg_order_payments, exact)
        ),
        "order_reviews_agg": on_models(
            lambda m: orders.order_reviews_agg(m.stg_order_reviews, exact)
        ),
        "dataset_boundary": on_models(
            lambda m: customers.dataset_boundary(m.customer_order_summary)
        ),
        "ntile_monetary_nulls": on_models(
            lambda m: m.customer_rfm.filter(F.col("monetary").isNull()).select(
                "customer_unique_id", "monetary", "monetary_score"
            )
        ),
        "payment_ratios": on_models(
            lambda m: customers.payment_ratios(
                m.stg_order_payments, m.stg_orders, m.stg_customers
            )
        ),
        "median_impute": on_models(
            lambda m: training.median_impute(m.customer_360, FEATURES).select(
                "customer_unique_id", *FEATURES
            )
        ),
        "stratified_split_counts": on_models(
            lambda m: training.stratified_split(m.customer_360, "churned", "customer_unique_id")
            .groupBy("churned", "held_out")
            .agg(F.count("*").alias("n"))
        ),
        "stratified_split_rows": on_models(
            lambda m: training.stratified_split(
                m.customer_360, "churned", "customer_unique_id"
            ).select("customer_unique_id", "churned", "held_out")
        ),
        "classification_report": on_rule(training.classification_report),
        "risk_tier_edges": on_models(
            lambda m: m.stg_orders.select(
                "order_id", ((F.col("order_id").cast("long") % 101).cast("double") / 100).alias("p")
            ).withColumn("churn_risk_tier", risk_tier(F.col("p")))
        ),
    }
    # On the fitted model. Its label is a rule over one feature, which it learns exactly, so SQL
    # can tell everything but the probabilities.
    named |= {
        "churn_prediction": on_fit(lambda df: df.drop("churn_probability")),
        "churn_scores": on_fit(comparable),
        "churn_segment_summary": on_models(
            lambda m: m.churn_segment_summary.drop("avg_churn_probability")
        ),
        "churn_segment_scores": on_fit(
            lambda df: segments.churn_segment_summary(comparable(df), exact)
        ),
        "kpi_row": on_fit(lambda df: segments.kpi_row(df, exact)),
        "kpi_labels": on_fit(lambda df: segments.kpi_labels(segments.kpi_row(df, exact))),
        "tier_distribution": on_fit(segments.tier_distribution),
        "state_churn_top10": on_fit(segments.state_churn),
        "at_risk_customers": on_fit(
            lambda df: segments.at_risk_customers(df).select(
                "customer_unique_id", "state", "lifetime_revenue", "churn_risk_tier"
            )
        ),
        "risk_sample": on_fit(lambda df: segments.risk_sample(df).drop("churn_probability")),
        "risk_sample_size": on_fit(
            lambda df: segments.risk_sample(df).agg(
                F.count("*").alias("rows_drawn"),
                F.countDistinct("customer_unique_id").alias("customers_drawn"),
            )
        ),
        "holdout_report": on_models(lambda m: m.churn_model.report()),
        "importance_by_kind": on_models(
            lambda m: m.churn_model.importances(top=len(FEATURES))
            .groupBy(
                F.when(F.col("feature").isin(*HOLD_THE_LABEL), "holds the label")
                .otherwise("other").alias("kind")
            )
            .agg(F.count("*").alias("features"), F.round(F.sum("importance"), 9).alias("importance"))
        ),
        "feature_importance_top10": on_models(
            lambda m: m.churn_model.importances(digits=9 if exact else None)
        ),
        "dq_churn_prediction": on_models(
            lambda m: quality.run_checks({"churn_prediction": m.churn_prediction})
        ),
    }
    # The same summaries on scores that SQL can compute too.
    named |= {
        "churn_segment_summary_rule": on_rule(
            lambda df: segments.churn_segment_summary(df, exact)
        ),
        "kpi_row_rule": on_rule(lambda df: segments.kpi_row(df, exact)),
        "tier_distribution_rule": on_rule(segments.tier_distribution),
        "state_churn_top10_rule": on_rule(segments.state_churn),
        "at_risk_customers_rule": on_rule(segments.at_risk_customers),
    }
    named |= {
        "dq_unique": on_models(
            lambda m: quality.duplicated_values(m.stg_order_reviews, "order_id")
        ),
        "dq_not_null": on_models(lambda m: quality.missing_rows(m.stg_orders, "delivered_at")),
        "dq_accepted_values": on_models(
            lambda m: quality.unaccepted_values(
                m.stg_orders, "order_status", ("delivered", "shipped")
            )
        ),
        "dq_relationships": on_models(
            lambda m: quality.orphan_keys(m.stg_orders, "order_id", m.stg_order_items, "order_id")
        ),
        "dq_label_completeness": on_models(
            lambda m: quality.unlabelled_customers(
                m.customer_order_summary,
                customers.customer_churn_labels(m.customer_order_summary, window_days=120),
            )
        ),
        "dq_summary": on_models(_check_summary),
    }
    for model in dict.fromkeys(metric.model for metric in metrics.METRICS):
        if model == "churn_prediction":
            build = on_rule(
                lambda df: metrics.metric_query("churn_prediction", df, exact=exact)
            )
        elif model == "churn_segment_summary":
            build = on_rule(
                lambda df: metrics.metric_query(
                    "churn_segment_summary", segments.churn_segment_summary(df, exact), exact=exact
                )
            )
        else:
            build = on_models(
                lambda m, model=model: metrics.metric_query(
                    model, getattr(m, model), exact=exact
                )
            )
        named[f"metrics_{model}"] = build
    named |= {
        "metric_churn_rate_by_state": on_models(
            lambda m: metrics.metric_query(
                "customer_360", m.customer_360, ("churned_count", "churn_rate"), ("state",),
                exact=exact,
            )
        ),
        "metric_seller_by_state": on_models(
            lambda m: metrics.metric_query(
                "seller_performance", m.seller_performance, None, ("seller_state",), exact=exact
            )
        ),
        "metric_late_orders_by_delay": on_models(
            lambda m: metrics.metric_query(
                "order_enriched",
                m.order_enriched,
                None,
                ("delivery_days",),
                F.col("delivery_delta_days") < 0,
                exact=exact,
            )
        ),
        "metrics_by_state_and_tier": on_rule(
            lambda df: metrics.metric_totals(
                "churn_prediction",
                df,
                (("state", "churn_risk_tier"), ("state",), ("churn_risk_tier",), ()),
                exact=exact,
            )
        ),
        "row_counts": on_models(lambda m: row_counts(m.raw)),
        "csv_load_status": on_models(lambda m: csv_load.load_status(_loaded_csv(m))),
        "csv_loaded_payments": on_models(lambda m: _loaded_table(m, "order_payments").rows),
        "csv_rejects": on_models(_rejected_rows),
        "csv_loaded_reviews": on_models(lambda m: _loaded_table(m, "order_reviews").rows),
        "csv_reload": on_models(_reloaded),
        "csv_review_blocks": on_models(_review_blocks),
        "csv_mixed_headers": on_models(
            lambda m: _mixed_headers(m).rows.select(
                "order_id",
                F.col("payment_sequential").cast("int").alias("payment_sequential"),
                F.col("payment_value").cast("double").alias("payment_value"),
                "batch",
            )
        ),
        "csv_text_rejects": on_models(
            lambda m: _text_load(m).rejects.select("reason", "order_id", "order_item_id")
        ),
        "mart_roundtrip": on_models(_mart_roundtrip),
        "mart_replace_after_failure": on_models(_replaced_after_failure),
        "csv_text_load": on_models(
            lambda m: staging.stg_order_items(_text_load(m).rows)
        ),
        "metric_revenue_label_by_tier": on_rule(
            lambda df: metrics.with_text_formats(
                "churn_prediction",
                metrics.metric_query(
                    "churn_prediction",
                    df,
                    ("total_lifetime_revenue",),
                    ("churn_risk_tier",),
                    exact=exact,
                ),
            )
        ),
    }
    if corpus_queries:
        named |= corpus_queries.QUERIES
    if corpus_pipeline:
        named["pipeline"] = corpus_pipeline.run
    return named


def oracle_sql() -> dict[str, str]:
    known = texts()
    if corpus_queries:
        known |= corpus_queries.ORACLE_SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        known["pipeline"] = corpus_pipeline.ORACLE_SQL
    return known
