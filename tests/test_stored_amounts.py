"""What queries write, shuffle and hold besides their results."""

from __future__ import annotations

import os
import re

import pyarrow as pa

import __spark_entry__ as entry
from tests.shop import item, payment, raw
from tidemark import session
from tidemark.operators import customers, orders, staging
from tidemark.plans import quality
from tidemark.plans.analytics import Analytics
from tidemark.sources import csv_load, csv_records


def models_of(spark, tmp_path, monkeypatch, **tables):
    monkeypatch.setattr(entry, "shared_dir", lambda _: str(tmp_path))
    return Analytics(spark, {name: raw(spark, name, rows) for name, rows in tables.items()})


def test_a_loaded_table_writes_the_csv_of_no_other(spark, tmp_path, monkeypatch):
    models = models_of(
        spark, tmp_path, monkeypatch,
        customers=[{"customer_id": "1"}], geolocation=[], sellers=[], orders=[{"order_id": "1"}],
        order_reviews=[], order_payments=[payment("1"), payment("2")],
    )
    assert entry._loaded_table(models, "order_payments").rows.count() == 2
    assert os.listdir(models.csv_folder) == ["order_payments_dataset.csv"]
    entry._loaded_table(models, "orders")
    assert sorted(os.listdir(models.csv_folder)) == ["order_payments_dataset.csv", "orders_dataset.csv"]


def test_a_mart_is_rebuilt_without_csv_files(spark, tmp_path, monkeypatch):
    models = models_of(spark, tmp_path, monkeypatch)
    models.customer_360 = spark.range(5)
    assert entry._mart_roundtrip(models).count() == 5
    stored = os.listdir(tmp_path / "tidemark" / spark.sparkContext.applicationId)
    assert [name.split("-")[0] for name in stored] == ["marts"]


def items_of(spark, rows):
    return staging.stg_order_items(raw(spark, "order_items", rows))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_item_aggregates_do_not_multiply_the_rows(spark):
    rows = [item("1", "p1", "s1", 1.5), item("1", "p1", "s2", 2.0), item("1", "p2", "s2", None)]
    rows += [item("1", None, "s2", 1.0), item("2", None, None, None), item(None, "p1", "s1"), item(None, "p2")]
    for exact in (False, True):
        agg = orders.order_items_agg(items_of(spark, rows), exact)
        assert "Expand" not in plan_of(agg)
        assert not re.search(r"keys=\[[^]]*(product|seller)_id", plan_of(agg.select("order_id", "item_count")))
        assert {row[0]: tuple(row)[1:] for row in agg.collect()} == {
            "1": (4, 2, 2, 4.5, 4.0), "2": (1, 0, 0, None, 1.0), None: (2, 2, 2, 20.0, 2.0),
        }
    assert orders.order_items_agg(items_of(spark, [])).collect() == []


def test_the_order_summary_groups_items_by_order_only(spark):
    tables = {name: [] for name in ("customers", "orders", "order_payments", "order_reviews")}
    frames = {name: raw(spark, name, rows) for name, rows in tables.items()}
    summary = customers.customer_order_summary(
        staging.stg_customers(frames["customers"]),
        staging.stg_orders(frames["orders"]),
        items_of(spark, [item("1")]),
        staging.stg_order_payments(frames["order_payments"]),
        staging.stg_order_reviews(frames["order_reviews"]),
    )
    assert not re.search(r"keys=\[[^]]*(product|seller)_id", plan_of(summary))


def test_checks_store_the_columns_they_read():
    assert quality.checked_columns("order_enriched") == ["order_id", "customer_id"]
    assert quality.checked_columns("stg_customers") == ["customer_id", "customer_unique_id"]


def test_small_parts_unless_the_owner_chose(spark):
    session.apply_defaults(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"


def test_one_line_of_each_file_leaves_the_header_scan():
    batches = [
        pa.RecordBatch.from_pydict({"file": files, "line": lines})
        for files, lines in ((["f", "f", "g"], ["a,b", "1,2", "c"]), (["g", "h"], ["3", "d"]), ([], []))
    ]
    batches[2] = batches[0].slice(0, 0)
    found = [row for batch in csv_load._first_lines(iter(batches)) for row in batch.to_pylist()]
    assert [tuple(row.values()) for row in found] == [("f", "a,b"), ("g", "c"), ("h", "d")]


def test_many_small_blocks_share_tasks(spark, tmp_path, monkeypatch):
    text = "\n".join(["a,b", *[f'{k},"x\ny"' for k in range(900)]])
    (tmp_path / "r.csv").write_text(text)
    tasks = []

    def counted(df, label):
        tasks.append(df.rdd.getNumPartitions())
        return session.stage(df, label)

    monkeypatch.setattr(csv_records, "stage", counted)
    monkeypatch.setattr(csv_records, "TASKS_PER_CORE", 1)
    sizes = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in sizes}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    try:
        assert spark.read.text(str(tmp_path / "r.csv")).rdd.getNumPartitions() > 20
        records = csv_records.read_records(spark, str(tmp_path / "r.csv"), 2, 5000)
        texts = sorted(row.text for row in records.filter("not broken").collect())
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)
    assert texts == sorted(f'{k},"x\ny"' for k in range(900))
    assert tasks == [spark.sparkContext.defaultParallelism]
