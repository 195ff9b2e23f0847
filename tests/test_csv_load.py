from __future__ import annotations

import gzip
import random

import pytest
from pyspark.errors import PySparkException

from tidemark.sources import csv_load, csv_records
from tidemark.sources.marts import read_mart, save_as_table, write_mart
from tidemark.sources.raw_tables import load_raw, raw_schema, row_counts

REVIEWS = '''"review_id","order_id","review_score","review_comment_title","review_comment_message","review_creation_date","review_answer_timestamp"
r1, o1 ,5,NULL,"first line
second ""quoted"" line",2018-01-18 00:00:00,2018-01-18 21:46:59
r2,o2,1.6,null,,2018-01-18 00:00:00,
r3,o3,five,,,,
r4,o4,1,,,,,extra
r5,o5,1
r6,o6,3,{long_title},,,
"r7","o7"," 4 ","",,2018-13-45 00:00:00,
r8,o8,2,ok,"a, b",,
'''


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    text = REVIEWS.replace("{long_title}", "x" * 501)
    (folder / "order_reviews_dataset.csv").write_text(text)
    with gzip.open(folder / "sellers_dataset.csv.gz", "wt") as out:
        out.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\n")
        out.write("s1,01234,sao paulo,SP\ns2,99999,rio,TOOLONG\n")
    return folder


def test_bad_rows_are_set_aside_and_the_load_goes_on(spark, source, tmp_path):
    loaded = csv_load.load_directory(spark, str(source), str(tmp_path / "raw"))
    assert set(loaded) == {"order_reviews", "sellers"}
    reviews = loaded["order_reviews"]
    rows = {row.review_id: row for row in reviews.rows.collect()}
    assert set(rows) == {"r1", "r2", "r8"}
    assert rows["r1"].order_id == "o1" and rows["r1"].review_comment_title is None
    assert rows["r1"].review_comment_message == 'first line\nsecond "quoted" line'
    assert rows["r1"].review_answer_timestamp.isoformat() == "2018-01-18T21:46:59"
    assert rows["r2"].review_score == 2 and rows["r2"].review_comment_title is None
    assert rows["r8"].review_comment_message == "a, b"
    reasons = {row.review_id: row.reason for row in reviews.rejects.collect()}
    assert reasons == {
        "r3": "review_score: not int",
        "r4": "malformed line",
        "r5": "malformed line",
        "r6": "review_comment_title: too long",
        "r7": "review_creation_date: not timestamp",
    }
    status = {row.table_name: tuple(row)[1:] for row in csv_load.load_status(loaded).collect()}
    assert status == {"order_reviews": (3, 5), "sellers": (1, 1)}
    assert [f.dataType for f in reviews.rows.schema] == [
        f.dataType for f in raw_schema("order_reviews")
    ]


def test_counts_and_rows_agree_whatever_is_read(spark, source, tmp_path):
    result = csv_load.load_csv(
        spark, "order_reviews", str(source / "order_reviews_dataset.csv"), str(tmp_path / "raw")
    )
    assert result.rows.count() == len(result.rows.collect()) == 3
    assert result.rows.select("review_id").distinct().count() == 3
    assert result.rejects.count() == len(result.rejects.collect()) == 5


def test_missing_files_are_reported(spark, source, tmp_path, capsys):
    csv_load.load_directory(spark, str(source), str(tmp_path / "raw"))
    assert "skipped orders" in capsys.readouterr().out


def test_loading_again_replaces(spark, source, tmp_path):
    for _ in range(2):
        result = csv_load.load_csv(
            spark, "sellers", str(source / "sellers_dataset.csv.gz"), str(tmp_path / "raw")
        )
    assert [row.seller_zip_code_prefix for row in result.rows.collect()] == ["01234"]


def test_header_named_text_load(spark, source, tmp_path):
    path = str(source / "sellers_dataset.csv.gz")
    df = csv_load.load_csv_as_text(spark, path, str(tmp_path / "text")).rows
    assert df.dtypes == [(name, "string") for name in
                         ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")]
    assert df.first().seller_zip_code_prefix == "01234"


def test_text_load_sets_bad_lines_aside(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b,c\n1,x,y\n3,z,4,5\n2,y\n4,"q ""r""",s\n')
    loaded = csv_load.load_csv_as_text(spark, str(tmp_path / "t.csv"), str(tmp_path / "t"))
    assert sorted(map(tuple, loaded.rows.collect())) == [("1", "x", "y"), ("4", 'q "r"', "s")]
    assert sorted(r.line for r in loaded.rejects.collect()) == ["2,y", "3,z,4,5"]
    status = loaded.status().first()
    assert (status.rows_loaded, status.rows_rejected) == (2, 2)


def test_texts_that_only_resemble_values_are_rejected(spark, tmp_path):
    names = [column.name for column in csv_load.RAW_TABLES["order_payments"]]
    values = {"order_id": "1", "payment_sequential": "1", "payment_type": "x",
              "payment_installments": "1", "payment_value": "2.50"}
    rows = [dict(values), values | {"payment_value": "1.5d"}, values | {"payment_installments": "1f"}]
    lines = [",".join(names)] + [",".join(row[name] for name in names) for row in rows]
    (tmp_path / "p.csv").write_text("\n".join(lines))
    loaded = csv_load.load_csv(spark, "order_payments", str(tmp_path / "p.csv"), str(tmp_path / "raw"))
    assert [r.payment_value for r in loaded.rows.collect()] == [2.5]
    assert loaded.rejects.count() == 2


@pytest.mark.parametrize(
    "text, good",
    [("2017", False), ("2017-10", False), ("2017-10-02", True), ("2017-10-02 10:00:00", True),
     ("2017-10-02T10:00:00+05:00", False), ("2017-10-02 10:00:00.5", True)],
)
def test_timestamps_need_a_whole_date_and_no_zone(spark, text, good):
    column = next(c for c in csv_load.RAW_TABLES["orders"] if "timestamp" in c.name)
    frame = spark.createDataFrame([(text,)], f"{column.name} string")
    assert (frame.select(csv_load._typed(column)).first()[0] is not None) == good


def test_empty_and_foreign_tables(spark, source, tmp_path):
    target = str(tmp_path / "raw")
    names = [column.name for column in csv_load.RAW_TABLES["sellers"]]
    (tmp_path / "s.csv").write_text(",".join(names) + "\n")
    csv_load.load_csv(spark, "sellers", str(tmp_path / "s.csv"), target)
    for table in csv_load.RAW_TABLES:
        if table != "sellers":
            empty = spark.createDataFrame([], raw_schema(table))
            empty.selectExpr("*", "true as rejected").write.parquet(f"{target}/{table}")
    row = spark.range(1).selectExpr("true as rejected", *[f"null as {f.name}" for f in raw_schema("orders")])
    row.select(*[row[f.name].cast(f.dataType) for f in raw_schema("orders")], "rejected").write.mode(
        "overwrite"
    ).parquet(f"{target}/orders")
    tables = load_raw(spark, target)
    assert tables["sellers"].count() == 0 and tables["orders"].count() == 1
    assert csv_load.load_status({}).collect() == [] and row_counts({}).collect() == []


def test_raw_tables_read_back_without_rejects(spark, source, tmp_path):
    target = str(tmp_path / "raw")
    csv_load.load_directory(spark, str(source), target)
    for table in ("customers", "orders", "order_items", "order_payments", "products", "geolocation"):
        spark.createDataFrame([], raw_schema(table)).write.parquet(f"{target}/{table}")
    tables = load_raw(spark, target)
    counts = {row.table_name: row.row_count for row in row_counts(tables).collect()}
    assert counts["order_reviews"] == 3 and counts["sellers"] == 1 and counts["orders"] == 0
    assert list(counts) == sorted(counts)
    plan = tables["sellers"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan


def test_marts_are_rebuilt(spark, tmp_path):
    for n in (5, 3):
        stored = write_mart(spark.range(n), str(tmp_path), "numbers")
        assert stored.count() == n
    assert read_mart(spark, str(tmp_path), "numbers").count() == 3


def test_a_rebuild_that_fails_leaves_the_old_mart(spark, tmp_path):
    write_mart(spark.range(10), str(tmp_path), "numbers")
    reader = read_mart(spark, str(tmp_path), "numbers")
    broken = spark.range(1000).selectExpr("if(id = 777, raise_error('stop'), id) as id")
    with pytest.raises(PySparkException):
        write_mart(broken, str(tmp_path), "numbers")
    assert read_mart(spark, str(tmp_path), "numbers").count() == 10
    write_mart(spark.range(3), str(tmp_path), "numbers")
    assert reader.count() == 10  # a reader of the version before goes on
    for n in (4, 5, 6):
        write_mart(spark.range(n), str(tmp_path), "numbers")
    assert read_mart(spark, str(tmp_path), "numbers").count() == 6
    assert sum(p.name.startswith("version-") for p in (tmp_path / "numbers").iterdir()) == 2
    spark.range(8).write.parquet(str(tmp_path / "plain"))
    assert read_mart(spark, str(tmp_path), "plain").count() == 8


def test_catalog_tables_are_rebuilt(spark):
    for n in (4, 2):
        assert save_as_table(spark.range(n), "numbers_table").count() == n
    assert spark.table("numbers_table").count() == 2


def review(k, title="", message=""):
    return f"r{k},o{k},{k % 5 + 1},{title},{message},2018-01-18 00:00:00,2018-01-18 21:46:59"


HEADER = REVIEWS.split("\n", 1)[0]


def load_reviews(spark, tmp_path, lines, **conf):
    (tmp_path / "r.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        return csv_load.load_csv(spark, "order_reviews", str(tmp_path / "r.csv"), str(tmp_path / "raw"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


SMALL_BLOCKS = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}


@pytest.mark.parametrize("conf", [{}, SMALL_BLOCKS])
@pytest.mark.parametrize("quotes", [False, True])
def test_a_stray_quote_costs_one_line(spark, tmp_path, quotes, conf):
    lines = [review(k, message='"ok, ""fine"""' if quotes else "") for k in range(1002)]
    lines[1] = review(1, title='"never closed')
    loaded = load_reviews(spark, tmp_path, lines, **conf)
    assert sorted(int(r.review_id[1:]) for r in loaded.rows.collect()) == [0, *range(2, 1002)]
    assert [r.line for r in loaded.rejects.collect()] == [lines[1]]


@pytest.mark.parametrize("conf", [{}, SMALL_BLOCKS])
def test_records_of_several_lines_over_many_blocks(spark, tmp_path, conf):
    pick = random.Random(5)
    parts = ["a,b", 'he said ""so""', "x" * 90, "", "r7,o7,1,,,,", "plain", "1,2,3,4,5,6,7"]
    messages = {k: "\n".join(pick.choices(parts, k=pick.randrange(1, 7))) for k in range(400)}
    lines = [review(k, message=f'"{m}"') if k % 3 else review(k) for k, m in messages.items()]
    lines += [review(400, title=' "t" x'), review(401, title='t "x" y'), review(402) + ",more"]
    loaded = load_reviews(spark, tmp_path, lines, **conf)
    got = {r.review_id: r.review_comment_message for r in loaded.rows.collect()}
    blank = lambda m: m.replace('""', '"').strip() or None
    expected = {f"r{k}": blank(m) if k % 3 else None for k, m in messages.items()}
    got = {k: (v or "").strip() or None for k, v in got.items()}
    assert got == expected | {"r401": None}
    assert sorted(r.line for r in loaded.rejects.collect()) == sorted([lines[-3], lines[-1]])


def test_a_large_review_file_uses_many_tasks(spark, tmp_path):
    lines = [review(k, message='"two\nlines"') for k in range(500)]
    (tmp_path / "r.csv").write_text("\n".join([HEADER, *lines]))
    for key, value in SMALL_BLOCKS.items():
        spark.conf.set(key, value)
    try:
        frame = spark.read.text(str(tmp_path / "r.csv"))
        assert frame.rdd.getNumPartitions() > 20
        records = csv_records.read_records(spark, str(tmp_path / "r.csv"), 7, 5000)
        assert records.count() == 500 and records.filter("broken").count() == 0
    finally:
        for key in SMALL_BLOCKS:
            spark.conf.unset(key)


def test_headers_may_differ_between_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,x\n")
    (folder / "2.csv").write_text('b, "a"\ny,2\nz\n')
    (folder / "3.csv").write_text("b,c\nw,7\n")
    loaded = csv_load.load_csv_as_text(spark, str(folder), str(tmp_path / "out"))
    assert loaded.rows.columns == ["a", "b", "c"]
    assert sorted(map(tuple, loaded.rows.collect()), key=str) == [
        ("1", "x", None), ("2", "y", None), (None, "w", "7"),
    ]
    assert [r.line for r in loaded.rejects.collect()] == ["z"]
    report = csv_load.header_report(spark, csv_load.headers(spark, str(folder))).collect()
    assert {r.file: r.missing for r in report} == {"1.csv": ["c"], "2.csv": ["c"], "3.csv": ["a"]}


def test_a_reload_under_dynamic_overwrite_keeps_no_old_reject(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for score in ("five", "5"):
            loaded = load_reviews(spark, tmp_path, [f"r1,o1,{score},,,,"])
        assert loaded.rows.count() == 1 and loaded.rejects.count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
