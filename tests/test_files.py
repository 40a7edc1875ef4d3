import csv
import gzip
import json
import os
import re
from glob import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_sales import CUSTOMERS, ORDERS, REFUNDS, order

from salesflow import staging as staging_module
from salesflow.checks import queries
from salesflow.functions import is_non_numeric, safe_double
from salesflow.operators import explode_items, number_sorted
from salesflow.plans import SalesOptions, job, run_sales_job
from salesflow.sinks import files as sink_files
from salesflow.sinks import save_table, write_csv, write_json_arrays, write_lines, write_partitioned_csv
from salesflow.sources import list_files, read_customers, read_lines, read_orders, read_refunds
from salesflow.staging import cleanup, scratch_path, stage, staging

ORDER_FIELDS = ("channel", "created_at", "customer_id", "items", "order_id", "payment_status")


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def json_value(text):
    """A number where the text is one, text otherwise: files hold both."""
    return text if "," in text else float(text)


def write_inputs(folder, orders=ORDERS):
    def table(name, header, data):
        folder.mkdir(parents=True, exist_ok=True)
        with open(folder / name, "w", encoding="utf-8", newline="") as f:
            csv.writer(f).writerows([header, *data])

    table("customers.csv", ["customer_id", "city", "is_active"], CUSTOMERS)
    table("refunds.csv", ["order_id", "amount", "created_at"], REFUNDS)
    for week, some in enumerate((orders[:3], orders[3:])):
        records = [dict(zip(ORDER_FIELDS, o, strict=True)) for o in some]
        for r in records:
            r["items"] = [{"qty": json_value(q), "unit_price": json_value(p)} for q, _, p in r["items"]]
        write(folder / f"sales_w{week}.json", json.dumps(records, indent=1))


# --- sources ----------------------------------------------------------------------------


def test_missing_files_are_errors(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for read, path in [
        (read_customers, "none.csv"), (read_refunds, "none.csv"), (read_lines, "none.txt"),
        (read_orders, "sales_w*.json"), (read_orders, "empty"),
    ]:
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path / path))


def test_csv_columns_go_by_name(spark, tmp_path):
    one = write(tmp_path / "1.csv", "city,vip,is_active,customer_id\nParis,x,YES,007\n")
    assert rows(read_customers(spark, one)) == [("Paris", "x", True, "007")]
    two = write(tmp_path / "2.csv", "customer_id,city,is_active,vip\n8,Lyon,1,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_customers(spark, [one, two]).collect()


def test_order_fields_outside_the_schema(spark, tmp_path):
    path = write(tmp_path / "o.json", '{"order_id":"A","note":"n","items":[{"qty":1,"unit_price":2,"size":"L"}]}')
    assert "note" not in read_orders(spark, path).columns
    lines = explode_items(read_orders(spark, path, infer=True))
    assert rows(lines, "note", "item_size", "item_qty") == [("n", "L", 1)]
    own = read_orders(spark, path, schema="order_id string, note string")
    assert rows(own) == [("A", "n")]


def test_customers(spark, tmp_path):
    path = write(tmp_path / "c.csv", "customer_id,city,is_active\n007,Paris,YES\n8,Lyon,\n9,Nice,no\n")
    expected = [("007", "Paris", True), ("8", "Lyon", None), ("9", "Nice", False)]
    assert rows(read_customers(spark, path)) == expected
    assert rows(read_customers(spark, path, raw=True), "is_active") == [(None,), ("YES",), ("no",)]
    inferred = read_customers(spark, path, infer=True)
    assert rows(inferred, "customer_id", "is_active") == [("7", True), ("8", None), ("9", False)]


def test_refunds(spark, tmp_path):
    path = write(tmp_path / "r.csv", 'order_id,amount,created_at\nO1,"2,5",2025-03-01\nO2,error,2025-03-02\n')
    expected = [("O1", 2.5, "2025-03-01"), ("O2", 0.0, "2025-03-02")]
    assert rows(read_refunds(spark, path)) == expected
    assert rows(read_refunds(spark, path, infer=True)) == expected


@pytest.mark.parametrize("infer", [False, True])
def test_orders_from_arrays_over_many_lines(spark, tmp_path, infer):
    write_inputs(tmp_path)
    write(tmp_path / "other.json", "[]")
    orders = read_orders(spark, f"{tmp_path}/sales_w*.json", infer=infer)
    assert list_files(spark, f"{tmp_path}/sales_w*.json").count() == 2
    assert rows(orders, "order_id") == [("A-1",), ("A-2",), ("A-3",), ("A-4",), ("A-5",)]
    lines = explode_items(orders).select("order_id", "pos", safe_double("item_unit_price"))
    assert rows(lines) == [
        ("A-1", 0, 2.5), ("A-1", 1, 99.0), ("A-2", 0, 3.0), ("A-3", 0, -1.0), ("A-3", 1, 1.5), ("A-4", 0, 0.75), ("A-5", 0, 1.0),
    ]


def test_several_paths_are_one_table(spark, tmp_path):
    write_inputs(tmp_path)
    paths = sorted(glob(f"{tmp_path}/sales_w*.json"))
    assert read_orders(spark, paths).count() == 5


def test_days_without_a_file(spark, tmp_path):
    write_inputs(tmp_path)
    paths = [f"{tmp_path}/sales_w{i}.json" for i in range(4)]
    assert read_orders(spark, paths, ignore_missing=True).count() == 5
    assert list_files(spark, paths, ignore_missing=True).count() == 2
    with pytest.raises(FileNotFoundError):
        read_orders(spark, paths).count()
    with pytest.raises(FileNotFoundError):
        read_orders(spark, paths[2:], ignore_missing=True)


def test_numbers_keep_their_type(spark, tmp_path):
    """Numbers count in any notation, text with an exponent does not."""
    values = ["1e2", "1E3", "12345678.9", "3.0e-5", "-0.5", "7", '"1e2"', '" 2,5 "', "null", "true", '"x"', "1e400"]
    lines = "".join('{"order_id":"%d","items":[{"qty":%s,"unit_price":%s}]}\n' % (i, v, v) for i, v in enumerate(values))
    path = write(tmp_path / "o.json", lines)
    items = explode_items(read_orders(spark, path, multiline=False))
    found = items.select(F.col("order_id").cast("int"), safe_double("item_qty"), is_non_numeric("item_unit_price"))
    assert [tuple(r)[1:] for r in found.orderBy("order_id").collect()] == [
        (100.0, False), (1000.0, False), (12345678.9, False), (3.0e-5, False), (-0.5, False), (7.0, False),
        (0.0, True), (2.5, False), (0.0, None), (0.0, True), (0.0, True), (0.0, True),
    ]


def test_trim_and_encoding(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes("customer_id,city,is_active\n1,Liège, yes \n".encode("latin-1"))
    read = read_customers(spark, str(path), encoding="ISO-8859-1", trim=True)
    assert rows(read, "city", "is_active") == [("Liège", True)]
    assert rows(read_customers(spark, str(path)), "is_active") == [(False,)]


def test_broken_order_fields_become_null(spark, tmp_path):
    path = write(tmp_path / "o.json", '{"order_id":"A","items":"none"}\nnot json\n{"order_id":"B","qty":1}\n')
    orders = read_orders(spark, path, multiline=False)
    assert rows(orders, "order_id", "items") == [(None, None), ("A", None), ("B", None)]


def test_lines_and_folders_of_part_files(spark, tmp_path):
    path = f"{tmp_path}/lines"
    df = spark.createDataFrame([("rust in the hinge",), ("4 bolts",), ("",)], "value string").repartition(3)
    write_lines(df, path)
    assert rows(read_lines(spark, path)) == [("",), ("4 bolts",), ("rust in the hinge",)]
    assert os.path.exists(f"{path}/_SUCCESS")


# --- sinks ------------------------------------------------------------------------------

DAILY = [
    ("2025-03-02", "Lyon", 1, 1.5), ("2025-03-01", "Paris", 2, 123456789.125),
    ("2025-03-01", "Lyon", 3, None), ("2025-03-02", "Albi", 4, 0.0),
]


def daily(spark):
    return spark.createDataFrame(DAILY, "date string, city string, n long, eur double").repartition(3)


def parts(path):
    return sorted(glob(f"{path}/part-*.csv"))


def read_text(path):
    with open(path, encoding="utf-8") as f:
        return f.read().splitlines()


SORTED = ["2025-03-01;Lyon;3;", "2025-03-01;Paris;2;123456789.13", "2025-03-02;Albi;4;0.00", "2025-03-02;Lyon;1;1.50"]


def test_json_arrays_are_joined_without_a_shuffle(spark, tmp_path):
    """Whole arrays of a bounded number of rows, compressed; no job of the write has a second stage."""
    orders = spark.range(0, 25, 1, 3).selectExpr("cast(id as string) order_id", "if(id = 7, null, 'pa\u00efd, ]') payment_status")
    path, group = str(tmp_path / "out"), "json arrays"
    spark.sparkContext.setJobGroup(group, group)
    write_json_arrays(orders, path, max_rows_per_file=5, compression="gzip")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    assert [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group)] == [1]
    texts = []
    for file in glob(f"{path}/part-*"):
        with gzip.open(file, "rt", encoding="utf-8") as f:
            texts.append(f.read())
    arrays = [json.loads(t) for t in texts]
    assert all(0 < len(a) <= 5 for a in arrays) and min(t.count("\n") for t in texts) > 2
    assert sorted(int(r["order_id"]) for a in arrays for r in a) == list(range(25))
    back = read_orders(spark, f"{path}/part-*")
    assert rows(back, "order_id", "payment_status") == rows(orders)


def test_array_files_of_the_query(spark, tmp_path, monkeypatch):
    """Its orders are shuffled for their own join only, and its files are compressed."""
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    star_tables(spark, tmp_path / "in", 300)
    found = queries.src_json_arrays(spark, str(tmp_path / "in"))
    assert found.count() == 600 and found.select("order_id").distinct().count() == 300
    files = glob(f"{tmp_path}/orders/part-*")
    assert files and all(f.endswith(".gz") for f in files)


def test_order_files_of_the_job_queries(spark, tmp_path, monkeypatch):
    """Orders as compressed lines, all of which the job reads."""
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    star_tables(spark, tmp_path / "in", 300)
    report = queries.run_report(spark, str(tmp_path / "in")).first()
    assert report["status"] == "OK" and report["orders_rows_raw"] == 300 and report["rejected_negative_price_rows"] == 100
    files = glob(f"{tmp_path}/input/orders/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)


def star_tables(spark, folder, n):
    """Small tables of the star schema: ``n`` paid orders of a line each."""
    day = "timestamp_ntz'2025-03-01 10:00:00'"
    tables = {
        "nation": "1 n_nationkey, 'CHILE' n_name, 1 n_regionkey",
        "customer": "id + 1 c_custkey, 'c' c_name, 1 c_nationkey, 0D c_acctbal, 'x' c_mktsegment",
        "orders": f"id o_orderkey, id % 7 + 1 o_custkey, 'F' o_orderstatus, 1D o_totalprice, {day} o_orderdate, '1' o_orderpriority",
        "lineitem": "id l_orderkey, id + 1 l_partkey, 2L l_suppkey, 1 l_linenumber, 2D l_quantity, 3.5D l_extendedprice, "
        f"if(id % 3 = 0, 0D, 0.1D) l_discount, 0.05D l_tax, 'R' l_returnflag, 'F' l_linestatus, {day} l_shipdate",
    }
    for name, columns in tables.items():
        spark.sql(f"select {columns} from range({1 if name == 'nation' else n})").write.parquet(f"{folder}/{name}.parquet")


def test_csv_is_sorted_over_its_parts(spark, tmp_path):
    path = f"{tmp_path}/out"
    for _ in range(2):  # the second run replaces the first
        write_csv(daily(spark), path, sort_by=["date", "city"])
    lines = [line for p in parts(path) for line in read_text(p)]
    assert [x for x in lines if x != "date;city;n;eur"] == SORTED


def test_csv_options(spark, tmp_path):
    path = f"{tmp_path}/out"
    write_csv(daily(spark).coalesce(1), path, sep="|", header=False, float_format=None)
    assert "2025-03-01|Paris|2|1.23456789125E8" in read_text(parts(path)[0])
    write_csv(daily(spark), path, compression="gzip")
    assert glob(f"{path}/part-*.csv.gz")


def test_one_folder_per_date(spark, tmp_path):
    path = f"{tmp_path}/out"
    write_partitioned_csv(daily(spark), path, sort_by=["city"])
    assert len(glob(f"{path}/date_key=*/part-*")) == 2
    assert sorted(os.path.basename(p) for p in glob(f"{path}/date_key=*")) == [
        "date_key=20250301", "date_key=20250302",
    ]
    for key, expected in (("20250301", SORTED[:2]), ("20250302", SORTED[2:])):
        lines = [x for p in parts(f"{path}/date_key={key}") for x in read_text(p)]
        assert [x for x in lines if x != "date;city;n;eur"] == expected
    back = spark.read.schema("date string, city string, n long, eur double, date_key string")
    one = back.option("header", True).csv(path, sep=";").filter("date_key = '20250302'")
    assert rows(one, "city") == [("Albi",), ("Lyon",)]
    assert "PartitionFilters: [isnotnull(date_key" in one._jdf.queryExecution().executedPlan().toString()


def test_a_large_date_gets_several_files(spark, tmp_path):
    df = spark.range(2000).selectExpr("'2025-03-01' as date", "cast(id as string) as city", "id as n")
    df = df.unionByName(spark.createDataFrame([(None, "x", 1)], "date string, city string, n long"))
    write_partitioned_csv(df, f"{tmp_path}/out", sort_by=["city"], max_rows_per_file=500)
    lines = [read_text(p)[1:] for p in parts(f"{tmp_path}/out/date_key=20250301")]
    assert len(lines) > 1 and sum(map(len, lines)) == 2000
    assert all(x == sorted(x, key=lambda line: line.split(";")[1]) for x in lines)
    back = spark.read.option("header", True).csv(f"{tmp_path}/out", sep=";")
    assert back.count() == 2001 and back.filter("date_key is null").count() == 1


def test_save_table_replaces(spark, tmp_path):
    for frame in (daily(spark), daily(spark).limit(1)):
        assert save_table(frame, "saved_daily", path=f"{tmp_path}/t") == "parquet"
    assert spark.table("saved_daily").count() == 1
    spark.sql("drop table saved_daily")


NO_DRIVER = {"format": "jdbc", "url": "jdbc:none:x", "driver": "none.Driver"}


def test_jdbc_without_driver_falls_back(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert save_table(daily(spark), "t", **NO_DRIVER, fallback_format="csv", fallback_path=path) == "csv"
    assert sum(len(read_text(p)) - 1 for p in parts(path)) == 4
    assert save_table(daily(spark), "t", **NO_DRIVER, fallback_format="parquet", fallback_path=path) == "parquet"
    assert rows(spark.read.parquet(path)) == rows(daily(spark))
    no_url = {"format": "jdbc", "url": "jdbc:none:x"}
    assert save_table(daily(spark), "t", **no_url, fallback_format="csv", fallback_path=path) == "csv"


def test_other_jdbc_failures_are_raised(spark, tmp_path, monkeypatch):
    with pytest.raises(Exception, match="none.Driver"):
        save_table(daily(spark), "t", **NO_DRIVER)
    monkeypatch.setattr(sink_files, "_driver_is_missing", lambda e: False)
    with pytest.raises(Exception, match="none.Driver"):
        save_table(daily(spark), "t", **NO_DRIVER, fallback_format="csv", fallback_path=f"{tmp_path}/t")


# --- staging ----------------------------------------------------------------------------


def test_stage_uses_the_checkpoint_folder(spark, tmp_path):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    assert path.startswith(named.rstrip("/") + "/" if named else "/")
    staged = stage(daily(spark), "daily")
    assert rows(staged) == rows(daily(spark))
    assert staged.schema == daily(spark).schema


def test_masters_with_executors_elsewhere():
    masters = {"local": False, "local[8]": False, "local[*]": False, "local-cluster[3,2,1024]": True, "yarn": True}
    assert {m: staging_module._is_cluster(m) for m in masters} == masters


def test_staging_cleans_up(spark):
    with pytest.raises(RuntimeError), staging(spark, "x") as stage_here:
        staged = stage_here(daily(spark), "daily")
        folder = re.sub("^file:", "", staged.inputFiles()[0].rsplit("/", 1)[0])
        assert staged.count() == 4 and os.path.isdir(folder)
        raise RuntimeError
    assert not os.path.exists(os.path.dirname(folder))


def test_nothing_is_left_after_cleanup(spark):
    """Tables behind returned DataFrames are deleted with the application's scratch folder."""
    numbered = number_sorted(daily(spark), F.col("n"))
    assert numbered.count() == 4
    folder = re.sub("^file:/*", "/", os.path.dirname(scratch_path(spark, "x")))
    assert os.listdir(folder)
    cleanup(spark)
    assert not os.path.exists(folder)


# --- the whole job ----------------------------------------------------------------------


def run(spark, folder, **options):
    return run_sales_job(
        spark,
        f"{folder}/in/customers.csv",
        f"{folder}/in/refunds.csv",
        f"{folder}/in/sales_w*.json",
        f"{folder}/out",
        **options,
    )


HEADER = "date;city;channel;orders_count;unique_customers;items_sold;gross_revenue_eur;refunds_eur;net_revenue_eur"
DAYS = ["2024-06-30;Gent;app;2;2;10;19.00;-5.00;14.00", "2024-07-01;Gent;app;1;1;10;7.50;0.00;7.50"]


def body(path, header):
    return [x for p in parts(path) for x in read_text(p) if not x.startswith(header)]


def test_job(spark, tmp_path):
    write_inputs(tmp_path / "in")
    for _ in range(2):  # a second run replaces the outputs of the first
        report = run(spark, tmp_path).first().asDict()
    out = tmp_path / "out"
    counters = {k: v for k, v in report.items() if isinstance(v, int) and not isinstance(v, bool)}
    assert counters == {
        "orders_files": 2, "customers_rows_raw": 3, "dup_customers": 0, "refunds_rows": 4,
        "refunds_amount_non_numeric": 1, "orders_rows_raw": 5, "orders_rows_paid": 4, "orders_bad_date": 0,
        "items_qty_non_numeric": 0, "items_unit_price_non_numeric": 0, "rejected_negative_price_rows": 1,
        "orders_clean_rows": 3, "daily_city_sales_rows": 2, "orders_malformed": 0,
    }
    assert report["status"] == "OK" and report["jdbc_written"] is False and report["duration_sec"] > 0
    assert body(out / "out/daily_summary_all", "date") == DAYS  # sorted over the parts
    assert [read_text(p) for p in parts(out / "out/daily_summary/date_key=20240701")] == [[HEADER, DAYS[1]]]
    assert sorted(body(out / "db/daily_city_sales", "date")) == DAYS
    assert sorted(body(out / "db/orders_clean", "order_id")) == [
        "A-1;17;Gent;app;2024-06-30;4;10.00", "A-3;19;Gent;app;2024-06-30;6;9.00", "A-4;19;Gent;app;2024-07-01;10;7.50",
    ]
    rejected = body(out / "rejects/rejects_items", "channel")
    assert [x.split(";")[:4] + x.split(";")[-2:] for x in rejected] == [["app", "2024-06-30", "19", "A-3", "2.0", "-1.0"]]
    saved = json.loads(read_text(glob(f"{out}/logs/run_report/part-*.json")[0])[0])
    assert saved["daily_city_sales_rows"] == 2
    files = [x for p in glob(f"{out}/logs/orders_files/part-*.txt") for x in read_text(p)]
    assert sorted(re.sub(".*/", "", f) for f in files) == ["sales_w0.json", "sales_w1.json"]


def test_job_without_rejects_writes_none(spark, tmp_path):
    write_inputs(tmp_path / "in", [ORDERS[3], ORDERS[4], ORDERS[1], ORDERS[0]])
    report = run(spark, tmp_path, infer=True, options=SalesOptions(dedup="order")).first()
    assert report.rejected_negative_price_rows == 0 and report.orders_clean_rows == 2
    assert not (tmp_path / "out/rejects").exists()


def test_job_falls_back_to_csv_in_its_own_format(spark, tmp_path):
    orders = [order("B", "2024-06-30", [("1", "1234567.891")])]
    write_inputs(tmp_path / "in", orders)
    jdbc = {"url": "jdbc:none:x", "driver": "none.Driver"}
    report = run(spark, tmp_path, jdbc=jdbc, sep=",", float_format=None).first()
    assert report.jdbc_written is False
    assert body(tmp_path / "out/db/orders_clean", "order_id") == ["B,17,Gent,app,2024-06-30,1,1234567.891"]


def test_job_releases_what_it_held_when_it_fails(spark, tmp_path, monkeypatch):
    write_inputs(tmp_path / "in")
    monkeypatch.setattr(job, "write_partitioned_csv", lambda *a, **k: 1 / 0)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(ZeroDivisionError):
        run(spark, tmp_path)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_job_needs_its_inputs(spark, tmp_path):
    write_inputs(tmp_path / "in")
    os.remove(tmp_path / "in/refunds.csv")
    with pytest.raises(FileNotFoundError):
        run(spark, tmp_path)
