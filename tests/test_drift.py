"""Input files that are not as they should be: malformed records, drifting columns."""

import json
from glob import glob

import pytest
from conftest import rows
from pyspark.sql import types as T
from test_files import run, write, write_inputs

from salesflow.sources import common_type, read_drifting_csv, read_orders, split_malformed
from salesflow.staging import stage

GOOD = '{"order_id": "A", "payment_status": "paid", "items": [{"qty": 1, "sku": "s", "unit_price": "2,5"}]}'
CUT = '{"order_id": "B", "payment_status": "paid", "items": [{"qty"'
ODD = '{"order_id": "C", "payment_status": "paid", "items": "none"}'


def parts_of(spark, path, **options):
    read = stage(read_orders(spark, path, malformed="bad", **options), "orders")
    return split_malformed(read, "bad")


@pytest.mark.parametrize("infer", [False, True])
def test_malformed_lines_go_to_the_quarantine(spark, tmp_path, infer):
    write(tmp_path / "in/a.json", f"{GOOD}\n{CUT}\n\n{ODD}\n")
    write(tmp_path / "in/b.json", f"[]\nno json é\n{GOOD}\n")
    orders, quarantine = parts_of(spark, f"{tmp_path}/in/*.json", multiline=False, infer=infer)
    found = [(r["file"].rsplit("/", 1)[1], r["record"]) for r in quarantine.collect()]
    wanted = {("a.json", CUT), ("b.json", "no json é")} | (set() if infer else {("a.json", ODD)})
    assert set(found) - {("b.json", "[]")} == wanted
    assert "bad" not in orders.columns and "bad_file" not in orders.columns
    paid = rows(orders.filter("payment_status = 'paid'"), "order_id")
    assert {("A",), ("C",)} <= set(paid) and paid.count(("A",)) == 2  # ODD is read but for its items


def test_whole_files_have_no_quarantine(spark, tmp_path):
    write(tmp_path / "in/a.json", f"[{GOOD}, {GOOD}]")
    for infer in (False, True):
        orders, quarantine = parts_of(spark, f"{tmp_path}/in/*.json", infer=infer)
        assert orders.count() == 2 and quarantine.count() == 0


def test_an_array_that_breaks_off(spark, tmp_path):
    write(tmp_path / "in/a.json", f"[{GOOD}]")
    write(tmp_path / "in/b.json", text := f"[{GOOD}, {CUT}")
    _, quarantine = parts_of(spark, f"{tmp_path}/in/*.json")
    assert {(r["file"].rsplit("/", 1)[1], r["record"]) for r in quarantine.collect()} == {("b.json", text)}


def test_the_job_reports_malformed_records(spark, tmp_path):
    write_inputs(tmp_path / "in")
    before = run(spark, tmp_path).first().asDict()
    write(tmp_path / "in/sales_w9.json", text := f"[{CUT}")
    after = run(spark, tmp_path).first().asDict()
    assert (before["orders_malformed"], after["orders_malformed"]) == (0, 1)
    assert after["orders_clean_rows"] == before["orders_clean_rows"]
    saved = [json.loads(x) for p in glob(f"{tmp_path}/out/rejects/malformed_orders/part-*") for x in open(p)]
    assert [(r["file"].rsplit("/", 1)[1], r["record"]) for r in saved] == [("sales_w9.json", text)]


def test_columns_that_drift(spark, tmp_path):
    write(tmp_path / "in/a.csv", "id,amount,day\n1,2,2025-01-01\n2,,2025-01-02\n")
    write(tmp_path / "in/b.csv", "amount,id,note\n2.5,3,\"x, y\"\n")
    write(tmp_path / "in/c.csv", "id,day\nK7,2025-01-03 10:00:00\n")
    write(tmp_path / "in/d.csv", "\n\nid,amount,day\n4,7,2025-01-04\n")  # like a, after empty lines
    write(tmp_path / "in/e.csv", "id,amount,day,note\n")  # no rows: its types are not known
    df = read_drifting_csv(spark, f"{tmp_path}/in/*.csv")
    assert dict(df.dtypes) == {"id": "string", "amount": "double", "day": "timestamp", "note": "string"}
    assert df.columns == ["id", "amount", "day", "note"]
    found = [(i, a, str(d) if d else None, n) for i, a, d, n in rows(df)]
    assert sorted(found) == [
        ("1", 2.0, "2025-01-01 00:00:00", None),
        ("2", None, "2025-01-02 00:00:00", None),
        ("3", 2.5, None, "x, y"),
        ("4", 7.0, "2025-01-04 00:00:00", None),
        ("K7", None, "2025-01-03 10:00:00", None),
    ]
    text = read_drifting_csv(spark, f"{tmp_path}/in/*.csv", infer=False)
    assert set(dict(text.dtypes).values()) == {"string"} and text.count() == 5
    narrow = text.select("note")
    assert "ReadSchema: struct<note:string>" in narrow._jdf.queryExecution().executedPlan().toString()


def test_an_empty_column_does_not_make_text(spark, tmp_path):
    write(tmp_path / "in/a.csv", "id,amount\n1,2\n")
    write(tmp_path / "in/b.csv", "id,amount,x\n1,,7\n")
    assert dict(read_drifting_csv(spark, f"{tmp_path}/in").dtypes) == {"id": "int", "amount": "int", "x": "int"}


def test_values_keep_their_text_where_types_conflict(spark, tmp_path):
    write(tmp_path / "in/a.csv", "code;n\n007;1\n")
    write(tmp_path / "in/b.csv", "n;code\n2;A1\n")
    df = read_drifting_csv(spark, f"{tmp_path}/in", sep=";")
    assert rows(df, "code", "n") == [("007", 1), ("A1", 2)]


def test_headers_that_cannot_be_read(spark, tmp_path):
    write(tmp_path / "a/a.csv", "id,ID\n1,2\n")
    write(tmp_path / "b/a.csv", "id,x\n1,2\n")
    write(tmp_path / "b/b.csv", "Id,x\n1,2\n")
    write(tmp_path / "c/a.csv", "id,\n1,2\n")
    write(tmp_path / "d/a.csv", "\n")
    for folder, error in (("a", ValueError), ("b", ValueError), ("c", ValueError), ("d", FileNotFoundError), ("e", FileNotFoundError)):
        with pytest.raises(error):
            read_drifting_csv(spark, f"{tmp_path}/{folder}")


def test_common_types():
    i, l, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()  # noqa: E741
    day, time = T.DateType(), T.TimestampType()
    cases = [([i], i), ([i, l], l), ([i, i], i), ([i, d], d), ([l, T.DecimalType(20, 0)], d), ([day, time], time)]
    for types, wanted in [*cases, ([day, i], s), ([i, s], s), ([T.BooleanType(), i], s)]:
        assert common_type(types) == common_type(types[::-1]) == wanted
