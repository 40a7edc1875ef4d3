"""Outputs that later runs replace in part, in one step, or read without a shuffle."""

import glob
import os

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from salesflow.checks.queries import QUERIES
from salesflow.operators import keep_dates
from salesflow.sinks import replace_table, save_bucketed, table_location, write_partitioned_csv


def sales(spark, *data):
    return spark.createDataFrame(list(data), "date string, city string, n long")


def read_back(spark, path):
    reader = spark.read.schema("date string, city string, n long, date_key string").option("header", True)
    return rows(reader.csv(path, sep=";").drop("date_key"))


def test_a_run_replaces_only_its_own_dates(spark, tmp_path):
    path = f"{tmp_path}/out"
    march = [("2025-03-01", "Lyon", 1), ("2025-03-01", "Gent", 2), ("2025-03-02", "Lyon", 3)]
    april = [("2025-04-01", "Lyon", 4)]
    write_partitioned_csv(sales(spark, *march), path)
    write_partitioned_csv(sales(spark, *april), path)
    assert read_back(spark, path) == sorted(march + april)
    write_partitioned_csv(sales(spark, ("2025-03-01", "Albi", 9)), path)
    assert read_back(spark, path) == sorted([("2025-03-01", "Albi", 9), march[2], *april])
    write_partitioned_csv(sales(spark, *april).limit(0), path)  # a run without rows
    assert len(read_back(spark, path)) == 3
    write_partitioned_csv(sales(spark, *april), path, replace="all")
    assert read_back(spark, path) == april
    with pytest.raises(ValueError, match="replace"):
        write_partitioned_csv(sales(spark, *april), path, replace="some")


def test_rows_without_a_date_are_replaced_together(spark, tmp_path):
    path = f"{tmp_path}/out"
    write_partitioned_csv(sales(spark, (None, "x", 1), ("2025-03-01", "y", 2)), path)
    write_partitioned_csv(sales(spark, (None, "z", 3)), path)
    assert read_back(spark, path) == [(None, "z", 3), ("2025-03-01", "y", 2)]


def test_a_failing_run_leaves_all_dates(spark, tmp_path):
    path = f"{tmp_path}/out"
    data = [("2025-03-01", "Lyon", 1), ("2025-03-02", "Lyon", 3)]
    write_partitioned_csv(sales(spark, *data), path)
    broken = sales(spark, *data).withColumn("n", F.when(F.col("n") == 3, F.raise_error(F.lit("broken"))).otherwise(7))
    with pytest.raises(Exception, match="broken"):
        write_partitioned_csv(broken.withColumn("n", F.col("n").cast("long")), path)
    assert read_back(spark, path) == data


@pytest.fixture
def table(spark):
    yield "stored_sales"
    spark.sql("drop table if exists stored_sales")


def test_replaced_table(spark, tmp_path, table):
    path = f"{tmp_path}/t"
    first = replace_table(sales(spark, ("a", "b", 1)), table, path=path)
    assert rows(spark.table(table)) == [("a", "b", 1)]
    held = spark.table(table)
    replace_table(spark.table(table).withColumn("n", F.col("n") + 1), table, path=path)  # reads itself
    assert rows(spark.table(table)) == [("a", "b", 2)]
    assert rows(held) and os.path.isdir(first)  # the version before is still there
    last = replace_table(sales(spark, ("c", None, None)), table, path=path)
    assert rows(spark.table(table)) == [("c", None, None)]
    assert not os.path.isdir(first) and len(glob.glob(f"{path}/version-*")) == 2
    assert table_location(spark, table).endswith(last.rsplit("/", 1)[1])


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path, table):
    path = f"{tmp_path}/t"
    replace_table(sales(spark, ("a", "b", 1)), table, path=path)
    broken = spark.range(0, 1000, 1, 4).select(
        F.lit("a").alias("date"),
        F.lit("b").alias("city"),
        F.when(F.col("id") == 999, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("n"),
    )
    with pytest.raises(Exception, match="broken"):
        replace_table(broken, table, path=path)
    assert rows(spark.table(table)) == [("a", "b", 1)] and len(glob.glob(f"{path}/version-*")) == 1
    for other in (sales(spark).drop("n"), sales(spark).withColumn("n", F.lit("text"))):
        with pytest.raises(ValueError, match="is parquet with"):
            replace_table(other, table, path=path)
    with pytest.raises(ValueError, match="not csv"):
        replace_table(sales(spark), table, path=path, format="csv")
    assert rows(spark.table(table)) == [("a", "b", 1)]


def test_all_older_versions_can_go(spark, tmp_path, table):
    for n in range(3):
        replace_table(sales(spark, ("a", "b", n)), table, path=f"{tmp_path}/t", keep=0)
    assert rows(spark.table(table)) == [("a", "b", 2)] and len(glob.glob(f"{tmp_path}/t/version-*")) == 1


def test_default_folder(spark, table):
    replace_table(sales(spark, ("a", "b", 1)), table, format="json")
    assert rows(spark.table(table), "date", "city", "n") == [("a", "b", 1)]
    assert f"{table}_versions/version-" in table_location(spark, table)


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, tmp_path):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(0, 5000, 1, 6).selectExpr("id % 900 as k", "id as v")
        right = spark.range(0, 3000, 1, 3).selectExpr("id % 1200 as j", "id as w")
        save_bucketed(left, "stored_left", ["k"], 8, path=f"{tmp_path}/l")
        save_bucketed(right, "stored_right", ["j"], 8, path=f"{tmp_path}/r")
        assert len(glob.glob(f"{tmp_path}/l/part-*")) <= 8  # one file per bucket
        sums = spark.table("stored_right").groupBy("j").agg(F.sum("w").alias("w"))
        joined = spark.table("stored_left").join(sums, F.col("k") == F.col("j"))
        assert "Exchange" not in plan_of(joined)
        wanted = left.join(right.groupBy("j").agg(F.sum("w").alias("w")), F.col("k") == F.col("j"))
        assert "Exchange" in plan_of(wanted) and rows(joined) == rows(wanted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("drop table if exists stored_left")
        spark.sql("drop table if exists stored_right")


def test_the_bucketed_query_shuffles_nothing(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan_of(QUERIES["join_bucketed"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dates_of_a_table_prune_folders(spark, tmp_path):
    data = spark.range(400).selectExpr("id", "concat('2025-01-', lpad(id % 20 + 1, 2, '0')) as day")
    data.repartition(1).write.partitionBy("day").parquet(f"{tmp_path}/t")
    stored = spark.read.schema("id long, day string").parquet(f"{tmp_path}/t")
    dates = spark.createDataFrame([("2025-01-03",), ("2025-01-03",), ("2025-01-19",), ("2030-01-01",), (None,)], "d string")
    kept = keep_dates(stored, dates, "day", "d")
    assert "dynamicpruningexpression" in plan_of(kept)
    assert rows(kept) == rows(data.filter("day in ('2025-01-03', '2025-01-19')"))
    assert kept.columns == stored.columns
    assert keep_dates(stored, dates.limit(0), "day", "d").count() == 0
    # the pruned folders are not even opened
    for gone in glob.glob(f"{tmp_path}/t/day=2025-01-0[4-9]/*.parquet"):
        with open(gone, "wb") as file:
            file.write(b"no parquet")
    assert kept.count() == 40


def test_the_query_prunes(spark, sf_dir):
    assert "dynamicpruningexpression" in plan_of(QUERIES["dates_from_table"](spark, sf_dir))
