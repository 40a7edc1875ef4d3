"""Hot keys: with broadcast off and small limits, Spark must be able to split their partitions."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from salesflow.operators import group_values, join_dimension, keep_first
from salesflow.plans import sales
from salesflow.sinks import write_partitioned_csv
from salesflow.staging import stage

LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
}
N = 60_000


@pytest.fixture(autouse=True)
def small_limits(spark):
    before = {k: spark.conf.get(k, None) for k in LIMITS}
    for k, v in LIMITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def facts(spark):
    """A third of the rows has key 0; read from files, so that several tasks hold it."""
    rows = spark.range(0, N, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 0, id % 997) as k", "md5(cast(id as string)) as payload"
    )
    return stage(rows, "facts")


@pytest.fixture
def dimension(spark):
    return spark.range(0, 1200).selectExpr("id as key", "concat('city', id % 7) as city")


def finished(df):
    """The plan as adapted while it ran."""
    df.collect()
    return plan_of(df)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_hot_fact_key_is_split(facts, dimension, how):
    joined = join_dimension(facts, dimension, "k", "key", how)
    assert "skew=true" in finished(joined)
    unused = 1200 - 997 if how in ("right", "full") else 0
    assert joined.count() == N + unused


def test_hot_group_is_split_before_it_is_collected(facts):
    groups = group_values(facts, F.col("k"), F.col("payload"), max_values=500)
    assert "skew=true" in finished(groups)
    found = groups.groupBy("key").agg(F.sum(F.size("values")), F.max(F.size("values")), F.count("*"))
    total, largest, chunks = [tuple(r)[1:] for r in found.collect() if r.key == 0][0]
    assert total == facts.filter("k = 0").count() and chunks >= total // 500 and largest < 1000


def test_hot_customer_in_orders_clean_is_split(facts, dimension):
    orders = facts.selectExpr(
        "cast(id as string) as order_id", "cast(k as string) as customer_id", "payload as channel",
        "'2025-03-01' as created_at", "1L as items_sold", "1.0D as gross_revenue_eur",
    )
    active = dimension.selectExpr("cast(key as string) as customer_id", "city")
    clean = sales.orders_clean(orders, active)
    assert "skew=true" in finished(clean)
    assert clean.count() == N


def test_hot_customer_shrinks_before_the_daily_join(facts, dimension):
    orders = facts.selectExpr(
        "cast(id as string) as order_id", "cast(k as string) as customer_id", "'web' as channel",
        "'2025-03-01' as created_at", "1L as items_sold", "1.0D as gross_revenue_eur", "0.0D as refunds_eur",
    )
    active = dimension.selectExpr("cast(key as string) as customer_id", "city")
    daily = sales.daily_city_sales(orders, active)
    result = daily.collect()
    assert sum(r.orders_count for r in result) == N
    assert sum(r.unique_customers for r in result) == 997
    plan = plan_of(daily)
    assert plan.index("SortMergeJoin") < plan.rindex("partial_count(order_id")  # summed below the join


def test_hot_key_is_cut_before_the_dedup_shuffle(facts):
    first = keep_first(facts, ["k"], ["id"])
    assert first.count() == 997 and rows(first.filter("k = 0"), "id") == [(0,)]
    first.collect()
    written = _shuffle_rows(first)  # at most one row per key and task
    assert written and max(written) <= 8 * 997


def _shuffle_rows(df):
    """Rows written by the shuffles of an executed plan."""
    found = []

    def visit(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(plan.plan())
        if name == "ShuffleExchangeExec":
            found.append(plan.metrics().apply("shuffleRecordsWritten").value())
        children = plan.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return found


def test_one_date_is_written_by_many_tasks(facts, tmp_path):
    """Half of the rows of the date are copies of one row."""
    out = facts.selectExpr("'2025-03-01' as date", "if(id % 2 = 0, 'copy', payload) as city")
    write_partitioned_csv(out, f"{tmp_path}/out", max_rows_per_file=N // 64)
    files = list((tmp_path / "out" / "date_key=20250301").glob("part-*.csv"))
    lines = sorted(len(f.read_text().splitlines()) - 1 for f in files)
    assert len(files) == 8 and sum(lines) == N
    assert lines[-1] < N // 2
