"""The fact of order lines: how many rows one task gets."""

import pytest
from pyspark.sql import functions as F

from playstream.plans import metrics
from playstream.sources import star
from tests.helpers import rows

N = 24_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Lines in one file; orders 0 to 5,999, the first of them twice, and lines of no order and of a null one."""
    top = tmp_path_factory.mktemp("lines")
    ids = spark.range(0, N, 1, 1)
    ids.selectExpr(
        "if(id % 1000 = 0, NULL, id div 4 + if(id % 500 = 1, 100000, 0)) AS l_orderkey",
        "id % 700 AS l_partkey",
        "if(id % 11 = 0, NULL, id % 90) AS l_suppkey",
        "CAST(id % 4 + 1 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity",
        "if(id % 3 = 0, 'R', 'A') AS l_returnflag",
        "'F' AS l_linestatus",
        "timestamp_ntz'2024-01-29 00:00:00' + make_dt_interval(0, 0, 0, id * 8) AS l_shipdate",
    ).write.parquet(f"{top}/lineitem.parquet")
    orders = spark.range(0, N // 4, 1, 1).selectExpr("id AS o_orderkey", "if(id % 101 = 0, NULL, id % 300) AS o_custkey")
    orders.union(orders.limit(1)).coalesce(1).write.parquet(f"{top}/orders.parquet")
    return str(top)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
@pytest.mark.parametrize("table", ["hourly_metrics", "user_engagement_metrics"])
def test_a_task_joins_a_bounded_number_of_lines(spark, folder, monkeypatch, broadcast, table):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    plain = star.StarSchema(session, folder).order_events
    columns = metrics.windowed(plain, table).columns
    expected = rows(metrics.windowed(plain, table), *columns)

    monkeypatch.setattr(star, "LINES_PER_TASK", 1000, raising=False)
    dealt = star.StarSchema(session, folder).order_events
    held = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert max(r.n for r in held) <= 2000
    assert rows(metrics.windowed(dealt, table), *columns) == expected
    assert len(expected) > 50 and dealt.count() == plain.count() > N - 100


def test_few_lines_are_left_to_spark(spark, folder):
    plan = star.StarSchema(spark, folder).order_events._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan
