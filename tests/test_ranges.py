"""The range join against all pairs."""

import random
from datetime import datetime, timedelta

from playstream.operators.ranges import range_join
from tests.helpers import rows

START = datetime(2024, 1, 1)


def made(seed=4):
    chooser = random.Random(seed)
    at = lambda: START + timedelta(microseconds=chooser.randrange(6 * 3600 * 10**6))
    points = [(chooser.choice([1, 1, 1, 2, 3, None]), i, at()) for i in range(400)] + [(1, 900, None)]
    spans = []
    for i in range(60):
        begin = at()
        spans.append((chooser.choice([1, 2, None]), i, begin, begin + timedelta(seconds=chooser.choice([0, -5, 1, 900, 20_000]))))
    spans.append((1, 99, points[0][2], points[0][2] + timedelta(microseconds=1)))
    return points, spans


def test_against_all_pairs(spark):
    points, spans = made()
    want = sorted(
        (k, p, i) for k, p, t in points for k2, i, b, e in spans if k == k2 and k is not None and t is not None and b <= t < e
    )
    left = spark.createDataFrame(points, "k int, p int, t timestamp_ntz")
    right = spark.createDataFrame(spans, "k int, i int, b timestamp_ntz, e timestamp_ntz")
    for width, most in ((3600, 50_000), (60, 50_000), (3600, 7), (86_400, 3)):
        got = range_join(left, right, ["k"], "t", "b", "e", width, most)
        assert rows(got, "k", "p", "i") == sorted(want, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_hot_key_is_dealt_over_several_places(spark):
    left = spark.range(3000).selectExpr("1 AS k", "id AS p", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS t")
    right = spark.sql("SELECT 1 AS k, 5 AS i, TIMESTAMP_NTZ '2023-12-31 23:00:00' AS b, TIMESTAMP_NTZ '2024-01-01 00:00:01' AS e")
    got = range_join(left, right, ["k"], "t", "b", "e", most=100)
    assert got.count() == 3000
    assert "_place" in got._jdf.queryExecution().optimizedPlan().toString()
