"""Time the plans used here against row-by-row joins, on a fact with hot keys.

    python -m playstream.checks.formulations [--times 10]

The fact is the order-line fact repeated ``times`` times, with every third row
moved to one user, one song and one location. Broadcasting is switched off, as
for dimensions too large for it.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from playstream.model import STREAM_EVENTS  # noqa: E402
from playstream.plans import business, metrics, quality  # noqa: E402
from playstream.session import build_session, run_folder  # noqa: E402
from playstream.sinks.store import settled  # noqa: E402
from playstream.sources.star import StarSchema  # noqa: E402

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def hot_fact(star: StarSchema, times: int) -> DataFrame:
    hot = F.pmod(F.xxhash64("event_id", "copy"), F.lit(3)) == 0
    rows = star.order_events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
    for key in ("user_id", "song_id", "location_id"):
        rows = rows.withColumn(key, F.when(hot, F.lit(1)).otherwise(F.col(key)).cast("int"))
    spread = F.make_dt_interval(mins=F.pmod(F.xxhash64("copy", "event_id"), F.lit(1440)).cast("int"))
    rows = rows.withColumn("timestamp", F.col("timestamp") + spread)
    return settled(rows.select(*STREAM_EVENTS.columns), run_folder(star.spark, "hot-fact"))


def rowwise_top_songs(fact, star):
    return (
        fact.join(star.songs, "song_id")
        .join(star.artists.withColumnRenamed("name", "artist_name"), "artist_id")
        .groupBy("title", "artist_name")
        .count()
        .orderBy(F.desc("count"), "title", "artist_name")
        .limit(10)
    )


def rowwise_orphans(fact, star):
    parts = []
    for ref in STREAM_EVENTS.references:
        known = star.table(ref.parent).select(F.col(ref.key))
        orphans = fact.where(F.col(ref.column).isNotNull()).join(known, ref.column, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("count")).withColumn("issue", F.lit(ref.column)))
    return reduce(DataFrame.unionByName, parts)


def rowwise_subscription(fact, star):
    joined = fact.join(star.users, "user_id").groupBy("subscription_type")
    return joined.agg(F.count(F.lit(1)), F.count_distinct("user_id"), F.avg("stream_duration_seconds"))


def rowwise_reconciliation(fact, star):
    metric = metrics.windowed(fact, "user_engagement_metrics").select("time_window", "user_id", "stream_count")
    end = F.col("time_window") + F.expr("INTERVAL 5 MINUTES")
    paired = metric.join(fact.select("user_id", "timestamp"), "user_id").where(
        F.col("timestamp").between(F.col("time_window"), end)
    )
    counted = paired.groupBy("user_id", "time_window", "stream_count").count()
    return counted.where("count <> stream_count").orderBy("user_id", "time_window").limit(10)


def pairs(star: StarSchema):
    def reconciled(fact):
        return quality.metrics_reconciliation(metrics.windowed(fact, "user_engagement_metrics"), fact)

    return {
        "top_songs": (lambda f: business.top_songs(f, star.songs, star.artists), lambda f: rowwise_top_songs(f, star)),
        "orphan_counts": (
            lambda f: quality.orphan_counts(f, star.dimensions()),
            lambda f: rowwise_orphans(f, star),
        ),
        "activity_by_subscription": (
            lambda f: business.activity_by_subscription(f, star.users),
            lambda f: rowwise_subscription(f, star),
        ),
        "metrics_reconciliation": (reconciled, lambda f: rowwise_reconciliation(f, star)),
    }


def seconds(df: DataFrame) -> float:
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 2)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--times", type=int, default=10)
    parser.add_argument("--only", nargs="*")
    args = parser.parse_args()
    spark = build_session("formulations", "local[8]", 8, SETTINGS)
    spark.sparkContext.setLogLevel("ERROR")
    star = StarSchema(spark, "/root/testdata/sf0.1")
    fact = hot_fact(star, args.times)
    found = {"rows": fact.count()}
    for name, (ours, rowwise) in pairs(star).items():
        if args.only and name not in args.only:
            continue
        seconds(ours(fact))  # warm up
        found[name] = {"here": seconds(ours(fact)), "row_by_row": seconds(rowwise(fact))}
        print(name, found[name], flush=True)
    print(json.dumps(found))
    spark.stop()


if __name__ == "__main__":
    main()
