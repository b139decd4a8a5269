"""Check the stored tables: ``python -m playstream.jobs.validate --root R``. Ends with 1 if a reference is broken."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from playstream import model
from playstream.jobs.common import arguments, dimensions, parser
from playstream.plans import quality
from playstream.session import build_session
from playstream.sinks.store import FileStore


def main(given: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments(parser(__doc__), given)
    spark = spark or build_session("validate")
    store = FileStore(args.root)
    known = dimensions(store, spark)
    events = store.read(spark, model.STREAM_EVENTS)
    metric_tables = {t.name: store.read(spark, t) for t in model.METRIC_TABLES}
    quality.table_counts(known | {model.STREAM_EVENTS.name: events} | metric_tables).show(truncate=False)
    orphans = quality.orphan_counts(events, known)
    orphans.show(truncate=False)
    engagement = metric_tables[model.USER_ENGAGEMENT.name]
    quality.metrics_reconciliation(engagement, events, minutes=1, inclusive=False).show(truncate=False)
    quality.dimension_completeness(events, known).show(truncate=False)
    return int(not orphans.where("count > 0").isEmpty())


if __name__ == "__main__":
    raise SystemExit(main())
