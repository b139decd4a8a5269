"""Load the six dimensions from dumps of their changelogs: ``python -m playstream.jobs.load --root R --messages M --batch 0``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from playstream.jobs.common import arguments, parser
from playstream.operators.loading import LoadResult, load_dimensions
from playstream.session import build_session
from playstream.sinks.store import FileStore

DUMP = "key binary, value binary, offset long"


def main(given: Sequence[str] | None = None, spark: SparkSession | None = None) -> list[LoadResult]:
    made = parser(__doc__)
    made.add_argument("--messages", required=True, help="folder with Parquet of key, value and offset per dimension")
    made.add_argument("--batch", type=int, required=True, help="number of this load; use it again to repeat the load")
    args = arguments(made, given)
    spark = spark or build_session("load")
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    read = lambda table: spark.read.schema(DUMP).parquet(f"{args.messages}/{table}")
    results = load_dimensions(read, FileStore(args.root), args.batch, now)
    for result in results:
        print(f"{result.table}: {result.loaded} loaded")
    return results


if __name__ == "__main__":
    main()
