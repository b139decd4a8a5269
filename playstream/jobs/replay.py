"""Check dead letters again and store what is good by now: ``python -m playstream.jobs.replay --root R --batch 0``.

Stored events are left out by their key, so a replay that is repeated adds nothing; letters are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from playstream import model
from playstream.jobs.common import arguments, dimensions, parser
from playstream.operators.deadletter import read_dead_letters
from playstream.operators.integrity import split_by_references
from playstream.session import build_session, run_folder
from playstream.sinks.outlets import unseen_rows
from playstream.sinks.store import FileStore, settled

RUN = "replay"


def main(given: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    made = parser(__doc__)
    made.add_argument("--batch", type=int, required=True, help="number of this replay; use it again to repeat it")
    args = arguments(made, given)
    spark = spark or build_session("replay")
    table, store = model.STREAM_EVENTS, FileStore(args.root)
    letters = read_dead_letters(store.read_dead_letters(spark, table.name), table).select(*table.columns)
    held = settled(letters.where("event_id IS NOT NULL AND timestamp IS NOT NULL"), run_folder(spark, "letters"))
    good, _ = split_by_references(
        held, table, dimensions(store, spark), hold=lambda df: settled(df, run_folder(spark, "broken-keys"))
    )
    others = store.read(spark, table, other_than_batch=args.batch, run=RUN)
    fresh = settled(
        unseen_rows(good.dropDuplicates(list(table.primary_key)), others, table), run_folder(spark, "replayed")
    )
    count = fresh.count()
    if count:
        store.write(fresh, table, args.batch, RUN, count)
    print(f"{count} events stored")
    return count


if __name__ == "__main__":
    main()
