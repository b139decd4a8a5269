"""Run the six streaming queries: ``python -m playstream.jobs.stream --root R --checkpoints C --messages M | --servers S``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from playstream.jobs.common import arguments, dimensions, parser
from playstream.session import build_session, streaming_session
from playstream.sinks.store import FileStore
from playstream.sources import bus
from playstream.streaming import job
from playstream.streaming.delivery import Delivery


def main(given: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    made = parser(__doc__)
    made.add_argument("--checkpoints", required=True)
    source = made.add_mutually_exclusive_group(required=True)
    source.add_argument("--messages", help="folder of message files")
    source.add_argument("--servers", help="message bus")
    made.add_argument("--topic", default="stream-events")
    made.add_argument("--files-per-batch", type=int, default=1000)
    made.add_argument("--state-partitions", type=int, required=True)
    made.add_argument("--drain", action="store_true", help="handle what is there and end")
    made.add_argument("--every", help="interval between batches, as '1 minute'")
    args = arguments(made, given)
    spark = streaming_session(spark or build_session("stream"), args.state_partitions)
    store = FileStore(args.root)
    if args.messages:
        messages = bus.message_files_stream(spark, args.messages, files_per_batch=args.files_per_batch)
    else:
        messages = bus.topic_stream(spark, args.servers, args.topic)
    delivery = Delivery(store, dimensions=lambda session: dimensions(store, session))
    running = job.start_all(messages, delivery, args.checkpoints, job.Schedule(args.drain, args.every))
    job.await_all(running.values())


if __name__ == "__main__":
    main()
