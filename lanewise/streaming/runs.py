"""Starting streams from parquet folders and running them to a written table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from lanewise.session import prepare, shared_dir

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string"
)

# Windows of one key are merged before the shuffle; keyed state lives on disk.
STREAM_SETTINGS = {
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def event_stream(
    spark: SparkSession,
    folder: str,
    name: str = "*.parquet",
    schema: str = EVENT_SCHEMA,
    ts: str = "ts",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream; ``ts`` gets a zone, as watermarks need one.

    ``files_per_trigger`` bounds a micro-batch, and with it what one task sees.
    """
    reader = prepare(spark).readStream.schema(schema).option("pathGlobFilter", name)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder).withColumn(ts, F.col(ts).cast("timestamp"))


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/lanewise/{kind}-{uuid.uuid4().hex}"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@dataclass(frozen=True)
class Run:
    """An ended query and the progress of all its micro-batches."""

    query: StreamingQuery
    progress: list[StreamingQueryProgress]


def run_available(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    mode: str = "append",
    each_batch: Callable[[DataFrame, int], None] | None = None,
) -> Run:
    """Process what has arrived, then stop. A restart goes on from the checkpoint.

    The progress of every micro-batch is gathered while the query runs: Spark itself
    keeps the last reports only.

    With ``path``, rows are appended to a parquet table exactly once; with
    ``each_batch``, the function must be repeatable for the same batch number.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True)
    if each_batch is not None:
        writer = writer.foreachBatch(each_batch)
    else:
        writer = writer.format("parquet").option("path", path)
    with _settings(stream.sparkSession, STREAM_SETTINGS):
        running = writer.start()
    seen: dict[int, StreamingQueryProgress] = {}
    done = False
    while not done:
        done = running.awaitTermination(0.2)
        seen.update((p.batchId, p) for p in running.recentProgress)
    if seen and len(seen) <= max(seen) - min(seen):
        raise RuntimeError("progress of some micro-batches was missed")
    return Run(running, [seen[k] for k in sorted(seen)])


def run_to_table(stream: DataFrame, kind: str) -> DataFrame:
    """Run an append stream over all that has arrived and read its table back."""
    spark = stream.sparkSession
    home = new_folder(spark, kind)
    run_available(stream, f"{home}/checkpoint", f"{home}/table")
    return spark.read.schema(stream.schema).parquet(f"{home}/table")
