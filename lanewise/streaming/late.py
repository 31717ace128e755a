"""Late rows as a table of their own, instead of rows that a stateful query drops.

``split_late`` runs before a stateful query. Each micro-batch is split against the
watermark that the batches before it committed, by the rule stateful operators use, and
written once, under its own number: rows in time, and late rows. The stateful query
then reads the rows in time as its stream. It takes them batch by batch, so its own
watermark is never ahead of the one they were split by, and it drops nothing.

Below ``home``: ``rows/batch=N/late=false`` and ``late=true`` hold the rows, and
``marks/batch=N`` the latest event time up to that batch, written last. A batch that is
sent again after a failure is written over if it has no mark, and left alone if it has
one; so every row is in one of both tables, once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lanewise.sources.tables import require
from lanewise.streaming.runs import Run, run_available

LATE = "late"
_PLACES = StructType().add("batch", "long").add(LATE, "boolean").fields


def _mark(spark: SparkSession, home: str, number: int) -> tuple[bool, int | None]:
    """Whether a batch has a mark, and the latest event time (ms) up to it."""
    try:
        found = spark.read.parquet(f"{home}/marks/batch={number}").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False, None
    return True, found["latest"]


def watermark_of(latest: int | None, delay: str) -> int | None:
    """The watermark in ms after event times up to ``latest``."""
    if latest is None:
        return None
    spark = SparkSession.active()
    mark = F.timestamp_millis(F.lit(latest)) - F.expr(f"INTERVAL '{delay}'")
    return spark.range(1).select(F.unix_millis(mark)).first()[0]


def split_late(
    stream: DataFrame, home: str, checkpoint: str, delay: str = "1 hour", ts: str = "ts"
) -> Run:
    """Split all that has arrived into the tables ``in_time`` and ``late_table`` read.

    A row is late if its event time is not after the watermark; without an event time it
    never is. The first batch has no late rows.
    """
    require(stream, ts)

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done, _ = _mark(spark, home, number)
        if done:
            return
        known, before = _mark(spark, home, number - 1)
        if number and not known:
            raise RuntimeError(f"the mark of batch {number - 1} is missing")
        mark = watermark_of(before, delay)
        late = F.lit(False) if mark is None else F.coalesce(F.unix_micros(ts) <= mark * 1000, F.lit(False))
        path = f"{home}/rows/batch={number}"
        batch.withColumn(LATE, late).write.mode("overwrite").partitionBy(LATE).parquet(path)
        # late rows cannot be the latest, so the rows just written are read in one column only
        written = spark.read.schema(f"{ts} timestamp").parquet(path)
        # event times count in whole milliseconds, as a stateful query takes them
        latest = F.greatest(F.floor(F.unix_micros(F.max(ts)) / 1000), F.lit(before).cast("bigint"))
        marked = written.agg(latest.alias("latest"))
        marked.coalesce(1).write.mode("overwrite").parquet(f"{home}/marks/batch={number}")

    return run_available(stream, checkpoint, each_batch=each)


def in_time(stream: DataFrame, home: str) -> DataFrame:
    """The rows in time as a stream of the same columns; start it when ``split_late`` has ended."""
    reader = stream.sparkSession.readStream.schema(stream.schema)
    return reader.parquet(f"{home}/rows/batch=*/{LATE}=false")


def late_table(stream: DataFrame, home: str) -> DataFrame:
    """The late rows so far, with the number of the ``batch`` they came in; empty if there are none."""
    spark = stream.sparkSession
    schema = StructType([*stream.schema.fields, *_PLACES])
    return spark.read.schema(schema).parquet(f"{home}/rows").where(LATE).drop(LATE)
