"""Three layers kept by streams: bronze as it came, silver typed, gold aggregated.

Silver holds the last version of every event, in one folder a day, and gold its
aggregates, likewise. A micro-batch finds the days it touches: those of its events and
those their earlier versions lie in, which an index of ids tells. Only these days are
read, merged and written again, under the number of the batch; a list of the days each
batch wrote then makes them visible. Taking the last version is idempotent and a batch
reads only what batches before it wrote, so one that is repeated after a failure writes
the same folders again and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.operators import governance as G
from lanewise.streaming.runs import EVENT_SCHEMA, event_stream, run_available

SILVER_SCHEMA = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value decimal(18,2),"
    " k bigint, batch bigint, day date"
)
GOLD_SCHEMA = (
    "event_type string, events bigint, users bigint, value decimal(28,2), max_k bigint,"
    " users_sketch binary, batch bigint, day date"
)
DAYS_SCHEMA = "day date, batch bigint"
IDS_SCHEMA = "event_id bigint, day date, batch bigint, bucket int"
BUCKETS = 256  # folders of a batch's index of ids


def run_medallion(
    spark: SparkSession,
    src: str,
    out: str,
    checkpoint: str,
    name: str = "*.parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Bring the streamed layers up to date with ``src`` and return gold.

    Bronze is appended exactly once; silver and gold are maintained batch by batch of
    ``files_per_trigger`` files. There is no watermark, so nothing is too late, and a
    correction in a later file counts, whichever day it moves an event to.
    """
    raw = event_stream(spark, src, name, files_per_trigger=files_per_trigger)
    bronze = raw.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    run_available(bronze, f"{checkpoint}/bronze", f"{out}/bronze")

    rows = event_stream(
        spark, f"{out}/bronze", schema=EVENT_SCHEMA, files_per_trigger=files_per_trigger
    )
    run_available(rows, f"{checkpoint}/silver", each_batch=lambda batch, n: merge_batch(batch, n, out))
    return read_gold(spark, out)


def merge_batch(raw: DataFrame, batch: int, out: str) -> None:
    """Merge the events of one batch into silver and gold under ``out``."""
    spark = raw.sparkSession
    new = G.silver(raw).withColumn("day", F.to_date("ts")).persist()
    try:
        days = touched_days(new, batch, out)
        if not days:
            return
        old = _of_days(spark, f"{out}/silver", SILVER_SCHEMA, written_days(spark, out, batch), days)
        merged = G.latest(old.drop("batch", "day").unionByName(new.drop("day")))
        merged = merged.withColumns({"batch": F.lit(batch).cast("bigint"), "day": F.to_date("ts")})
        # even files, also where most rows are of one day
        _write(merged.hint("rebalance", "day"), f"{out}/silver", "batch", "day")
        now = spark.read.schema(SILVER_SCHEMA).parquet(f"{out}/silver").where(F.col("batch") == batch)
        _write(gold_of(now).withColumn("batch", F.lit(batch).cast("bigint")), f"{out}/gold", "batch", "day")
        ids = new.select("event_id", "day", F.lit(batch).cast("bigint").alias("batch"), _bucket().alias("bucket"))
        _write(ids.repartition("bucket"), f"{out}/ids", "batch", "bucket")
        # days that lost their last event are listed too: they have no folder, hence no rows
        listed = spark.createDataFrame([(d, batch) for d in days], DAYS_SCHEMA)
        _write(listed.coalesce(1), f"{out}/days", "batch")
    finally:
        new.unpersist()


def gold_of(silver: DataFrame) -> DataFrame:
    """Gold with a sketch of the users of every row, for users of longer spans."""
    by = ["day", "event_type"]
    sketches = silver.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.hll_sketch_agg("user_id").alias("users_sketch")
    )
    return G.gold(silver).join(sketches, by)


def _bucket() -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(BUCKETS)).cast("int")


def _write(df: DataFrame, path: str, *by: str) -> None:
    """Write the folders of one batch, in place of what an earlier try of it wrote."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def written_days(spark: SparkSession, out: str, before: int | None = None) -> dict:
    """The batch that last wrote each day, among those earlier than ``before``; one entry a calendar day."""
    if not _exists(spark, f"{out}/days"):
        return {}
    listed = spark.read.schema(DAYS_SCHEMA).parquet(f"{out}/days")
    if before is not None:
        listed = listed.where(F.col("batch") < before)
    return {r["day"]: r["batch"] for r in listed.groupBy("day").agg(F.max("batch").alias("batch")).collect()}


def touched_days(new: DataFrame, batch: int, out: str) -> list:
    """Days of the events ``new`` and of the earlier versions of the same events."""
    spark = new.sparkSession
    days = new.select("day")
    if _exists(spark, f"{out}/ids"):
        buckets = [r[0] for r in new.select(_bucket()).distinct().collect()]
        known = spark.read.schema(IDS_SCHEMA).parquet(f"{out}/ids")
        known = known.where((F.col("batch") < batch) & F.col("bucket").isin(buckets))
        days = days.union(known.join(new.select("event_id"), "event_id", "left_semi").select("day"))
    return sorted(r["day"] for r in days.distinct().collect())


def _of_days(spark: SparkSession, path: str, schema: str, written: dict, days: list) -> DataFrame:
    """The rows of some days, as the batches of ``written`` left them; other folders are not read."""
    table = spark.createDataFrame([], schema)
    if _exists(spark, path):
        by_batch: dict[int, list] = {}
        for day in days:
            if day in written:
                by_batch.setdefault(written[day], []).append(day)
        kept = F.lit(False)
        for number in sorted(by_batch):
            kept = kept | ((F.col("batch") == number) & F.col("day").isin(by_batch[number]))
        if by_batch:
            table = spark.read.schema(schema).parquet(path).where(kept)
    return table


def _current(spark: SparkSession, out: str, layer: str, schema: str) -> DataFrame:
    written = written_days(spark, out)
    if not written or not _exists(spark, f"{out}/{layer}"):
        return spark.createDataFrame([], schema)
    last = spark.createDataFrame(list(written.items()), "day date, batch bigint")
    table = spark.read.schema(schema).parquet(f"{out}/{layer}")
    return table.join(F.broadcast(last), ["day", "batch"], "left_semi")


def read_silver(spark: SparkSession, out: str) -> DataFrame:
    """The last version of every event."""
    return _current(spark, out, "silver", SILVER_SCHEMA).drop("batch", "day")


def read_gold(spark: SparkSession, out: str) -> DataFrame:
    """Events, users and value per day and type, of the last version of each event."""
    table = _current(spark, out, "gold", GOLD_SCHEMA)
    return table.select("day", "event_type", "events", "users", "value", "max_k")


def read_users(spark: SparkSession, out: str, unit: str = "week") -> DataFrame:
    """About how many users each ``unit`` of days had, by type, from the sketches of its days.

    No event is read again. The standard error is 2 %; few users are counted exactly.
    """
    table = _current(spark, out, "gold", GOLD_SCHEMA)
    return table.groupBy(F.to_date(F.date_trunc(unit, "day")).alias(unit), "event_type").agg(
        F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("users")
    )


def vacuum(spark: SparkSession, out: str) -> int:
    """Delete folders of days that a later batch wrote again; gives their number.

    Not while a batch runs: it may be reading them.
    """
    written, gone = {str(day): n for day, n in written_days(spark, out).items()}, 0
    for layer in ("silver", "gold"):
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{layer}")
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{layer}/batch=*/day=*")) or []:
            path = folder.getPath()
            batch, day = int(path.getParent().getName()[6:]), path.getName()[4:]
            if batch < written.get(day, batch):
                gone += bool(files.delete(path, True))
    return gone
