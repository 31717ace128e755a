"""Masking, quality rules, archive split, layered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.functions import strings as S
from lanewise.sources.tables import require


def mask(df: DataFrame, text: str, key: str, secret: str) -> DataFrame:
    """E-mail addresses in ``text`` masked, ``key`` replaced by the SHA-256 of it and ``secret``.

    Keys from a small range can be found by trying all of them, unless the secret
    that is hashed with them stays unknown. A null key stays null.
    """
    require(df, text, key)
    if not secret:
        raise ValueError("a secret is needed: plain hashes of short keys are reversed by counting up")
    return df.withColumns(
        {key: F.sha2(F.concat(F.sha2(F.lit(secret), 256), F.lit(":"), F.col(key).cast("string")), 256), text: S.emails_masked(F.col(text))}
    )


def check_rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows passing and failing each rule (a SQL condition; null fails), in one pass."""
    holds = {name: F.coalesce(F.expr(rule), F.lit(False)) for name, rule in rules.items()}
    counted = df.agg(
        *[F.count_if(c).alias(f"p{i}") for i, c in enumerate(holds.values())],
        *[F.count_if(~c).alias(f"f{i}") for i, c in enumerate(holds.values())],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"p{i}").alias("passed"),
                F.col(f"f{i}").alias("failed"),
            )
            for i, name in enumerate(holds)
        ]
    )
    return counted.select(F.inline(rows))


def quarantine(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows that fail a rule, with the names of those they fail."""
    fails = [
        F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in rules.items()
    ]
    marked = df.withColumn("failed_rules", F.array_compact(F.array(*fails)))
    return marked.where(F.size("failed_rules") > 0)


def split_by_age(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """Add ``tier``: ``hot`` for the last ``days`` days before ``as_of``, else ``archive``."""
    require(df, ts)
    edge = F.date_sub(F.lit(as_of).cast("date"), days).cast(df.schema[ts].dataType)
    tier = F.when(F.col(ts) >= edge, "hot").otherwise("archive")
    return df.withColumns({"tier": tier, "year": F.year(ts).cast("bigint")})


def write_by_age(df: DataFrame, ts: str, as_of: str, days: int, path: str) -> None:
    """Write the split as a table whose folders are tier and year.

    Rebalancing before the write gives each folder a few files of even size,
    splitting a folder that holds most of the rows.
    """
    split = split_by_age(df, ts, as_of, days).hint("rebalance", "tier", "year")
    split.write.mode("overwrite").partitionBy("tier", "year").parquet(path)


def typed(raw: DataFrame) -> DataFrame:
    """Every version of every event with its types; rows without an id or a time are left out."""
    require(raw, "event_id", "ts", "user_id", "event_type", "value", "props")
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        F.lower(F.trim("event_type")).alias("event_type"),
        F.col("value").try_cast("decimal(18,2)").alias("value"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
    ).where(F.col("event_id").isNotNull() & F.col("ts").isNotNull())


def latest(versions: DataFrame) -> DataFrame:
    """One row per event id: the last version by time wins."""
    fields = [c for c in versions.columns if c != "event_id"]
    order = Window.partitionBy("event_id").orderBy(*[F.desc(c) for c in fields])
    return versions.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def silver(raw: DataFrame) -> DataFrame:
    """Typed events, one row per event id."""
    return latest(typed(raw))


def gold(clean: DataFrame) -> DataFrame:
    """Events, users and value per day and type."""
    return clean.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("user_id").alias("users"),
        F.sum("value").alias("value"),
        F.max("k").alias("max_k"),
    )


def html_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title and visible text of each page."""
    require(pages, html)
    return pages.withColumns(
        {"title": S.page_title(F.col(html)), "text": S.visible_text(F.col(html))}
    ).drop(html)

