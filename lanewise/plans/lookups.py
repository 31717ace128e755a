"""Joining rows to a lookup table that has one row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from lanewise.session import shared_dir

BROADCAST_BYTES = 32 << 20
SALTS = 16


def join_null_safe(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", plain: list[str] | None = None
) -> DataFrame:
    """Join on ``on``, where null meets null, and on ``plain``, where it meets nothing.

    Key columns are kept once, from the left, so ``how`` is inner, left, semi or anti.
    Spark joins such keys by hash or sort like any others.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a join that keeps the left key can't be {how}")
    plain = plain or []
    names = {c: f"_right_{c}" for c in [*on, *plain]}
    right = right.withColumnsRenamed(names)
    terms = [F.col(c).eqNullSafe(F.col(names[c])) for c in on]
    terms += [F.col(c) == F.col(names[c]) for c in plain]
    return left.join(right, reduce(lambda a, b: a & b, terms), how).drop(*names.values())


def byte_size(df: DataFrame) -> int:
    """Bytes of the values of a small written table, counted, not estimated."""
    wide = [f.name for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    size = F.count(F.lit(1)) * 8 * len(df.columns)
    for c in wide:
        size = size + F.coalesce(F.sum(F.octet_length(c)), F.lit(0))
    return df.agg(size.alias("n")).first()["n"]


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``df`` to ``lookup`` (unique on ``on``) without moving hot keys to one task.

    ``how`` is inner, left, semi or anti; null keys meet null keys. The lookup is written once
    to the shared folder and measured there. Up to ``max_bytes`` it is broadcast. Beyond that both sides are shuffled on the key
    plus a salt: rows of one key spread over ``salts`` tasks, and the lookup,
    which is unique on the key, is copied once per salt.
    """
    shared_dir(df.sparkSession)
    lookup = lookup.checkpoint()
    if byte_size(lookup) <= max_bytes:
        return join_null_safe(df, F.broadcast(lookup), on, how)
    others = [c for c in df.columns if c not in on] or on
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(salts)))
    copies = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    return join_null_safe(salted, copies, on, how, plain=["_salt"]).drop("_salt")
