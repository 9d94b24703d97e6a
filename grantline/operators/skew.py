"""Equi-joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Keys that may be broadcast; further ones are looked up like any other.
MOST_HOT_KEYS = 10_000


def by_shuffle(rows: DataFrame) -> DataFrame:
    """``rows`` of a table that grows with the users or the history: joins with it are shuffled, so
    that it never goes through the driver as a broadcast, even while it is small enough for one."""
    return rows.hint("merge")


def hot_keys(keys: DataFrame, hot_key_rows: int) -> DataFrame:
    """The most frequent keys with at least ``hot_key_rows`` rows, ``MOST_HOT_KEYS`` at most."""
    return (
        keys.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= hot_key_rows)
        .orderBy(F.desc("n"), "key")
        .limit(MOST_HOT_KEYS)
        .select("key")
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: Column,
    value: str,
    spread_by: Column,
    hot_key_rows: int,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``left`` with the column ``value`` of ``right`` added, null where there is none.

    ``right`` holds at most one row per ``key``. Rows of ``left`` whose key is null
    need no look-up, and rows with a hot key get their value from a broadcast of
    just the hot keys; both kinds go through the shuffle spread by ``spread_by``, so
    no task receives a whole hot group. ``counted`` (column ``key``) may be a cheaper
    frame to count keys on; what counts as hot does not change the result.
    """
    keyed = left.withColumn("_key", key)
    counts = counted if counted is not None else keyed.select(F.col("_key").alias("key"))
    table = by_shuffle(right.select(F.col("key"), F.col(value)))
    hot = (
        hot_keys(counts, hot_key_rows)
        .join(table, "key", "left")
        .select(
            F.col("key").alias("_hot_key"),
            F.col(value).alias("_hot_value"),
            F.lit(True).alias("_is_hot"),
        )
    )
    marked = keyed.join(F.broadcast(hot), F.col("_key") == F.col("_hot_key"), "left")
    spread = F.when(
        F.col("_key").isNull() | F.col("_is_hot"),
        F.concat(F.lit("\x00"), spread_by.cast("string")),
    ).otherwise(F.col("_key"))
    cold = by_shuffle(
        right.select(F.col("key").alias("_cold_key"), F.col(value).alias("_cold_value"))
    )
    joined = marked.withColumn("_spread", spread).join(
        cold, F.col("_spread") == F.col("_cold_key"), "left"
    )
    return joined.withColumn(value, F.coalesce("_hot_value", "_cold_value")).drop(
        "_key", "_hot_key", "_hot_value", "_is_hot", "_spread", "_cold_key", "_cold_value"
    )
