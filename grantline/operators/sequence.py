"""What earlier requests of a pass change for later ones, without a loop over requests.

A pass takes requests in listing order (``seq``). Granting one overwrites the state
row of its access key, so the question "is this URN the latest of an active row?"
depends on the requests before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.checkpoints import written
from grantline.functions.identity import non_empty

KEY = ["snowflake_role", "snowflake_database", "snowflake_schema"]


def schema_key(schema: Column) -> Column:
    """Stored form of a schema: the empty string stands for "all schemas"."""
    return F.coalesce(schema, F.lit(""))


def key_struct(role: str, database: str, schema: str) -> Column:
    return F.struct(
        F.col(role).alias("role"),
        F.col(database).alias("database"),
        schema_key(F.col(schema)).alias("schema"),
    )


def already_latest(requests: DataFrame, active: DataFrame) -> DataFrame:
    """URNs that are skipped because an active row still carries them at their turn.

    ``requests`` has ``urn`` (unique), ``seq``, ``key`` and ``ready`` (will be granted
    if not skipped); ``active`` has ``home`` and ``urn``, one row per active state row.

    A request with no state row is granted whenever it is ready, so each key has an
    earliest sure overwrite: the least ``seq`` of those. A held request is granted if all its
    home rows are overwritten before its turn. Where a held request has moved to another key
    (another default role, say), granting it overwrites that key's row, and so may free the
    request that sits there, if that one comes later. So each request leads to one other at
    most, in rising order: chains that join and never close. Who is freed by whom is
    found by pointer doubling: in each round a request frees the one it points to, and then
    points as far again as it did. A chain of n requests takes log2 n rounds on a
    table of one row per held request.

    A request with several home rows needs all of them overwritten. Chains end at such
    requests; they are judged between the doublings, and the chains behind those that are granted
    then are followed in turn.
    """
    held = requests.join(active, "urn")
    free = requests.filter("ready").join(active.select("urn"), "urn", "left_anti")
    sure = free.groupBy("key").agg(F.min("seq").alias("sure"))
    turns = held.join(
        sure.withColumnRenamed("key", "home"), "home", "left"
    ).withColumnRenamed("sure", "overwritten")
    turns = written(turns, "turns")
    nodes = _turns_per_urn(turns)
    owner = turns.select(
        F.col("home").alias("key"), F.col("urn").alias("next"), F.col("seq").alias("next_seq")
    )
    moves = nodes.filter("ready").join(owner, "key").filter(
        (F.col("next") != F.col("urn")) & (F.col("seq") < F.col("next_seq"))
    )
    moves = written(moves.select("urn", "seq", "key", "next"), "moves")
    if moves.isEmpty():
        return nodes.filter(~F.col("granted")).select("urn")
    several = turns.groupBy("urn").agg(F.count("*").alias("homes")).filter("homes > 1")
    links = moves.join(several, F.col("next") == several["urn"], "left_anti").select("urn", "next")
    flags = written(nodes.select("urn", "granted").join(links, "urn", "left"), "freed")
    joined = turns.join(several.select("urn"), "urn", "left_semi")
    any_joined = not joined.isEmpty()
    while True:
        freed = _freed(flags)
        if not any_joined:
            break
        hits = moves.join(freed.filter("granted"), "urn").groupBy(F.col("key").alias("home")).agg(
            F.min("seq").alias("by_move")
        )
        judged = _turns_per_urn(
            joined.join(hits, "home", "left").withColumn(
                "overwritten", F.least("overwritten", "by_move")
            )
        )
        now = judged.filter("granted").select("urn", F.lit(True).alias("now"))
        fresh = written(
            freed.join(now, "urn", "left")
            .withColumn("fresh", F.coalesce("now", F.lit(False)) & ~F.col("granted"))
            .withColumn("granted", F.col("granted") | F.col("fresh"))
            .drop("now"),
            "freed",
        )
        if fresh.filter("fresh").isEmpty():
            break
        flags = fresh.drop("fresh").join(links, "urn", "left")
    return freed.filter(~F.col("granted")).select("urn")


def _freed(flags: DataFrame) -> DataFrame:
    """``urn, granted`` after granted requests have freed all that they lead to.

    ``flags`` has ``urn``, ``granted`` and ``next``, null at the end of a chain.
    """
    while not flags.filter("next IS NOT NULL").isEmpty():
        told = flags.filter("granted AND next IS NOT NULL").select(
            F.col("next").alias("urn"), F.lit(True).alias("told")
        )
        far = flags.filter("next IS NOT NULL").select(
            F.col("urn").alias("next"), F.col("next").alias("after")
        )
        flags = written(
            flags.join(told.distinct(), "urn", "left")
            .withColumn("granted", F.col("granted") | F.coalesce("told", F.lit(False)))
            .join(far, "next", "left")
            .select("urn", "granted", F.col("after").alias("next")),
            "freed",
        )
    return flags.select("urn", "granted")


def _turns_per_urn(turns: DataFrame) -> DataFrame:
    gone = F.coalesce(F.col("overwritten") < F.col("seq"), F.lit(False))
    return turns.groupBy("urn", "seq", "key", "ready").agg(F.bool_and(gone).alias("granted"))


def last_per_key(granted: DataFrame) -> DataFrame:
    """``KEY`` and ``seq`` of the request that ends up in each key's row."""
    return granted.groupBy(
        F.col("resolved_role").alias("snowflake_role"),
        "snowflake_database",
        schema_key(non_empty(F.col("snowflake_schema"))).alias("snowflake_schema"),
    ).agg(F.max("seq").alias("seq"))
