"""Two sides that meet row by row, in a grid of bounded cells."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def met_in_cells(
    blocks: DataFrame,
    shards: DataFrame,
    across: int,
    down: int,
    work: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """What ``work`` finds for every row of ``blocks`` (by ``block``) with every one of ``shards``.

    ``across`` groups of shards (by a hash of ``ids``) meet ``down`` groups of blocks, each two
    groups in a cell of their own: one table of blocks and one of shards. Rows are dealt by hash
    whole, so a cell is bounded by what a row holds, and no key grows with the data.
    """

    def dealt(number: Column, groups: int) -> Column:
        return F.pmod(F.xxhash64(number), F.lit(groups))

    def every(groups: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    left = blocks.withColumn("other_", every(across)).withColumn(
        "cell", dealt(F.col("block"), down) * across + F.col("other_")
    )
    right = shards.withColumn("other_", every(down)).withColumn(
        "cell", F.col("other_") * across + dealt(F.col("ids"), across)
    )
    return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(work, schema)
