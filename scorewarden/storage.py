"""Where intermediate tables go, and how big a table may be to be broadcast."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a table that may be shipped to every executor.
BROADCAST_BYTES = 16 << 20
_WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4, "bigint": 8, "double": 8, "timestamp": 8}


def use_checkpoint_folder(spark: SparkSession) -> None:
    """Point checkpoints at the folder the session names.

    A machine-local folder is only acceptable when the whole of Spark runs in
    one process; on a cluster an unset folder is an error, not a guess.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(folder)


def settled(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder, so that a lost executor costs a read."""
    use_checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def estimated_bytes(table: DataFrame, rows: int) -> int:
    """Size of a counted table in memory, from the declared width of its columns and 64 bytes for anything without one."""
    return rows * sum(_WIDTHS.get(kind, 64) + 8 for _, kind in table.dtypes)


def small_side(table: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Settle a table and mark it for broadcast if, and only if, its counted rows fit."""
    table = settled(table)
    return F.broadcast(table) if estimated_bytes(table, table.count()) <= max_bytes else table


def left_lookup(df: DataFrame, table: DataFrame, on: list[str], *, weight: str, max_bytes: int = BROADCAST_BYTES, hot_share: int = 10_000) -> DataFrame:
    """Left join rows to a lookup table with one row per key, without its ``weight`` column.

    ``weight`` is the share of the rows that have the key. A table that fits is broadcast, so the rows never move. Of a
    larger one only the keys of at least one row in ``hot_share`` are, at most ``hot_share`` of them as shares sum to 1;
    the remaining rows, none of whose keys is frequent, are joined by key, and null keys stay where they are.
    """
    table = settled(table)
    if estimated_bytes(table, table.count()) <= max_bytes:
        return df.join(F.broadcast(table.drop(weight)), on, "left")
    values = [c for c in table.columns if c not in (*on, weight)]
    packed = table.select(*on, weight, F.struct(*values).alias("_found"))
    hot = packed.where(F.col(weight) * hot_share >= 1).select(*on, F.col("_found").alias("_hot"))
    marked = df.join(F.broadcast(hot), on, "left")
    settled_here = F.col("_hot").isNotNull()
    for c in on:
        settled_here = settled_here | F.col(c).isNull()
    near = marked.where(settled_here).withColumn("_found", F.col("_hot"))
    far = marked.where(~settled_here).join(packed.where(F.col(weight) * hot_share < 1).drop(weight), on, "left")
    both = near.drop("_hot").unionByName(far.drop("_hot"))
    return both.select(*df.columns, *(F.col("_found")[c].alias(c) for c in values))
