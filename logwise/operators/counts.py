"""Counts per key: totals and the series of running totals after each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwise.session import checkpoint_root


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """``count(*)`` per key (partial aggregation before the shuffle, so a hot
    key costs one row per map task, not one per input row)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


# Batches per block in total_snapshots: no task sorts, and no array holds, more
# than this many batches of one key.
SNAPSHOT_BLOCK = 4096


def total_snapshots(
    df: DataFrame,
    key: str,
    batch: str,
    name: str = "total",
    block: int = SNAPSHOT_BLOCK,
    weight: str | None = None,
) -> DataFrame:
    """Running total of every known key after each batch.

    This is what a never-evicted running count prints after every micro-batch:
    a key appears from its first batch on, and stays in every later batch up to
    the last one, also when it has no new rows. Batches form a grid (integers
    step 1, dates step 1 day) from the first to the last batch with data.
    A row counts 1, or its ``weight`` column. A NULL key is a key like any
    other; rows with a NULL batch belong to no batch and are left out.

    The result has keys x batches rows by definition; :func:`total_intervals`
    says the same in one row per change. Repeating a row until the key's next
    change explodes block-sized chunks, so no array grows with the gap.
    """
    spans, from_int = _intervals(df, key, batch, name, block, weight)
    chunked = spans.select(
        key,
        name,
        "_b",
        "_until",
        F.explode(F.sequence(F.floor(F.col("_b") / block), F.floor(F.col("_until") / block))).alias("_chunk"),
    )
    lo = F.greatest(F.col("_b"), F.col("_chunk") * block)
    hi = F.least(F.col("_until"), F.col("_chunk") * block + (block - 1))
    return chunked.select(key, name, F.explode(F.sequence(lo, hi)).alias("_i")).select(
        from_int(F.col("_i")).alias(batch), key, name
    )


def total_intervals(
    df: DataFrame,
    key: str,
    batch: str,
    name: str = "total",
    block: int = SNAPSHOT_BLOCK,
    weight: str | None = None,
) -> DataFrame:
    """The running totals of :func:`total_snapshots` as intervals: one row
    (from_<batch>, to_<batch>, key, total) per change of a key's total, both
    ends included; the last interval of a key ends with the last batch."""
    spans, from_int = _intervals(df, key, batch, name, block, weight)
    return spans.select(
        from_int(F.col("_b")).alias(f"from_{batch}"), from_int(F.col("_until")).alias(f"to_{batch}"), key, name
    )


def _intervals(df: DataFrame, key: str, batch: str, name: str, block: int, weight: str | None):
    """(key, _b, _until, total) with batches as integers, and the way back.

    Plan, built so that a key present in every batch is never one task's work:
    (1) count per (batch, key), partial aggregation first, so a hot key
    shrinks to one row per batch; (2) batches are cut into blocks of
    ``block``; totals per (key, block) and a window over the blocks of a key
    give each block its starting offset and the first batch of the key's next
    block; (3) the running sum inside a (key, block) window adds the offset.
    No keys x batches spine is built.

    The per-(batch, key) counts feed three branches (block totals, the join
    back, the last batch); they are checkpointed to the shared checkpoint
    folder (one job, at call time) so the input is scanned once, not three
    times, and a lost executor does not recompute them from the input.
    """
    if df.isStreaming:
        raise ValueError(
            "running totals per batch are the batch form; on a stream use "
            "streaming.level_totals_query(mode='complete'), whose sink holds the same series"
        )
    checkpoint_root(df.sparkSession)
    measure = F.count(F.lit(1)) if weight is None else F.sum(F.col(weight))
    per_batch = df.where(F.col(batch).isNotNull()).groupBy(batch, key).agg(measure.alias("_c"))
    b_type = per_batch.schema[batch].dataType
    if isinstance(b_type, T.DateType):
        to_int, from_int = F.unix_date, F.date_from_unix_date
    elif isinstance(b_type, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        to_int, from_int = (lambda c: c.cast("bigint")), (lambda c: c.cast(b_type))
    else:
        raise TypeError(f"batch column must be a date or an integer, not {b_type}")

    ints = (
        per_batch.select(key, to_int(F.col(batch)).alias("_b"), "_c")
        .withColumn("_blk", F.floor(F.col("_b") / F.lit(block)))
        .checkpoint(eager=True)
    )
    per_block = ints.groupBy(key, "_blk").agg(F.sum("_c").alias("_bc"), F.min("_b").alias("_first"))
    over_blocks = Window.partitionBy(key).orderBy("_blk")
    offsets = per_block.select(
        F.col(key).alias("_key"),
        F.col("_blk").alias("_block"),
        (F.sum("_bc").over(over_blocks) - F.col("_bc")).alias("_before"),
        F.lead("_first").over(over_blocks).alias("_next_first"),
    )
    in_block = Window.partitionBy(key, "_blk").orderBy("_b")
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_blk") == F.col("_block"))
    running = ints.join(offsets, same).select(
        key,
        "_b",
        (F.col("_before") + F.sum("_c").over(in_block)).alias(name),
        F.coalesce(F.lead("_b").over(in_block), F.col("_next_first")).alias("_next"),
    )
    last = ints.select(F.max("_b")).scalar()
    until = F.coalesce(F.col("_next") - F.lit(1), last)
    return running.select(key, name, "_b", until.alias("_until")), from_int
