"""Start, drain and read back streaming queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from logwise.settings import CONSOLE_ROWS
from logwise.sinks.tables import read_batches
from logwise.sources.storage import newest_mark, newest_number, put_mark


# Fixed value: the state store Spark ships for large state (kept off-heap).
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(
    writer: DataStreamWriter,
    checkpoint: str,
    trigger: str | None = None,
    name: str | None = None,
    spark: SparkSession | None = None,
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Start with a checkpoint (offsets + state survive restarts).

    ``trigger=None`` processes what is available now and stops (a replay or a
    catch-up job); a string like ``"2 seconds"`` runs micro-batches forever.

    ``state_partitions`` sets the shuffle (and state store) partitions of a
    stateful query. Spark records the number in the checkpoint at the first
    start and keeps it for the life of the query, so it should match the
    expected state size, not the current batch. ``state_store='rocksdb'``
    keeps the state in RocksDB instead of executor memory (large key sets).
    Both apply only while the query starts (the stream runs on a copy of the
    session conf).
    """
    w = writer.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger is None:
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    conf: dict[str, str] = {}
    if state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store == "rocksdb":
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    elif state_store not in (None, "default"):
        raise ValueError(f"unknown state store {state_store!r}")
    if not conf or spark is None:
        return w.start()
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return w.start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; re-raise its failure."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query


def latest_per_key(
    spark: SparkSession,
    path: str,
    schema: str,
    keys: Sequence[str],
    values: Sequence[str],
    compacted_path: str | None = None,
) -> DataFrame:
    """Read an update-mode ledger (one partition per batch) and keep, per key,
    the values written by the latest batch that touched it.

    With ``compacted_path`` (written by :func:`compact_latest`), the folded
    batches come from there and the ledger adds only later batches.
    """
    ledger = read_batches(spark, path, schema)
    cols = [*keys, *values, "batch_id"]
    done, through, _ = _folded(spark, compacted_path)
    if done is not None:
        ledger = ledger.where(F.col("batch_id") > F.lit(through)).select(*cols).unionByName(done.select(*cols))
    aggs = [F.max_by(F.col(v), F.col("batch_id")).alias(v) for v in values]
    return ledger.groupBy(*keys).agg(*aggs)


def _folded(spark: SparkSession, compacted_path: str | None) -> tuple[DataFrame | None, int, int]:
    """(rows, last batch folded in, number) of the newest version that is
    marked as finished."""
    version = newest_mark(spark, compacted_path, "version") if compacted_path else None
    if version is None or version < 0:
        return None, -1, 0
    done = spark.read.parquet(f"{compacted_path}/version={version}")
    through = done.agg(F.max("through_batch")).first()[0]
    return done, -1 if through is None else int(through), version


def compact_latest(
    spark: SparkSession,
    path: str,
    schema: str,
    keys: Sequence[str],
    values: Sequence[str],
    compacted_path: str,
) -> None:
    """Fold an update-mode ledger into one row per key (its latest values and
    batch) plus ``through_batch``, the last batch folded in.

    A stream that runs for months writes one partition per batch; after
    compaction readers scan the compacted rows and only the newer batches
    (``latest_per_key(..., compacted_path=...)``). The rows folded earlier and
    the newer batches make a new version folder; readers take the newest one
    that is complete. Folded partitions and older versions may be dropped.
    """
    done, through, version = _folded(spark, compacted_path)
    cols = [*keys, *values, "batch_id"]
    rows = read_batches(spark, path, schema).where(F.col("batch_id") > F.lit(through)).select(*cols)
    if done is not None:
        rows = rows.unionByName(done.select(*cols))
    newest = rows.agg(F.max("batch_id")).first()[0]
    if newest is None:
        return  # nothing written yet
    aggs = [F.max_by(F.col(v), F.col("batch_id")).alias(v) for v in values]
    latest = rows.groupBy(*keys).agg(*aggs, F.max("batch_id").alias("batch_id"))
    latest = latest.withColumn("through_batch", F.lit(max(int(newest), through)).cast("bigint"))
    # a number that no earlier attempt has used, also one that did not finish
    number = 1 + max(version, newest_number(spark, compacted_path, "version") or 0)
    latest.write.parquet(f"{compacted_path}/version={number}")
    put_mark(spark, compacted_path, "version", number)


def last_batch_id(spark: SparkSession, path: str) -> int | None:
    """Id of the newest batch in a sink; None if nothing has been written."""
    return newest_number(spark, path, "batch_id")


def snapshot_at(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """One batch of a complete-mode ledger: every known key as of that batch.

    Reads a single ``batch_id`` partition (partition pruning), so the cost is
    the number of keys, not keys x batches as with ``latest_per_key``.
    """
    return read_batches(spark, path, schema).where(F.col("batch_id") == F.lit(batch_id)).drop("batch_id")


def console_query(
    stream: DataFrame,
    checkpoint: str,
    mode: str = "update",
    rows: int = CONSOLE_ROWS,
    trigger: str | None = None,
) -> StreamingQuery:
    """Print the first ``rows`` rows of every micro-batch on the driver's
    console (only those rows reach the driver)."""
    writer = (
        stream.writeStream.format("console")
        .outputMode(mode)
        .option("numRows", rows)
        .option("truncate", "false")
    )
    return start(writer, checkpoint, trigger)
