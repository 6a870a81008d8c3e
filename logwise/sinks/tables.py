"""Append a micro-batch to a table, replay-safe, or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwise.settings import CONSOLE_ROWS
from logwise.sources.storage import is_folder, newest_mark


def append_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write one batch as partition ``batch_id=<id>``.

    The folder of the partition is overwritten as a whole: an empty batch
    leaves a partition without rows, and a replay replaces what an earlier
    attempt wrote, also when the replay has no rows.
    """
    df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={int(batch_id)}")


def read_batches(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """All appended batches; ``schema`` must include ``batch_id BIGINT``. No
    rows if no batch has been written yet.

    Where the writer marks finished batches beside the table (one mark for
    all outputs of a batch, see :func:`logwise.sources.storage.put_mark`),
    batches after the mark are left out: a reader sees all outputs of a batch
    or none.
    """
    path = path.rstrip("/")
    finished = newest_mark(spark, path.rpartition("/")[0], "batch_id")
    if not is_folder(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).format(fmt).load(path)
    return rows if finished is None else rows.where(F.col("batch_id") <= finished)


def jdbc_append(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column_types: str | None = None,
) -> None:
    """Append rows to a database table (executors write, one connection per task).

    ``column_types`` is passed as ``createTableColumnTypes`` when the table
    is created by Spark, e.g. ``"log_level VARCHAR(255)"``.
    """
    w = df.write.mode("append")
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    w.jdbc(url, table, properties=properties or {})


def console(df: DataFrame, rows: int = CONSOLE_ROWS) -> None:
    """Print the first rows of a batch (only ``rows`` rows reach the driver)."""
    df.show(rows, truncate=False)
