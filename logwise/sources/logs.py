"""Log lines from a folder of text files, as a batch or a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwise.operators.parse import lines_from_columns


def log_lines(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    ignore_existing_before: dt.datetime | None = None,
    archive: str | None = None,
    max_file_age: str | None = None,
) -> DataFrame:
    """``value`` (one line) plus ``file_path`` and ``file_time``.

    The stream picks up new files in ``path`` (not sub-folders); files already
    there are read too, which a replay needs. ``ignore_existing_before`` keeps
    only files modified at or after a time, like a watcher started then.
    Spark orders new files by modification time, not by name.

    A folder of small files that only grows is listed for ever. With
    ``archive`` (a folder beside ``path``, on the same file system) the stream
    moves files there once the batch that read them is finished, so a listing
    sees new files only; what a stopped stream has not yet moved is moved after
    its restart. ``max_file_age`` (such as ``7d``, before the newest file) is how
    far back unseen files are still read; Spark forgets names of older ones.
    """
    if (archive or max_file_age) and not stream:
        raise ValueError("archive and max_file_age are options of a stream")
    reader = spark.readStream if stream else spark.read
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )
    if ignore_existing_before is not None:
        df = df.where(F.col("file_time") >= F.lit(ignore_existing_before))
    return df


def log_lines_from_events(
    events: DataFrame,
    level: str = "event_type",
    method: F.Column | None = None,
    ts: str = "ts",
    keep: tuple[str, ...] = ("event_id",),
) -> DataFrame:
    """Rebuild log lines from an event table: ``[type]\\tu<user>\\tDate:<ts>``."""
    m = method if method is not None else F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return events.select(*keep, lines_from_columns(F.col(level), m, F.col(ts)).alias("value"))


def write_log_files(lines: DataFrame, path: str, files: int | None = None) -> None:
    """Write ``value`` as text files (a test and replay helper)."""
    out = lines.select("value")
    if files:
        out = out.repartition(files)
    out.write.mode("overwrite").text(path)
