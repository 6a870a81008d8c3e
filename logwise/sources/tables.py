"""Parquet input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logwise import schemas
from logwise.sources.storage import is_folder

_SCHEMAS = {"events": schemas.EVENTS, "documents": schemas.DOCUMENTS}


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """``<data_dir>/<name>.parquet``; known tables are read with a fixed schema."""
    reader = spark.read
    if name in _SCHEMAS:
        reader = reader.schema(_SCHEMAS[name])
    return reader.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def table_stream(
    spark: SparkSession,
    data_dir: str,
    name: str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same table as a streaming file source (new files become batches).

    A table stored as a folder of part files is watched as that folder; of a
    single file, the folder around it is watched for that name only.
    """
    reader = spark.readStream.schema(_SCHEMAS[name])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = f"{data_dir.rstrip('/')}/{name}.parquet"
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(data_dir)
