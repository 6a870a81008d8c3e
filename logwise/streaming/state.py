"""Keyed state by a function of the user's own.

``update(values, state)`` gives the new state of a key from its values of a
batch and its state so far, as a Python function does that sums or keeps the
largest. The state lives in the state store, so it survives restarts; every
batch writes the keys that it changed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logwise.session import ship_package
from logwise.sinks.tables import append_batch
from logwise.streaming.runner import latest_per_key, start

Update = Callable[[pd.Series, Any], Any]
Partial = Callable[[pd.Series], Any]


def _plain(value: Any) -> Any:
    """A numpy number as a Python one, which the state store takes."""
    return value.item() if hasattr(value, "item") else value


def keyed_states(stream: DataFrame, key: str, value: str, update: Update, state_type: str = "bigint",
                 partial: Partial | None = None, start_from: DataFrame | None = None) -> DataFrame:
    """A stream of (key, state): in every batch the new state of each key that
    has rows in it.

    ``update(values, state)`` is called for the Arrow batches of a key's values
    one after the other, first with the key's state (None for a new key), then
    with what it returned; so a key with any number of rows needs the memory of
    one Arrow batch. It must not depend on how the values are cut or ordered.
    ``partial(values)`` makes one value of several before the shuffle, so that a
    key that holds a third of all rows sends one row per Arrow batch; ``update``
    then gets those.

    ``start_from`` (``key``, ``state``; one row a key) holds states to begin
    with: a key's first values meet its state there. A state of None is kept as
    None. A NULL key is a key like any other. NULL values reach the functions
    as pandas has them. Writers use the output mode ``update``.
    """
    ship_package(stream.sparkSession)
    rows = stream.select(F.col(key).alias("k"), F.col(value).alias("v"))
    kind = rows.schema["k"].dataType

    def shorten(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            groups = pdf.groupby("k", dropna=False, sort=False)["v"]
            made = [(None if pd.isna(k) else k, partial(v)) for k, v in groups]
            yield pd.DataFrame(made, columns=["k", "v"])

    if partial is not None:
        rows = rows.mapInPandas(shorten, rows.schema)
    # an array keeps the type of a state that some keys do not have
    of_state = T.DataType.fromDDL(state_type)
    if start_from is None:
        rows = rows.withColumn("s", F.lit(None).cast(T.ArrayType(of_state)))
    else:
        known = start_from.select(
            F.col(key).alias("_k"), F.array(F.col("state").cast(of_state)).alias("s")
        )
        rows = rows.join(known, F.col("k").eqNullSafe(F.col("_k")), "left").drop("_k")

    def step(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.exists
        now = state.get[0] if seen else None
        for pdf in frames:
            if not seen:
                given = pdf["s"].iloc[0]
                now, seen = (None if given is None else _plain(given[0])), True
            now = _plain(update(pdf["v"], now))
        state.update((now,))
        yield pd.DataFrame({"k": pd.Series([name[0]], dtype=object), "state": pd.Series([now], dtype=object)})

    out = T.StructType().add("k", kind).add("state", of_state)
    kept = T.StructType().add("state", of_state)
    states = rows.groupBy("k").applyInPandasWithState(step, out, kept, "update", GroupStateTimeout.NoTimeout)
    return states.select(F.col("k").alias(key), "state")


def keyed_state_query(
    stream: DataFrame,
    key: str,
    value: str,
    update: Update,
    out_path: str,
    checkpoint: str,
    state_type: str = "bigint",
    partial: Partial | None = None,
    start_from: DataFrame | None = None,
    trigger: str | None = None,
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Start :func:`keyed_states`; every batch writes the keys it changed as
    one partition, which a replay replaces. Read with :func:`latest_states`."""
    states = keyed_states(stream, key, value, update, state_type, partial, start_from)
    writer = states.writeStream.outputMode("update").foreachBatch(
        lambda df, batch_id: append_batch(df, out_path, batch_id)
    )
    return start(
        writer, checkpoint, trigger, spark=stream.sparkSession,
        state_partitions=state_partitions, state_store=state_store,
    )


def latest_states(
    spark: SparkSession,
    path: str,
    key: str,
    key_type: str = "string",
    state_type: str = "bigint",
    start_from: DataFrame | None = None,
) -> DataFrame:
    """(key, state) after the last batch; with ``start_from`` also the keys of
    which no batch had a row. States of None are left out."""
    schema = f"`{key}` {key_type}, state {state_type}, batch_id bigint"
    now = latest_per_key(spark, path, schema, [key], ["state"])
    if start_from is not None:
        seen = now.select(F.col(key).alias("_k"))
        unseen = start_from.select(F.col(key).cast(key_type).alias(key), F.col("state").cast(state_type).alias("state"))
        now = now.unionByName(unseen.join(seen, F.col(key).eqNullSafe(F.col("_k")), "left_anti"))
    return now.where(F.col("state").isNotNull())
