"""Cleaning and grouping of embedding rows, shared by search and near-dedup."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(vec: Column) -> Column:
    """True for a non-empty vector without null, NaN or infinite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~bad


def distinct_vectors(
    rows: DataFrame, id_col: str, vec_col: str, encode: Callable[[np.ndarray], bytes], keep: int
) -> DataFrame:
    """Rows of equal vectors collapsed: (vec binary, n long, ids array).

    ``ids`` holds the ``keep`` smallest ids, ascending; ``n`` counts all rows.
    Batches are collapsed before the shuffle, so a vector that a third of all
    rows repeat costs a few rows per batch and no task sees its copies.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: dict[bytes, list[int]] = {}
            for i, v in zip(pdf["id"].to_numpy(), pdf["v"], strict=True):
                found.setdefault(encode(np.asarray(v, dtype=np.float64)), []).append(int(i))
            if found:
                yield pd.DataFrame(
                    {
                        "vec": list(found),
                        "n": [len(x) for x in found.values()],
                        "ids": [sorted(x)[:keep] for x in found.values()],
                    }
                )

    parts = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return (
        parts.where(F.col("id").isNotNull())
        .mapInPandas(run, "vec binary, n long, ids array<long>")
        .groupBy("vec")
        .agg(
            F.sum("n").alias("n"),
            F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"),
        )
    )
