"""Window counts from panes: one stored count serves windows of many forms.

A pane is a short interval that divides the lengths and slides of all windows
wanted of it. Rows are counted per pane, one pane a row, whatever the windows
are. A pane enters the windows that hold it at one window start and leaves
them at a later one, so the count of a window is a running total of these two
changes over the window starts: no row is repeated length / slide times.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwise.operators.counts import total_intervals


def interval_micros(spark: SparkSession, interval: str) -> int:
    """Microseconds of an interval such as ``4 hours``; months and years have
    no fixed length and are refused."""
    if re.search(r"month|year", interval, re.IGNORECASE):
        raise ValueError(f"no fixed length: {interval!r}")
    micros = spark.sql(
        "select unix_micros(timestamp_micros(0) + cast(:i as interval)) as us", args={"i": interval}
    ).first()["us"]
    if micros is None or micros <= 0:
        raise ValueError(f"not a positive interval: {interval!r}")
    return int(micros)


def pane_length(spark: SparkSession, windows: Sequence[tuple[str, str]]) -> str:
    """The longest pane that serves all of the (length, slide) forms."""
    if not windows:
        raise ValueError("name at least one (length, slide)")
    return f"{gcd(*[interval_micros(spark, i) for form in windows for i in form])} microseconds"


def pane_counts(df: DataFrame, time_col: str, key: str, pane: str, name: str = "n") -> DataFrame:
    """Rows per (pane, key): ``ps``, ``pe`` (start and end), key, n.

    Panes are aligned to the epoch. Times without a zone are read in the
    session's time zone; rows without a time are in no pane; a NULL key is a
    key like any other. One partial aggregate, one shuffle.
    """
    at = F.window(F.col(time_col).cast("timestamp"), pane)
    return (
        df.groupBy(at.alias("_p"), key)
        .agg(F.count(F.lit(1)).alias(name))
        .select(F.col("_p.start").alias("ps"), F.col("_p.end").alias("pe"), key, name)
    )


def _floor_div(x: Column, step: int) -> Column:
    return F.call_function("div", x - F.pmod(x, F.lit(step)), F.lit(step))


def windows_of_panes(panes: DataFrame, key: str, length: str, slide: str, name: str = "n") -> DataFrame:
    """(ws, we, key, n): the counts of windows of ``length`` every ``slide``,
    as :func:`logwise.operators.windows.sliding_counts` gives them for the
    rows behind the panes; windows without a row of a key are not output.

    ``panes`` may hold several rows of a pane (contributions of batches) and
    panes of different lengths; one that does not divide ``length`` and
    ``slide`` is an error. Two rows a pane enter the running totals, which are
    cut into blocks, so a key seen in every pane is not one task's work.
    """
    spark = panes.sparkSession
    size, step = interval_micros(spark, length), interval_micros(spark, slide)
    start, end = (F.unix_micros(F.col(c)) for c in ("ps", "pe"))
    pane = end - start
    fits = (pane > 0) & (F.lit(size) % pane == 0) & (F.lit(step) % pane == 0)
    checked = F.when(fits, start).otherwise(
        F.raise_error(F.concat(F.lit("a pane does not divide the window: microseconds "), pane.cast("string")))
    )
    # windows k with k * step <= ps and pe <= k * step + size
    first, last = -_floor_div(F.lit(size) - end, step), _floor_div(checked, step)
    reach = panes.select(F.col(key), F.col(name).alias("_n"), first.alias("_first"), last.alias("_last"))
    change = F.array(
        F.struct(F.col("_first").alias("_k"), F.col("_n").alias("_d")),
        F.struct((F.col("_last") + 1).alias("_k"), (-F.col("_n")).alias("_d")),
    )
    changes = reach.where(F.col("_first") <= F.col("_last")).select(key, F.inline(change))
    spans = total_intervals(changes, key, "_k", name, weight="_d").where(F.col(name) > 0)
    each = spans.select(key, name, F.explode(F.sequence("from__k", "to__k")).alias("_k"))
    begin = F.col("_k") * F.lit(step)
    return each.select(
        F.timestamp_micros(begin).alias("ws"), F.timestamp_micros(begin + F.lit(size)).alias("we"), key, name
    )
