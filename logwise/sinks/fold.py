"""Folding of additive ledgers: months, levels, windows.

A ledger holds one contribution per batch, and totals are a sum over it. A
stream that runs for months leaves one partition per batch, so the batches
are folded into totals from time to time. The folded totals are cut into
parts (a month, a day of windows); a fold rewrites only the parts that new
batches touched, each as a new folder ``part=<p>/fold=<n>``, and then commits
by one small file that names, for every part, its current folder and the last
batch in it. Readers follow the newest commit and add the later batches.

What a failed fold leaves behind is named by no commit and its number is not
used again, so the next fold is not affected. No ``_SUCCESS`` file is needed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwise.sinks.tables import read_batches
from logwise.sources.storage import (
    folder_number,
    matching_files,
    matching_folders,
    newest_number,
    put_file,
    read_file,
    remove_folder,
)


@dataclass(frozen=True)
class Ledger:
    """An additive ledger: sums of ``value`` per ``keys`` over all batches.

    ``schema`` includes ``batch_id``. ``part`` is an SQL expression over the
    keys that cuts the folded totals; ``part_column`` names it if the ledger
    itself is stored by it (``<path>/<part_column>=.../batch_id=...``).
    """

    path: str
    schema: str | T.StructType
    keys: tuple[str, ...]
    value: str
    part: str = "'all'"
    part_column: str | None = None


@dataclass(frozen=True)
class _Commit:
    number: int
    parts: dict[str, tuple[int, int]]  # part -> (fold, last batch in it)
    covered: int  # all batches up to this one are folded, whatever their part


_NOTHING = _Commit(-1, {}, -1)


def _commits(spark: SparkSession, folded: str) -> list[str]:
    return matching_files(spark, f"{folded.rstrip('/')}/_commits/fold=*")


def _newest_commit(spark: SparkSession, folded: str | None, back: int = 0) -> _Commit:
    """The newest commit, or the one ``back`` before it."""
    found = sorted(_commits(spark, folded), key=lambda f: folder_number(f, "fold")) if folded else []
    if len(found) <= back:
        return _NOTHING
    path = found[-1 - back]
    said = json.loads(read_file(spark, path))
    return _Commit(folder_number(path, "fold"), {p: (f, b) for p, f, b in said["parts"]}, said["covered"])


def _rows(spark: SparkSession, ledger: Ledger) -> DataFrame:
    rows = read_batches(spark, ledger.path, ledger.schema)
    part = F.coalesce(F.expr(ledger.part).cast("string"), F.lit("null"))
    return rows.select(*ledger.keys, ledger.value, "batch_id", part.alias("_part"))


def _marks(spark: SparkSession, marks: dict[str, int]) -> DataFrame:
    """One row per part."""
    return F.broadcast(spark.createDataFrame(list(marks.items()), "_part string, _through bigint"))


def _after(spark: SparkSession, rows: DataFrame, commit: _Commit) -> DataFrame:
    """Rows of batches that are not folded yet."""
    if not commit.parts:
        return rows
    marks = _marks(spark, {p: b for p, (_, b) in commit.parts.items()})
    later = F.col("_through").isNull() | (F.col("batch_id") > F.col("_through"))
    return rows.join(marks, "_part", "left").where(later).drop("_through")


def _folded_rows(spark: SparkSession, ledger: Ledger, folded: str, commit: _Commit, parts: Sequence[str]) -> DataFrame:
    """Committed totals of ``parts``; other folders are pruned by their names."""
    types = T.StructType(
        [f for f in spark.createDataFrame([], ledger.schema).schema.fields if f.name in (*ledger.keys, ledger.value)]
        + [T.StructField("part", T.StringType()), T.StructField("fold", T.LongType())]
    )
    current = F.create_map(*[F.lit(x) for p in parts for x in (p, commit.parts[p][0])])
    stored = spark.read.schema(types).parquet(f"{folded.rstrip('/')}/totals")
    return stored.where(F.try_element_at(current, F.col("part")) == F.col("fold")).select(
        *ledger.keys, ledger.value, F.col("part").alias("_part")
    )


def fold(
    spark: SparkSession,
    ledger: Ledger,
    folded: str,
    parts: Sequence[str] | None = None,
    through: int | None = None,
) -> int | None:
    """Fold the batches that are not folded yet; the number of the fold, or
    None if there was nothing to do.

    ``parts`` folds only these parts; ``through`` only batches up to this one
    (of a stream that is running, its last finished batch; ledgers whose
    writer marks finished batches are bounded by that mark anyway).
    """
    commit = _newest_commit(spark, folded)
    fresh = _after(spark, _rows(spark, ledger), commit)
    if parts is not None:
        fresh = fresh.where(F.col("_part").isin(*parts))
    if through is not None:
        fresh = fresh.where(F.col("batch_id") <= F.lit(through))
    touched = {r["_part"]: r["last"] for r in fresh.groupBy("_part").agg(F.max("batch_id").alias("last")).collect()}
    if not touched:
        return None
    root = folded.rstrip("/")
    number = 1 + max(
        newest_number(spark, f"{root}/totals/part=*", "fold") or 0,
        max((folder_number(f, "fold") for f in _commits(spark, folded)), default=0),
    )
    # batches that arrive meanwhile are left to the next fold
    rows = fresh.join(_marks(spark, touched), "_part").where(F.col("batch_id") <= F.col("_through"))
    rows = rows.select(*ledger.keys, ledger.value, "_part")
    before = [p for p in touched if p in commit.parts]
    if before:
        rows = rows.unionByName(_folded_rows(spark, ledger, folded, commit, before))
    totals = rows.groupBy(*ledger.keys, "_part").agg(F.sum(ledger.value).alias(ledger.value))
    (
        totals.select(*ledger.keys, ledger.value, F.col("_part").alias("part"), F.lit(number).cast("bigint").alias("fold"))
        .hint("rebalance", "part")
        .write.mode("append")
        .partitionBy("part", "fold")
        .parquet(f"{root}/totals")
    )
    now = {**commit.parts, **{p: (number, last) for p, last in touched.items()}}
    covered = max(commit.covered, *touched.values()) if parts is None else commit.covered
    said = {"covered": covered, "parts": [[p, f, b] for p, (f, b) in sorted(now.items())]}
    put_file(spark, f"{root}/_commits/fold={number}", json.dumps(said))
    return number


def totals(spark: SparkSession, ledger: Ledger, folded: str | None = None, parts: Sequence[str] | None = None) -> DataFrame:
    """(keys..., value): sums over all batches, folded ones from their totals."""
    commit = _newest_commit(spark, folded)
    rows = _after(spark, _rows(spark, ledger), commit)
    if parts is not None:
        rows = rows.where(F.col("_part").isin(*parts))
    rows = rows.select(*ledger.keys, ledger.value)
    known = [p for p in commit.parts if parts is None or p in parts]
    if known:
        rows = rows.unionByName(_folded_rows(spark, ledger, folded, commit, known).drop("_part"))
    return rows.groupBy(*ledger.keys).agg(F.sum(ledger.value).alias(ledger.value))


def drop_folded(spark: SparkSession, ledger: Ledger, folded: str) -> int:
    """Remove what the newest two commits do not need: folders of earlier and
    failed folds, and ledger batches folded by the commit before the newest
    (a reader may have begun with that one). Returns the folders removed.
    Not to be run beside a fold of the same ledger."""
    now, last = _newest_commit(spark, folded), _newest_commit(spark, folded, back=1)
    root = folded.rstrip("/")
    needed = {f for c in (now, last) for f in {f for f, _ in c.parts.values()}}
    gone = []
    for folder in matching_folders(spark, f"{root}/totals/part=*/fold=*"):
        number = folder_number(folder, "fold")
        if number not in needed and number <= now.number:
            gone.append(folder)
    path = ledger.path.rstrip("/")
    if ledger.part_column is None:
        gone += [f for f in matching_folders(spark, f"{path}/batch_id=*") if folder_number(f, "batch_id") <= last.covered]
    else:
        for part, (_, batch) in last.parts.items():
            inside = matching_folders(spark, f"{path}/{ledger.part_column}={part}/batch_id=*")
            gone += [f for f in inside if folder_number(f, "batch_id") <= batch]
    for folder in gone:
        remove_folder(spark, folder)
    return len(gone)
