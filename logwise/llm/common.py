"""Helpers shared by the operators: tables, intermediate files, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwise.session import scratch_path, ship_package
from logwise.sources.storage import folder_bytes, remove_folder

__all__ = ["components", "discard", "materialize", "mix64", "read_table", "ship_package", "small", "word_hashes"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; a single file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting that removes the shuffle files of a query when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks of the stage that
    runs, never a recomputation from the input. Shuffle files of the write go
    with its end; nothing reads them again, and they would otherwise stay on
    the executors' disks until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`materialize` wrote, once all that reads them
    has been written itself."""
    for df in tables:
        if hasattr(df, "_jdf") and "_scratch" in vars(df):
            remove_folder(df.sparkSession, df._scratch)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply) over a uint64 array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes:
    """64-bit hashes of words, the same on every worker; a bounded memo."""

    def __init__(self, limit: int = 400_000):
        self.limit, self.memo = limit, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        memo, digest = self.memo, xxhash.xxh3_64_intdigest
        if len(memo) > self.limit:
            memo.clear()
        out = list(map(memo.get, words))
        if None in out:
            for i, h in enumerate(out):
                if h is None:
                    out[i] = memo[words[i]] = digest(words[i])
        return np.array(out, dtype=np.uint64)


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of UTF-8 ``words`` through the memo of this Python worker."""
    return _HASHES(words)


def forget_words() -> None:
    """Empty the memo of this Python worker, which outlives a task: for
    operators that hash no words and keep a memo of their own."""
    _HASHES.memo.clear()


def small(
    df: DataFrame,
    max_rows: int = 500_000,
    max_bytes: int | None = None,
    lists: str | None = None,
    entry_bytes: int = 0,
) -> DataFrame:
    """A written table of narrow rows as the small side of a join: broadcast
    up to ``max_rows`` counted rows and, of a table that :func:`materialize`
    wrote, ``max_bytes`` of files; else joined by a shuffle. Files say little
    of the memory that repeated entries take, so the entries of a column of
    ``lists`` are counted too, at ``entry_bytes`` each."""
    if max_bytes is not None and "_scratch" in vars(df) and folder_bytes(df.sparkSession, df._scratch) > max_bytes:
        return df.hint("merge")
    if lists is None:
        return F.broadcast(df) if df.count() <= max_rows else df
    rows, entries = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(lists)), F.lit(0))).first()
    if max_bytes is not None and entries * entry_bytes > max_bytes:
        return df.hint("merge")
    return F.broadcast(df) if rows <= max_rows else df


def components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list of long ids.

    Returns (node, component) for every node that has an edge to another
    node; component is the smallest node id reachable. Null ends and loops are
    ignored; an empty list gives an empty result.

    Each task first contracts its own edges to stars. Then alternating
    large-star / small-star rounds attach every node to the smallest neighbour
    known so far, until all that is left are stars. Minima are aggregated
    map-side and joined back on the node, so a hub with any number of
    neighbours is split by the skew-join rule instead of being gathered. Each
    round is written to the shared folder. The driver sees three numbers a
    round; files and tasks follow the number of edges.
    """
    ship_package(edges.sparkSession)
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    plain = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    cur = materialize(plain.mapInPandas(_contract, "u long, v long").distinct(), "cc-edges")
    for _ in range(max_rounds):
        n, settled = _state(cur)
        if settled:
            break
        tasks = max(1, n // EDGES_PER_TASK)
        # large star: larger neighbours of u go to the smallest of u and all its neighbours
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        star = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = star.unionByName(least.select("u", F.col("m").alias("v"))).coalesce(tasks)
        before = cur
        cur = materialize(after.mapInPandas(_contract, "u long, v long").distinct().coalesce(tasks), "cc-round")
        discard(before)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


#: Edges of one task of a components round.
EDGES_PER_TASK = 200_000


def _contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of each batch as stars around the smallest node of a component."""
    for pdf in frames:
        up: dict[int, int] = {}
        for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True):
            while (x := up.get(a, a)) != a:
                up[a] = up.get(x, x)
                a = x
            while (x := up.get(b, b)) != b:
                up[b] = up.get(x, x)
                b = x
            if a != b:
                up[max(a, b)] = min(a, b)
        roots = []
        for x in up:
            r = x
            while (y := up.get(r, r)) != r:
                r = y
            roots.append(r)
        yield pd.DataFrame({"u": list(up), "v": roots}, dtype="int64")


def _state(edges: DataFrame) -> tuple[int, bool]:
    """(edges, whether they are stars: no node with two centres, no centre
    that has a centre itself)."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    node = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = node.agg(
        F.coalesce(F.sum("up"), F.lit(0)).alias("n"),
        F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).alias("bad"),
    ).first()
    return int(row["n"]), row["bad"] == 0
