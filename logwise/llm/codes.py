"""Vector codes: product quantization in exact integers over a trie of parts.

A vector is cut into equal parts, and each part position has a codebook of a
few entries. Codebooks start from the parts of the smallest ids and are
refined for a fixed number of rounds: every part goes to its nearest entry,
every entry becomes the floored mean of its parts.

Equal parts of a position are counted once, and the distinct parts are kept in
lexicographic order, which is the preorder of a trie over their components.
The trie is walked depth first in blocks of leaves. A node holds the
accumulated squared distances of its prefix to every entry; it is computed
once, from its parent's, for all parts below it. Nodes of the path to the last
leaf of a block stay on a stack, so the next block goes on below them. Leaves
take the smallest distance and add their components, times their count, to
the sums of that entry.

Between rounds only the codebooks (positions x entries) are on the driver. Sums
of a task leave it as decimal strings, so they are exact at any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwise.llm.common import materialize, ship_package
from logwise.operators.sizing import measure

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Leaves of one block of the walk.
BLOCK = 4096
#: Labels whose summed errors are broadcast, and bytes of them.
LABEL_ROWS, LABEL_BYTES = 500_000, 32 << 20
#: Shares of a label where the sums are joined by a shuffle.
LABEL_SHARES = 16


def cuts(dim: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Ranges of the parts; the first ones are longer where dim is no multiple."""
    size, more = divmod(dim, parts)
    ends = [0]
    for p in range(parts):
        ends.append(ends[-1] + size + (p < more))
    return list(zip(ends, ends[1:], strict=False))


def whole(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as integers: int64 where they fit, else Python ints.
    ``scale`` is a power of two, so the product is exact."""
    x = np.asarray(x, dtype=np.float64)
    if x.size == 0 or np.abs(x).max() < 2.0**40:
        return np.floor(x * scale).astype(np.int64)
    flat = [int(v) * scale if abs(v) >= 2.0**52 else int(np.floor(v * scale)) for v in x.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(x.shape)


def _narrow(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the narrowest type that holds every summed squared distance."""
    if x.size == 0 or entries.size == 0:
        return x.astype(np.int64), entries.astype(np.int64)
    most = max(int(x.max()), -int(x.min()), int(entries.max()), -int(entries.min()))
    largest = 4 * most * most * x.shape[1]
    kind = np.int32 if largest < 2**31 else np.int64 if largest < 2**63 else object
    return x.astype(kind), entries.astype(kind)


class TrieWalk:
    """Depth-first walk over parts given in lexicographic order, block by block.

    ``nearest`` returns the index of the nearest entry (ties: the lowest) and
    the squared distance of each part. ``nodes`` counts computed trie nodes.
    """

    def __init__(self, entries: np.ndarray):
        self.entries, self.nodes = entries, 0
        self._last: np.ndarray | None = None
        self._stack: list[np.ndarray] = []

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, dim = parts.shape
        if n == 0 or dim == 0:
            return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        x, entries = _narrow(parts, self.entries)
        # depth at which each part leaves the path of the one before it
        before = np.concatenate([parts[:1] if self._last is None else self._last[None, :], parts[:-1]])
        differs = parts != before
        leaves_at = np.where(differs.any(axis=1), differs.argmax(axis=1), dim)
        if self._last is None:
            leaves_at[0] = 0
        kept = int(leaves_at[0])  # nodes of the stack that the first part shares
        above = np.zeros((1, len(entries)), dtype=x.dtype)  # distances of the parents
        of_parent = np.zeros(n, dtype=np.int64)
        stack = []
        for d in range(dim):
            starts = leaves_at <= d  # a new node begins here
            own = starts.copy()
            own[0] = True
            at = np.flatnonzero(own)
            step = x[at, d][:, None] - entries[None, :, d]
            dist = above[of_parent[at]] + step * step
            if d < kept:
                dist[0] = self._stack[d].astype(dist.dtype)
            self.nodes += len(at) - (d < kept)
            of_parent = np.cumsum(own) - 1
            above = dist
            stack.append(dist[-1])
        self._stack, self._last = stack, parts[-1]
        best = above.argmin(axis=1)
        return best[of_parent], above[np.arange(len(above)), best][of_parent]


def _sorted_distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group of each row in that order) of equal rows."""
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    ordered = parts[order]
    new = np.ones(len(parts), dtype=bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    return order, np.cumsum(new) - 1


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in values])


def distinct_parts(vectors: DataFrame, dim: int, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(position, part, n): the distinct parts and how many vectors have them,
    written in lexicographic order within each file.

    ``part`` holds floor(scale * x) / scale in the vector's own type, which is
    exact: the scale is a power of two. Equal parts are merged before the
    shuffle and dealt by the whole part, so copies do not gather.
    """
    kind = vectors.schema["vec"].dataType.elementType.simpleString()
    floored = F.transform("vec", lambda x: F.when(F.abs(x) < 2.0**40, F.floor(x.cast("double") * scale) / scale).otherwise(x).cast(kind))
    cut = F.array(*[F.slice(F.col("g"), a + 1, b - a) for a, b in cuts(dim, parts)])
    each = vectors.select(F.explode(F.array(floored)).alias("g")).select(F.posexplode(cut).alias("position", "part"))
    counted = each.groupBy("position", "part").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counted.sortWithinPartitions("position", "part"), "code-parts")


def _summed(found: DataFrame, codebooks: list[np.ndarray], scale: int) -> DataFrame:
    """(position, entry, n, sums) per task: counts and weighted component sums."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walks = [TrieWalk(book) for book in codebooks]
        counts = [np.zeros(len(book), dtype=object) for book in codebooks]
        sums = [np.zeros(book.shape, dtype=object) for book in codebooks]
        for pdf in batches:
            position = pdf["position"].to_numpy()
            for p in np.unique(position):
                rows = pdf[position == p]
                book, weights = codebooks[p], rows["n"].to_numpy()
                values = whole(_matrix(rows["part"]), scale)
                for at in range(0, len(rows), BLOCK):
                    block, n = values[at : at + BLOCK], weights[at : at + BLOCK]
                    best, _ = walks[p].nearest(block)
                    most = int(np.abs(block).max()) if block.size else 0
                    fits = most * int(n.sum()) < 2**63
                    weighted = block * (n if fits else n.astype(object))[:, None]
                    for e in np.unique(best):
                        mine = best == e
                        counts[p][e] += int(n[mine].sum())
                        total = weighted[mine].sum(axis=0)
                        sums[p][e] += np.array([int(s) for s in total], dtype=object)
        out = [
            (p, e, str(counts[p][e]), [str(s) for s in sums[p][e]])
            for p in range(len(codebooks))
            for e in range(len(codebooks[p]))
            if counts[p][e]
        ]
        if out:
            yield pd.DataFrame(out, columns=["position", "entry", "n", "sums"])

    return found.mapInPandas(run, "position int, entry int, n string, sums array<string>")


def _means(pdf: pd.DataFrame) -> pd.DataFrame:
    """The floored mean of one entry from the sums of all tasks."""
    n = sum(int(x) for x in pdf["n"])
    sums = [sum(int(x) for x in column) for column in zip(*pdf["sums"], strict=True)]
    return pd.DataFrame({"position": pdf["position"][:1], "entry": pdf["entry"][:1], "mean": [[str(s // n) for s in sums]]})


def refine(found: DataFrame, codebooks: list[np.ndarray], rounds: int = ROUNDS, scale: int = SCALE) -> list[np.ndarray]:
    """Codebooks after ``rounds`` of assignment and replacement."""
    for _ in range(rounds):
        means = _summed(found, codebooks, scale).groupBy("position", "entry").applyInPandas(
            _means, "position int, entry int, mean array<string>"
        )
        books = [book.astype(object) for book in codebooks]
        for row in means.collect():  # positions x entries rows
            books[row["position"]][row["entry"]] = [int(m) for m in row["mean"]]
        codebooks = [_compact(book) for book in books]
    return codebooks


def _compact(book: np.ndarray) -> np.ndarray:
    small = book.size == 0 or max(abs(int(v)) for v in book.ravel()) < 2**62
    return book.astype(np.int64) if small else book


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components by position, entry, place, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for book in codebooks for v in book.ravel()).encode()).hexdigest()


def _assigned(vectors: DataFrame, codebooks: list[np.ndarray], dim: int, scale: int) -> DataFrame:
    """(id, label, code, error): the equal parts of a batch share one leaf."""
    ranges = cuts(dim, len(codebooks))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.select("id", "label").schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            fits = np.array([len(v) == dim for v in pdf["vec"]])
            codes, errors = np.full(len(pdf), None, dtype=object), np.full(len(pdf), None, dtype=object)
            if fits.any():
                values = whole(_matrix(pdf["vec"][fits]), scale)
                total, texts = np.zeros(len(values), dtype=object), np.full(len(values), "", dtype=object)
                for (a, b), book in zip(ranges, codebooks, strict=True):
                    order, group = _sorted_distinct(values[:, a:b])
                    firsts = order[np.flatnonzero(np.diff(group, prepend=-1))]
                    walk = TrieWalk(book)
                    found = [walk.nearest(values[firsts[i : i + BLOCK], a:b]) for i in range(0, len(firsts), BLOCK)]
                    best = np.concatenate([f[0] for f in found])
                    dist = np.concatenate([f[1].astype(object) for f in found])
                    texts[order] += np.array([f"{e:02x}" for e in best], dtype=object)[group]
                    total[order] += dist[group]
                codes[fits] = texts
                errors[fits] = [int(t) if t < 2**63 else None for t in total]
            yield pd.DataFrame(
                {"id": pdf["id"], "label": pdf["label"], "code": codes, "error": pd.array(errors, dtype="Int64")}
            )

    return vectors.mapInPandas(run, f"{fields}, code string, error long")


def _label_errors(found: DataFrame) -> DataFrame:
    """``found`` with label_error; nulls are one label. The sums are broadcast
    after a measurement, else a label is joined in ``LABEL_SHARES`` shares."""
    name = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))
    named = found.withColumn("label_name", name)
    total = F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)")
    sums = materialize(named.groupBy("label_name").agg(total.alias("label_error")), "code-labels")
    if measure(sums, "label_name").fits(LABEL_ROWS, LABEL_BYTES):
        return named.join(F.broadcast(sums), "label_name").drop("label_name")
    dealt = named.withColumn("label_share", F.pmod(F.xxhash64("id", "code"), F.lit(LABEL_SHARES)))
    spread = sums.withColumn("label_share", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SHARES - 1)).cast("array<long>")))
    return dealt.join(spread, ["label_name", "label_share"]).drop("label_name", "label_share")


def compress(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all vectors, and the codebooks.

    Result: (id, label, code, error, label_error): code has two hex digits per
    part; error is the summed squared distance in scaled integers; label_error
    the sum of errors over the rows of equal label, nulls together.

    Rows whose vector is null or holds a null or non-finite component are left
    out. Codebooks start from the ``entries`` smallest ids (equal ids by their
    vectors, null ids last) and are shorter if there are fewer rows. Repeated
    rows count each. Vectors of another length than the first non-empty one (by
    id) have null code and error and no part in the codebooks.
    Errors beyond a long are null. Where the length is no multiple of
    ``parts``, the first parts are one component longer. Other columns are
    ignored. An empty table gives no rows and empty codebooks.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    ship_package(rows.sparkSession)
    vec = F.col(vec_col)
    cleaned = rows.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), F.col(label_col).alias("label")).where(
        F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    order = [F.col("id").asc_nulls_last(), F.col("vec")]
    head = cleaned.where(F.size("vec") > 0).orderBy(*order).select("vec").limit(1).collect()
    dim = len(head[0]["vec"]) if head else 0
    fit = cleaned.where(F.size("vec") == dim)
    seeds = [r["vec"] for r in fit.orderBy(*order).select("vec").limit(entries).collect()]
    start = whole(np.array(seeds, dtype=np.float64).reshape(len(seeds), dim), scale)
    codebooks = [_compact(start[:, a:b]) for a, b in cuts(dim, parts)]
    if seeds:
        codebooks = refine(distinct_parts(fit, dim, parts, scale), codebooks, rounds, scale)
    found = materialize(_assigned(cleaned, codebooks, dim, scale), "codes")
    return _label_errors(found), codebooks


def codes_with_digest(rows: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of :func:`compress`."""
    found, codebooks = compress(rows, id_col)
    return found.select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
