"""N-gram Jaccard join of whole documents by count-vector R-trees.

A document is its set of distinct word shingles. Shingles are hashed into
groups; the numbers of shingles per group are the coordinates of a point, and
``sum(min(a, b))`` over the coordinates bounds the overlap of two sets from
above.

One flat R-tree over all points cannot prune: unrelated documents of equal
size differ by little in every coordinate. So the first level of the index is
exact matching of coordinate blocks. Sets that link differ in at most
``t = (a + b) / 19`` shingles (at Jaccard 0.9); with more than t blocks of
coordinates, some block is equal in both points. Each set is dealt to one cell
per block of its size class (and of the next class, if a larger partner can be
there). A block with few shingles is equal in many unrelated sets, so there are
more blocks than needed and each set leaves out as many of its smallest. Only
sets that share a cell, directly or through others, meet again.

Those families are packed into R-tree leaf pages by size. A page is searched
within itself, pairs of pages only if their boxes can hold a link and their
sets are not yet known to be connected. Surviving pairs are verified on the
sets. Nothing is cut off, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwise.llm.common import components, discard, materialize, mix64, ship_package, small, word_hashes

#: Coordinates of a point that is used for bounds.
GROUPS = 64
#: Coordinates of one routing block; finer than any block's share of a set.
BLOCK_GROUPS = 1 << 20
#: Sets, and bytes of their hashes, on one leaf page.
PAGE_SETS, PAGE_BYTES = 128, 16 << 20
#: Sets of each family that are compared with all page components first.
HUBS = 4
#: Bytes of sets handed to one task at a time.
TASK_BYTES = 16 << 20


def lower_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct hashes of k-word shingles; a shorter text is one."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(words)
    if len(h) < k:
        out = np.array([len(h)], dtype=np.uint64)
        for x in h:
            out = mix64(out * np.uint64(31) + x)
        return out
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i]
    return np.unique(mix64(out))


def set_id(hashes: np.ndarray) -> int:
    """One signed 64-bit id of a set."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


class Bounds:
    """Integer forms of ``intersection / union >= share`` for share in percent."""

    def __init__(self, percent: int):
        self.p = percent

    def links(self, common, a, b):
        return (100 + self.p) * common >= self.p * (a + b)

    def differ(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of these sizes."""
        return (a + b) * (100 - self.p) // (100 + self.p)


def size_classes(limit: int, growth: float = 1.35) -> list[int]:
    """Lower ends of the size classes up to beyond ``limit``."""
    ends = [1]
    while ends[-1] <= limit:
        ends.append(max(ends[-1] + 1, int(ends[-1] * growth)))
    return ends


def route(hashes: np.ndarray, bounds: Bounds, ends: list[int]) -> np.ndarray:
    """Cells of a set: one per block of its class, and of the next class if a
    partner there can link. A cell is named by class, block and the counts of
    the block's coordinates (through a linear hash of the counts).

    With at most t differences and t + 1 + slack blocks, at least slack + 1
    blocks are equal in both sets. Each set leaves out its slack smallest
    blocks, ordered by number of shingles, then place. Equal blocks hold
    equally many, so the last of them in that order comes after slack others
    in either set: neither leaves it out.
    """
    n = len(hashes)
    at = int(np.searchsorted(ends, n, side="right")) - 1
    out = []
    for c in (at, at + 1):
        low, high = ends[c], ends[c + 1] - 1
        if c > at and 100 * n < bounds.p * low:
            break
        differ = bounds.differ(high, high)
        if differ == 0:
            continue  # only equal sets link
        slack = 1 + differ // 4
        blocks = differ + 1 + slack
        block = ((hashes >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
        value = mix64(hashes % np.uint64(BLOCK_GROUPS) + np.uint64(1))
        total = np.zeros(blocks, dtype=np.uint64)
        np.add.at(total, block, value)
        cells = mix64(total + mix64(np.arange(blocks, dtype=np.uint64) + np.uint64(c << 40)))
        out.append(cells[np.argsort(np.bincount(block, minlength=blocks), kind="stable")[slack:]])
    return np.concatenate(out).view(np.int64) if out else np.empty(0, dtype=np.int64)


def points(sets: list[np.ndarray]) -> np.ndarray:
    """Shingles per group: the sets' points, a row each."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets]) * GROUPS
    flat = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    counts = np.bincount(row + (flat >> np.uint64(58)).astype(np.int64), minlength=len(sets) * GROUPS)
    return counts.astype(np.int32).reshape(-1, GROUPS)


class Forest:
    """Union-find over a few ids."""

    def __init__(self, names):
        self.up = {x: x for x in names}

    def find(self, x):
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def search_page(sids, points, sizes, sets, bounds: Bounds, split: int | None = None, known: dict | None = None) -> list:
    """Links as a forest of (sid, sid): within a page, or with ``split``
    between its first ``split`` rows and the rest. Pairs whose summed
    coordinate minima are too small, and pairs already connected, are not
    verified."""
    forest = Forest([known.get(s, s) if known else s for s in sids])
    name = [known.get(s, s) if known else s for s in sids]
    out = []
    for i in range(len(sids) if split is None else split):
        first = i + 1 if split is None else split
        best = np.minimum(points[i], points[first:]).sum(1)
        for j in (np.flatnonzero(bounds.links(best, sizes[i], sizes[first:])) + first).tolist():
            if forest.find(name[i]) != forest.find(name[j]) and bounds.links(
                common_count(sets[i], sets[j]), int(sizes[i]), int(sizes[j])
            ):
                forest.join(name[i], name[j])
                out.append((int(sids[i]), int(sids[j])))
    return out


def _open(pdf: pd.DataFrame, by: str) -> Iterator[tuple[slice, tuple]]:
    """Runs of equal ``by`` in sorted rows, each as (rows, (sids, points,
    sizes, sets))."""
    if not len(pdf):
        return
    sets = [np.frombuffer(s, dtype=np.uint64) for s in pdf["hashes"]]
    sids, sizes, key = pdf["sid"].to_numpy(), pdf["n"].to_numpy(), pdf[by].to_numpy()
    ends = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(pdf)]
    for a, b in zip(ends, ends[1:], strict=False):
        part = slice(a, b)
        yield part, (sids[part], points(sets[part]), sizes[part], sets[part])


def join_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90
) -> DataFrame:
    """Components of documents whose shingle sets have Jaccard >= percent.

    Result per row: id, n_shingles, component_id (smallest id reachable by
    links, itself included). Null texts and texts without words have an empty
    set and link with nothing; texts of fewer than k words are one shingle.
    Rows of a repeated id take part as rows of their own; null ids are
    returned with a null component and link with nothing. Other columns are
    ignored. An empty table gives no rows.

    Sets are compared by 64-bit shingle hashes.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bounds = Bounds(percent)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends = size_classes(1 << 12)
        for pdf in batches:
            n, sid, cells, seen = [], [], [], set()
            for known, text in zip(pdf["id"].notna(), pdf["t"], strict=True):
                s = shingle_set(lower_words(text), k) if isinstance(text, str) else np.empty(0, dtype=np.uint64)
                n.append(len(s))
                if len(s) > ends[-3]:
                    ends = size_classes(4 * len(s))
                name = set_id(s) if len(s) and known else None
                sid.append(name)
                # copies within a batch are dealt once
                cells.append(None if name is None or name in seen else route(s, bounds, ends))
                seen.add(name)
            yield pd.DataFrame({"id": pdf["id"], "n": n, "sid": pd.array(sid, dtype="Int64"), "cells": cells})

    signed = materialize(source.mapInPandas(sign, "id long, n long, sid long, cells array<long>"), "jaccard-signed")
    dealt = signed.where(F.col("sid").isNotNull()).select("sid", F.explode("cells").alias("cell"))
    shared = (
        dealt.groupBy("cell")
        .agg(F.min("sid").alias("low"), F.max("sid").alias("high"))
        .where(F.col("low") < F.col("high"))
        .select("cell", "low")
    )
    shared = materialize(shared, "jaccard-shared")
    meets = dealt.join(small(shared, 1_000_000), "cell")  # two longs a row
    meets = meets.where(F.col("sid") != F.col("low")).select("sid", "low").distinct()
    family = materialize(components(meets, "sid", "low").select(F.col("node").alias("sid"), F.col("component").alias("family")), "jaccard-family")
    # the result reads what follows; cells are most of the bytes
    dealt_rows, signed = signed, materialize(signed.select("id", "n", "sid"), "jaccard-ids")
    discard(dealt_rows, shared)

    reps = signed.where(F.col("sid").isNotNull()).groupBy("sid").agg(F.min("id").alias("rep"))
    wanted = materialize(reps.join(family, "sid").select(F.col("rep").alias("id"), "sid", "family"), "jaccard-wanted")

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for sid, fam, text in zip(pdf["sid"], pdf["family"], pdf["t"], strict=True):
                s = shingle_set(lower_words(text), k)
                if set_id(s) == sid:  # an id may repeat with another text
                    rows.append((sid, fam, len(s), s.tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["sid", "family", "n", "hashes"])

    sets = (
        source.where(F.col("t").isNotNull())
        .join(small(wanted), "id")
        .mapInPandas(gather, "sid long, family long, n long, hashes binary")
        .dropDuplicates(["sid"])
    )
    edges = family_links(sets, bounds)
    linked = components(edges, "a", "b").select(F.col("node").alias("sid"), F.col("component").alias("class"))
    ids = reps.join(linked, "sid", "left").withColumn("class", F.coalesce("class", "sid"))
    least = ids.groupBy("class").agg(F.min("rep").alias("component_id"))
    named = ids.join(least, "class").select("sid", "component_id")
    return (
        signed.select("id", "n", "sid")
        .join(named, "sid", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )


def family_links(sets: DataFrame, bounds: Bounds) -> DataFrame:
    """Links (a, b) between sets of the same family, enough to connect what
    is connected. ``sets``: sid, family, n, hashes; every sid once. They are
    written once; pages and points are made of them by the tasks that search.
    """
    spark = sets.sparkSession
    tile = F.floor(F.log(F.col("n").cast("double")) / F.lit(0.02)).cast("int")
    sets = materialize(sets.withColumn("tile", tile), "jaccard-sets")
    # leaf pages: sets of a family by size, cut by number and bytes
    tiles = sets.groupBy("family").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    more = (F.col("c") > PAGE_SETS) | (F.col("w") * 8 > PAGE_BYTES)
    # only families of more than one page are listed: they are few, so that the sets,
    # which are long, are joined where they are and dealt out once, to the tasks
    tiles = small(materialize(tiles.where(more).select("family", F.lit(True).alias("_wide")), "jaccard-tiles"))
    packed = sets.join(tiles, "family", "left").withColumn(
        "tile", F.when(F.col("_wide"), F.col("tile")).otherwise(F.lit(0))
    )
    cuts = packed.where("_wide").groupBy("family", "tile").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / PAGE_SETS), F.ceil(F.sum("n") * 8 / PAGE_BYTES)).cast("int").alias("cuts")
    )
    cuts = small(materialize(cuts, "jaccard-cuts"))
    cut = F.pmod(F.xxhash64("sid"), F.coalesce("cuts", F.lit(1)))
    packed = packed.join(cuts, ["family", "tile"], "left").withColumn("page", F.xxhash64("family", "tile", cut))
    paged = packed.select("sid", "family", "n", "hashes", "page")
    weight = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * 8
    tasks = max(1, -(-int(weight) // TASK_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def within(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, page in _open(pdf.sort_values(["page", "n", "sid"]), "page"):
            if len(page[0]) > 1:
                out += search_page(*page, bounds)
        return pd.DataFrame(out, columns=["a", "b"])

    inside = materialize(
        paged.withColumn("task", F.pmod(F.xxhash64("page"), F.lit(tasks)))
        .repartition(tasks, "task")  # work follows pairs, not bytes: not to be coalesced
        .groupBy("task")
        .applyInPandas(lambda pdf: within(pdf), "a long, b long"),
        "jaccard-inside",
    )
    edges = inside
    wide = packed.where("_wide").select(paged.columns)
    if wide.limit(1).count():
        edges = edges.unionByName(_across(wide, inside, bounds, tasks))
    discard(sets)
    return edges


def _across(wide: DataFrame, inside: DataFrame, bounds: Bounds, tasks: int) -> DataFrame:
    """Links between pages of families that fill more than one page."""
    # hubs first: in a family of near copies they connect most pages
    found = components(inside, "a", "b")
    label = wide.select("sid", "family", "page").join(
        found.select(F.col("node").alias("sid"), "component"), "sid", "left"
    )
    label = materialize(label.withColumn("component", F.coalesce("component", "sid")), "jaccard-label")
    heads = label.groupBy("family", "component").agg(F.min("sid").alias("sid"))
    hubs = small(materialize(_first_hubs(heads), "jaccard-hubs"))
    pairs = heads.join(hubs, "family").where(F.col("sid") != F.col("hub")).select("sid", "hub")
    left = wide.select("sid", "n", "hashes")
    right = wide.select(F.col("sid").alias("hub"), F.col("n").alias("hub_n"), F.col("hashes").alias("hub_hashes"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            own, other = ([np.frombuffer(s, dtype=np.uint64) for s in pdf[c]] for c in ("hashes", "hub_hashes"))
            best = np.minimum(points(own), points(other)).sum(1).tolist()
            for a, b, n, m, most, s, t in zip(pdf["sid"], pdf["hub"], pdf["n"], pdf["hub_n"], best, own, other, strict=True):
                if bounds.links(most, n, m) and bounds.links(common_count(s, t), n, m):
                    out.append((a, b))
            yield pd.DataFrame(out, columns=["a", "b"])

    starred = materialize(pairs.join(left, "sid").join(right, "hub").mapInPandas(verify, "a long, b long"), "jaccard-star")
    so_far = components(inside.unionByName(starred), "a", "b").select(F.col("node").alias("sid"), F.col("component").alias("known"))
    known = materialize(
        wide.join(so_far, "sid", "left").withColumn("known", F.coalesce("known", "sid")), "jaccard-known"
    )

    # page boxes: largest coordinate per group, smallest size, classes inside
    def box(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        pdf = pdf.sort_values(["page", "n", "sid"])
        for part, (_, points, sizes, _) in _open(pdf, "page"):
            first, classes = pdf.iloc[part.start], pdf["known"].iloc[part].unique()
            name = (int(first["family"]), int(first["page"]))
            rows.append((*name, points.max(0).tobytes(), int(sizes.min()), int(classes[0]), len(classes)))
        return pd.DataFrame(rows, columns=["family", "page", "high", "least", "known", "classes"])

    boxes = materialize(
        known.withColumn("task", F.pmod(F.xxhash64("page"), F.lit(tasks)))
        .groupBy("task")
        .applyInPandas(lambda pdf: box(pdf), "family long, page long, high binary, least long, known long, classes int"),
        "jaccard-boxes",
    )
    other = boxes.select("family", *[F.col(c).alias(f"{c}_2") for c in ("page", "high", "least", "known", "classes")])
    open_pairs = boxes.join(other, "family").where(
        (F.col("page") < F.col("page_2"))
        & ~((F.col("classes") == 1) & (F.col("classes_2") == 1) & (F.col("known") == F.col("known_2")))
    )

    def overlap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [
                bool(bounds.links(int(np.minimum(np.frombuffer(p, dtype=np.int32), np.frombuffer(q, dtype=np.int32)).sum()), a, b))
                for p, q, a, b in zip(pdf["high"], pdf["high_2"], pdf["least"], pdf["least_2"], strict=True)
            ]
            yield pdf.loc[keep, ["page", "page_2"]]

    units = open_pairs.mapInPandas(overlap, "page long, page_2 long").withColumn("unit", F.xxhash64("page", "page_2"))
    units = materialize(units, "jaccard-units")
    sides = units.select("unit", "page", F.lit(0).alias("side")).unionByName(
        units.select("unit", F.col("page_2").alias("page"), F.lit(1).alias("side"))
    )

    def between(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        pdf = pdf.sort_values(["unit", "side", "n", "sid"])
        names = dict(zip(pdf["sid"], pdf["known"], strict=True))
        side = pdf["side"].to_numpy()
        for part, unit in _open(pdf, "unit"):
            out += search_page(*unit, bounds, split=int((side[part] == 0).sum()), known=names)
        return pd.DataFrame(out, columns=["a", "b"])

    crossed = materialize(
        sides.join(known, "page")
        .select("unit", "side", "sid", "n", "hashes", "known")
        .repartition(4 * tasks, "unit")
        .groupBy("unit")
        .applyInPandas(lambda pdf: between(pdf), "a long, b long"),
        "jaccard-across",
    )
    return starred.unionByName(crossed)


def _first_hubs(heads: DataFrame) -> DataFrame:
    """Up to HUBS page components of each family, by hash: one minimum of
    each of HUBS hash orders, aggregated map-side."""
    picks = [F.min_by("sid", F.xxhash64("sid", F.lit(i))).alias(f"h{i}") for i in range(HUBS)]
    return (
        heads.groupBy("family")
        .agg(*picks)
        .select("family", F.explode(F.array_distinct(F.array(*[f"h{i}" for i in range(HUBS)]))).alias("hub"))
    )
