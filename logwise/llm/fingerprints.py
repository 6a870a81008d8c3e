"""Document fingerprints by SimHash, in DataFrame expressions only.

Every distinct term of a text casts a weighted vote on each of 64 bits: for
the bit if it is set in the hash of the term, against it if not. A bit of the
fingerprint is set where the votes for it hold more than half of the weight.
Terms are the words of a text (weight 1) and each word together with the up to
four words before it (weight 2), so texts that differ in a part differ in that
part of the votes. Words are lower-cased, end at ASCII white space and are cut after 24
characters, so a text without spaces has terms as well.

Votes are counted two bits to a long: a term's hash, shifted by j and masked,
adds to the low half for bit j and to the high half for bit j + 32. All of it
is partial aggregation of plain longs.

Fingerprints within a Hamming radius r are found through block tables: the 64
bits are cut into b blocks, and two fingerprints within r bits agree in at
least b - r of them. There is one table per choice of b - r blocks, keyed by
the bits of these blocks moved to the front; a pair counts in the first table
in which it agrees.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwise.llm.common import materialize

BITS = 64
#: Characters of a word after which it is cut.
WORD_CHARS = 24
#: Words of a shingle, and the weights of a word and of a shingle.
SHINGLE, WORD_WEIGHT, SHINGLE_WEIGHT = 5, 1, 2
#: Blocks of the block tables; with radius 3 they make 20 tables.
RADIUS, BLOCKS = 3, 6
#: Fingerprints of one key of a block table that meet in one row.
PAGE = 256
#: Rows up to which the keys of a query set are broadcast (16 bytes a row).
ASKED_ROWS = 1_000_000

_LANES = 0x1_0000_0001


def _words(text: Column) -> Column:
    return F.split(F.lower(text), r"[\x20\x09-\x0D]+")


def _word_hashes(words: Column) -> Column:
    """Hashes of the non-empty words, long ones in parts."""
    parts = F.flatten(F.transform(words, lambda w: F.regexp_extract_all(w, F.lit(rf"(?s).{{1,{WORD_CHARS}}}"), F.lit(0))))
    long = F.exists(words, lambda w: F.char_length(w) > WORD_CHARS)
    return F.transform(F.array_remove(F.when(long, parts).otherwise(words), ""), lambda w: F.xxhash64(w))


def _shingle_hashes(words: Column) -> Column:
    """Hash of each word with the words before it; missing ones are skipped."""
    return F.transform(words, lambda w, i: F.xxhash64(*[F.get(words, i - k) for k in range(SHINGLE - 1, 0, -1)], w))


def simhash(rows: DataFrame, keys: list[str], text: str, name: str = "simhash") -> DataFrame:
    """(keys..., name long): the fingerprint of ``text`` per distinct key.

    Rows of equal keys vote together. A null text counts as empty; a text
    without a word has fingerprint 0. Ties of a bit leave it unset. Votes are
    exact up to 2^31 / 2 terms a key. ``rows`` that are already dealt by some
    of the keys are not shuffled again.
    """
    # generators over one row keep the planner from copying an expression into
    # each of its uses
    split = rows.select(*keys, F.explode(F.array(_words(F.coalesce(text, F.lit(""))))).alias("_split"))
    hashed = split.select(*keys, F.explode(F.array(_word_hashes(F.col("_split")))).alias("_words"))
    kinds = F.array(
        F.struct(F.array_distinct("_words").alias("hashes"), F.lit(WORD_WEIGHT).cast("long").alias("weight")),
        F.struct(
            F.array_distinct(_shingle_hashes(F.col("_words"))).alias("hashes"), F.lit(SHINGLE_WEIGHT).cast("long").alias("weight")
        ),
    )
    each = hashed.select(*keys, F.inline(kinds).alias("_hashes", "_weight"))
    votes = each.select(*keys, "_weight", F.explode_outer("_hashes").alias("_hash"))
    weight = F.when(F.col("_hash").isNotNull(), F.col("_weight"))
    half = BITS // 2

    def lane(j: int) -> Column:
        return F.sum(F.shiftrightunsigned("_hash", j).bitwiseAND(F.lit(_LANES)) * F.col("_weight")).alias(f"_lane{j}")

    counted = votes.groupBy(*keys).agg(F.sum(weight).alias("_total"), *[lane(j) for j in range(half)])
    total = F.coalesce("_total", F.lit(0))

    def bit(j: int) -> Column:
        lanes = F.coalesce(f"_lane{j % half}", F.lit(0))
        ayes = lanes.bitwiseAND(F.lit(0xFFFFFFFF)) if j < half else F.shiftrightunsigned(lanes, 32)
        return F.shiftleft((ayes * 2 > total).cast("long"), j)

    return counted.select(*keys, reduce(Column.bitwiseOR, [bit(j) for j in range(BITS)]).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of the votes of two fingerprints, 0 to 1: equal ones
    give 1, ones that differ in half of the bits or more give 0."""
    return F.greatest(F.lit(0.0), F.cos(F.bit_count(a.bitwiseXOR(b)) * F.lit(3.141592653589793 / BITS)))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


# -- search ------------------------------------------------------------------


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """Bit masks of the blocks, as signed longs; sizes differ by one at most."""
    cuts = [i * BITS // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _tables(radius: int, blocks: int) -> tuple[list[int], list[int]]:
    """Masks of the tables, and for each set of agreeing blocks (as bits) the
    first table whose blocks are among them, or -1."""
    masks = block_masks(blocks)
    chosen = list(combinations(range(blocks), blocks - radius))
    first = []
    for agree in range(1 << blocks):
        first.append(next((t for t, c in enumerate(chosen) if all(agree >> b & 1 for b in c)), -1))
    return [reduce(lambda x, y: x | y, (masks[b] for b in c)) for c in chosen], first


def _keyed(fps: DataFrame, masks: list[int], *more: str) -> DataFrame:
    """(table, key, fp, more...): every fingerprint once per table. The key
    keeps the bits of the table's blocks."""
    tables = F.array(
        *[
            F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
            for t, m in enumerate(masks)
        ]
    )
    return fps.select("fp", *more, F.inline(tables).alias("table", "key"))


def _paged(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """(table, key, name array): fingerprints of a key in pages of about
    ``PAGE``, so that a key of any size is many rows, none of them long."""
    crowded = rows.groupBy("table", "key").count().where(F.col("count") > PAGE)
    pages = crowded.select("table", "key", F.ceil(F.col("count") / PAGE).alias("pages"))
    page = F.pmod(F.xxhash64("fp"), F.coalesce("pages", F.lit(1)))
    return (
        rows.join(pages, ["table", "key"], "left")
        .groupBy("table", "key", page.alias("page"))
        .agg(F.collect_list(value).alias(name))
        .drop("page")
    )


def near_fingerprints(
    index: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, count_only: bool = False
) -> DataFrame:
    """All fingerprints of ``index`` within ``radius`` bits of those of ``queries``.

    Both have a long column ``fp``; ``index`` also a long column ``n`` (how
    many documents have it). Result: (fp, near, distance, n) per pair of
    distinct fingerprints, itself included; with ``count_only`` (fp, n): the
    documents within the radius, the query's own included. Null fingerprints
    match nothing. Equal fingerprints of either side are merged first.

    Only rows of the index whose key some query has are kept; they meet the
    queries page by page, so neither a crowded key nor a group of copies is
    gathered or expanded.
    """
    if not 0 <= radius < blocks <= 16:
        raise ValueError("radius must be below blocks, blocks at most 16")
    masks, first = _tables(radius, blocks)
    asked_fps = queries.where(F.col("fp").isNotNull()).select("fp").distinct()
    known = index.where(F.col("fp").isNotNull()).groupBy("fp").agg(F.sum("n").cast("long").alias("n"))
    asked = materialize(_keyed(asked_fps, masks), "blocks-asked")
    keys = materialize(asked.select("table", "key").distinct(), "blocks-keys")
    keys = F.broadcast(keys) if keys.count() <= ASKED_ROWS else keys
    met = materialize(_keyed(known, masks, "n").join(keys, ["table", "key"], "left_semi"), "blocks-met")
    entries = _paged(met, F.struct("fp", "n"), "entries")
    wanted = _paged(asked, F.col("fp"), "wanted")
    meeting = wanted.join(entries, ["table", "key"])

    sizes = block_masks(blocks)
    firsts = F.array(*[F.lit(t) for t in first])

    def counts_here(q: Column, e: Column) -> Column:
        x = q.bitwiseXOR(e["fp"])
        agree = reduce(
            lambda a, b: a + b,
            [F.when(x.bitwiseAND(F.lit(m).cast("long")) == 0, 1 << b).otherwise(0) for b, m in enumerate(sizes)],
        )
        return (F.bit_count(x) <= radius) & (F.get(firsts, agree) == F.col("table"))

    found = meeting.select("table", "entries", F.explode("wanted").alias("fp")).select(
        "fp", F.filter("entries", lambda e: counts_here(F.col("fp"), e)).alias("near")
    )
    if count_only:
        n = F.aggregate("near", F.lit(0).cast("long"), lambda s, e: s + e["n"])
        return found.select("fp", n.alias("n")).groupBy("fp").agg(F.sum("n").cast("long").alias("n"))
    pairs = found.select("fp", F.inline("near").alias("near", "n"))
    return pairs.select("fp", "near", F.bit_count(F.col("fp").bitwiseXOR(F.col("near"))).alias("distance"), "n")


# -- documents and their edited texts -------------------------------------------


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, order) of the documents.

    ``texts`` has (key, text): key is a digest of id and text. ``order`` has
    one row per key: id, n_chars, next_key; the next document by (id, key),
    null ids last; the last is followed by the first.

    The order is found on (id, key) alone: dealt by range, windows inside a
    range, and the first key of the next range from a table of one row a range.
    """
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), whole)
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(F.encode(named, "UTF-8"), 256)).alias("key"), whole.alias("text")
    )
    keys = texts.select(F.col("id").isNull().alias("none"), "id", "key", F.char_length("text").cast("long").alias("n_chars"))
    place = F.struct("none", "id", "key")
    ranged = materialize(
        keys.distinct().repartitionByRange("none", "id", "key").withColumn("part", F.spark_partition_id()), "fingerprint-order"
    )
    starts = ranged.groupBy("part").agg(F.min(place)["key"].alias("first"))
    by_part = Window.orderBy("part")
    after = F.lead("first").over(by_part)
    following = starts.select(F.col("part"), F.coalesce(after, F.first("first").over(by_part)).alias("first_after"))
    inside = Window.partitionBy("part").orderBy(place)
    order = (
        ranged.withColumn("lead_key", F.lead("key").over(inside))
        .join(F.broadcast(following), "part")  # one row per range
        .select("id", "key", "n_chars", F.coalesce("lead_key", "first_after").alias("next_key"))
    )
    return texts.select("key", "text"), materialize(order, "fingerprint-next")


def with_edited(texts: DataFrame, order: DataFrame) -> DataFrame:
    """(key, text, edited): the last floor(n_chars / 4) code points replaced
    by the first as many (or all) of the next document."""
    taken = F.floor(F.col("n_chars") / 4).cast("int")
    asks = order.select(F.col("next_key").alias("key"), F.col("key").alias("for"), taken.alias("taken"))
    tails = (
        texts.join(asks, "key")
        .select(F.col("for").alias("key"), F.substring("text", F.lit(1), F.col("taken")).alias("tail"), "taken")
        .dropDuplicates(["key"])
    )
    kept = F.substring("text", F.lit(1), F.char_length("text") - F.col("taken"))
    return texts.join(tails, "key").select("key", "text", F.concat(kept, F.col("tail")).alias("edited"))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 100) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, compared.

    Result, per distinct (id, text): id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (16 hex digits), near_edited, near_next (likeness to
    the edited text's and the next document's fingerprint) and n_near: for ids
    divisible by ``every`` the number of other documents within ``RADIUS``
    bits, from the block tables over all documents; null for other ids.

    Null texts count as empty; an empty text has fingerprint 0 and its edited
    text is empty. Texts under four characters are their own edited text.
    Null ids come last in the order. Rows of equal id and text are one
    document. Other columns are ignored. A single document is followed by
    itself; an empty table gives no rows.
    """
    texts, order = with_next(docs, id_col, text_col)
    both = with_edited(texts, order).select(
        "key",
        F.posexplode(F.array("text", "edited")).alias("kind", "body"),
    )
    digest = F.when(F.col("kind") == 1, F.sha2(F.encode("body", "UTF-8"), 256))
    hashed = simhash(both.withColumn("digest", digest), ["key", "kind", "digest"], "body")
    own, other = F.col("kind") == 0, F.col("kind") == 1
    found = hashed.groupBy("key").agg(
        F.max(F.when(own, F.col("simhash"))).alias("fp"),
        F.max(F.when(other, F.col("simhash"))).alias("edited_fp"),
        F.max("digest").alias("edited_sha256"),
    )
    found = materialize(order.join(found, "key"), "fingerprints")
    index = found.select("fp", F.lit(1).cast("long").alias("n"))
    near = near_fingerprints(index, found.where(F.col("id") % every == 0).select("fp"), count_only=True)
    following = found.select(F.col("key").alias("next_key"), F.col("fp").alias("next_fp"))
    done = found.join(following, "next_key").join(near, "fp", "left")
    return done.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("id") % every == 0, F.col("n") - 1).alias("n_near"),
    )
