"""Source divergence audit by chunk factorization.

Texts are cut at ASCII white space into chunks, and chunks are counted per
(lang, source): documents that hold the chunk, and occurrences. A term is a
run of letters or of characters beyond ASCII, so no term spans two chunks and
a chunk needs to be tokenized once per source only, however often it occurs.
That is done where its counts are summed, so nothing is joined back to them.

Occurrences of a term are a sum over its chunks. Documents are not, since one
document may hold several chunks of a term ("word", "word,"). The number of
documents lies between that of the term's most frequent chunk and the sum over
its chunks; where both lie on the same side of the threshold it is decided,
first by the chunks of single sources, then by those of the whole language.
Only the rest, terms of a few rare chunks, is counted document by document.

Sums over all kept terms of a pair of sources do not walk terms that neither
has: with f(a, b) the divergence of two counts, the sum is

    V f(0, 0) + sum over terms of the first (f(a, 0) - f(0, 0))
              + the same of the second
              + sum over common terms (f(a, b) - f(a, 0) - f(0, b) + f(0, 0)),

the first two sums taken over the distinct counts of a source. All arithmetic
is in longs and exact for up to 9e15 occurrences.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwise.llm.common import materialize
from logwise.operators.sizing import broadcast_if_small, measure

#: A term: ASCII letters and all characters beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that a kept term is in, at least.
LEAST_DOCS = 10
#: Terms listed per source.
TOP_TERMS = 10
#: Chunks of sources that a task counts before it hands them on, and bytes of text.
TALLY_CHUNKS, TALLY_BYTES = 600_000, 1 << 26
#: Chunks of undecided terms that are sent to the tasks, at most, and their bytes.
OPEN_CHUNKS, OPEN_BYTES = 500_000, 1 << 24


def chunks(text: Column) -> Column:
    """Chunks of a text between ASCII white space; the first or last may be
    empty."""
    return F.split(text, r"[\x20\x09-\x0D]+")


def _source_rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    empty = F.lit("")
    plain = docs.select(
        *[F.coalesce(F.col(c).cast("string"), empty).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    )
    return plain.withColumn("g", F.xxhash64("lang", "source"))


def source_names(rows: DataFrame) -> DataFrame:
    """(g, lang, source): the (lang, source) pairs by the number that stands
    for them while chunks are counted; two pairs of one number are an error."""
    names = materialize(rows.select("g", "lang", "source").distinct(), "audit-names")
    if names.groupBy("g").count().where(F.col("count") > 1).count():
        raise RuntimeError("two sources share a hash")
    return names


def count_chunks(rows: DataFrame) -> DataFrame:
    """(g, chunk, docs, n): documents and occurrences per source and chunk;
    both are summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[int, tuple[Counter[bytes], Counter[bytes]]] = {}

        def flush() -> pa.RecordBatch:
            names = [list(n) for _, n in tally.values()]
            flat = itertools.chain.from_iterable
            out = [
                pa.array(np.repeat(list(tally), [len(x) for x in names]), pa.int64()),
                pa.array(list(flat(names)), pa.binary()),
                pa.array(list(flat(map(d.__getitem__, x) for x, (d, _) in zip(names, tally.values(), strict=True))), pa.int64()),
                pa.array(list(flat(n.values() for _, n in tally.values())), pa.int64()),
            ]
            tally.clear()
            return pa.RecordBatch.from_arrays(out, ["g", "chunk", "docs", "n"])

        kinds = held = 0
        for batch in batches:
            for g, text in zip(batch["g"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = text.split()  # bytes: at ASCII white space
                docs, n = tally.setdefault(g, (Counter(), Counter()))
                before = len(n)
                n.update(words)
                docs.update(set(words))
                kinds, held = kinds + len(n) - before, held + len(text)
                if kinds > TALLY_CHUNKS or held > TALLY_BYTES:
                    yield flush()
                    kinds = held = 0
        if kinds:
            yield flush()

    parts = rows.select("g", F.col("text").cast("binary").alias("text")).mapInArrow(run, "g long, chunk binary, docs long, n long")
    return parts.groupBy("g", F.col("chunk").cast("string").alias("chunk")).agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def chunk_rows(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(lang, row, chunk): the chunks of each text that are asked for in any
    language, each once. More than OPEN_CHUNKS or OPEN_BYTES of them are not
    sent to the tasks; then every chunk of a text is given."""
    # row numbers come straight from the scan: a repeated task gives the same
    numbered = rows.select("lang", F.monotonically_increasing_id().alias("row"), "text")
    wanted = asked.select("chunk").distinct()
    if not measure(wanted, "chunk").fits(OPEN_CHUNKS, OPEN_BYTES):
        return numbered.select("lang", "row", F.explode(F.array_distinct(chunks(F.col("text")))).alias("chunk"))
    names = wanted.select(F.col("chunk").cast("binary").alias("chunk")).toArrow()["chunk"].to_pylist()
    sent = rows.sparkSession.sparkContext.broadcast(frozenset(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.intersection(t.split()) for t in batch["text"].to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            flat = pa.array(list(itertools.chain.from_iterable(found)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch["lang"].take(at), batch["row"].take(at), flat], ["lang", "row", "chunk"])

    seen = numbered.select("lang", "row", F.col("text").cast("binary").alias("text"))
    seen = seen.mapInArrow(run, "lang string, row long, chunk binary")
    return seen.select("lang", "row", F.col("chunk").cast("string").alias("chunk"))


def tokenize(counted: DataFrame) -> DataFrame:
    """(g, chunk, term, docs, c): terms of each counted chunk, with the
    documents that hold the chunk and the term's occurrences in it."""
    low = F.translate("chunk", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = counted.select("g", "chunk", "docs", "n", F.regexp_extract_all(low, F.lit(TERM), F.lit(0)).alias("found"))
    terms = cut.select("g", "chunk", "docs", "n", "found", F.explode(F.array_distinct("found")).alias("term"))
    times = F.size("found") - F.size(F.array_remove("found", F.col("term")))
    return terms.select("g", "chunk", "term", "docs", (F.col("n") * times).alias("c"))


def sum_terms(held: DataFrame) -> DataFrame:
    """(g, term, c, low, high): occurrences of a term in a source, documents
    of its most frequent chunk and the sum over its chunks."""
    return held.groupBy("g", "term").agg(F.sum("c").alias("c"), F.max("docs").alias("low"), F.sum("docs").alias("high"))


def kept_terms(rows: DataFrame, names: DataFrame, held: DataFrame, summed: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term) in at least ``least_docs`` documents of the language.

    The bounds of the sources decide most terms. Only for the rest are the
    documents of a chunk summed over sources, and documents counted."""
    langs = names.select("g", "lang")
    bounds = summed.join(langs, "g").groupBy("lang", "term").agg(F.max("low").alias("low"), F.sum("high").alias("high"))
    bounds = materialize(bounds.where(F.col("high") >= least_docs), "audit-bounds")
    rest, _ = broadcast_if_small(bounds.where(F.col("low") < least_docs).select("lang", "term"), "term")
    by_lang = held.select("g", "chunk", "term", "docs").join(langs, "g").join(rest, ["lang", "term"])
    by_lang = by_lang.groupBy("lang", "chunk", "term").agg(F.sum("docs").alias("docs"))
    by_lang = materialize(by_lang, "audit-chunks")
    low = materialize(by_lang.groupBy("lang", "term").agg(F.max("docs").alias("low")), "audit-low")
    open_terms = low.where(F.col("low") < least_docs).select("lang", "term")
    asked = materialize(by_lang.join(open_terms, ["lang", "term"]).select("lang", "chunk", "term"), "audit-open")
    given = chunk_rows(rows, asked)
    asked, _ = broadcast_if_small(asked, "term")
    seen = given.join(asked, ["lang", "chunk"])
    exact = seen.select("lang", "term", "row").distinct().groupBy("lang", "term").count()
    found = exact.where(F.col("count") >= least_docs).select("lang", "term")
    sure = [x.where(F.col("low") >= least_docs).select("lang", "term") for x in (bounds, low)]
    return sure[0].unionByName(sure[1]).unionByName(found)


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 2) / total), in steps that stay within a long."""
    rest, out = count + 2, F.lit(0).cast("long")
    for _ in range(3):
        scaled = rest * 1000
        out = out * 1000 + _div(scaled, total)
        rest = scaled % total
    return out + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))"""
    return _div((p - q) * (p - q), p + q)


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source).

    Part ``pair``: item is each other source of the language, value the sum of
    divergences over all kept terms, all ranks. Part ``term``: item is each
    kept term that the source has and holds more of than its language, value
    its divergence from the language, up to rank ``top_terms``. Ranks go by
    value descending, then item in UTF-8 order.

    Null text, language and source count as ''. Repeated rows are documents of
    their own. A language without a kept term has pairs of value 0; an empty
    table gives no rows. Other columns are ignored. ``docs`` should be a table
    that is read, not computed by a shuffle, as row numbers are taken from it.
    """
    rows = _source_rows(docs, text, lang, source)
    names = source_names(rows)
    held = materialize(tokenize(count_chunks(rows)), "audit-counts")
    summed = materialize(sum_terms(held), "audit-terms")
    known, _ = broadcast_if_small(names, "source")
    kept = materialize(kept_terms(rows, known, held, summed, least_docs), "audit-kept")
    # occurrences of kept terms per source; terms kept in no language go first
    some, _ = broadcast_if_small(kept.select("term").distinct(), "term")
    by_term = (
        summed.select("g", "term", "c")
        .join(some, "term", "left_semi")
        .join(known, "g")
        .select("lang", "source", "term", "c")
        .join(kept, ["lang", "term"], "left_semi")
    )
    by_term = materialize(by_term, "audit-by-term")
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = by_term.groupBy("lang", "source").agg(F.sum("c").alias("total"))
    groups = (
        names.select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(vocabulary, "lang", "left")
        .select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("total", F.lit(0)).alias("total"))
    )
    d = F.col("total") + 2 * F.col("v")
    none = F.when(d > 0, share(F.lit(0).cast("long"), d))
    groups = materialize(groups.select("lang", "source", "v", "total", d.alias("d"), none.alias("p0")), "audit-groups")
    sizes, _ = broadcast_if_small(groups.select("lang", "source", "d", "p0"), "source")
    rated = by_term.join(sizes, ["lang", "source"]).withColumn("p", share(F.col("c"), F.col("d")))
    rated = materialize(rated.select("lang", "source", "term", "c", "p", "p0"), "audit-shares")
    return _pairs(groups, rated).unionByName(_terms(groups, rated, top_terms))


def _ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(groups: DataFrame, rated: DataFrame) -> DataFrame:
    named = groups.select("lang", "source", "p0", "v")
    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0"))
    pairs = materialize(named.join(other, "lang").where(F.col("source") != F.col("other")), "audit-pairs")
    p, p0, other_p, other_p0 = (F.col(c) for c in ("p", "p0", "other_p", "other_p0"))
    neither = divergence(p0, other_p0)
    base = pairs.select("lang", "source", "other", F.when(F.col("v") > 0, neither * F.col("v")).otherwise(0).alias("part"))
    # terms of one source against none: once per distinct share; the other
    # half of a pair comes from the mirrored row
    shares = rated.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
    single = pairs.join(shares, ["lang", "source"]).select(
        "lang", "source", "other", ((divergence(p, other_p0) - neither) * F.col("terms")).alias("part")
    )
    left = rated.select("lang", "term", "source", "p", "p0")
    right = rated.select("lang", "term", F.col("source").alias("other"), p.alias("other_p"), p0.alias("other_p0"))
    common = (
        left.join(right, ["lang", "term"])
        .where(F.col("source") < F.col("other"))
        .select(
            "lang",
            "source",
            "other",
            (divergence(p, other_p) - divergence(p, other_p0) - divergence(p0, other_p) + neither).alias("part"),
        )
    )
    one_way = single.unionByName(common).groupBy("lang", "source", "other").agg(F.sum("part").alias("part"))
    one_way = materialize(one_way, "audit-one-way")
    mirrored = one_way.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "part")
    parts = base.unionByName(one_way).unionByName(mirrored)
    summed = parts.groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("part").cast("long").alias("value"))
    return _ranked(summed, "pair")


def _terms(groups: DataFrame, rated: DataFrame, top: int) -> DataFrame:
    whole = rated.groupBy("lang", "term").agg(F.sum("c").alias("lang_c"))
    size = groups.groupBy("lang").agg((F.sum("total") + 2 * F.max("v")).alias("lang_d"))
    sizes, _ = broadcast_if_small(materialize(size, "audit-langs"), "lang")
    of_lang = whole.join(sizes, "lang").select("lang", "term", share(F.col("lang_c"), F.col("lang_d")).alias("q"))
    p, q = F.col("p"), F.col("q")
    more = rated.join(of_lang, ["lang", "term"]).where(p > q)
    found = more.select("lang", "source", F.col("term").alias("item"), divergence(p, q).alias("value"))
    return _ranked(found, "term").where(F.col("rank") <= top)
