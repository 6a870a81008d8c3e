"""Dictionary versions as intervals, and as-of matches against them.

A dictionary that is reloaded leaves a series of versions, each valid from a
batch id (or a time) until the next one. As intervals, a word that stays over
many versions is one row. Comments are matched with the version that was valid
at their batch: counts per (word, batch) come first, so the as-of condition is
checked on one row per word and batch, after an equality join on the word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logwise.operators.sizing import BROADCAST_MAX_ROWS, broadcast_if_small
from logwise.operators.words import dictionary_words, word_document_counts


def version_intervals(versions: DataFrame, words: DataFrame) -> DataFrame:
    """(word, valid_from, valid_to): when each word was in the dictionary.

    ``versions`` has the start of every version in ``valid_from``, also of one
    without words; ``words`` has (valid_from, word). An interval holds
    ``valid_from`` and ends before ``valid_to``, which is NULL while the word
    is in the last version. A word that leaves and comes back has two rows.
    Empty and NULL words and words of an unknown version are left out.
    """
    starts = versions.select("valid_from").where(F.col("valid_from").isNotNull()).distinct()
    in_order = Window.orderBy("valid_from")  # one row per reload, not per comment
    numbered = starts.select(
        "valid_from",
        F.row_number().over(in_order).alias("_ordinal"),
        F.lead("valid_from").over(in_order).alias("_next"),
    )
    fits = starts.count() <= BROADCAST_MAX_ROWS
    w = F.col("word")
    held = words.where(w.isNotNull() & (w != "")).select("valid_from", "word").distinct()
    held = held.join(F.broadcast(numbered) if fits else numbered, "valid_from")
    of_word = Window.partitionBy("word").orderBy("_ordinal")
    runs = held.withColumn("_run", F.col("_ordinal") - F.row_number().over(of_word))
    return runs.groupBy("word", "_run").agg(
        F.min("valid_from").alias("valid_from"), F.max_by("_next", "_ordinal").alias("valid_to")
    ).drop("_run")


def valid_at(at: F.Column) -> F.Column:
    """The as-of condition on the columns of :func:`version_intervals`."""
    return (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))


def match_as_of(rows: DataFrame, intervals: DataFrame, at: str) -> DataFrame:
    """Rows (``word`` and ``at`` among their columns) whose word was in the
    dictionary at ``at``. The intervals of a word do not overlap, so a row
    stays one row. Intervals are broadcast only if they measure small."""
    ranges = intervals.select(F.col("word").alias("_word"), "valid_from", "valid_to")
    ranges, _ = broadcast_if_small(ranges, "_word")
    joined = rows.join(ranges, (F.col("word") == F.col("_word")) & valid_at(F.col(at)))
    return joined.select(*rows.columns)


def as_of_word_counts(
    docs: DataFrame,
    intervals: DataFrame,
    at: str,
    text: str = "text",
    method: str = "spaces",
    name: str = "n",
    by: Sequence[str] = (),
) -> DataFrame:
    """``(word, at, by..., n)``: comments per word of the version valid at ``at``.

    Methods as in :func:`word_document_counts`. With ``spaces``, ``terms`` and
    ``substrings`` a word is found whatever else is in the dictionary, so one
    pass counts the words of all versions and the counts are matched as of
    their batch. Maximum matching (``dictionary``) depends on the other words:
    comments are segmented once per version, each version with its own
    comments; the number of versions must then be small enough to plan.
    A comment whose ``at`` is NULL or before the first version has no words.
    """
    if method != "dictionary":
        counts = word_document_counts(docs, dictionary_words(intervals), text, method, name, by=(at, *by))
        return match_as_of(counts, intervals, at)
    edges = intervals.select(F.explode(F.array("valid_from", "valid_to")).alias("e")).where(F.col("e").isNotNull())
    starts = [r["e"] for r in edges.distinct().orderBy("e").collect()]  # one row per change of the dictionary
    parts = []
    for low, high in zip(starts, [*starts[1:], None], strict=False):
        own = docs.where(F.col(at) >= F.lit(low))
        own = own if high is None else own.where(F.col(at) < F.lit(high))
        words = dictionary_words(intervals.where(valid_at(F.lit(low))))
        parts.append(word_document_counts(own, words, text, method, name, by=(at, *by)))
    if not parts:
        return word_document_counts(docs, [], text, "spaces", name, by=(at, *by))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
