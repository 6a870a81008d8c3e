"""Dictionary words at the characters of a text, for dictionaries of many regexes.

A dictionary is cut into chunks of sorted words, each within the limits of one
prefix-tree pattern, and each text meets each chunk once. At a character a
pattern finds the longest word of its chunk; the other words that start there
are beginnings of it, so a closure table (word -> its beginnings in the
dictionary) gives them. Rows follow texts x chunks and words found, never
characters x word lengths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwise.functions.text import CHARACTER, trie_pattern

# Limits of one pattern, and of the patterns of one plan (they travel with it).
CHUNK_MAX_WORDS = 60_000
CHUNK_MAX_BYTES = 768 * 1024
MAX_CHUNKS = 24


def pattern_chunks(words: Sequence[str]) -> list[list[str]]:
    """Sorted distinct words cut into chunks within the limits of a pattern."""
    chunks: list[list[str]] = []
    size = 0
    for w in sorted({w for w in words if w}):
        n = len(w.encode())
        if not chunks or len(chunks[-1]) >= CHUNK_MAX_WORDS or (size + n > CHUNK_MAX_BYTES and chunks[-1]):
            chunks.append([])
            size = 0
        chunks[-1].append(w)
        size += n
    return chunks


def beginnings(words: Sequence[str]) -> list[tuple[str, list[str]]]:
    """(word, the words that it begins with, itself last) of sorted words."""
    out, open_words = [], []
    for w in words:
        while open_words and not w.startswith(open_words[-1]):
            open_words.pop()
        open_words.append(w)
        out.append((w, list(open_words)))
    return out


def closure(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """(_hit, _words): :func:`beginnings` as a table."""
    return spark.createDataFrame(beginnings(words), "_hit string, _words array<string>")


def words_inside(docs: DataFrame, text: Column, chunks: Sequence[Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """(by..., word): each word of the dictionary that occurs in a text, once
    per text, overlaps included. No shuffle.

    The distinct hits of a chunk are sorted, so the texts of one beginning
    stand together: a beginning is new where the hit before does not have it.
    """
    found = [
        F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(f"{CHARACTER}(?=({trie_pattern(c)}))"), 1)))
        for c in chunks
    ]
    each = docs.select(*by, F.explode(F.array(*found)).alias("_hits")).where(F.size("_hits") > 0)
    before = F.concat(F.array(F.lit("")), F.slice(F.col("_hits"), F.lit(1), F.size("_hits") - 1))
    hits = each.select(*by, F.inline(F.arrays_zip(F.col("_hits"), before)).alias("_hit", "_before"))
    # every chunk has a closure of its own: words of other chunks are found by theirs
    table = docs.sparkSession.createDataFrame(
        [row for c in chunks for row in beginnings(c)], "_hit string, _words array<string>"
    )
    words = hits.join(F.broadcast(table), "_hit").select(*by, "_before", F.explode("_words").alias("word"))
    return words.where(~F.startswith("_before", "word")).select(*by, "word")


def longest_at(text: Column, chunks: Sequence[Sequence[str]]) -> Column:
    """Array over the characters of a text: the longest word that starts
    there, or ''."""

    def aligned(words: Sequence[str]) -> Column:
        return F.regexp_extract_all(text, F.lit(f"(?s)(?=((?:{trie_pattern(words)})?))."), 1)

    out = aligned(chunks[0])
    for c in chunks[1:]:
        out = F.zip_with(out, aligned(c), lambda a, b: F.when(F.char_length(b) > F.char_length(a), b).otherwise(a))
    return out


def longest_words(docs: DataFrame, text: Column, chunks: Sequence[Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """(by..., word): words of forward maximum matching, once per text.

    The chunks first give the words that are the longest of their chunk at
    some character. The longest of the whole dictionary is always among them,
    so a pattern of these few words, longer ones first, finds what the whole
    dictionary would. No shuffle and no row key: all within the row.
    """
    found = [F.array_distinct(F.regexp_extract_all(text, F.lit(f"{CHARACTER}(?=({trie_pattern(c)}))"), 1)) for c in chunks]
    each = docs.select(*by, text.alias("_text"), F.explode(F.array(F.flatten(F.array(*found)))).alias("_hits"))
    sized = F.array_sort(F.transform("_hits", lambda w: F.struct((-F.char_length(w)).alias("n"), w.alias("w"))))
    quoted = F.transform(sized, lambda s: F.concat(F.lit(r"\Q"), F.replace(s["w"], F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
    pattern = F.concat(F.lit("("), F.array_join(quoted, "|"), F.lit(")"))
    own = each.where(F.size("_hits") > 0).select(*by, "_text", F.explode(F.array(pattern)).alias("_pattern"))
    words = F.regexp_extract_all(F.col("_text"), F.col("_pattern"), F.lit(1))
    return own.select(*by, F.explode(F.array_distinct(words)).alias("word"))
