"""Comments x dictionary -> how many comments contain each dictionary word.

A comment counts at most once per word (its tokens form a set), so the result
is a document frequency. Four ways to find words in a comment:

* ``spaces``      tokens separated by spaces, exact equality with a word;
* ``dictionary``  forward maximum matching against the dictionary;
* ``substrings``  every occurrence as a substring (overlaps allowed);
* ``terms``       the set of terms that a segmentation service answered.

Words on the most likely path through a comment are in
:mod:`logwise.operators.paths`.

A dictionary is either a Python list (a literal that travels with the plan) or
a DataFrame with a ``word`` column. A DataFrame dictionary is measured first:
below the broadcast limits it is broadcast and filters the tokens before the
aggregation; above them the tokens are aggregated per word first (partial
aggregation absorbs hot words) and only then joined on the word, so no task
ever holds the rows of one hot word.

Every method gives one answer at every dictionary size; sizes only choose how
Spark finds it. All plans are built from Spark's own expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwise.functions.text import (
    contained_words,
    ngram_pattern,
    runs_pattern,
    segment_dictionary,
    segment_spaces,
)
from logwise.operators.counts import count_by
from logwise.operators.hits import (
    CHUNK_MAX_BYTES,
    CHUNK_MAX_WORDS,
    MAX_CHUNKS,
    longest_words,
    pattern_chunks,
    words_inside,
)
from logwise.operators.sizing import Size, broadcast_if_small, measure
from logwise.session import checkpoint_root

Dictionary = Sequence[str] | DataFrame

# Up to this size a dictionary is folded into one regex; beyond it, into a
# regex per chunk; beyond MAX_CHUNKS, candidate substrings are joined with it.
# All give the same words.
PATTERN_MAX_WORDS = 5_000
PATTERN_MAX_BYTES = 128 * 1024
# Half of what the chunks can hold, as chunks are filled to one of their limits.
LISTED_MAX = (CHUNK_MAX_WORDS * MAX_CHUNKS // 2, CHUNK_MAX_BYTES * MAX_CHUNKS // 2)
# Up to this many literal words, one ``contains`` per word.
CONTAINS_MAX_WORDS = 8
# Characters of a word by which candidate substrings are filtered before a
# join: as many as keep the beginnings of all words within these limits.
PREFIXES = (64, 8, 5, 3)
PREFIX_MAX = 5_000


def _is_frame(d: Dictionary) -> bool:
    return isinstance(d, DataFrame)


def dictionary_words(dictionary: DataFrame, column: str = "word") -> DataFrame:
    """Distinct non-empty words of a dictionary frame as column ``word``."""
    return _clean(dictionary.select(F.col(column).alias("word"))).distinct()


def _clean(dictionary: Dictionary) -> Dictionary:
    """Frames keep non-empty, non-NULL words (duplicates are harmless in a semi join)."""
    if not _is_frame(dictionary):
        return dictionary
    w = F.col("word")
    return dictionary.select("word").where(w.isNotNull() & (w != ""))


def _as_frame(dictionary: Dictionary, docs: DataFrame) -> DataFrame:
    if _is_frame(dictionary):
        return dictionary
    return docs.sparkSession.createDataFrame([(w,) for w in sorted({w for w in dictionary if w})], "word string")


def _token_set(text: Column) -> Column:
    return F.array_distinct(segment_spaces(text))


def _count_joined(
    tokens: DataFrame,
    dictionary: DataFrame,
    size: Size | None,
    name: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """tokens(word, by...) x dictionary(word) -> (word, by..., n).

    Broadcast (filter, then aggregate) only when the dictionary measured small;
    otherwise aggregate first and join the per-word counts.
    """
    small, is_small = broadcast_if_small(dictionary, "word", size)
    if is_small:
        return count_by(tokens.join(small, "word", "left_semi"), "word", *by, name=name)
    return count_by(tokens, "word", *by, name=name).join(small, "word", "left_semi")


def match_words(
    docs: DataFrame,
    dictionary: Dictionary,
    text: str = "text",
    keep: Sequence[str] = (),
    size: Size | None = None,
) -> DataFrame:
    """One row per (comment, dictionary word among its space tokens).

    Rows stay per comment, so a dictionary too large to broadcast means a
    shuffle join on the word; Spark's adaptive skew-join handling splits the
    partition of a hot word. For counts use :func:`word_document_counts`,
    which aggregates before that join.
    """
    return _match_sets(docs, _token_set(F.col(text)), dictionary, keep, size)


def _match_sets(
    docs: DataFrame, tokens: Column, dictionary: Dictionary, keep: Sequence[str], size: Size | None
) -> DataFrame:
    dictionary = _clean(dictionary)
    if not _is_frame(dictionary):
        words = F.array(*[F.lit(w) for w in sorted(set(dictionary))])
        return docs.select(*keep, F.explode(F.array_intersect(tokens, words)).alias("word"))
    small, _ = broadcast_if_small(dictionary, "word", size)
    return docs.select(*keep, F.explode(tokens).alias("word")).join(small, "word", "left_semi")


def word_document_counts(
    docs: DataFrame,
    dictionary: Dictionary,
    text: str = "text",
    method: str = "spaces",
    name: str = "n",
    size: Size | None = None,
    by: Sequence[str] = (),
    plan: str = "auto",
    key: Sequence[str] = (),
) -> DataFrame:
    """``(word, by..., n)``: number of comments that contain each dictionary word.

    ``by`` adds grouping columns (for example the date of the comment).
    ``size`` is a measurement of a frame dictionary taken earlier (for example
    by :class:`logwise.sources.dictionary.RefreshingDictionary`); it saves one
    aggregate. ``plan`` forces how words are found: ``pattern``, ``chunks``,
    ``join`` or ``pieces`` for forward maximum matching, ``contains``, ``pattern``,
    ``chunks`` or ``ngrams`` for substrings; ``auto`` chooses by size. With
    method ``terms``, ``text`` names an array column of terms. ``key`` names
    columns that identify a comment; plan ``join`` gathers the words of a
    comment by them (without them, and in plan ``pieces``, by row numbers,
    which need an input whose rows come in the same order if a task is
    repeated).
    """
    t = F.col(text)
    dictionary = _clean(dictionary)
    if not _is_frame(dictionary) and not any(dictionary):
        # an empty dictionary matches nothing (same result type, no job)
        nothing = docs.select(*by, F.lit(None).cast("string").alias("word")).where(F.lit(False))
        return count_by(nothing, "word", *by, name=name)
    if method in ("spaces", "terms"):
        tokens = _token_set(t) if method == "spaces" else F.array_distinct(t)
        if not _is_frame(dictionary):
            return count_by(_match_sets(docs, tokens, dictionary, by, size), "word", *by, name=name)
        return _count_joined(docs.select(*by, F.explode(tokens).alias("word")), dictionary, size, name, by)

    if method == "dictionary":
        if _is_frame(dictionary) and size is None:
            size = measure(dictionary)
        if plan == "pieces" or (plan == "auto" and not docs.isStreaming and not _one_pattern(dictionary, size)):
            return _counts_by_piece(docs, _as_frame(dictionary, docs), t, size, name, by)
        found = _longest_words(docs, dictionary, t, size, by, plan, key)
        return count_by(found, "word", *by, name=name)

    if method == "substrings":
        if plan not in ("auto", "contains", "pattern", "chunks", "ngrams"):
            raise ValueError(f"unknown plan {plan!r}")
        words = None if plan == "ngrams" else _listed(dictionary, size, plan)
        if words is not None:
            if not words:
                return word_document_counts(docs, [], text, method, name, by=by)
            if plan == "contains" or (plan == "auto" and len(words) <= CONTAINS_MAX_WORDS):
                found = docs.select(*by, F.explode(contained_words(t, words)).alias("word"))
            else:
                chunks = [sorted(set(words))] if plan == "pattern" else pattern_chunks(words)
                found = words_inside(docs, t, chunks, by)
            return count_by(found, "word", *by, name=name)
        if plan in ("contains", "pattern", "chunks"):
            raise ValueError("the dictionary is over the pattern limits; use plan 'ngrams'")
        return _substring_counts_by_ngrams(docs, _as_frame(dictionary, docs), t, size, name, by)

    raise ValueError(f"unknown method {method!r}")


def bucketed_word_counts(
    docs: DataFrame,
    dictionary: DataFrame,
    buckets: int,
    text: str = "text",
    name: str = "n",
    by: Sequence[str] = (),
) -> DataFrame:
    """:func:`word_document_counts` of space tokens with a dictionary stored in
    ``buckets`` (:func:`logwise.sources.dictionary.store_buckets`).

    Tokens are counted per word first; the counts, one row a word, are dealt
    to the buckets and merged with them. Nothing of the dictionary is
    broadcast, shuffled or sorted, so its size costs a read of its buckets only.
    """
    tokens = docs.select(*by, F.explode(_token_set(F.col(text))).alias("word"))
    counts = count_by(tokens, "word", *by, name=name).repartition(buckets, "word")
    return counts.join(dictionary.select("word").hint("merge"), "word", "left_semi")


def _listed(dictionary: Dictionary, size: Size | None, plan: str = "auto") -> list[str] | None:
    """The words as a sorted list if they are within the limits of one pattern
    (plan ``pattern``) or of the chunks of a plan; a frame is collected only
    after its measurement."""
    rows, octets = (PATTERN_MAX_WORDS, PATTERN_MAX_BYTES) if plan == "pattern" else LISTED_MAX
    if not _is_frame(dictionary):
        words = sorted({w for w in dictionary if w})
        fits = Size(len(words), sum(len(w.encode()) for w in words)).fits(rows, octets)
        return words if fits else None
    s = size if size is not None else measure(dictionary)
    if not s.fits(rows, octets):
        return None
    return sorted({r["word"] for r in dictionary.select("word").collect()})


def _one_pattern(dictionary: Dictionary, size: Size | None) -> bool:
    """Whether a dictionary, a frame with its size, is within the limits of one chunk."""
    return size.fits(CHUNK_MAX_WORDS, CHUNK_MAX_BYTES) if _is_frame(dictionary) else len(pattern_chunks(dictionary)) <= 1


def _counts_by_piece(
    docs: DataFrame, dictionary: DataFrame, text: Column, size: Size | None, name: str, by: Sequence[str]
) -> DataFrame:
    """Counts of forward maximum matching with a dictionary of many patterns.

    No word goes over a character that no word holds, so texts are cut there.
    A piece that is a word itself has no longer word at its start and is all
    that matching finds in it: such pieces are counted and joined with the
    dictionary. Each distinct other piece is matched once, and its words are
    joined back to the texts; only words that both kinds of pieces give are
    gathered per text before they are counted.
    """
    checkpoint_root(docs.sparkSession)
    words = dictionary.distinct().checkpoint(eager=True)
    held = words.select(F.explode(F.split("word", "")).alias("c")).where(F.col("c") != "").distinct().collect()
    if not held:
        return word_document_counts(docs, [], name=name, by=by)
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(runs_pattern(r["c"] for r in held)), F.lit(0)))
    counts = count_by(docs.select(F.explode(runs).alias("word"), *by), "word", *by, name=name).checkpoint(eager=True)
    whole = counts.join(words, "word", "left_semi")
    others = counts.select("word").distinct().join(words, "word", "left_anti").withColumnRenamed("word", "_piece")
    others = others.checkpoint(eager=True)
    if others.isEmpty():
        return whole
    parts = _longest_words(others, words, F.col("_piece"), size, ("_piece",), "auto", ("_piece",)).checkpoint(eager=True)
    shared = parts.select("word").distinct()
    given, _ = broadcast_if_small(parts.unionByName(shared.select(F.col("word").alias("_piece"), "word")), "_piece")
    # row numbers come straight from the texts: a repeated task gives the same
    numbered = docs.select(*by, F.monotonically_increasing_id().alias("_row"), runs.alias("_runs"))
    rows = numbered.select("_row", *by, F.explode("_runs").alias("_piece"))
    both = rows.join(given, "_piece").select("_row", *by, "word").distinct()
    shared, _ = broadcast_if_small(shared, "word")
    return whole.join(shared, "word", "left_anti").unionByName(count_by(both, "word", *by, name=name))


def _longest_words(
    docs: DataFrame, dictionary: Dictionary, text: Column, size: Size | None, by: Sequence[str], plan: str,
    key: Sequence[str] = (),
) -> DataFrame:
    """(by..., word), once per comment and word, of forward maximum matching:
    left to right the longest word that starts at a position, no overlaps.

    ``pattern``: one regex. ``chunks``: a regex per chunk, then one of the words
    that they found in the comment. ``join``, for a dictionary of any size: the substrings of every word length at every position, semi-joined with the
    dictionary; the longest per position; then the pick from left to right
    inside each comment.
    """
    if plan not in ("auto", "pattern", "chunks", "join"):
        raise ValueError(f"unknown plan {plan!r}")
    words = None if plan == "join" else _listed(dictionary, size, plan)
    if words is None and plan in ("pattern", "chunks"):
        raise ValueError("the dictionary is over the pattern limits; use plan 'join'")
    if words is not None:
        if not words:
            return docs.select(*by, F.lit(None).cast("string").alias("word")).where(F.lit(False))
        chunks = pattern_chunks(words)
        if plan == "pattern" or (plan == "auto" and len(chunks) == 1):
            return docs.select(*by, F.explode(F.array_distinct(segment_dictionary(text, words))).alias("word"))
        return longest_words(docs, text, chunks, by)
    frame = _as_frame(dictionary, docs)
    small, is_small = broadcast_if_small(frame, "word", size)
    row = F.struct(*key) if key else F.monotonically_increasing_id()
    rows = docs.select(*by, text.alias("_text"), row.alias("_row"))
    grams = _grams_by_length(rows, _word_lengths(frame), [*by, "_row"], positions=True)
    if not is_small:
        short = PREFIXES[-1]
        begins, few = broadcast_if_small(frame.select(F.substring("word", 1, short).alias("word")).distinct(), "word")
        if few:
            begins = begins.withColumnRenamed("word", "_begin")
            grams = grams.join(begins, F.substring("word", 1, short) == F.col("_begin"), "left_semi")
    hits = grams.join(small, "word", "left_semi")
    longest = hits.groupBy("_row", "_pos", *by).agg(F.max_by("word", F.char_length("word")).alias("word"))
    spots = longest.groupBy("_row", *by).agg(F.array_sort(F.collect_list(F.struct("_pos", "word"))).alias("_spots"))
    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("words"))
    picked = F.aggregate(
        "_spots",
        start,
        lambda acc, s: F.when(
            s["_pos"] >= acc["next"],
            F.struct(
                (s["_pos"] + F.char_length(s["word"])).alias("next"),
                F.when(F.array_contains(acc["words"], s["word"]), acc["words"])
                .otherwise(F.concat(acc["words"], F.array(s["word"])))
                .alias("words"),
            ),
        ).otherwise(acc),
    )
    return spots.select(*by, F.explode(picked["words"]).alias("word"))


def _word_lengths(dictionary: DataFrame) -> list[int]:
    """Distinct word lengths (at most the length of the longest word)."""
    rows = dictionary.select(F.char_length("word").alias("n")).distinct().collect()
    return sorted(r["n"] for r in rows)


def _grams_by_length(
    rows: DataFrame,
    lengths: Sequence[int],
    keep: Sequence[str],
    prefixes: dict[int, list[str]] | None = None,
    positions: bool = False,
) -> DataFrame:
    """(keep..., [_pos,] word): the substrings of the given lengths of
    ``_text``. Lengths are exploded first, so an array holds the substrings of
    one length only: all of them with their positions, or the distinct ones
    that start with a prefix of a word of that length."""
    if not lengths:
        nothing = rows.select(*keep, F.lit(0).alias("_pos"), F.lit(None).cast("string").alias("word")).where(F.lit(False))
        return nothing if positions else nothing.drop("_pos")
    patterns = [F.lit(ngram_pattern(n, (prefixes or {}).get(n, ()))) for n in lengths]
    each = rows.select(*keep, "_text", F.explode(F.array(*patterns)).alias("_pattern"))
    grams = F.regexp_extract_all(F.col("_text"), F.col("_pattern"), F.lit(1))
    if positions:
        return each.select(*keep, F.posexplode(grams).alias("_pos", "word"))
    return each.select(*keep, F.explode(F.array_distinct(grams)).alias("word"))


def _substring_counts_by_ngrams(
    docs: DataFrame,
    dictionary: DataFrame,
    text: Column,
    size: Size | None,
    name: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Substring containment for a dictionary of any size.

    The candidates of a comment are its distinct n-grams for every word length
    n, one length at a time, that begin like a word of that length. The
    beginnings are measured; the longest that fit are part of the pattern.
    N-grams are aggregated and joined with the dictionary; beyond the
    broadcast limits the counts are joined, not the n-grams.
    """
    prefixes = _beginnings(dictionary)
    lengths = sorted(prefixes) if prefixes else _word_lengths(dictionary)
    rows = docs.select(*by, text.alias("_text"))
    return _count_joined(_grams_by_length(rows, lengths, by, prefixes), dictionary, size, name, by)


def _beginnings(dictionary: DataFrame) -> dict[int, list[str]] | None:
    """{word length: beginnings of its words}, as long as the pattern limits
    allow; None if even the shortest are too many."""
    for k in PREFIXES:
        rows = dictionary.select(F.char_length("word").alias("n"), F.substring("word", 1, k).alias("p")).distinct()
        if measure(rows, "p").fits(PREFIX_MAX, PATTERN_MAX_BYTES):  # two numbers; collected only then
            out: dict[int, list[str]] = {}
            for r in rows.collect():
                out.setdefault(r["n"], []).append(r["p"])
            return out
    return None
