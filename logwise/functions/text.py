"""Column expressions for splitting lines and segmenting comments.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen next to the scan; none needs Python on the executors.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from logwise.settings import NGRAM


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(value: str | Column, sep: str = "\t") -> Column:
    """Split a line like Java's ``String.split(sep)``.

    Java drops trailing empty fields ("a\\tb\\t" -> [a, b]); Spark's ``split``
    keeps them. Removing the trailing separators first gives Java's result;
    an empty or separator-only line becomes ``[""]``.
    """
    sep_re = re.escape(sep)
    return F.split(F.regexp_replace(_col(value), f"(?:{sep_re})+$", ""), sep_re)


def segment_spaces(text: str | Column) -> Column:
    """Tokens separated by one space; empty tokens removed, duplicates kept.

    ``array_remove`` keeps the step in generated code (a lambda ``filter``
    would be interpreted element by element)."""
    return F.array_remove(F.split(_col(text), " "), "")


def distinct_tokens(tokens: Column) -> Column:
    """The set of tokens of one comment (multiplicity dropped)."""
    return F.array_distinct(tokens)


def trie_pattern(words: Iterable[str]) -> str:
    """A regex for the longest of ``words`` that starts at a position.

    The words are folded into a prefix tree: every branch starts with another
    character, and a word that is a prefix of longer ones is followed by them
    as a greedy option. Where a node has many branches, a look-ahead on the
    next character halves them. So the cost at a position follows the length
    of the match and the logarithm of the branches, not the number of words.
    """
    unique = sorted({w for w in words if w})
    if not unique:
        raise ValueError("dictionary is empty")

    def fold(tails: list[str]) -> str:
        """Pattern of sorted distinct tails; an empty tail comes first."""
        ends = tails[0] == ""
        branches, heads = [], []
        for head, group in itertools.groupby(tails[1:] if ends else tails, key=lambda t: t[0]):
            rest = list(group)
            shared = len(os.path.commonprefix(rest))
            heads.append(head)
            branches.append(re.escape(rest[0][:shared]) + (fold([t[shared:] for t in rest]) if len(rest) > 1 else ""))
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and not ends else f"(?:{choose(branches, heads)})"
        return body + "?" if ends else body

    def choose(branches: list[str], heads: list[str]) -> str:
        if len(branches) <= 4:
            return "|".join(branches)
        half = len(branches) // 2
        first = "".join(re.escape(h) if not h.isspace() else h for h in heads[:half])
        left = choose(branches[:half], heads[:half])
        return f"(?=[{first}])(?:{left})|{choose(branches[half:], heads[half:])}"

    return fold(unique)


def dictionary_pattern(words: Iterable[str]) -> str:
    """One group holding the longest word at a position: scanned left to right
    without overlaps this is forward maximum matching."""
    return f"({trie_pattern(words)})"


def segment_dictionary(text: str | Column, words: Iterable[str]) -> Column:
    """Dictionary words found by forward maximum matching, in text order."""
    return F.regexp_extract_all(_col(text), F.lit(dictionary_pattern(words)), 1)


# Start of a character: not between the two halves of one beyond the BMP.
CHARACTER = r"(?s)(?![\uDC00-\uDFFF])"


# Ranges of a class of characters beyond Latin-1.
MAX_RANGES = 64


def runs_pattern(characters: Iterable[str]) -> str:
    """Regex of the longest runs of ``characters``. Where they make too many
    ranges, those nearest to each other are joined with what lies between, so
    a run may hold other characters too; what it leaves out is never one of
    them."""
    points = sorted({ord(c) for c in characters})
    if not points:
        raise ValueError("no characters")
    ranges: list[list[int]] = []
    for p in points:
        if p > 0xFF and ranges and ranges[-1][1] == p - 1 > 0xFF:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    gaps = sorted(b[0] - a[1] for a, b in itertools.pairwise(ranges) if a[0] > 0xFF)
    if len(gaps) > MAX_RANGES:
        widest, joined = gaps[-MAX_RANGES], []
        for r in ranges:
            if joined and joined[-1][0] > 0xFF and r[0] - joined[-1][1] < widest:
                joined[-1][1] = r[1]
            else:
                joined.append(r)
        ranges = joined
    body = "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)
    return f"[{body}]+"


def ngram_pattern(n: int, prefixes: Iterable[str] = ()) -> str:
    """Regex of n-character substrings at every character, overlaps included
    (a zero-width look-ahead); only those that start with one of ``prefixes``
    if any are given."""
    if n < 1:
        raise ValueError("n must be positive")
    prefixes = list(prefixes)
    only = f"(?={trie_pattern(prefixes)})" if prefixes else ""
    return f"{CHARACTER}{only}(?=(.{{{n}}}))"


def ngrams(text: str | Column, n: int = NGRAM) -> Column:
    """All overlapping n-character substrings in order, in one regex pass."""
    return F.regexp_extract_all(_col(text), F.lit(ngram_pattern(n)), 1)


def contained_words(text: str | Column, words: Iterable[str]) -> Column:
    """The words of a small literal list that occur anywhere in the text."""
    unique = sorted({w for w in words if w})
    if not unique:
        raise ValueError("dictionary is empty")
    t = _col(text)
    return F.filter(F.array(*[F.lit(w) for w in unique]), lambda w: F.contains(t, w))


def collapse_whitespace(text: str | Column) -> Column:
    """Runs of ASCII white space to one space, ends trimmed."""
    return F.trim(F.regexp_replace(_col(text), r"[\t\n\x0B\f\r ]+", " "))
