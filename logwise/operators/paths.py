"""Segmentation by the most likely path through a lattice of dictionary words.

Every way to cut a text into dictionary words, and single characters where
there is none, is a path; its weight is the sum of the logarithms of the
relative frequencies of its words. The best path is found from right to left:
the best weight from a character on is the largest of a word's weight plus the
best weight after it.

Weights are whole millionths, so sums are exact and ties are defined: of equal
weights the path whose first word is longer, then by the same rule after it.
Texts are cut at characters that no word holds. The paths of a text are found
next to its scan; only words travel, as counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwise.operators.balance import spread
from logwise.operators.counts import count_by
from logwise.operators.sizing import measure
from logwise.operators.words import LISTED_MAX
from logwise.session import ship_package

# Weights per unit of the natural logarithm.
WEIGHT_SCALE = 1_000_000


def word_weights(frequencies: DataFrame) -> tuple[dict[str, int], int]:
    """({word: weight}, weight of a character that is no word) of a frame
    (word, count). Counts of a repeated word add up; empty and NULL words and
    counts below one are left out. An unknown character weighs like a word
    seen once. The frame is collected only after its measurement."""
    w, n = F.col("word"), F.col("count").cast("bigint")
    summed = frequencies.where(w.isNotNull() & (w != "") & (n > 0)).groupBy("word").agg(F.sum(n).alias("count"))
    if not measure(summed).fits(*LISTED_MAX):
        raise ValueError("the dictionary is over the limits of pattern chunks")
    counts = {r["word"]: r["count"] for r in summed.collect()}
    total = sum(counts.values())
    weigh = lambda c: math.floor(math.log(c / total) * WEIGHT_SCALE + 0.5)
    return {w: weigh(c) for w, c in counts.items()}, weigh(1) if total else 0


# Pieces, and beginnings, of which a task remembers what it found.
MEMO = 200_000
# Characters by which the words that start at a character are looked up; longer
# words by twice as many, and so on.
BEGIN = 4


class BestPaths:
    """Dictionary words on the best paths of texts. What was found is
    remembered, at most twice MEMO pieces, those met last."""

    def __init__(self, weights: dict[str, int], unknown: int):
        self.weights, self.unknown = weights, unknown
        self.memo, self.before, self.starts = {}, {}, {}
        held = sorted({c for w in weights for c in w})
        self.runs = re.compile(f"[{''.join(map(re.escape, held))}]+")
        # lengths above k, up to 2 k, of the words behind their first k characters
        longer: dict[str, set[int]] = {}
        for w in weights:
            k = BEGIN
            while k < len(w):
                sizes = longer.setdefault(w[:k], set())
                k *= 2
                if len(w) <= k:
                    sizes.add(len(w))
        self.longer = {b: tuple(sorted(n)) for b, n in longer.items()}

    def __call__(self, text: str) -> list[str]:
        """The words of a text, each once."""
        found: set[str] = set()
        for piece in set(self.runs.findall(text)):
            words = self.memo.get(piece)
            if words is None:
                words = self.before.get(piece)
                if words is None:
                    words = tuple(self.path(piece))
                if len(self.memo) >= MEMO:
                    self.before, self.memo = self.memo, {}
                self.memo[piece] = words
            found.update(words)
        return list(found)

    def start(self, begin: str) -> tuple[int, list[tuple[int, int]]]:
        """What starts with the characters ``begin``: the weight of the first
        one, (length, weight) of longer words."""
        if len(self.starts) >= MEMO:
            self.starts.clear()
        some = [(n, self.weights[begin[:n]]) for n in range(2, len(begin) + 1) if begin[:n] in self.weights]
        out = self.starts[begin] = (self.weights.get(begin[0], self.unknown), some)
        return out

    def path(self, piece: str) -> list[str]:
        """The dictionary words of the best path, in order."""
        n, weights, starts, longer = len(piece), self.weights, self.starts, self.longer
        sums, sizes = [0] * (n + 1), [1] * n
        for i in range(n - 1, -1, -1):
            begin = piece[i : i + BEGIN]
            one, some = starts.get(begin) or self.start(begin)
            best = one + sums[i + 1]
            for size, weight in some:
                if weight + sums[i + size] >= best:
                    best, sizes[i] = weight + sums[i + size], size
            k = BEGIN
            while i + k < n and (known := longer.get(begin)) is not None:
                for size in known:
                    if i + size > n:
                        break
                    weight = weights.get(piece[i : i + size])
                    if weight is not None and weight + sums[i + size] >= best:
                        best, sizes[i] = weight + sums[i + size], size
                k *= 2
                begin = piece[i : i + k]
            sums[i] = best
        words, i = [], 0
        while i < n:
            word = piece[i : i + sizes[i]]
            if word in weights:
                words.append(word)
            i += sizes[i]
        return words


def best_path_counts(
    docs: DataFrame,
    frequencies: DataFrame,
    key: Sequence[str],
    text: str = "text",
    name: str = "n",
    by: Sequence[str] = (),
) -> DataFrame:
    """``(word, by..., n)``: comments with each dictionary word on their best path.

    ``frequencies`` has (word, count); ``key`` names the columns that identify
    a comment. A comment counts once per word. NULL and empty texts have no
    words; an empty dictionary gives no rows.
    """
    weights, unknown = word_weights(frequencies)
    if not weights:
        nothing = docs.select(*by, F.lit(None).cast("string").alias("word")).where(F.lit(False))
        return count_by(nothing, "word", *by, name=name)
    spark = docs.sparkSession
    ship_package(spark)
    known = spark.sparkContext.broadcast((weights, unknown))  # within the limits checked by word_weights

    @F.pandas_udf("array<string>")
    def words(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        paths = BestPaths(*known.value)
        for batch in texts:
            yield batch.map(lambda t: paths(t) if isinstance(t, str) else [])

    own = list(dict.fromkeys((*key, *by)))
    narrow = docs.select(*own, F.col(text).alias("_text"))
    found = spread(narrow, key[0] if key else None).select(*own, words("_text").alias("_words"))
    # outer, as a filter on the size of the array would run the function twice
    each = found.select(*own, F.explode_outer("_words").alias("word")).where(F.col("word").isNotNull())
    if not count_by(narrow, *own, name="_rows").where(F.col("_rows") > 1).isEmpty():
        each = each.distinct()  # several rows of one comment
    return count_by(each, "word", *by, name=name)
