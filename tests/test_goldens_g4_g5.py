"""Goldens G4 (dictionary shape: 10 one-character, 15 two-character and one
seven-character word) and G5 (shape of the monthly count tables)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from logwise.operators import word_document_counts
from logwise.sinks import contributions, monthly_totals, write_contributions
from conftest import rows

# A pool of CJK characters built by rule (a block of the unified ideographs).
POOL = [chr(0x4E00 + 37 * i % 2000) for i in range(60)]


def _corpus(n_docs=300, seed=4):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(POOL) for _ in range(rnd.randint(0, 120))) for _ in range(n_docs)]


def _g4_dictionary(texts, seed=9):
    """26 distinct words with the G4 length profile, cut out of the corpus."""
    rnd = random.Random(seed)
    long_texts = [t for t in texts if len(t) >= 7]
    words = set(rnd.sample(POOL, 10))
    while len([w for w in words if len(w) == 2]) < 15:
        t = rnd.choice(long_texts)
        i = rnd.randrange(len(t) - 1)
        words.add(t[i : i + 2])
    t = rnd.choice(long_texts)
    words.add(t[:7])
    words = sorted(words)
    assert len(words) == 26 and sorted(len(w) for w in words) == [1] * 10 + [2] * 15 + [7]
    return words


def test_g4_dictionary_all_substring_plans_agree(spark):
    texts = _corpus()
    words = _g4_dictionary(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    want = sorted((w, sum(1 for t in texts if w in t)) for w in words if any(w in t for t in texts))
    for plan in ("contains", "ngrams"):
        assert rows(word_document_counts(docs, words, method="substrings", plan=plan)) == want, plan
    assert rows(word_document_counts(docs, frame, method="substrings")) == want
    # forward maximum matching: the longest word at each position, no overlap
    fmm = rows(word_document_counts(docs, words, method="dictionary"))
    assert fmm == rows(word_document_counts(docs, frame, method="dictionary", plan="join"))
    def segment(t):
        out, i = set(), 0
        by_len = sorted(words, key=len, reverse=True)
        while i < len(t):
            w = next((w for w in by_len if t.startswith(w, i)), None)
            if w:
                out.add(w)
                i += len(w)
            else:
                i += 1
        return out
    segs = [segment(t) for t in texts]
    assert fmm == sorted((w, sum(1 for s in segs if w in s)) for w in words if any(w in s for s in segs))


def test_g5_monthly_table_shape(spark, tmp):
    days = [dt.date(2018, 8, 5), dt.date(2018, 8, 19), dt.date(2018, 11, 18)]
    batches = [
        [("狗", days[0], 40), ("酒", days[0], 24), ("狼", days[1], 83)],
        [("狗", days[0], 4), ("狗", days[1], 61), ("书籍", days[2], 1)],
        [("狗", days[2], 16), ("酒", days[1], 37)],
    ]
    for i, b in enumerate(batches):
        df = spark.createDataFrame(b, "word string, date date, count long")
        write_contributions(contributions(df, i), f"{tmp}/ledger")
    totals = monthly_totals(spark, f"{tmp}/ledger")
    keys = totals.groupBy("word", "date").count()
    assert keys.where("count > 1").count() == 0  # (word, date) unique
    got = {(r.month, r.word, r.date): r["count"] for r in totals.collect()}
    assert got[("201808", "狗", days[0])] == 44
    assert {m for m, _, d in got if d.month == 8} == {"201808"}
    assert {m for m, _, d in got if d.month == 11} == {"201811"}
    assert len([k for k in got if k[0] == "201808"]) == 5 and len([k for k in got if k[0] == "201811"]) == 2
