"""Dictionary matching: golden G2, document frequency, plan equivalence."""

import random

import pytest
from pyspark.sql import functions as F

from logwise.functions import dictionary_pattern, ngrams, segment_dictionary
from logwise.operators import Size, dictionary_words, word_document_counts
from logwise.plans import comment_word_counts
from conftest import rows

G2_TEXT = "今天是星期天,今天天气是不错"
G2_WORDS = ["今天", "星期天"]


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("method", ["dictionary", "substrings"])
def test_g2_each_word_once_per_comment(spark, method):
    got = rows(word_document_counts(_docs(spark, [G2_TEXT]), G2_WORDS, method=method))
    assert got == [("今天", 1), ("星期天", 1)]


def test_g2_spaces_needs_separated_tokens(spark):
    assert word_document_counts(_docs(spark, [G2_TEXT]), G2_WORDS).count() == 0
    spaced = "今天 是 星期天 , 今天 天气 是 不错"
    assert rows(word_document_counts(_docs(spark, [spaced]), G2_WORDS)) == [("今天", 1), ("星期天", 1)]


def test_document_frequency_not_occurrences(spark):
    docs = _docs(spark, ["a a a b", "a c", "", None, "b b"])
    got = rows(word_document_counts(docs.where(F.length("text") > 0), ["a", "b", "z"]))
    assert got == [("a", 2), ("b", 2)]


def test_empty_and_null_comments_have_no_words(spark):
    comments = spark.createDataFrame([("",), (None,), ("x y",)], "value string")
    got = rows(comment_word_counts(comments, ["x", "y", ""]))
    assert got == [("x", 1), ("y", 1)]


def test_frame_dictionary_broadcast_and_shuffle_paths_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = dictionary_words(
        spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select(
            F.explode(F.split("text", " ")).alias("word")
        )
    )
    small = rows(word_document_counts(docs, words))
    huge = Size(10**12, 10**15)  # pretend the dictionary is too large to broadcast
    big = rows(word_document_counts(docs, words, size=huge))
    assert small == big and len(small) > 10


def test_shuffle_path_has_no_broadcast(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = spark.createDataFrame([("the",), ("und",)], "word string")
    plan = word_document_counts(docs, words, size=Size(10**12, 10**15))._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
    plan_small = word_document_counts(docs, words)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan_small


def test_substring_plans_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    words = dictionary_words(bench.select(F.explode(F.split("text", " ")).alias("word"))).where(
        F.length("word") <= 4
    )
    word_list = [r.word for r in words.collect()]
    n = rows(word_document_counts(docs, words, method="substrings", plan="ngrams"))
    c = rows(word_document_counts(docs, word_list, method="substrings", plan="contains"))
    assert c == rows(word_document_counts(docs, words, method="substrings", plan="pattern"))
    huge = Size(10**12, 10**15)
    u = rows(word_document_counts(docs, words, method="substrings", size=huge))  # auto -> ngrams, shuffle join
    assert n == c == u and len(n) > 10


def test_overlapping_substrings_all_count(spark):
    got = rows(word_document_counts(_docs(spark, ["theme"]), ["the", "hem", "them", "x"], method="substrings"))
    assert got == [("hem", 1), ("the", 1), ("them", 1)]


def test_forward_maximum_matching_longest_first(spark):
    df = _docs(spark, ["nation station"])
    got = df.select(segment_dictionary("text", ["tion", "ation", "on", "nat"]).alias("w")).first().w
    # left to right, the longest word starting at each position, no overlaps:
    # "nat" at 0, then "on" at 4 ("ion" is not a word), then "ation" in "station"
    assert got == ["nat", "on", "ation"]
    assert dictionary_pattern(["a.b", "ab"]) == "(a(?:\\.b|b))"


def _maximum_matching(text, words):
    """Plain forward maximum matching: the distinct words taken."""
    found, at = set(), 0
    while at < len(text):
        best = max((w for w in words if text.startswith(w, at)), key=len, default="")
        if best:
            found.add(best)
        at += len(best) or 1
    return found


def test_known_case_of_nested_words(spark):
    docs, words = _docs(spark, ["bda"]), ["a", "aab", "add", "b", "daaa"]
    for plan in ("pattern", "join"):
        assert rows(word_document_counts(docs, words, method="dictionary", plan=plan)) == [("a", 1), ("b", 1)]


def test_every_plan_of_maximum_matching_gives_one_answer(spark):
    """Thousands of random small-alphabet dictionaries and texts: the pattern
    by Java's matcher, and the join plan on a frame of all of them."""
    rnd = random.Random(11)
    draw = lambda n: "".join(rnd.choice(["a", "b", "d", "😀"]) for _ in range(n))
    cases = []
    for _ in range(2500):
        words = sorted({draw(rnd.randint(1, 4)) for _ in range(rnd.randint(1, 9))})
        cases.append((draw(rnd.randint(0, 14)), words, dictionary_pattern(words)))
    df = spark.createDataFrame(cases, "text string, words array<string>, pattern string")
    got = df.select("text", "words", F.regexp_extract_all("text", F.col("pattern"), F.lit(1)).alias("found")).collect()
    for text, words, found in got:
        assert set(found) == _maximum_matching(text, words), (text, words)
    for _ in range(12):
        words = sorted({draw(rnd.randint(1, 4)) for _ in range(rnd.randint(1, 9))})
        texts = [draw(rnd.randint(0, 14)) for _ in range(60)]
        want = {}
        for t in texts:
            for w in _maximum_matching(t, words):
                want[w] = want.get(w, 0) + 1
        docs = _docs(spark, texts)
        frame = spark.createDataFrame([(w,) for w in words], "word string")
        for dictionary, plan, size in ((words, "pattern", None), (words, "join", None), (frame, "auto", Size(10**9, 10**12))):
            assert dict(rows(word_document_counts(docs, dictionary, method="dictionary", plan=plan, size=size))) == want


def test_dictionary_method_has_no_size_limit(spark):
    words = [f"w{i}x" for i in range(30_000)] + ["cat", "cats"]
    docs = _docs(spark, ["cats w29999x", "cat w7x w7x"])
    want = [("cat", 1), ("cats", 1), ("w29999x", 1), ("w7x", 1)]
    assert rows(word_document_counts(docs, words, method="dictionary")) == want
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    assert rows(word_document_counts(docs, frame, method="dictionary")) == want
    assert rows(word_document_counts(docs, frame, method="dictionary", size=Size(10**12, 10**15))) == want


def test_ngrams_beside_characters_of_two_code_units(spark):
    df = _docs(spark, ["😀b", "a😀😀", ""])
    got = {r.text: (r.one, r.two) for r in df.select("text", ngrams("text", 1).alias("one"), ngrams("text", 2).alias("two")).collect()}
    assert got == {"😀b": (["😀", "b"], ["😀b"]), "a😀😀": (["a", "😀", "😀"], ["a😀", "😀😀"]), "": ([], [])}
    words = spark.createDataFrame([("?b",), ("😀b",), ("😀",)], "word string")
    assert rows(word_document_counts(df, words, method="substrings")) == [("😀", 2), ("😀b", 1)]


def test_every_plan_of_substrings_gives_one_answer(spark):
    rnd = random.Random(12)
    draw = lambda n: "".join(rnd.choice(["a", "b", "😀"]) for _ in range(n))
    for _ in range(10):
        words = sorted({draw(rnd.randint(1, 4)) for _ in range(rnd.randint(1, 14))})
        texts = [draw(rnd.randint(0, 12)) for _ in range(50)]
        want = {w: n for w in words if (n := sum(w in t for t in texts))}
        docs = _docs(spark, texts)
        frame = spark.createDataFrame([(w,) for w in words], "word string")
        for dictionary, plan in ((words, "contains"), (words, "pattern"), (words, "ngrams"), (frame, "auto"), (frame, "ngrams")):
            assert dict(rows(word_document_counts(docs, dictionary, method="substrings", plan=plan))) == want, plan


def test_terms_of_a_service(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["b"],), ([],), (None,)], "terms array<string>")
    words = spark.createDataFrame([("a",), ("b",), ("c",)], "word string")
    for d in (words, ["a", "b", "c"]):
        assert rows(word_document_counts(df, d, text="terms", method="terms")) == [("a", 1), ("b", 2)]


def test_frame_dictionary_with_empty_and_null_words(spark):
    docs = _docs(spark, ["ab cd", "cd"])
    words = spark.createDataFrame([("cd",), ("",), (None,), ("cd",)], "word string")
    for method, plan in [("spaces", "auto"), ("substrings", "ngrams"), ("substrings", "pattern"), ("substrings", "contains"), ("dictionary", "auto"), ("dictionary", "join")]:
        assert rows(word_document_counts(docs, words, method=method, plan=plan)) == [("cd", 2)]


def test_chunked_plans_give_one_answer(spark, monkeypatch):
    from logwise.operators import hits

    rnd = random.Random(13)
    draw = lambda n: "".join(rnd.choice(["a", "b", "\\", "E", "😀"]) for _ in range(n))
    monkeypatch.setattr(hits, "CHUNK_MAX_WORDS", 3)
    for _ in range(6):
        words = sorted({draw(rnd.randint(1, 4)) for _ in range(rnd.randint(4, 20))})
        texts = [draw(rnd.randint(0, 14)) for _ in range(60)] + [None]
        inside = {w: n for w in words if (n := sum(w in t for t in texts if t))}
        longest = {}
        for t in texts:
            for w in _maximum_matching(t or "", words):
                longest[w] = longest.get(w, 0) + 1
        docs = _docs(spark, texts)
        assert dict(rows(word_document_counts(docs, words, method="substrings", plan="chunks"))) == inside
        assert dict(rows(word_document_counts(docs, words, method="dictionary", plan="chunks"))) == longest
        frame = spark.createDataFrame([(w,) for w in words], "word string")
        assert dict(rows(word_document_counts(docs, frame, method="dictionary", plan="chunks"))) == longest
        keyed = docs.withColumn("id", F.monotonically_increasing_id())
        assert dict(rows(word_document_counts(keyed, frame, method="dictionary", plan="join", key=("id",)))) == longest


def test_substrings_need_no_shuffle_of_texts(spark):
    docs, words = _docs(spark, ["abc ab", "bc"]), ["a", "ab", "abc", "b", "bc", "c", "d", "e", "f", "g"]
    plan = word_document_counts(docs, words, method="substrings")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(word") == 1 and plan.count("Exchange hashpartitioning") == 1


def _best_path(text, weights, unknown):
    """Largest (sum, lengths of the words in order) over all paths."""
    best = None
    stack = [(0, 0, (), ())]
    while stack:
        at, total, lengths, words = stack.pop()
        if at == len(text):
            if best is None or (total, lengths) > best[:2]:
                best = (total, lengths, words)
            continue
        for n in range(1, len(text) - at + 1):
            w = text[at : at + n]
            if w in weights:
                stack.append((at + n, total + weights[w], (*lengths, n), (*words, w)))
            elif n == 1:
                stack.append((at + 1, total + unknown, (*lengths, 1), words))
    return set(best[2])


def test_best_paths_equal_all_paths_tried(spark):
    from logwise.operators.paths import best_path_counts, word_weights

    rnd = random.Random(14)
    for alphabet in (["a", "b"], ["a", "b", "]", "😀", " "]):
        draw = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))  # noqa: B023, E731
        for _ in range(4):
            counts = [(draw(rnd.randint(1, 4)), rnd.randint(1, 3)) for _ in range(rnd.randint(1, 9))]
            frame = spark.createDataFrame([*counts, ("", 5), (None, 5), ("zz", 0)], "word string, count long")
            weights, unknown = word_weights(frame)
            texts = [draw(rnd.randint(0, 11)) + rnd.choice(["", "-", "x y"]) for _ in range(40)] + [None]
            want = {}
            for t in texts:
                for w in _best_path(t or "", weights, unknown):
                    want[w] = want.get(w, 0) + 1
            docs = _docs(spark, texts).withColumn("id", F.monotonically_increasing_id())
            assert dict(rows(best_path_counts(docs, frame, ("id",)))) == want
    nothing = spark.createDataFrame([], "word string, count long")
    assert best_path_counts(docs, nothing, ("id",)).count() == 0


def test_pieces_give_what_maximum_matching_finds(spark, monkeypatch):
    from logwise.operators import words as module

    rnd = random.Random(15)
    draw = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    for limit in ((2, 20), (10_000, 100_000)):  # other pieces by substrings, by patterns
        monkeypatch.setattr(module, "LISTED_MAX", limit)
        for letters in (["a", "b", "]"], ["a", "b", "\\", "😀", "ü"]):
            words = sorted({draw(letters, rnd.randint(1, 4)) for _ in range(9)})
            texts = [draw([*letters, " ", "-"], rnd.randint(0, 14)) for _ in range(60)] + [None, words[0], words[0]]
            want = {}
            for t in texts:
                for w in _maximum_matching(t or "", words):
                    want[w] = want.get(w, 0) + 1
            frame = spark.createDataFrame([(w,) for w in [*words, words[0], "", None]], "word string")
            docs = _docs(spark, texts).withColumn("half", F.col("doc_id") % 2)
            assert dict(rows(word_document_counts(docs, frame, method="dictionary", plan="pieces"))) == want
            halves = rows(word_document_counts(docs, words, method="dictionary", plan="pieces", by=("half",)))
            by_half = rows(word_document_counts(docs, words, method="dictionary", plan="pattern", by=("half",)))
            assert halves == by_half
    nothing = spark.createDataFrame([], "word string")
    assert word_document_counts(docs, nothing, method="dictionary", plan="pieces").count() == 0


def test_words_of_the_texts_need_no_substrings(spark, monkeypatch):
    from logwise.operators import words as module

    monkeypatch.setattr(module, "CHUNK_MAX_WORDS", 2)
    monkeypatch.setattr(module, "LISTED_MAX", (2, 10))
    monkeypatch.setattr(module, "_grams_by_length", None)  # the substrings of every length at every position
    docs = _docs(spark, ["ab abc b", "abc  abc d", "ab", None])
    words = docs.select(F.explode(F.split("text", " ")).alias("word"))
    found = word_document_counts(docs, words, method="dictionary", key=("doc_id",))
    assert rows(found) == [("ab", 2), ("abc", 2), ("b", 1), ("d", 1)]


def test_runs_of_many_characters():
    import re

    from logwise.functions.text import MAX_RANGES, runs_pattern

    held = [chr(0x4E00 + 3 * i) for i in range(500)] + list("a-]^\\ ")
    body = re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), runs_pattern(held))
    assert body.count("-") <= MAX_RANGES + 2
    assert all(re.fullmatch(body, c) for c in held) and not re.search(body, "bc_\t")


def test_best_paths_run_once_next_to_the_scan(spark):
    from logwise.operators.paths import best_path_counts

    frame = spark.createDataFrame([("a", 2), ("ab", 1)], "word string, count long")
    docs = spark.createDataFrame([(1, "ab a"), (1, "a"), (None, "ab"), (None, "ab"), (2**53 + 1, "ab"), (2**53, "ab")], "id long, text string")
    found = best_path_counts(docs, frame, ("id",))
    assert rows(found) == [("a", 1), ("ab", 4)]  # rows of one key are one comment
    plan = best_path_counts(docs.where("id > 1"), frame, ("id",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") == 1 and "Join" not in plan and "collect_list" not in plan
    assert plan.count("ArrowEvalPython [words") == 1


def test_best_paths_of_long_words():
    from logwise.operators.paths import BestPaths

    rnd = random.Random(16)
    draw = lambda n: "".join(rnd.choice("ab") for _ in range(n))
    for _ in range(60):
        text = draw(rnd.randint(15, 45))
        cuts = [(i, rnd.choice([1, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33])) for i in range(0, len(text), 4)]
        weights = {text[i : i + n]: -rnd.randint(1, 9) for i, n in cuts} | {"ab": -9, draw(6): -2}
        paths = BestPaths(weights, -12)
        best = {0: ((0, ()), ())}  # by characters left: (sum, lengths) of the best path and its words
        for left in range(1, len(text) + 1):
            at = len(text) - left
            options = []
            for n in range(1, left + 1):
                w = text[at : at + n]
                (total, lengths), after = best[left - n]
                if w in weights or n == 1:
                    options.append(((weights.get(w, -12) + total, (n, *lengths)), ((w,) if w in weights else ()) + after))
            best[left] = max(options)
        assert tuple(paths.path(text)) == best[len(text)][1]
