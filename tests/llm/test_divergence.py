"""The divergence audit against plain loops."""

import re

import pytest

from llm_cases import doc, docs_of, odd_rows, sentence  # noqa: F401
from logwise.llm import divergence


def brute(rows, least, top):
    docs = []
    for _, text, lang, source, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        docs.append((lang or "", source or "", re.findall(divergence.TERM, low)))
    out = []
    for lang in {d[0] for d in docs}:
        held, count = {}, {}
        for one, source, terms in docs:
            if one == lang:
                count.setdefault(source, {})
                for t in set(terms):
                    held[t] = held.get(t, 0) + 1
                for t in terms:
                    count[source][t] = count[source].get(t, 0) + 1
        kept = sorted((t for t, n in held.items() if n >= least), key=lambda t: t.encode())
        whole = {t: sum(c.get(t, 0) for c in count.values()) for t in kept}

        def shares(c, kept=kept):
            n = sum(c.get(t, 0) for t in kept)
            return {t: 1 + 10**9 * (c.get(t, 0) + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in count.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in count if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[s].get(t) and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(found[:most], 1)]
    return sorted(out)


def cases(odd_rows):
    words = sentence(1, 60).split()
    rows = []
    for i in range(120):
        text = sentence(i % 25, 30) + f" {words[i % 60]}, ({words[i * 7 % 60]}) " + words[i % 9].upper() + "\n" + words[i % 5] + "-x"
        rows.append(doc(i, text, ["en", "de", None][i % 3], [f"src{i % 7}", None, "src1"][i % 3]))
    rows += [doc(500, "", "en", "bare"), doc(501, None, "en", "none"), doc(502, "1 2 3", "fr", "s"), doc(503, "a", "fr", "t")]
    # only rare chunks of a term that is frequent over all of them
    rows += [doc(600 + i, f"rare{'!' * i} rare{'?' * i}", "es", f"src{i % 2}") for i in range(12)]
    return rows + odd_rows


@pytest.mark.parametrize("least,top", [(10, 10), (3, 2), (1, 10), (1000, 10)])
def test_audit_equals_brute_force(docs_of, odd_rows, least, top):
    rows = cases(odd_rows)
    found = divergence.audit(docs_of(rows), least_docs=least, top_terms=top)
    assert sorted(map(tuple, found.collect())) == brute(rows, least, top)


def test_empty_table(docs_of):
    assert divergence.audit(docs_of([])).count() == 0


def test_shares_stay_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    pairs = [(0, 2), (10**13, 10**13 + 7), (9 * 10**15 - 2, 9 * 10**15 + 10**9), (1, 9 * 10**14)]
    df = spark.createDataFrame(pairs, "c long, d long")
    got = [r[0] for r in df.select(divergence.share(F.col("c"), F.col("d"))).collect()]
    assert got == [1 + 10**9 * (c + 2) // d for c, d in pairs]


@pytest.mark.parametrize("asked,kinds", [(0, 600_000), (500_000, 7)])
def test_limits_of_tasks_change_no_row(docs_of, odd_rows, monkeypatch, asked, kinds):
    monkeypatch.setattr(divergence, "OPEN_CHUNKS", asked)
    monkeypatch.setattr(divergence, "TALLY_CHUNKS", kinds)
    rows = cases(odd_rows)
    assert sorted(map(tuple, divergence.audit(docs_of(rows)).collect())) == brute(rows, 10, 10)


def test_task_counts_documents_and_occurrences_of_a_source(docs_of):
    rows = [doc(i, "One\x0btwo two\x85 two", "en", f"src{i % 2}") for i in range(6)]
    counted = divergence.count_chunks(divergence._source_rows(docs_of(rows), "text", "lang", "source")).collect()
    each = [("One", 3, 3), ("two", 3, 6), ("two\x85", 3, 3)]
    assert sorted((r["chunk"], r["docs"], r["n"]) for r in counted) == sorted(2 * each)
    one_task = divergence._source_rows(docs_of(rows).coalesce(1), "text", "lang", "source")
    plan = divergence.count_chunks(one_task)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_terms_of_counted_chunks_need_no_join(spark):
    rows = [(1, "A-b-a,", 2, 3), (2, "a", 4, 5), (1, "12;", 1, 1), (1, "Éa", 1, 1)]
    counted = spark.createDataFrame(rows, "g long, chunk string, docs long, n long")
    held = divergence.tokenize(counted)
    want = [(1, "A-b-a,", "a", 2, 6), (1, "A-b-a,", "b", 2, 3), (1, "Éa", "Éa", 1, 1), (2, "a", "a", 4, 5)]
    assert sorted(tuple(r[c] for c in ("g", "chunk", "term", "docs", "c")) for r in held.collect()) == want
    plan = held._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan
