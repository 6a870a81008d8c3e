"""Budgets and token-prefixes against a plain implementation."""

import hashlib

from llm_cases import doc, docs_of, odd_rows, sentence  # noqa: F401
from pyspark.sql import functions as F

from logwise.llm import mixing
from logwise.llm.queries import domain_of


def plain_fill(total, children):
    """children: {name: (cap, weight)} -> budgets by repeated redistribution."""
    out, open_ = {}, {k: v for k, v in children.items() if v[1] > 0}
    while open_:
        level = total / sum(w for _, w in open_.values())
        full = {k: c for k, (c, w) in open_.items() if c <= level * w}
        if not full:
            return out | {k: min(c, int(level * w)) for k, (c, w) in open_.items()}
        k = min(full, key=lambda x: (children[x][0] / children[x][1], x))
        out[k] = full[k]
        total -= full[k]
        del open_[k]
    return out


def test_shortages_go_to_siblings_before_ancestors(spark):
    rows = [("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "1", 500), ("b", "x", "1", 100), ("b", "z", "9", 5)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    weights = {"domain": {"a": 3, "b": 1}, "lang": {"x": 2}, "source": {}}
    got = {tuple(r)[:3]: r["budget"] for r in mixing.leaf_budgets(leaves, ["domain", "lang", "source"], weights, 600, 1).collect()}
    top = plain_fill(600, {"a": (1510, 3), "b": (105, 1)})
    assert top == {"b": 105, "a": 495}  # b is short, its ancestor's sibling gets the rest
    ax = plain_fill(top["a"], {"x": (1010, 2), "y": (500, 1)})
    x1 = plain_fill(ax["x"], {"1": (10, 1), "2": (1000, 1)})
    assert x1["1"] == 10 and x1["2"] == ax["x"] - 10  # source 1 is short, its sibling fills up
    assert got[("a", "x", "1")] == 10 and got[("a", "x", "2")] == x1["2"] and got[("a", "y", "1")] == ax["y"]
    assert got[("b", "x", "1")] == 100 and got[("b", "z", "9")] == 5


def test_prefixes_fill_budgets_in_key_order(docs_of):  # noqa: F811
    rows = [doc(i, sentence(i, 5 + i % 9), "en" if i % 3 else "de", f"src{i % 4}") for i in range(300)]
    df = docs_of(rows)
    weights = {"domain": {"web": 1}, "lang": {"de": 3}, "source": {"src0": 5}}
    got = mixing.mix(df, domain_of(F.col("source")), weights, target=4000, max_epochs=3, seed=9).collect()
    leaves = {}
    for r in rows:
        leaves.setdefault((r[2], r[3]), []).append(r)
    size = {k: sum(len(r[1].split()) for r in v) for k, v in leaves.items()}
    langs = plain_fill(4000, {"en": (3 * sum(n for (g, _), n in size.items() if g == "en"), 1), "de": (3 * sum(n for (g, _), n in size.items() if g == "de"), 3)})
    want = set()
    for lang, total in langs.items():
        inner = plain_fill(total, {s: (3 * n, 5 if s == "src0" else 1) for (g, s), n in size.items() if g == lang})
        for s, budget in inner.items():
            whole, rest = divmod(budget, size[(lang, s)])
            key = lambda r: hashlib.md5(f"9:{whole}:{r[0]}".encode()).hexdigest()  # noqa: E731, B023
            used = 0
            for r in sorted(leaves[(lang, s)], key=key):
                used += len(r[1].split())
                want |= {(r[0], e) for e in range(whole + (used <= rest))}
    assert {(r["doc_id"], r["epoch"]) for r in got} == want and len(got) == len(want)
    assert sum(r["n_tokens"] for r in got) <= 4000


def test_odd_rows_and_whole_rows(docs_of, odd_rows):  # noqa: F811
    df = docs_of(odd_rows)
    weights = {"domain": {}, "lang": {}, "source": {}}
    out = mixing.mix(df, domain_of(F.col("source")), weights, max_epochs=2)
    assert {r["lang"] for r in out.collect()} <= {"en", ""}
    whole = mixing.mix(df, domain_of(F.col("source")), weights, max_epochs=2, whole_rows=True)
    assert whole.columns == df.columns
    assert whole.where("doc_id = 4").count() % 2 == 0  # repeated rows are taken together
    assert mixing.mix(docs_of([]), domain_of(F.col("source")), weights).count() == 0
    assert mixing.mix(docs_of([doc(1, None)]), domain_of(F.col("source")), weights).count() == 0
