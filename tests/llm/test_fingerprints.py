"""SimHash and block tables against brute force."""

import hashlib
import math
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from llm_cases import doc, docs_of, odd_rows, sentence  # noqa: F401
from logwise.llm import fingerprints as fp

M = (1 << 64) - 1


def long_hash(x, seed):
    return xxhash.xxh64_intdigest(struct.pack("<Q", x & M), seed=seed)


def simhash(text):
    words = [p for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) for p in re.findall(r"(?s).{1,24}", w)]
    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]
    shingles = []
    for i in range(len(hashes)):
        h = 42
        for x in hashes[max(0, i - 4) : i + 1]:
            h = long_hash(x, h)
        shingles.append(h)
    terms = [(h, 1) for h in set(hashes)] + [(h, 2) for h in set(shingles)]
    total = sum(w for _, w in terms)
    return sum(1 << j for j in range(64) if 2 * sum(w for h, w in terms if h >> j & 1) > total)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(rows):
    known = sorted({(i is None, i or 0, hashlib.sha256(f"{'null' if i is None else i}:{t or ''}".encode()).digest(), t or "")
                    for i, t in rows})
    prints = [simhash(t) for *_, t in known]
    out = []
    for at, (none, i, _, text) in enumerate(known):
        after = (at + 1) % len(known)
        n = len(text) // 4
        edited = text[: len(text) - n] + known[after][3][:n]
        like = lambda a, b: max(0.0, math.cos(math.pi * (a ^ b).bit_count() / 64))
        near = sum((p ^ prints[at]).bit_count() <= fp.RADIUS for p in prints) - 1
        out.append(
            (
                None if none else i,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                f"{prints[at]:016x}",
                f"{simhash(edited):016x}",
                round(like(prints[at], simhash(edited)), 12),
                round(like(prints[at], prints[after]), 12),
                near if not none and i % 100 == 0 else None,
            )
        )
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def cases(odd_rows):
    base = sentence(1, 300)
    words = base.split()
    rows = [doc(100 * k, " ".join(words[:50] + [f"new{k}"] + words[51:])) for k in range(2, 30)]  # near copies
    rows += [doc(100 * k + 1, base) for k in range(2, 10)]  # exact copies
    rows += [doc(5000 + k, sentence(k, 5 + k)) for k in range(20)] + [doc(6000, "字" * 333), doc(6001, "é" * 100)]
    return rows + odd_rows


def test_documents_equal_brute_force(docs_of, odd_rows):
    rows = cases(odd_rows)
    assert got(fp.compare_edited(docs_of(rows))) == brute([r[:2] for r in rows])


def test_one_document_and_empty_tables(docs_of):
    assert got(fp.compare_edited(docs_of([doc(100, "a b c d e")]))) == brute([(100, "a b c d e")])
    assert fp.compare_edited(docs_of([])).count() == 0


def test_likeness_separates_edited_from_next(docs_of):
    rows = [doc(i, sentence(i, 150)) for i in range(60)]
    for r in fp.compare_edited(docs_of(rows)).collect():
        assert r["near_edited"] > 0.4 and r["near_edited"] > r["near_next"]


@pytest.mark.parametrize("radius,blocks,page", [(3, 6, 256), (3, 6, 4), (0, 2, 8), (5, 7, 8)])
def test_block_tables_find_all_within_radius(spark, monkeypatch, radius, blocks, page):
    monkeypatch.setattr(fp, "PAGE", page)
    rnd = random.Random(radius * 10 + page)
    base = [rnd.getrandbits(64) for _ in range(60)]
    prints = list(base)
    for x in base[:6]:  # crowded places
        for _ in range(40):
            prints.append(x ^ sum({1 << rnd.randrange(64) for _ in range(rnd.randrange(7))}))
    rows = [(signed(x), 1) for x in prints] + [(None, 1)]
    index = spark.createDataFrame(rows, "fp long, n long")
    queries = index.where(F.pmod("fp", F.lit(3)) == 0).select("fp")
    want = {}
    counts = {}
    for x in prints:
        counts[x] = counts.get(x, 0) + 1
    for q in {x for x in counts if signed(x) % 3 == 0}:
        for x, n in counts.items():
            if (q ^ x).bit_count() <= radius:
                want[signed(q), signed(x)] = ((q ^ x).bit_count(), n)
    found = fp.near_fingerprints(index, queries, radius, blocks).collect()
    assert len(found) == len(want)
    assert {(r["fp"], r["near"]): (r["distance"], r["n"]) for r in found} == want
    totals = {}
    for (q, _), (_, n) in want.items():
        totals[q] = totals.get(q, 0) + n
    assert {r["fp"]: r["n"] for r in fp.near_fingerprints(index, queries, radius, blocks, count_only=True).collect()} == totals


def test_main_path_is_native(docs_of):
    df = fp.compare_edited(docs_of([doc(1, "a b c"), doc(2, "d e")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
