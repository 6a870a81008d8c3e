"""Corpus pipeline: every stage against a brute-force version on its input."""

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from conftest import SF_SMALL
from llm_cases import doc, docs_of, odd_rows  # noqa: F401
from test_joins import brute_jaccard, families, passage_rows

import corpus_pipeline
from logwise.llm import mixing, stages
from logwise.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_WEIGHTS, domain_of
from logwise.schemas import DOCUMENTS
from pyspark.sql import functions as F

LIB = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "ngram-jaccard", "passages", "mixture", "sentencepiece"]


def test_language_stage_keeps_clean_documents(spark, docs_of, odd_rows):  # noqa: F811
    docs = spark.read.schema(DOCUMENTS).parquet(f"{SF_SMALL}/documents.parquet")
    kept = stages.known_language(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    ids = {r["doc_id"]: r for r in kept.collect()}
    every = docs.collect()
    assert len(ids) >= len(every) - 1
    assert all(ids[r["doc_id"]] == r for r in every if r["doc_id"] in ids)
    more = [doc(100 + i, "the cat and the dog", "en") for i in range(8)] + [doc(200, "the dog and the cat", None)]
    out = {r["doc_id"]: r["lang"] for r in stages.known_language(spark, docs_of(odd_rows + more), "").collect()}
    assert not {1, 2, 3, 8, 11} & set(out) and out[200] == "en"


def test_one_document_of_each_group_stays(spark, docs_of, odd_rows):  # noqa: F811
    rows = families(3) + odd_rows
    kept = stages.one_of_each_group(spark, docs_of(rows), "")
    got = Counter(r["doc_id"] for r in kept.collect())
    want = {i for i, _, c in brute_jaccard(rows) if i == c}
    assert set(got) == want | {None} and max(got.values()) == 1


def test_repeats_are_cut_and_the_rest_stays(spark, docs_of):  # noqa: F811
    rows, shared, line = passage_rows()
    out = {r["doc_id"]: r for r in stages.without_repeats(spark, docs_of(rows), "").collect()}
    assert set(out) == {r[0] for r in rows}
    for i, text, *_ in rows:
        assert out[i]["n_chars"] == len(out[i]["text"])
        if i in (20, *range(10, 20)):
            assert out[i]["text"] == text
    middle = " ".join(shared.split()[30:60])
    assert [i for i in out if middle in out[i]["text"]] == [20]
    assert sum(out[i]["text"].count(line) for i in out) == 1


def test_mixture_repeats_whole_documents_by_epoch(spark):
    docs = spark.read.schema(DOCUMENTS).parquet(f"{SF_SMALL}/documents.parquet")
    out = stages.mixed(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    plan = mixing.mix(docs, domain_of(F.col("source")), MIX_WEIGHTS, max_epochs=MIX_EPOCHS, seed=MIX_SEED)
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(r["doc_id"] for r in plan.collect())
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert all(rows[r["doc_id"]] == r for r in out.collect())


def test_run_is_all_stages_and_encodes_what_is_left(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), DOCUMENTS)
    want = Counter()
    for r in docs.collect():
        ids = LIB.encode(r["text"])
        want[(r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), tuple(ids))] += 1
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], tuple(r["ids"])) for r in got) == want


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
