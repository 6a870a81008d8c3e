"""A key that holds a third of all rows: results stay exact and every shuffle
of a count carries partial aggregates, not raw rows."""

from pyspark.sql import functions as F

from logwise.operators import count_by, sliding_counts, total_snapshots, word_document_counts
from conftest import rows


def _hot_events(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    # every third event becomes the same level: one hot key with a third of the rows
    return ev.withColumn(
        "event_type", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("event_type"))
    )


def _partial_before_every_exchange(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and "REPARTITION" not in line:
            below = "\n".join(lines[i + 1 : i + 3])
            assert "HashAggregate" in below and "partial_" in below, plan
    return plan


def test_hot_key_counts_are_exact_and_partially_aggregated(spark):
    ev = _hot_events(spark)
    n = ev.count()
    totals = count_by(ev, "event_type")
    _partial_before_every_exchange(totals)
    got = {r.event_type: r.n for r in totals.collect()}
    assert sum(got.values()) == n and got["hot"] == ev.where("event_id % 3 = 0").count()

    w = sliding_counts(ev, "ts", "event_type", "4 hours", "2 hours")
    _partial_before_every_exchange(w)
    assert w.agg(F.sum("n")).first()[0] == 2 * n


def test_hot_key_snapshots_match_plain_totals(spark):
    ev = _hot_events(spark).select("event_type", F.to_date("ts").alias("batch"))
    snaps = total_snapshots(ev, "event_type", "batch", block=4)  # many blocks for the hot key
    last = snaps.groupBy("event_type").agg(F.max_by("total", "batch").alias("n"))
    assert rows(last) == rows(count_by(ev, "event_type"))


def test_hot_word_document_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # "the" occurs in most English documents: the hot word
    counts = word_document_counts(docs, ["the", "und", "la"])
    _partial_before_every_exchange(counts)
    want = docs.where(F.array_contains(F.split("text", " "), "the")).count()
    assert {r.word: r.n for r in counts.collect()}["the"] == want


def test_spread_is_a_no_op_on_wide_scans(spark, tmp):
    from logwise.operators import spread

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs.repartition(16).write.parquet(f"{tmp}/wide")
    wide = spark.read.parquet(f"{tmp}/wide")
    slots = spark.sparkContext.defaultParallelism
    assert wide.rdd.getNumPartitions() >= slots
    plan = spread(wide, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan
    narrow = spread(docs.coalesce(1), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in narrow
