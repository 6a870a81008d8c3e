"""Helpers of the operators: written tables and memos of workers."""

import glob

from pyspark.sql import functions as F

from logwise.llm import common


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [f.getPath() for f in manager.localDirs()]
    return {p for d in folders for p in glob.glob(f"{d}/*/shuffle_*")}


def test_shuffle_files_of_a_written_table_go_with_the_write(spark):
    before = shuffle_files(spark)
    table = spark.range(0, 50_000, 1, 4).groupBy((F.col("id") % 997).alias("k")).count()
    kept = spark.conf.get(common.SHUFFLE_CLEANUP)
    written = common.materialize(table, "test-cleanup")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == kept
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, table.collect()))


def test_words_are_forgotten():
    first = common.word_hashes([b"one", b"two"])
    common.forget_words()
    assert not common._HASHES.memo
    assert (common.word_hashes([b"one", b"two"]) == first).all()
