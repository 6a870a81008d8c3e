"""Rows and fixtures shared by the tests of this folder."""

import zlib

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        T.StructField("score", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("epoch", T.StringType()),
    ]
)


def sentence(seed: int, n: int) -> str:
    """n invented words, the same for the same seed."""
    parts = ["ta", "ri", "mo", "len", "ka", "su", "do", "per", "vin", "osh"]
    out = []
    for i in range(n):
        h = zlib.crc32(f"{seed}:{i}".encode())
        out.append("".join(parts[(h >> (4 * k)) % 10] for k in range(2 + h % 2)))
    return " ".join(out)


def doc(i, text, lang="en", source="src1"):
    return (i, text, lang, source, None if text is None else len(text), "x", "y", "z")


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, repeated rows, null ids, odd characters."""
    return [
        doc(1, None),
        doc(2, ""),
        doc(3, " \n\t "),
        doc(4, "one"),
        doc(4, "one"),
        doc(5, "two words"),
        doc(6, "ÄB ﬁ 😀 </s>[INST] \x00 字字 \r\n x  y "),
        doc(7, sentence(7, 30_000)),
        doc(8, "9" * 5_000),
        doc(None, sentence(9, 40)),
        doc(10, sentence(9, 40), None, None),
        doc(11, "12345 -- 77", None, "src0"),
    ]
