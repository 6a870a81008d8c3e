"""Calls to a segmentation service, in batches, with retries.

The service is a user-supplied ``fetch(texts) -> [(code, body), ...]``, one
answer per text in order. Spark spreads the rows over tasks and hands them
over in Arrow batches (``mapInPandas``). Only the text and the columns asked
for go to Python; the text does not come back. An exception is retried, any
answer is final, as a non-200 code is.
"""

from __future__ import annotations

import logging
import queue
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwise.operators.sizing import broadcast_if_small
from logwise.session import ship_package
from logwise.sources.storage import is_folder

log = logging.getLogger(__name__)

Fetch = Callable[[list[str]], list[tuple[int, str]]]

# Fixed value: a call slower than this many milliseconds is logged as slow.
SLOW_CALL_MS = 20

ANSWER_FIELDS = [
    T.StructField("code", T.IntegerType(), True),
    T.StructField("body", T.StringType(), True),
    T.StructField("attempts", T.IntegerType(), True),
    T.StructField("error", T.StringType(), True),
    T.StructField("elapsed_ms", T.IntegerType(), True),
]

Answer = tuple[int | None, str | None, int, str | None]


def call_with_retry(fetch: Fetch, texts: list[str], attempts: int) -> list[Answer]:
    """(code, body, attempts used, last error) of each text.

    A failed call of several texts says nothing about any one of them: they
    are then sent one by one. The joint call counts, so no text is sent more
    than ``attempts`` times; with a single attempt texts are sent one by one.
    """
    if len(texts) > 1 and attempts > 1:
        try:
            return [(int(code), body, 1, None) for code, body in _answers(fetch, texts)]
        except Exception as exc:  # noqa: BLE001 - any failure is retried
            joint = f"{type(exc).__name__}: {exc}"
        return [_alone(fetch, t, attempts, 1, joint) for t in texts]
    return [_alone(fetch, t, attempts, 0, None) for t in texts]


def _alone(fetch: Fetch, text: str, attempts: int, used: int, error: str | None) -> Answer:
    """One text sent by itself, after ``used`` sends with others."""
    for n in range(used + 1, attempts + 1):
        try:
            code, body = _answers(fetch, [text])[0]
            return int(code), body, n, None
        except Exception as exc:  # noqa: BLE001
            error = f"{type(exc).__name__}: {exc}"
    return None, None, attempts, error


def with_time_limit(fetch: Fetch, seconds: float) -> Fetch:
    """``fetch`` that fails after ``seconds`` without an answer. The call
    itself is left to end in a thread of its own."""

    def call(texts: list[str]) -> list[tuple[int, str]]:
        said: queue.Queue = queue.Queue(1)

        def run() -> None:
            try:
                said.put((True, fetch(texts)))
            except Exception as exc:  # noqa: BLE001 - raised again by the caller
                said.put((False, exc))

        threading.Thread(target=run, daemon=True).start()
        try:
            good, value = said.get(timeout=seconds)
        except queue.Empty:
            raise TimeoutError(f"no answer in {seconds} s") from None
        if not good:
            raise value
        return value

    return call


def _answers(fetch: Fetch, texts: list[str]) -> list[tuple[int, str]]:
    got = list(fetch(texts))
    if len(got) != len(texts):
        raise ValueError(f"{len(got)} answers to {len(texts)} texts")
    return got


def enrich_with_retry(
    df: DataFrame,
    fetch: Fetch,
    column: str = "value",
    keep: Sequence[str] = (),
    attempts: int = 3,
    batch: int = 32,
    concurrency: int = 1,
    time_limit: float | None = None,
) -> DataFrame:
    """``keep..., code, body, attempts, error, elapsed_ms``: the answers to
    ``column``, ``batch`` texts a call.

    Empty or NULL values are not sent (they have no words); they get a NULL
    code and 0 attempts. ``elapsed_ms`` covers all attempts of the call that
    held the row; calls slower than ``SLOW_CALL_MS`` are logged by the
    executor. A task has up to ``concurrency`` calls open at once; a call
    without an answer after ``time_limit`` seconds has failed. Rows without an answer stay in the result, with their error;
    see :func:`logwise.operators.responses.failed_answers`.
    """
    if attempts < 1 or batch < 1 or concurrency < 1:
        raise ValueError("attempts, batch and concurrency must be at least 1")
    call = fetch if time_limit is None else with_time_limit(fetch, time_limit)
    sent = df.select(*keep, df[column].alias("_text"))
    schema = T.StructType([f for f in sent.schema.fields if f.name != "_text"] + ANSWER_FIELDS)
    ship_package(df.sparkSession)

    def timed(texts: list[str]) -> tuple[list[Answer], int]:
        t0 = time.perf_counter()
        answers = call_with_retry(call, texts, attempts)
        ms = int((time.perf_counter() - t0) * 1000)
        if ms > SLOW_CALL_MS:
            log.warning("slow call: %d ms, %d text(s)", ms, len(texts))
        return answers, ms

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            results: list[tuple] = [(None, None, 0, None, None)] * len(pdf)
            full = [i for i, v in enumerate(pdf["_text"]) if isinstance(v, str) and v]
            groups = [full[lo : lo + batch] for lo in range(0, len(full), batch)]
            texts = [[pdf["_text"].iloc[i] for i in at] for at in groups]
            if concurrency == 1:
                done = map(timed, texts)
            else:
                with ThreadPoolExecutor(concurrency) as pool:
                    done = list(pool.map(timed, texts))
            for at, (answers, ms) in zip(groups, done, strict=True):
                for i, r in zip(at, answers, strict=True):
                    results[i] = (*r, ms)
            out = pdf.drop(columns="_text")
            out["code"] = pd.array([r[0] for r in results], dtype="Int32")
            out["body"] = [r[1] for r in results]
            out["attempts"] = pd.array([r[2] for r in results], dtype="Int32")
            out["error"] = [r[3] for r in results]
            out["elapsed_ms"] = pd.array([r[4] for r in results], dtype="Int32")
            yield out

    return sent.mapInPandas(run, schema)


STORED = "text_hash string, code int, body string, attempts int, error string, elapsed_ms int, batch_id bigint"


def enrich_with_store(
    df: DataFrame,
    fetch: Fetch,
    store_path: str,
    batch_id: int,
    column: str = "value",
    keep: Sequence[str] = (),
    **options,
) -> DataFrame:
    """As :func:`enrich_with_retry`, each distinct text being sent once.

    Answers are kept below ``store_path`` by a hash of their text. Only texts
    without a stored answer are sent, equal ones once; what was answered in an
    earlier batch, or in an earlier attempt of this one, is not sent again. A
    text that failed is final for its batch and sent again in a later one.
    ``options`` are those of :func:`enrich_with_retry`.
    """
    spark = df.sparkSession
    text = F.col(column)
    sendable = F.coalesce(F.length(text), F.lit(0)) > 0
    named = df.select(*keep, text.alias("_text"), F.when(sendable, F.sha2(F.encode(text, "UTF-8"), 256)).alias("text_hash"))
    answers = f"{store_path.rstrip('/')}/answers"

    def known() -> DataFrame:
        if not is_folder(spark, answers):
            return spark.createDataFrame([], STORED)
        stored = spark.read.schema(STORED).parquet(answers)
        return stored.where(F.col("code").isNotNull() | (F.col("batch_id") == F.lit(batch_id)))

    texts = named.where(F.col("text_hash").isNotNull()).select("text_hash", "_text").dropDuplicates(["text_hash"])
    missing = texts.join(known().select("text_hash"), "text_hash", "left_anti")
    fresh = enrich_with_retry(missing, fetch, "_text", keep=("text_hash",), **options)
    # every attempt adds a folder of its own; two answers to one text do no harm
    fresh.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.parquet(f"{answers}/call={uuid.uuid4().hex}")
    fields = [f.name for f in ANSWER_FIELDS]
    order = F.struct(F.col("code").isNotNull(), "batch_id", F.struct(*fields))
    wanted = known().join(named.select("text_hash").distinct(), "text_hash", "left_semi")
    best = wanted.groupBy("text_hash").agg(F.max_by(F.struct(*fields), order).alias("_a"))
    small, _ = broadcast_if_small(best.select("text_hash", "_a", "_a.body"), "body")
    joined = named.join(small.select("text_hash", "_a"), "text_hash", "left")
    kept = [F.col("_a")[f].alias(f) for f in fields if f != "attempts"]
    tries = F.when(F.col("text_hash").isNull(), 0).otherwise(F.col("_a")["attempts"]).cast("int").alias("attempts")
    kept.insert(fields.index("attempts"), tries)
    return joined.select(*keep, *kept)
