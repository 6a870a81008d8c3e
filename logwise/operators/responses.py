"""Service responses -> validated term sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwise.functions.responses import parse_response, response_ok, split_terms


def parse_responses(
    df: DataFrame, code: str = "code", body: str = "body", keep: Sequence[str] = ()
) -> DataFrame:
    """``keep..., code, r struct<ret, msg, terms>, ok BOOLEAN, terms ARRAY<STRING>``.

    The body is parsed exactly once per row: the parse sits in a one-row
    generator, so the validity check and the term split read its result
    instead of Catalyst copying ``from_json`` into every filter and projection
    that references a field.
    """
    parsed = df.select(
        *keep,
        F.inline(F.array(F.struct(F.col(code).alias("code"), parse_response(body).alias("r")))),
    )
    ok = response_ok("code", "r")
    return parsed.select(
        *keep,
        "code",
        "r",
        ok.alias("ok"),
        F.when(ok, split_terms(F.col("r.terms"))).otherwise(F.array().cast("array<string>")).alias("terms"),
    )


def valid_terms(df: DataFrame, code: str = "code", body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Rows with a valid response only: ``keep..., terms``."""
    return parse_responses(df, code, body, keep).where("ok").select(*keep, "terms")


def failed_answers(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Answers of :func:`logwise.operators.enrich.enrich_with_retry` that give
    no terms, for an error output: ``keep..., code, body, attempts, error``.
    Rows that were never sent (empty texts) are no failures."""
    extra = ("body", "attempts", "error")
    parsed = parse_responses(df.where(F.col("attempts") > 0), keep=[*keep, *extra])
    return parsed.where(~F.col("ok")).select(*keep, "code", *extra)
