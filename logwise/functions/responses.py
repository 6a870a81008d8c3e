"""Segmentation service responses: format, parse, validate, split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logwise.schemas import SERVICE_RESPONSE

# The response body the segmentation service sends, with the
# terms inserted as they are (no escaping), and the status it answers with.
RESPONSE_PREFIX = '{"ret":0, "msg":"OK", "terms":"'
RESPONSE_SUFFIX = '"}'
HTTP_OK = 200
RET_OK = 0


def format_response(terms: str | Column) -> Column:
    """The body the service returns for a segmented comment.

    Terms are pasted in unescaped, so a comment with a double quote, a
    backslash or a control character yields a body that does not parse.
    """
    t = F.col(terms) if isinstance(terms, str) else terms
    return F.concat(F.lit(RESPONSE_PREFIX), t, F.lit(RESPONSE_SUFFIX))


def parse_response(body: str | Column) -> Column:
    """Body -> struct<ret INT, msg STRING, terms STRING>; malformed -> NULL fields."""
    b = F.col(body) if isinstance(body, str) else body
    return F.from_json(b, SERVICE_RESPONSE, {"mode": "PERMISSIVE"})


def response_ok(code: str | Column, parsed: str | Column) -> Column:
    """HTTP 200, ``ret == 0`` and all three fields present with the right type."""
    c = F.col(code) if isinstance(code, str) else code
    r = F.col(parsed) if isinstance(parsed, str) else parsed
    return F.coalesce(
        (c == F.lit(HTTP_OK))
        & (r["ret"] == F.lit(RET_OK))
        & r["msg"].isNotNull()
        & r["terms"].isNotNull(),
        F.lit(False),
    )


def split_terms(terms: str | Column) -> Column:
    """Terms joined by one space -> set of non-empty terms."""
    t = F.col(terms) if isinstance(terms, str) else terms
    return F.array_distinct(F.array_remove(F.split(t, " "), ""))
