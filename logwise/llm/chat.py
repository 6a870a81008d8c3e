"""Chat formatting of typed content parts, in DataFrame expressions only.

A conversation is a set of message rows whose content is an array of parts
(text, image, audio, document). A visitor per part kind flattens them in
order: text is escaped and kept, any other part becomes a numbered
placeholder, is recorded as an attachment and counts as the tokens that its
placeholder expands to. Every row is rendered before the shuffle; rows then
meet once per conversation.

Template (role -> opening, closing):
    user       [INST] ... [/INST]
    system     [SYS] ... [/SYS]
    assistant  [ASST] ... </s>
    any other  [ROLE]name[MSG] ... [/MSG]
with ``<s>`` before the first turn. Inside texts, role names and references a
backslash is doubled and a control string gets a backslash after its first
character; :func:`unescape` inverts both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names inside the brackets of control strings.
NAMES = r"/?(?:INST|SYS|ASST|ROLE|MSG|IMAGE|AUDIO|DOC)"
#: Tokens one placeholder expands to: a fixed part and a part per unit
#: (unit: an image tile, a second of audio, a page).
EXPANSION = {"image": (1, 576), "audio": (2, 25), "document": (1, 800)}
PLACEHOLDER = {"image": "IMAGE", "audio": "AUDIO", "document": "DOC"}

PARTS = "array<struct<type:string,text:string,ref:string,units:bigint>>"


def escape(text: Column) -> Column:
    """Text without any control string of the template; reversible."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    square = F.regexp_replace(doubled, rf"\[({NAMES}[\]:])", r"[\\$1")
    return F.regexp_replace(square, r"<(/?s>)", r"<\\$1")


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`."""
    angle = F.regexp_replace(text, r"<\\(/?s>)", "<$1")
    square = F.regexp_replace(angle, rf"\[\\({NAMES}[\]:])", "[$1")
    return F.replace(square, F.lit("\\\\"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A content array that holds one text part (null text: empty)."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("long").alias("units"),
        )
    )


def _visit(part: Column, ordinal: Column) -> Column:
    """One part flattened: text, or a placeholder with its number in the message."""
    out = escape(F.coalesce(part["text"], F.lit("")))
    for kind, name in PLACEHOLDER.items():
        shown = F.concat(
            F.lit(f"[{name}:"), ordinal.cast("string"), F.lit(":"), escape(F.coalesce(part["ref"], F.lit(""))), F.lit("]")
        )
        out = F.when(part["type"] == kind, shown).otherwise(out)
    return out


def _expanded(part: Column) -> Column:
    """Tokens that the placeholder of a part expands to; 0 for text."""
    out = F.lit(0).cast("long")
    for kind, (fixed, each) in EXPANSION.items():
        units = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0)).cast("long")
        out = F.when(part["type"] == kind, F.lit(fixed) + F.lit(each) * units).otherwise(out)
    return out


def _frame(role: Column) -> tuple[Column, Column]:
    known = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("[ASST]", "</s>")}
    start = F.concat(F.lit("[ROLE]"), escape(F.coalesce(role, F.lit(""))), F.lit("[MSG]"))
    end = F.lit("[/MSG]")
    for name, (a, b) in known.items():
        start, end = F.when(role == name, a).otherwise(start), F.when(role == name, b).otherwise(end)
    return start, end


def format_chat(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "content"
) -> DataFrame:
    """One row per conversation, turns in order.

    Result: conv, ``formatted`` (string), ``loss_spans`` (array of start and
    length in code points of ``formatted``: each assistant text), ``n_turns``,
    ``attachments`` (array of turn, ordinal, type, ref, n_tokens; ordinals
    count within the message) and ``expanded_tokens`` (sum over attachments).

    Null content or a null text is an empty text; a null role is an empty
    role name; parts of an unknown type count as text; a null or negative
    number of units counts as one or none. Rows of equal turn are ordered by
    role, then rendered text; null turns come first; repeated rows are turns
    of their own; null ids form one conversation. Other columns are ignored.
    An empty table gives no rows.
    """
    parts = F.coalesce(F.col(content).cast(PARTS), F.lit(None).cast(PARTS), F.array().cast(PARTS))
    start, end = _frame(F.col("_role"))
    row = (
        messages.select(
            F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.col(role).alias("_role"), parts.alias("_parts")
        )
        .withColumn("_parts", F.filter("_parts", lambda p: p.isNotNull()))
        .select(
            "_conv",
            "_turn",
            F.coalesce("_role", F.lit("")).alias("_name"),
            start.alias("_start"),
            F.array_join(F.transform("_parts", lambda p, i: _visit(p, i + 1)), "").alias("_body"),
            end.alias("_end"),
            F.filter(
                F.transform(
                    "_parts",
                    lambda p, i: F.struct(
                        F.col("_turn").alias("turn"),
                        (i + 1).alias("ordinal"),
                        p["type"].alias("type"),
                        p["ref"].alias("ref"),
                        _expanded(p).alias("n_tokens"),
                    ),
                ),
                lambda a: a["type"].isin(*EXPANSION),
            ).alias("_attached"),
        )
    )
    turns = row.groupBy("_conv").agg(
        F.array_sort(F.collect_list(F.struct("_turn", "_name", "_body", "_start", "_end", "_attached"))).alias("_turns")
    )

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.char_length(t["_start"])
        size = F.char_length(t["_body"])
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        spans = F.when(t["_name"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((begin + size + F.char_length(t["_end"])).alias("at"), spans.alias("spans"))

    first = F.struct(F.lit(3).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    pieces = F.transform("_turns", lambda t: F.concat(t["_start"], t["_body"], t["_end"]))
    attached = F.flatten(F.transform("_turns", lambda t: t["_attached"]))
    return turns.select(
        F.col("_conv").alias(conv),
        F.concat(F.lit("<s>"), F.array_join(pieces, "")).alias("formatted"),
        F.aggregate("_turns", first, step)["spans"].alias("loss_spans"),
        F.size("_turns").cast("long").alias("n_turns"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda s, a: s + a["n_tokens"]).alias("expanded_tokens"),
    )


_TURN = (
    r"(?s)(\[INST\]|\[SYS\]|\[ASST\]|\[ROLE\].*?\[MSG\])(.*?)"
    r"(\[/INST\]|\[/SYS\]|</s>|\[/MSG\])"
)


def read_turns(formatted: Column) -> Column:
    """Turns parsed from a formatted conversation: array of role and text."""
    heads = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))

    def named(head: Column) -> Column:
        other = unescape(F.substring(head, F.lit(7), F.char_length(head) - F.lit(11)))
        return (
            F.when(head == "[INST]", "user").when(head == "[SYS]", "system").when(head == "[ASST]", "assistant").otherwise(other)
        )

    return F.zip_with(heads, texts, lambda h, t: F.struct(named(h).alias("role"), unescape(t).alias("text")))


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), ""
    )
