"""Chat formatting of typed content parts, with a loss mask, and the way back.

A turn is a role and an ordered list of parts: texts, images, audio clips and documents. A visitor with one rule per
kind of part flattens them: texts are escaped, every other part becomes a placeholder, and its reference and the number of
tokens it expands to are recorded in the order of the placeholders. The template marks turns by control strings.

Escaping is one rule: between ``<`` and ``|`` one backslash is added, so nothing in a text reads as a control string, and
taking one away gives the text back whatever it held.

DataFrame functions only: no code runs in Python on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

# Control strings of the template. They all begin with "<|", which no escaped text holds.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TURN_END = END + "\n"
TRAINED = ("assistant",)
# Tokens of attachments: image patches of this many pixels, audio tokens a second, tokens a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25.0, 256
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHED = "struct<kind:string,ref:string,tokens:bigint>"
_PLACEHOLDER = r"<\|(?:image|audio|document)\|>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def text_part(text: Column | str) -> Column:
    """A text as a part; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    empty = F.lit(None)
    return F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), empty.alias("ref"), empty.alias("width"),
        empty.alias("height"), empty.alias("seconds"), empty.alias("pages"),
    ).cast(PART)


def _at_least_one(tokens: Column) -> Column:
    return F.greatest(F.coalesce(F.ceil(tokens), F.lit(1)), F.lit(1)).cast("bigint")


# What the visitor does with each kind of attachment: the tokens it expands to.
_EXPANDED: dict[str, Callable[[Column], Column]] = {
    "image": lambda p: _at_least_one(F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH)),
    "audio": lambda p: _at_least_one(p["seconds"] * AUDIO_RATE),
    "document": lambda p: _at_least_one(p["pages"].cast("bigint") * PAGE_TOKENS),
}


def _visit(part: Column) -> Column:
    """``(out, attached)`` of one part: what is written, and what is recorded (null for texts)."""
    out, attached = escaped(F.coalesce(part["text"], F.lit(""))), F.lit(None).cast(ATTACHED)
    for kind, tokens in _EXPANDED.items():
        is_kind = part["type"] == kind
        out = F.when(is_kind, F.lit(f"<|{kind}|>")).otherwise(out)
        record = F.struct(F.lit(kind).alias("kind"), part["ref"].alias("ref"), tokens(part).alias("tokens")).cast(ATTACHED)
        attached = F.when(is_kind, record).otherwise(attached)
    return F.struct(out.alias("out"), attached.alias("attached"))


def format_chats(turns: DataFrame, ident: str = "conv_id", order: str = "turn", role: str = "role", parts: str = "parts",
                 trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """One row per conversation: ``(ident, formatted, loss_spans, attachments, expanded_tokens)``.

    ``parts`` is an array of :data:`PART`. ``loss_spans`` are the bodies of turns of a ``trained`` role, in order, as
    ``(start, end, start_byte, end_byte)`` in ``formatted``, end exclusive; empty bodies have empty spans. Placeholders
    lie inside the spans of their turn; :func:`loss_text` leaves them out. ``attachments`` are in the order of the
    placeholders, ``expanded_tokens`` is the sum of their tokens.

    Turns follow ``order``, null first; equal ones follow role and body, so repeated rows stay and reruns agree. A null role, a
    null text and a null list of parts count as empty. A part of unknown kind is a text. An attachment without
    size counts one token. A null ``ident`` is a conversation of its own. An empty table gives an empty one. Other
    columns are ignored. A conversation is written as one text, as a document is; all sums run in sorted windows.
    """
    visited = F.transform(F.coalesce(parts, F.array().cast(f"array<{PART}>")), _visit)
    flat = turns.select(
        F.col(ident).alias("_c"), F.col(order).alias("_turn"), F.coalesce(role, F.lit("")).alias("_role"), visited.alias("_visited")
    ).select(
        "_c", "_turn", "_role",
        F.array_join(F.transform("_visited", lambda v: v["out"]), "").alias("_body"),
        F.filter(F.transform("_visited", lambda v: v["attached"]), lambda a: a.isNotNull()).alias("_attached"),
    )
    head = F.concat(F.lit(START), escaped(F.col("_role")), F.lit(MIDDLE))
    pieces = flat.select(
        "_c", "_turn", "_role", "_body", "_attached", head.alias("_head"),
        F.concat(head, F.col("_body"), F.lit(TURN_END)).alias("_piece"),
    )
    in_order = Window.partitionBy("_c").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_body", F.xxhash64("_attached"))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.select(
        "_c", "_role", "_piece", "_attached", F.row_number().over(in_order).alias("_at"),
        *[
            x
            for measure, unit in ((F.char_length, ""), (F.octet_length, "_byte"))
            for x in (
                (F.coalesce(F.sum(measure("_piece").cast("bigint")).over(earlier), F.lit(0)) + measure("_head")).alias(f"_start{unit}"),
                measure("_body").cast("bigint").alias(f"_size{unit}"),
            )
        ],
    )
    span = F.struct(
        F.col("_start").alias("start"), (F.col("_start") + F.col("_size")).alias("end"),
        F.col("_start_byte").alias("start_byte"), (F.col("_start_byte") + F.col("_size_byte")).alias("end_byte"),
    )
    row = F.struct(
        "_at", F.col("_piece").alias("piece"), F.col("_attached").alias("attached"),
        F.when(F.col("_role").isin(*trained), span).alias("span"),
    )
    gathered = placed.groupBy("_c").agg(F.array_sort(F.collect_list(row)).alias("_turns"))
    attachments = F.flatten(F.transform("_turns", lambda t: t["attached"]))
    return gathered.select(
        F.col("_c").alias(ident),
        F.array_join(F.transform("_turns", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("_turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate(
        F.transform("attachments", lambda a: a["tokens"]), F.lit(0).cast("bigint"), lambda a, b: a + b
    ))


def _plain(body: Column) -> Column:
    """The text of a body: placeholders out, escapes undone."""
    return unescaped(F.regexp_replace(body, _PLACEHOLDER, ""))


def read_turns(formatted: Column | str) -> Column:
    """``(role, text, kinds)`` of each turn, read back from a formatted text; ``kinds`` are those of its placeholders."""
    pieces = F.split(formatted, rf"\Q{TURN_END}\E", -1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, MIDDLE, 1)
        body = F.substring_index(piece, MIDDLE, -1)
        return F.struct(
            unescaped(F.substring(role, len(START) + 1, 1 << 30)).alias("role"), _plain(body).alias("text"),
            F.transform(
                F.regexp_extract_all(body, F.lit(_PLACEHOLDER), F.lit(0)), lambda p: F.regexp_extract(p, r"\w+", 0)
            ).alias("kinds"),
        )

    # What follows the last mark is no turn.
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def loss_text(formatted: Column | str, spans: Column | str) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between.

    Spans are cut by bytes, which takes as long as the span, not as the way to it.
    """
    data = (F.col(formatted) if isinstance(formatted, str) else formatted).cast("binary")
    cut = lambda s: _plain(
        F.substring(data, (s["start_byte"] + 1).cast("int"), (s["end_byte"] - s["start_byte"]).cast("int")).cast("string")
    )
    return F.array_join(F.transform(spans, cut), "")
