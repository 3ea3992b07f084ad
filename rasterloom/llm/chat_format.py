"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar, with tokens as fixed values below:

    conversation = { turn }
    turn         = ( "<s>" | "<x>" ) role "[INST] " text " [/INST]" "</s>"

A text behind ``<x>`` is escaped: ``~`` is written ``~0``, ``<`` ``~1`` and ``[`` ``~2``, so
no token can occur in it; a role of such a turn is escaped too. The deterministic parser
splits at ``</s>``, takes the role up to the first ``[INST] `` and drops the closing token.

Every turn that holds a token anywhere is escaped from the start, so no text can pass for a
part of the grammar. Rendering repeats until the parser gives back the source: first (level 0) the
other turns stand as they are, then (level 1) every turn is escaped. The last round holds no token
outside the grammar, so the trip ends there. ``level`` says which round it was.

Defined cases: a null text or role is empty; turns come by turn number (nulls first), ties
by role and text; repeated rows are repeated turns; null conv_id is a conversation of its
own; an empty table gives an empty result. A conversation's turns are gathered in one
row, as its one formatted string demands. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import sums_before

OPEN, OPEN_ESCAPED, HEAD, TAIL, CLOSE = "<s>", "<x>", "[INST] ", " [/INST]", "</s>"
TOKENS = (OPEN, OPEN_ESCAPED, "[INST]", "[/INST]", CLOSE)


def escape(s: Column) -> Column:
    return F.replace(F.replace(F.replace(s, F.lit("~"), F.lit("~0")), F.lit("<"), F.lit("~1")), F.lit("["), F.lit("~2"))


def unescape(s: Column) -> Column:
    return F.replace(F.replace(F.replace(s, F.lit("~2"), F.lit("[")), F.lit("~1"), F.lit("<")), F.lit("~0"), F.lit("~"))


def _holds_token(s: Column) -> Column:
    out = F.lit(False)
    for t in TOKENS:
        out = out | F.contains(s, F.lit(t))
    return out


def render(turns: Column, level: int) -> Column:
    """The formatted conversation; turns: array of struct(role, text)."""

    def one(t: Column) -> Column:
        role, text = t["role"], t["text"]
        plain = F.concat(F.lit(OPEN), role, F.lit(HEAD), text, F.lit(TAIL + CLOSE))
        coded = F.concat(F.lit(OPEN_ESCAPED), escape(role), F.lit(HEAD), escape(text), F.lit(TAIL + CLOSE))
        return coded if level else F.when(_holds_token(role) | _holds_token(text), coded).otherwise(plain)

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """Turns read back: array of struct(role, text, skip, size, chars, escaped); the numbers are code points of
    the formatted string: before the text, of the piece, of the text. A malformed piece has a null role."""
    pieces = F.split(formatted, CLOSE)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def one(p: Column) -> Column:
        body, head = F.substr(p, F.lit(4)), F.substr(p, F.lit(1), F.lit(3))
        cut = F.instr(body, F.lit(HEAD))
        raw_role = F.substr(body, F.lit(1), cut - 1)
        raw = F.substr(body, cut + len(HEAD), F.char_length(body) - cut + 1 - len(HEAD) - len(TAIL))
        good = (cut > 0) & p.endswith(TAIL) & head.isin(OPEN, OPEN_ESCAPED) & (F.char_length(body) - cut + 1 >= len(HEAD) + len(TAIL))
        coded = head == OPEN_ESCAPED
        return F.struct(
            F.when(good, F.when(coded, unescape(raw_role)).otherwise(raw_role)).alias("role"),
            F.when(coded, unescape(raw)).otherwise(raw).alias("text"),
            (cut + 2 + len(HEAD)).alias("skip"), F.char_length(p).alias("size"), F.char_length(raw).alias("chars"), coded.alias("escaped"))

    return F.transform(pieces, one)


def _same(turns: Column, read: Column) -> Column:
    plain = F.transform(read, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return F.coalesce(turns == plain, F.lit(False))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv, formatted, level, identical, turns (read back: role, text) and loss (array of
    start, chars, escaped_text): the spans of ``formatted`` under the loss mask, in code points."""
    item = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    convs = rows.groupBy(F.col(conv_col).alias("__conv")).agg(F.sort_array(F.collect_list(item)).alias("__rows"))
    convs = convs.select("__conv", F.transform("__rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("__turns"))
    for level in (0, 1):  # the texts of each further round are made only where the one before failed
        tried = render(F.col("__turns"), level)
        if level:
            tried = F.when(F.col("__level") >= 0, F.col("__formatted")).otherwise(tried)
        seen = [c for c in ("__conv", "__turns", "__level") if c in convs.columns]
        convs = convs.select(*seen, tried.alias("__formatted"))
        good = _same(F.col("__turns"), parse(F.col("__formatted")))
        found = F.when(good, F.lit(level)).otherwise(F.lit(-1))
        convs = convs.select("__conv", "__turns", "__formatted", (F.when(F.col("__level") >= 0, F.col("__level")).otherwise(found) if level else found).alias("__level"))
    convs = convs.select("__conv", "__formatted", "__level", parse(F.col("__formatted")).alias("__read"))
    convs = convs.select("*", sums_before(F.transform("__read", lambda t: t["size"] + len(CLOSE))).alias("__before"))
    spans = F.filter(
        F.zip_with("__read", "__before", lambda t, at: F.struct(t["role"].alias("role"), (at + t["skip"]).alias("start"), t["chars"].alias("chars"), t["escaped"].alias("escaped"))),
        lambda t: t["role"].isin(*loss_roles))
    return convs.select(
        F.col("__conv").alias(conv_col), F.col("__formatted").alias("formatted"), F.col("__level").alias("level"),
        (F.col("__level") >= 0).alias("identical"),
        F.transform("__read", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        spans.alias("loss"))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, cut out of the formatted string by its spans and unescaped."""
    def one(s: Column) -> Column:
        cut = F.substr(formatted, s["start"] + 1, s["chars"])
        return F.when(s["escaped"], unescape(cut)).otherwise(cut)
    return F.array_join(F.transform(loss, one), "")
