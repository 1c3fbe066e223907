"""Chat formatting from event logs, with DataFrame functions only.

A conversation is a log of events. Events of one turn are folded in order of their
sequence number into messages; messages are rendered with a template whose control
strings cannot occur in an escaped text; the loss mask is a list of spans of the
rendered text.

Template of one message::

    ### role
    text</turn>

Escapes: a backslash is ``\\\\\\\\``, ``#`` is ``\\\\h``, ``<`` is ``\\\\l`` and, in roles, a line
break is ``\\\\n``. An escaped text thus holds neither ``#`` nor ``<``, so splitting on
the control strings is exact and the escape can be taken back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN_END = "</turn>\n"
#: Turns of one part of a formatted conversation; parts bound what a task holds of a long one.
TURNS_PER_PART = 64


def escaped(text: Column) -> Column:
    for plain, code in (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    """Inverse of both escapes: pairs of backslashes are taken off first, from the left."""
    def codes(piece: Column) -> Column:
        for plain, code in (("#", "\\h"), ("<", "\\l"), ("\n", "\\n")):
            piece = F.replace(piece, F.lit(code), F.lit(plain))
        return piece

    pieces = F.transform(F.split(text, r"\\\\"), codes)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(pieces, "\\")).otherwise(text)


def message_events(conversations: DataFrame) -> DataFrame:
    """Finished turns as a log: one event ``message`` for each row."""
    return conversations.select(
        "conv_id", "turn", F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, number, role, text) of a log (conv_id, turn, seq, kind, role, text).

    Kinds: ``message`` starts a message of the turn, ``delta`` appends to the latest,
    ``edit`` replaces its text, ``regenerate`` empties it for the deltas that follow.
    Any other or no kind counts as ``message``; so does a ``delta``, ``edit`` or
    ``regenerate`` without a message before it. Events of equal sequence number are
    taken in order of kind, role and text. A null text is empty, a null role is empty;
    null conversations and turns are values of their own. Repeated ``message`` rows
    are repeated messages. An empty log gives no rows.
    """
    kind = F.coalesce("kind", F.lit("message"))
    event = F.struct(
        F.col("seq"), F.when(kind.isin("delta", "edit", "regenerate"), kind).otherwise("message").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    none = F.array().cast("array<struct<role:string,text:string>>")

    def step(done: Column, e: Column) -> Column:
        last = F.element_at(done, -1)
        text = (F.when(e["kind"] == "delta", F.concat(last["text"], e["text"]))
                .when(e["kind"] == "edit", e["text"]).otherwise(""))
        changed = F.struct(last["role"].alias("role"), text.alias("text"))
        started = F.struct(e["role"].alias("role"), F.when(e["kind"] == "regenerate", "").otherwise(e["text"]).alias("text"))
        return F.when((e["kind"] == "message") | (F.size(done) == 0), F.concat(done, F.array(started))).otherwise(
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(changed)))

    turns = events.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(event)).alias("log"))
    # a turn of one event is the common case and needs no fold
    only = F.col("log")[0]
    simple = F.array(F.struct(only["role"].alias("role"),
                              F.when(only["kind"] == "regenerate", "").otherwise(only["text"]).alias("text")))
    messages = F.when(F.size("log") == 1, simple).otherwise(F.aggregate("log", none, step))
    return turns.select("conv_id", "turn", F.posexplode(messages).alias("number", "m")).select(
        "conv_id", "turn", "number", "m.role", "m.text")


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Formatted parts (conv_id, part, formatted, loss) of messages.

    A conversation's text is its parts joined in order (null part, for null turns,
    first); a part holds ``TURNS_PER_PART`` consecutive turns, which bounds the rows a
    task gathers however long a conversation grows. ``loss`` has the spans (start, length in code points of ``formatted``) of the
    texts of ``loss_role``, in order.
    """
    head = F.concat(F.lit("### "), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    piece = F.struct(
        "turn", "number", F.concat(head, body, F.lit(TURN_END)).alias("text"),
        F.char_length(head).alias("start"), F.char_length(body).alias("length"), (F.col("role") == loss_role).alias("learnt"),
    )
    part = F.floor(F.col("turn") / TURNS_PER_PART)
    parts = messages.groupBy("conv_id", part.alias("part")).agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(s: Column, p: Column) -> Column:
        span = F.struct((s["at"] + p["start"]).alias("start"), p["length"].alias("length"))
        return F.struct(
            (s["at"] + F.char_length(p["text"])).alias("at"),
            F.when(p["learnt"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    return parts.select(
        "conv_id", "part", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.aggregate("pieces", zero, step, lambda s: s["spans"]).alias("loss"))


def parsed(formatted: Column) -> Column:
    """Messages (role, text) read back from formatted text."""
    def message(piece: Column) -> Column:
        return F.struct(
            unescaped(F.substring_index(piece, "\n", 1).substr(F.lit(5), F.char_length(piece))).alias("role"),
            unescaped(piece.substr(F.instr(piece, "\n") + 1, F.char_length(piece))).alias("text"))

    pieces = F.split(formatted, TURN_END)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), message)


def masked(formatted: Column, loss: Column) -> Column:
    """Texts under the loss mask, read back."""
    return F.transform(loss, lambda s: unescaped(formatted.substr(s["start"] + 1, s["length"])))


def digest(parts: DataFrame) -> DataFrame:
    """One row per conversation with digests of what its formatted parts hold."""
    def line(m: Column) -> Column:
        return F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))

    turns, loss = parsed(F.col("formatted")), F.array_join(masked(F.col("formatted"), F.col("loss")), "")
    each = parts.select("conv_id", "part", turns.alias("turns"), loss.alias("loss"), F.char_length("formatted").alias("chars"))
    piece = F.struct("part", F.size("turns").cast("long").alias("n"),
                     F.array_join(F.transform("turns", line), "").alias("turns"), "loss",
                     F.col("chars").cast("long").alias("chars"))
    whole = each.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))

    def total(field: str) -> Column:
        return F.aggregate("p", F.lit(0).cast("long"), lambda s, x: s + x[field])

    def text(field: str) -> Column:
        return F.array_join(F.transform("p", lambda x: x[field]), "")

    return whole.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(text("turns"), 256).alias("turns_sha256"),
        F.char_length(text("loss")).cast("long").alias("loss_chars"), F.sha2(text("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"))
