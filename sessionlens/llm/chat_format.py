"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log holds events per conversation: ``delta`` appends to a message, ``edit``
replaces what it says so far, ``regenerate`` empties it (deltas follow),
``delete`` removes it. Events are applied by sequence number and folded into
one text per message; messages are rendered in the order of their first event
and joined per conversation. Finished turns become the log that a chat service
would have kept of them: an answer's first attempt, its regeneration and the
streamed deltas; a question's first words and the edit to what it says.

Template: a turn is ``<s>[ROLE]role[/ROLE]text</s>``. Inside roles and texts
every control string gets a backslash after its first character (``<\\s>``), and
one more where backslashes already stand there, so taking one away again
restores any text. The loss mask lists the code-point spans of assistant texts
in the formatted string.

Folding and rendering are spread by message, so a conversation with very many
events is not gathered for them; only the finished turns of a conversation
meet, as its formatted text is one value.

Cases: a null text or role is empty. Turns with equal numbers are ordered by
role, then a digest of the text; repeated rows are turns of their own, told apart
by a copy number. Null turn numbers come first. A text of any length is streamed as
deltas and rendered whole. A null conversation id is a conversation. An event without a message
id, or of another kind, is ignored. Empty tables give no rows; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, ROLE, END_ROLE = "<s>", "</s>", "[ROLE]", "[/ROLE]"
# The strings that a template of this family can hold.
CONTROL = r"/?s>|/?ROLE\]|/?INST\]|/?SYS\]"
ESCAPE = rf"(?i)([<\[])(\\*)({CONTROL})"
UNESCAPE = rf"(?i)([<\[])\\(\\*)({CONTROL})"
TRAINED = "assistant"
KINDS = ("delta", "edit", "regenerate", "delete")
STREAMED = 1024  # code points of a delta
ATTEMPT = 8      # of what is edited or regenerated away


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


# --- events ------------------------------------------------------------------

def events_from_turns(turns: DataFrame) -> DataFrame:
    """The log of finished turns (conv_id, turn, role, text): conv_id, message, copy,
    seq, kind, role, text. The message id is the turn number, the role and a digest
    of the text; equal rows are copies of one message."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    message = F.struct("turn", role.alias("role"), F.unhex(F.md5(text)).alias("digest"))
    rows = turns.select("conv_id", "turn", message.alias("message"), role.alias("role"), text.alias("text"))
    same = Window.partitionBy("conv_id", "message").orderBy("turn")
    rows = rows.withColumn("copy", F.row_number().over(same) - 1)

    def event(n: Column, kind: str, said: Column) -> Column:
        return F.struct(n.cast("int").alias("n"), F.lit(kind).alias("kind"), said.alias("text"))
    first = event(F.lit(0), "delta", F.left("text", F.lit(ATTEMPT)))
    pieces = F.ceil(F.length("text") / STREAMED).cast("int")
    deltas = F.transform(F.sequence(F.lit(0), F.greatest(pieces - 1, F.lit(0))), lambda k: event(
        k + 2, "delta", F.substring("text", k * STREAMED + 1, F.lit(STREAMED))))
    answer = F.concat(F.array(first, event(F.lit(1), "regenerate", F.lit(""))), deltas)
    question = F.array(first, event(F.lit(1), "edit", F.col("text")))
    log = F.when(F.col("role") == TRAINED, answer).otherwise(question)
    return rows.select("conv_id", "message", "copy", "turn", "role", F.explode(log).alias("e")).select(
        "conv_id", "message", "copy", F.struct("turn", "e.n").alias("seq"), "e.kind", "role", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """Events (conv_id, message, seq, kind, role, text, and copy where messages have
    copies) -> one row per message that is left: conv_id, first (its first sequence
    number), message, copy, role, text."""
    if "copy" not in events.columns:
        events = events.withColumn("copy", F.lit(0))
    known = events.where(F.col("message").isNotNull() & F.col("kind").isin(*KINDS))
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), F.col("role").alias("role"))
    log = known.groupBy("conv_id", "message", "copy").agg(F.sort_array(F.collect_list(event)).alias("log"))
    # only what follows the last edit, regeneration or deletion counts
    numbered = F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i).otherwise(F.lit(-1)))
    log = log.withColumn("reset", F.array_max(numbered))
    tail = F.expr("slice(log, greatest(reset, 0) + 1, size(log))")
    said = F.transform("tail", lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    return (log.withColumn("tail", tail).where("tail[0].kind <> 'delete'")
            .select("conv_id", F.col("log")[0]["seq"].alias("first"), "message", "copy",
                    F.coalesce(F.col("log")[0]["role"], F.lit("")).alias("role"),
                    F.array_join(said, "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """Messages -> rendered turns: head (up to the text), body and tail."""
    return messages.select(
        "conv_id", "first", "message", "copy", "role",
        F.concat(F.lit(OPEN + ROLE), escape(F.col("role")), F.lit(END_ROLE)).alias("head"),
        escape(F.col("text")).alias("body"))


def join_turns(rendered: DataFrame) -> DataFrame:
    """Per conversation: conv_id, n_turns, formatted, loss_mask (array of
    start and end, code points) over the texts of assistant turns."""
    order = Window.partitionBy("conv_id").orderBy("first", "message", "copy")
    size = F.length("head") + F.length("body") + len(CLOSE)
    placed = (rendered.withColumn("end", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("end", F.col("end") - len(CLOSE))
              .withColumn("start", F.col("end") - F.length("body")))
    turn = F.struct("first", "message", "copy", "role", F.concat("head", "body", F.lit(CLOSE)).alias("said"),
                    F.struct("start", "end").alias("span"))
    # the window has already brought a conversation's turns together
    joined = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    trained = F.filter("turns", lambda t: t["role"] == TRAINED)
    return joined.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                         F.array_join(F.col("turns")["said"], "").alias("formatted"),
                         F.transform(trained, lambda t: t["span"]).alias("loss_mask"))


def format_log(events: DataFrame) -> DataFrame:
    return join_turns(render(fold(events)))


def format_turns(turns: DataFrame) -> DataFrame:
    return format_log(events_from_turns(turns))


# --- reading back ------------------------------------------------------------

def parse_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted string; no escaped text holds a marker."""
    parts = F.filter(F.split(formatted, F.lit(CLOSE)), lambda p: p != "")
    body = lambda p: F.substring(p, F.lit(len(OPEN + ROLE) + 1), F.length(p))
    at = lambda p: F.instr(body(p), END_ROLE)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring(body(p), F.lit(1), at(p) - 1)).alias("role"),
        unescape(F.substring(body(p), at(p) + len(END_ROLE), F.length(p))).alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted strings say, read back from them."""
    lines = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.transform("loss_mask", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return (formatted.withColumn("back", parse_turns(F.col("formatted")))
            .withColumn("loss", F.array_join(trained, ""))
            .select("conv_id", F.size("back").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
