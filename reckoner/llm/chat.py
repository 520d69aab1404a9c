"""Chat formatting of an event log.

A log has one row per event: ``conv_id``, ``turn``, ``message`` (tells apart
messages of one turn), ``seq``, ``op``, ``role``, ``text``, ``times``. Events
of a conversation are sorted by sequence and folded into final messages:

* ``start`` begins a message, with its role and its number of repeats
  ``times``; ``delta`` appends to it;
* ``edit`` replaces what there is; ``regenerate`` discards it, and later deltas
  are a new answer;
* ``delete`` removes the message, unless a later event begins it again.

Events are folded per message first, so a conversation with many deltas is
spread over its messages; then messages are placed and joined per conversation.
The result of a conversation is one text by its nature.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts ``\\``
becomes ``\\s`` and ``<|`` becomes ``<\\p``, in roles also a line feed ``\\n``, so
no control string can arise and reading is exact. The loss mask is the UTF-8
byte ranges of assistant texts in the formatted text.

Only built-in functions are used. Cases: NULL roles and texts are empty; NULL
turns come first; messages of one turn are ordered by role and text; repeated
rows are repeated turns; a conversation whose messages are all deleted is not
returned; NULL ``conv_id`` is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
CHUNK = 200


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\p"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\s"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\n"), F.lit("\n")))


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A log in which every turn is started and streamed in deltas of ``CHUNK`` characters."""
    clean = turns.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    once = clean.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").cast("int").alias("times"))
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor(F.length("text") / CHUNK).cast("int")),
        lambda i: F.struct(F.lit("delta").alias("op"), F.substring(F.col("text"), i * CHUNK + 1, F.lit(CHUNK)).alias("text")),
    )
    start = F.array(F.struct(F.lit("start").alias("op"), F.lit("").alias("text")))
    message = F.sha2(F.concat_ws("\n", "role", "text"), 256)
    listed = once.select("conv_id", "turn", "role", "times", message.alias("message"), F.posexplode(F.concat(start, chunks)).alias("seq", "e"))
    return listed.select("conv_id", "turn", "message", F.col("seq").cast("long").alias("seq"), "e.op", "role", "e.text", "times")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, role, text, times."""
    clean = F.struct("seq", "op", F.coalesce("text", F.lit("")).alias("text"))
    said = F.col("op") != "delete"
    messages = events.groupBy("conv_id", "turn", "message").agg(
        F.sort_array(F.collect_list(clean)).alias("events"),
        F.max(F.when(F.col("op").isin("start", "edit", "regenerate"), F.col("seq"))).alias("reset"),
        F.coalesce(F.min_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))), F.lit("")).alias("role"),
        F.coalesce(F.max("times"), F.lit(1)).alias("times"),
        F.max(F.when(~said, F.col("seq"))).alias("deleted"),
        F.max(F.when(said, F.col("seq"))).alias("last"),
    )
    kept = messages.filter(F.col("deleted").isNull() | (F.col("last") > F.col("deleted")))
    current = F.filter("events", lambda e: F.col("reset").isNull() | (e["seq"] >= F.col("reset")))
    text = F.array_join(F.transform(F.filter(current, lambda e: ~e["op"].isin("regenerate", "delete")), lambda e: e["text"]), "")
    return kept.select("conv_id", "turn", "role", text.alias("text"), "times")


def render(messages: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, and loss_mask, an array of (start, length) in bytes."""
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    rows = messages.withColumn("nth", F.explode(F.sequence(F.lit(1), "times"))).select(
        "conv_id", "turn", "role", "text", head.alias("head"), escaped(F.col("text")).alias("body")
    )
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(f"{END}\n")))
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    to_here = F.sum(F.octet_length("piece").cast("long")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.select(
        "conv_id", "role", "piece", F.octet_length("head").alias("head"), F.octet_length("body").alias("length"),
        (to_here - F.octet_length("piece")).alias("at"),
    )
    span = F.when(F.col("role") == "assistant", F.struct((F.col("at") + F.col("head")).alias("start"), "length"))
    joined = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"), F.sort_array(F.collect_list(span)).alias("loss_mask")
    )
    return joined.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "loss_mask"
    )


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold(events))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    parts = F.split(formatted, r"<\|im_start\|>")
    parts = F.slice(parts, F.lit(2), F.size(parts))
    text = lambda p: F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(END) - 1)
    return F.transform(
        parts, lambda p: F.struct(unescaped_role(F.substring_index(p, "\n", 1)).alias("role"), unescaped(text(p)).alias("text"))
    )


def masked(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped."""
    raw = formatted.cast("binary")
    spans = F.transform(
        mask, lambda s: unescaped(F.decode(F.substring(raw, (s["start"] + 1).cast("int"), s["length"]), "UTF-8"))
    )
    return F.array_join(spans, "")


def digest(chats: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, as numbers and digests."""
    read = chats.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), masked(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
