"""Quotation linking: conversations in reply order, without quotes, on DataFrame functions only.

Lines that begin with ``>`` marks are quoted, one level for each mark; lines
of one level that follow each other are a passage. What a message says itself
is indexed by hashes of its normalised whole, paragraphs and lines, each hash
with the first message that has it. A quoted passage is looked up as a whole,
by its paragraphs and by its lines; the message found by the lowest level is
what the quoting message replies to. Short passages are looked up in their own
conversation only, and so are lines but the long ones: many say them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.llm.common import components, cut, running_total

QUOTED = r"^[ \t]*>"
MARKS = r"^((?:[ \t]*>)+)"
#: Lines of fewer words and characters link nothing by themselves, and such passages nothing in other conversations.
LEAST_WORDS = 3
LEAST_CHARACTERS = 12
#: Lines of so many words link other conversations.
LONG_LINE = 8
TURNS = 1024


def normal(text: Column) -> Column:
    """Letters and digits of any script in lower case, everything else one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def level(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 1)
    return F.length(F.regexp_replace(marks, "[^>]", ""))


def unquoted(text: Column) -> Column:
    """A text without quoted lines and without the "... wrote:" line before them."""
    free = F.regexp_replace(text, r"(?m)^[^\n>]*\bwrote:[ \t]*\n(?=[ \t]*>)", "")
    free = F.regexp_replace(free, r"(?m)^[ \t]*>[^\n]*(?:\n|\z)", "")
    return F.when(text.rlike(r"(?m)^[ \t]*>"), F.trim(F.regexp_replace(free, r"^\s+|\s+$", ""))).otherwise(text)


def _long_enough(n: Column) -> Column:
    return (F.size(F.split(n, " ")) >= LEAST_WORDS) | (F.length(n) >= LEAST_CHARACTERS)


def previous_turns(turns: DataFrame) -> DataFrame:
    """Adds last, the turn before in the same conversation; a long conversation is looked through in stretches."""
    stretch = F.floor(F.col("turn") / TURNS)
    ends = turns.groupBy("conv_id", stretch.alias("b")).agg(F.max("turn").alias("end"))
    ends = ends.select(F.col("conv_id").alias("c2"), F.col("b").alias("b2"), F.lag("end").over(Window.partitionBy("conv_id").orderBy("b")).alias("end"))
    inner = F.lag("turn").over(Window.partitionBy("conv_id", "b").orderBy("turn"))
    local = turns.withColumn("b", stretch).withColumn("last", inner)
    joined = local.join(ends, (F.col("conv_id") == F.col("c2")) & (F.col("b") == F.col("b2")))
    return joined.select("conv_id", "turn", F.coalesce("last", "end").alias("last"))


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """thread_id, position, conv_id, turn, role, body, n_quoted, reply_conv, reply_turn, linked of each message.

    body is the text without quotes. reply_conv and reply_turn name the
    message that it replies to: the first, earlier in (conv, turn), that says
    the quoted passage of the lowest level found, in the same conversation
    before others; without any such, the turn before it in its conversation,
    null for a first turn. linked tells whether a quotation decided. Equal
    passages are told by their normalised words; ties between passages of one
    level go to whole ones, then to the own conversation, the earlier passage
    and the earlier message. Texts of any length are taken whole, a message's
    lines in one task. Other columns are left out; an empty table gives no rows.
    Conversations that quotations join are a thread, named by the smallest of
    them; position counts from 1 in the order of conversation and turn, in
    which every message follows the one it replies to. Null texts are empty;
    repeated rows are messages each, in the same place; messages with a null
    conversation or turn reply to nothing, stand first and have a null thread.
    """
    rows = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    at = F.struct(F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"))
    known = rows.where("conv_id is not null and turn is not null")
    quoting = known.where(F.col("t").rlike(r"(?m)^[ \t]*>")).select("conv_id", "turn", "t").distinct()

    lines = quoting.select("conv_id", "turn", F.xxhash64("t").alias("h"), F.posexplode(F.split("t", "\n")).alias("i", "line"))
    lines = lines.withColumn("level", level(F.col("line"))).withColumn("said", F.regexp_replace("line", MARKS, ""))
    own = Window.partitionBy("conv_id", "turn", "h").orderBy("i")
    new = (F.col("level") != F.lag("level", 1, -1).over(own)).cast("int")
    runs = lines.withColumn("new", new).withColumn("run", F.sum("new").over(own)).where("level > 0")
    passages = runs.groupBy("conv_id", "turn", "h", "run", "level").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "said"))), lambda x: x["said"]), "\n").alias("p"))
    some = lambda part, pattern: F.transform(F.split("p", pattern), lambda x: F.struct(F.lit(part).alias("part"), x.alias("x")))
    parts = F.concat(F.array(F.struct(F.lit(0).alias("part"), F.col("p").alias("x"))), some(1, r"\n[ \t\r]*\n"), some(2, "\n"))
    asked = passages.select("conv_id", "turn", "level", "run", F.inline(parts)).withColumn("n", normal(F.col("x"))).where((F.col("n") != "") & ((F.col("part") < 2) | _long_enough(F.col("n"))))
    far = F.when(F.col("part") == 2, F.size(F.split("n", " ")) >= LONG_LINE).otherwise(_long_enough(F.col("n")))
    asked = asked.select("conv_id", "turn", "level", "run", "part", far.alias("far"), F.md5("n").alias("k")).distinct()

    body = unquoted(F.col("t"))
    said = known.select("conv_id", "turn", body.alias("b")).where("b <> ''")
    pieces = F.array_distinct(F.concat(F.array(F.col("b")), F.split("b", r"\n[ \t\r]*\n"), F.split("b", "\n")))
    index = said.select(at.alias("at"), F.explode(pieces).alias("x")).withColumn("n", normal(F.col("x"))).where("n <> ''").select("at", F.md5("n").alias("k"))
    wanted = asked.select("k").distinct()
    # The first message of a hash, in all and in each conversation: one row however many say the same.
    index = index.join(wanted, "k", "left_semi")
    near = cut(index.groupBy("k", F.col("at.conv_id").alias("conv_id")).agg(F.min("at").alias("near")))
    first = near.groupBy("k").agg(F.min("near").alias("first"))
    found = asked.join(first, "k").join(near, ["k", "conv_id"], "left")
    before = lambda c: F.when(F.col(c) < at, F.col(c))
    found = found.withColumn("to", F.coalesce(before("near"), F.when(F.col("far"), before("first")))).where("to is not null")
    order = F.struct("level", "part", F.when(F.col("to.conv_id") == F.col("conv_id"), 0).otherwise(1), "run", "to")
    replies = found.groupBy(F.col("conv_id").alias("c2"), F.col("turn").alias("t2")).agg(F.min_by("to", order).alias("to"))

    hops = replies.where("to.conv_id <> c2").select(F.col("c2").alias("a"), F.col("to.conv_id").alias("b"))
    threads = components(hops)
    turns = previous_turns(known.select("conv_id", "turn").distinct())
    placed = turns.join(replies, (F.col("conv_id") == F.col("c2")) & (F.col("turn") == F.col("t2")), "left").drop("c2", "t2")
    placed = placed.join(threads.hint("merge"), F.col("conv_id") == F.col("node"), "left").withColumn("thread_id", F.coalesce("root", "conv_id")).drop("node", "root")
    placed = placed.withColumn("bucket", F.struct("conv_id", F.floor(F.col("turn") / TURNS).alias("b"))).withColumn("one", F.lit(1))
    placed = running_total(placed, ["thread_id"], "bucket", ["turn"], "one", "before")
    meta = placed.select(
        F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), "thread_id", (F.col("before") + 1).alias("position"), F.col("to").isNotNull().alias("linked"),
        F.coalesce(F.col("to.conv_id"), F.when(F.col("last").isNotNull(), F.col("conv_id"))).alias("reply_conv"), F.coalesce(F.col("to.turn"), F.col("last")).alias("reply_turn"),
    )
    quoted = F.size(F.filter(F.split("t", "\n"), lambda x: x.rlike(QUOTED)))
    out = rows.withColumn("body", unquoted(F.col("t"))).withColumn("n_quoted", quoted.cast("long")).drop("t")
    joined = out.join(meta, (F.col("conv_id") == F.col("c2")) & (F.col("turn") == F.col("t2")), "left")
    return joined.select("thread_id", F.coalesce("position", F.lit(1)).cast("long").alias("position"), "conv_id", "turn", "role", "body", "n_quoted", "reply_conv", "reply_turn", F.coalesce("linked", F.lit(False)).alias("linked"))
