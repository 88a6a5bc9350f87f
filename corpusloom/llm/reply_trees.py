"""Reply trees to conversations: self-joins find all root-to-leaf paths, branches are ranked, chosen paths are formatted.

Messages name the message they answer.  Pointers are doubled by joining the table with itself: round k knows the ancestor
2^k steps up and the sum of the scores between, so trees of depth d take log2(d) joins, after which every leaf has the length
and the score of its path.  The best paths of each tree are chosen (Spark keeps the first ranks within each task before it
shuffles), and their messages are found through the same pointers, again in log2(d) joins: a stretch of up to 2^(k+1)
messages becomes two of up to 2^k.  No join is by the tree alone, so a tree with a third of all messages is spread like any
other; only a finished conversation, which is one text, is gathered.  DataFrame operations only.

Template: a turn is its role's opening, its text and its role's closing (MARKS).  Control strings inside a text get one
backslash after their first character, or one more where some are, so what has none is the template's own, and turns() gives
back every role and text exactly.  The loss mask is a list of spans (code points, end exclusive) of the formatted text: the
texts of the roles that are learnt.

Edge cases: a null text or role is an empty one; a null score counts as 0; all messages of a null tree are one tree.  A
parent that is null, or not in the tree, makes a root.  Messages on or below a cycle of parents have no root and so no path.
Rows that repeat an id within a tree are one message, the least by (parent, role, text, score); rows without an id are in no
tree.  Equal scores: the longer path, then the smaller leaf, goes first.  Empty tables give no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_tables, shared_table
from .secrets import _let, _running

#: Opening and closing of the turns of known roles.  The opening of any other names it, with '\', '<' and '>' written as
#: '\b', '\l' and '\g'.
MARKS = {"system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
NAMED, NAMED_END, NAMED_CLOSE = "<<TURN:", ">>\n", "\n<</TURN>>"
ROLE_ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
#: A control string with any number of backslashes after its first character, and one that has some.
CONTROL = r"([<\[])(\\*)(/?s>|</?SYS>>|<TURN:|</TURN>>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|</?SYS>>|<TURN:|</TURN>>|/?INST\])"
#: One turn of a formatted conversation.
TURN = r"(?s)<<SYS>>\n.*?\n<</SYS>>\n\n|\[INST\] .*? \[/INST\]|<s>.*?</s>|<<TURN:[^>]*>>\n.*?\n<</TURN>>"


def escaped(text: Column) -> Column:
    """The text with its control strings made harmless; unescaped() reverses it."""
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"$1\\$2$3"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2$3"))


def _opening(role: Column) -> Column:
    name = role
    for plain, written in ROLE_ESCAPES:
        name = F.replace(name, F.lit(plain), F.lit(written))
    out = F.concat(F.lit(NAMED), name, F.lit(NAMED_END))
    for known, (opening, _) in MARKS.items():
        out = F.when(role == known, F.lit(opening)).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit(NAMED_CLOSE)
    for known, (_, closing) in MARKS.items():
        out = F.when(role == known, F.lit(closing)).otherwise(out)
    return out


def formatted(turns: Column, learnt: tuple[str, ...] = ("assistant",)) -> Column:
    """struct(text, loss) of an array of struct(role, text): the conversation, and the spans of it that bear loss."""
    parts = F.transform(turns, lambda t: F.struct(_opening(t["role"]).alias("a"), escaped(t["text"]).alias("b"), _closing(t["role"]).alias("c"), t["role"].isin(*learnt).alias("learnt")))

    def joined(p: Column) -> Column:
        def spans(ends: Column) -> Column:
            each = F.zip_with(p, ends, lambda x, end: F.struct((end - F.length(x["c"]) - F.length(x["b"])).alias("start"), (end - F.length(x["c"])).alias("end"), x["learnt"].alias("learnt")))
            return F.transform(F.filter(each, lambda x: x["learnt"]), lambda x: F.struct(x["start"], x["end"]))

        text = F.array_join(F.transform(p, lambda x: F.concat(x["a"], x["b"], x["c"])), "")
        ends = _running(F.transform(p, lambda x: F.length(x["a"]) + F.length(x["b"]) + F.length(x["c"])))
        return F.struct(text.alias("text"), _let(ends, spans).alias("loss"))

    return _let(parts, joined)


def turns(text: Column) -> Column:
    """array<struct<role,text>> of a formatted conversation: what formatted() was given."""

    def turn(x: Column) -> Column:
        def between(opening: Column, closing: str) -> Column:
            return unescaped(F.substring(x, F.length(opening) + 1, F.length(x) - F.length(opening) - len(closing)))

        name = F.substring_index(F.substring(x, F.lit(len(NAMED) + 1), F.length(x)), NAMED_END, 1)
        role = name
        for plain, written in reversed(ROLE_ESCAPES):
            role = F.replace(role, F.lit(written), F.lit(plain))
        out = F.struct(role.alias("role"), between(F.concat(F.lit(NAMED), name, F.lit(NAMED_END)), NAMED_CLOSE).alias("text"))
        for known, (opening, closing) in MARKS.items():
            out = F.when(F.startswith(x, F.lit(opening)), F.struct(F.lit(known).alias("role"), between(F.lit(opening), closing).alias("text"))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(text, F.lit(TURN), F.lit(0)), turn)


def loss_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")


def _known(messages: DataFrame) -> DataFrame:
    """One row an id of a tree.  The tree is held in a struct, so that null trees are equal in joins."""
    rest = F.struct("parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    named = messages.select(F.struct(F.col("tree").alias("key")).alias("tree"), "id", rest.alias("rest")).where("id is not null")
    return named.groupBy("tree", "id").agg(F.min("rest").alias("rest")).select("tree", "id", "rest.*")


def paths(known: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(ends, pointers) of rows tree, id, parent, score.

    ends: tree, leaf, length, score (the sum) of every root-to-leaf path.  pointers[k]: tree, id, up (the message 2^k steps
    up), for the messages that have one.
    """
    ids = known.select("tree", F.col("id").alias("up"))
    own = known.select("tree", "id", F.col("parent").alias("up"), "score")
    step = shared_table(own.join(ids, ["tree", "up"], "left_semi").select("tree", "id", "up", "score"), "parents")
    roots = own.join(step, ["tree", "id"], "left_anti").select("tree", "id", F.lit(1).cast("long").alias("length"), "score")
    done, pointers = [shared_table(roots, "roots")], [step]
    while not pointers[-1].isEmpty():
        # Messages whose path has up to 2^k messages are done; the pointers are those of all others.
        left, so_far = pointers[-1], 1 << (len(pointers) - 1)
        ended = _union(done).select("tree", F.col("id").alias("up"), "length", F.col("score").alias("above"))
        now = shared_table(left.join(ended, ["tree", "up"]).select("tree", "id", (F.col("length") + so_far).alias("length"), (F.col("score") + F.col("above")).alias("score")), "paths")
        if now.isEmpty():  # what is left hangs on cycles
            drop_tables(now)
            break
        done.append(now)
        further = left.select("tree", F.col("id").alias("up"), F.col("up").alias("then"), F.col("score").alias("above"))
        pointers.append(shared_table(left.join(further, ["tree", "up"]).select("tree", "id", F.col("then").alias("up"), (F.col("score") + F.col("above")).alias("score")), "pointers"))
    answered = step.select("tree", F.col("up").alias("id"))
    leaves = _union(done).join(answered, ["tree", "id"], "left_anti")
    ends = shared_table(leaves.select("tree", F.col("id").alias("leaf"), "length", "score"), "path-ends")
    drop_tables(*done)
    return ends, pointers


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.union(table)
    return out


def best(ends: DataFrame, top: int) -> DataFrame:
    """The first `top` paths of each tree, with their rank (from 1)."""
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("length"), "leaf")
    return ends.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def members(chosen: DataFrame, pointers: list[DataFrame]) -> DataFrame:
    """tree, leaf, at (from 0, the root), id of every message of the chosen paths."""
    held = chosen.select("tree", "leaf", F.col("leaf").alias("id"), (F.col("length") - 1).alias("at"), F.col("length").alias("size"))
    for k in reversed(range(len(pointers))):
        half = F.lit(1 << k).cast("long")
        whole = F.struct("id", "at", "size")
        lower = F.struct("id", "at", half.alias("size"))
        upper = F.struct(F.col("up").alias("id"), (F.col("at") - half).alias("at"), (F.col("size") - half).alias("size"))
        split = F.when(F.col("size") > half, F.array(lower, upper)).otherwise(F.array(whole))
        held = held.join(pointers[k].select("tree", "id", "up"), ["tree", "id"], "left").select("tree", "leaf", F.explode(split).alias("part")).select("tree", "leaf", "part.*")
    return held.select("tree", "leaf", "at", "id")


def conversations(messages: DataFrame, top: int = 1, learnt: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """From rows tree, id, parent, role, text, score: tree, rank, leaf, score, length, text, loss of the `top` best paths of
    each tree, each formatted as one conversation."""
    known = _known(messages)
    ends, pointers = paths(known.select("tree", "id", "parent", "score"))
    chosen = best(ends, top)
    said = members(chosen, pointers).join(known.select("tree", "id", "role", "text"), ["tree", "id"])
    each = said.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("said"))
    spoken = F.transform("said", lambda x: F.struct(x["role"], x["text"]))
    out = each.select("tree", "leaf", formatted(spoken, learnt).alias("out")).join(chosen, ["tree", "leaf"])
    return out.select("tree.key", "rank", "leaf", "score", "length", "out.text", "out.loss").withColumnRenamed("key", "tree")


def digests(done: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from formatted conversations."""
    read = done.select("tree", "text", turns(F.col("text")).alias("said"), loss_text(F.col("text"), F.col("loss")).alias("learnt"))
    listed = F.array_join(F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("said").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


#: Conversation -1 of the registered query: both turns say what the template says between turns.
PROBE_ID, PROBE = -1, "</s>[INST] ok [/INST]"


def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all conversations, as trees in which every turn answers the one before it."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(PROBE_ID).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PROBE))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    chain = shared_table(given.union(probe).select(F.col("conv_id").alias("tree"), number.alias("id"), "role", "text"), "turns")
    messages = chain.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
    return digests(conversations(messages))
