"""Chat formatting: link quotations to the messages they come from, and order replies without them.

A line's quote level is the number of `>` it starts with. A passage is a run of consecutive lines of one
level of at least 1; blank lines end it. Passages are compared after lower-casing and joining their words with
single spaces. A message offers its own lines (level 0), its own paragraphs, and all of its own text;
a passage comes from the first message of the conversation that offered it, if that came before.
Lines of longer passages vote too, so a passage cut short still finds its message.

A message replies to the origin of most of what it quotes at level 1, or else to the message
before it. Conversations are ordered as trees of replies, depth first: a message is followed by the
replies to it, by turn, each with all that replies to it in turn.

All steps are column expressions and joins. A conversation is never gathered: order and neighbours come
from a global index that is dealt by ranges, and the tree order from ranking the list of its steps,
where every round doubles how far a step looks ahead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partload.llm.common import dense_index, let
from partload.sources import storage

_NO_ID = -(1 << 63)

_PREFIX = r"'^[ \\t]*(>[> \\t]*)'"
_LINE = f"""named_struct(
    'level', length(regexp_replace(regexp_extract(l, {_PREFIX}, 1), '[^>]', '')),
    'raw', l,
    'words', trim(regexp_replace(lower(regexp_replace(l, {_PREFIX}, '')), '\\\\s+', ' ')))"""
_LINES = f"transform(split(replace(text, '\\r', ''), '\\n'), l -> {_LINE})"


def _edges(end: str, near: str) -> str:
    """Places j of lines that are not blank and whose neighbour `near` is not of their passage; `end` has none."""
    same = f"all[{near}].words <> '' AND all[{near}].level = l.level"
    return f"""filter(transform(all, (l, j) -> IF(l.words <> '' AND ({end} OR NOT ({same})), j, NULL)),
        j -> j IS NOT NULL)"""


# Passages are runs of consecutive lines of one level without a blank one. Where they start and where they end
# are two lists of equal length. The lines are bound to a name before their neighbours are looked up, so that
# they are split once, wherever Spark puts the expression.
_PASSAGES = let("all", "lines", f"""zip_with({_edges('j = 0', 'j - 1')}, {_edges('j + 1 = size(all)', 'j + 1')},
    (a, b) -> named_struct('level', all[a].level,
        'lines', transform(slice(all, a + 1, b - a + 1), l -> l.words)))""")

# Own lines, without a line that introduces the quotation below it.
_OWN = let("all", "lines", """filter(all, (l, i) -> l.level = 0 AND NOT (
    rlike(l.words, '(wrote|writes|said):$') AND i + 1 < size(all) AND all[i + 1].level > 0))""")


def parsed(messages: DataFrame) -> DataFrame:
    """Adds lines, passages and clean: the own text without quotations."""
    out = messages.withColumn("lines", F.expr(_LINES)).withColumn("passages", F.expr(_PASSAGES))
    clean = F.regexp_replace(F.expr(f"array_join(transform({_OWN}, l -> l.raw), '\\n')"), r"^\s*\n", "")
    return out.withColumn("clean", F.rtrim(clean, F.lit(" \t\n\x0b\f\r")))


def _offers(rows: DataFrame) -> DataFrame:
    """(conv, hash, origin): the first place at which a conversation offers a text."""
    whole = F.expr(f"array_join(filter(transform({_OWN}, l -> l.words), w -> w <> ''), ' ')")
    own = F.expr("filter(passages, p -> p.level = 0)")
    texts = F.concat(
        F.array(whole),
        F.transform(own, lambda p: F.array_join(p["lines"], " ")),
        F.flatten(F.transform(own, lambda p: p["lines"])),
    )
    return (
        rows.select("conv", "place", F.explode(F.array_distinct(texts)).alias("words"))
        .where("words <> ''")
        .groupBy("conv", F.xxhash64("words").alias("hash"))
        .agg(F.min("place").alias("origin"))
    )


def _quoted(rows: DataFrame) -> DataFrame:
    """(conv, place, passage, level, hash, weight): what each quoted passage may be found by."""
    one = rows.select("conv", "place", F.posexplode("passages").alias("passage", "p")).where("p.level > 0")
    one = one.select("conv", "place", "passage", F.col("p.level").alias("level"), F.col("p.lines").alias("lines"))
    whole = F.struct(F.array_join("lines", " ").alias("words"), F.size("lines").alias("weight"))
    lines = F.transform("lines", lambda w: F.struct(w.alias("words"), F.lit(1).alias("weight")))
    votes = F.when(F.size("lines") > 1, F.concat(F.array(whole), lines)).otherwise(F.array(whole))
    return one.select("conv", "place", "passage", "level", F.explode(votes).alias("v")).select(
        "conv", "place", "passage", "level", F.xxhash64("v.words").alias("hash"), "v.weight"
    )


def _best(votes: DataFrame, keys: list[str]) -> DataFrame:
    """The origin with most votes for each key; the latest of equals."""
    sums = votes.groupBy(*keys, "origin").agg(F.sum("weight").alias("votes"))
    return sums.groupBy(*keys).agg(F.max(F.struct("votes", "origin"))["origin"].alias("origin"))


def _tree_order(replies: DataFrame) -> DataFrame:
    """(place, after): how many messages of its conversation stand at or after each, depth first.

    replies has place and reply_to. Each message is entered (step 2 * place) and left (step 2 * place + 1);
    entering leads to the first reply or else to leaving, leaving to the next reply to the
    same message or else to leaving that one.
    """
    among = dense_index(replies.where("reply_to IS NOT NULL"), ["reply_to", "place"], "at")
    among = storage.materialise(among.select("reply_to", "place", "at"), "replies")
    first = among.groupBy(F.col("reply_to").alias("place")).agg(F.min("place").alias("child"))
    following = among.select(
        (F.col("at") - 1).alias("at"), F.col("reply_to").alias("_to"), F.col("place").alias("sibling")
    )
    siblings = among.join(following, "at").where("reply_to = _to").select("place", "sibling")
    steps = replies.join(first, "place", "left").join(siblings, "place", "left")
    leave = 2 * F.col("place") + 1
    enter = F.struct(
        (2 * F.col("place")).alias("step"), F.coalesce(2 * F.col("child"), leave).alias("next"),
        F.lit(1).cast("long").alias("n"),
    )
    out = F.struct(
        leave.alias("step"), F.coalesce(2 * F.col("sibling"), 2 * F.col("reply_to") + 1).alias("next"),
        F.lit(0).cast("long").alias("n"),
    )
    steps = storage.materialise(steps.select(F.inline(F.array(enter, out))), "steps")
    while not steps.where("next IS NOT NULL").isEmpty():
        ahead = steps.select(
            F.col("step").alias("next"), F.col("next").alias("_next"), F.col("n").alias("_n")
        )
        steps = storage.materialise(
            steps.join(ahead, "next", "left").select(
                "step", F.col("_next").alias("next"), (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n")
            ),
            "steps",
        )
    return steps.where("step % 2 = 0").select((F.col("step") / 2).cast("long").alias("place"), F.col("n").alias("after"))


def link_quotations(messages: DataFrame) -> DataFrame:
    """One row for each message (conv_id, turn, role, text), to be read in reply_index order:

    conv_id, turn, role, clean (own text without quotations and the lines that introduce them),
    levels (deepest quote level), passages and linked (quoted passages, and those found),
    reply_to (turn it replies to; null for the first message), reply_index (place in the
    conversation, from 0).

    A null conv_id is a conversation; null turns come first; messages of equal turn go by role and
    text. Null text is empty. A message of nothing but quotations has an empty clean text. Other
    columns are not looked at.
    """
    rows = messages.select(
        F.coalesce("conv_id", F.lit(_NO_ID)).alias("conv"), "conv_id", "turn", "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    placed = storage.materialise(dense_index(rows, ["conv", "turn", "role", "text"], "place"), "placed")
    rows = parsed(placed)
    votes = (
        _quoted(rows).join(_offers(rows), ["conv", "hash"]).where("origin < place")
        .select("conv", "place", "passage", "level", "origin", "weight")
    )
    votes = storage.materialise(votes, "votes")
    found = votes.groupBy("place", "passage").agg(F.count(F.lit(1))).groupBy("place").agg(
        F.count(F.lit(1)).alias("linked")
    )
    reply = _best(votes.where("level = 1"), ["place"]).withColumnRenamed("origin", "quotes")
    ends = placed.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.when(F.col("place") > F.col("first"), F.col("place") - 1)
    base = (
        rows.select(
            "place", "conv", "conv_id", "turn", "role", "clean",
            F.expr("coalesce(array_max(transform(lines, l -> l.level)), 0)").alias("levels"),
            F.expr("size(filter(passages, p -> p.level > 0))").alias("passages"),
        )
        .join(ends, "conv")
        .join(found, "place", "left")
        .join(reply, "place", "left")
        .withColumn("reply_to", F.coalesce("quotes", before))
    )
    base = storage.materialise(base, "messages")
    # Where every message replies to the one before, the order is that of the turns.
    branched = base.where("reply_to < place - 1").select("conv").distinct()
    replies = base.join(branched, "conv", "left_semi").select("place", "reply_to")
    order = _tree_order(storage.materialise(replies, "branched"))
    to = placed.select(F.col("place").alias("reply_to"), F.col("turn").alias("to_turn"))
    straight = F.col("n") - (F.col("place") - F.col("first"))
    return (
        base.join(order, "place", "left").join(to, "reply_to", "left")
        .select(
            "conv_id", "turn", "role", "clean", "levels", "passages",
            F.coalesce("linked", F.lit(0)).cast("int").alias("linked"),
            F.col("to_turn").alias("reply_to"),
            (F.col("n") - F.coalesce("after", straight)).alias("reply_index"),
        )
    )


def chat_text(role: str = "role", clean: str = "clean") -> Column:
    """A message as a chat turn; null roles are `unknown`."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), F.col(clean), F.lit("\n"))
