"""Chat messages without quotes, linked to the messages that they quote.

Lines are parsed into quote levels by their leading marks; quoted passages, joined over
their line breaks, and as a second chance single lines are normalised, hashed and joined,
as of their own turn, to the latest earlier message of the conversation that wrote them. A
message answers the message it quotes most, else the one before it. From the answers each
conversation is put in reply order: every message is followed by its answers, and theirs,
before its next neighbour. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.asof import latest_before
from merchlens.llm.tables import stored

MARKS = r"^(?:[\x20\t]*>)+[\x20\t]?"
#: A line that names the writer of the quote below it.
ATTRIBUTION = r"(?i)^\s*\S.{0,200}\b(?:wrote|writes|said|schrieb|escribió|a écrit)\s*:\s*$"
#: Messages in one row of a formatted conversation.
PART = 64


def normalised(line: Column) -> Column:
    """A line without case, marks of stress and differences of white space."""
    plain = F.regexp_replace(F.lower(line), r"[*_`~]+", "")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def parsed_lines(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, message, no, level, line, hash, passage, first, start``: one row
    per line.

    ``level`` counts the leading ``>`` marks; ``hash`` is null for blank lines.
    ``passage`` is the hash of the line's passage, null for blank lines: consecutive
    lines of one level without a blank one, joined, so that it does not depend on where
    lines were wrapped. ``first`` marks the passage's first line, ``start`` is its
    number. A line that names the writer of the quote right below it counts as a blank
    line of that quote.
    """
    key = ["conv_id", "turn", "message"]
    # Each generator keeps what it makes from being worked out once per line again.
    raw = F.split("text", "\r?\n", -1)
    marks = F.transform(raw, lambda x: F.struct(x.alias("raw"), F.regexp_extract(x, MARKS, 0).alias("marks")))
    rows = messages.select(*key, F.explode(F.array(marks)).alias("marked"))
    split = F.transform(
        "marked",
        lambda x: F.struct(
            F.length(F.regexp_replace(x["marks"], "[^>]", "")).alias("level"),
            F.regexp_replace(x["raw"], MARKS, "").alias("line"),
            normalised(F.regexp_replace(x["raw"], MARKS, "")).alias("norm"),
        ),
    )
    rows = rows.select(*key, F.explode(F.array(split)).alias("lines"))

    def attributed(x: Column, i: Column) -> Column:
        below = F.get("lines", i + 1)["level"]
        names = (below > x["level"]) & x["line"].rlike(ATTRIBUTION)
        blank = F.struct(below.alias("level"), F.lit("").alias("line"), F.lit("").alias("norm"))
        return F.when(names, blank).otherwise(x)

    rows = rows.select(*key, F.explode(F.array(F.transform("lines", attributed))).alias("lines"))

    def begins(i: Column) -> Column:
        now, before = F.get("lines", i), F.get("lines", i - 1)
        same = (now["level"] == before["level"]) & (now["norm"] != "") & (before["norm"] != "")
        return (i == 0) | ~same

    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), begins)
    rows = rows.select(*key, "lines", F.explode(F.array(starts)).alias("starts"))
    rows = rows.select(*key, "lines", "starts", F.posexplode("starts").alias("k", "start"))
    stop = F.coalesce(F.get("starts", F.col("k") + 1), F.size("lines"))
    rows = rows.select(
        *key, "start", F.explode(F.array(F.slice("lines", F.col("start") + 1, stop - F.col("start")))).alias("lines")
    )
    whole = normalised(F.concat_ws(" ", F.transform("lines", lambda x: x["line"])))
    rows = rows.select(
        *key, "start", F.when(whole != "", F.xxhash64(whole)).alias("passage"), F.posexplode("lines").alias("k", "x")
    )
    return rows.select(
        *key,
        (F.col("start") + F.col("k")).alias("no"),
        "x.level",
        "x.line",
        F.when(F.col("x.norm") != "", F.xxhash64("x.norm")).alias("hash"),
        "passage",
        (F.col("k") == 0).alias("first"),
        "start",
    )


def _messages(chats: DataFrame) -> DataFrame:
    """Distinct messages; ``message`` tells those of one turn apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = chats.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), text.alias("text")
    ).distinct()
    return stored(rows.withColumn("message", F.xxhash64("role", "text")), "messages")


def linked_messages(chats: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, turn, message, role, body, n_quoted, n_matched, reply_to,
    reply_message``.

    ``message`` tells messages of one turn apart, ``reply_message`` those of ``reply_to``.
    ``body`` is the text without quoted lines and without blank lines at its ends.
    ``reply_to`` is the turn of the earlier message that holds most of the lines quoted
    at the lowest level (the later one of equals), else of the latest earlier message;
    null for the first of a conversation. A message whose quotes match nothing falls back
    to the one before it. Rows that repeat conversation, turn, role and text are one
    message. Null texts are empty; messages without conversation or turn answer nothing.
    """
    messages = _messages(chats)
    lines = stored(parsed_lines(messages), "chat-lines")
    quotes = lines.where("level > 0 AND hash IS NOT NULL")
    own = lines.where("level = 0 AND hash IS NOT NULL")
    nothing = F.lit(None).cast("struct<turn:bigint,message:bigint>")
    whole = F.struct(F.lit(True).alias("whole"), F.col("passage").alias("hash"))
    single = F.struct(F.lit(False).alias("whole"), "hash")
    # The first line of a passage stands for all of it.
    wanted = F.explode(F.when(F.col("first"), F.array(whole, single)).otherwise(F.array(single)))
    quotes = quotes.select("conv_id", "turn", "message", "no", "level", "start", wanted.alias("x"))
    quotes = quotes.select("conv_id", "x.hash", "x.whole", "turn", "message", "no", "level", "start")
    asked = quotes.withColumn("found", nothing)
    offers = own.select("conv_id", "turn", "message", wanted.alias("x")).select(
        "conv_id",
        "x.hash",
        "x.whole",
        "turn",
        F.lit(None).cast("long").alias("message"),
        F.lit(None).cast("int").alias("no"),
        F.lit(None).cast("int").alias("level"),
        F.lit(None).cast("int").alias("start"),
        F.struct("turn", "message").alias("found"),
    )
    # Only passages and lines that somebody quotes are looked up.
    looked_up = ["conv_id", "hash", "whole"]
    offers = offers.join(quotes.select(*looked_up).distinct(), looked_up, "left_semi")
    met = latest_before(asked.unionByName(offers), looked_up, "turn", "found")
    met = met.where("level IS NOT NULL")
    # A line counts for the message that wrote its passage, else for the one that wrote it.
    passage = Window.partitionBy("conv_id", "turn", "message", "start")
    met = met.withColumn("passage", F.max(F.when(F.col("whole"), F.col("found"))).over(passage))
    met = met.where("NOT whole").withColumn("found", F.coalesce("passage", "found"))
    key = ["conv_id", "turn", "message"]
    totals = met.groupBy(*key).agg(
        F.count("*").alias("n_quoted"), F.count("found").alias("n_matched")
    )
    votes = met.where("found IS NOT NULL").groupBy(*key, "level", "found").agg(F.count("*").alias("n"))
    best = votes.groupBy(*key).agg(
        F.max(F.struct((-F.col("level")).alias("near"), "n", "found")).alias("best")
    )
    before = latest_before(
        messages.select(*key, F.struct("turn", "message").alias("previous")), ["conv_id"], "turn", "previous"
    )
    bodies = _bodies(lines)
    out = messages.select(*key, "role")
    for part in (before, bodies, totals, best):
        out = _left(out, part, key)
    answered = F.coalesce("best.found", "previous")
    return out.select(
        "conv_id",
        "turn",
        "message",
        "role",
        F.coalesce("body", F.lit("")).alias("body"),
        F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce("n_matched", F.lit(0)).cast("long").alias("n_matched"),
        answered["turn"].alias("reply_to"),
        answered["message"].alias("reply_message"),
    )


def _left(rows: DataFrame, part: DataFrame, key: list[str]) -> DataFrame:
    names = {c: f"__{c}" for c in key}
    part = part.withColumnsRenamed(names)
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(names[c]))
    return rows.join(part, same, "left").drop(*names.values())


def _bodies(lines: DataFrame) -> DataFrame:
    """A message's lines outside quotes, in order."""
    own = F.when(F.col("level") == 0, F.struct("no", "line"))
    text = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(own)), lambda x: x["line"]))
    body = F.regexp_replace(text, r"^\s+|\s+$", "")
    return lines.groupBy("conv_id", "turn", "message").agg(body.alias("body"))


def placed(linked: DataFrame) -> DataFrame:
    """``linked`` with ``depth`` and ``position`` of each message in its conversation.

    A message that answers nothing has depth 0, an answer one more than what it answers.
    ``position`` counts from 0 in reply order: a message, then its answers from the
    earliest turn on, each followed by its own. Messages without conversation or turn have
    depth 0 and no position.

    The order is a walk that enters and leaves every message. Each step knows the next
    one, and steps learn in rounds of doubled distance how much of the walk is left, so no
    task holds a conversation and a chain of n answers takes about log n rounds.
    """
    named = linked.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    keys = ["conv_id", "turn", "message"]
    # Numbers that rise with turn and message, so they order a message's answers.
    numbered = named.select(*keys, "reply_to", "reply_message").repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = stored(numbered.withColumn("no", F.monotonically_increasing_id()), "chat-numbers")
    parents = numbered.select(
        "conv_id", F.col("turn").alias("reply_to"), F.col("message").alias("reply_message"), F.col("no").alias("up")
    )
    nodes = numbered.join(parents, ["conv_id", "reply_to", "reply_message"], "left").select(
        "conv_id", "no", F.coalesce("up", F.lit(-1)).alias("up")
    )
    nodes = stored(nodes, "chat-nodes")
    # The neighbour after a message is the nearest greater number below the same parent.
    sides = nodes.select("conv_id", "no", "up", (-F.col("no")).alias("at"))
    after = latest_before(
        sides.withColumn("after", F.struct("at")), ["conv_id", "up"], "at", "after"
    ).select("no", "up", (-F.col("after.at")).alias("next"))
    first = nodes.where("up >= 0").groupBy("up").agg(F.min("no").alias("child"))
    first = first.withColumnRenamed("up", "no")
    walk = after.join(first, "no", "left")
    enter, leave = 2 * F.col("no"), 2 * F.col("no") + 1
    up = F.when(F.col("up") >= 0, 2 * F.col("up") + 1)
    steps = walk.select(
        F.explode(
            F.array(
                F.struct(
                    enter.alias("step"), F.coalesce(2 * F.col("child"), leave).alias("next"),
                    F.lit(1).cast("long").alias("left"), F.lit(1).cast("long").alias("deep"),
                ),
                F.struct(
                    leave.alias("step"), F.coalesce(2 * F.col("next"), up).alias("next"),
                    F.lit(0).cast("long").alias("left"), F.lit(-1).cast("long").alias("deep"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    steps = stored(steps, "chat-steps")
    while steps.where("next IS NOT NULL").limit(1).count():
        on = steps.select(
            F.col("step").alias("next"), F.col("next").alias("then"),
            F.col("left").alias("more"), F.col("deep").alias("deeper"),
        )
        done = steps.where("next IS NULL")
        going = steps.where("next IS NOT NULL").join(on, "next").select(
            "step", F.col("then").alias("next"), (F.col("left") + F.col("more")).alias("left"),
            (F.col("deep") + F.col("deeper")).alias("deep"),
        )
        steps = stored(done.union(going), "chat-steps")
    places = steps.where("step % 2 = 0").select(
        F.floor(F.col("step") / 2).alias("no"), (-F.col("deep")).alias("depth"), "left"
    )
    sizes = numbered.groupBy("conv_id").agg(F.count("*").alias("n"))
    places = numbered.select(*keys, "no").join(places, "no").join(sizes, "conv_id").select(
        *keys, "depth", (F.col("n") - F.col("left")).alias("position")
    )
    out = _left(linked, places, keys)
    return out.withColumn("depth", F.coalesce("depth", F.lit(0).cast("long")))


def conversations(chats: DataFrame, part: int = PART) -> DataFrame:
    """``conv_id, part, messages``: a conversation's messages in reply order, without quotes.

    Rows hold ``part`` messages (``turn, role, body, depth, reply_to``) each, so a long
    conversation is many rows. Messages without conversation or turn are in none.
    """
    rows = placed(linked_messages(chats)).where("position IS NOT NULL")
    one = F.struct("position", "turn", "role", "body", "depth", "reply_to")
    rows = rows.groupBy("conv_id", F.floor(F.col("position") / part).alias("part"))
    ordered = F.transform(F.array_sort(F.collect_list(one)), lambda m: m.dropFields("position"))
    return rows.agg(ordered.alias("messages"))


def with_quotes(chats: DataFrame) -> DataFrame:
    """The messages, every third of which quotes the whole message two turns before it."""
    earlier = chats.select(
        F.col("conv_id").alias("c"), (F.col("turn") + 2).alias("t"), F.col("text").alias("quoted")
    ).where("t % 3 = 2").groupBy("c", "t").agg(F.max("quoted").alias("quoted"))
    joined = chats.join(earlier, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    quote = F.concat(F.lit("> "), F.regexp_replace("quoted", "\n", "\n> "), F.lit("\n"), F.coalesce("text", F.lit("")))
    text = F.when(F.col("quoted").isNotNull(), quote).otherwise(F.col("text"))
    return joined.select("conv_id", "turn", "role", text.alias("text"))
