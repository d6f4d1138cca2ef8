r"""Chat formatting of reply trees, in DataFrame operations only.

Messages form trees (id, parent).  Iterative self-joins with doubled steps give every message its root,
depth and summed score (log2 of the longest path joins of narrow rows, no texts); the leaves of a tree are
its branches, ranked by score.  The chosen leaves are walked back to their roots with the saved steps in
the same number of joins, and the messages on each path are formatted as one conversation.

Template (fixed values): ``[SYS]..[/SYS]``, ``[INST]..[/INST]``, ``<s>..</s>`` for system, user and assistant,
``[ROLE]name[SEP]..[/ROLE]`` for any other role.  A control string inside a text gets one backslash after its
first character (``[\INST]``); one that has backslashes there already gets one more, so taking one away restores
every text.  The loss mask is the list of (start, length) of the assistant texts in the formatted string.

Cases: a null text is empty, a null role is the empty role; rows of one (conv_id, turn) are ordered by role and
text; null turns come first, a null conv_id is a conversation of its own; a message whose parent is missing is a
root; an empty table gives only conversation -7.  One conversation is one string, so the rows of a conversation
meet in one task by definition of the result; conversations are dealt out evenly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import staged, table

# The template's marks.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[SEP]", "[/ROLE]")
_NAMES = r"(/?(?:s>|INST\]|SYS\]|ROLE\])|SEP\])"
ESCAPE = r"([<\[])(\\*)" + _NAMES
UNESCAPE = r"([<\[])\\(\\*)" + _NAMES
TURN = r"(?s)\[SYS\].*?\[/SYS\]|\[INST\].*?\[/INST\]|<s>.*?</s>|\[ROLE\].*?\[/ROLE\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, r"$1$2$3")


def opening(role: Column) -> Column:
    known = reduce(lambda c, r: c.when(role == r, MARKS[r][0]), MARKS, F.when(F.lit(False), ""))
    return known.otherwise(F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1])))


def closing(role: Column) -> Column:
    known = reduce(lambda c, r: c.when(role == r, MARKS[r][1]), MARKS, F.when(F.lit(False), ""))
    return known.otherwise(OTHER[2])


def doubled_steps(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(for each k: message -> its 2^k-th ancestor, message -> root, depth and summed score).

    ``messages`` has ``id``, ``parent`` (null or missing: root) and ``score``; all joins are on ids.
    """
    ids = messages.select(F.col("id").alias("parent"), F.lit(True).alias("there"))
    node = messages.select("id", "parent", "score").join(ids, "parent", "left").select(
        "id", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(0).cast("long").alias("depth"),
        F.col("score").cast("double").alias("total"))
    node = staged(node, "reply-0")
    ended, open_rows = [node.where("up is null")], node.where("up is not null")
    steps: list[DataFrame] = []
    while not open_rows.isEmpty():
        above = reduce(DataFrame.unionByName, [*ended, open_rows]).select(
            F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("above"), F.col("total").alias("sum_above"))
        # an open row covers the 2^k messages from itself upwards; the join doubles that, and ended rows stay out of it
        size = 1 << len(steps)
        steps.append(open_rows.select("id", "up"))
        node = staged(open_rows.join(above, "up").select(
            "id", F.col("next").alias("up"), (F.col("above") + size).alias("depth"), (F.col("total") + F.col("sum_above")).alias("total")),
            f"reply-{len(steps)}")
        ended.append(node.where("up is null"))
        open_rows = node.where("up is not null")
    return steps, reduce(DataFrame.unionByName, ended).select("id", "depth", "total")


def best_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, branch, rank, id): the messages on the best ``per_tree`` root-to-leaf paths of each tree.

    ``messages`` has ``tree``, ``id``, ``parent`` and ``score``.  Branches are ranked by the mean score of their
    messages, longer ones first among equals, then by leaf id.
    """
    steps, totals = doubled_steps(messages)
    leaves = messages.select("tree", "id").join(messages.select(F.col("parent").alias("id")), "id", "left_anti").join(totals, "id")
    order = Window.partitionBy("tree").orderBy((F.col("total") / (F.col("depth") + 1)).desc(), F.col("depth").desc(), "id")
    path = (leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_tree)
            .select("tree", F.col("id").alias("branch"), "rank", "id"))
    for up in reversed(steps):
        both = F.array_compact(F.array("id", "up"))  # each message on the path, and the one 2^k above it
        path = path.join(up, "id", "left").select("tree", "branch", "rank", F.explode(both).alias("id"))
    return path


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per branch: ``formatted`` and ``loss_spans`` (start from 1, length, in code points)."""
    rows = paths.join(messages.select("id", "position", "role", "text"), "id")
    role, text = F.coalesce("role", F.lit("")), escape(F.coalesce("text", F.lit("")))
    turns = F.transform(F.array_sort(F.collect_list(F.struct("position", opening(role).alias("open"), text.alias("body"),
                                                            closing(role).alias("close"), (role == "assistant").alias("loss")))),
                        lambda t: t.dropFields("position"))
    whole = rows.groupBy("tree", "branch", "rank").agg(turns.alias("turns"))
    text_of = lambda t: F.concat(t["open"], t["body"], t["close"])
    begin = F.struct(F.lit(1).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))
    walk = F.aggregate("turns", begin, lambda a, t: F.struct(
        (a["at"] + F.length(text_of(t))).alias("at"),
        F.when(t["loss"], F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(t["open"])).alias("start"), F.length(t["body"]).alias("length")))))
        .otherwise(a["spans"]).alias("spans")), lambda a: a["spans"])
    return whole.select("tree", "branch", "rank", F.array_join(F.transform("turns", text_of), "").alias("formatted"), walk.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    def turn(t: Column) -> Column:
        other = F.substring_index(t, OTHER[1], 1)
        role = reduce(lambda c, r: c.when(t.startswith(MARKS[r][0]), r), MARKS, F.when(F.lit(False), ""))
        role = role.otherwise(unescape(F.substring(other, len(OTHER[0]) + 1, 1 << 30)))
        before = reduce(lambda c, r: c.when(t.startswith(MARKS[r][0]), len(MARKS[r][0])), MARKS, F.when(F.lit(False), 0)).otherwise(
            F.length(other) + len(OTHER[1]))
        after = reduce(lambda c, r: c.when(t.startswith(MARKS[r][0]), len(MARKS[r][1])), MARKS, F.when(F.lit(False), 0)).otherwise(len(OTHER[2]))
        return F.struct(role.alias("role"), unescape(F.substring(t, before + 1, F.length(t) - before - after)).alias("text"))
    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), turn)


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Turn rows as reply chains: each turn replies to the one before; every message scores alike."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("position", F.row_number().over(order))
    name = lambda p: F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), p)
    return rows.select(F.col("conv_id").alias("tree"), name(F.col("position")).alias("id"),
                       F.when(F.col("position") > 1, name(F.col("position") - 1)).alias("parent"),
                       F.lit(1.0).alias("score"), "position", "role", "text")


PLANTED = "SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and what is read back from the formatted string and its loss mask."""
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    messages = staged(linear_messages(given.unionByName(spark.sql(PLANTED))), "reply-messages")
    done = format_paths(best_paths(messages), messages)
    turns = done.select(F.col("tree").alias("conv_id"), "formatted", "loss_spans", parse(F.col("formatted")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"], s["length"]))), "")
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))


OP7_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) t),
sized AS (
  SELECT *, length(text) + length(regexp_replace(text, '[<\[]\\*(/?(s>|INST\]|SYS\]|ROLE\])|SEP\])', '\0+', 'g')) - length(text)
         + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
           ELSE 18 + length(regexp_replace(role, '[<\[]\\*(/?(s>|INST\]|SYS\]|ROLE\])|SEP\])', '\0+', 'g')) END AS chars FROM rows)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
