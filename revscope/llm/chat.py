"""Operator 6, chat formatting in budgeted windows (DataFrame functions only).

Template.  A turn is ``<turn ROLE>``, a line feed, its text, ``</turn>`` and a
line feed (``<turn>`` where the role is null).  Inside roles and texts a
backslash, ``<`` and ``>`` are written ``\\b``, ``\\l`` and ``\\g``, so neither
occurs but as a mark, and the way back is exact.

Method: prefix sums of turn tokens (words and signs, and ``OVERHEAD`` a turn)
cut a conversation into spans of whole turns: a turn belongs to the stride its
prefix sum falls in, and one that crosses the stride's end stands in a window
of its own.  A window retains the conversation's opening system turn, repeats
the last turns before it up to ``history`` tokens, and adds its own.  The loss
mask covers the assistant texts that are the window's own; repeated ones are
masked.  A window holds at most ``budget`` tokens, but for one whose single own
turn is longer than the room.

Sums and history are window frames over a conversation's turns, which Spark
sorts and spills; a window's rows are bounded by the budget.  Only the digests
of a whole conversation, which need its text in one place, gather it.

Defined cases: null text counts as empty; turns of equal number are ordered by
role and text, repeated rows each count; null conversation ids are one
conversation; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revscope.llm._common import pick

BUDGET, HISTORY, SYSTEM, OVERHEAD = 1024, 192, 256, 4
#: A word (a run without ASCII signs or white space) or an ASCII sign.
TOKEN = r"[^\x00-\x20!-/:-@\[-`{-\x7F]+|[!-/:-@\[-`{-~]"
END = "</turn>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def _opening(role: Column) -> Column:
    return F.concat(F.lit("<turn"), F.coalesce(F.concat(F.lit(" "), escaped(role)), F.lit("")), F.lit(">\n"))


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, system: int = SYSTEM) -> DataFrame:
    """One row per window: conv_id, window, formatted, repeated (leading turns that are not
    its own), tokens, loss (start and length of each part under the loss mask, in code points).

    ``system``: tokens set aside for the system turn; a longer one is retained all the same.
    """
    stride = budget - history - system
    turns = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text").select(
        "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")
    )
    turns = turns.withColumn("tokens", (F.regexp_count("text", F.lit(TOKEN)) + OVERHEAD).cast("long"))
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumn("pos", F.row_number().over(ordered)).withColumn("end", F.sum("tokens").over(running))
    turns = turns.withColumn("start", F.col("end") - F.col("tokens"))
    by_pos = Window.partitionBy("conv_id").orderBy("pos")
    # the opening turn, if it is a system turn; not repeated as history as well
    opening = F.first(F.when((F.col("pos") == 1) & (F.col("role") == "system"), F.struct("role", "text", "tokens"))).over(
        by_pos.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    span = F.floor(F.col("start") / stride)
    crosses = (F.col("end") > (span + 1) * stride) & (F.lag(span).over(by_pos) == span)
    turns = turns.withColumn("span", span).withColumn("apart", F.coalesce(crosses, F.lit(False)))
    first = F.coalesce(
        (F.lag("span").over(by_pos) != F.col("span")) | (F.lag("apart").over(by_pos) != F.col("apart")), F.lit(True)
    )
    is_system = (F.col("pos") == 1) & (F.col("role") == "system")
    turn = F.when(~is_system, F.struct("pos", "role", "text", "tokens"))
    near = Window.partitionBy("conv_id").orderBy("start").rangeBetween(-history, -1)
    marked = turns.withColumn("opening", opening).withColumn("first", first).withColumn("before", F.collect_list(turn).over(near))
    windows = marked.groupBy("conv_id", "span", "apart").agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "text", "tokens"))).alias("own"),
        F.first(F.when(F.col("first"), F.col("before")), ignorenulls=True).alias("before"),
        F.first("opening", ignorenulls=True).alias("opening"),
    )
    bare = lambda own: lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"), x["tokens"].alias("tokens"), F.lit(own).alias("own"))
    kept = F.when(F.col("opening").isNotNull() & (F.get("own", F.lit(0))["pos"] > 1), F.array(bare(False)(F.col("opening")))).otherwise(F.array())
    past = F.transform(F.array_sort("before"), bare(False))
    rows = windows.select("conv_id", "span", "apart", F.concat(kept, past, F.transform("own", bare(True))).alias("turns"), (F.size(kept) + F.size(past)).alias("repeated"))
    opened = F.transform("turns", lambda x: F.struct(_opening(x["role"]).alias("head"), escaped(x["text"]).alias("body"), (x["own"] & F.coalesce(x["role"] == "assistant", F.lit(False))).alias("loss"), x["tokens"].alias("tokens")))
    rows = rows.withColumn("turns", opened)
    place = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.length(x["head"])
        size = F.length(x["body"])
        out = F.when(x["loss"], F.concat(s["out"], F.array(F.struct(begin.alias("start"), size.alias("length"))))).otherwise(s["out"])
        return F.struct((begin + size + len(END)).alias("at"), out.alias("out"))

    return rows.select(
        "conv_id",
        F.struct("span", "apart").alias("window"),
        F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("formatted"),
        "repeated",
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, x: n + x["tokens"]).alias("tokens"),
        F.aggregate("turns", place, step, lambda s: s["out"]).alias("loss"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Back from ``chat_windows``: one row per conversation with its turns, loss texts and size."""
    pieces = F.split("formatted", END, -1)
    own = F.slice(pieces, F.col("repeated") + 1, F.size(pieces) - 1 - F.col("repeated"))
    head = lambda x: F.substring_index(x, ">\n", 1)
    parsed = F.transform(
        own,
        lambda x: F.struct(
            F.when(F.length(head(x)) > 5, unescaped(F.substring(head(x), 7, F.length(x)))).alias("role"),
            unescaped(F.substring(x, F.length(head(x)) + 3, F.length(x))).alias("text"),
        ),
    )
    masked = F.array_join(F.transform("loss", lambda x: unescaped(F.substring(F.col("formatted"), x["start"] + 1, x["length"]))), "")
    rows = windows.select("conv_id", "window", parsed.alias("turns"), masked.alias("loss"), F.length("formatted").cast("long").alias("chars"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    return grouped.select("conv_id", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"), F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss"), "formatted_chars")


def chat_digests(conversations: DataFrame, **options: int) -> DataFrame:
    """The digest of each conversation as read back from its windows."""
    back = read_windows(chat_windows(conversations, **options))
    whole = F.array_join(F.transform("turns", lambda x: F.concat(F.coalesce(x["role"], F.lit("")), F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def oracle(extra: str, budget: int = BUDGET, history: int = HISTORY, system: int = SYSTEM) -> str:
    """DuckDB SQL for ``chat_digests`` of ``conversations`` and the rows of ``extra``, counting
    the formatted characters from the windows' sizes."""
    stride = budget - history - system
    return f"""
WITH turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL {extra}),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
                  len(regexp_extract_all(text, '{TOKEN}')) + {OVERHEAD} AS tokens,
                  7 + coalesce(1 + length(role), 0) + length(text) + length(regexp_replace(text, '[^\\\\<>]', '', 'g')) + 8 AS size FROM turns),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos) AS stop FROM placed),
spans AS (SELECT *, stop - tokens AS start, (stop - tokens) // {stride} AS span FROM summed),
apart AS (SELECT *, coalesce(stop > (span + 1) * {stride} AND lag(span) OVER (PARTITION BY conv_id ORDER BY pos) = span, false) AS apart FROM spans),
firsts AS (SELECT *, coalesce(lag(span) OVER o <> span OR lag(apart) OVER o <> apart, true) AS opens,
                  coalesce(sum(CASE WHEN pos = 1 AND role = 'system' THEN 0 ELSE size END) OVER (PARTITION BY conv_id ORDER BY start RANGE BETWEEN {history} PRECEDING AND 1 PRECEDING), 0) AS before,
                  first_value(CASE WHEN role = 'system' THEN size ELSE 0 END) OVER o AS opening
           FROM apart WINDOW o AS (PARTITION BY conv_id ORDER BY pos))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(size) + sum(CASE WHEN opens THEN before + CASE WHEN pos > 1 THEN opening ELSE 0 END ELSE 0 END))::BIGINT AS formatted_chars
FROM firsts GROUP BY conv_id
"""
