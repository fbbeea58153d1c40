"""Chat history rule (W4): keep the last n messages of each conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed value: history length kept by the chat page ----
HISTORY_MESSAGES = 8
# ---- end of fixed values ----


def last_turns(conversations: DataFrame, n: int = HISTORY_MESSAGES) -> DataFrame:
    """``row_number() <= n`` over turns, newest first; Spark cuts each
    conversation to n rows per task before the shuffle (WindowGroupLimit)."""
    newest_first = Window.partitionBy("conv_id").orderBy(
        F.desc("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")
    )
    return (
        conversations.withColumn("rn", F.row_number().over(newest_first))
        .filter(F.col("rn") <= n)
        .drop("rn")
    )
