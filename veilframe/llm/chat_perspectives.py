"""Multi-party perspective rotation: each dialogue once per participant, with that speaker as the assistant.

The other speakers become named users, system turns stay system turns, and the
spans of the text to learn from (the assistant's turns) are returned as a mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.common import saved

END = "<|end|>\n"


def _header(role: Column, name: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.when(name.isNotNull(), F.concat(F.lit(" name="), name)).otherwise(F.lit("")), F.lit("|>\n"))


def _cut(rows: DataFrame, piece_rows: int) -> DataFrame:
    """conv_id, piece, turn, speaker, text: the rows of long conversations, with the number of the piece by position.

    Rows are dealt to ranges in the order of (conv_id, turn, speaker, text), equal rows by a number of their own, so
    no conversation and no repeated row is one task's; a row's position is its place in the range and what lies before.
    """
    order = ["conv_id", "turn", "speaker", "text", "row"]
    numbered = saved(rows.withColumn("row", F.monotonically_increasing_id()))  # written, so that a row keeps its number
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-numbered.count() // (16 * piece_rows)))
    ranged = saved(numbered.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()))
    held = ranged.groupBy("conv_id", "range").count()  # a row for each range and conversation in it
    before = F.sum("count").over(Window.partitionBy("conv_id").orderBy("range")) - F.col("count")
    starts = held.select(F.col("conv_id").alias("c"), F.col("range").alias("r"), before.alias("before"))
    placed = ranged.withColumn("place", F.row_number().over(Window.partitionBy("conv_id", "range").orderBy("turn", "speaker", "text", "row")) - 1)
    joined = placed.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")))
    return joined.select("conv_id", F.floor((F.col("before") + F.col("place")) / piece_rows).alias("piece"), "turn", "speaker", "text")


def rotate(turns: DataFrame, piece_rows: int = 4096, system: str = "system") -> DataFrame:
    """conv_id, piece, perspective, text, spans, n_messages of every conversation and participant.

    ``turns`` (conv_id, turn, role, text; further columns are ignored); role names the speaker.
    Messages are in order of turn, then role, then text. Piece p of a conversation holds its
    messages from p * piece_rows on, so one of any length is a series of bounded rows whose
    texts, in order of piece, make the whole. Participants come from the whole conversation,
    so each has every piece.

    ``spans`` lists [start, end) in code points of ``text``: what the assistant says, with the
    end marker. Null conv_ids make one conversation of their own; a null turn counts as before
    all others, a null or empty role as "unknown", a null text as "". Repeated rows are
    repeated in the text. A conversation of system turns alone has no participant and no row;
    an empty table gives no rows.
    """
    role = F.coalesce(F.nullif(F.col("role"), F.lit("")), F.lit("unknown"))
    rows = turns.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("speaker"), F.coalesce("text", F.lit("")).alias("text"),
    )
    long = saved(rows.groupBy("conv_id").count().where(F.col("count") > piece_rows).select(F.col("conv_id").alias("c")))
    is_long = F.col("conv_id").eqNullSafe(F.col("c"))
    placed = rows.join(long, is_long, "left_anti").withColumn("piece", F.lit(0).cast("long"))
    if not long.isEmpty():
        placed = placed.unionByName(_cut(rows.join(long, is_long, "left_semi"), piece_rows))
    parts = placed.groupBy("conv_id", "piece").agg(F.sort_array(F.collect_list(F.struct("turn", "speaker", "text"))).alias("messages"))
    people = rows.where(F.col("speaker") != system).select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    each = parts.join(people, F.col("conv_id").eqNullSafe(F.col("c")))

    def message(m: Column) -> Column:
        own = m["speaker"] == F.col("perspective")
        kind = F.when(m["speaker"] == system, F.lit("system")).when(own, F.lit("assistant")).otherwise(F.lit("user"))
        name = F.when((m["speaker"] != system) & ~own, m["speaker"])
        return F.struct(_header(kind, name).alias("head"), F.concat(m["text"], F.lit(END)).alias("body"), own.alias("own"))

    def grow(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["head"])
        end = start + F.length(m["body"])
        return F.struct(
            end.alias("at"),
            F.when(m["own"], F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(state["spans"]).alias("spans"),
        )

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return each.withColumn("rendered", F.transform("messages", message)).select(
        "conv_id", "piece", "perspective",
        F.array_join(F.transform("rendered", lambda m: F.concat(m["head"], m["body"])), "").alias("text"),
        F.aggregate("rendered", empty, grow)["spans"].alias("spans"),
        F.size("rendered").alias("n_messages"),
    )
