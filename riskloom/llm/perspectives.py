"""Multi-party dialogues rendered once per participant. DataFrame functions only.

Every speaker but ``system`` is a participant. In a participant's rendering that speaker is the assistant, the others are
users with their role as name, and system turns stay system turns. ``mask`` holds the spans (code points, end exclusive) of the
assistant's texts with the marker that ends each, which are what a model learns from. Markers inside a text or a role are broken by backslashes
(``<\\|im_end\\|>``), and line feeds inside a role become spaces, so that nothing said opens a turn.

Turns go by (turn, role, the first HEAD code points of the text, its md5), nulls last. A dialogue of more than PART turns is delivered in consecutive
parts, each a row, so that a row never grows with a dialogue. Places are counted over the whole table in that order: rows are put
into ranges of the order, with equal rows told apart by a number, and stored; the sizes of the ranges and the first place of each dialogue do
the rest. So a dialogue that holds most rows, also one of null or repeated turns, is spread over many tasks.
A null role is the participant ``unknown``, a null text is empty, rows without conv_id are one dialogue of their own, repeated rows are
repeated turns. A dialogue with system turns only has no rendering; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

PART = 64
HEAD = 64
OPEN, BREAK, CLOSE, END = "<|im_start|>", "\n", "<|im_end|>", "\n"
# Low bits of the numbers that Spark gives to rows in order: the place inside a partition.
LOW = 33


def _broken(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(im_start|im_end)\|>", r"<\\|$1\\|>")


def numbered(df: DataFrame) -> DataFrame:
    """(conv, turn, role, text, place): place counts from 0 inside a dialogue."""
    rows = df.select(
        F.col("conv_id").alias("conv"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(2**62)).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = {"head": F.substring("text", 1, HEAD), "hash": F.md5(F.col("text").cast("binary")), "tie": F.monotonically_increasing_id()}
    order = ["conv", "turn", "role", *keys]
    ranged = rows.withColumns(keys).repartitionByRange(*order).sortWithinPartitions(*order)
    # Stored, for ranges are cut by a sample and must be the same for all that follows.
    stored, _ = materialize(ranged.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("id")), "turns")
    part = F.shiftright("id", LOW)
    sizes = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # one row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    at = stored.withColumn("part", part).join(F.broadcast(sizes), "part")
    at = at.select("conv", "turn", "role", "text", (F.col("before") + F.col("id") - F.shiftleft("part", LOW)).alias("at"))
    first = at.groupBy("conv").agg(F.min("at").alias("first")).withColumnRenamed("conv", "c")
    joined = at.join(first, at.conv.eqNullSafe(F.col("c")))
    return joined.select("conv", "turn", "role", "text", (F.col("at") - F.col("first")).alias("place"))


def perspectives(df: DataFrame) -> DataFrame:
    """conv_id, participant, part, n_turns, text, mask."""
    parts = (
        numbered(df).withColumn("part", F.expr(f"place div {PART}")).groupBy("conv", "part")
        .agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    )
    speakers = df.select(F.col("conv_id").alias("c"), F.coalesce("role", F.lit("unknown")).alias("participant"))
    speakers = speakers.where("participant <> 'system'").distinct()
    each = parts.join(speakers, parts.conv.eqNullSafe(speakers.c))
    who = F.col("participant")

    def segment(t):
        own, system = t["role"] == who, t["role"] == "system"
        head = F.when(own, F.lit("assistant")).when(system, F.lit("system")).otherwise(
            F.concat(F.lit("user name="), F.translate(_broken(t["role"]), "\r\n", "  "))
        )
        head, body = F.concat(F.lit(OPEN), head, F.lit(BREAK)), F.concat(_broken(t["text"]), F.lit(CLOSE))
        return F.struct(F.length(head).alias("head"), F.length(body).alias("body"), own.alias("own"), F.concat(head, body, F.lit(END)).alias("text"))

    def add(acc, s):
        start = acc["at"] + s["head"]
        span = F.array(F.struct(start.alias("start"), (start + s["body"]).alias("end")))
        return F.struct(
            (start + s["body"] + len(END)).alias("at"), F.when(s["own"], F.concat(acc["mask"], span)).otherwise(acc["mask"]).alias("mask")
        )

    first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<struct<start:int,end:int>>)").alias("mask"))
    rendered = each.withColumn("segments", F.transform("turns", segment))
    return rendered.select(
        F.col("conv").alias("conv_id"), "participant", F.col("part").cast("bigint").alias("part"),
        F.size("segments").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("text"),
        F.aggregate("segments", first, add, lambda acc: acc["mask"]).alias("mask"),
    )


def mask_text(mask) -> Column:
    """Spans as ``start:end``, comma-joined."""
    return F.array_join(F.transform(mask, lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
