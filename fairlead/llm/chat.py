"""Chat formatting: keep the longest snapshot of each logged conversation and render it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.session import stored

# Turns are chained within stretches of so many turn numbers, and the stretches among
# themselves, so that a very long conversation is no window partition of its own.
STRETCH = 4096


def turn_hash(seed: int, place: Column) -> Column:
    """Hash of a turn at its place; a null role or text differs from an empty one."""
    return F.xxhash64(
        F.lit(seed),
        place,
        F.col("role").isNull(),
        F.coalesce("role", F.lit("")),
        F.col("text").isNull(),
        F.coalesce("text", F.lit("")),
    )


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """Per distinct turn: conv_id, turn, its place (from 1) and the hash (h1, h2) of the turns up to it.

    A prefix hash is the xor of the hashes of (place, role, text) of its turns, in two
    independent 64-bit halves: rolling, for each turn adds one term to the prefix before. Places
    are ranks by turn number (null first), then by the turn's hash.
    """
    stretch = F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-1)).cast("long")
    slim = turns.select(
        "conv_id",
        "turn",
        stretch.alias("stretch"),
        turn_hash(1, F.lit(0)).alias("t1"),
        turn_hash(2, F.lit(0)).alias("t2"),
    ).distinct()
    slim = stored(slim, "turns")
    counts = slim.groupBy("conv_id", "stretch").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(
        F.col("conv_id").alias("_conv"),
        F.col("stretch").alias("_stretch"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skipped"),
    )
    inner = W.partitionBy("conv_id", "stretch").orderBy("turn", "t1", "t2")
    placed = slim.withColumn("nth", F.row_number().over(inner)).join(
        counts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("stretch") == F.col("_stretch"))
    )
    place = (F.col("skipped") + F.col("nth")).alias("place")
    placed = placed.select("conv_id", "stretch", "turn", "t1", "t2", place).select(
        "*",
        F.xxhash64(F.lit(1), "place", "t1").alias("p1"),
        F.xxhash64(F.lit(2), "place", "t2").alias("p2"),
    )
    upto = W.partitionBy("conv_id", "stretch").orderBy("place")
    within = placed.select(
        "*", F.bit_xor("p1").over(upto).alias("w1"), F.bit_xor("p2").over(upto).alias("w2")
    )
    sums = placed.groupBy("conv_id", "stretch").agg(
        F.bit_xor("p1").alias("s1"), F.bit_xor("p2").alias("s2")
    )
    before = sums.select(
        F.col("conv_id").alias("_conv"),
        F.col("stretch").alias("_stretch"),
        F.coalesce(F.bit_xor("s1").over(earlier), F.lit(0)).alias("b1"),
        F.coalesce(F.bit_xor("s2").over(earlier), F.lit(0)).alias("b2"),
    )
    joined = within.join(
        before, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("stretch") == F.col("_stretch"))
    )
    return joined.select(
        "conv_id",
        "turn",
        "place",
        F.col("w1").bitwiseXOR(F.col("b1")).alias("h1"),
        F.col("w2").bitwiseXOR(F.col("b2")).alias("h2"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_logged of the conversations that no other one continues.

    Of conversations with the same turns the smallest id stays (null before all); `n_logged`
    says how many there were. Prefixes and whole conversations are reduced to distinct hashes
    before they meet, so a first turn that a third of the conversations share is one row.
    """
    prefixes = stored(turn_prefixes(turns), "prefixes")
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct("place", "h1", "h2")).alias("whole"))
    whole = last.select("conv_id", "whole.*")
    kept = whole.groupBy("place", "h1", "h2").agg(
        F.min(F.struct(F.col("conv_id"))).getField("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_logged"),
    )
    lengths = whole.select(F.col("conv_id").alias("_conv"), F.col("place").alias("n"))
    inner = prefixes.join(lengths, F.col("conv_id").eqNullSafe(F.col("_conv")))
    proper = inner.filter(F.col("place") < F.col("n")).select("place", "h1", "h2").distinct()
    maximal = kept.join(proper, ["place", "h1", "h2"], "left_anti")
    return maximal.select("conv_id", F.col("place").alias("n_turns"), "n_logged")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per kept conversation: conv_id, n_turns, n_logged and the rendered text.

    A turn is rendered as "<|role|>", a line feed, its text, and a line feed; a null role is
    "unknown" and a null text is empty. Repeated turns are rendered once.
    """
    chosen = kept.withColumnRenamed("conv_id", "_conv")
    shown = turns.select("conv_id", "turn", "role", "text").distinct()
    shown = shown.join(chosen, F.col("conv_id").eqNullSafe(F.col("_conv")))
    shown = shown.select(
        "conv_id",
        "n_turns",
        "n_logged",
        F.struct(
            F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-1)).alias("stretch"),
            "turn",
            turn_hash(1, F.lit(0)).alias("t1"),
            turn_hash(2, F.lit(0)).alias("t2"),
            F.concat(
                F.lit("<|"),
                F.coalesce("role", F.lit("unknown")),
                F.lit("|>\n"),
                F.coalesce("text", F.lit("")),
                F.lit("\n"),
            ).alias("line"),
        ).alias("shown"),
    )
    gathered = shown.groupBy("conv_id", "n_turns", "n_logged").agg(
        F.sort_array(F.collect_list("shown")).alias("lines")
    )
    return gathered.select(
        "conv_id", "n_turns", "n_logged", F.array_join("lines.line", "").alias("rendered")
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """Render the maximal conversations of a table of turns (conv_id, turn, role, text).

    A conversation whose turns are the first turns of a longer one is a snapshot of it and
    goes. Rows that repeat a turn count once; turns with one number but other content follow
    each other. A null conv_id is a conversation like any other; an empty table gives an empty
    one; other columns are ignored. A rendered conversation is one value, so one conversation
    must fit into a task.
    """
    kept = stored(maximal_conversations(turns), "kept-chats")
    return render(turns, kept)
