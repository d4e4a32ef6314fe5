"""Mixing sources to target weights: repeat documents so that each source meets its share of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.llm.common import free_name, small
from fairlead.operators.keys import Sized, number_rows
from fairlead.session import stored

SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = 5


def word_count(text: str) -> Column:
    """Number of runs of anything but ASCII white space; null has none."""
    trimmed = F.btrim(F.col(text), F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, SPACE))).otherwise(0).cast("long")


def hash_draw(key: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5 of seed and key (null: "null")."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return bits / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The target of each source, from one row per source: source, source_size, rank (from 0).

    The sources weigh `weights` by rank, repeating, and share the total of all sizes. A target
    stops at `most` times its source; the excess goes to the others by weight until none is
    above. That is water rising over the sources in order of cap / weight: with the first k at
    their caps, the level is what is left over, divided by the weights left over, and the right
    k is the first at which the next source's cap lies above that level.
    """
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(most)
    rows = sizes.withColumn("weight", pick).withColumn("cap", cap.cast("double"))
    order = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    levels = rows.select(
        "source",
        "source_size",
        "rank",
        "weight",
        "cap",
        (
            (F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(onward)
        ).alias("level"),
    )
    fits = F.col("level") <= F.col("cap") / F.col("weight")
    level = F.min(F.when(fits, F.struct((F.col("cap") / F.col("weight")).alias("o"), "rank", "level")))
    return levels.withColumn("water", level.over(W.partitionBy()).getField("level")).select(
        "source",
        "source_size",
        F.when(F.col("water").isNull(), F.col("cap"))
        .otherwise(F.least("cap", F.col("water") * F.col("weight")))
        .alias("target"),
    )


def source_sizes(sized: DataFrame) -> Sized:
    """One row per source: its words, and its rank by code point, null last.

    A source may hold any share of the rows: they are summed before the shuffle. Many distinct
    sources are numbered by a distributed sort, not in one task.
    """
    sums = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    count = sums.count()
    ranked = number_rows(sums, [F.col("source").asc_nulls_last()], start=-1, count=count)
    return Sized(ranked.withColumnRenamed("id", "rank"), count)


def mix_rates(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, rate and copies.

    `rate` is target over source size (0 for a source without words). A document is taken
    floor(rate) times, and once more with probability rate - floor(rate), drawn from a hash of
    its id, so that reruns agree. Null text has size 0; a null source is a source of its own,
    ranked last; rows that repeat an id each count, and draw alike, each by its own source's
    rate. An empty table gives one; other columns are ignored.
    """
    sized = stored(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    sources = source_sizes(sized)
    aims = stored(targets(sources.rows, weights, most), "targets").withColumnRenamed("source", "of_source")
    joined = sized.join(
        small(aims, sources.count), F.col("source").eqNullSafe(F.col("of_source")), "left"
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    draw = hash_draw(F.col("doc_id"))
    rated = joined.withColumn("rate", rate)
    copies = F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")
    return rated.withColumn("copies", copies.cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies"
    )


def mix_documents(docs: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """The documents of the mix, with their own columns; a document taken n times is n rows.

    A row is taken as often as its id and source are: rows that repeat both are taken alike,
    an id in two sources by the rate of each. Columns of any name are passed on; texts are not
    read, however long. An empty table gives one.
    """
    rates = mix_rates(docs) if rates is None else rates
    id_name, from_name = free_name(docs, "taken_id"), free_name(docs, "taken_source")
    copies, copy = free_name(docs, "taken_copies"), free_name(docs, "taken_copy")
    taken = rates.filter("copies > 0").select(
        F.col("doc_id").alias(id_name), F.col("source").alias(from_name), F.col("copies").alias(copies)
    )
    same = F.col("doc_id").eqNullSafe(F.col(id_name)) & F.col("source").eqNullSafe(F.col(from_name))
    rows = docs.join(taken.distinct(), same)
    repeated = rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
    return repeated.select(*docs.columns)
