"""Line dedup: lines that many documents have stay in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import BROADCAST_ROWS, small
from fairlead.session import stored

SHORTEST = 40
DOCUMENTS = 5
BLANKS = " \t\n\x0b\x0c\r"
# Keys with more lines than one in so many of all are joined apart: fewer than so many rows.
HOT = 10_000


def split_lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n", -1)


def line_key(line: str) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, upper, upper.lower()))


def keyed_lines(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, place (from 0), and the hash (k1, k2) of the key, of all lines with a key long enough.

    t1 and t2 hash the text, so that rows that repeat an id with other texts are told apart.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slim = slim.withColumns({"t1": F.xxhash64(F.lit(1), "text"), "t2": F.xxhash64(F.lit(2), "text")})
    lines = slim.select("doc_id", "t1", "t2", F.posexplode(split_lines("text")).alias("place", "line"))
    # The key has as many characters as the line without its blanks.
    lines = lines.filter(F.length(F.btrim("line", F.lit(BLANKS))) >= shortest).withColumn("key", line_key("line"))
    return lines.select(
        "doc_id", "t1", "t2", "place", F.xxhash64(F.lit(3), "key").alias("k1"), F.xxhash64(F.lit(4), "key").alias("k2")
    )


def common_keys(lines: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """k1, k2, last (largest doc_id) and n (lines) of the keys found in at least so many documents.

    Tasks add up the lines of a key and document before the shuffle, and of a key after it, so
    a line that a third of all documents have never meets in one task as rows.
    """
    each = lines.groupBy("k1", "k2", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    # A null id is one document, before all others.
    keys = each.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("holders"), F.max("doc_id").alias("last"), F.sum("n").alias("n")
    )
    return keys.filter(F.col("holders") >= documents).select("k1", "k2", "last", "n")


def lines_to_drop(docs: DataFrame, shortest: int = SHORTEST, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, t1, t2 and the sorted places of the lines that go, for documents that lose some."""
    lines = keyed_lines(docs, shortest)
    keys = stored(common_keys(lines, documents), "line-keys")
    count, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = keys.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "last", "n")
    same = (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    if count <= BROADCAST_ROWS:
        met = lines.join(small(found, count), same)
    else:
        # The keys with most lines, fewer than HOT by their share, are broadcast; no other key
        # has more than that share of the rows, so the rest is joined by a shuffle.
        hot = F.col("n") > total / HOT
        met = lines.join(F.broadcast(found.filter(hot)), same).unionByName(lines.join(found.filter(~hot), same))
    gone = met.filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    places = gone.groupBy("doc_id", "t1", "t2").agg(F.sort_array(F.collect_set("place")).alias("places"))
    return places


def drop_lines(docs: DataFrame, shortest: int = SHORTEST, documents: int = DOCUMENTS) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and the text without the lines that go.

    Texts are split at line feeds; a null or empty text is one empty line. A line's key is the
    line without blanks at both ends, A-Z in lower case. Keys of at least `shortest` code
    points that at least `documents` documents have lose all their lines but those of the
    largest doc_id that has the key. Keys are compared by 128 bits of hashes.

    Rows that repeat an id are one document for the counts and keep their own texts; a null id
    is one document and the smallest. All lines may go: the text is then empty. An empty table
    gives an empty one; other columns are ignored. The lines that stay are cut out of the
    text between those that go, in one pass, so a very long text costs as much as its length.
    """
    gone = lines_to_drop(docs, shortest, documents).select(
        F.col("doc_id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "places"
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & (F.xxhash64(F.lit(1), "text") == F.col("_t1"))
        & (F.xxhash64(F.lit(2), "text") == F.col("_t2"))
    )
    rows = rows.join(gone, same, "left").select("doc_id", split_lines("text").alias("lines"), "places")
    # The j-th stretch of kept lines lies between the j-th line that goes and the one after.
    begin = lambda j: F.when(j == 0, F.lit(0)).otherwise(F.get("places", j - 1) + 1)
    end = lambda j: F.coalesce(F.get("places", j), F.size("lines"))
    stretches = F.transform(
        F.sequence(F.lit(0), F.size("places")), lambda j: F.slice("lines", begin(j) + 1, end(j) - begin(j))
    )
    kept = F.when(F.col("places").isNull(), F.col("lines")).otherwise(F.flatten(stretches))
    return rows.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("text"),
    )
