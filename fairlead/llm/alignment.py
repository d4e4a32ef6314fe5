"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, corpus-wide."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import arrow_rows, portions
from fairlead.llm.spans import FIELDS, NOTHING, aligner
from fairlead.session import scratch_path, stored

PORTION = 4 << 20
# At most so many pairs of ids, the most frequent ones, are looked up without a shuffle: those
# that make up more than one in COMMON of all links.
COMMON = 2_000_000
# A task hands on its counts of pairs when it holds so many.
HELD = 1_000_000
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document its counts, the hash of its groups, and its distinct pairs with their numbers.

    pairs: a << 16 | b (or << 32 where a vocabulary is larger), ascending, each as the
    difference from the one before; times: how many links have it.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
            ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(a_path, b_path)
        for whole in batches:
            for batch in portions(whole, "text", PORTION):
                entries, which, counts = tool.align(batch.column(1))
                ends = np.cumsum(counts)
                bounds = np.concatenate([[0], ends]).tolist()
                # Columns of the entries, each read once; a text only picks from them.
                linked, groups, *n_each = zip(*[FIELDS(e or NOTHING) for e in entries]) if entries else [()] * 5
                n_each = np.array(n_each, np.int64).T
                summed = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(n_each[which], axis=0)])
                sizes = summed[ends] - summed[ends - counts]
                linked, groups = (np.array(column, object)[which].tolist() for column in (linked, groups))
                odd = np.concatenate([[0], np.cumsum(np.array([e is None for e in entries], bool)[which])])
                odd = (odd[ends] > odd[ends - counts]).tolist()
                n_links, sha, packed, times = [], [], [], []
                for k in range(batch.num_rows):
                    parts = slice(bounds[k], bounds[k + 1])
                    joined, shown, found = b"".join(linked[parts]), ";".join(groups[parts]), bounds[k] < bounds[k + 1]
                    if odd[k]:
                        entry = tool.whole(batch.column(1)[k].as_py())
                        (joined, shown, *sizes[k]), found = FIELDS(entry or NOTHING), entry is not None
                    links = np.frombuffer(joined, tool.kind)
                    pairs, n = np.unique(links, return_counts=True)
                    packed.append(np.diff(pairs, prepend=pairs.dtype.type(0)).tobytes())
                    times.append(n.astype("<u4").tobytes())
                    n_links.append(len(links))
                    sha.append(hashlib.sha256(shown.encode()).hexdigest() if found else "")
                yield arrow_rows(
                    schema, doc_id=batch.column(0), n_a=sizes[:, 0], n_b=sizes[:, 1], n_groups=sizes[:, 2],
                    n_links=n_links, groups_sha256=sha, pairs=packed, times=times,
                )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame, kind: str) -> DataFrame:
    """pair and n: how many links of the corpus have it. Tasks add up their own before the shuffle."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
        for batch in batches:
            for packed, times in zip(batch.column(0), batch.column(1)):
                waiting.append((unpacked(packed, kind), np.frombuffer(times.as_buffer(), "<u4")))
                size += len(waiting[-1][0])
                if size > HELD:
                    pairs, counts = added(pairs, counts, waiting)
                    waiting, size = [], 0
                    if len(pairs) > HELD:
                        yield arrow_rows(schema, pair=pairs, n=counts)
                        pairs, counts = pairs[:0], counts[:0]
        pairs, counts = added(pairs, counts, waiting)
        yield arrow_rows(schema, pair=pairs, n=counts)

    rows = aligned.select("pairs", "times").mapInArrow(run, "pair long, n long")
    return rows.groupBy("pair").agg(F.sum("n").alias("n"))


def unpacked(packed: pa.Scalar, kind: str) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed.as_buffer(), kind).astype(np.int64))


def added(pairs: np.ndarray, counts: np.ndarray, more: list) -> tuple[np.ndarray, np.ndarray]:
    if not more:
        return pairs, counts
    values = np.concatenate([pairs, *(p for p, _ in more)])
    numbers = np.concatenate([counts, *(n for _, n in more)])
    order = np.argsort(values, kind="stable")
    values, numbers = values[order], numbers[order]
    lead = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])
    return values[lead], np.add.reduceat(numbers, lead) if len(lead) else numbers


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, common: int = COMMON) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    Every text is encoded by both tokenizers with a space before it. Bytes at which a token of
    both ends cut the tokens into groups; tokens of A and B whose bytes overlap are linked. A
    pair of ids counts as often as links of the whole corpus have it; n_best is the number of
    links whose count is the highest that their B id has with any A id, count_sum the sum of
    the counts over the links.

    Pairs that make up more than one in `common` of all links, fewer than `common` by that, are
    looked up in the tasks; links of all others meet their counts in a join, where none has more
    than that share of the rows.

    Texts that are null, empty, or not spelled by the tokens (a U+2581 in the text) have zeros
    and '' as hash. Repeated rows are documents of their own and count each; a null doc_id is
    an id like any other; an empty table gives an empty one; other columns are ignored. A
    text without any seam, however long, is encoded as one piece.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    rows = align(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id())
    rows.write.option("compression", "zstd").parquet(path)
    aligned = spark.read.schema(rows.schema).parquet(path)
    kind = aligner(a_path, b_path).kind.str
    shift = aligner(a_path, b_path).shift
    counts = pair_counts(aligned, kind)
    counts = stored(counts.withColumn("b", F.col("pair").bitwiseAND((1 << shift) - 1)), "pair-counts")
    highest = counts.groupBy(F.col("b").alias("_b")).agg(F.max("n").alias("highest"))
    # One row per id of B's vocabulary, whatever the input.
    judged = counts.join(F.broadcast(highest), F.col("b") == F.col("_b"))
    judged = judged.select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = math.floor(total / common) + 1
    frequent = judged.filter(F.col("n") >= least).orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast([frequent.column(c).to_numpy() for c in ("pair", "n", "best")])

    schema = pa.schema(
        [
            ("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
            ("rare", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers, bests = shared.value
        for batch in batches:
            best, total, rare, often = [], [], [], []
            for packed, times in zip(batch.column(1), batch.column(2)):
                pairs, n = unpacked(packed, kind), np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
                at = np.searchsorted(known, pairs)
                inside = at < len(known)
                inside[inside] = known[at[inside]] == pairs[inside]
                at, n_in = at[inside], n[inside]
                best.append(int(n_in[bests[at]].sum()))
                total.append(int((n_in * numbers[at]).sum()))
                rare.append(pairs[~inside])
                often.append(n[~inside])
            yield arrow_rows(schema, row=batch.column(0), n_best=best, count_sum=total, rare=rare, times=often)

    sums = aligned.select("row", "pairs", "times").mapInArrow(
        run, "row long, n_best long, count_sum long, rare array<long>, times array<long>"
    )
    if least > 1:
        sums = stored(sums, "common-sums")
        links = sums.select("row", F.explode(F.arrays_zip("rare", "times")).alias("link"))
        links = links.select("row", F.col("link.rare").alias("_pair"), F.col("link.times").alias("times"))
        met = links.join(judged.filter(F.col("n") < least), F.col("_pair") == F.col("pair"))
        met = met.groupBy(F.col("row").alias("_row")).agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
        sums = sums.join(met, F.col("row") == F.col("_row"), "left").select(
            "row",
            (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        )
    sums = sums.select(F.col("row").alias("_row"), "n_best", "count_sum")
    out = aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    out = out.join(sums, F.col("row") == F.col("_row"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
