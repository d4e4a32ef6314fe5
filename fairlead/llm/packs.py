"""Asking the whole corpus, pack by pack, which keys occur more than once.

Documents are written once into packs of a few megabytes. A pass over the packs sends each
pack's distinct keys, as one array per bucket of keys, to the task of that bucket; the answer is
one bit per key: whether another pack has it too. Keys travel as arrays of hashes, answers as
bits, so a pass over many keys costs few rows. A key that many documents share arrives once per
pack at most, and buckets divide the keys by their hash, so none is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import arrow_rows, partitions, portions
from fairlead.session import stored

PACK = 1 << 20
# Text per bucket; its keys are a small part of that.
BUCKET_TEXT = 32 << 20
# Answers of at most so many bytes in all are broadcast to the packs, others joined by a shuffle.
BROADCAST_BYTES = 32 << 20

DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
PACKED = pa.schema([("pack", pa.int64()), ("size", pa.int64()), ("body", pa.binary())])
ASKED = pa.schema([("ask", pa.int32()), ("bucket", pa.int32()), ("pack", pa.int64()), ("keys", pa.binary())])
ANSWERED = pa.schema([("ask", pa.int32()), ("bucket", pa.int32()), ("pack", pa.int64()), ("bits", pa.binary())])
ASKED_DDL = "ask int, bucket int, pack long, keys binary"
ANSWERED_DDL = "ask int, bucket int, pack long, bits binary"

Answers = dict[tuple[int, int], bytes]


@dataclass(frozen=True)
class Packs:
    rows: DataFrame
    buckets: int


def _body(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, DOCUMENTS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays(batch.columns, schema=DOCUMENTS))
    return sink.getvalue().to_pybytes()


def opened(body: pa.Scalar) -> pa.RecordBatch:
    table = pa.ipc.open_stream(body.as_buffer()).read_all().combine_chunks()
    return table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], schema=DOCUMENTS)


def pack_documents(docs: DataFrame) -> Packs:
    """Write doc_id and text of all documents, null texts as empty, into packs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            part = whole.column(2)[0].as_py() if whole.num_rows else 0
            for batch in portions(whole, "text", PACK):
                size = batch.column(1).nbytes
                run.number += 1
                body = _body(batch.select(["doc_id", "text"]))
                yield arrow_rows(PACKED, pack=[(part << 32) | run.number], size=[size], body=[body])

    run.number = 0
    slim = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    rows = stored(slim.mapInArrow(run, "pack long, size long, body binary"), "packs")
    size = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return Packs(rows, max(partitions(docs.sparkSession), -(-size // BUCKET_TEXT)))


class Keys:
    """The distinct keys among some items' keys (one or two 64-bit halves), dealt to buckets.

    `width` bytes of a key travel. Two halves cut to 12 bytes still tell 10**13 keys apart; one
    half cut to 6 is for keys where a rare false "shared" does no harm. Buckets go by `deal`
    where it is given, a value per item that equal keys have in common.
    """

    def __init__(
        self,
        ask: int,
        buckets: int,
        width: int,
        first: np.ndarray,
        second: np.ndarray | None = None,
        deal: np.ndarray | None = None,
    ):
        self.ask, self.width = ask, width
        order = np.argsort(first, kind="stable") if second is None else np.lexsort((second, first))
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.diff(first[order]) != 0
        if second is not None:
            fresh[1:] |= np.diff(second[order]) != 0
        group = np.cumsum(fresh) - 1
        self.item = np.empty(len(order), np.int64)
        self.item[order] = group
        self.count = np.bincount(group, minlength=0)
        source = order[fresh]
        dealt = ((first if deal is None else deal)[source] >> np.uint64(32)) % np.uint64(buckets)
        self.order = np.argsort(dealt, kind="stable")
        # Only the buckets that this pack has keys for, however many there are.
        self.full, start = np.unique(dealt[self.order], return_index=True)
        self.ends = dict(zip(self.full.tolist(), zip(start.tolist(), [*start[1:].tolist(), len(dealt)])))
        self.source = source[self.order]
        self.first, self.second = first, second

    def payload(self, source: np.ndarray) -> bytes:
        halves = [self.first[source]] + ([] if self.second is None else [self.second[source]])
        whole = np.stack(halves, axis=1).astype("<u8").view(np.uint8).reshape(len(source), -1)
        return np.ascontiguousarray(whole[:, : self.width]).tobytes()

    def requests(self, pack: int) -> pa.RecordBatch:
        return arrow_rows(
            ASKED,
            ask=np.full(len(self.full), self.ask, np.int32),
            bucket=self.full.astype(np.int32),
            pack=np.full(len(self.full), pack, np.int64),
            keys=[self.payload(self.source[a:b]) for a, b in self.ends.values()],
        )

    def replies(self, answers: Answers) -> Iterator[tuple[np.ndarray, bytes]]:
        """The keys of each bucket that has answered, with its answer."""
        for (ask, b), bits in answers.items():
            if ask == self.ask:
                yield self.order[slice(*self.ends[b])], bits

    def shared(self, answers: Answers) -> np.ndarray:
        """Per item, whether its key occurs more than once, here or elsewhere."""
        flags = self.count > 1
        for part, bits in self.replies(answers):
            flags[part] |= unpacked(bits[: -(-len(part) // 8)], len(part))
        return flags[self.item]

    def crowded(self, answers: Answers) -> np.ndarray:
        """Per item, whether its key occurs in very many packs (for asks that are told)."""
        flags = np.zeros(len(self.count), bool)
        for part, bits in self.replies(answers):
            flags[part] = unpacked(bits[-(-len(part) // 8) :], len(part))
        return flags[self.item]

    def owned(self, answers: Answers) -> np.ndarray:
        """Per item, whether it is the one occurrence of its key that counts as the owner."""
        flags = np.zeros(len(self.count), bool)
        for part, bits in self.replies(answers):
            flags[part] = unpacked(bits[-(-len(part) // 8) :], len(part))
        return flags[self.item] & self.leads()

    def leads(self) -> np.ndarray:
        """Per item, whether it is the first one of its key here."""
        first = np.zeros(len(self.item), bool)
        first[np.unique(self.item, return_index=True)[1]] = True
        return first


def widened(keys: pa.Buffer, width: int) -> np.ndarray:
    """Keys of some bytes as one or two 64-bit numbers each."""
    raw = np.frombuffer(keys, np.uint8).reshape(-1, width)
    wide = np.zeros((len(raw), 8 if width <= 8 else 16), np.uint8)
    wide[:, :width] = raw
    halves = wide.view("<u8")
    return halves[:, 0] if width <= 8 else halves


def unpacked(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def found_elsewhere(keys: list[np.ndarray], many: int = 0) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For arrays of distinct keys, whether each key is in another array too, and in none before.

    With `many`, the second is whether the key is in at least so many arrays.
    """
    joined = np.concatenate(keys)
    if joined.ndim == 1:
        order = np.argsort(joined, kind="stable")
        ranked = joined[order]
        same = ranked[1:] == ranked[:-1]
    else:
        order = np.lexsort((joined[:, 1], joined[:, 0]))
        ranked = joined[order]
        same = (ranked[1:] == ranked[:-1]).all(axis=1)
    flags = np.zeros(len(joined), bool)
    flags[order[1:]] |= same
    flags[order[:-1]] |= same
    owners = np.ones(len(joined), bool)
    owners[order[1:]] = ~same
    if many:
        run = np.cumsum(np.concatenate([[0], ~same]))
        owners[order] = np.bincount(run)[run] >= many
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return np.split(flags, cuts), np.split(owners, cuts)


def answer_keys(
    width: dict[int, int], owners: set[int] = frozenset(), many: dict[int, int] | None = None
) -> Callable[[pa.Table], pa.Table]:
    """The task of one bucket: bits per request; `width` has the bytes per key of each ask.

    For the asks in owners, the bits that name one owner per key follow those that say shared;
    for those in many, bits that tell keys of at least so many packs.
    """
    many = many or {}

    def run(asked: pa.Table) -> pa.Table:
        ask = asked["ask"][0].as_py()
        keys = [widened(k.as_buffer(), width[ask]) for k in asked["keys"]]
        shared, first = found_elsewhere(keys, many.get(ask, 0))
        bits = [np.packbits(f).tobytes() for f in shared]
        if ask in owners or ask in many:
            bits = [b + np.packbits(f).tobytes() for b, f in zip(bits, first)]
        return pa.table([asked["ask"], asked["bucket"], asked["pack"], pa.array(bits, pa.binary())], schema=ANSWERED)

    return run


def with_answers(packs: Packs, answers: DataFrame | None) -> DataFrame:
    """pack, body and the list of the answers (ask, bucket, bits) to each pack."""
    if answers is None:
        return packs.rows.select("pack", "body", F.lit(None).cast("array<struct<ask:int,bucket:int,bits:binary>>").alias("told"))
    told = answers.groupBy("pack").agg(F.collect_list(F.struct("ask", "bucket", "bits")).alias("told"))
    size = answers.agg(F.coalesce(F.sum(F.length("bits") + 16), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        told = F.broadcast(told)
    return packs.rows.select("pack", "body").join(told, "pack", "left")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, Answers]]:
    for batch in batches:
        for pack, body, told in zip(batch.column(0), batch.column(1), batch.column(2)):
            answers = {(t["ask"], t["bucket"]): t["bits"] for t in told.as_py() or []}
            yield pack.as_py(), opened(body), answers


def ask(
    packs: Packs,
    answers: DataFrame | None,
    keys_of: Callable[[pa.RecordBatch, Answers], list],
    reply: Callable[[pa.Table], pa.Table],
    name: str,
) -> DataFrame:
    """Send what keys_of gives for each pack to its buckets; all answers so far and the new ones."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, docs, told in _each(batches):
            for keys in keys_of(docs, told):
                yield keys.requests(pack)

    asked = with_answers(packs, answers).mapInArrow(send, ASKED_DDL)
    # Buckets of all asks are spread evenly, one group each.
    new = stored(asked.groupBy("ask", "bucket").applyInArrow(reply, ANSWERED_DDL), name)
    return new if answers is None else answers.unionByName(new)


def conclude(
    packs: Packs, answers: DataFrame, result: Callable[[pa.RecordBatch, Answers], pa.RecordBatch], ddl: str
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, docs, told in _each(batches):
            yield result(docs, told)

    return with_answers(packs, answers).mapInArrow(run, ddl)
