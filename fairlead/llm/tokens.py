"""Token-ID output: tokenize, order by document id, write compressed blocks, and read them back."""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.llm import rans
from fairlead.llm.common import arrow_rows, partitions, portions
from fairlead.session import scratch_path, stored

END_ID = 2
# Bytes of words and ids that a worker remembers; beyond, it starts anew. An entry takes about
# OVERHEAD bytes besides.
MEMORY = 96 << 20
OVERHEAD = 160
PORTION = 4 << 20
# Without U+0130, which lower-cases to i and a mark that belongs to the punctuation after it.
SEAM = r"([a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}])([,.!|*%$&#?;:])"
# The normalizer and splitting that WordCoder's short cuts hold for.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
TOKENS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
BLOCKS = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()),
        ("low", pa.int64()), ("high", pa.int64()), ("payload", pa.binary()),
    ]
)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordCoder:
    """Ids of whole texts, by way of their distinct words.

    The tokenizer's splitting never crosses ASCII white space, nor the seam between a letter
    and the ASCII punctuation after it, so a text's ids are those of its words one after the
    other, and each distinct word is encoded once. Words of plain lower-case letters go to the
    merge model directly, all others through the whole tokenizer. A portion with a special
    token's opening "<|" is encoded text by text, and so is everything by a tokenizer with
    another normalizer or splitting than the one these short cuts hold for.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.forget()
        made = json.loads(self.tokenizer.to_str())
        steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_words = (
            made["normalizer"] == NORMALIZER
            and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and (steps[0]["pattern"], steps[0]["behavior"], steps[0]["invert"]) == ({"Regex": SPLIT}, "Removed", True)
            and not (steps[1]["add_prefix_space"] or steps[1]["use_regex"])
            and made["post_processor"] is None
            and all(t["content"].startswith("<|") for t in made["added_tokens"])
        )

    def forget(self) -> None:
        """Start anew: `known` has the number of each word, whose ids are flat[at[number]:at[number + 1]]."""
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 12, np.uint32)
        self.at = np.zeros(1 << 10, np.int64)
        self.held = 0

    def plain(self, word: str) -> str | None:
        """The word as the merge model takes it, or None if the whole tokenizer has to."""
        if not word.isalpha():
            return None
        if word.isascii():
            return word.lower()
        if any(c >= "ƀ" or c == "İ" for c in word) or not unicodedata.is_normalized("NFC", word):
            return None
        return "".join(self.letters[b] for b in word.lower().encode())

    def learn(self, fresh: list[str]) -> None:
        hard, coded = [], []
        for n, word in enumerate(fresh):
            shown = self.plain(word)
            if shown is None:
                hard.append(n)
            coded.append([] if shown is None else [t.id for t in self.model.tokenize(shown)])
        words = [fresh[n] for n in hard]
        for n, whole in zip(hard, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            coded[n] = whole.ids
        begin = len(self.known)
        ends = self.at[begin] + np.cumsum([len(ids) for ids in coded])
        self.at = longer(self.at, begin, len(fresh) + 1)
        self.at[begin + 1 : begin + 1 + len(fresh)] = ends
        first, last = int(self.at[begin]), int(ends[-1])
        self.flat = longer(self.flat, first, last - first)
        self.flat[first:last] = np.fromiter(chain.from_iterable(coded), np.uint32, last - first)
        self.known.update(zip(fresh, range(begin, begin + len(fresh))))
        self.held += sum(map(len, fresh)) + 4 * (last - first) + OVERHEAD * len(fresh)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of each text (null: none)."""
        texts = texts.fill_null("")
        if not self.by_words or pc.any(pc.match_substring(texts, "<|")).as_py():
            coded = [np.array(c.ids, np.uint32) for c in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([*coded, np.zeros(0, np.uint32)]), np.array([len(c) for c in coded], np.int64)
        seamed = pc.replace_substring_regex(pc.ascii_lower(texts), SEAM, r"\1 \2")
        lists = pc.ascii_split_whitespace(seamed)
        coded = lists.flatten().dictionary_encode()
        vocabulary = coded.dictionary.to_numpy(zero_copy_only=False)
        if self.held > MEMORY:
            self.forget()
        numbers = np.fromiter(map(self.known.get, vocabulary, repeat(-1)), np.int64, len(vocabulary))
        fresh = np.flatnonzero(numbers < 0)
        if len(fresh):
            begin = len(self.known)
            self.learn(vocabulary[fresh].tolist())
            numbers[fresh] = np.arange(begin, begin + len(fresh))
        if not len(coded):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        which = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        entries = [None, pa.py_buffer(self.at[: len(self.known) + 1] * 4), pa.py_buffer(self.flat)]
        found = pa.Array.from_buffers(pa.large_binary(), len(self.known), entries).take(pa.array(which))
        _, offsets, data = found.buffers()
        after = np.frombuffer(offsets, np.int64)[: len(which) + 1] // 4
        ids = np.frombuffer(data, np.uint32)[: after[-1]] if after[-1] else np.zeros(0, np.uint32)
        bounds = after[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return ids, np.diff(bounds)


def longer(values: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, or a copy of at least twice its size, with room for so many values after those used."""
    if used + more <= len(values):
        return values
    grown = np.zeros(max(2 * len(values), used + more), values.dtype)
    grown[: len(values)] = values
    return grown


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def forget_words(path: str) -> None:
    """Drop what this worker's coder, if it has one, remembers from task to task."""
    if coder.cache_info().currsize:
        coder(path).forget()


def id_width(path: str) -> str:
    """How ids are held between the stages: 16 bits where the vocabulary allows it, else 32."""
    return "<u2" if coder(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Per document: doc_id, n_tokens and ids (of id_width, little-endian), end id included."""
    kind = np.dtype(id_width(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(path)
        for whole in batches:
            for batch in portions(whole, "text", PORTION):
                ids, sizes = words.encode(batch.column(1))
                ends = np.cumsum(sizes)
                # The end id goes after the last id of each text.
                ids = np.insert(ids, ends, end_id).astype(kind)
                at = np.concatenate([[0], ends + np.arange(1, len(sizes) + 1)])
                data = ids.tobytes()
                yield arrow_rows(
                    TOKENS,
                    doc_id=batch.column(0),
                    n_tokens=sizes + 1,
                    ids=[data[a:b] for a, b in zip(at[:-1] * kind.itemsize, at[1:] * kind.itemsize)],
                )
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def token_counts(tokens: DataFrame, kind: str, path: str) -> np.ndarray:
    """How often each id occurs; the table is as long as the vocabulary, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words(path)  # the texts are tokenized; the worker serves other tasks from now on
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                counts = np.bincount(np.frombuffer(ids.as_buffer(), kind))
                if len(counts) > len(total):
                    counts[: len(total)] += total
                    total = counts
                else:
                    total[: len(counts)] += counts
        seen = np.flatnonzero(total)
        yield arrow_rows(pa.schema([("id", pa.int64()), ("n", pa.int64())]), id=seen, n=total[seen])

    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return counts


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> rans.Frequencies:
    """Write the ids of all documents, in ascending doc_id order, as blocks under the folder.

    `folder`/blocks holds one row per block: part and block (their order is the order of the
    documents), first (ids before it in its part), n_tokens, the smallest and largest doc_id
    (low, high) and payload, in the format of `rans`. `folder`/frequencies holds the shared
    table. Null texts count as empty, a null doc_id comes first, rows that repeat an id follow
    each other by their ids' bytes. An empty table gives no blocks; columns other than doc_id
    and text are ignored. A block holds whole documents: a very long text is a block of its
    own size. Spark's writers commit the files, so a lost executor or a repeated task leaves
    no half block.
    """
    spark = docs.sparkSession
    kind = id_width(path)
    tokens = stored(tokenize(docs, path, end_id), "tokens")
    table = rans.Frequencies.of_counts(token_counts(tokens, kind, path))
    spark.createDataFrame(
        pa.table({"id": np.arange(len(table.scaled)), "frequency": table.scaled.astype(np.int64)})
    ).coalesce(1).write.parquet(f"{folder}/frequencies")
    shared = spark.sparkContext.broadcast(table.scaled)
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Frequencies.of_scaled(shared.value)
        state = {"block": 0, "first": 0}
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def flush(part: int) -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(d for _, d in held), kind)
            lengths = np.array([len(d) // width for _, d in held], np.int64)
            payload = rans.write_block([i for i, _ in held], lengths, ids, table)
            named = [i for i, _ in held if i is not None]
            row = arrow_rows(
                BLOCKS, part=[part], block=[state["block"]], first=[state["first"]], n_tokens=[len(ids)],
                low=[min(named, default=None)], high=[max(named, default=None)], payload=[payload],
            )
            state["block"] += 1
            state["first"] += len(ids)
            held.clear()
            return row

        part = 0
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.column(0)[row].as_py()
                data = batch.column(2)[row].as_py()
                held.append((batch.column(1)[row].as_py(), data))
                size += len(data) // width
                if size >= rans.BLOCK_IDS:
                    yield flush(part)
                    size = 0
        if held:
            yield flush(part)

    ordered = tokens.select("doc_id", "ids").repartitionByRange(partitions(spark), "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "ids").select(
        F.spark_partition_id().alias("part"), "doc_id", "ids"
    )
    blocks = ordered.mapInArrow(
        run, "part int, block long, first long, n_tokens long, low long, high long, payload binary"
    )
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    return table


def read_tokens(spark, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and ids_crc32.

    Each block is decoded on its own. `start` adds up the ids of the parts before (one row per
    part), of the blocks before in the part, and of the documents before in the block.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    scaled = spark.read.parquet(f"{folder}/frequencies").orderBy("id").toPandas()["frequency"]
    shared = spark.sparkContext.broadcast(scaled.to_numpy().astype(np.uint64))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Frequencies.of_scaled(shared.value)
        slots = table.slots()
        schema = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        )
        for batch in batches:
            for begin, payload in zip(batch.column(0), batch.column(1)):
                doc_ids, lengths, ids = rans.read_block(payload.as_py(), table, slots)
                at = np.concatenate([[0], np.cumsum(lengths)])
                data = ids.astype("<u4").tobytes()
                yield arrow_rows(
                    schema,
                    doc_id=doc_ids,
                    start=begin.as_py() + at[:-1],
                    n_tokens=lengths,
                    ids_crc32=[zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])],
                )

    placed = blocks.join(F.broadcast(parts), "part").select((F.col("before") + F.col("first")).alias("begin"), "payload")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark, folder: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of the named documents (a list for the driver), end id included.

    Only the blocks whose range of ids has one of them are read, and of those only the rows
    from the checkpoint before a document to its end are decoded.
    """
    wanted = sorted(set(doc_ids))
    near = F.exists(F.array(*map(F.lit, wanted)), lambda i: i.between(F.col("low"), F.col("high")))
    blocks = spark.read.parquet(f"{folder}/blocks").filter(near if wanted else F.lit(False))
    scaled = spark.read.parquet(f"{folder}/frequencies").orderBy("id").toPandas()["frequency"]
    shared = spark.sparkContext.broadcast(scaled.to_numpy().astype(np.uint64))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, named = rans.Frequencies.of_scaled(shared.value), set(wanted)
        slots = table.slots()
        for batch in batches:
            for payload in batch.column(0):
                block = rans.Block(payload.as_py())
                at = np.concatenate([[0], np.cumsum(block.lengths)]).tolist()
                for k, doc_id in enumerate(block.doc_ids):
                    if doc_id in named:
                        ids = block.ids(table, slots, at[k], at[k + 1])
                        yield arrow_rows(schema, doc_id=[doc_id], ids=[ids.astype(np.int64)])

    return blocks.select("payload").mapInArrow(run, "doc_id long, ids array<long>")


def token_files(docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """Write the documents' ids under the folder (default: a new shared one) and read them back."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, folder)
    return read_tokens(docs.sparkSession, folder)
