"""What the operators of this subpackage share: hashing over Arrow text, and small Spark helpers."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Frames of at most so many rows may be broadcast; callers count first.
BROADCAST_ROWS = 200_000
GOLDEN = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_fairlead_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="fairlead-code-")) / "fairlead_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    context._fairlead_shipped = True


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(rows: DataFrame, count: int) -> DataFrame:
    """The rows with a broadcast hint if they were counted to be few."""
    return F.broadcast(rows) if count <= BROADCAST_ROWS else rows


def free_name(rows: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the rows has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def matched(docs: DataFrame, judged: DataFrame, how: str, by_text: bool = True) -> DataFrame:
    """Documents with (left_semi) or without (left_anti) a row in judged, columns kept.

    Rows meet by doc_id, nulls included, and where by_text is set by the hash of the text in
    judged.text_hash, so rows that repeat an id with other texts are told apart.
    """
    id_name, hash_name = free_name(docs, "judged_id"), free_name(docs, "judged_hash")
    slim = judged.select(
        F.col("doc_id").alias(id_name), *([F.col("text_hash").alias(hash_name)] if by_text else [])
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_name))
    if by_text:
        same = same & (F.xxhash64("text") == F.col(hash_name))
    return docs.join(slim, same, how)


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def uniform(*columns: str | Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the columns' values and the seed alone."""
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(-1)) for c in columns]
    hashed = F.xxhash64(F.lit(seed), *parts)
    return F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(1 << 53))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x += np.uint64((seed * GOLDEN + GOLDEN) & (2**64 - 1))
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}
# So many powers of a base are held at most; longer sequences make their own.
HELD_POWERS = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, 4096), base, dtype=np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            held = np.cumprod(steps, dtype=np.uint64)
        if n <= HELD_POWERS:
            _POWERS[base] = held
    return held[:n]


# Two odd bases; only their powers are held by a worker, whatever hashes it takes.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class Rolling:
    """Hashes of any stretch of a sequence, by prefix sums of symbol * base**position."""

    def __init__(self, symbols: np.ndarray, seed: int, base: int = BASES[0]):
        n = len(symbols)
        self.seed = seed
        self.back = powers(pow(base, -1, 2**64), n + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(symbols * powers(base, n), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            raw = (self.sums[end] - self.sums[start]) * self.back[start]
            raw += (end - start).astype(np.uint64)
        return mix(raw, self.seed)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows one after the other, and where each row starts (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def portions(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many bytes of text; a longer text is a slice of its own."""
    _, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(at, at[first] + size, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes other than ASCII white space within a row."""
    inside = ~SPACES[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(at, start, side="right") - 1


def stretch_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes; equal bytes give equal hashes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    letters = mix(np.arange(256, dtype=np.uint64), seed + 101)
    return Rolling(letters[data], seed).of(start, end)


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        value = columns[field.name]
        if isinstance(value, pa.ChunkedArray):
            value = value.combine_chunks()
        arrays.append(value if isinstance(value, pa.Array) else pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
