"""Token ids in a compressed binary format: a range asymmetric numeral system with static tables.

Coding. One table of frequencies, which sum to 2**SCALE, serves all blocks. A block holds the
ids of whole documents and is coded on its own by LANES interleaved states of 64 bits: id i
belongs to lane i mod LANES, so one step codes a row of LANES ids at once. A state that would
leave its range first gives up its lower 32 bits as a word. The coder runs from the last row to
the first, so that the decoder reads rows and words forwards.

Block format, little-endian, one after the other:
    header   magic "RNS1", version, lanes, number of documents, of ids, of words, of checkpoints
             (unsigned 32-bit each; ids and words 64-bit)
    documents  ids (signed 64-bit), a byte each for "id is null", numbers of ids (64-bit)
    checkpoints  row (64-bit), word (64-bit) and lane states at that row; the first is row 0
    words    unsigned 32-bit
    checksum crc32 of all bytes before it
Decoding may begin at any checkpoint; rows between two of them need nothing else.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

SCALE = 20
LANES = 256
EVERY = 128  # rows between checkpoints: a block has several
BLOCK_IDS = 1 << 17
HEADER = struct.Struct("<4sIIIQQI")
MAGIC, VERSION = b"RNS1", 1
LOW = np.uint64(32)


@dataclass(frozen=True)
class Frequencies:
    """Scaled frequencies of the ids 0 .. n-1; an id that occurs has at least 1."""

    scaled: np.ndarray
    before: np.ndarray

    @staticmethod
    def of_counts(counts: np.ndarray) -> Frequencies:
        """Scale counts so that they sum to 2**SCALE, none that occurs to 0."""
        total, whole = int(counts.sum()), 1 << SCALE
        if np.count_nonzero(counts) > whole:
            raise ValueError(f"more than {whole} distinct ids")
        if not total:
            return Frequencies.of_scaled(np.zeros(len(counts), np.uint64))
        scaled = np.where(counts > 0, np.maximum(1, counts.astype(np.float64) * (whole / total)), 0)
        scaled = np.floor(scaled).astype(np.int64)
        left = whole - int(scaled.sum())
        order = np.argsort(-scaled, kind="stable")
        if left > 0:
            scaled[order[0]] += left
        while left < 0:  # the floor of 1 for rare ids is paid by the frequent ones
            room = scaled[order] - 1
            give = np.minimum(room, np.maximum(1, room * -left // max(1, int(room.sum()))))
            give = np.where(np.cumsum(give) <= -left, give, 0)
            if not give.any():
                give[0] = min(int(room[0]), -left)
            scaled[order] -= give
            left += int(give.sum())
        return Frequencies.of_scaled(scaled.astype(np.uint64))

    @staticmethod
    def of_scaled(scaled: np.ndarray) -> Frequencies:
        before = np.zeros(len(scaled), np.uint64)
        before[1:] = np.cumsum(scaled)[:-1]
        return Frequencies(scaled, before)

    def slots(self) -> np.ndarray:
        """The id of each of the 2**SCALE slots."""
        return np.repeat(np.arange(len(self.scaled), dtype=np.uint32), self.scaled.astype(np.int64))


def encode_ids(ids: np.ndarray, table: Frequencies) -> tuple[list[tuple[int, int, np.ndarray]], np.ndarray]:
    """Checkpoints (row, word, states) and words of a sequence of ids."""
    rows = -(-len(ids) // LANES)
    states = np.full(LANES, 1 << 32, np.uint64)
    parts: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    given = 0
    freq, before = table.scaled[ids], table.before[ids]
    shift = np.uint64(64 - SCALE)
    for row in range(rows - 1, -1, -1):
        f, b = freq[row * LANES : (row + 1) * LANES], before[row * LANES : (row + 1) * LANES]
        x = states[: len(f)]
        over = (x >> shift) >= f
        if over.any():
            parts.append((x[over] & np.uint64(0xFFFFFFFF)).astype(np.uint32)[::-1])
            given += len(parts[-1])
            x = np.where(over, x >> LOW, x)
        quotient = x // f
        states[: len(f)] = (quotient << np.uint64(SCALE)) + (x - quotient * f) + b
        if row % EVERY == 0:
            marks.append((row, given, states.copy()))
    words = np.concatenate(parts)[::-1] if parts else np.zeros(0, np.uint32)
    return [(row, given - taken, s) for row, taken, s in reversed(marks)], words


def decode_ids(
    marks: list[tuple[int, int, np.ndarray]],
    words: np.ndarray,
    n: int,
    table: Frequencies,
    slots: np.ndarray,
    first: int = 0,
    last: int | None = None,
) -> np.ndarray:
    """The ids from checkpoint `first` up to checkpoint `last` (None: to the end).

    What lies between two checkpoints is decoded in step with all other such ranges; the ids
    after the last checkpoint follow, row by row.
    """
    if not marks:
        return np.zeros(0, np.uint32)
    whole = marks[first : len(marks) if last is None else last + 1]
    wide = words.astype(np.uint64)
    ranges = _in_step(whole, wide, table, slots)
    if last is not None:
        return ranges
    row, at, states = whole[-1]
    out = np.empty(n - row * LANES, np.uint32)
    states, mask = states.copy(), np.uint64((1 << SCALE) - 1)
    for begin in range(0, len(out), LANES):
        x = states[: min(LANES, len(out) - begin)]
        slot = x & mask
        ids = slots[slot]
        out[begin : begin + len(x)] = ids
        x = table.scaled[ids] * (x >> np.uint64(SCALE)) + slot - table.before[ids]
        short = np.flatnonzero(x < np.uint64(1 << 32))
        if len(short):
            x[short] = (x[short] << LOW) | wide[at : at + len(short)]
            at += len(short)
        states[: len(x)] = x
    return np.concatenate([ranges, out])


def _in_step(marks: list[tuple[int, int, np.ndarray]], wide: np.ndarray, table: Frequencies, slots: np.ndarray) -> np.ndarray:
    """The ids between the first and the last of the checkpoints, one row of every range at a time."""
    if len(marks) < 2:
        return np.zeros(0, np.uint32)
    x = np.stack([states for _, _, states in marks[:-1]])
    at = np.array([word for _, word, _ in marks[:-1]], np.int64)
    out = np.empty((len(x), EVERY, LANES), np.uint32)
    mask = np.uint64((1 << SCALE) - 1)
    for row in range(EVERY):
        slot = x & mask
        ids = slots[slot]
        out[:, row] = ids
        x = table.scaled[ids] * (x >> np.uint64(SCALE)) + slot - table.before[ids]
        short = x < np.uint64(1 << 32)
        taken = np.cumsum(short, axis=1)
        place = (at[:, None] + taken - 1)[short]
        x[short] = (x[short] << LOW) | wide[place]
        at += taken[:, -1]
    return out.reshape(-1)


def write_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, table: Frequencies) -> bytes:
    """A block of whole documents: their ids, one after the other, in the given order."""
    marks, words = encode_ids(ids, table)
    parts = [
        HEADER.pack(MAGIC, VERSION, LANES, len(doc_ids), len(ids), len(words), len(marks)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.asarray(lengths, "<i8").tobytes(),
    ]
    for row, at, states in marks:
        parts += [struct.pack("<QQ", row, at), states.astype("<u8").tobytes()]
    parts.append(words.astype("<u4").tobytes())
    body = b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A block's documents and checkpoints, and its ids on demand; a damaged one raises ValueError."""

    def __init__(self, block: bytes):
        if len(block) < HEADER.size + 4 or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
            raise ValueError("the block's checksum is wrong")
        magic, version, lanes, n_docs, n_ids, n_words, n_marks = HEADER.unpack_from(block)
        if (magic, version, lanes) != (MAGIC, VERSION, LANES):
            raise ValueError("not a block of this format")
        at = HEADER.size
        doc_ids = np.frombuffer(block, "<i8", n_docs, at)
        at += 8 * n_docs
        null = np.frombuffer(block, np.uint8, n_docs, at)
        at += n_docs
        self.lengths = np.frombuffer(block, "<i8", n_docs, at)
        at += 8 * n_docs
        self.marks = []
        for _ in range(n_marks):
            row, word = struct.unpack_from("<QQ", block, at)
            self.marks.append((row, word, np.frombuffer(block, "<u8", LANES, at + 16).astype(np.uint64)))
            at += 16 + 8 * LANES
        self.words = np.frombuffer(block, "<u4", n_words, at)
        self.size = n_ids
        self.doc_ids = [None if z else int(d) for d, z in zip(doc_ids, null)]

    def ids(self, table: Frequencies, slots: np.ndarray, begin: int = 0, end: int | None = None) -> np.ndarray:
        """The ids from begin to end, decoded from the checkpoint before to the one after them."""
        end = self.size if end is None else end
        if begin >= end:
            return np.zeros(0, np.uint32)
        rows = [row * LANES for row, _, _ in self.marks]
        first = max(k for k, row in enumerate(rows) if row <= begin)
        last = next((k for k, row in enumerate(rows) if row >= end), None)
        ids = decode_ids(self.marks, self.words, self.size, table, slots, first, last)
        return ids[begin - rows[first] : end - rows[first]]


def read_block(block: bytes, table: Frequencies, slots: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, numbers of ids, and all ids of a block."""
    opened = Block(block)
    return opened.doc_ids, opened.lengths, opened.ids(table, slots)
