"""Substring deduplication by recompression of word sequences.

Rounds name runs of one symbol, then pairs of neighbours whose coins fall left and right. Names
and coins are hashes of what they stand for, so every task gives equal substrings the same
names, with no dictionary to share, except near their ends. Each symbol also knows the stretch
of words that its parse depends on: in every substring that holds this stretch, it appears.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fairlead.llm.common import BASES, Rolling, arrow_rows, mix, stretch_hashes, text_bytes, words
from fairlead.llm.packs import Answers, Keys, answer_keys, ask, conclude, pack_documents

WINDOW = 35
LOW_ROUNDS = 4
MOST_ROUNDS = 40
NAMES, LONG, WINDOWS = 1, 2, 3
WIDTH = {NAMES: 6, LONG: 16, WINDOWS: 12}
STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Level:
    """Symbols in order: names, words [start, end), words [low, high) that decide them."""

    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    fixed: np.ndarray  # the marks between documents, which take part in nothing

    def runs(self, seed: int) -> Level:
        n = len(self.name)
        fresh = np.ones(n, bool)
        fresh[1:] = (self.name[1:] != self.name[:-1]) | self.fixed[1:] | self.fixed[:-1]
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], n) - 1
        count = last - first + 1
        with np.errstate(over="ignore"):
            named = mix(self.name[first] * STEP + count.astype(np.uint64), seed)
        # A run ends where the neighbours differ, so they decide it too.
        before, after = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
        return Level(
            np.where(count > 1, named, self.name[first]),
            self.start[first],
            self.end[last],
            self.low[before],
            self.high[after],
            self.fixed[first],
        )

    def pairs(self, seed: int) -> Level:
        n = len(self.name)
        coin = (mix(self.name, seed) >> np.uint64(63)).astype(bool)
        left, right = ~coin & ~self.fixed, coin & ~self.fixed
        opens = np.zeros(n, bool)
        opens[:-1] = left[:-1] & right[1:]
        second = np.zeros(n, bool)
        second[1:] = opens[:-1]
        at = np.flatnonzero(~second)
        paired, after, before = opens[at], np.minimum(at + 1, n - 1), np.maximum(at - 1, 0)
        with np.errstate(over="ignore"):
            named = mix(mix(self.name[at], seed + 1) * STEP + self.name[after], seed + 2)
        # A left symbol depends on the next one, a right symbol on the one before.
        return Level(
            np.where(paired, named, self.name[at]),
            self.start[at],
            np.where(paired, self.end[after], self.end[at]),
            np.where(left[at], self.low[at], self.low[before]),
            np.where(left[at], self.high[after], self.high[at]),
            self.fixed[at],
        )


class Parse:
    """The words of a pack's documents, with a mark before each document and after the last."""

    def __init__(self, texts: pa.Array, window: int):
        self.window = window
        data, at = text_bytes(texts)
        start, end, row = words(data, at)
        self.count = np.bincount(row, minlength=len(texts))
        self.place = np.arange(len(row)) + row + 1
        total = len(row) + len(texts) + 1
        self.fixed = np.ones(total, bool)
        self.fixed[self.place] = False
        one, two = np.zeros(total, np.uint64), np.zeros(total, np.uint64)
        one[self.place] = stretch_hashes(data, start, end, 51)
        two[self.place] = stretch_hashes(data, start, end, 52)
        self.words = one
        self.rolls = Rolling(one, 53), Rolling(two, 54, BASES[1])
        edge = np.cumsum(self.fixed)
        # Where a whole window of one document begins.
        self.whole = np.zeros(total, bool)
        if total > window:
            self.whole[: total - window + 1] = ~self.fixed[: total - window + 1]
            self.whole[: total - window + 1] &= edge[: total - window + 1] == edge[window - 1 :]

    def levels(self) -> tuple[Level, Long]:
        """The low level, and the symbols that first reach a window's length, four times that, ..."""
        n = np.arange(len(self.words))
        level = Level(self.words, n, n + 1, n, n + 1, self.fixed)
        low, grades = level, []
        marks: list[np.ndarray] = []
        for k in range(MOST_ROUNDS):
            before = len(level.name)
            level = level.runs(100 + 10 * k).pairs(105 + 10 * k)
            if k + 1 <= LOW_ROUNDS:
                low = level
            length = level.end - level.start
            grade = 0
            while (reached := np.flatnonzero(length >= self.window << 2 * grade)).size:
                if grade == len(grades):
                    grades.append(([], []))
                    marks.append(np.zeros(len(self.words) + 1, np.int64))
                start, end = level.start[reached], level.end[reached]
                upto = np.cumsum(marks[grade])
                fresh = upto[end - 1] == np.where(start > 0, upto[start - 1], 0)
                grades[grade][0].append(start[fresh])
                grades[grade][1].append(end[fresh])
                marks[grade][start[fresh]] = 1
                grade += 1
            if k + 1 >= LOW_ROUNDS and len(level.name) == before:
                break
        none = [np.zeros(0, np.int64)]
        starts = [np.concatenate(s) for s, _ in grades]
        which = np.repeat(np.arange(len(starts)), [len(x) for x in starts])
        start, end = np.concatenate(starts + none), np.concatenate([np.concatenate(e) for _, e in grades] + none)
        # A symbol that passes several lengths at once counts once, in the highest grade.
        order = np.lexsort((-which, end, start))
        kept = np.ones(len(order), bool)
        kept[1:] = (np.diff(start[order]) != 0) | (np.diff(end[order]) != 0)
        order = order[kept]
        return low, Long(start[order], end[order], which[order])


@dataclass
class Long:
    """Symbols of a window's length or more: words [start, end), and grade by length.

    Within a grade they are apart from each other; each lies inside at most one of a higher.
    """

    start: np.ndarray
    end: np.ndarray
    grade: np.ndarray


def _union(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of 0 .. n-1 lie in any [start, end)."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps)[:n] > 0


def first_keys(parse: Parse, buckets: int) -> tuple[Level, Long, Keys, Keys]:
    low, long = parse.levels()
    inner = np.flatnonzero(~low.fixed)
    low = Level(*(getattr(low, f)[inner] for f in ("name", "start", "end", "low", "high", "fixed")))
    one, two = parse.rolls
    keys = Keys(LONG, buckets, WIDTH[LONG], one.of(long.start, long.end), two.of(long.start, long.end))
    return low, long, Keys(NAMES, buckets, WIDTH[NAMES], low.name), keys


def second_keys(parse: Parse, buckets: int, answers: Answers) -> tuple[np.ndarray, np.ndarray, Keys]:
    """Words covered by shared long symbols, the windows to ask for, and those windows' keys.

    A window need not be asked for if it holds a symbol that occurs only once, with all that
    decides it: such a symbol occurs wherever the window does. Nor if the longest shared symbol
    around it has another occurrence as its owner: its words are covered, and the owner asks.
    """
    low, long, names, keys = first_keys(parse, buckets)
    n, window = len(parse.words), parse.window
    shared, owned = keys.shared(answers), keys.owned(answers)
    covered = _union(n, long.start[shared], long.end[shared])
    alone = ~names.shared(answers)
    first, last = np.maximum(low.high[alone] - window, 0), low.low[alone]
    inside = first <= last
    left_out = _union(n, first[inside], last[inside] + 1)
    decided = np.zeros(n, bool)
    for grade in range(int(long.grade.max(initial=-1)), -1, -1):
        here = shared & (long.grade == grade)
        around = _union(n, long.start[here], long.end[here] - window + 1)
        foreign = here & ~owned
        left_out |= _union(n, long.start[foreign], long.end[foreign] - window + 1) & ~decided
        decided |= around
    at = np.flatnonzero(parse.whole & ~left_out)
    one, two = parse.rolls
    return covered, at, Keys(WINDOWS, buckets, WIDTH[WINDOWS], one.of(at, at + window), two.of(at, at + window))


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and the kept text, its words joined by one space.

    A word goes if a run of `window` words around it also starts anywhere else, in the same
    document or another; all are judged on the input. Null texts have no words and become
    empty. Null ids and repeated rows are documents like any other, so a row that repeats a
    long text loses all of it, like its twin. An empty table gives no rows; columns other than
    doc_id and text are ignored. A text longer than a pack is a pack of its own.

    Three passes over packs of documents: one asks which low symbols and which symbols of a
    window's length or more occur twice; the second asks, by two 64-bit hashes of their words,
    for the windows that these leave in question; the last removes.
    """
    packs = pack_documents(docs)
    buckets = packs.buckets

    def first(batch: pa.RecordBatch, _: Answers) -> list[Keys]:
        return list(first_keys(Parse(batch.column(1), window), buckets)[2:])

    def second(batch: pa.RecordBatch, told: Answers) -> list[Keys]:
        return [second_keys(Parse(batch.column(1), window), buckets, told)[2]]

    def last(batch: pa.RecordBatch, told: Answers) -> pa.RecordBatch:
        parse = Parse(batch.column(1), window)
        covered, at, keys = second_keys(parse, buckets, told)
        at = at[keys.shared(told)]
        gone = (covered | _union(len(covered), at, at + window))[parse.place]
        removed, texts, done = [], [], 0
        for text, n in zip(batch.column(1), parse.count):
            part = gone[done : done + n]
            done += n
            removed.append(int(part.sum()))
            held = text.as_py().encode().split()
            texts.append(b" ".join(held if not removed[-1] else compress(held, ~part)).decode())
        return arrow_rows(RESULT, doc_id=batch.column(0), n_words=parse.count.astype(np.int64), n_removed=removed, text=texts)

    reply = answer_keys(WIDTH, owners={LONG})
    told = ask(packs, None, first, reply, "symbols")
    told = ask(packs, told, second, reply, "windows")
    return conclude(packs, told, last, "doc_id long, n_words long, n_removed long, text string")
