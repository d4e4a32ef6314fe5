"""Suffix-array deduplication of byte strings.

Texts are cut at anchors, places where a hash of the next GRAM bytes is small: anchors depend on
those bytes alone, so equal strings have the same ones. The chunks from anchor to anchor are the
symbols of the suffix arrays. Suffixes that begin with the same chunk (or, where very many packs
have it, with the same chunks up to a rarer one) meet in one bucket, are sorted there by linear grouping (see `suffixes`), and the neighbour in the order tells how far a
string is repeated; a string ends about a window after its second anchor. What the order does
not mark is decided by windows of bytes alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fairlead.llm.common import BASES, Rolling, arrow_rows, mix, text_bytes
from fairlead.llm.packs import ANSWERED, Answers, Keys, answer_keys, ask, conclude, pack_documents
from fairlead.llm.suffixes import longest_shared

WINDOW = 200
GRAM = 8
# Mean distance of the anchors that sift windows, and of those (every fourth or so of them) that
# part the symbols of the suffix arrays.
FINE, COARSE = 24, 72
NAMES, SUFFIXES, WINDOWS = 1, 2, 3
WIDTH = {NAMES: 6, WINDOWS: 12}
MOST_SYMBOLS = 250
# Chunks in so many packs or more are crowded.
CROWD = 32


def _union(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of 0 .. n-1 lie in any [start, end)."""
    steps = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


class Cuts:
    """The bytes of a pack's documents and their anchors."""

    def __init__(self, texts: pa.Array, window: int):
        self.window = window
        self.data, self.at = text_bytes(texts)
        n = len(self.data)
        self.size = n
        letters = mix(np.arange(256, dtype=np.uint64), 71)
        self.rolls = Rolling(letters[self.data], 72), Rolling(mix(letters, 73)[self.data], 74, BASES[1])
        self.anchors = np.zeros(0, np.int64)
        self.coarse = np.zeros(0, bool)
        if n >= GRAM:
            grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.data, GRAM))
            hashed = mix(grams.view("<u8").ravel(), 75)
            found = np.flatnonzero(hashed < np.uint64(2**64 // FINE))
            row = np.searchsorted(self.at, found, side="right") - 1
            found = found[found + GRAM <= self.at[row + 1]]
            self.anchors, self.coarse = found, hashed[found] < np.uint64(2**64 // COARSE)
        self.row = np.searchsorted(self.at, self.anchors, side="right") - 1
        # A chunk runs from an anchor to the end of the next one's gram, in one document.
        self.chunk = np.flatnonzero(self.row[1:] == self.row[:-1])
        self.start, self.end = self.anchors[self.chunk], self.anchors[self.chunk + 1] + GRAM

    def names(self, buckets: int) -> Keys:
        return Keys(NAMES, buckets, WIDTH[NAMES], self.rolls[0].of(self.start, self.end))

    def windows(self, alone: np.ndarray) -> np.ndarray:
        """Where windows begin that hold no chunk which occurs only once."""
        first = np.maximum(self.end[alone] - self.window, 0)
        last = self.start[alone]
        inside = first <= last
        barred = _union(self.size, first[inside], last[inside] + 1)
        room = np.zeros(self.size, bool)
        ends = np.maximum(self.at[1:] - self.window + 1, self.at[:-1])
        room |= _union(self.size, self.at[:-1], ends)
        return np.flatnonzero(room & ~barred)


class Suffixes(Keys):
    """The symbol strings that begin at coarse anchors and hold no chunk which occurs only once.

    A string goes on until it holds every window that begins before its second anchor, or ends
    at a chunk that occurs only once or at the document's last anchor; strings that hold no
    window are left out. `symbols` are names of the coarse chunks; string i has those from
    begin[i], length[i] of them.
    """

    def __init__(self, cuts: Cuts, alone: np.ndarray, buckets: int, crowded: np.ndarray):
        lonely = np.zeros(len(cuts.anchors) + 1, np.int64)
        lonely[cuts.chunk[alone] + 1] = 1
        lonely = np.cumsum(lonely)
        where = np.flatnonzero(cuts.coarse)
        place, row = cuts.anchors[where], cuts.row[where]
        # Symbol i goes from coarse anchor i to the next one; good if it may be repeated.
        good = np.zeros(len(where), bool)
        if len(where) > 1:
            good[:-1] = (row[1:] == row[:-1]) & (lonely[where[1:]] == lonely[where[:-1]])
        stop = np.append(place[1:] + GRAM, 0)
        symbol = np.zeros(len(where), np.uint64)
        symbol[good] = cuts.rolls[0].of(place[good], stop[good])
        # The first symbol at or after i that is not good, and the first that reaches far enough.
        bad = np.append(np.flatnonzero(~good), len(where))
        limit = bad[np.searchsorted(bad, np.arange(len(where)))]
        needed = np.append(place[1:], 0) + cuts.window - 1
        enough = np.searchsorted(place, needed - GRAM) if len(place) else limit
        last = np.minimum(np.minimum(limit, enough), np.arange(len(where)) + MOST_SYMBOLS)
        begin = np.flatnonzero(good & (last > np.arange(len(where))))
        last = last[begin]
        begin = begin[place[last] + GRAM - place[begin] >= cuts.window]
        last = np.minimum(np.minimum(limit, enough), np.arange(len(where)) + MOST_SYMBOLS)[begin]
        self.place, self.symbol, self.begin, self.length = place, symbol, begin, last - begin
        one, two = (r.of(place[begin], place[last] + GRAM) for r in cuts.rolls)
        # A symbol is crowded if all its chunks are: strings are dealt by what they begin with up
        # to the first symbol that is not, so that a passage of very many packs is no one bucket.
        spare = np.ones(len(cuts.anchors) + 1, np.int64)
        spare[0] = 0
        spare[cuts.chunk[crowded] + 1] = 0
        spare = np.cumsum(spare)
        free = np.ones(len(where), bool)
        if len(where) > 1:
            free[:-1] = spare[where[1:]] > spare[where[:-1]]
        plain = np.append(np.flatnonzero(free), len(where))
        until = np.minimum(plain[np.searchsorted(plain, begin)] + 1, last)
        super().__init__(SUFFIXES, buckets, 0, one, two, deal=cuts.rolls[0].of(place[begin], place[until] + GRAM))

    def payload(self, source: np.ndarray) -> bytes:
        """Number of strings, their lengths, and their symbols one after the other."""
        begin, length = self.begin[source], self.length[source]
        skipped = np.cumsum(length) - length
        at = np.repeat(begin - skipped, length) + np.arange(int(length.sum()))
        return b"".join(
            [np.uint32(len(source)).tobytes(), length.astype(np.uint8).tobytes(), self.symbol[at].astype("<u8").tobytes()]
        )

    def told(self, answers: Answers) -> tuple[np.ndarray, np.ndarray]:
        """Per string, the bytes of it that are repeated, and those that another string asks about."""
        known, owned = np.zeros(len(self.count), np.int64), np.zeros(len(self.count), np.int64)
        for part, sizes in self.replies(answers):
            known[part], owned[part] = np.frombuffer(sizes, np.uint8).reshape(2, -1)
        shared, left = known[self.item], owned[self.item]
        shared = np.where(self.count[self.item] > 1, self.length, shared)
        left = np.where(self.leads(), left, self.length)
        span = lambda m: np.where(m > 0, self.place[self.begin + m] + GRAM - self.place[self.begin], 0)
        return span(shared), span(left)


def answer_suffixes(asked: pa.Table) -> pa.Table:
    """Sort a bucket's strings; per string the leading symbols shared with any, and with one before.

    Equal strings of several packs are one string to the suffix array; all but one of them
    leave everything to that one.
    """
    strings: list[bytes] = []
    for row in asked["keys"]:
        raw = row.as_buffer().to_pybytes()
        n = int(np.frombuffer(raw, "<u4", 1)[0])
        lengths = np.frombuffer(raw, np.uint8, n, 4).astype(np.int64)
        at = 4 + n + 8 * np.concatenate([[0], np.cumsum(lengths)])
        strings.append([raw[a:b] for a, b in zip(at[:-1], at[1:])])
    seen: dict[bytes, int] = {}
    times: list[int] = []
    for row in strings:
        for text in row:
            number = seen.setdefault(text, len(seen))
            if number == len(times):
                times.append(0)
            times[number] += 1
    most, earlier = longest_shared([np.frombuffer(t, "<u8") for t in seen])
    taken = [False] * len(times)
    replies = []
    for row in strings:
        shared, left = [], []
        for text in row:
            number = seen[text]
            whole = len(text) // 8
            shared.append(whole if times[number] > 1 else int(most[number]))
            left.append(whole if taken[number] else int(earlier[number]))
            taken[number] = True
        replies.append(bytes(shared) + bytes(left))
    return pa.table([asked["ask"], asked["bucket"], asked["pack"], pa.array(replies, pa.binary())], schema=ANSWERED)


def window_keys(cuts: Cuts, answers: Answers, buckets: int) -> tuple[np.ndarray, np.ndarray, Keys]:
    """Bytes covered by repeated strings, the windows to ask for, and those windows' keys.

    A window belongs to the last coarse anchor at or before its start. If the string from there
    leaves it to a string earlier in the suffix array, that one or one before it asks.
    """
    names = cuts.names(buckets)
    alone = ~names.shared(answers)
    strings = Suffixes(cuts, alone, buckets, names.crowded(answers))
    shared, left = strings.told(answers)
    begin = strings.place[strings.begin]
    long = shared >= cuts.window
    covered = _union(cuts.size, begin[long], begin[long] + shared[long])
    after = np.append(strings.place[1:], cuts.size)[strings.begin]
    until = np.minimum(begin + left - cuts.window + 1, after)
    some = until > begin
    left_out = _union(cuts.size, begin[some], until[some])
    at = cuts.windows(alone)
    at = at[~left_out[at]]
    one, two = (r.of(at, at + cuts.window) for r in cuts.rolls)
    return covered, at, Keys(WINDOWS, buckets, WIDTH[WINDOWS], one, two)


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
)
DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def drop_byte_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes.

    A byte of the UTF-8 text goes if a string of `window` bytes around it also starts anywhere
    else, in the same document or another; all are judged on the input. Null texts are empty.
    Null ids and repeated rows are documents like any other. An empty table gives no rows;
    columns other than doc_id and text are ignored. A text longer than a pack is a pack of its
    own. The kept bytes need not be valid UTF-8, as a string may begin or end within a character.
    """
    if window <= 4 * GRAM:
        raise ValueError(f"a window needs more than {4 * GRAM} bytes")
    packs = pack_documents(docs)
    buckets = packs.buckets

    def name(batch: pa.RecordBatch, _: Answers) -> list[Keys]:
        return [Cuts(batch.column(1), window).names(buckets)]

    def suffixes(batch: pa.RecordBatch, told: Answers) -> list[Keys]:
        cuts = Cuts(batch.column(1), window)
        names = cuts.names(buckets)
        return [Suffixes(cuts, ~names.shared(told), buckets, names.crowded(told))]

    def windows(batch: pa.RecordBatch, told: Answers) -> list[Keys]:
        return [window_keys(Cuts(batch.column(1), window), told, buckets)[2]]

    def last(batch: pa.RecordBatch, told: Answers) -> pa.RecordBatch:
        cuts = Cuts(batch.column(1), window)
        covered, at, keys = window_keys(cuts, told, buckets)
        at = at[keys.shared(told)]
        gone = covered | _union(cuts.size, at, at + window)
        kept, removed, spans = [], [], []
        for a, b in zip(cuts.at[:-1], cuts.at[1:]):
            part = gone[a:b]
            kept.append(cuts.data[a:b][~part].tobytes())
            removed.append(int(part.sum()))
            spans.append(int(part[:1].sum() + (part[1:] & ~part[:-1]).sum()))
        return arrow_rows(
            RESULT, doc_id=batch.column(0), n_bytes=np.diff(cuts.at), n_removed=removed, n_spans=spans, kept=kept
        )

    told = ask(packs, None, name, answer_keys(WIDTH, many={NAMES: CROWD}), "chunks")
    told = ask(packs, told, suffixes, answer_suffixes, "suffixes")
    told = ask(packs, told, windows, answer_keys(WIDTH), "byte-windows")
    return conclude(packs, told, last, DDL)
