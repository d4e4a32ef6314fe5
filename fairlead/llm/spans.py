"""Token spans of two tokenizers over the same bytes, and where they meet.

A is a byte-level vocabulary of the tokenizers library, B a sentencepiece model that puts a
space before a text. Both see a space and the text.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa

from fairlead.llm.common import text_bytes
from fairlead.llm.tokens import byte_letters

# Bytes of aligned pieces in each of the two generations that a worker remembers.
MEMORY = 112 << 20
# Pieces are encoded together in runs of about so many characters.
RUN = 1 << 16
SPACE = 0x20
SPAN = attrgetter("id", "begin", "end")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Spans:
    """Token ids of pieces of text, one after the other, with the byte at which each token ends."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, joined: bytes):
        self.ids = ids
        self.ends = ends
        self.joined = joined


def refined_ends(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where each token ends, from the libraries' spans (bytes) and the tokens' own lengths.

    The spans are coarse: tokens that share a character all have its span, and those of a
    character spelled in single bytes have an empty one but for the last. Spans are cut where
    one ends as the next begins; within a cut each token ends so many decoded bytes on.
    """
    if not len(sizes):
        return end
    cut = np.ones(len(end), bool)
    cut[:-1] = (end[:-1] <= begin[1:]) & (end[:-1] > begin[:-1])
    first = np.concatenate([[0], np.flatnonzero(cut)[:-1] + 1]) if cut.any() else np.zeros(1, np.int64)
    run = np.cumsum(np.concatenate([[0], cut[:-1]]))
    summed = np.cumsum(sizes)
    start = np.concatenate([[0], end[np.flatnonzero(cut)][:-1]])
    return start[run] + summed - (summed[first] - sizes[first])[run]


class Pair:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        value = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, n in self.a.get_vocab().items():
            self.a_bytes[n] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        self.b_bytes = []
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        for n, piece in enumerate(pieces):
            spelled = BYTE_PIECE.fullmatch(piece) if self.b.is_byte(n) else None
            self.b_bytes.append(bytes([int(spelled[1], 16)]) if spelled else piece.replace("▁", " ").encode())
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # Texts may be cut before a space after a letter if no token of either goes across.
        splitter = json.loads(self.a.to_str())
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        before = splitter["pre_tokenizer"] or {}
        self.seams = (
            splitter["normalizer"] is None
            and all(before.get(k) == v for k, v in plain.items())
            and not any(re.search("[^▁]▁", piece) for piece in pieces)
        )

    def spans_a(self, text: str) -> Spans:
        coded = self.a.encode(text, add_special_tokens=False)
        listed = coded.ids
        ids = np.array(listed, np.int64)
        spans = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        data = text.encode()
        if len(data) > len(text):
            starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            spans = np.concatenate([starts, [len(data)]])[spans]
        joined = b"".join(map(self.a_bytes.__getitem__, listed))
        return Spans(ids, refined_ends(spans[:, 0], spans[:, 1], self.a_sizes[ids]), joined)

    def spans_b(self, text: str) -> Spans:
        """Spans in the text with its leading space, which the model adds by itself."""
        coded = self.b.encode(text[1:], return_type="proto").pieces
        # Field by field: each piece is looked at once.
        ids, begin, end = np.fromiter(chain.from_iterable(map(SPAN, coded)), np.int64, 3 * len(coded)).reshape(-1, 3).T.copy()
        # The added space has no place in the spans: all move by it but the first begin.
        begin, end = begin + 1, end + 1
        begin[:1] = 0
        joined = b"".join(map(self.b_bytes.__getitem__, ids.tolist()))
        return Spans(ids, refined_ends(begin, end, self.b_sizes[ids]), joined)


class Aligned:
    """What is kept of a piece: its links as pairs of ids, its groups as text, its counts."""

    __slots__ = ("links", "shown", "n_a", "n_b", "n_groups")

    def __init__(self, links: bytes, shown: str, n_a: int, n_b: int, n_groups: int):
        self.links, self.shown, self.n_a, self.n_b, self.n_groups = links, shown, n_a, n_b, n_groups


FIELDS = attrgetter(*Aligned.__slots__)
NOTHING = Aligned(b"", "", 0, 0, 0)


def meet(a: Spans, b: Spans, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group of each A token, of each B token, first linked B and number of links of each A token, group ends."""
    common = np.intersect1d(a.ends, b.ends, assume_unique=True)
    a_start = np.concatenate([[0], a.ends[:-1]])
    b_start = np.concatenate([[0], b.ends[:-1]])
    lowest = np.searchsorted(b.ends, a_start, side="right")
    links = np.searchsorted(b_start, a.ends, side="left") - lowest
    return np.searchsorted(common, a.ends), np.searchsorted(common, b.ends), lowest, links, common


def _texts(size: int, *ends: str) -> np.ndarray:
    """The ids below size as text, a row for each end."""
    return np.array([[f"{n}{end}" for n in range(size)] for end in ends], object)


class Aligner:
    """Alignments of whole texts, by way of their distinct pieces between seams.

    A seam is a space after a printable ASCII character or a letter of two bytes, with text
    after it. The splitting of A never goes across one, and no piece of B has a space after
    another character, so neither has a token across it, and both ends of a seam's piece are
    ends of a token of both. Each distinct piece is therefore aligned once. Where a piece's
    tokens do not spell it, the whole text is encoded at once and compared.
    """

    def __init__(self, a_path: str, b_path: str):
        self.pair = Pair(a_path, b_path)
        # Pieces met since the last turn, and those of the turn before that were not met again.
        self.known: dict[str, Aligned | None] = {}
        self.older: dict[str, Aligned | None] = {}
        self.held = 0
        widest = max(len(self.pair.a_bytes), len(self.pair.b_bytes))
        self.shift = 16 if widest <= 1 << 16 else 32
        self.kind = np.dtype("<u4" if self.shift == 16 else "<u8")
        # Every id as text, before another of its side and before what else may follow; a piece ends a line.
        self.a_texts = _texts(len(self.pair.a_bytes), ",", "|")
        self.b_texts = _texts(len(self.pair.b_bytes), ",", ";", "\n")

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces, each with the space before it, and the number of them in each text."""
        data, at = text_bytes(texts)
        n = len(texts)
        lengths = np.diff(at)
        some = lengths > 0
        spaced = np.insert(data, at[:-1][some], SPACE)
        at = np.concatenate([[0], np.cumsum(lengths + some)])
        begins = np.zeros(len(spaced) + 1, bool)
        if self.pair.seams and len(spaced) > 2:
            letter = (spaced > SPACE) & (spaced < 0x7F)
            letter[1:] |= (spaced[1:] >= 0x80) & (spaced[:-1] >= 0xC3) & (spaced[:-1] <= 0xDF)
            begins[1:-1] = (spaced[1:] == SPACE) & letter[:-1]
            begins[at[1:][some] - 1] = False
        begins[at[:-1][some]] = True
        begins[-1] = False
        starts = np.flatnonzero(begins)
        counts = np.bincount(np.searchsorted(at, starts, side="right") - 1, minlength=n)
        offsets = np.concatenate([starts, [len(spaced)]]).astype(np.int32)
        made = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(spaced.tobytes()))
        return made, counts

    def align_run(self, run: list[str]) -> list[Aligned | None]:
        """The alignments of pieces that may follow each other; None where tokens do not spell it."""
        text = "".join(run)
        data = text.encode()
        a, b = self.pair.spans_a(text), self.pair.spans_b(text)
        if a.joined != data or b.joined != data:
            return [None] if len(run) == 1 else [x for piece in run for x in self.align_run([piece])]
        sizes = np.array([len(piece.encode()) for piece in run] if len(data) > len(text) else list(map(len, run)), np.int64)
        after = np.cumsum(sizes)
        if not (np.isin(after, a.ends).all() and np.isin(after, b.ends).all()):
            return [x for piece in run for x in self.align_run([piece])]
        a_group, b_group, lowest, links, common = meet(a, b, len(data))
        # Links as pairs of ids, in the order of A's tokens.
        begin = np.cumsum(links) - links
        other = np.repeat(lowest - begin, links) + np.arange(links.sum())
        pairs = (np.repeat(a.ids, links) << self.shift | b.ids[other]).astype(self.kind)
        # Each token's text with what follows it; A's tokens of a group come before B's.
        a_piece, b_piece = np.searchsorted(after, a.ends), np.searchsorted(after, b.ends)
        a_more, b_more = np.zeros(len(a_group), bool), np.zeros(len(b_group), bool)
        a_more[:-1], b_more[:-1] = a_group[1:] == a_group[:-1], b_group[1:] == b_group[:-1]
        b_last = np.isin(b.ends, after)
        shown = np.empty(len(a_group) + len(b_group), object)
        a_at = np.arange(len(a_group)) + np.searchsorted(b_group, a_group, side="left")
        b_at = np.arange(len(b_group)) + np.searchsorted(a_group, b_group, side="right")
        shown[a_at] = self.a_texts[np.where(a_more, 0, 1), a.ids]
        shown[b_at] = self.b_texts[np.where(b_more, 0, np.where(b_last, 2, 1)), b.ids]
        shown = "".join(shown.tolist()).split("\n")
        k = len(run)
        n_a, n_b = np.bincount(a_piece, minlength=k), np.bincount(b_piece, minlength=k)
        n_groups = np.bincount(np.searchsorted(after, common), minlength=k)
        n_links = np.bincount(np.repeat(a_piece, links), minlength=k)
        packed = pairs.tobytes()
        ends = (np.concatenate([[0], np.cumsum(n_links)]) * self.kind.itemsize).tolist()
        rows = zip(ends, ends[1:], shown, n_a.tolist(), n_b.tolist(), n_groups.tolist())
        return [Aligned(packed[i:j], groups, x, y, z) for i, j, groups, x, y, z in rows]

    def learn(self, fresh: list[str]) -> None:
        run: list[str] = []
        size = 0
        for piece in [*fresh, None]:
            if piece is None or size > RUN:
                for name, entry in zip(run, self.align_run(run) if run else []):
                    self.keep(name, entry)
                run, size = [], 0
            if piece is None:
                break
            # A piece that ends in no letter has no seam after it: it is a run of its own.
            if "!" <= piece[-1] <= "~" or "À" <= piece[-1] <= "߿":
                run.append(piece)
                size += len(piece)
            else:
                self.keep(piece, self.align_run([piece])[0])

    def keep(self, piece: str, entry: Aligned | None) -> None:
        self.known[piece] = entry
        self.held += 2 * len(piece) + (len(entry.links) + len(entry.shown) + 300 if entry else 100)

    def align(self, texts: pa.Array) -> tuple[list[Aligned | None], np.ndarray, np.ndarray]:
        """Of each text the alignments of its pieces: entries, the entry of each piece, pieces a text."""
        made, counts = self.pieces(texts)
        coded = made.dictionary_encode()
        vocabulary = coded.dictionary.to_pylist()
        if self.held > MEMORY:
            self.older, self.known, self.held = self.known, {}, 0
        fresh = []
        entries = list(map(self.known.get, vocabulary))
        for piece in [piece for piece, entry in zip(vocabulary, entries) if entry is None]:
            if piece in self.older:
                self.keep(piece, self.older.pop(piece))
            elif piece not in self.known:
                fresh.append(piece)
        self.learn(fresh)
        entries = [self.known[piece] if entry is None else entry for piece, entry in zip(vocabulary, entries)]
        return entries, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts

    def whole(self, text: str) -> Aligned | None:
        """The alignment of a text encoded at once; None if the tokens do not spell it."""
        return self.align_run([" " + text])[0]


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)
