import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from fairlead.llm import alignment, spans
from fairlead.llm.queries import QUERIES, tokenizer_path
from fairlead.llm.tokens import byte_letters
from pyspark.sql import functions as F
from tests.llm.helpers import documents

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers' tokens of a whole text, as (id, bytes)."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    value = {letter: n for n, letter in enumerate(byte_letters())}

    def of_b(n):
        piece = b.id_to_piece(n)
        byte = re.fullmatch("<0x(..)>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def tokens(text):
        left = a.encode(" " + text, add_special_tokens=False)
        return [(n, bytes(value[c] for c in t)) for n, t in zip(left.ids, left.tokens)], [(n, of_b(n)) for n in b.encode(text)]

    return tokens


def aligned(docs, tokens):
    """The contract in plain Python, from whole texts."""
    made = []
    for doc, text in docs:
        a, b = tokens(text) if text else ([], [])
        if b"".join(x for _, x in a) != (" " + (text or "")).encode() or b"".join(x for _, x in b) != (" " + (text or "")).encode():
            a = b = []
        ends = []
        for side in (a, b):
            at, places = 0, []
            for _, x in side:
                places.append((at, at := at + len(x)))
            ends.append(places)
        common = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
        groups = []
        at = 0
        for c in common:
            groups.append([[n for (n, _), (s, e) in zip(side, places) if at < e <= c] for side, places in zip((a, b), ends)])
            at = c
        links, first = [], 0
        for (x, _), (s, e) in zip(a, ends[0]):
            while first < len(b) and ends[1][first][1] <= s:
                first += 1
            k = first
            while k < len(b) and ends[1][k][0] < e:
                links.append((x, b[k][0]))
                k += 1
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        made.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    count = Counter(x for m in made for x in m[4])
    best = {}
    for (x, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    rows = [(d, x, y, g, len(ls), sum(count[k] == best[k[1]] for k in ls), sum(count[k] for k in ls), sha) for d, x, y, g, ls, sha in made]
    return sorted(rows, key=str)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


ODD = [
    "a", " ", "  ", " a", "a ", "a  ", "a\n", "\n", "a \n b", "\n\nx y", "tab\there \t there", "x ▁ y", "▁", "a b   c　 d e",
    "<|endoftext|> <s> </s> <unk> <0x41> <|endoftext|>x", "naïve É́ é 日本語テキスト 😀👩‍👩‍👧 Straße", "don't I'll we've 's 12 345 3.14 ,. !? a.b,c",
    "\x00 \x01x\x1f\x85 y \x85z", "؀ ۿ ݀ ߿ ࠀ x", "word" * 400 + " " + "é" * 300 + " 日" * 200,
]


def test_whole_table(llm_spark, sf_dir, real, plain):
    assert found(QUERIES["op12_align_tokenizers"](llm_spark, sf_dir)) == aligned(real, plain)


def test_odd_texts(llm_spark, odd, plain):
    """Also where most pairs are too rare to be looked up without a shuffle."""
    draw = random.Random(8)
    letters = "ab .,\n\t'0é日😀▁ 　-<>|"
    rows = [*odd, (50, ODD[1]), *((100 + n, t) for n, t in enumerate(ODD)), (None, "no id")]
    rows += [(500 + n, "".join(draw.choice(letters[: draw.choice([8, 14, 99])]) for _ in range(draw.choice([3, 30, 300])))) for n in range(150)]
    rows.append((9999, "".join(draw.choice("abc日é") for _ in range(30_000))))
    docs = documents(llm_spark, rows).withColumns({"row": F.lit("x"), "pairs": F.lit(1), "n": F.lit(1), "pair": F.lit(0)})
    want = aligned(rows, plain)
    for common in (alignment.COMMON, 40):
        assert found(alignment.align_tokenizers(docs.repartition(5), A, B, common)) == want
    assert alignment.align_tokenizers(docs.limit(0), A, B).count() == 0


def test_spans_are_refined_by_bytes():
    """Tokens inside a character end where their bytes do; the worker's memory is bounded and may start anew."""
    pair = spans.Pair(A, B)
    assert pair.seams
    for text in (" héllo 日本 \U0001f9ffx \U0001f9ff\U0001f9ff", " ͸͹ 𒀀"):
        for side, table in ((pair.spans_a(text), pair.a_bytes), (pair.spans_b(text), pair.b_bytes)):
            at, ends = 0, []
            for n in side.ids:
                ends.append(at := at + len(table[n]))
            assert side.ends.tolist() == ends and side.joined == text.encode()
    tool = spans.Aligner(A, B)
    texts = pa.array([f"some words {n} and {n * n} more" for n in range(300)])
    before = [e.shown for e in tool.align(texts)[0]]
    held = tool.held
    for _ in range(3):
        tool.held = spans.MEMORY + 1
        assert [e.shown for e in tool.align(texts)[0]] == before and tool.held == held
        assert not tool.older
    tool.held = spans.MEMORY + 1
    tool.align(pa.array(["something else"]))
    assert len(tool.known) < 5 and len(tool.older) > 300


def test_tokens_and_pieces_are_read_once():
    """Getters of the libraries build new objects each time, so none is asked twice for a text."""
    pair, asked = spans.Pair(A, B), Counter()

    class Seen:
        def __init__(self, inner, name):
            self.inner, self.name = inner, name

        def __getattr__(self, field):
            asked[self.name, field] += 1
            return getattr(self.inner, field)

    class Pieces(list):
        def __iter__(self):
            asked["b", "pieces"] += 1
            return super().__iter__()

    class Coder:
        def __init__(self, inner, wrap):
            self.inner, self.wrap = inner, wrap

        def encode(self, text, **options):
            return self.wrap(self.inner.encode(text, **options))

    text = " some wörds, of 日本"
    want = [(side.ids.tolist(), side.ends.tolist(), side.joined) for side in (pair.spans_a(text), pair.spans_b(text))]
    pair.a = Coder(pair.a, lambda coded: Seen(coded, "a"))
    pair.b = Coder(pair.b, lambda coded: type("Coded", (), {"pieces": Pieces(coded.pieces)}))
    sides = pair.spans_a(text), pair.spans_b(text)
    assert [(side.ids.tolist(), side.ends.tolist(), side.joined) for side in sides] == want
    assert asked == {("a", "ids"): 1, ("a", "offsets"): 1, ("b", "pieces"): 1}
