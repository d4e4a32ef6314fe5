import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fairlead.llm import rans, tokens
from fairlead.llm.queries import QUERIES, tokenizer_path
from tests.llm.helpers import documents


def expected(docs):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table(llm_spark, sf_dir, real):
    got = sorted(map(tuple, QUERIES["op1_token_files"](llm_spark, sf_dir).collect()))
    assert got == expected(real)


def test_odd_texts(llm_spark, odd):
    odd = [*odd, (None, "no id")]
    got = [tuple(r) for r in tokens.token_files(documents(llm_spark, odd), tokenizer_path()).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(odd)


def test_empty_table_and_extra_columns(llm_spark):
    empty = documents(llm_spark, [])
    assert tokens.token_files(empty, tokenizer_path()).collect() == []
    clash = documents(llm_spark, [(1, "a b")]).selectExpr("*", "1 as part", "2 as ids", "3 as n_tokens", "4 as first")
    assert len(tokens.token_files(clash, tokenizer_path()).collect()) == 1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=3000), st.integers(1, 50))
def test_round_trip(ids, repeat):
    ids = np.array(ids * repeat, np.uint32)[:60_000]
    counts = np.bincount(ids, minlength=1)
    table = rans.Frequencies.of_counts(counts)
    if len(ids):
        assert table.scaled.sum() == 1 << rans.SCALE
    block = rans.write_block([None, 7], np.array([0, len(ids)]), ids, table)
    doc_ids, lengths, got = rans.read_block(block, table, table.slots())
    assert doc_ids == [None, 7] and list(lengths) == [0, len(ids)] and (got == ids).all()


def test_checkpoints_decode_on_their_own():
    ids = np.random.default_rng(1).zipf(1.3, 400_000) % 49_000
    table = rans.Frequencies.of_counts(np.bincount(ids))
    marks, words = rans.encode_ids(ids, table)
    assert len(marks) > 3
    parts = [
        rans.decode_ids(marks, words, len(ids), table, table.slots(), k, k + 1 if k + 1 < len(marks) else None)
        for k in range(len(marks))
    ]
    assert (np.concatenate(parts) == ids).all()
    assert len(words) * 4 < len(ids) * 2


def test_letters_before_marks():
    """A seam after any letter that has one leaves the ids as the whole text's."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    marks = ",.!|*%$&#?;:"
    texts = [f"{a}{chr(n)}{m}{b} {m}{chr(n)}" for n in range(0xC0, 0x180) for m in marks for a, b in (("", ""), ("a", "b1"))]
    texts += ["Adana, SİVAS. ve İ, AVCI(BÖRKÜVARLIĞİ).", "İ$", "i̇$ i̇.", "ſ. ŉ! Ǆ, ß?"]
    ids, sizes = tokens.WordCoder(tokenizer_path()).encode(pa.array(texts))
    want = [c.ids for c in whole.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_another_tokenizer_encodes_whole_texts(odd):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    coder = tokens.WordCoder(path)
    assert not coder.by_words and tokens.WordCoder(tokenizer_path()).by_words
    texts = [t for _, t in odd]
    want = [c.ids for c in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    ids, sizes = coder.encode(pa.array(texts))
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_any_stretch_of_a_block():
    """Ids are read from the checkpoint before them, wherever they begin."""
    ids = np.random.default_rng(2).zipf(1.4, rans.BLOCK_IDS + 5000) % 40_000
    table = rans.Frequencies.of_counts(np.bincount(ids))
    block = rans.Block(rans.write_block([1], np.array([len(ids)]), ids, table))
    assert len(block.marks) >= 4
    step = rans.EVERY * rans.LANES
    for begin, end in [(0, 5), (step - 1, step + 1), (step, 2 * step), (3 * step + 7, len(ids)), (len(ids) - 1, len(ids)), (9, 9)]:
        assert (block.ids(table, table.slots(), begin, end) == ids[begin:end]).all()


def test_reading_single_documents(llm_spark, tmp_path):
    """Also of blocks with many documents, and of one text longer than a block."""
    from tokenizers import Tokenizer

    long = " ".join(f"word{n % 977} and {n}" for n in range(60_000))
    docs = [(n, f"document {n} " * (n % 90)) for n in range(3000)] + [(5000, long), (None, "no id"), (7, "again")]
    folder = str(tmp_path / "files")
    tokens.write_tokens(documents(llm_spark, docs).coalesce(2), tokenizer_path(), folder)
    coder = Tokenizer.from_file(tokenizer_path())
    asked = [7, 1500, 2999, 5000, 4000]
    got = sorted((r["doc_id"], list(r["ids"])) for r in tokens.read_documents(llm_spark, folder, asked).collect())
    assert got == sorted((d, [*coder.encode(t, add_special_tokens=False).ids, 2]) for d, t in docs if d in asked)
    assert tokens.read_documents(llm_spark, folder, []).count() == 0


def test_damage_is_found():
    ids = np.arange(1000) % 7
    table = rans.Frequencies.of_counts(np.bincount(ids))
    block = bytearray(rans.write_block([1], np.array([1000]), ids, table))
    block[len(block) // 2] ^= 1
    with pytest.raises(ValueError):
        rans.read_block(bytes(block), table, table.slots())


def test_many_rare_ids_keep_a_slot():
    counts = np.ones(50_000, np.int64)
    counts[0] = 10**9
    table = rans.Frequencies.of_counts(counts)
    assert table.scaled.sum() == 1 << rans.SCALE and (table.scaled > 0).all()
