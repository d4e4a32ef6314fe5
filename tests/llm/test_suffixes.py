import random

import numpy as np
import pyarrow as pa
from fairlead.llm import byterepeats
from fairlead.llm.queries import QUERIES
from fairlead.llm.suffixes import longest_shared, suffix_array
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.helpers import documents, sha, without_byte_repeats
from tests.llm.test_repeats import tangle


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.integers(1, 6))
def test_suffix_array(text, times):
    text = [*(text * times), 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=200, deadline=None)
@given(st.sets(st.lists(st.integers(0, 2), min_size=1, max_size=7).map(tuple), max_size=25))
def test_longest_shared(strings):
    strings = list(strings)

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    most, lesser = longest_shared([np.array(s) for s in strings])
    assert list(most) == [max((common(a, b) for b in strings if b != a), default=0) for a in strings]
    assert (np.array(lesser) <= np.array(most)).all()


def digest(kept):
    rows = kept.collect()
    return sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in rows)


def test_whole_table(llm_spark, sf_dir, real):
    got = sorted(map(tuple, QUERIES["op9_suffix_repeats"](llm_spark, sf_dir).collect()))
    assert got == sorted(without_byte_repeats(real))
    assert any(r[2] for r in got)


def test_tangled_texts_over_many_packs(llm_spark, odd):
    for seed in range(3):
        draw = random.Random(seed)
        docs = tangle(draw, 120) + odd
        blob = "".join(draw.choice("αβγabc ") for _ in range(900))
        for i in range(30):
            a = draw.randrange(700)
            docs.append((1000 + i, draw.choice(["", "é", "zz "]) + blob[a : a + draw.choice([150, 199, 200, 201, 500])]))
        frame = documents(llm_spark, docs).withColumns({"pack": F.lit(1), "part": F.lit(2)}).repartition(7)
        assert digest(byterepeats.drop_byte_repeats(frame)) == sorted(without_byte_repeats(docs))


def test_one_passage_in_a_third_of_many_documents(llm_spark, monkeypatch):
    """Strings that go on differently after a crowded passage are no one bucket; the rows are the same."""
    draw = random.Random(9)
    passage = "".join(draw.choice("abcdefghij ") for _ in range(1500))
    tails = ["".join(draw.choice("klmnopqrst ") for _ in range(700)) for _ in range(60)]
    docs = [(n, f"{n} {passage}{tails[n % 60]} {n}" if n % 3 else f"{tails[n % 60]}{n * 7919}") for n in range(240)]
    long = "".join(draw.choice("uvwxyz ") for _ in range(90_000))
    docs += [(1000, long), (1001, long[30_000:])]
    monkeypatch.setattr("fairlead.llm.packs.PACK", 20_000)
    monkeypatch.setattr(byterepeats, "MOST_SYMBOLS", 4)
    frame = documents(llm_spark, docs).repartition(4)
    want = sorted(without_byte_repeats(docs))
    for crowd in (10**6, 4):
        monkeypatch.setattr(byterepeats, "CROWD", crowd)
        assert digest(byterepeats.drop_byte_repeats(frame)) == want
    cuts = byterepeats.Cuts(pa.array([t for _, t in docs]), byterepeats.WINDOW)
    names = cuts.names(1)
    often = names.count[names.item] >= 30
    none = np.zeros(len(often), bool)
    largest = [
        max(b - a for a, b in byterepeats.Suffixes(cuts, none, 10**6, crowded).ends.values()) for crowded in (none, often)
    ]
    assert largest[1] < 0.2 * largest[0]


def test_no_rows_and_null_ids(llm_spark):
    docs = documents(llm_spark, [(None, "a" * 240), (None, None)])
    assert digest(byterepeats.drop_byte_repeats(docs)) == [(0, 0, 0, 0, sha("")), (0, 240, 240, 1, sha(""))]
    assert byterepeats.drop_byte_repeats(docs.limit(0)).count() == 0
