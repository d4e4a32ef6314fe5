import random

import pytest
from fairlead.llm import recompress
from fairlead.llm.common import table
from fairlead.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.llm.helpers import documents, sha, without_repeats


def digest(kept):
    return sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"], sha(r["text"])) for r in kept.collect())


def tangle(draw, n):
    """Texts cut from shared passages at any word, with runs, periods and small vocabularies."""
    pool = [[f"p{k}w{draw.randrange(60)}" for _ in range(draw.choice([34, 35, 36, 60, 200]))] for k in range(12)]
    pool += [["a"] * 80, ["a", "b"] * 50, ["a", "b", "c"] * 40, ["a"] * 20 + ["z"]]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            p = draw.choice(pool)
            a = draw.randrange(len(p))
            parts += p[a : a + draw.choice([10, 34, 35, 36, 70, 300])]
            parts += [f"u{draw.randrange(10**6)}" for _ in range(draw.choice([0, 1, 5]))]
        docs.append((i, draw.choice([" ", "\n", " \t "]).join(parts)))
    return docs


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(llm_spark, sf):
    folder = f"/root/testdata/{sf}"
    real = [tuple(r) for r in table(llm_spark, folder, "documents").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op3_drop_repeats"](llm_spark, folder).collect()))
    assert got == sorted(without_repeats(real))
    assert any(r[2] for r in got)


def test_tangled_texts_over_many_packs(llm_spark, odd, monkeypatch):
    for seed in range(3):
        docs = tangle(random.Random(seed), 120) + odd
        frame = documents(llm_spark, docs).withColumns({"pack": F.lit(1), "part": F.lit(2)}).repartition(7)
        assert digest(recompress.drop_repeats(frame)) == sorted(without_repeats(docs))


def test_texts_longer_than_a_pack(llm_spark, monkeypatch):
    monkeypatch.setattr("fairlead.llm.packs.PACK", 20_000)
    draw = random.Random(5)
    long = [f"w{draw.randrange(9000)}" for _ in range(12_000)]
    docs = [(1, " ".join(long)), (2, " ".join(long[5000:5100])), (3, " ".join(long[7000:7034])), (4, "x " * 9000), (5, " ".join(long[11_000:]))]
    frame = documents(llm_spark, docs).withColumns({"keys": F.lit(1), "bits": F.lit(2), "size": F.lit(3)})
    assert digest(recompress.drop_repeats(frame.repartition(3))) == sorted(without_repeats(docs))


def test_no_rows_and_null_ids(llm_spark):
    docs = documents(llm_spark, [(None, "a " * 40), (None, None)])
    assert digest(recompress.drop_repeats(docs)) == [(0, 0, 0, sha("")), (0, 40, 40, sha(""))]
    assert recompress.drop_repeats(docs.limit(0)).count() == 0
