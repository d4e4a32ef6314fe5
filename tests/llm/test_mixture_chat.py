from collections import Counter

from fairlead.llm import chat, mixture
from fairlead.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.llm.helpers import SPACED, documents


def water(sizes, weights, most=3):
    total, aims, free = sum(sizes), {}, dict(enumerate(sizes))
    while free:
        left = total - sum(aims.values())
        whole = sum(weights[i] for i in free)
        above = [i for i, s in free.items() if left * weights[i] / whole > most * s]
        if not above:
            return [aims.get(i, left * weights[i] / whole if i in free else 0) for i in range(len(sizes))]
        for i in above:
            aims[i] = most * free.pop(i)
    return [aims[i] for i in range(len(sizes))]


def test_targets_and_copies(llm_spark, sf_dir, real):
    rows = QUERIES["op5_mix_sources"](llm_spark, sf_dir).collect()
    sizes = {d: len(SPACED.findall(t or "")) for d, t in real}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes
    assert all(r["taken"] in range(0, 3 * r["size"] + 1, max(1, r["size"])) for r in rows)
    aims = {(r["source_size"], r["target"]) for r in rows}
    assert abs(sum(t for _, t in aims) - sum(s for s, _ in aims)) < 1e-6 * sum(sizes.values())


def test_water_level(llm_spark):
    for sizes in ([100, 1, 1, 5, 0, 7], [3, 3, 3], [1], [0, 0], [10**6, 2, 3, 10**5, 1, 1, 50]):
        weights = [mixture.WEIGHTS[i % 3] for i in range(len(sizes))]
        frame = llm_spark.createDataFrame([(f"s{i}", s, i) for i, s in enumerate(sizes)], "source string, source_size long, rank long")
        got = [r["target"] for r in mixture.targets(frame).orderBy("source").collect()]
        assert all(abs(a - b) < 1e-6 for a, b in zip(got, water(sizes, weights)))


def test_mix_of_odd_rows(llm_spark):
    rows = [(1, "a b", None, "s"), (1, "a b", None, "s"), (2, None, None, None), (None, "x y z", None, "é"), (4, "  ", None, "Z")]
    docs = documents(llm_spark, rows).withColumns({"rate": F.lit(1), "copies": F.lit(2), "taken_copies": F.lit(3)})
    rated = mixture.mix_rates(docs).collect()
    assert sorted(r["size"] for r in rated) == [0, 0, 2, 2, 3]
    mixed = mixture.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixture.mix_rates(docs.limit(0)).count() == 0
    copies = sum(r["copies"] for r in rated)
    assert mixed.count() == copies


def test_an_id_in_two_sources(llm_spark):
    """Each row is taken by the rate of its own source."""
    rows = [(1000, "a b", None, "a"), (1000, "c d", None, "b"), *((n, "x y z", None, "a") for n in range(40))]
    rows += [(50 + n, "x", None, "b") for n in range(3)]
    docs = documents(llm_spark, rows)
    rates = {(r["doc_id"], r["source"]): r["copies"] for r in mixture.mix_rates(docs).collect()}
    assert rates[1000, "a"] != rates[1000, "b"]
    mixed = Counter((r["doc_id"], r["source"]) for r in mixture.mix_documents(docs).collect())
    assert mixed == {k: n for k, n in rates.items() if n}


def test_mean_meets_the_target(llm_spark):
    docs = documents(llm_spark, [(i, "w " * 10, None, f"s{i % 7}") for i in range(7000)])
    rows = mixture.mix_rates(docs).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("t"), F.first("target").alias("aim")).collect()
    assert all(abs(r["t"] - r["aim"]) < 0.1 * r["aim"] for r in rows)


def plain_chats(turns):
    chats = {}
    for conv, turn, role, text in set(turns):
        chats.setdefault(conv, []).append((turn is not None, turn, role, text))
    chats = {c: tuple(x[1:] for x in sorted(t, key=lambda x: (x[0], x[1] or 0))) for c, t in chats.items()}
    plain = {c: tuple(x[1:] for x in t) for c, t in chats.items()}
    groups = Counter(plain.values())
    longer = {t[:k] for t in groups for k in range(1, len(t))}
    out = {}
    for conv in sorted(plain, key=lambda c: (c is not None, c)):
        t = plain[conv]
        if t not in longer and t not in {plain[c] for c in out}:
            out[conv] = (len(t), groups[t], "".join(f"<|{'unknown' if r is None else r}|>\n{x or ''}\n" for r, x in t))
    return out


TURNS = "conv_id long, turn int, role string, text string"


def test_chats(llm_spark, sf_dir):
    turns = llm_spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op8_format_chats"](llm_spark, sf_dir).collect()}
    assert got == plain_chats([tuple(r) for r in turns.collect()])


def test_snapshots_go(llm_spark):
    a = [(0, "user", "hi"), (1, "assistant", None), (2, "user", ""), (5, None, "x")]
    turns = [(1, *t) for t in a[:2]] + [(2, *t) for t in a] + [(3, *t) for t in a] + [(3, *a[0])]
    turns += [(4, 0, "user", "hi"), (5, 0, "user", "hi"), (5, 1, "assistant", ""), (None, 0, "user", "alone"), (7, None, "user", "no turn")]
    turns += [(8, n, "user", f"t{n}") for n in range(9000)] + [(9, n, "user", f"t{n}") for n in range(8999)]
    frame = llm_spark.createDataFrame(turns, TURNS)
    got = {r[0]: tuple(r)[1:] for r in chat.format_chats(frame.withColumns({"place": F.lit(1), "h1": F.lit(2)})).collect()}
    assert got == plain_chats(turns)
    assert set(got) == {2, 5, None, 7, 8}
    assert chat.format_chats(frame.limit(0)).count() == 0
