import random

from fairlead.llm import neardup, weighted
from fairlead.llm.components import components
from fairlead.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.llm.helpers import SPACED, documents, edits, near_groups


def test_whole_table(llm_spark, sf_dir, real):
    rows = QUERIES["op7_near_duplicates"](llm_spark, sf_dir).collect()
    assert sorted((r[0], r[1], r[2]) for r in rows) == sorted(near_groups(real))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_families(llm_spark, odd):
    """Copies of copies, each a few words off, so that many links pass by other members."""
    draw = random.Random(3)
    docs, at = list(odd), 1000
    for family in range(12):
        base = [f"f{family}w{draw.randrange(400)}" for _ in range(draw.choice([6, 30, 120]))]
        made = [base]
        for _ in range(25):
            copy = list(draw.choice(made))
            for _ in range(draw.choice([0, 1, 1, 2])):
                copy[draw.randrange(len(copy))] = f"n{draw.randrange(10**6)}"
            made.append(copy)
        for copy in made:
            docs.append((at, " ".join(copy)))
            at += 1
    draw.shuffle(docs)
    got = neardup.near_duplicates(documents(llm_spark, docs).withColumn("n", F.lit(1)), size=4).collect()
    assert sorted(map(tuple, got)) == sorted(near_groups(docs))


def test_long_texts_and_clashing_columns(llm_spark):
    draw = random.Random(12)
    words = [f"w{draw.randrange(10**6)}" for _ in range(40_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:38_000])), (3, " ".join(words[:20_000])), (4, " ".join(reversed(words))), (5, "a b")]
    wide = documents(llm_spark, docs).withColumns({c: F.lit(1) for c in ("bucket", "component", "n", "hashes", "given_id", "text_hash", "bands")})
    assert sorted(map(tuple, neardup.near_duplicates(wide, size=4).collect())) == sorted(near_groups(docs))


def test_members_that_no_center_is_close_to(llm_spark):
    """Copies that are near each other by shared edits, but to no common center, and many that are near none."""
    draw = random.Random(13)
    base = [f"b{n}" for n in range(120)]
    docs, at = [], 0
    for kind in range(6):
        edits = draw.sample(range(2, 118), 6)
        for _ in range(12):
            copy = list(base)
            for e in edits[: draw.choice([4, 5, 6])]:
                copy[e] = f"k{kind}e{e}"
            copy[draw.randrange(120)] = f"own{at}"
            docs.append((at, " ".join(copy)))
            at += 1
    for _ in range(40):
        copy = list(base)
        for e in draw.sample(range(120), draw.choice([3, 5, 7])):
            copy[e] = f"u{draw.randrange(10**9)}"
        docs.append((at, " ".join(copy)))
        at += 1
    want = sorted(near_groups(docs))
    assert 5 < len({r[2] for r in want}) < 110
    assert sorted(map(tuple, neardup.near_duplicates(documents(llm_spark, docs), size=4).collect())) == want


def test_no_rows_and_null_ids(llm_spark):
    docs = documents(llm_spark, [(None, "a b c d e"), (None, "a b c d e"), (3, "a b c d e"), (4, None)])
    got = neardup.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (0, 0), (3, 3), (4, 4)]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_texts_that_share_an_id(llm_spark):
    """Each text of an id is linked by its own words, and one row of each group is kept."""
    base = " ".join(f"b{n}" for n in range(60))
    other = " ".join(f"o{n}" for n in range(60))
    rows = [(1, base), (5, base + " more"), (5, other), (5, other), (6, other + " more"), (8, "alone in the world now"), (8, None)]
    rows += [(9, "two texts " + base[::-1]), (9, "two texts " + base[::-1] + " x"), (None, other), (3, base)]
    docs = documents(llm_spark, rows)
    for _ in range(2):
        got = neardup.judged_duplicates(docs.repartition(5), size=4).collect()
        assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [
            (0, 0), (1, 1), (3, 1), (5, 1), (5, 5), (5, 5), (6, 5), (8, 8), (8, 8), (9, 9), (9, 9),
        ]
    kept = [(r["doc_id"], r["text"]) for r in neardup.keep_one(docs, neardup.judged_duplicates(docs, size=4)).collect()]
    nine = [k for k in kept if k[0] == 9]
    assert len(nine) == 1
    assert sorted(set(kept) - set(nine), key=str) == sorted(
        [(1, base), (5, other), (8, "alone in the world now"), (8, None), (None, other)], key=str
    )
    assert len(kept) == 6


def test_components(llm_spark):
    draw = random.Random(4)
    links = [(i, i + 1) for i in range(300) if i % 50] + [(1000, 1000 + i) for i in range(1, 400)]
    links += [(draw.randrange(2000, 2100), draw.randrange(2000, 2100)) for _ in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    frame = llm_spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, components(frame).collect()))
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}


def jaccard(a, b):
    pieces = lambda t: [w[i : i + 16] for w in (x.encode() for x in SPACED.findall(t)) for i in range(0, len(w), 16)]
    x, y = pieces(a), pieces(b)
    terms = set(x) | set(y)
    top = sum(max(x.count(t), y.count(t)) for t in terms)
    return sum(min(x.count(t), y.count(t)) for t in terms) / top if top else 1.0


def test_fingerprints(llm_spark, sf_dir, real):
    rows = QUERIES["op10_weighted_fingerprints"](llm_spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == sorted(edits(real))
    order = sorted(real, key=lambda d: -d[0])
    by_id = {r["doc_id"]: r for r in rows}
    errors = []
    for n, (d, t) in enumerate(order):
        after = order[(n + 1) % len(order)][1] or ""
        r = by_id[d]
        errors.append(abs(r["near_next"] - jaccard(t or "", after)))
        errors.append(abs(r["near_edited"] - jaccard(t or "", weighted.edited_text(t or "", after))))
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.04
    prints = {}
    assert all(prints.setdefault(t, by_id[d]["fingerprint"]) == by_id[d]["fingerprint"] for d, t in real)


def test_fingerprints_of_very_long_texts(llm_spark):
    """Unrelated texts of 100,000 distinct words have nothing in common, whatever their number."""
    a, b = (" ".join(f"{x}{n}" for n in range(100_000)) for x in "ab")
    half = a[: len(a) // 2] + b[len(b) // 2 :]
    docs = documents(llm_spark, [(3, a), (2, b), (1, half)])
    rows = {r["doc_id"]: r for r in weighted.compare_with_edits(docs).collect()}
    assert rows[3]["near_next"] < 0.03
    assert abs(rows[2]["near_next"] - 1 / 3) < 0.15 and abs(rows[1]["near_next"] - 1 / 3) < 0.15


def test_fingerprints_agree_as_the_weighted_jaccard():
    draw = random.Random(6)
    errors = []
    for _ in range(40):
        a, b = ([f"w{int(draw.paretovariate(0.7)) % 60}" for _ in range(draw.choice([20, 200, 900]))] for _ in "ab")
        b += draw.sample(a, len(a) // 2)
        codes, has = weighted.fingerprints(weighted.pa.array([" ".join(a), " ".join(b)]))
        assert has.all()
        errors.append((codes[0] == codes[1]).mean() - jaccard(" ".join(a), " ".join(b)))
    assert abs(sum(errors)) / len(errors) < 0.02 and max(map(abs, errors)) < 0.2


def test_fingerprints_of_edited_texts_without_spaces():
    """A character more or less changes the terms around it alone; all terms are whole characters."""
    draw = random.Random(7)
    for letters in ("abcdefghijklmnopqrstuvwxyz0123456789", [chr(0x4E00 + i) for i in range(900)], "añ日😀b"):
        text = "".join(draw.choice(letters) for _ in range(4000))
        other = "".join(draw.choice(letters) for _ in range(4000))
        made = weighted.pa.array([text, letters[0] + text, text[:9] + text[10:], text[:2000] + "x" + text[2000:], other, "see " + text])
        codes, _ = weighted.fingerprints(made)
        shares = (codes[0] == codes).mean(axis=1)
        assert min(shares[1], shares[2], shares[3], shares[5]) > 0.9 and shares[4] < 0.1
        data, at = weighted.text_bytes(made)
        begins, ends, row = weighted.cut_words(data, *weighted.words(data, at))
        pieces = [bytes(data[a:b]) for a, b in zip(begins, ends)]
        assert b"".join(pieces).decode() == "".join(made.to_pylist()).replace(" ", "")
        assert all(p.decode() and len(p) <= weighted.LONGEST + 3 for p in pieces)


def test_fingerprints_of_odd_texts(llm_spark):
    docs = documents(llm_spark, [(1, ""), (2, None), (3, "x"), (4, "日本" * 900), (None, "no id")]).withColumn("part", F.lit(1))
    rows = {r["doc_id"]: r for r in weighted.compare_with_edits(docs).collect()}
    assert len(rows) == 5 and rows[2]["near_next"] == 1 and rows[3]["near_next"] == 0
    assert rows[2]["fingerprint"] == "" and rows[4]["near_edited"] > 0
    alone = weighted.compare_with_edits(documents(llm_spark, [(1, "a b c d")])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1
    assert weighted.compare_with_edits(docs.limit(0)).count() == 0
