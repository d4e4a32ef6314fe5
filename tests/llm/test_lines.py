import re
from collections import defaultdict

from fairlead.llm import lines
from fairlead.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.llm.helpers import FOLD, documents, sha

LONG = "a line that is long enough to be judged as a copy"


def without_common_lines(docs, shortest=40, holders=5):
    split = [(d, (t or "").split("\n")) for d, t in docs]
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line).translate(FOLD)
    having = defaultdict(set)
    for d, ls in split:
        for line in ls:
            having[key(line)].add(d)
    rank = lambda d: (d is not None, d or 0)
    gone = {k: max(ds, key=rank) for k, ds in having.items() if len(k) >= shortest and len(ds) >= holders}
    out = []
    for d, ls in split:
        kept = [line for line in ls if key(line) not in gone or gone[key(line)] == d]
        out.append((d, len(ls), len(ls) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def found(frame):
    hashed = frame.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256))
    return sorted(map(tuple, hashed.collect()), key=str)


def odd_documents():
    rows = [(n, f"own {n}\n {LONG}\t\r\n{LONG.upper()}\nend") for n in range(4)]
    rows += [(4, f"{LONG}"), (5, None), (6, ""), (7, "\n\n"), (8, f"\x0b{LONG}\x0c\nx"), (8, f"\x0b{LONG}\x0c\nx"), (8, "another text")]
    rows += [(None, LONG), (None, f"{LONG}\nof no id")]
    rows += [(n, "É" + "é" * 39 + "\n" + "é" * 39 + " " + "\n" + "s" * 39 + f"\n{n}") for n in range(10, 16)]
    rows += [(n, "É" + "é" * 39 + " " + "\n" + "É" * 40) for n in range(16, 19)]
    return rows


def test_odd_lines(llm_spark):
    rows = odd_documents()
    docs = documents(llm_spark, rows).withColumns({"line": F.lit("x"), "last": F.lit(1), "places": F.lit(2), "t1": F.lit(3)})
    assert found(lines.drop_lines(docs.repartition(4))) == without_common_lines(rows)
    assert found(lines.drop_lines(docs, 1, 1)) == without_common_lines(rows, 1, 1)
    assert lines.drop_lines(docs.limit(0)).count() == 0


def test_long_texts_and_many_keys(llm_spark, monkeypatch):
    """Keys too many to broadcast: the hot ones apart, the others by a shuffle; a text of 60,000 lines."""
    rows = [(n, "\n".join([LONG] * 50 + [f"{LONG} number {k}" for k in range(n, n + 40)])) for n in range(60)]
    rows.append((1000, "\n".join(f"{LONG} number {k % 300}" if k % 2 else f"single line {k}" for k in range(60_000))))
    rows.append((999, rows[-1][1]))
    docs = documents(llm_spark, rows)
    want = without_common_lines(rows)
    assert found(lines.drop_lines(docs)) == want
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(lines, "HOT", 10)
    assert found(lines.drop_lines(docs)) == want


def test_whole_table_without_python(llm_spark, sf_dir, real):
    frame = QUERIES["op13_drop_lines"](llm_spark, sf_dir)
    assert sorted(map(tuple, frame.collect()), key=str) == without_common_lines(real)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
