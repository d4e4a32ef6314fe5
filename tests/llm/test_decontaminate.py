from fairlead.llm.decontaminate import decontaminate, keep_clean
from fairlead.llm.common import table
from fairlead.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.llm.helpers import decontaminated, documents, sha


def test_whole_table(llm_spark, sf_dir, real):
    items = [tuple(r) for r in table(llm_spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op2_decontaminate"](llm_spark, sf_dir).collect()))
    assert got == sorted(decontaminated(real, items))
    assert any(r[-1] for r in got)


def digest(judged):
    rows = judged.select("doc_id", "n_words", "n_hit", "items").collect()
    return sorted((d, n, h, len(i), sha(",".join(i)), h > 0) for d, n, h, i in rows)


def test_short_items_ties_and_repeats(llm_spark, odd):
    letters = " ".join(f"w{i}" for i in range(40))
    docs = [
        *odd,
        (20, f"start {letters} end"),
        (21, letters),
        (22, "W3 w4, W5; w6 then w9 w10 w11"),
        (23, "that that that"),
        (24, " ".join(f"w{i}" for i in range(5, 15))),
        (25, " ".join(f"w{i}" for i in range(5, 14))),
    ]
    items = [(0, letters), (1, "w4 w5 w6"), (2, "That"), (3, None), (4, "--"), (5, letters), (10, "that " * 30), (11, "one TWO three")]
    bench = llm_spark.createDataFrame(items, "item_id long, text string")
    assert digest(decontaminate(documents(llm_spark, docs), bench)) == sorted(decontaminated(docs, items))


def test_items_without_id_and_long_texts(llm_spark):
    """An item without an id hits words and is in no list; a text of 200,000 words is judged whole."""
    many = " ".join(f"x{i}" for i in range(200_000))
    passage = " ".join(f"x{i}" for i in range(199_000, 199_030))
    docs = [(1, many), (2, "start " + passage), (3, "q r s t u v w")]
    items = [(None, "q r s"), (7, passage), (8, many)]
    bench = llm_spark.createDataFrame(items, "item_id long, text string")
    want = decontaminated(docs, items[1:])
    want[2] = (3, 7, 3, 0, sha(""), True)
    assert digest(decontaminate(documents(llm_spark, docs), bench)) == want


def test_empty_tables_and_clashing_columns(llm_spark):
    docs = documents(llm_spark, [(1, "a b c"), (None, "a b c"), (3, None)])
    bench = llm_spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    wide = docs.withColumns({c: F.lit(1) for c in ("words", "length", "hash", "prints", "_id", "start")})
    judged = decontaminate(wide, bench.withColumn("doc_id", F.lit(9)))
    assert judged.filter("n_hit = 1").count() == 2
    kept = keep_clean(wide, judged)
    assert kept.columns == wide.columns and [r["doc_id"] for r in kept.collect()] == [3]
