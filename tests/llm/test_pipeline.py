import random
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from fairlead.llm import mixture
from fairlead.llm.quality import score_quality
from fairlead.llm.common import table
from pyspark.sql import functions as F
from tests.llm.helpers import SPACED, decontaminated, documents, near_groups
from tests.llm.test_mixture_chat import water
from tests.llm.test_tokens import expected

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(frame):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in frame.collect()]


def alike(got, wanted):
    return Counter(got) == Counter(wanted)


def plain_near(docs):
    """One row of each group: of the smallest id; rows that repeat id and text count once."""
    once = list({(r[0], r[1]): r for r in reversed(docs)}.values())
    groups = near_groups([r[:2] for r in once], size=5)
    return [r for r, (d, _, component) in zip(once, groups) if d == component]


def plain_clean(docs, items):
    return [r for r, (*_, hit) in zip(docs, decontaminated([r[:2] for r in docs], items)) if not hit]


def plain_mix(spark, docs):
    sizes = defaultdict(int)
    for _, text, _, source in docs:
        sizes[source] += len(SPACED.findall(text or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = [mixture.WEIGHTS[i % len(mixture.WEIGHTS)] for i in range(len(names))]
    aims = dict(zip(names, water([sizes[n] for n in names], weights)))
    draws = spark.createDataFrame([(r[0],) for r in docs] or [(0,)], "doc_id long").distinct()
    draws = {r[0]: r[1] for r in draws.select("doc_id", mixture.hash_draw(F.col("doc_id"))).collect()}
    rates = {name: aims[name] / sizes[name] if sizes[name] else 0 for name in names}
    times = lambda doc, source: int(rates[source]) + (draws[doc] < rates[source] - int(rates[source]))
    return [r for r in docs for _ in range(times(r[0], r[3]))]


@pytest.fixture(scope="module")
def sf(llm_spark, tmp_path_factory):
    """A fixture of documents with near copies, passages of a benchmark, nulls and repeated rows."""
    draw = random.Random(11)
    words = [f"w{n}" for n in range(3000)]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [(i, text(30)) for i in range(5)]
    rows = []
    for i in range(120):
        good = i % 3 > 0
        made = text(draw.choice([8, 40, 90])) + (" fine prose here" if good else " $$$ !!! buy 999")
        if i % 15 == 4:
            made += " " + items[i % 5][1]
        rows.append((i, made, "en", draw.choice(["a", "b", "c", None])))
    rows += [(200 + i, rows[3 * i + 1][1] + " tail", "en", "b") for i in range(10)]
    rows += [rows[7], rows[7], rows[8], (300, None, None, None), (301, "", None, "a"), (301, "", None, "a")]
    rows += [(None, "no id at all but fine prose here", "en", "c")]
    rows += [(400 + i % 3, text(30) + " fine prose here", "en", "abc"[i // 3]) for i in range(9)]
    folder = str(tmp_path_factory.mktemp("sf"))
    documents(llm_spark, rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 3 > 0)) for i in range(100)] + [(7, 1), (None, 0), (40, None), (999, 0)]
    llm_spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    schema = table(llm_spark, "/root/testdata/sf0.001", "benchmark").schema
    made = llm_spark.createDataFrame(items, "item long, text string")
    fill = [F.col("text") if f.name == "text" else F.col("item").cast(f.dataType) if "id" in f.name else F.lit(None).cast(f.dataType) for f in schema]
    made.select(*[c.alias(f.name) for c, f in zip(fill, schema)]).write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_stages_and_run(llm_spark, sf):
    folder, rows, items = sf
    scored = score_quality(table(llm_spark, folder, "documents"), table(llm_spark, folder, "labels")).collect()
    assert len(scored) == len(rows)
    hashes = table(llm_spark, folder, "documents").select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    verdict = {(r["doc_id"], r["text_hash"]): r["predicted"] for r in scored}
    good = {(r["doc_id"], r["text"]) for r in hashes if verdict[r["doc_id"], r["h"]]}
    wanted = [r for r in rows if r[:2] in good]
    assert 60 < len(wanted) < len(rows)
    docs = table(llm_spark, folder, "documents")
    steps = [
        ("quality", lambda _: wanted),
        ("near_duplicate", plain_near),
        ("decontamination", lambda d: plain_clean(d, items)),
        ("mixture", lambda d: plain_mix(llm_spark, d)),
    ]
    before = rows
    for name, plain in steps:
        docs = docs.withColumns({"kept": F.lit(1), "id": F.lit(2), "judged_id": F.lit(3), "n": F.lit(4)})
        made = STAGES[name](llm_spark, docs, folder)
        assert made.columns == docs.columns, name
        after = plain(before)
        assert alike(rows_of(made), after) and (name in ("quality", "mixture") or len(after) < len(before)), name
        before, docs = after, documents(llm_spark, after)
    tokens = STAGES["token_output"](llm_spark, docs, folder).collect()
    # Copies of one id may stand in any order, so starts are left to the test of token files.
    by_id = lambda r: (r[0], r[2], r[3])
    assert alike(map(by_id, map(tuple, tokens)), map(by_id, expected([r[:2] for r in before])))
    whole = corpus_pipeline.run(llm_spark, folder).collect()
    assert alike(map(by_id, map(tuple, whole)), map(by_id, map(tuple, tokens)))


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_of_an_empty_table(llm_spark, sf, name):
    assert STAGES[name](llm_spark, documents(llm_spark, []), sf[0]).count() == 0
