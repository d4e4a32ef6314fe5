import zlib

import numpy as np
import pyarrow as pa
from fairlead.llm import features, language, quality
from fairlead.llm.common import table
from fairlead.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.llm.helpers import documents

SF = "/root/testdata/sf0.01"


def held(doc, folds, at):
    return zlib.crc32(str(doc).encode()) % folds == at


def test_quality_on_held_out_rows(llm_spark):
    rows = QUERIES["op4_quality"](llm_spark, SF).collect()
    labels = dict(table(llm_spark, SF, "labels").select("doc_id", "quality").collect())
    assert len(rows) == 1000 and all(r["held_out"] == held(r["doc_id"], 5, 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    tested = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == q for p, q in tested]) >= 0.95
    again = QUERIES["op4_quality"](llm_spark, SF).collect()
    assert sorted(again) == sorted(rows)


def test_quality_of_odd_texts(llm_spark, odd):
    docs = documents(llm_spark, [*odd, (None, "no id")])
    labels = llm_spark.createDataFrame([(4, 1), (7, 0), (None, 1), (5, None), (5, 1), (9, 0)], "doc_id long, quality int")
    scored = quality.score_quality(docs.withColumn("quality", F.lit(3)), labels)
    assert scored.count() == len(odd) + 1
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    assert quality.score_quality(docs, labels.limit(0)).filter("predicted = 1").count() == len(odd) + 1
    assert quality.keep_good(docs, scored).columns == docs.columns


def test_quality_of_long_texts_and_clashing_columns(llm_spark):
    """A text of 300,000 words is scored whole: what its end says counts."""
    good, bad = "fine prose here ", "$$$ !!! buy 999 "
    docs = [(n, (good if n % 2 else bad) + f"w{n}") for n in range(400)]
    docs += [(1000, good * 100_000), (1001, bad * 75_000), (1002, "x " * 200_000 + bad * 20_000)]
    labels = llm_spark.createDataFrame([(n, n % 2) for n in range(400)], "doc_id long, quality long")
    wide = documents(llm_spark, docs).withColumns({c: F.lit("x") for c in ("score", "held_out", "features", "quality", "predicted")})
    scored = {r["doc_id"]: r["predicted"] for r in quality.score_quality(wide, labels).collect()}
    assert (scored[1000], scored[1001], scored[1002]) == (1, 0, 0)


def test_quality_has_the_shares_of_all_labels(llm_spark):
    """One word tells nothing, so the score is the share of label 1: 0.9, also of a small sample."""
    draw = np.random.default_rng(5)
    docs = documents(llm_spark, [(i, " ".join(f"w{x}" for x in draw.integers(0, 50, 12))) for i in range(6000)])
    labels = llm_spark.createDataFrame([(i, int(draw.random() < 0.9)) for i in range(6000)], "doc_id long, quality int")
    for sample in (600, 6_000, 60_000):
        rows = quality.score_quality(docs, labels, sample=sample).select("score").collect()
        assert abs(np.mean([r["score"] for r in rows]) - 0.9) < 0.03, sample
    rows, good, count = quality.training_rows(docs, labels, 600)
    usable = labels.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0").groupBy("quality").count().collect()
    assert 450 < len(rows) < 750 and {r["quality"]: r["count"] for r in usable} == {
        1: round(count[good].sum()),
        0: round(count[~good].sum()),
    }


def test_descent_separates():
    order = np.random.default_rng(2)
    good = np.arange(400) % 5 > 0
    rows = [np.unique(np.r_[order.integers(10, 900, 30), 3 if g else 5]).astype(np.int32) for g in good]
    model = quality.fit(rows, good, bits=10)
    margins = quality._margins(rows, model.weight, model.square, model.bias)
    assert ((model.slope * margins + model.offset > 0) == good).mean() > 0.97


def test_features_are_those_of_each_text():
    texts = ["a b a", None, "", "A!! b", "x " * 3000]
    row, feature = features.ngram_features(pa.array(texts))
    for i, text in enumerate(texts):
        alone = features.ngram_features(pa.array([text], pa.string()))[1]
        assert (feature[row == i] == alone).all()


def test_language_on_held_out_rows(llm_spark):
    rows = QUERIES["op6_language"](llm_spark, SF).collect()
    langs = dict(table(llm_spark, SF, "documents").select("doc_id", "lang").collect())
    tested = [r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"] and langs[r["doc_id"]]]
    assert np.mean(tested) >= 0.97
    assert all(r["held_out"] == held(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 for r in rows)


def test_language_is_learnt_from_whole_texts(llm_spark):
    """A shared foreign head of 1,500 characters, and thousands of copies of one text, hide nothing."""
    draw = np.random.default_rng(8)
    head = " ".join(f"licence{n}" for n in range(150))
    vocabulary = {"aa": [f"ka{x}o" for x in "bcdfghjklmnp"], "bb": [f"ш{x}ы" for x in "бвгджзклмнпр"]}
    body = lambda lang, n: " ".join(draw.choice(vocabulary[lang], n))
    rows = [(i, f"{head} {body(lang, 900)}", lang, "s") for i, lang in enumerate(["aa", "bb"] * 100)]
    rows += [(1000 + i, head, "aa", "s") for i in range(3000)]
    docs = documents(llm_spark, rows)
    contents = language.learn_dictionaries(docs)
    assert list(contents) == ["aa", "bb"]
    for lang, held in contents.items():
        assert 50_000 < len(held) <= language.DICTIONARY
        found = held.decode().split()
        assert np.mean([w in vocabulary[lang] for w in found]) > 0.6
    odd = documents(llm_spark, [(i, body(lang, 40), lang, "s") for i, lang in enumerate(["aa", "bb"] * 20)])
    got = language.identify(odd, contents).collect()
    assert all(r["lang_pred"] == ["aa", "bb"][r["doc_id"] % 2] for r in got)


def test_language_of_odd_texts(llm_spark, odd):
    docs = documents(llm_spark, [*[(d, t, "en" if d % 2 else "de", "s") for d, t in odd], (None, "no id", None, None)])
    rows = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()}
    assert [rows[i] for i in (1, 2, 3)] == ["und"] * 3 and rows[4] in ("en", "de")
    assert language.identify(docs.limit(0)).count() == 0
    nothing = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
