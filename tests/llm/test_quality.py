"""Quality: statistics, rules, compiled columns, accuracy on held-out rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.llm import learn, quality, statistics
from larkspur.llm.common import fold_of

MEDIUM = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return quality.learned(spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/labels.parquet"), max_rows=3000)


def test_statistics_by_hand():
    rows = statistics.of_texts(pa.array([None, "", "Ab é1.\nab ab", "x", "same same same same", "l\nl\n\nm"]))
    get = lambda i, n: rows[i, statistics.NAMES.index(n)]
    assert not rows[0].any() and not rows[1].any()
    assert get(2, "log_chars") == pytest.approx(np.log1p(12)) and get(2, "log_words") == pytest.approx(np.log1p(4))
    assert get(2, "upper") == pytest.approx(1 / 12) and get(2, "digit") == pytest.approx(1 / 12) and get(2, "other") == pytest.approx(1 / 12) and get(2, "stop") == pytest.approx(1 / 12)
    assert get(2, "distinct_words") == 0.5 and get(2, "top_word") == 0.75 and get(2, "lines_per_word") == 0.25 and get(2, "word_chars") == pytest.approx(9 / 4)
    assert get(3, "repeated_pairs") == 0 and get(3, "single_letter_words") == 1
    assert get(4, "repeated_pairs") == pytest.approx(2 / 3) and get(5, "repeated_lines") == pytest.approx(1 / 3)


def test_compiled_column_is_the_model(spark, model):
    df = spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(300)
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    rows = df.collect()
    x = statistics.of_texts(pa.array([r.text for r in rows]))
    z = model.bias + quality.matched(x, model.rules) @ np.array(model.weights)
    for r, s in zip(rows, 1 / (1 + np.exp(-z))):
        assert got[r.doc_id] == pytest.approx(s, rel=1e-9)
    assert 0 < len(model.rules) == len(model.described()) and all(len(r) <= 3 for r in model.rules)


def test_lasso_keeps_few_rules():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(statistics.NAMES)))
    y = ((x[:, 3] > 0.5) & (x[:, 7] <= 0.4)).astype(int)
    model = quality.fit(x, y)
    s = model.bias + quality.matched(x, model.rules) @ np.array(model.weights)
    assert ((s > 0) == y).mean() > 0.97 and len(model.rules) < 120
    assert len(quality.fit(x, y, lasso=0.05).rules) < len(model.rules)


def test_logistic_matches_known_weights():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((20_000, 3))
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.0] + 0.5)))).astype(float)
    w, b = learn.logistic(x, y)
    assert np.abs(w - [2, -1, 0]).max() < 0.15 and abs(b - 0.5) < 0.1


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    held = docs.join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").where(fold_of(F.col("doc_id")) == 0)
    rows = quality.score(held, model).join(held.select("doc_id", "quality"), "doc_id").collect()
    y, got = np.array([r.quality for r in rows]), np.array([r.score >= 0.3 for r in rows])
    assert (got == y).mean() > 0.97 and got[y == 1].mean() > 0.99 and got[y == 0].mean() < 0.1


def test_edges(spark, model):
    rows = [(1, None), (None, ""), (2, "a"), (2, "a"), (3, "x" * 300_000), (4, "\n" * 1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"score": F.lit("clash"), "upper": F.lit(1), "id": F.lit(2)})
    got = quality.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(df.limit(0), model).count() == 0
    for labels in ([], [(1, None)], [(1, 1), (2, 1)]):
        constant = quality.learned(df, spark.createDataFrame(labels, "doc_id bigint, quality int"))
        assert constant.rules == [] and len({r.score for r in quality.score(df, constant).collect()}) == 1
