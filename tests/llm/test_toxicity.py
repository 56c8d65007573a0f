"""Toxicity: restoring disguised words, and accuracy on held-out rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.llm import toxicity
from larkspur.llm.common import fold_of

MEDIUM = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.learned(docs, labels.withColumn("text", F.lit("clash")), max_rows=3000)


@pytest.mark.parametrize(("word", "core"), [("Idiot!!", "idiot"), ("(loser)", "loser"), ("the&&&", "the"), ("of%%%", "of"), ("a$$$", "a"), ("1diot", "1diot"), ("tra$h", "tra$h"), ("...", ""), ("$", ""), ("$cum", "$cum"), ("ÉTÉ,", "été")])
def test_core(word, core):
    assert toxicity.core(word) == core


@pytest.mark.parametrize(("word", "disguised"), [("idiot", False), ("1d10t", True), ("i.d.i.o.t", True), ("idiiiot", True), ("1234", False), ("ab", False), ("x" * 100, False)])
def test_disguised(word, disguised):
    assert toxicity.disguised(word) == disguised


@pytest.mark.parametrize("raw", ["1d10t", "IDIOT", "idi0t", "i.d.i.o.t", "idiiiiot", "i-d-1-0-t", "!diot", "id¡ot".replace("¡", "1")])
def test_restored(model, raw):
    assert toxicity.Restorer(model.letters).word(raw) == "idiot"


def test_disguises_score_like_the_words(model):
    plain = "the of thering and idiot ened the ation of anre"
    texts = [plain, plain.replace("idiot", "1d10t"), plain.replace("idiot", "i d i o t"), plain.replace("idiot", "IDIIIIOT!!!"), plain.replace("idiot", "onan")]
    s = model.score(pa.array(texts))
    assert (s[:4] > 0.5).all() and s[4] < 0.2


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    held = docs.join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").where(fold_of(F.col("doc_id")) == 0)
    rows = toxicity.score(held, model).join(held.select("doc_id", "toxic"), "doc_id").collect()
    y, got = np.array([r.toxic for r in rows]), np.array([r.score >= 0.5 for r in rows])
    assert (got == y).mean() > 0.97 and got[y == 1].mean() > 0.8 and got[y == 0].mean() < 0.01


def test_edges(spark, model):
    rows = [(1, None), (None, ""), (2, "idiot " * 9), (2, "idiot " * 9), (3, "x" * 200_000), (4, "a " * 50_000), (5, "$ % & 1 2 3")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"score": F.lit("clash"), "made": F.lit(1), "id": F.lit(2)})
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and sum(r.score > 0.5 for r in got) == 2
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == len(rows) - 2
    assert toxicity.score(df.limit(0), model).count() == 0


def test_letters_do_not_depend_on_layout(spark, documents):
    one, many = (toxicity.letters_of(documents.repartition(n)) for n in (1, 24))
    assert one.tri == many.tri and one.lexicon == many.lexicon and len(one.lexicon) > 100
    assert toxicity.letters_of(documents.limit(0)).lexicon == {}


def test_repeated_ids_are_sampled_once(spark):
    docs = spark.createDataFrame([(k % 10, f"text {k}") for k in range(200)] + [(None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 10)], "doc_id bigint, toxic int")
    from larkspur.llm import learn

    sample = learn.labelled_sample(docs, labels, "toxic", "doc_id", "text", "doc_id", 5)
    assert 0 < sample.count() <= 5


def test_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    for labels in ([], [(1, None)], [(None, 1)], [(1, 0), (2, 0)], [(1, 7)]):
        model = toxicity.learned(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())


def test_fold_zero_is_not_learned_from(spark):
    ids = spark.range(400).where(fold_of(F.col("id")) == 0)
    docs = ids.selectExpr("id AS doc_id", "concat('word', id % 2, ' filler') AS text")
    model = toxicity.learned(docs, ids.selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic"))
    assert model.features == []


def test_copies_of_one_text_do_not_fill_the_features(spark):
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnoprstu"))
    word = lambda: "".join(rng.choice(letters, 9, replace=False))
    say = lambda n: [word() for _ in range(n)]
    one = say(301)
    copies = [" ".join([*one[:k], word(), *one[k + 1 :]]) for k in range(300)]
    other = [" ".join([*say(30), "stupid" if k % 2 else "moron"]) for k in range(60)]
    many = say(150)
    wide = [" ".join([*say(10), *many]) if k % 4 else " ".join(many[::-1]) for k in range(80)]
    wide = [" ".join(rng.permutation(t.split())) for t in wide]  # no copies: other shingles
    clean = [" ".join(say(30)) for _ in range(700)]
    texts = [(t, 1) for t in copies + other + wide] + [(t, 0) for t in clean]
    docs = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "doc_id bigint, text string, toxic int")
    features = toxicity.learned(docs.drop("toxic"), docs.drop("text")).features
    assert {"=stupid", "=moron"} <= set(features) and len(features) > 600
    assert not {f"={w}" for w in one} & set(features) and {f"={w}" for w in many} <= set(features)


@pytest.fixture(scope="module")
def small():
    """A model of few words, and one that knows no words of its features."""
    often = {"you": 400, "are": 400, "an": 300, "a": 900, "hello": 60, "well": 90, "the": 900, "is": 500, "idiot": 20, "stupid": 20, "ass": 15}
    grams = {}
    for w, n in often.items():
        for t in toxicity.trigrams(w):
            grams[t] = grams.get(t, 0) + n
    return toxicity.ToxicModel(toxicity.Letters(grams, often), ["=idiot", "=stupid", "=ass"], np.full(3, 5.0), -4.0)


@pytest.mark.parametrize(
    "text",
    ["a s t u p i d", "y o u a r e a n i d i o t", "a s s", "you.are.an.idiot", "well...idiot", "hello,idiot", "hello,1d10t", "hello!idiot", "well?idiot", "y 0 u a r e s t u u u p 1 d", "s t u p i d " + "y o u a r e a n " * 9 + "i d i o t", "i.d.i.o.t", "qzzrv,idiot"],
)
def test_word_boundaries_in_runs(small, text):
    assert small.score(pa.array([text]))[0] > 0.5


def test_boundaries_make_no_toxic_words(small):
    texts = ["the a.s the s", "hello.you,are", "t h e a n s w e r", "idio.you", "a a a a", "is a - b - c", "", None]
    assert (small.score(pa.array(texts)) < 0.5).all()
    assert small.restorer.parts("you.are.an.idiot")[0] == ["you", "are", "an", "idiot"]


@pytest.mark.parametrize("text", ["id" + "i" * 70 + "ot", "i" * 5000 + "diot", "hello.you-are." * 9 + "1d10t", "1d10t" + ".the" * 40, "i.d.i.o.t" + "..." * 40 + "you", "hello," * 5000 + "idiot"])
def test_long_words_are_decoded(small, text):
    counted = small.counts(pa.array([text]))
    assert counted[1].tolist() == [0] and counted[2].tolist() == [1]


def test_shortened_runs_restore_the_same(small):
    for word in ("idiiiiiiiot", "sssstupid", "hellllllo.yoooou", "aaaaaaaan"):
        assert toxicity.decode(word, small.letters) == toxicity.decode(toxicity.shortened(word), small.letters)


def test_words_are_cut_from_few_texts_at_a_time(monkeypatch):
    texts = [f"w{i % 700} the x y z {'long ' * 300}" for i in range(3000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 1000])], ["text"]) for k in range(0, 3000, 1000)]
    sizes, cut = [], toxicity.coded_words
    monkeypatch.setattr(toxicity, "coded_words", lambda some, table: sizes.append(sum(map(len, some.to_pylist()))) or cut(some, table))
    found = list(toxicity._word_batches(batches))
    assert max(sizes) <= 1_100_000 and sum(sizes) == sum(map(len, texts))
    assert len(found) == 1  # counted together: each word once
    counts = dict(zip(found[0].column("raw").to_pylist(), found[0].column("n").to_pylist()))
    assert len(counts) == found[0].num_rows == 705
    assert counts[b"the"] == 3000 and counts[b"long"] == 900_000 and counts[b"w5"] == 5 and counts[b"x"] == 0


def test_features_are_counted_once_a_text(monkeypatch):
    class Held:
        def __init__(self, value):
            self.value = value

    texts = ["bright bright house", "house", "idiot house"] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([0, 1, 1] * 2)], ["text", "y"])
    keys = toxicity._keys(pa.array(texts))
    shared, shares = Held(toxicity.Letters({})), Held({k: dict.fromkeys(keys, 0.5) for k in (0, 1)})
    whole = pa.Table.from_batches(toxicity._feature_batches(shared, shares)([batch])).to_pylist()
    monkeypatch.setattr(toxicity, "CUT_BYTES", 20)  # each text by itself
    parts = pa.Table.from_batches(toxicity._feature_batches(shared, shares)([batch])).to_pylist()
    assert parts == whole
    told = {r["feature"]: (r["bad"], r["good"]) for r in whole}
    assert told["=house"] == (2.0, 1.0) and told["=bright"] == (0.0, 1.0) and told["=idiot"] == (1.0, 0.0)
