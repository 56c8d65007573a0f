"""Near duplicates against all pairs."""

import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from larkspur.llm import common, minhash
from larkspur.llm.text import shingle_sets

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, n):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    return {tuple(ws[i : i + n]) for i in range(max(len(ws) - n, 0) + 1)} if ws else set()


def plain(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    out = []
    for k, (i, _) in enumerate(rows):
        c = i if not sets[k] else least.get(root(k))
        out.append((i, len(sets[k]), c, None if i is None or c is None else i == c))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    rows, key = [], 100
    for size in (4, 9, 40, 120):
        for _ in range(4):
            text = [word() for _ in range(size)]
            for _ in range(6):
                copy = list(text)
                for _ in range(rng.randint(0, max(size // 25, 1))):
                    copy[rng.randrange(size)] = word()
                rows.append((key, " ".join(copy)))
                key += 1
    original = [word() for _ in range(60)]
    for _ in range(80):  # one large group, most of whose members are linked through the original alone
        copy = list(original)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(60)] = word()
        rows.append((key, " ".join(copy)))
        key += 1
    rows += [(k, "exact copy of one text here") for k in range(20)]
    return rows + [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "ONE"), (5, "ONE"), (None, "one"), (None, "no name at all"), (None, None), (6, "É x y"), (7, "é x y")]


def judged(spark, rows, n, percent):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"node": F.lit("clash"), "id": F.lit(0), "kept": F.lit("x")})
    return sorted((tuple(r) for r in minhash.near_duplicates(df, shingle=n, percent=percent).collect()), key=str)


def test_matches_all_pairs(spark):
    rows = corpus()
    for n, percent in ((3, 85), (5, 80)):
        assert judged(spark, rows, n, percent) == plain(rows, n, percent)


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert judged(spark, rows, 3, 85) == plain(rows, 3, 85)


def test_hot_buckets_and_hubs_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(common, "HOT_SHARE", 10**9)
    rows = corpus()[90:]
    assert judged(spark, rows, 3, 85) == plain(rows, 3, 85)


def test_a_very_long_text(spark):
    rng = random.Random(6)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(300_000))
    rows = [(1, long), (2, long + " one more"), (3, "short text of words"), (4, long)]
    assert judged(spark, rows, 3, 85) == plain(rows, 3, 85)


def test_intermediate_tables_are_dropped(spark, documents):
    before = len(common._left)
    minhash.near_duplicates(documents).count()
    assert len(common._left) == before + 1  # the result


def test_empty_table(spark):
    assert judged(spark, [], 3, 85) == []
    assert judged(spark, [(1, None), (None, "")], 3, 85) == plain([(1, None), (None, "")], 3, 85)


def test_without_copies(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept", F.lit(True))
    got = minhash.without_copies(df)
    assert got.columns == ["doc_id", "text", "kept"]
    ids = [r.doc_id for r in got.collect()]
    want = {r[0] for r in plain(rows, 5, 80) if r[3]}
    assert {i for i in ids if i is not None} == want
    assert sum(i is None for i in ids) == sum(i is None for i, _ in rows) and ids.count(5) <= 1


def test_sketch_agreement_estimates_similarity():
    rng = random.Random(1)
    a = [f"w{rng.random()}" for _ in range(400)]
    b = a[:300] + [f"v{k}" for k in range(40)]
    hashes, offsets = shingle_sets(pa.array([" ".join(a), " ".join(b)]), 1)
    s = minhash.sketch(hashes, offsets)
    assert abs((s[0] == s[1]).mean() - 300 / 440) < 0.1
    tiny = minhash.sketch(*shingle_sets(pa.array(["one word", "one word"]), 5))
    assert (tiny[0] == tiny[1]).all() and np.unique(tiny[0]).size == 1
