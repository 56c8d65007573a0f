"""Decontamination against a search window by window."""

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from larkspur.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain(docs, items, size=10):
    windows = {}
    for i, t in items:
        ws = WORD.findall((t or "").translate(LOWER))
        for k in range(max(len(ws) - size, 0) + 1 if ws else 0):
            windows.setdefault(tuple(ws[k : k + size]), set()).add(i)
    out = []
    for i, t in docs:
        found = list(WORD.finditer((t or "").translate(LOWER)))
        ws, hit, names = [m[0] for m in found], set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(ws) - n + 1):
                if (w := tuple(ws[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    names.update(str(x) for x in windows[w] if x is not None)
        spans = []
        for k in sorted(hit):
            if k - 1 in hit:
                spans[-1] = (spans[-1][0], found[k].end())
            else:
                spans.append((found[k].start(), found[k].end()))
        out.append((i, len(ws), len(hit), sorted(names), spans))
    return sorted(out, key=str)


def data():
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice(["the", "of", "Ünder", "日本", "a1", "z"]) for _ in range(n))
    items = [(k, say(rng.randint(8, 25))) for k in range(12)] + [(50, "Just four words, HERE!"), (51, None), (52, " .. "), (53, "x"), (None, "nameless item of four")]
    docs = []
    for k in range(120):
        parts = [say(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            ws = rng.choice(items)[1] or ""
            parts += [ws.upper().replace(" ", rng.choice([" ", "-- ", "\n"])) if rng.random() < 0.5 else " ".join(ws.split()[: rng.randint(1, 30)]), say(3)]
        docs.append((k, ", ".join(parts)))
    return docs + [(1, None), (1, ""), (None, "just four words here, just four words here"), (7, "é" * 5000 + " x " + items[0][1])], items


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"items": F.lit(1), "id": F.lit("x")})
    return d, spark.createDataFrame(items, "item_id bigint, text string").withColumn("t0", F.lit(None))


def test_matches_plain_search(spark):
    docs, items = data()
    got = decontaminate.scan(*frames(spark, docs, items)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in got), key=str) == plain(docs, items)


def test_filter_keeps_clean_rows_whole(spark):
    docs, items = data()
    d, b = frames(spark, docs, items)
    kept = decontaminate.without_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r[0]) for r in plain(docs, items) if not r[2])


@pytest.mark.parametrize("items", [[], [(1, None)], [(1, "...")]])
def test_empty_benchmark_and_documents(spark, items):
    docs, _ = data()
    d, b = frames(spark, docs, items)
    assert decontaminate.scan(d, b).where("n_hit > 0").count() == 0 and decontaminate.without_contaminated(d, b).count() == len(docs)
    assert decontaminate.scan(*frames(spark, [], [(1, "a")])).count() == 0


def test_benchmark_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BENCHMARK_BYTES", 10)
    with pytest.raises(ValueError, match="parts"):
        decontaminate.scan(*frames(spark, [(1, "a")], [(1, "more than ten bytes")]))


def test_parts_unite(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BENCHMARK_BYTES", 150)
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 2_000)
    docs, items = data()
    d, b = frames(spark, docs, items)
    assert len(list(decontaminate._benchmark_parts(b, "item_id", ["text"], 10))) > 2
    got = decontaminate.scan(d, b).collect()
    want = plain(docs, items)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in got), key=str) == want
    kept = decontaminate.without_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r[0]) for r in want if not r[2])
