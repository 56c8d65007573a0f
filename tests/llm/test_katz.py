"""Katz scoring against a plain version that counts with dictionaries."""

import math
import re
import string
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from larkspur.llm import katz

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w] + [None]


def plain(rows, order=katz.ORDER):
    """{id: (n_tokens, n_known, N, base, score)} for unique ids."""
    train = [tokens(t) for _, t, held in rows if not held]
    uni = Counter(w for ws in train for w in ws)
    n, v = sum(uni.values()), len(uni)
    hist = lambda c: [sum(x == r for x in c.values()) for r in range(katz.CUTOFF + 2)]
    cut = lambda c, d: c * (d[c] if c <= katz.CUTOFF else 1.0)
    d1 = katz.discounts(hist(uni))
    kept = sum(cut(c, d1) for c in uni.values())
    total = n if n - kept > 0.25 else kept + 0.5
    p1 = lambda w: cut(uni[w], d1) / total if uni[w] else (total - kept) / total if total else 1.0
    after, ds = {}, {}
    for k in range(2, order + 1):
        every = Counter()
        for ws in train:
            padded = ["<s>", *ws]
            every.update(tuple(padded[i : i + k]) for i in range(len(padded) - k + 1))
        of_history = defaultdict(dict)
        for g, c in every.items():
            of_history[g[:-1]][g[-1]] = c
        after[k] = {h: c for h, c in of_history.items() if k == 2 or sum(c.values()) >= katz.LEAST}
        ds[k] = katz.discounts(hist({(h, w): c for h, ws in after[k].items() for w, c in ws.items()}))
    memo = {}

    def state(h):
        """(denominator, weight) of a history that is modelled."""
        if h not in memo:
            seen, d = after[len(h) + 1][h], ds[len(h) + 1]
            count = sum(seen.values())
            freed = count - sum(cut(c, d) for c in seen.values())
            below = count if freed > 1e-9 else count + 1
            freed = freed if freed > 1e-9 else 1.0
            memo[h] = below, freed / below / (1 - sum(p(h[1:], x) for x in seen))
        return memo[h]

    def p(h, w):
        if not h:
            return p1(w)
        seen = after[len(h) + 1].get(h)
        if not seen:
            return p(h[1:], w)
        below, weight = state(h)
        return cut(seen[w], ds[len(h) + 1]) / below if w in seen else weight * p(h[1:], w)

    out = {}
    for i, t, _ in rows:
        ws = tokens(t)
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        padded = ["<s>", *ws]
        logs = [math.log10(p(tuple(padded[max(0, j - order + 1) : j]), padded[j])) for j in range(1, len(padded))]
        out[i] = (len(ws), sum(uni[w] > 0 for w in ws), n, base, sum(logs))
    some = [*list(after[2])[:15], *list(after[order])[:15], ("never seen",) * (order - 1)]
    for h in some:  # exactly normalised over all words and the unseen class
        assert sum(p(h, w) for w in uni) + p(h, "\0 no such word") == pytest.approx(1, abs=1e-9)
    return out


def scored(spark, rows, id_type="bigint", **more):
    df = spark.createDataFrame(rows, f"doc_id {id_type}, text string, held boolean").withColumn("score", F.lit("clash"))
    return katz.score(df, held_out=F.col("held"), **more).collect()


@pytest.mark.parametrize("order", [2, 3, 4])
def test_matches_plain_version(spark, documents, order):
    rows = [(r.doc_id, r.text, r.doc_id % 5 == 1) for r in documents.orderBy("doc_id").limit(150).collect()]
    rows += [(10_000 + i, "the the of the " * 40, False) for i in range(30)] + [(20_000, None, False), (20_001, "", True), (20_002, " \t\n", True), (20_003, "zzz Éa unheard-of words", True)]
    want = plain(rows, order)
    got = scored(spark, rows, order=order)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)
        assert r.score == pytest.approx(want[r.doc_id][4], rel=1e-9)


def test_hot_history_is_spread(spark):
    rows = [(i, " ".join(f"the w{(i * 7 + k) % 50}" for k in range(60)), i % 4 == 0) for i in range(40)]
    want = plain(rows)
    for r in scored(spark, rows):
        assert r.score == pytest.approx(want[r.doc_id][4], rel=1e-9)


def test_histories_that_occur_once_are_modelled(spark):
    """By hand: counts of one are halved here (none is two), those of seven stay whole."""
    rows = [(1, "a b c", False), *[(10 + i, "x b d", False) for i in range(7)], (2, "a b c", True), (3, "a b d", True)]
    got = {r.doc_id: r.score for r in scored(spark, rows)}
    first_two = 0.5 / 8 * 0.5  # P(a|<s>) P(b|<s> a)
    assert got[1] == got[2] == pytest.approx(math.log10(first_two * 0.5 * 0.5))  # P(c|a b) P(end|b c)
    backed_off = 0.5 / (1 - 0.5 / 8) * 7 / 8  # the weight of "a b", P(d|b)
    assert got[3] == pytest.approx(math.log10(first_two * backed_off * 7 / 8))  # P(end|b d)


@pytest.mark.parametrize("rows", [[], [(1, "a b", True)], [(None, "a a", False), (1, "a", None), (1, "a", None)]])
def test_edges(spark, rows):
    got = scored(spark, rows)
    assert len(got) == len(rows)
    assert all(r.score <= 0 and r.base_score <= 0 and r.n_tokens >= 1 for r in got)


def test_longer_histories_predict_better(spark, documents):
    rows = [(r.doc_id, r.text, r.doc_id % 5 == 1) for r in documents.collect()]
    rows += [(10_000 + i, f"the {'quick' if i % 2 else 'lazy'} brown {'fox' if i % 2 else 'dog'} runs", i % 7 == 0) for i in range(60)]
    got = {k: {r.doc_id: (r.base_score, r.score) for r in scored(spark, rows, order=k)} for k in (2, 3)}
    held = [i for i, _, h in rows if h]
    base, two, three = sum(got[2][i][0] for i in held), sum(got[2][i][1] for i in held), sum(got[3][i][1] for i in held)
    assert base < two < three


def test_many_partitions_and_blocks(spark, documents, monkeypatch):
    rows = [(r.doc_id, r.text, r.doc_id % 5 == 1) for r in documents.orderBy("doc_id").limit(120).collect()] + [(99_999, "long " * 100_000 + "end", False)]
    want = {r.doc_id: r.score for r in scored(spark, rows)}
    monkeypatch.setattr(katz, "PART_BYTES", (20_000, 20_000))
    got = scored(spark, rows)
    assert len(got) == len(rows) and all(r.score == pytest.approx(want[r.doc_id], rel=1e-9) for r in got)


def test_histories_of_one_block_are_counted_there(spark, documents):
    """Less is sent, and the model is the same as when blocks ask for all."""
    df = documents.select("doc_id", "text", (F.col("doc_id") % 5 == 1).alias("held")).repartition(6, "doc_id")
    ds, scores, sent = {}, {}, {}
    for keep in (False, True):
        f = katz._Fit(df, "doc_id", "text", F.col("held"), 4, keep)
        ds[keep] = [list(d) for d in f.ds]
        scores[keep] = {r[0]: r[6] for r in f.whole().mapPartitions(katz._scores(f.model, f.buckets, f.ds)).collect()}
        sent[keep] = f.tables[-1].map(lambda r: len(r[1][1])).sum()
        f.close()
    assert ds[False] == ds[True] and len(scores[False]) == documents.count()
    assert scores[False] == pytest.approx(scores[True], rel=1e-9)
    assert sent[False] < sent[True]


def test_order_is_checked(spark, documents):
    with pytest.raises(ValueError, match="order"):
        katz.score(documents, order=1)


def test_stored_tables_are_normalised(spark, documents, tmp_path):
    uni, bi, tri = katz.fit(documents, str(tmp_path / "model"))
    words = {r.id: 10**r.log_prob for r in uni.collect()}
    unseen = 1 - sum(words.values())
    assert 0 < unseen < 1 and len(words) == uni.count()
    held = {k: defaultdict(list) for k in (2, 3)}
    for k, table in ((2, bi), (3, tri)):
        for r in table.collect():
            held[k][tuple(r.history)].append(r)
    two = {h: {r.id: 10**r.log_prob for r in rows} for h, rows in held[2].items()}

    def p2(h, w):
        return two[h][w] if w in two[h] else 10 ** held[2][h][0].log_backoff * words[w]

    for k in (2, 3):
        for h, rows in sorted(held[k].items(), key=lambda x: len(x[1]))[-30:] + list(held[k].items())[:200]:
            assert len({r.id for r in rows}) == len(rows)
            rest = 1 - sum(words[r.id] if k == 2 else p2(h[1:], r.id) for r in rows)
            assert sum(10**r.log_prob for r in rows) + 10 ** rows[0].log_backoff * rest == pytest.approx(1, abs=1e-9)
