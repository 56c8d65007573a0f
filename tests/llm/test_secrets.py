"""Secret scans against a plain version with Python's regular expressions."""

import hashlib
import random
import re
import time
from collections import defaultdict

from pyspark.sql import functions as F

from larkspur.llm import secrets

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
HEX40 = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def random_looking(value):
    mixed = re.search("[0-9]", value) and re.search("[A-Za-z]", value)
    return bool(mixed) and len(set(value)) >= min(-(-len(value) // 2), 8)


def plain(rows, repo=2):
    """Each row's spans, and whether each value is live; ``repo`` is the place of the repository in a row."""
    every = {}
    for i, (_, t, _) in enumerate(rows):
        blobs = [(m.start(), 3, m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_]{32,}", t or "") if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
        every[i] = sorted(base(t) + blobs)
    owners, repos = defaultdict(set), defaultdict(set)
    for i, spans in every.items():
        for s in spans:
            owners[s[3]].add(rows[i][2] or "")
            repos[s[3]].add("" if rows[i][repo] is None else str(rows[i][repo]))
    live = {v: random_looking(v) and len(owners[v]) <= 2 and len(repos[v]) <= 20 for v in owners}
    out = []
    for i, spans in every.items():
        fixed = [s for s in spans if s[1] < 3]
        out.append((rows[i][0], [s for s in spans if s[1] < 3 or (live[s[3]] and not any(b[0] == s[0] or b[2] == s[2] for b in fixed))], live))
    return out


def digest(rows):
    shown = lambda xs: ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b, _ in xs)
    out = []
    for i, spans, known in plain(rows):
        n = [sum(s[1] == k for s in spans) for k in range(3)]
        live = sum(known[s[3]] for s in spans)
        out.append((i, *n, live, len(spans) - live, hashlib.sha256(shown([s for s in spans if s[1] < 3]).encode()).hexdigest(), shown(spans)))
    return sorted(out, key=str)


def texts():
    rng = random.Random(8)
    parts = ["token = ", "Secret:", 'api_key="', "APIKEY='", "password: token: abcdefgh ", "passwd=abc", HEX40, HEX40.upper(), "AKIA" + "Q" * 16, "AKIA" + "Q" * 15, "abc", " ", "\n", "é日\U0001f600", "ſecret=abcdefgh", "a" * 40 + "1", "=", "a1b2" * 12, "a1b2c3d4e5" * 4, "zzz9"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12))), rng.choice(["s1", "s2", "s3", "s4", None])) for k in range(300)]
    return rows + [(1, None, "s1"), (None, "token=abcdef", None), (7, "", "s1"), (7, "", "s1"), (9, ("x" * 50 + f" token={HEX40} ") * 400, "s2")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns({"spans": F.lit("clash"), "uid": F.lit(1), "digest": F.lit(0)})


def test_matches_plain_version(spark):
    rows = texts()
    found = secrets.scan(frame(spark, rows))
    got = found.select("doc_id", *[c.alias(n) for n, c in secrets.digest_columns(F.col("spans")).items()]).collect()
    assert sorted((tuple(r) for r in got), key=str) == digest(rows)


def test_owners_separate_examples_from_live_values(spark):
    rows = [(k, f"token={HEX40}", f"s{k}") for k in range(5)] + [(9, "token=onlyhere1234", "s1")]
    got = {r.doc_id: r.spans for r in secrets.scan(frame(spark, rows)).collect()}
    assert not any(s.live for s in got[0]) and got[0][0].owners == 5 and all(s.live for s in got[9])


def test_redaction(spark):
    rows = texts()
    got = secrets.redacted(frame(spark, rows).withColumn("n_chars", F.length("text").cast("bigint")))
    assert got.columns == ["doc_id", "text", "source", "spans", "uid", "digest", "n_chars"]
    want = []
    for (i, t, s), (_, spans, _) in zip(rows, plain(rows)):
        out, at = "", 0
        for a, _, b, _ in spans:
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        want.append((i, out + t[at:] if t is not None else None, s))
    assert sorted(((r.doc_id, r.text, r.source) for r in got.collect()), key=str) == sorted(want, key=str)
    assert got.where("n_chars <> length(text)").count() == 0


def test_repositories_of_one_owner(spark):
    rows = [(k, f"token={HEX40}" if k < 21 else "token=k3y-of-20-repositories", "s1") for k in range(41)]
    got = {r.doc_id: r.spans for r in secrets.scan(frame(spark, rows), repo_col="doc_id").collect()}
    assert (got[0][0].repos, got[0][0].owners, got[0][0].live) == (21, 1, False) and got[40][0].live
    few = secrets.scan(frame(spark, [(1, "token=aaaa1111aaaa password=changeme", "s1")])).collect()[0].spans
    assert [s.live for s in few] == [False, False]


def test_tens_of_thousands_of_secrets_in_one_text(spark):
    rng = random.Random(2)
    text = "".join(f"é token={rng.getrandbits(40):010x} x" for _ in range(32_000))
    df = frame(spark, [(1, text, "s")]).withColumn("n_chars", F.lit(1))
    began = time.perf_counter()
    spans = secrets.scan(df).collect()[0].spans
    assert len(spans) == 32_000 and all(text[s.start : s.end].startswith("token=") and s.end - s.start == 16 for s in spans)
    assert secrets.redacted(df).collect()[0].text == "é [SECRET] x" * 32_000
    assert time.perf_counter() - began < 60


def test_empty_table_and_no_python(spark):
    assert secrets.scan(frame(spark, [])).count() == 0 and secrets.redacted(frame(spark, [])).count() == 0
    p = secrets.scan(frame(spark, texts()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in p and "MapIn" not in p
