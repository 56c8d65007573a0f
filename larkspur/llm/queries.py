"""The queries ``opN_<name>`` over the synthetic tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import caps, decontaminate, html_main, katz, minhash, pieces, quality, secrets, toxicity, url_filters
from .common import fold_of, small_batches

#: Rules of the URL query: host, path, action.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; the session is set for whole texts."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, action)")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), rules)


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


#: The public tokenizer the query encodes with; any SentencePiece model file will do.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode its ids, and hold the result against it."""
    both = pieces.round_trip(table(spark, sf_dir, "documents"), PIECE_MODEL)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.col("same").alias("round_trip"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spans=False)
    items = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _predictions(scored: DataFrame, least: float) -> DataFrame:
    held = fold_of(F.col("doc_id")) == 0
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _predictions(toxicity.score(docs, toxicity.learned(docs, table(spark, sf_dir, "labels"))), 0.5)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _predictions(quality.score(docs, quality.learned(docs, table(spark, sf_dir, "labels"))), 0.3)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the documents tell their sources, as owners; each document is a repository of its own
    found = secrets.scan(table(spark, sf_dir, "documents"), repo_col="doc_id")
    return found.select("doc_id", *[c.alias(n) for n, c in secrets.digest_columns(F.col("spans")).items()])


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), held_out=fold_of(F.col("doc_id")) == 1)


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_secret_scans": op9_secret_scans,
    "op10_lm_scoring": op10_lm_scoring,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op1_url_filters": f"""
WITH rules(rhost, rpath, action) AS (VALUES {", ".join(map(str, URL_RULES))}),
parts AS (
  SELECT page_id, row_number() OVER () AS row_id,
         {_LOWER.format(r"regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)\\A.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
ranked AS (
  SELECT p.*, r.rhost || r.rpath AS rule, r.action,
         row_number() OVER (PARTITION BY row_id ORDER BY length(r.rhost || r.rpath) DESC, length(r.rhost) DESC) AS k
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM ranked WHERE k = 1
""",
}


def _secret_sql() -> str:
    def spans(kind: int, pattern: str, group: int, keep: str) -> str:
        p = pattern.replace("'", "''")
        return f"""
  SELECT rid, doc_id, source, {kind} AS kind, k,
         list_sum(list_transform(gaps[1:k], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:k-1], lambda g: length(g))), 0) AS s,
         length(found[k]) AS n, vals[k] AS val
  FROM (SELECT rid, doc_id, source, gaps, found, vals, unnest(range(1, len(found) + 1)) AS k
        FROM (SELECT rid, doc_id, source, regexp_split_to_array(txt, '{p}') AS gaps,
                     regexp_extract_all(txt, '{p}', 0) AS found, regexp_extract_all(txt, '{p}', {group}) AS vals FROM d))
  WHERE {keep}"""

    either = lambda w: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w)
    assign = "(" + "|".join(map(either, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    every = " UNION ALL ".join([
        spans(0, assign, 2, "length(vals[k]) >= 6"),
        spans(1, "AKIA[A-Z0-9]+", 0, "length(found[k]) >= 20"),
        spans(2, "[0-9a-f]+", 0, "length(found[k]) >= 24"),
        spans(3, "[A-Za-z0-9+/_]{32,}", 0, "regexp_matches(vals[k], '[0-9]') AND regexp_matches(vals[k], '[A-Za-z]')"),
    ])
    joined = "coalesce(string_agg(['assign','access','hex','blob'][kind + 1] || ':' || s || ':' || (s + n), ',' ORDER BY s, kind{}), '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS txt FROM documents),
every AS ({every}),
held AS (SELECT val, count(DISTINCT coalesce(source, '')) <= 2 AND count(DISTINCT coalesce(doc_id::VARCHAR, '')) <= 20
                 AND regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]')
                 AND len(list_distinct(string_split(val, ''))) >= least(ceil(length(val) / 2.0), 8) AS live FROM every GROUP BY val),
judged AS (SELECT e.*, h.live FROM every e JOIN held h USING (val)),
kept AS (SELECT * FROM judged j WHERE kind < 3 OR (live AND NOT EXISTS (
  SELECT 1 FROM judged b WHERE b.rid = j.rid AND b.kind < 3 AND (b.s = j.s OR b.s + b.n = j.s + j.n)))),
summed AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
         {joined.format("").replace("ORDER BY s, kind)", "ORDER BY s, kind) FILTER (kind < 3)")} AS base, {joined.format("")} AS spans
  FROM kept GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN summed USING (rid)
"""




def near_duplicate_sql(shingle: int, percent: int) -> str:
    """All pairs by brute force, then components by recursion."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + {shingle - 1}) AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {shingle - 1}, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * common >= {percent} * (x.n + y.n - common)),
r(u, v) AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
m AS (SELECT u, least(u, min(v)) AS component_id FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.u = d.doc_id
"""


ORACLES["op2_minhash_near_dedup"] = near_duplicate_sql(3, 85)
ORACLES["op9_secret_scans"] = _secret_sql()


ORACLES["op4_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(ws, i, i + least(len(ws), 10) - 1) AS win, least(len(ws), 10) AS n
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
spot AS (SELECT rid, n, i, list_slice(ws, i, i + n - 1) AS win
       FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)),
hits AS (SELECT rid, i, spot.n, item_id FROM spot JOIN win ON spot.win = win.win AND spot.n = win.n),
spots AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (rid) LEFT JOIN found USING (rid)
"""

ORACLES["op7_embedding_near_dedup"] = """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.vec_id <> b.vec_id AND a.n > 0 AND b.n > 0
      WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.9),
r(u, v) AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
m AS (SELECT u, least(u, min(v)) AS component_id FROM r GROUP BY u),
c AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM e LEFT JOIN m ON m.u = vec_id LEFT JOIN c ON c.u = vec_id
"""
