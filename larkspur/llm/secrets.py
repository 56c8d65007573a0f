"""Secret scans with corpus-wide ownership frequency, in DataFrame operations
only.

Patterns give candidate spans; the candidates' hashes are aggregated over the
whole corpus by distinct repositories and owners.  A value that many owners or
repositories hold is a copied example; one that few hold and that looks random
is taken for live.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread_join, written

#: Fixed patterns, as the contract states them; the assignment's letters match in either case.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Candidates that only the corpus-wide count can confirm: long runs with digits and letters mixed.
BLOB = r"[A-Za-z0-9+/_]{32,}"
KINDS = ("assign", "access", "hex", "blob")
#: A value looks random if its distinct characters are half of its length at least, or so many.
DISTINCT = 8
#: Code points of a text's pieces, while spans are cut out of it.
PIECE = 4096

JUDGED = "array<struct<start:bigint,kind:int,end:bigint,digest:string,owners:bigint,repos:bigint,live:boolean>>"
SPAN = "array<struct<start:bigint,kind:int,end:bigint,digest:string,random:boolean>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each place of an array ``step`` folded over the values before it,
    and last over all.  Blocks of about the root of its length are folded
    first, so n values take n * sqrt(n) steps and no list is copied."""

    def blocks(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))

        def of_width(w: Column) -> Column:
            folded = F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / w).cast("int")), lambda b: F.aggregate(F.slice(v, b * w + 1, w), start, step))

            def of_folded(f: Column) -> Column:
                heads = F.transform(F.sequence(F.lit(0), F.size(f) - 1), lambda b: F.aggregate(F.slice(f, F.lit(1), b), start, step))
                at = F.sequence(F.lit(0), F.size(v))
                return _let(heads, lambda h: F.transform(at, lambda i: F.aggregate(F.slice(v, (F.floor(i / w) * w).cast("int") + 1, (i % w).cast("int")), h[F.floor(i / w).cast("int")], step)))

            return _let(folded, of_folded)

        return _let(width, of_width)

    return _let(values, blocks)


def _sums(values: Column) -> Column:
    return _running(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _random(value: Column) -> Column:
    """Looks random: digits beside letters, and no few characters repeated."""
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (distinct >= F.least(F.ceil(F.length(value) / 2), F.lit(DISTINCT)))


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 1, keep=None) -> Column:
    """Spans of all matches, in code points.  Between the matches lie the
    pieces of a split by the same pattern, so running lengths give offsets."""
    found, secret = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("bigint"))
    none = F.array().cast(SPAN)

    def of_parts(parts: Column) -> Column:
        before = _sums(F.transform(parts, lambda x: x["gap"] + F.coalesce(F.length(x["found"]), F.lit(0))))

        def span(x: Column, i: Column) -> Column:
            at = x["before"] + x["gap"]
            return F.struct(at.alias("start"), F.lit(kind).alias("kind"), (at + F.length(x["found"])).cast("bigint").alias("end"), F.sha2(x["secret"].cast("binary"), 256).alias("digest"), _random(x["secret"]).alias("random"))

        def good(x: Column) -> Column:
            own = x["found"].isNotNull() & (F.length(x["secret"]) >= least)
            return own if keep is None else own & keep(x["secret"])

        whole = F.zip_with(parts, before, lambda x, b: F.struct(x["gap"].alias("gap"), x["found"].alias("found"), x["secret"].alias("secret"), b.alias("before")))
        return F.transform(F.filter(whole, good), span).cast(SPAN)

    spans = _let(F.arrays_zip(gaps.alias("gap"), found.alias("found"), secret.alias("secret")), of_parts)
    return F.when(text.rlike(pattern), spans).otherwise(none)


def candidates(text: Column) -> Column:
    """All candidate spans of a text by start, then kind as listed."""
    every = [
        _spans(text, ASSIGN, 0, group=2, least=6),
        _spans(text, ACCESS, 1),
        _spans(text, HEX, 2),
        _spans(text, BLOB, 3, keep=lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")),
    ]
    return F.array_sort(F.concat(*every))


def _found(docs: DataFrame, text_col: str, repo_col: str, owner_col: str, carried: dict[str, Column]) -> DataFrame:
    """Each document's candidates, in the shared folder."""
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            *[c.alias(n) for n, c in carried.items()],
            F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
            F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
            candidates(F.coalesce(F.col(text_col), F.lit(""))).alias("spans"),
        ),
        "secrets",
    )


def _judged(found: DataFrame, max_owners: int, max_repos: int) -> DataFrame:
    """(uid, judged) of the documents that have candidates: how many owners and
    repositories hold each value anywhere in the corpus, and the verdict.  A
    value that very many documents hold is dealt out over several tasks."""
    each = found.where(F.size("spans") > 0).select("uid", "repo", "owner", F.explode("spans").alias("s")).select("uid", "repo", "owner", "s.*")
    times = each.groupBy("digest").agg(F.count("*").alias("held"))
    pairs = each.select("digest", "owner", "repo").distinct()
    owners = pairs.select("digest", "owner").distinct().groupBy("digest").agg(F.count("*").alias("owners"))
    repos = pairs.select("digest", "repo").distinct().groupBy("digest").agg(F.count("*").alias("repos"))
    held = owners.join(repos, "digest")
    rows = found.select(F.sum(F.size("spans"))).first()[0] or 0
    live = F.col("random") & (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    told = spread_join(each.drop("repo", "owner"), held, ["digest"], "uid", rows, times)
    return told.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "digest", "owners", "repos", live.alias("live")))).alias("judged"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner_col: str = "source", max_owners: int = 2, max_repos: int = 20) -> DataFrame:
    """One row for each document: id, spans (start, end in code points, kind,
    digest of the value, owners, repos, live).

    ``live`` says that a value looks random and is owner-specific: at most
    ``max_owners`` owners and ``max_repos`` repositories hold it anywhere in
    the corpus.  Base kinds (assign, access, hex) always stay.  A blob is a
    span only when it is live and no base span begins or ends where it does.

    Null and empty texts have no spans.  Null owners or repositories count as
    one unknown owner or repository.  Repeated ids and rows stay apart.  Other
    columns are not read.  The values themselves never leave the scan, only
    their digests.
    """
    found = _found(docs, text_col, repo_col, owner_col, {"id": F.col(id_col)})
    both = found.select("uid", "id").join(_judged(found, max_owners, max_repos), "uid", "left")
    return both.select(F.col("id").alias(id_col), _settled(F.coalesce("judged", F.array().cast(JUDGED))).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text", repo_col: str = "source", owner_col: str = "source", length_col: str | None = "n_chars", mark: str = "[SECRET]", max_owners: int = 2, max_repos: int = 20) -> DataFrame:
    """``docs`` with every span of ``scan`` replaced by ``mark``; overlapping
    spans are replaced together.  ``length_col``, where there is one, becomes
    the new length in code points.  Rows without a candidate stay as they are
    and are not shuffled; so do the texts of rows without a span (null and
    empty ones have none).  Repeated rows stay; columns may have any names."""
    names = {f"c{i}": c for i, c in enumerate(docs.columns)}
    found = _found(docs, text_col, repo_col, owner_col, {n: F.col(f"`{c}`") for n, c in names.items()})
    back = [F.col(n).alias(c) for n, c in names.items()]
    text = F.col(next(n for n, c in names.items() if c == text_col))
    changed = found.where(F.size("spans") > 0).join(_judged(found, max_owners, max_repos), "uid").withColumn("new", _without(text, _settled(F.col("judged")), mark))
    renewed = []
    for n, c in names.items():
        new = F.col("new") if c == text_col else F.length("new").cast(docs.schema[c].dataType) if c == length_col else F.col(n)
        renewed.append(F.when(F.size(_settled(F.col("judged"))) > 0, new).otherwise(F.col(n)).alias(c))
    return found.where(F.size("spans") == 0).select(*back).union(changed.select(*renewed))


def _without(text: Column, spans: Column, mark: str) -> Column:
    """The text with a mark for each run of overlapping spans.  The text is cut
    into pieces once, so that a place far behind its start is found at once."""

    def cut(pieces: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / PIECE).cast("int")
        some = F.slice(pieces, first + 1, F.floor(b / PIECE).cast("int") - first + 1)
        return F.substring(F.array_join(some, ""), (a - first * PIECE + 1).cast("int"), (b - a).cast("int"))

    def of_spans(xs: Column) -> Column:
        reach = _running(F.transform(xs, lambda s: s["end"]), F.lit(0).cast("bigint"), lambda a, x: F.greatest(a, x))

        def of_reach(r: Column) -> Column:
            # a span that begins within an earlier one's reach is replaced with it
            gaps = F.filter(F.transform(xs, lambda s, i: F.struct(r[i].alias("a"), s["start"].alias("b"))), lambda g: g["b"] >= g["a"])
            length = F.length(text).cast("bigint")
            ends = F.concat(gaps, F.array(F.struct(F.element_at(r, -1).alias("a"), length.alias("b"))))
            pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
            return _let(pieces, lambda p: F.array_join(F.transform(ends, lambda g: cut(p, g["a"], g["b"])), mark))

        return _let(reach, of_reach)

    return _let(spans, of_spans)


def _settled(judged: Column) -> Column:
    """The spans that stay.  Of a blob and base spans that begin (or end)
    together the blob comes last by start (or end) and kind, so it is enough to
    look at the span before."""

    def own(spans: Column, place: str) -> Column:
        together = lambda s, i: (s["kind"] == 3) & (i > 0) & (F.get(spans, i - 1)[place] == s[place])
        return F.filter(spans, lambda s, i: ~F.coalesce(together(s, i), F.lit(False)))

    def ordered(spans: Column, first: str, second: str) -> Column:
        rest = ("digest", "owners", "repos", "live")
        return F.array_sort(F.transform(spans, lambda s: F.struct(s[first].alias(first), s["kind"].alias("kind"), s[second].alias(second), *[s[c].alias(c) for c in rest])))

    live = F.filter(judged, lambda s: (s["kind"] < 3) | s["live"])
    begun = _let(live, lambda xs: own(xs, "start"))
    ended = _let(ordered(begun, "end", "start"), lambda xs: own(xs, "end"))
    return ordered(ended, "start", "end").cast(JUDGED)


def digest_columns(spans: Column) -> dict[str, Column]:
    """Counts, the digest of the base spans, and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda keep: F.size(F.filter(spans, keep)).cast("bigint")
    return {
        "n_assign": count(lambda s: s["kind"] == 0),
        "n_access": count(lambda s: s["kind"] == 1),
        "n_hex": count(lambda s: s["kind"] == 2),
        "n_live": count(lambda s: s["live"]),
        "n_example": count(lambda s: ~s["live"]),
        "base_sha256": F.sha2(shown(F.filter(spans, lambda s: s["kind"] < 3)).cast("binary"), 256),
        "spans": shown(spans),
    }
