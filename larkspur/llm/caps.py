"""Embedding near-duplicates by spherical-cap filters.

Filters are directions of a structured random product code: a random rotation,
the space cut in two halves, and in each half ``k`` Gaussian directions; a
filter is one direction of either half, and its product with a vector is the
sum of the halves' products.  Each vector is list-decoded to all filters whose
product reaches its threshold; vectors that share a filter are compared exactly.
The threshold is the vector's own, its ``FILTERS``-th greatest product (filters
that tie with it count too): under one threshold for all, vectors that lie far
from a finite code would have few filters and lose links.

Equal vectors are one class.  A filter with many classes is cut into blocks,
whose pairs are compared by matrix products, a slice at a time, so no task
holds more than two blocks and no pairs are written: a task returns link counts
and a spanning forest of the links that it saw.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph
from .common import partitions, spread_join, temporaries, written

#: Filters of each vector in each of several independent codes, and classes of a filter on average.
FILTERS = 24
AVERAGE = 512
#: Classes of a block, and rows of a matrix product.
BLOCK, SLICE = 4096, 512
#: Crowded filters up to this number are broadcast; beyond, the join shuffles.
CROWDED = 500_000
SEED = 20_240_607


def codes_for(k: int) -> int:
    """Independent codes of ``k`` directions a half.  A pair at cosine 0.9
    shares no filter of one code in 0.1 percent of cases at 64 directions, but
    in 1 percent at 512 and in 7 at 8192, so larger codes are more: at every
    size about one pair in ten thousand is lost at most."""
    return 2 + (k > 512) + (k > 2048) + (k > 16_384)


class Code:
    """The product code for vectors of ``dim`` components."""

    def __init__(self, dim: int, k: int, number: int = 0):
        rng = np.random.default_rng([SEED, dim, number])
        self.k = k
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.half = (dim + 1) // 2
        self.a = rng.standard_normal((k, self.half))
        self.b = rng.standard_normal((k, dim - self.half))

    def decode(self, unit: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of the filters whose products reach a row's ``n``-th
        greatest, sorted by row.  They lie among the sums of the best directions
        of either half, the ``n`` best and those that tie with them."""
        turned = unit @ self.turn
        left, right = turned[:, : self.half] @ self.a.T, turned[:, self.half :] @ self.b.T
        m = min(n, self.k)
        tied = max(_tied(left, m), _tied(right, m))
        i = np.argpartition(-left, tied - 1, axis=1)[:, :tied]
        j = np.argpartition(-right, tied - 1, axis=1)[:, :tied]
        sums = np.take_along_axis(left, i, 1)[:, :, None] + np.take_along_axis(right, j, 1)[:, None, :]
        sums = sums.reshape(len(unit), -1)
        least = -np.partition(-sums, n - 1, axis=1)[:, n - 1]
        row, place = np.nonzero(sums >= least[:, None])
        return row, i[row, place // tied] * self.k + j[row, place % tied]


def _tied(products: np.ndarray, m: int) -> int:
    """How many directions a row has at most that reach its ``m``-th best."""
    if m == products.shape[1]:
        return m
    least = -np.partition(-products, m - 1, axis=1)[:, m - 1]
    return int((products >= least[:, None]).sum(axis=1).max(initial=m))


class Codes:
    """Several independent codes; a filter's name also tells its code and the
    vectors' length."""

    def __init__(self, dim: int, k: int, expected: int):
        self.base = dim << 40
        self.codes = [Code(dim, k, c) for c in range(codes_for(k))]
        self.width, self.n = k * k, min(expected, k * k)

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Each row's filters, sorted."""
        rows, names = [], []
        for at in range(0, len(unit), 1024):
            for c, code in enumerate(self.codes):
                row, name = code.decode(unit[at : at + 1024], self.n)
                rows.append(row + at)
                names.append(name + (self.base + c * self.width))
        row, name = np.concatenate(rows), np.concatenate(names)
        order = np.lexsort((name, row))
        return np.split(name[order], np.searchsorted(row[order], np.arange(1, len(unit))))


def _units(raw: list[bytes], kind: str) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _node_batches(kind: str):
    def run(batches):
        for batch in batches:
            names, raws = [], []
            for v in batch.column("v"):
                x = np.array(v.as_py(), np.float64) if v.is_valid else None
                good = x is not None and len(x) and bool(np.isfinite(x).all()) and bool(x.any())
                raw = (x + 0.0).astype(kind).tobytes() if good else None
                names.append(xxhash.xxh3_128_digest(raw) if good else None)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.binary()), pa.array(raws, pa.binary())], ["id", "name", "raw"])

    return run


def _codes(memo: dict, dim: int, k: int, expected: int) -> Codes:
    if dim not in memo:
        memo[dim] = Codes(dim, k, expected)
    return memo[dim]


def _decode_batches(k: int, expected: int, kind: str):
    width = np.dtype(kind).itemsize

    def run(batches):
        memo: dict[int, Codes] = {}
        for batch in batches:
            raws = batch.column("raw").to_pylist()
            sizes = np.array([len(r) // width for r in raws])
            found: list = [None] * len(raws)
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                for r, f in zip(rows.tolist(), _codes(memo, dim, k, expected).decode(_units([raws[r] for r in rows], kind))):
                    found[r] = f.tolist()
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("size"), batch.column("raw"), pa.array(found, pa.list_(pa.int64()))], ["node", "size", "raw", "filters"])

    return run


class _Forest:
    """Which rows are joined by the links seen so far."""

    def __init__(self, n: int):
        self.top, self.edges = np.arange(n), []

    def add(self, linked: np.ndarray, first: int) -> None:
        """Links of the rows from ``first`` on with all rows."""
        for k in np.flatnonzero(linked.any(axis=1)).tolist():
            others = np.flatnonzero(linked[k])
            tops, at = np.unique(self.top[others], return_index=True)
            new = tops != self.top[first + k]
            if new.any():
                self.edges.extend((first + k, j) for j in others[at[new]].tolist())
                self.top[np.isin(self.top, tops)] = self.top[first + k]


def _links(own: int, nodes, sizes, raw, block, split: bool, k: int, expected: int, cosine: float, kind: str, memo: dict):
    """(node, other, links) of one filter's classes: within one block, or where
    ``split`` between two.  A pair that shares several filters counts in the
    first of them alone; ``other`` makes a spanning forest."""
    unit = _units(raw, kind)
    forest, count = _Forest(len(nodes)), np.zeros(len(nodes), np.int64)
    some = np.zeros(len(nodes), bool)
    for at in range(0, len(nodes), SLICE):  # who has links at all: few, mostly
        linked = unit[at : at + SLICE] @ unit.T >= cosine
        if split:
            linked &= block[at : at + SLICE, None] != block[None, :]
        linked[np.arange(len(linked)), np.arange(at, at + len(linked))] = False
        some[at : at + SLICE] = linked.any(axis=1)
        forest.add(linked, at)
    rows = np.flatnonzero(some)
    if not len(rows):
        return [], [], []
    unit, own_block = unit[rows], block[rows]
    lists = [x[x < own] for x in _codes(memo, unit.shape[1], k, expected).decode(unit)]
    early = np.concatenate(lists)
    names, column = np.unique(early, return_inverse=True)
    shared = np.flatnonzero(np.bincount(column, minlength=len(names)) > 1)  # filters of one row alone decide nothing
    place = np.full(len(names), -1)
    place[shared] = np.arange(len(shared))
    row, column = np.repeat(np.arange(len(rows)), [len(x) for x in lists]), place[column]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, len(rows), SLICE):
        linked = unit[at : at + SLICE] @ unit.T >= cosine
        if split:
            linked &= own_block[at : at + SLICE, None] != own_block[None, :]
        linked[np.arange(len(linked)), np.arange(at, at + len(linked))] = False
        seen = np.zeros(linked.shape, bool)
        for c in np.split(row, np.searchsorted(column, np.arange(1, len(shared)))) if len(row) else ():
            here = c[(c >= at) & (c < at + SLICE)] - at
            if len(here):
                seen[np.ix_(here, c)] = True
        count[rows[at : at + SLICE]] = (linked & ~seen) @ sizes[rows]
    told = np.flatnonzero(count)
    left, right = zip(*forest.edges) if forest.edges else ((), ())
    out_node = [*nodes[list(left)].tolist(), *nodes[told].tolist()]
    out_other = [*nodes[list(right)].tolist(), *[None] * len(told)]
    return out_node, out_other, [0] * len(left) + count[told].tolist()


COLUMNS = ("filter", "i", "j", "block", "node", "size", "raw")


def _compare_batches(k: int, expected: int, cosine: float, kind: str):
    """Groups (filter, i, j) of sorted rows, one at a time."""

    def run(batches):
        memo: dict[int, Codes] = {}
        rest = None

        def told(parts):
            out = [[], [], []]
            for t in parts:
                if t.num_rows > 1:
                    column = lambda c: t.column(c).to_numpy(zero_copy_only=False)  # noqa: E731, B023
                    i, j = column("i")[0], column("j")[0]
                    found = _links(int(column("filter")[0]), column("node"), column("size"), t.column("raw").to_pylist(), column("block"), i != j, k, expected, cosine, kind, memo)
                    for all_, some in zip(out, found):
                        all_.extend(some)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["node", "other", "links"])

        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("filter", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), table.num_rows]
            parts = [table.slice(a, b - a) for a, b in zip(bounds, bounds[1:])]
            if len(parts) > 1:
                yield told(parts[:-1])
            rest = parts[-1].combine_chunks().to_batches()[0]  # the last group may go on in the next batch
        if rest is not None:
            yield told([pa.Table.from_batches([rest])])

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, expected: int = FILTERS) -> DataFrame:
    """One row for each row of ``vectors``: id, n_links, component_id, kept.

    Vectors link at cosine >= ``cosine`` in double precision; component_id is
    the smallest id reachable.  Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, and vectors of different
    lengths are not compared.  Equal vectors are linked (repeated rows count as
    other vectors).  A row without an id takes part but names no component;
    where no member has an id, component_id and kept are null.  Ids are whole
    numbers.  Other columns are not read; the result is a table in the shared
    folder.

    The code grows with the table, so that a filter has some ``AVERAGE``
    classes; the loss at the threshold stays the same (``codes_for``).
    """
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    source = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    with temporaries() as keep:
        rows = source.mapInArrow(_node_batches(kind), "id bigint, name binary, raw binary").withColumn("uid", F.monotonically_increasing_id())
        rows = written(rows, "vectors")
        grouped = rows.where("name is not null").groupBy("name").agg(F.count("*").alias("size"), F.min("id").alias("least"), F.first("raw").alias("raw"))
        classes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
        n = classes.count()
        k = 16
        while k * k < n * expected / AVERAGE:
            k *= 2
        each = classes.repartition(partitions(spark)).select("node", "size", "raw").mapInArrow(_decode_batches(k, expected, kind), "node bigint, size bigint, raw binary, filters array<bigint>")
        each = written(each, "decoded").select("node", "size", "raw", F.explode("filters").alias("filter"))
        counts = each.groupBy("filter").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("held"))
        # a filter of several blocks has more than BLOCK classes: few have
        crowded = written(counts.where("blocks > 1").select("filter", "blocks", "held"), "filters")
        if crowded.count() <= CROWDED:
            cut = each.join(F.broadcast(crowded.drop("held")), "filter", "left")
        else:
            cut = spread_join(each, crowded.drop("held"), ["filter"], "node", each.count(), crowded.select("filter", "held"), how="left")
        cut = cut.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        paired = cut.withColumn("o", other).withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o")).select(*COLUMNS)
        dealt = paired.repartition(partitions(spark), "filter", "i", "j").sortWithinPartitions("filter", "i", "j")
        seen = written(dealt.mapInArrow(_compare_batches(k, expected, cosine, kind), "node bigint, other bigint, links bigint"), "caps")
        links = seen.groupBy("node").agg(F.sum("links").alias("links"))
        comps = graph.components(seen.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
        linked = written(classes.select("node", "least").join(comps, "node"), "linked")
        least = written(linked.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("held")), "least")
        of_node = spread_join(linked.select("node", "component"), least.drop("held"), ["component"], "node", linked.count(), least.select("component", "held"))
        told = classes.select("name", "node", "size", "least").join(of_node, "node", "left").join(links, "node", "left")
        told = told.select("name", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
        ids = rows.select("uid", "id", "name")
        out = spread_join(ids, told, ["name"], "uid", ids.count(), classes.select("name", F.col("size").alias("held")), how="left")
        component = F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("component_id"))
        kept = out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
        return keep(written(kept, "judged"))
