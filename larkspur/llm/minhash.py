"""MinHash near-duplicate detection.

One pass hashes each text's word shingles and sketches them by one-permutation
hashing: the hash space is cut in bins, each bin keeps its least hash, and
empty bins borrow by optimal densification.  Bands of the sketch are buckets.
Each bucket gives star-shaped candidate edges: from a centre to the members
that are not yet in its component; edges are confirmed on the full shingle
sets.  Buckets that still hold several components go on with other centres,
until every pair of a bucket has been compared, cannot be linked by an exact
bound, or lies in one component.  So no link between bucket mates is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import graph
from .common import drop, partitions, passing, sized, spread_join, temporaries, written
from .text import mix, shingle_sets, slices

BINS = 256
ROWS = 5
#: Cells of the bound on shared shingles.
CELLS = 512
#: Centres of a bucket in the second round; each later one has eight times as many.
SLOTS = 64
#: Candidate ids up to this number are broadcast; beyond, the join shuffles.
BROADCAST_IDS = 1_000_000

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(hashes: np.ndarray, offsets: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One-permutation sketches of sorted sets, densified; sets must not be
    empty."""
    n = len(offsets) - 1
    shift = np.uint64(64 - int(bins).bit_length() + 1)
    row = np.repeat(np.arange(n), np.diff(offsets))
    cell = row * bins + (hashes >> shift).astype(np.int64)
    first = np.concatenate([[True], cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, bool)
    out = np.full(n * bins, _EMPTY)
    out[cell[first]] = hashes[first]
    had = out != _EMPTY
    left = np.flatnonzero(~had)
    attempt = 0
    while len(left):
        attempt += 1
        at = left % bins
        probe = mix(at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt)) % np.uint64(bins)
        donor = left - at + probe.astype(np.int64)
        good = had[donor]
        # a borrowed value is tagged with nothing: equal donors give equal values in both sets
        out[left[good]] = out[donor[good]]
        left = left[~good]
    return out.reshape(n, bins)


def bands(sketches: np.ndarray, rows: int = ROWS) -> np.ndarray:
    count = sketches.shape[1] // rows
    cut = sketches[:, : count * rows].reshape(len(sketches), count, rows)
    state = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), cut.shape[:2]).copy()
    for k in range(rows):
        state = mix(state * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, k])
    return state


def _names(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A name of 128 bits for each whole set, in two halves: two sums of the
    set's hashes, mixed in two ways.  Equal sets have equal names."""
    sizes = np.diff(offsets).astype(np.uint64)
    out = []
    for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(seed)), dtype=np.uint64)])
        out.append(mix(sums[offsets[1:]] - sums[offsets[:-1]] + sizes).view(np.int64))
    return out[0], out[1]


def _sketch_batches(size: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, offsets = shingle_sets(part.column("text"), size)
                sizes = np.diff(offsets)
                some = sizes > 0
                keep = np.concatenate([[0], np.cumsum(sizes[some])])
                banded = bands(sketch(hashes, keep)).view(np.int64)
                width = banded.shape[1]
                ends = np.concatenate([[0], np.cumsum(np.where(some, width, 0))]).astype(np.int32)
                names = [pa.array(np.where(some, x, 0), mask=~some) for x in _names(hashes, offsets)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes), *names, pa.ListArray.from_arrays(pa.array(ends), pa.array(banded.reshape(-1)))],
                    ["id", "n_shingles", "hi", "lo", "bands"],
                )

    return run


def _set_batches(size: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, offsets = shingle_sets(part.column("text"), size)
                names = [pa.array(x) for x in _names(hashes, offsets)]
                yield pa.RecordBatch.from_arrays([*names, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes.view(np.int64)))], ["hi", "lo", "hashes"])

    return run


_BITS = [f"b{i}" for i in range(2 * CELLS // 64)]


def _run_batches(batches):
    """(node, its hashes) of rows sorted by node: lists without row objects."""
    rest_node, rest_hash = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def lists(nodes, hashes, starts):
        ends = np.concatenate([starts, [len(nodes)]]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(nodes[starts]), pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes))], ["node", "private"])

    for batch in batches:
        nodes = np.concatenate([rest_node, batch.column("node").to_numpy()])
        hashes = np.concatenate([rest_hash, batch.column("hash").to_numpy()])
        if not len(nodes):
            continue
        starts = np.concatenate([[0], np.flatnonzero(nodes[1:] != nodes[:-1]) + 1])
        last = starts[-1]  # the last node may go on in the next batch
        if last:
            yield lists(nodes[:last], hashes[:last], starts[:-1])
        rest_node, rest_hash = nodes[last:], hashes[last:]
    if len(rest_node):
        yield lists(rest_node, rest_hash, np.zeros(1, np.int64))


def _bound_batches(batches):
    """(node, size, private shingles, overflow, bits): a cell's first bit says
    that it holds a shingle, its second that it holds two; the overflow counts
    the shingles beyond."""
    for batch in batches:
        rows = []
        for node, hashes, private in zip(batch.column("node").to_pylist(), batch.column("hashes"), batch.column("private")):
            own = hashes.values.to_numpy()
            u = len(private.values) if private.is_valid else 0
            shared = np.setdiff1d(own, private.values.to_numpy(), assume_unique=True) if u else own
            count = np.bincount((shared.view(np.uint64) >> np.uint64(7)) % np.uint64(CELLS), minlength=CELLS)
            bits = np.packbits(np.concatenate([count > 0, count > 1])).view(np.int64)
            rows.append((node, len(own), u, int(np.maximum(count - 2, 0).sum()), *bits.tolist()))
        columns = list(zip(*rows)) if rows else [()] * (4 + len(_BITS))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "n", "u", "over", *_BITS])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id, kept.

    Texts are linked when 100 * |A ∩ B| >= ``percent`` * |A ∪ B| over their
    sets of ``shingle``-word shingles; components are reached by links.
    component_id is the smallest id reachable, kept says the id is its own
    component_id.  Null, empty and wordless texts have no shingles and are
    linked with nothing.  Equal sets (of equal names, 128 bits) are one node, so
    copies cost nothing and repeated rows stay repeated.  A row without an id
    takes part but names no component; where no member has an id, component_id
    and kept are null.  Ids are whole numbers.  Other columns are not read; the
    result is a table in the shared folder.
    """
    return _judged(docs, id_col, text_col, shingle, percent).select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(id, n_shingles, hi, lo, component_id, kept), written."""
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    with temporaries() as keep:
        made = source.mapInArrow(_sketch_batches(shingle), "id bigint, n_shingles bigint, hi bigint, lo bigint, bands array<bigint>")
        sketched = written(made.withColumn("uid", F.monotonically_increasing_id()), "sketches")
        # each distinct set is a node, named by one of its rows
        named = sketched.where("hi is not null").groupBy("hi", "lo")
        nodes = written(named.agg(F.min("uid").alias("node"), F.min("id").alias("least"), F.count("*").alias("held")), "nodes")
        comps = graph.components(_links(source, sketched, nodes, shingle, percent))
        linked = written(nodes.select("node", "least").join(comps, "node"), "linked")
        least = written(linked.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("held")), "least")
        of_node = spread_join(linked.select("node", "component"), least.drop("held"), ["component"], "node", linked.count(), least.select("component", "held"))
        told = nodes.join(of_node, "node", "left").select("hi", "lo", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
        rows = sketched.drop("bands")
        out = spread_join(rows, told, ["hi", "lo"], "uid", rows.count(), nodes.select("hi", "lo", "held"), how="left")
        component = F.when(F.col("hi").isNull(), F.col("id")).otherwise(F.col("component_id"))
        return keep(written(out.select("id", "n_shingles", "hi", "lo", component.alias("component_id"), (F.col("id") == component).alias("kept")), "judged"))


_NAME = T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType())])


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near copies (the
    smallest id), with all columns.  Rows without an id stay, and so do null,
    empty and wordless texts; rows that repeat an id and its shingles stay
    once; an empty table stays empty.  Columns may have any names."""
    judged = _judged(docs, id_col, text_col, shingle, percent)
    gone = judged.where(~F.col("kept")).select("id", F.struct("hi", "lo").alias("name")).distinct()
    if not docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").take(1):
        return docs.join(sized(gone.select(F.col("id").alias(id_col)), BROADCAST_IDS), id_col, "left_anti").select(docs.columns)
    # ids repeat: a row is known by its id and its shingle set
    named, name = passing(docs, text_col, _NAME, lambda texts: _names_of(texts, shingle))
    gone = gone.select(F.col("id").alias(id_col), F.col("name").alias(name))
    left = named.join(sized(gone, BROADCAST_IDS), [id_col, name], "left_anti")
    once = left.where(F.col(id_col).isNotNull() & F.col(name).isNotNull()).dropDuplicates([id_col, name])
    return once.union(left.where(F.col(id_col).isNull() | F.col(name).isNull())).select(docs.columns)


def _names_of(texts: pa.Array, shingle: int) -> pa.Array:
    hashes, offsets = shingle_sets(texts, shingle)
    return pa.StructArray.from_arrays([pa.array(x) for x in _names(hashes, offsets)], ["hi", "lo"], mask=pa.array(np.diff(offsets) == 0))


def _links(source: DataFrame, sketched: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Confirmed links (u, v) that give the components of all links.

    A node's private shingles are those that no other candidate holds; the rest
    are counted in cells by hash, in unary up to two a cell.  Two nodes share
    no more than the cells' lesser counts add up to, exactly, so nodes and pairs
    beyond that bound are never compared; among many copies of one text it lets
    through little more than the links.  The centre of a bucket is the node with
    the least private share, the one that the others were copied from.  Buckets
    of very many members are dealt out over several tasks, and so are the pairs
    of a centre."""
    rows = sketched.where("hi is not null").select("uid", "lo", F.explode("bands").alias("band"))
    # a bucket matters if it holds two different sets
    busy = written(rows.groupBy("band").agg(F.min("lo").alias("a"), F.max("lo").alias("z"), F.count("*").alias("held")).where("a < z").select("band", "held"), "busy")
    members = spread_join(rows.select("uid", "band"), busy.select("band"), ["band"], "uid", sketched.count(), busy).select("band", F.col("uid").alias("node"))
    members = written(members.join(nodes.select("node"), "node", "left_semi").select("band", "node"), "members")
    drop(busy)
    sets = _full_sets(source, nodes, members, shingle)
    held = sets.select("node", F.explode("hashes").alias("hash")).groupBy("hash").agg(F.min("node").alias("node"), F.count("*").alias("holders"))
    alone = held.where("holders = 1").select("node", "hash").repartition(partitions(source.sparkSession), "node").sortWithinPartitions("node")
    private = alone.mapInArrow(_run_batches, "node bigint, private array<bigint>")
    bounds = sets.join(private, "node", "left").mapInArrow(_bound_batches, "node bigint, n bigint, u bigint, over bigint, " + ", ".join(f"{b} bigint" for b in _BITS))
    bounds = bounds.where((F.col("n") - F.col("u")) * 100 >= F.col("n") * percent)
    known = ["n", "u", "over", *_BITS]
    placed = written(members.join(bounds, "node").select("band", "node", *known, F.col("node").alias("comp")), "placed")
    drop(members)
    links: list[DataFrame] = []
    tested: list[DataFrame] = []
    slots = 1
    while True:
        parts = placed.groupBy("band", "comp").agg(F.count("*").alias("n"))
        split = parts.groupBy("band").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("held"), F.count("*").alias("comps")).where("comps > 1")
        split = written(split.select("band", F.col("top.comp").alias("top"), (F.col("held") - F.col("top.n") <= slots).alias("few"), "held"), "split")
        if not split.take(1):
            break
        size, sizes = placed.count(), split.select("band", "held")
        opened = written(spread_join(placed, split.drop("held"), ["band"], "node", size, sizes), "opened")
        drop(placed)
        # the first round has one centre for each bucket; later ones all members outside a bucket's largest component, if
        # these are few, which settles the bucket, and else several centres
        last_of_band = F.col("few") & F.lit(slots > 1)
        slot = F.when(last_of_band, F.col("node")).otherwise(F.pmod(F.xxhash64("node", "band"), F.lit(slots)))
        central = F.struct((F.col("u") * 1000 / F.col("n")).cast("int").alias("share"), F.xxhash64("node", "band").alias("o"), "node", "n", "over", *_BITS, "comp")
        chosen = opened.where(~last_of_band | (F.col("comp") != F.col("top"))).groupBy("band", slot.alias("slot")).agg(F.min(central).alias("p"))
        pivots = written(chosen.select("band", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("node", "n", "over", *_BITS, "comp")]), "pivots")
        most = sum((F.bit_count(F.col(b).bitwiseAND(F.col(f"p_{b}"))) for b in _BITS), F.least("over", "p_over"))
        possible = (F.col("comp") != F.col("p_comp")) & (most * 100 >= (F.col("n") + F.col("p_n") - most) * percent)
        near = spread_join(opened, pivots, ["band"], "node", size, sizes).where(possible)
        pairs = near.groupBy(F.least("node", "p_node").alias("u"), F.greatest("node", "p_node").alias("v")).agg(F.min("comp").alias("c1"), F.max("p_comp").alias("c2"))
        if tested:
            pairs = pairs.join(_together(tested).select("u", "v"), ["u", "v"], "left_anti")
        tested.append(written(pairs, "pairs"))
        links.append(written(_confirmed(tested[-1], sets, percent), "links"))
        rest = opened.where(~last_of_band).drop("top", "few").join(pivots.select("band", F.col("p_node").alias("node")), ["band", "node"], "left_anti")
        if links[-1].take(1):
            merged = graph.components(links[-1].select(F.col("c1").alias("u"), F.col("c2").alias("v"))).select(F.col("node").alias("comp"), "component")
            rest = spread_join(rest, merged, ["comp"], "node", size, how="left").withColumn("comp", F.coalesce("component", "comp"))
        placed = written(rest.select("band", "node", *known, "comp"), "placed")
        drop(opened, split, pivots)
        slots *= SLOTS if slots == 1 else 8
    if not links:
        return nodes.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    return _together(links).select("u", "v")


def _together(tables: list[DataFrame]) -> DataFrame:
    every = tables[0]
    for more in tables[1:]:
        every = every.union(more)
    return every


def _full_sets(source: DataFrame, nodes: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """The whole shingle set of each candidate node, from one of its texts."""
    wanted = written(nodes.join(members.select("node").distinct(), "node").select("node", "hi", "lo", F.col("least").alias("id")), "wanted")
    ids = wanted.where("id is not null").select("id").distinct()
    texts = source.join(sized(ids, BROADCAST_IDS), "id", "left_semi").select("text")
    if wanted.where("id is null").take(1):  # nodes of rows without ids: every such row is a possible text
        texts = texts.union(source.where("id is null").select("text"))
    found = texts.mapInArrow(_set_batches(shingle), "hi bigint, lo bigint, hashes array<bigint>")
    # rows that repeat an id may have other texts: only the named sets stay
    out = written(found.join(sized(wanted.select("node", "hi", "lo"), BROADCAST_IDS), ["hi", "lo"]).dropDuplicates(["node"]).select("node", "hashes"), "sets")
    drop(wanted)
    return out


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are alike enough.  A pair carries one set to
    the other, which is sent once to each part of a centre's pairs."""
    rows = pairs.count()
    a = sets.select(F.col("node").alias("u"), F.col("hashes").alias("hu"))
    b = sets.select(F.col("node").alias("v"), F.col("hashes").alias("hv"))
    both = F.size(F.array_intersect("hu", "hv")).cast("bigint")
    total = (F.size("hu") + F.size("hv")).cast("bigint")
    sizes = F.least(F.size("hu"), F.size("hv")).cast("bigint") * 100 >= F.greatest(F.size("hu"), F.size("hv")).cast("bigint") * percent
    of_v = pairs.groupBy("v").agg(F.count("*").alias("held"))
    met = spread_join(spread_join(pairs, a, ["u"], "v", rows), b, ["v"], "u", rows, of_v)
    return met.where(sizes).where(both * 100 >= (total - both) * percent).select("u", "v", "c1", "c2")
